"""Model comparison and combination on the naive forecasts, per series."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import ensemble, monitor, split
from tidemark.operators.features import SERIES_FEATURES
from tidemark.operators.profile import safe_corr
from tidemark.plans.common import (
    LINE_GRAIN,
    SCORED_ALL,
    SUPPLIER_ALL,
    forecasts,
    known,
    rounded,
    scored_wide,
    sql_round,
    supplier_features,
)
from tidemark.sources import store
from tidemark.sources.tables import table

QUERIES, ORACLE = {}, {}
A, B = "vol_5", "half_vol_20"
NAMES = ("average", "half_vol_20", "vol_5")


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLE[fn.__name__] = sql
        return fn

    return register


PAIRED = """paired AS (SELECT series, bar, rv_5d, half_vol_20, vol_5 FROM scored_wide
  WHERE rv_5d IS NOT NULL AND half_vol_20 IS NOT NULL AND vol_5 IS NOT NULL)"""
PAIRED_CTES = (*SCORED_ALL, PAIRED)


def paired(spark, sf):
    """Rows with the label and both forecasts."""
    return scored_wide(spark, sf).dropna(subset=["rv_5d", A, B])


@query(
    sql_round(
        """SELECT series, bar, y_a, pred_a, y_b, pred_b,
                  CASE WHEN n_a = 0 THEN 'only_b' WHEN n_b = 0 THEN 'only_a'
                       WHEN abs(y_a - y_b) <= 1e-8 + 1e-5 * abs(y_b) THEN 'aligned' ELSE 'label_mismatch' END AS status
           FROM (SELECT series, bar,
                        max(rv_5d) FILTER (model = 'vol_5') AS y_a, max(prediction) FILTER (model = 'vol_5') AS pred_a,
                        max(rv_5d) FILTER (model = 'half_vol_20') AS y_b, max(prediction) FILTER (model = 'half_vol_20') AS pred_b,
                        count(*) FILTER (model = 'vol_5') AS n_a, count(*) FILTER (model = 'half_vol_20') AS n_b
                 FROM known WHERE model IN ('vol_5', 'half_vol_20') GROUP BY series, bar) p""",
        ("y_a", "pred_a", "y_b", "pred_b"),
        SCORED_ALL,
    )
)
def aligned_predictions(spark, sf):
    rows = store.stored(known(spark, sf), "known")
    one = lambda m: rows.where(F.col("model") == m)
    return rounded(ensemble.aligned_predictions(one(A), one(B), ["series", "bar"]))


@query(
    sql_round(
        """SELECT series, count(*) AS n, avg(d) AS mean_diff, stddev_pop(d) AS std_diff,
                  max(d) AS max_diff, covar_pop(vol_5, half_vol_20)
                    / (stddev_pop(vol_5) * stddev_pop(half_vol_20)) AS corr
           FROM (SELECT *, abs(vol_5 - half_vol_20) AS d FROM paired) p GROUP BY series""",
        ("mean_diff", "std_diff", "max_diff", "corr"),
        PAIRED_CTES,
    )
)
def prediction_diff(spark, sf):
    return rounded(ensemble.prediction_diff(paired(spark, sf), A, B))


GRID = """grid AS (
  SELECT series, weight, sqrt(avg(power(rv_5d - weight * vol_5 - (1 - weight) * half_vol_20, 2)))
           AS rmse
  FROM paired, (SELECT unnest(range(21)) / 20.0::DOUBLE AS weight) g GROUP BY series, weight)"""


@query(sql_round("SELECT * FROM grid", ("weight", "rmse"), (*PAIRED_CTES, GRID)))
def blend_search(spark, sf):
    return rounded(ensemble.blend_search(paired(spark, sf), A, B))


@query(
    sql_round(
        "SELECT series, arg_min(weight, rmse) AS weight, min(rmse) AS rmse FROM grid GROUP BY series",
        ("weight", "rmse"),
        (*PAIRED_CTES, GRID),
    )
)
def best_blend(spark, sf):
    return rounded(ensemble.best_blend(ensemble.blend_search(paired(spark, sf), A, B)))


STACK = """moments AS (
  SELECT series, count(*) AS n, avg(vol_5) AS m1, avg(half_vol_20) AS m2, avg(rv_5d) AS my,
         var_pop(vol_5) + alpha / count(*) AS s1, var_pop(half_vol_20) + alpha / count(*) AS s2,
         covar_pop(vol_5, half_vol_20) AS c12, covar_pop(vol_5, rv_5d) AS c1y,
         covar_pop(half_vol_20, rv_5d) AS c2y, alpha
  FROM paired, (SELECT unnest([0.001, 0.01, 0.1, 1.0, 10.0])::DOUBLE AS alpha) a
  GROUP BY series, alpha),
 weights AS (
  SELECT series, alpha, (c1y * s2 - c2y * c12) / (s1 * s2 - c12 * c12) AS weight_a,
         (c2y * s1 - c1y * c12) / (s1 * s2 - c12 * c12) AS weight_b, m1, m2, my
  FROM moments WHERE s1 * s2 - c12 * c12 <> 0),
 stack AS (
  SELECT w.series, w.alpha, w.weight_a, w.weight_b, my - weight_a * m1 - weight_b * m2 AS intercept,
         CASE WHEN weight_a + weight_b > 0 THEN weight_a / (weight_a + weight_b) END AS share_a,
         CASE WHEN weight_a + weight_b > 0 THEN weight_b / (weight_a + weight_b) END AS share_b
  FROM weights w),
 stacked AS (
  SELECT s.*, r.rmse FROM stack s JOIN (
    SELECT s.series, s.alpha, sqrt(avg(power(p.rv_5d - s.intercept - s.weight_a * p.vol_5
             - s.weight_b * p.half_vol_20, 2))) AS rmse
    FROM stack s JOIN paired p ON s.series = p.series GROUP BY ALL) r
  ON s.series = r.series AND s.alpha = r.alpha)"""


@query(
    sql_round(
        "SELECT * FROM stacked",
        ("weight_a", "weight_b", "intercept", "share_a", "share_b", "rmse"),
        (*PAIRED_CTES, STACK),
    )
)
def stacking_weights(spark, sf):
    return rounded(
        ensemble.stacking_weights(paired(spark, sf), A, B, alphas=ensemble.ALPHA_GRID)
    )


def _window(name: str, where: str) -> str:
    return f"""SELECT series, '{name}' AS "window", count(*) AS samples, min(bar) AS start,
         max(bar) AS "end", sqrt(avg(power(vol_5 - rv_5d, 2))) AS rmse_a,
         avg(abs(vol_5 - rv_5d)) AS mae_a, sqrt(avg(power(half_vol_20 - rv_5d, 2))) AS rmse_b,
         avg(abs(half_vol_20 - rv_5d)) AS mae_b
  FROM (SELECT *, row_number() OVER (PARTITION BY series ORDER BY bar DESC) AS rn FROM paired) r
  WHERE {where} GROUP BY series"""


WINDOWS = (
    "raw_windows AS ("
    + " UNION ALL ".join(
        [_window("full", "true")] + [_window(f"last_{n}", f"rn <= {n}") for n in (30, 10, 1)]
    )
    + """),
 windows AS (SELECT *, CASE WHEN rmse_b < rmse_a THEN 'B' ELSE 'A' END AS winner,
    abs(CASE WHEN rmse_b < rmse_a THEN (rmse_b - rmse_a) / rmse_a * 100
             WHEN rmse_b <> 0 THEN (rmse_a - rmse_b) / rmse_b * 100 END) AS improvement_pct
  FROM raw_windows)"""
)
WINDOW_CTES = (*PAIRED_CTES, WINDOWS)


def windows(spark, sf):
    return ensemble.ab_windows(store.stored(paired(spark, sf), "paired"), A, B)


@query(
    sql_round(
        "SELECT * FROM windows", ("rmse_a", "mae_a", "rmse_b", "mae_b", "improvement_pct"), WINDOW_CTES
    )
)
def ab_windows(spark, sf):
    return rounded(windows(spark, sf))


@query(
    sql_round(
        """SELECT series, winner, count(*) AS wins,
                  count(*) * 100.0::DOUBLE / sum(count(*)) OVER (PARTITION BY series) AS win_rate
           FROM windows GROUP BY series, winner""",
        ("win_rate",),
        WINDOW_CTES,
    )
)
def win_rate(spark, sf):
    return rounded(ensemble.win_rate(windows(spark, sf)))


@query(
    sql_round(
        """SELECT series, drift_pct, b_win_rate,
                  CASE WHEN drift_pct > 20 THEN 'RETRAIN' WHEN drift_pct > 10 THEN 'PLAN_RETRAIN'
                       ELSE 'OK' END AS recommendation,
                  CASE WHEN b_win_rate >= 75 AND drift_pct < 10 THEN 'B'
                       WHEN b_win_rate >= 50 THEN 'B (with caution)' ELSE 'A' END AS selected_model
           FROM (SELECT series, (max(CASE WHEN "window" = 'last_30' THEN rmse_a END)
                          / max(CASE WHEN "window" = 'full' THEN rmse_a END) - 1) * 100 AS drift_pct,
                        avg(CASE WHEN winner = 'B' THEN 100.0 ELSE 0.0 END) AS b_win_rate
                 FROM windows GROUP BY series) f""",
        ("drift_pct", "b_win_rate"),
        WINDOW_CTES,
    )
)
def drift_decision(spark, sf):
    return rounded(ensemble.drift_decision(windows(spark, sf)))


# ---- candidate table: train / val / test errors per (series, model) -----------------


def candidates(spark, sf):
    rows = split.time_split(paired(spark, sf), keys=["series"], grain=LINE_GRAIN)
    rows = rows.withColumn("average", (F.col(A) + F.col(B)) / 2.0)
    long = rows.unpivot(["series", "bar", "split", "rv_5d"], list(NAMES), "model", "prediction")
    per = monitor.regression_metrics(long, ["series", "model", "split"])
    # a few rows per series, read several times by the rules
    per = store.stored(per, "candidates")
    pick = lambda s, m: F.max(F.when(F.col("split") == s, F.col(m))).alias(f"{s}_{m}")
    return per.groupBy("series", "model").agg(
        pick("train", "rmse"), pick("val", "rmse"), pick("val", "r2"), pick("test", "rmse")
    )


def _rmse(s: str) -> str:
    return (
        f"sqrt(avg(CASE WHEN split = '{s}' THEN power(prediction - rv_5d, 2) END)) AS {s}_rmse"
    )


CANDIDATES = f"""split AS (
  SELECT *, CASE WHEN rn > pre THEN 'test'
         WHEN rn > pre - greatest(1, CAST(floor(pre * 0.2) AS BIGINT)) THEN 'val' ELSE 'train' END AS split
  FROM (SELECT *, greatest(count(*) OVER (PARTITION BY series) - 30, 0) AS pre,
               row_number() OVER (PARTITION BY series ORDER BY bar) AS rn FROM paired) p),
 long AS (SELECT series, split, rv_5d, 'vol_5' AS model, vol_5 AS prediction FROM split
  UNION ALL SELECT series, split, rv_5d, 'half_vol_20', half_vol_20 FROM split
  UNION ALL SELECT series, split, rv_5d, 'average', (vol_5 + half_vol_20) / 2 FROM split),
 candidates AS (
  SELECT series, model, {_rmse('train')}, {_rmse('val')},
         1 - avg(CASE WHEN split = 'val' THEN power(prediction - rv_5d, 2) END)
             / var_pop(CASE WHEN split = 'val' THEN rv_5d END) AS val_r2, {_rmse('test')}
  FROM long GROUP BY series, model)"""
CANDIDATE_CTES = (*PAIRED_CTES, CANDIDATES)
_ERRORS = ("train_rmse", "val_rmse", "val_r2", "test_rmse")


@query(
    sql_round(
        "SELECT *, row_number() OVER (PARTITION BY series ORDER BY val_rmse, model) AS rank "
        "FROM candidates",
        _ERRORS,
        CANDIDATE_CTES,
    )
)
def model_rank(spark, sf):
    return rounded(ensemble.model_rank(candidates(spark, sf)))


@query(
    sql_round(
        """SELECT series, model, val_rmse, test_rmse, place FROM (
             SELECT *, CAST(row_number() OVER (PARTITION BY series ORDER BY val_rmse,
                       test_rmse NULLS LAST, model) AS INTEGER) AS place FROM candidates) r
           WHERE place <= 2""",
        ("val_rmse", "test_rmse"),
        CANDIDATE_CTES,
    )
)
def top_models(spark, sf):
    best = ensemble.top_models(candidates(spark, sf))
    return rounded(best.select("series", "model", "val_rmse", "test_rmse", "place"))


@query(
    sql_round(
        """SELECT series, a.val_rmse AS rmse_a, b.val_rmse AS rmse_b,
                  abs(a.val_rmse - b.val_rmse) / least(a.val_rmse, b.val_rmse) * 100 AS diff_pct,
                  CASE WHEN CASE WHEN abs(a.val_rmse - b.val_rmse) / least(a.val_rmse, b.val_rmse)
                                      * 100 < 0.5 THEN a.val_r2 > b.val_r2
                                 ELSE a.val_rmse < b.val_rmse END
                       THEN 'vol_5' ELSE 'half_vol_20' END AS selected
           FROM (SELECT * FROM candidates WHERE model = 'vol_5') a
           JOIN (SELECT * FROM candidates WHERE model = 'half_vol_20') b USING (series)""",
        ("rmse_a", "rmse_b", "diff_pct"),
        CANDIDATE_CTES,
    )
)
def select_model(spark, sf):
    return rounded(ensemble.select_model(candidates(spark, sf), A, B))


def _pick(cur: str, best: str) -> str:
    return (
        f"coalesce(CASE WHEN v_{cur} < {best}_v THEN true WHEN abs(v_{cur} - {best}_v) "
        f"<= 1e-8 + 1e-5 * abs({best}_v) THEN t_{cur} < {best}_t END, false)"
    )


@query(
    sql_round(
        f"""SELECT series, CASE WHEN w3 THEN 'average' ELSE s2 END AS winner,
                  CASE WHEN w3 THEN v_average ELSE b2_v END AS val_rmse,
                  CASE WHEN w3 THEN t_average ELSE b2_t END AS test_rmse
           FROM (SELECT *, {_pick('average', 'b2')} AS w3 FROM (
             SELECT *, CASE WHEN w2 THEN 'half_vol_20' ELSE 'vol_5' END AS s2,
                    CASE WHEN w2 THEN v_half_vol_20 ELSE b1_v END AS b2_v,
                    CASE WHEN w2 THEN t_half_vol_20 ELSE b1_t END AS b2_t
             FROM (SELECT *, {_pick('half_vol_20', 'b1')} AS w2 FROM (
               SELECT series, {', '.join(
                   f"max(CASE WHEN model = '{m}' THEN val_rmse END) AS v_{m}, "
                   f"max(CASE WHEN model = '{m}' THEN test_rmse END) AS t_{m}" for m in NAMES)},
                 max(CASE WHEN model = 'vol_5' THEN val_rmse END) AS b1_v,
                 max(CASE WHEN model = 'vol_5' THEN test_rmse END) AS b1_t
               FROM candidates GROUP BY series) e) f) g) h""",
        ("val_rmse", "test_rmse"),
        CANDIDATE_CTES,
    )
)
def best_overall(spark, sf):
    """Individual models first, the simple average as the combined candidate last."""
    order = [A, B, "average"]
    rows = candidates(spark, sf)
    at = lambda m, f: F.max(F.when(F.col("model") == m, F.col(f"{f}_rmse"))).alias(f"{f}_{m}")
    entries = rows.groupBy("series").agg(*[at(m, f) for m in order for f in ("val", "test")])
    return rounded(ensemble.best_overall(entries, order))


GAPS = """gaps AS (
  SELECT c.series, c.model, c.train_rmse, c.val_rmse, c.train_rmse - c.val_rmse AS gap,
         abs(c.train_rmse - c.val_rmse) / c.train_rmse * 100 AS gap_over_train,
         (c.train_rmse - c.val_rmse) / c.val_rmse * 100 AS gap_over_val,
         CASE WHEN abs(c.train_rmse - c.val_rmse) / c.train_rmse * 100 < 5 THEN 'good'
              WHEN abs(c.train_rmse - c.val_rmse) / c.train_rmse * 100 < 10 THEN 'slight'
              ELSE 'overfit' END AS gap_class,
         CASE WHEN c.val_rmse < c.train_rmse * 1.1 THEN 'good'
              WHEN c.val_rmse < c.train_rmse * 1.2 THEN 'slight' ELSE 'overfit' END AS ratio_class,
         (b.val_rmse - c.val_rmse) / b.val_rmse * 100 AS improvement_pct
  FROM candidates c LEFT JOIN (SELECT series, val_rmse FROM candidates
                               WHERE model = 'half_vol_20') b ON c.series = b.series)"""


@query(
    sql_round(
        "SELECT * FROM gaps",
        ("train_rmse", "val_rmse", "gap", "gap_over_train", "gap_over_val", "improvement_pct"),
        (*CANDIDATE_CTES, GAPS),
    )
)
def generalization_gap(spark, sf):
    return rounded(ensemble.generalization_gap(candidates(spark, sf), B))


@query(
    sql_round(
        """SELECT model, covar_pop(val_rmse, gap_over_val) / (
             stddev_pop(CASE WHEN gap_over_val IS NOT NULL THEN val_rmse END)
             * stddev_pop(gap_over_val)) AS gap_rmse_corr FROM gaps GROUP BY model""",
        ("gap_rmse_corr",),
        (*CANDIDATE_CTES, GAPS),
    )
)
def gap_correlation(spark, sf):
    return rounded(ensemble.gap_correlation(ensemble.generalization_gap(candidates(spark, sf), B)))


@query(
    sql_round(
        """SELECT series, model, metric, value, "limit" FROM (
              SELECT series, model, 'val_rmse' AS metric, val_rmse AS value, 0.0095::DOUBLE AS "limit", val_rmse > 0.0095 AS breach FROM candidates
              UNION ALL SELECT series, model, 'val_r2', val_r2, 0.4::DOUBLE, val_r2 < 0.4 FROM candidates
              UNION ALL SELECT series, model, 'gap_pct', gap_over_train, 20.0::DOUBLE, gap_over_train > 20 FROM gaps
              UNION ALL SELECT series, model, 'drift_rmse', test_rmse, 0.01::DOUBLE, test_rmse > 0.01 FROM candidates
            ) m WHERE breach""",
        ("value",),
        (*CANDIDATE_CTES, GAPS),
    )
)
def threshold_alerts(spark, sf):
    """All four limits: validation error and R2, gap to the train error, error on the latest rows."""
    rows = candidates(spark, sf)
    gap = F.abs(F.col("train_rmse") - F.col("val_rmse")) / F.col("train_rmse") * 100.0
    named = rows.withColumn("gap_pct", gap).withColumnRenamed("test_rmse", "drift_rmse")
    return rounded(monitor.threshold_alerts(named))


# ---- registered for completeness: deduped candidates, stacked and blended entries -------


@query(
    sql_round(
        "SELECT series, model, val_rmse FROM candidates UNION ALL "
        "SELECT series, 'again', val_rmse FROM candidates WHERE model = 'vol_5'",
        ("val_rmse",),
        CANDIDATE_CTES,
    )
)
def candidate_dedupe(spark, sf):
    """Every candidate entered twice, first with a wrong error; one of another name once."""
    rows = store.stored(candidates(spark, sf).select("series", "model", "val_rmse"), "entries")
    first = rows.select("series", "model", (F.col("val_rmse") * 2).alias("val_rmse"), F.lit(1).alias("entry"))
    other = rows.where(F.col("model") == A).select("series", F.lit("again").alias("model"), "val_rmse", F.lit(1).alias("entry"))
    entries = store.union_layers([rows.withColumn("entry", F.lit(2)), first, other])
    return rounded(ensemble.dedupe_candidates(entries, ["series", "model"], "entry").select("series", "model", "val_rmse"))


COMBINED = """combined AS (
  SELECT s.*, b.weight AS blend_weight,
         k.intercept + k.weight_a * s.vol_5 + k.weight_b * s.half_vol_20 AS stacked,
         b.weight * s.vol_5 + (1 - b.weight) * s.half_vol_20 AS blended
  FROM split s
  JOIN (SELECT series, arg_min(weight, round(rmse, 12)) AS weight FROM (
          SELECT series, weight, sqrt(avg(power(rv_5d - weight * vol_5 - (1 - weight) * half_vol_20, 2))) AS rmse
          FROM split, (SELECT unnest(range(21)) / 20.0::DOUBLE AS weight) g WHERE split = 'val' GROUP BY series, weight) x
        GROUP BY series) b USING (series)
  JOIN (SELECT series, (c1y * s2 - c2y * c12) / (s1 * s2 - c12 * c12) AS weight_a,
               (c2y * s1 - c1y * c12) / (s1 * s2 - c12 * c12) AS weight_b,
               my - (c1y * s2 - c2y * c12) / (s1 * s2 - c12 * c12) * m1 - (c2y * s1 - c1y * c12) / (s1 * s2 - c12 * c12) * m2 AS intercept
        FROM (SELECT series, avg(vol_5) AS m1, avg(half_vol_20) AS m2, avg(rv_5d) AS my,
                     var_pop(vol_5) + 0.1 / count(*) AS s1, var_pop(half_vol_20) + 0.1 / count(*) AS s2,
                     covar_pop(vol_5, half_vol_20) AS c12, covar_pop(vol_5, rv_5d) AS c1y, covar_pop(half_vol_20, rv_5d) AS c2y
              FROM split WHERE split = 'val' GROUP BY series) m WHERE s1 * s2 - c12 * c12 <> 0) k USING (series)),
 entries AS (
  SELECT series, model, sqrt(avg(CASE WHEN split = 'val' THEN power(p - rv_5d, 2) END)) AS val_rmse,
         sqrt(avg(CASE WHEN split = 'test' THEN power(p - rv_5d, 2) END)) AS test_rmse
  FROM (SELECT series, split, rv_5d, unnest(['vol_5', 'half_vol_20', 'stacked', 'blended']) AS model,
               unnest([vol_5, half_vol_20, stacked, blended]) AS p FROM combined) l GROUP BY series, model)"""


@query(sql_round("SELECT * FROM entries", ("val_rmse", "test_rmse"), (*CANDIDATE_CTES, COMBINED)))
def combined_entries(spark, sf):
    """Errors of both models, their ridge stack and their best blend, both fitted on the val rows."""
    return rounded(combined(spark, sf))


def combined(spark, sf):
    rows = split.time_split(paired(spark, sf), keys=["series"], grain=LINE_GRAIN)
    rows = store.stored(rows.select("series", "bar", "split", "rv_5d", A, B), "split")
    val = rows.where("split = 'val'")
    stack = ensemble.stacking_weights(val, A, B).where("weight_a IS NOT NULL")
    grid = ensemble.blend_search(val, A, B).withColumn("rmse", F.round("rmse", 12))
    best = ensemble.best_blend(grid).select("series", F.col("weight").alias("blend_weight"))
    both = ensemble.apply_stack(rows, stack, A, B).join(best, "series")
    w = F.col("blend_weight")
    both = both.withColumn("blended", w * F.col(A) + (1 - w) * F.col(B))
    long = both.unpivot(["series", "split", "rv_5d"], [A, B, "stacked", "blended"], "model", "prediction")
    square = (F.col("prediction") - F.col("rv_5d")) ** 2
    at = lambda s: F.sqrt(F.avg(F.when(F.col("split") == s, square))).alias(f"{s}_rmse")
    return long.groupBy("series", "model").agg(at("val"), at("test"))


_ORDER = ("vol_5", "half_vol_20", "stacked", "blended")


def _sql_contest() -> str:
    """The winner rule over the four entries, one nested query for each challenger."""
    pick = ", ".join(
        f"max(CASE WHEN model = '{m}' THEN val_rmse END) AS v_{m}, max(CASE WHEN model = '{m}' THEN test_rmse END) AS t_{m}"
        for m in _ORDER
    )
    sql = f"SELECT *, 'vol_5' AS winner, v_vol_5 AS val_rmse, t_vol_5 AS test_rmse FROM (SELECT series, {pick} FROM entries GROUP BY series) e"
    for m in _ORDER[1:]:
        wins = (
            f"coalesce(CASE WHEN v_{m} < val_rmse THEN true WHEN abs(v_{m} - val_rmse) <= 1e-8 + 1e-5 * abs(val_rmse) "
            f"THEN t_{m} < test_rmse END, false)"
        )
        sql = (
            f"SELECT * EXCLUDE (wins) REPLACE (CASE WHEN wins THEN '{m}' ELSE winner END AS winner, "
            f"CASE WHEN wins THEN v_{m} ELSE val_rmse END AS val_rmse, "
            f"CASE WHEN wins THEN t_{m} ELSE test_rmse END AS test_rmse) FROM (SELECT *, {wins} AS wins FROM ({sql}) q) r"
        )
    return f"SELECT series, winner, val_rmse, test_rmse FROM ({sql}) z"


@query(sql_round(_sql_contest(), ("val_rmse", "test_rmse"), (*CANDIDATE_CTES, COMBINED)))
def best_of_all(spark, sf):
    """The best individual model, the ridge stack and the best blend against each other."""
    rows = combined(spark, sf)
    at = lambda m, f: F.max(F.when(F.col("model") == m, F.col(f"{f}_rmse"))).alias(f"{f}_{m}")
    entries = rows.groupBy("series").agg(*[at(m, f) for m in _ORDER for f in ("val", "test")])
    return rounded(ensemble.best_overall(entries, list(_ORDER)))


# ---- importance: absolute correlation of each feature with the label, per region --------

IMPORTANCE = (
    "placed AS (SELECT r.r_name AS model, m.* FROM supplier_master m "
    "JOIN supplier s ON m.series = s.s_suppkey JOIN nation n ON s.s_nationkey = n.n_nationkey "
    "JOIN region r ON n.n_regionkey = r.r_regionkey),\n importance AS ("
    + " UNION ALL ".join(
        f"SELECT model, '{c}' AS feature, covar_pop({c}, rv_5d) / "
        f"(stddev_pop(CASE WHEN rv_5d IS NOT NULL THEN {c} END) "
        f"* stddev_pop(CASE WHEN {c} IS NOT NULL THEN rv_5d END)) AS importance "
        "FROM placed GROUP BY model"
        for c in SERIES_FEATURES
    )
    + """),
 top AS (SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY model
           ORDER BY round(abs(importance), 8) DESC, feature) AS INTEGER) AS place FROM importance) i
         WHERE place <= 10)"""
)
IMPORTANCE_CTES = (*SUPPLIER_ALL, IMPORTANCE)


def importance(spark, sf):
    master = supplier_features(spark, sf, label=True)
    region = (
        table(spark, sf, "supplier")
        .join(table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(F.col("s_suppkey").alias("series"), F.col("r_name").alias("model"))
    )
    rows = master.join(region, "series")
    long = rows.unpivot(["model", "rv_5d"], list(SERIES_FEATURES), "feature", "x")
    return long.groupBy("model", "feature").agg(
        F.round(safe_corr(F.col("x"), F.col("rv_5d")), 8).alias("importance")
    )


def top(spark, sf):
    """Top lists; the importance table is small and read several times, so it is written."""
    return ensemble.top_features(store.stored(importance(spark, sf), "importance"))


@query(sql_round("SELECT * FROM top", ("importance",), IMPORTANCE_CTES))
def top_features(spark, sf):
    return rounded(top(spark, sf))


@query(
    "WITH "
    + ", ".join(IMPORTANCE_CTES)
    + """
  SELECT feature, count(*) AS models,
         count(*) = (SELECT count(DISTINCT model) FROM top) AS universal FROM top GROUP BY feature"""
)
def feature_consensus(spark, sf):
    return ensemble.feature_consensus(top(spark, sf))


@query(
    "WITH "
    + ", ".join(IMPORTANCE_CTES)
    + """
  SELECT a.model AS model_a, b.model AS model_b,
         count(CASE WHEN a.feature = b.feature THEN 1 END) AS shared
  FROM top a, top b GROUP BY 1, 2"""
)
def feature_overlap(spark, sf):
    return ensemble.feature_overlap(top(spark, sf))


@query(
    "WITH "
    + ", ".join(IMPORTANCE_CTES)
    + """
  SELECT feature FROM top WHERE model IN (SELECT r_name FROM region) GROUP BY feature
  HAVING count(DISTINCT model) = (SELECT count(DISTINCT model) FROM top)"""
)
def feature_intersection(spark, sf):
    """Features that the lists of all regions share."""
    lists = store.stored(top(spark, sf), "top")
    names = [r[0] for r in lists.select("model").distinct().collect()]  # the regions
    return ensemble.feature_intersection(lists, names)
