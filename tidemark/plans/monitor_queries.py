"""Evaluation and monitoring of the naive forecasts, per (series, model)."""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import functions as F

from tidemark.operators import monitor, profile
from tidemark.plans.common import (
    KNOWN,
    LINE_GRAIN,
    SCORED_ALL,
    forecasts,
    known,
    rounded,
    scored,
    scored_wide,
    sql_round,
    unpivoted,
)
from tidemark.sources import store

QUERIES, ORACLE = {}, {}
BENCHMARK_END = "1999-01-01"  # forecasts before this day form the benchmark


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLE[fn.__name__] = sql
        return fn

    return register


REL = "abs(CASE WHEN rv_5d <> 0 THEN (prediction - rv_5d) / rv_5d END)"
HIT = f"avg(CASE WHEN {REL} <= 0.2 THEN 1.0 WHEN {REL} > 0.2 THEN 0.0 END)"
RMSE = "sqrt(avg((prediction - rv_5d) * (prediction - rv_5d)))"
R2 = (
    "CASE WHEN var_pop(rv_5d) <> 0 THEN "
    "1 - avg((prediction - rv_5d) * (prediction - rv_5d)) / var_pop(rv_5d) END"
)
SQL_METRICS = f"{RMSE} AS rmse, avg(abs(prediction - rv_5d)) AS mae, {R2} AS r2"
SQL_FULL = f"{SQL_METRICS}, avg({REL}) * 100 AS mape, {HIT} AS hit_rate"
METRIC = ("rmse", "mae", "r2")
FULL = (*METRIC, "mape", "hit_rate")


def is_early():
    return F.col("bar") < F.lit(BENCHMARK_END).cast("timestamp_ntz")


def comparison(spark, sf):
    return monitor.compared(monitor.period_errors(known(spark, sf), is_early()))


COMPARISON = f"""comparison AS (
  SELECT *, production_rmse - test_rmse AS rmse_diff,
         CASE WHEN abs(rmse_diff_pct) < 10 THEN 'GOOD' WHEN abs(rmse_diff_pct) < 30
              THEN 'ACCEPTABLE' WHEN rmse_diff_pct IS NOT NULL THEN 'DEGRADED' END AS status
  FROM (SELECT series, model, b.test_rmse, p.production_rmse,
               (p.production_rmse - b.test_rmse) / b.test_rmse * 100 AS rmse_diff_pct
        FROM (SELECT series, model, {RMSE} AS test_rmse FROM known
              WHERE bar < TIMESTAMP '{BENCHMARK_END}' GROUP BY ALL) b
        JOIN (SELECT series, model, {RMSE} AS production_rmse FROM known
              WHERE bar >= TIMESTAMP '{BENCHMARK_END}' GROUP BY ALL) p
        USING (series, model)) c)"""

REGIME = """CASE WHEN {v} < 0.015 THEN 'LOW' WHEN {v} < 0.03 THEN 'NORMAL'
            WHEN {v} < 0.05 THEN 'ELEVATED' WHEN {v} IS NOT NULL THEN 'HIGH' END"""

TREND = """trend AS (
  SELECT series, model, last_bar, volatility,
         CASE WHEN n < 10 THEN 'UNKNOWN' WHEN early = 0 THEN 'STABLE'
              WHEN (late - early) / early * 100 > 10 THEN 'INCREASING'
              WHEN (late - early) / early * 100 < -10 THEN 'DECREASING' ELSE 'STABLE' END AS trend,
         CASE WHEN n < 10 OR early = 0 THEN 0.0 ELSE (late - early) / early * 100 END
           AS trend_change_pct
  FROM (SELECT series, model, max(bar) AS last_bar, arg_max(prediction, bar) AS volatility,
               count(*) AS n, avg(CASE WHEN rn <= 5 THEN prediction END) AS late,
               avg(CASE WHEN rn > 5 THEN prediction END) AS early
        FROM (SELECT *, row_number() OVER (PARTITION BY series, model ORDER BY bar DESC) AS rn
              FROM scored) r
        WHERE rn <= 10 GROUP BY ALL) t)"""
PERCENTILE = """percentile AS (
  SELECT k.series, k.model, max(t.volatility) AS volatility,
         avg(CASE WHEN k.rv_5d < t.volatility THEN 1.0 ELSE 0.0 END) * 100 AS percentile
  FROM known k JOIN (SELECT series, model, arg_max(prediction, bar) AS volatility
                     FROM scored GROUP BY ALL) t
    ON k.series = t.series AND k.model = t.model
  GROUP BY ALL)"""
CURRENT = f"""current AS (
  SELECT t.*, {REGIME.format(v="t.volatility")} AS regime, p.percentile
  FROM trend t LEFT JOIN percentile p ON t.series = p.series AND t.model = p.model)"""


@query(
    sql_round(
        "SELECT series, bar, model, prediction, rv_5d FROM scored",
        ("prediction", "rv_5d"),
        SCORED_ALL,
    )
)
def pred_vs_actual(spark, sf):
    wide = store.stored(scored_wide(spark, sf), "forecasts")
    made = unpivoted(wide).select("series", "bar", "model", "prediction")
    return rounded(monitor.attach_actuals(made, wide.select("series", "bar", "rv_5d")))


@query(
    sql_round(
        "SELECT model, count(rv_5d) AS with_actual, count(*) - count(rv_5d) AS without_actual, "
        "sum(CASE WHEN rv_5d IS NULL THEN prediction END) AS open_sum FROM scored GROUP BY model",
        ("open_sum",),
        SCORED_ALL,
    )
)
def actuals_split(spark, sf):
    waits = F.col("rv_5d").isNull()
    out = scored(spark, sf).groupBy("model").agg(
        F.count("rv_5d").alias("with_actual"), F.count_if(waits).alias("without_actual"),
        F.sum(F.when(waits, F.col("prediction"))).alias("open_sum"),
    )
    return rounded(out)


@query(
    sql_round(
        f"SELECT series, model, count(*) AS n, {SQL_METRICS} FROM known GROUP BY ALL",
        METRIC,
        SCORED_ALL,
    )
)
def regression_metrics(spark, sf):
    return rounded(monitor.regression_metrics(known(spark, sf)))


@query(
    sql_round(
        f"SELECT series, model, count(*) AS n, {SQL_FULL}, "
        "count(CASE WHEN rv_5d = 0 THEN 1 END) AS zero_actuals FROM known GROUP BY ALL",
        FULL,
        SCORED_ALL,
    )
)
def forecast_metrics(spark, sf):
    return rounded(monitor.forecast_metrics(known(spark, sf)))


@query(
    sql_round(
        f"SELECT series, model, count(*) AS n, {SQL_FULL}, "
        "count(CASE WHEN rv_5d = 0 THEN 1 END) AS zero_actuals FROM "
        "(SELECT *, row_number() OVER (PARTITION BY series, model ORDER BY bar DESC) AS rn "
        "FROM known) r WHERE rn <= 30 GROUP BY series, model",
        FULL,
        SCORED_ALL,
    )
)
def recent_metrics(spark, sf):
    return rounded(monitor.recent_metrics(known(spark, sf)))


@query(
    sql_round(
        f"""SELECT series, model, bar AS end_bar, n AS window_size, sqrt(mse) AS rmse, mae,
                  CASE WHEN vary <> 0 THEN 1 - mse / vary END AS r2, rel * 100 AS mape, hit AS hit_rate
           FROM (SELECT series, model, bar, count(*) OVER w AS n,
                   avg((prediction - rv_5d) * (prediction - rv_5d)) OVER w AS mse,
                   avg(abs(prediction - rv_5d)) OVER w AS mae, var_pop(rv_5d) OVER w AS vary,
                   avg({REL}) OVER w AS rel,
                   avg(CASE WHEN {REL} <= 0.2 THEN 1.0 WHEN {REL} > 0.2 THEN 0.0 END) OVER w AS hit
                 FROM known
                 WINDOW w AS (PARTITION BY series, model ORDER BY bar
                              ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)) r
           WHERE n = 30""",
        FULL,
        SCORED_ALL,
    )
)
def rolling_metrics(spark, sf):
    return rounded(monitor.rolling_metrics(known(spark, sf), grain=LINE_GRAIN))


@query(sql_round("SELECT * FROM trend", ("volatility", "trend_change_pct"), (*SCORED_ALL, TREND)))
def trend(spark, sf):
    return rounded(monitor.trend(scored(spark, sf)))


@query(
    sql_round("SELECT * FROM percentile", ("volatility", "percentile"), (*SCORED_ALL, PERCENTILE))
)
def forecast_percentile(spark, sf):
    return rounded(monitor.forecast_percentile(store.stored(scored(spark, sf), "scored")))


@query(
    sql_round(
        f"SELECT series, bar, model, {REGIME.format(v='prediction')} AS regime FROM scored",
        (),
        SCORED_ALL,
    )
)
def regime(spark, sf):
    from tidemark.functions.scalars import regime as level

    rows = forecasts(spark, sf)
    return rows.select("series", "bar", "model", level(F.col("prediction")).alias("regime"))


@query(
    sql_round(
        "SELECT * FROM comparison",
        ("test_rmse", "production_rmse", "rmse_diff", "rmse_diff_pct"),
        (*SCORED_ALL, COMPARISON),
    )
)
def benchmark_status(spark, sf):
    return rounded(comparison(spark, sf))


@query(
    sql_round(
        "SELECT *, CASE WHEN volatility IS NOT NULL THEN printf('%.2f percent', volatility * 100) END AS volatility_pct, "
        "'MEDIUM' AS confidence FROM current",
        ("volatility", "trend_change_pct", "percentile"),
        (*SCORED_ALL, TREND, PERCENTILE, CURRENT),
    )
)
def current_forecast(spark, sf):
    return rounded(monitor.current_forecast(store.stored(scored(spark, sf), "scored")))


@query(
    "WITH "
    + ", ".join((*SCORED_ALL, TREND, PERCENTILE, CURRENT, COMPARISON))
    + f"""
  , joined AS (SELECT c.*, b.status, b.test_rmse, b.production_rmse, b.rmse_diff_pct
               FROM current c LEFT JOIN comparison b USING (series, model))
  SELECT series, model, 'TREND' AS type, 'WARNING' AS severity, '{monitor.TREND_UP_TEXT}' AS message FROM joined
   WHERE trend = 'INCREASING' AND abs(trend_change_pct) > 15
  UNION ALL SELECT series, model, 'TREND', 'INFO', '{monitor.TREND_DOWN_TEXT}' FROM joined
   WHERE trend = 'DECREASING' AND abs(trend_change_pct) > 15
  UNION ALL SELECT series, model, 'REGIME', 'ALERT', '{monitor.HIGH_TEXT}' FROM joined WHERE regime = 'HIGH'
  UNION ALL SELECT series, model, 'REGIME', 'INFO', '{monitor.LOW_TEXT}' FROM joined
   WHERE regime = 'LOW' AND percentile < 10
  UNION ALL SELECT series, model, 'RMSE', 'ALERT', printf('{monitor.RMSE_DEGRADED_FORMAT}', test_rmse, production_rmse, rmse_diff_pct)
    FROM joined WHERE status = 'DEGRADED'
  UNION ALL SELECT series, model, 'RMSE', 'WARNING', printf('{monitor.RMSE_ACCEPTABLE_FORMAT}', test_rmse, production_rmse, rmse_diff_pct)
    FROM joined WHERE status = 'ACCEPTABLE'"""
)
def insights(spark, sf):
    table = store.stored(scored(spark, sf), "scored")
    known_rows = table.where(F.col("rv_5d").isNotNull())
    against = monitor.compared(monitor.period_errors(known_rows, is_early()))
    return monitor.insights(monitor.current_forecast(table), against)


@query(
    sql_round(
        """SELECT series, model, bar, rv_5d AS actual, prediction, prediction - rv_5d AS error,
                  CASE WHEN rv_5d <> 0 THEN (prediction - rv_5d) / rv_5d * 100 END AS error_pct
           FROM (SELECT *, row_number() OVER (PARTITION BY series, model ORDER BY bar DESC) AS rn
                 FROM known) r WHERE rn <= 30""",
        ("actual", "prediction", "error", "error_pct"),
        SCORED_ALL,
    )
)
def error_table(spark, sf):
    return rounded(monitor.error_table(known(spark, sf)))


DOCUMENT = (
    "metadata struct<total_predictions: bigint, predictions_with_actuals: bigint>, "
    "current_forecast struct<regime: string, trend: string, percentile: double>, "
    "latest_predictions array<struct<prediction: double>>, "
    "predictions_vs_actuals array<struct<error: double>>, "
    "performance struct<overall: struct<rmse: double>, rolling_30d: array<struct<rmse: double>>, "
    "benchmark_comparison: struct<status: string>>"
)


@query(
    sql_round(
        f"""SELECT o.* EXCLUDE (recent), CASE WHEN o.recent >= 30 THEN o.recent - 29 ELSE 0 END AS windows
           FROM (SELECT r.series, r.model, count(*) AS total_predictions,
                        count(rv_5d) AS predictions_with_actuals, {RMSE} AS rmse,
                        least(count(rv_5d), 30) AS errors,
                        count(*) FILTER (rn <= 35 AND rv_5d IS NULL) AS waiting, max(t.trend) AS trend,
                        max({REGIME.format(v='t.volatility')}) AS regime, max(b.test_rmse) AS test,
                        max(d.trained) AS trained, count(rv_5d) FILTER (rn <= 35) AS recent
                 FROM (SELECT *, row_number() OVER (PARTITION BY series, model
                              ORDER BY bar DESC) AS rn FROM scored) r
                 JOIN trend t ON r.series = t.series AND r.model = t.model
                 LEFT JOIN comparison b ON r.series = b.series AND r.model = b.model
                 LEFT JOIN (SELECT series, model, strftime(max(bar), '%Y-%m-%d') AS trained FROM known
                            WHERE bar < TIMESTAMP '{BENCHMARK_END}' GROUP BY ALL) d
                   ON r.series = d.series AND r.model = d.model
                 GROUP BY r.series, r.model) o""",
        ("rmse", "test"),
        (*SCORED_ALL, TREND, COMPARISON),
    )
)
def monitor_document(spark, sf):
    """The monitor document per group, read back from its JSON text."""
    table = store.stored(scored(spark, sf), "scored")
    early = table.where(F.col("rv_5d").isNotNull() & is_early())
    bench = early.groupBy("series", "model").agg(
        monitor.metric_aggregates()[0].alias("test_rmse"), F.max(F.to_date("bar")).alias("trained_date")
    )
    docs = monitor.monitor_documents(table, bench)
    d = docs.select("series", "model", F.from_json("monitor", DOCUMENT).alias("d"), "alerts")
    size = lambda c: F.coalesce(F.size(c), F.lit(0)).cast("long")
    return rounded(
        d.select(
            "series",
            "model",
            "d.metadata.total_predictions",
            "d.metadata.predictions_with_actuals",
            F.col("d.performance.overall.rmse").alias("rmse"),
            size(F.col("d.predictions_vs_actuals")).alias("errors"),
            size(F.col("d.latest_predictions")).alias("waiting"),
            F.col("d.current_forecast.trend").alias("trend"),
            F.col("d.current_forecast.regime").alias("regime"),
            F.get_json_object("alerts", "$.benchmark_comparison.test_rmse")
            .cast("double")
            .alias("test"),
            F.get_json_object("alerts", "$.benchmark_comparison.trained_date").alias("trained"),
            size(F.col("d.performance.rolling_30d")).alias("windows"),
        )
    )


RUNS = f"""runs AS (
  SELECT series || ' ' || model AS experiment, strftime(date_trunc('year', bar), '%Y') AS run_id,
         {RMSE} AS rmse, avg(abs(prediction - rv_5d)) AS mae
  FROM known GROUP BY 1, 2)"""


def runs(spark, sf):
    """One run per series, model and year with its metrics as a map."""
    rows = known(spark, sf)
    per_year = monitor.regression_metrics(
        rows.select(
            F.concat_ws(" ", F.col("series").cast("string"), "model").alias("experiment"),
            F.year("bar").cast("string").alias("run_id"),
            "rv_5d",
            "prediction",
        ),
        ["experiment", "run_id"],
    )
    return per_year.select(
        "experiment",
        "run_id",
        F.create_map(F.lit("rmse"), "rmse", F.lit("mae"), "mae").alias("metrics"),
    )


@query(
    sql_round(
        """SELECT experiment, metric, previous_run, latest_run, previous, latest,
                  latest - previous AS diff,
                  CASE WHEN previous <> 0 THEN (latest - previous) / previous * 100 ELSE 0 END
                    AS pct_change
           FROM (SELECT experiment, metric, max(CASE WHEN rn = 2 THEN run_id END) AS previous_run,
                        max(CASE WHEN rn = 1 THEN run_id END) AS latest_run,
                        max(CASE WHEN rn = 2 THEN value END) AS previous,
                        max(CASE WHEN rn = 1 THEN value END) AS latest
                 FROM (SELECT experiment, run_id, 'rmse' AS metric, rmse AS value, rn FROM ranked
                       UNION ALL SELECT experiment, run_id, 'mae', mae, rn FROM ranked) l
                 WHERE rn <= 2 GROUP BY ALL) b
           WHERE previous_run IS NOT NULL""",
        ("previous", "latest", "diff", "pct_change"),
        (
            *SCORED_ALL,
            RUNS,
            "ranked AS (SELECT *, row_number() OVER (PARTITION BY experiment "
            "ORDER BY run_id DESC) AS rn FROM runs)",
        ),
    )
)
def compare_runs(spark, sf):
    return rounded(monitor.compare_runs(runs(spark, sf)))


@query(
    sql_round(
        """SELECT series, model, avg(e) AS mean, stddev_pop(e) AS std, min(e) AS min,
                  max(e) AS max, median(e) AS median
           FROM (SELECT series, model, rv_5d - prediction AS e FROM known) r GROUP BY ALL""",
        ("mean", "std", "min", "max", "median"),
        SCORED_ALL,
    )
)
def residual_stats(spark, sf):
    table = store.stored(known(spark, sf), "scored")
    return rounded(profile.residual_stats(table, ["series", "model"]))


_PROBS = tuple(i / 10 for i in range(1, 10))


@query(
    sql_round(
        " UNION ALL ".join(
            f"SELECT model, {p}::DOUBLE AS prob, {NormalDist().inv_cdf(p)!r}::DOUBLE AS normal, "
            f"quantile_cont(rv_5d - prediction, {p}) AS residual FROM known GROUP BY model"
            for p in _PROBS
        ),
        ("normal", "residual"),
        SCORED_ALL,
    )
)
def residual_quantiles(spark, sf):
    table = store.stored(known(spark, sf), "scored")
    return rounded(profile.residual_quantiles(table, ["model"]))


@query(
    sql_round(
        """SELECT *, abs(skewness) < 0.5 AND abs(kurtosis) < 3 AS near_normal FROM (
             SELECT series, model,
                    (m3 - 3 * m * m2 + 2 * m * m * m) / power(v, 1.5) AS skewness,
                    (m4 - 4 * m * m3 + 6 * m * m * m2 - 3 * m * m * m * m) / (v * v) - 3 AS kurtosis
             FROM (SELECT series, model, avg(e) AS m, avg(e * e) AS m2, avg(e * e * e) AS m3,
                          avg(e * e * e * e) AS m4, var_pop(e) AS v
                   FROM (SELECT series, model, rv_5d - prediction AS e FROM known) r
                   GROUP BY ALL) s) t""",
        ("skewness", "kurtosis"),
        SCORED_ALL,
    )
)
def residual_shape(spark, sf):
    return rounded(profile.residual_shape(known(spark, sf), ["series", "model"]))
