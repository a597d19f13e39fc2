"""Comparing and combining models: alignment, blending, stacking, ranking, selection rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalars import percent_change, ratio
from tidemark.operators.bars import dedupe_last
from tidemark.operators.frames import attach_group_value, last_rows
from tidemark.operators.profile import safe_corr

# Fixed values of the selection and drift rules.
BLEND_STEPS = 20
STACK_ALPHA = 0.1
ALPHA_GRID = (0.001, 0.01, 0.1, 1.0, 10.0)
TIE_PCT = 0.5
ISCLOSE_ABS, ISCLOSE_REL = 1e-8, 1e-5
COMPARE_WINDOWS = (30, 10, 1)
DRIFT_RETRAIN, DRIFT_PLAN = 20, 10
TOP_FEATURES = 10


def is_close(a: Column, b: Column) -> Column:
    return F.abs(a - b) <= ISCLOSE_ABS + ISCLOSE_REL * F.abs(b)


def aligned_predictions(
    a: DataFrame, b: DataFrame, on: Sequence[str], y: str = "rv_5d", p: str = "prediction"
) -> DataFrame:
    """Full outer join of two models' rows with a ``status`` naming any misalignment."""
    left = a.select(*on, F.col(y).alias("y_a"), F.col(p).alias("pred_a"), F.lit(1).alias("_a"))
    right = b.select(*on, F.col(y).alias("y_b"), F.col(p).alias("pred_b"), F.lit(1).alias("_b"))
    status = (
        F.when(F.col("_a").isNull(), "only_b")
        .when(F.col("_b").isNull(), "only_a")
        .when(is_close(F.col("y_a"), F.col("y_b")), "aligned")
        .otherwise("label_mismatch")
    )
    return left.join(right, list(on), "full").withColumn("status", status).drop("_a", "_b")


def prediction_diff(wide: DataFrame, a: str, b: str, by: Sequence[str] = ("series",)) -> DataFrame:
    gap = F.abs(F.col(a) - F.col(b))
    return wide.groupBy(*by).agg(
        F.count(gap).alias("n"),
        F.avg(gap).alias("mean_diff"),
        F.stddev_pop(gap).alias("std_diff"),
        F.max(gap).alias("max_diff"),
        safe_corr(F.col(a), F.col(b)).alias("corr"),
    )


def blend_search(
    wide: DataFrame,
    a: str,
    b: str,
    *,
    y: str = "rv_5d",
    by: Sequence[str] = ("series",),
    steps: int = BLEND_STEPS,
) -> DataFrame:
    """RMSE of ``w * a + (1 - w) * b`` for each weight on an even grid over 0..1.

    The squared error is a quadratic in ``w``; three sums per group give the whole
    grid, so rows are never multiplied by the number of weights.
    """
    err, gap = F.col(y) - F.col(b), F.col(a) - F.col(b)
    sums = wide.groupBy(*by).agg(
        F.avg(err * err).alias("_ee"), F.avg(err * gap).alias("_eg"), F.avg(gap * gap).alias("_gg")
    )
    weights = F.array(*[F.lit(i / steps) for i in range(steps + 1)])
    w = F.col("weight")
    mse = F.col("_ee") - 2.0 * w * F.col("_eg") + w * w * F.col("_gg")
    return sums.withColumn("weight", F.explode(weights)).select(
        *by, "weight", F.sqrt(F.greatest(mse, F.lit(0.0))).alias("rmse")
    )


def best_blend(grid: DataFrame, by: Sequence[str] = ("series",)) -> DataFrame:
    """First weight of the smallest RMSE."""
    best = grid.groupBy(*by).agg(F.min(F.struct("rmse", "weight")).alias("_best"))
    return best.select(*by, F.col("_best.weight").alias("weight"), F.col("_best.rmse").alias("rmse"))


def stacking_weights(
    wide: DataFrame,
    a: str,
    b: str,
    *,
    y: str = "rv_5d",
    by: Sequence[str] = ("series",),
    alphas: Sequence[float] = (STACK_ALPHA,),
) -> DataFrame:
    """Ridge on two base predictions from centred moments, for each penalty.

    The normal equations of two features have a closed form, so a group needs one
    aggregate. ``rmse`` is the error on the rows the weights were fitted on.
    """
    x1, x2, t = F.col(a), F.col(b), F.col(y)
    m = wide.groupBy(*by).agg(
        F.count(t).cast("double").alias("_n"),
        F.avg(x1).alias("_m1"),
        F.avg(x2).alias("_m2"),
        F.avg(t).alias("_my"),
        F.var_pop(x1).alias("_v1"),
        F.var_pop(x2).alias("_v2"),
        F.var_pop(t).alias("_vy"),
        F.covar_pop(x1, x2).alias("_c12"),
        F.covar_pop(x1, t).alias("_c1y"),
        F.covar_pop(x2, t).alias("_c2y"),
    )
    c = F.col
    grid = m.withColumn("alpha", F.explode(F.array(*[F.lit(float(v)) for v in alphas])))
    penalty = c("alpha") / c("_n")
    s1, s2 = c("_v1") + penalty, c("_v2") + penalty
    det = s1 * s2 - c("_c12") * c("_c12")
    w1 = F.try_divide(c("_c1y") * s2 - c("_c2y") * c("_c12"), det)
    w2 = F.try_divide(c("_c2y") * s1 - c("_c1y") * c("_c12"), det)
    grid = grid.withColumns({"weight_a": w1, "weight_b": w2})
    wa, wb = c("weight_a"), c("weight_b")
    mse = (
        c("_vy")
        - 2.0 * (wa * c("_c1y") + wb * c("_c2y"))
        + wa * wa * c("_v1")
        + wb * wb * c("_v2")
        + 2.0 * wa * wb * c("_c12")
    )
    total = wa + wb
    return grid.select(
        *by,
        "alpha",
        "weight_a",
        "weight_b",
        (c("_my") - wa * c("_m1") - wb * c("_m2")).alias("intercept"),
        F.when(total > 0, wa / total).alias("share_a"),
        F.when(total > 0, wb / total).alias("share_b"),
        F.sqrt(F.greatest(mse, F.lit(0.0))).alias("rmse"),
    )


def apply_stack(
    wide: DataFrame, weights: DataFrame, a: str, b: str, by: Sequence[str] = ("series",)
) -> DataFrame:
    w = weights.select(*by, "weight_a", "weight_b", "intercept")
    rows = attach_group_value(wide, w, by, a)
    stacked = F.col("intercept") + F.col("weight_a") * F.col(a) + F.col("weight_b") * F.col(b)
    return rows.withColumn("stacked", stacked).drop("weight_a", "weight_b", "intercept")


def ab_windows(
    wide: DataFrame,
    a: str,
    b: str,
    *,
    y: str = "rv_5d",
    by: Sequence[str] = ("series",),
    order: str = "bar",
    windows: Sequence[int] = COMPARE_WINDOWS,
) -> DataFrame:
    """Errors of two models over all rows and over the latest 30, 10 and 1 rows.

    B wins a window only with a strictly lower RMSE. The short windows are served
    by the latest rows alone.
    """
    t = F.col(y)
    sq = lambda p: (F.col(p) - t) * (F.col(p) - t)
    stats = [
        F.count(F.lit(1)).alias("samples"),
        F.min(order).alias("start"),
        F.max(order).alias("end"),
        F.sqrt(F.avg(sq(a))).alias("rmse_a"),
        F.avg(F.abs(F.col(a) - t)).alias("mae_a"),
        F.sqrt(F.avg(sq(b))).alias("rmse_b"),
        F.avg(F.abs(F.col(b) - t)).alias("mae_b"),
    ]
    overall = wide.groupBy(*by).agg(*stats).withColumn("window", F.lit("full"))
    recent = last_rows(wide, by, order, max(windows))
    member = F.array_compact(
        F.array(*[F.when(F.col("recency") <= n, F.lit(f"last_{n}")) for n in windows])
    )
    short = recent.withColumn("window", F.explode(member)).groupBy(*by, "window").agg(*stats)
    both = overall.unionByName(short)
    b_wins = F.col("rmse_b") < F.col("rmse_a")
    gain = F.when(b_wins, percent_change(F.col("rmse_b"), F.col("rmse_a"))).otherwise(
        percent_change(F.col("rmse_a"), F.col("rmse_b"))
    )
    return both.select(
        *by,
        "window",
        *[c for c in both.columns if c not in (*by, "window")],
        F.when(b_wins, "B").otherwise("A").alias("winner"),
        F.abs(gain).alias("improvement_pct"),
    )


def win_rate(windows: DataFrame, by: Sequence[str] = ("series",)) -> DataFrame:
    wins = windows.groupBy(*by, "winner").agg(F.count(F.lit(1)).alias("wins"))
    total = Window.partitionBy(*by)
    share = ratio(F.col("wins").cast("double"), F.sum("wins").over(total)) * 100.0
    return wins.withColumn("win_rate", share)


def drift_decision(windows: DataFrame, by: Sequence[str] = ("series",)) -> DataFrame:
    """Drift of model A on the latest 30 rows against all rows, and the model to use."""
    at = lambda w: F.max(F.when(F.col("window") == w, F.col("rmse_a")))
    facts = windows.groupBy(*by).agg(
        percent_change(at("last_30"), at("full")).alias("drift_pct"),
        (F.avg((F.col("winner") == "B").cast("double")) * 100.0).alias("b_win_rate"),
    )
    drift, rate = F.col("drift_pct"), F.col("b_win_rate")
    return facts.select(
        *by,
        "drift_pct",
        "b_win_rate",
        F.when(drift > DRIFT_RETRAIN, "RETRAIN")
        .when(drift > DRIFT_PLAN, "PLAN_RETRAIN")
        .otherwise("OK")
        .alias("recommendation"),
        F.when((rate >= 75) & (drift < DRIFT_PLAN), "B")
        .when(rate >= 50, "B (with caution)")
        .otherwise("A")
        .alias("selected_model"),
    )


def model_rank(
    candidates: DataFrame, by: Sequence[str] = ("series",), *, metric: str = "val_rmse"
) -> DataFrame:
    """Rank 1 = smallest metric; the model name settles ties."""
    w = Window.partitionBy(*by).orderBy(metric, "model")
    return candidates.withColumn("rank", F.row_number().over(w).cast("long"))


def dedupe_candidates(candidates: DataFrame, keys: Sequence[str], seq: str) -> DataFrame:
    """The entry added last for each candidate name."""
    return dedupe_last(candidates, keys, [seq])


def top_models(candidates: DataFrame, n: int = 2, by: Sequence[str] = ("series",)) -> DataFrame:
    """The ``n`` best by validation error, then test error (unknown last), then name."""
    w = Window.partitionBy(*by).orderBy(
        F.col("val_rmse").asc(), F.col("test_rmse").asc_nulls_last(), F.col("model").asc()
    )
    return candidates.withColumn("place", F.row_number().over(w)).where(F.col("place") <= n)


def select_model(
    candidates: DataFrame, a: str, b: str, by: Sequence[str] = ("series",)
) -> DataFrame:
    """Lower RMSE wins; within half a percent the higher R2 wins (B on a full tie)."""
    at = lambda model, field: F.max(F.when(F.col("model") == model, F.col(field)))
    pair = candidates.groupBy(*by).agg(
        at(a, "val_rmse").alias("rmse_a"),
        at(b, "val_rmse").alias("rmse_b"),
        at(a, "val_r2").alias("r2_a"),
        at(b, "val_r2").alias("r2_b"),
    )
    diff_pct = ratio(F.abs(F.col("rmse_a") - F.col("rmse_b")), F.least("rmse_a", "rmse_b")) * 100.0
    a_wins = F.when(diff_pct < TIE_PCT, F.col("r2_a") > F.col("r2_b")).otherwise(
        F.col("rmse_a") < F.col("rmse_b")
    )
    return pair.where(F.col("rmse_a").isNotNull() & F.col("rmse_b").isNotNull()).select(
        *by,
        "rmse_a",
        "rmse_b",
        diff_pct.alias("diff_pct"),
        F.when(a_wins, a).otherwise(b).alias("selected"),
    )


def best_overall(
    entries: DataFrame, names: Sequence[str], by: Sequence[str] = ("series",)
) -> DataFrame:
    """Winner among named entries (columns ``val_<name>``, ``test_<name>``), in the given order.

    A later entry replaces the current best with a lower validation error, or with
    a lower test error when the validation errors are close.
    """
    name, val, test = F.lit(names[0]), F.col(f"val_{names[0]}"), F.col(f"test_{names[0]}")
    for other in names[1:]:
        v, t = F.col(f"val_{other}"), F.col(f"test_{other}")
        wins = F.when(v < val, True).when(is_close(v, val), t < test)
        wins = F.coalesce(wins, F.lit(False))
        name, val, test = (
            F.when(wins, F.lit(other)).otherwise(name),
            F.when(wins, v).otherwise(val),
            F.when(wins, t).otherwise(test),
        )
    return entries.select(
        *by, name.alias("winner"), val.alias("val_rmse"), test.alias("test_rmse")
    )


def generalization_gap(candidates: DataFrame, baseline: str, by: Sequence[str] = ("series",)):
    """Gap between train and validation error, overfit classes, improvement over a baseline."""
    train, val = F.col("train_rmse"), F.col("val_rmse")
    base = candidates.where(F.col("model") == baseline).select(
        *by, F.col("val_rmse").alias("baseline_rmse")
    )
    gap_pct = ratio(F.abs(train - val), train) * 100.0
    return candidates.join(base, list(by), "left").select(
        *by,
        "model",
        "train_rmse",
        "val_rmse",
        (train - val).alias("gap"),
        gap_pct.alias("gap_over_train"),
        (ratio(train - val, val) * 100.0).alias("gap_over_val"),
        F.when(gap_pct < 5, "good").when(gap_pct < 10, "slight").otherwise("overfit").alias(
            "gap_class"
        ),
        F.when(val < train * 1.1, "good")
        .when(val < train * 1.2, "slight")
        .otherwise("overfit")
        .alias("ratio_class"),
        (ratio(F.col("baseline_rmse") - val, F.col("baseline_rmse")) * 100.0).alias(
            "improvement_pct"
        ),
    )


def gap_correlation(gaps: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    return gaps.groupBy(*by).agg(
        safe_corr(F.col("val_rmse"), F.col("gap_over_val")).alias("gap_rmse_corr")
    )


# ---- feature importance tables: (model, feature, importance) ---------------------


def top_features(
    importance: DataFrame, k: int = TOP_FEATURES, by: Sequence[str] = ("model",)
) -> DataFrame:
    """The ``k`` features of largest absolute importance per model."""
    w = Window.partitionBy(*by).orderBy(F.abs("importance").desc(), F.col("feature"))
    ranked = importance.where(F.col("importance").isNotNull())
    return ranked.withColumn("place", F.row_number().over(w)).where(F.col("place") <= k)


def feature_consensus(top: DataFrame) -> DataFrame:
    """Number of models that list a feature; ``universal`` when all of them do."""
    models = top.select(F.count_distinct("model")).scalar()
    counts = top.groupBy("feature").agg(F.count(F.lit(1)).alias("models"))
    return counts.withColumn("universal", F.col("models") == models)


def feature_overlap(top: DataFrame) -> DataFrame:
    """Shared features for every ordered pair of models, zero included."""
    models = F.array_sort(F.collect_set("model"))
    lists = top.groupBy("feature").agg(models.alias("_models"))
    shared = (
        lists.select(F.explode("_models").alias("model_a"), "_models")
        .select("model_a", F.explode("_models").alias("model_b"))
        .groupBy("model_a", "model_b")
        .agg(F.count(F.lit(1)).alias("shared"))
    )
    every = top.select(F.col("model").alias("model_a")).distinct()
    others = top.select(F.collect_set("model")).scalar()
    pairs = every.withColumn("model_b", F.explode(others))
    return pairs.join(shared, ["model_a", "model_b"], "left").select(
        "model_a", "model_b", F.coalesce("shared", F.lit(0).cast("long")).alias("shared")
    )


def feature_intersection(top: DataFrame, models: Sequence[str]) -> DataFrame:
    """Features listed by every one of the named models."""
    listed = top.where(F.col("model").isin(list(models)))
    counts = listed.groupBy("feature").agg(F.count_distinct("model").alias("_models"))
    return counts.where(F.col("_models") == len(set(models))).select("feature")
