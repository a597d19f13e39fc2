"""Profiles of bar and feature tables: coverage, distributions, correlations, histograms."""

from __future__ import annotations

from collections.abc import Sequence
from statistics import NormalDist

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalars import ratio
from tidemark.operators.frames import Slot, attach_group_value, number_rows, running_sum
from tidemark.sources.store import stored


def coverage(bars: DataFrame, by: Sequence[str] = ("series",), order: str = "bar") -> DataFrame:
    return bars.groupBy(*by).agg(
        F.min(order).alias("first_bar"),
        F.max(order).alias("last_bar"),
        F.count(F.lit(1)).alias("bars"),
        F.count_distinct(order).alias("days"),
    )


def _long(df: DataFrame, columns: Sequence[str], keys: Sequence[str]) -> DataFrame:
    return df.select(*keys, *[F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        list(keys), list(columns), "column", "value"
    )


def missing_report(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Null count and percentage per column, from one aggregate over the table."""
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns]
    )
    long = counts.unpivot(["_rows"], list(columns), "column", "missing")
    return long.select(
        "column", "missing", (F.try_divide("missing", "_rows") * 100.0).alias("missing_pct")
    )


def return_stats(
    bars: DataFrame, by: Sequence[str] = ("series",), value: str = "ret"
) -> DataFrame:
    v = F.col(value)
    return bars.groupBy(*by).agg(
        F.count(v).alias("n"),
        F.avg(v).alias("mean"),
        F.stddev_samp(v).alias("std"),
        F.min(v).alias("min"),
        F.max(v).alias("max"),
    )


def return_moments(
    bars: DataFrame, by: Sequence[str] = ("series",), value: str = "ret"
) -> DataFrame:
    """Corrected moments; null (not an error) for a constant group."""
    spread = bars.groupBy(*by).agg(
        F.count(value).alias("n"), F.skewness(value).alias("_g1"), F.kurtosis(value).alias("_g2")
    )
    n, g1, g2 = F.col("n").cast("double"), F.col("_g1"), F.col("_g2")
    return spread.select(
        *by,
        "n",
        F.when(n > 2, g1 * F.sqrt(n * (n - 1)) / (n - 2)).alias("skewness"),
        F.when(n > 3, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * g2 + 6)).alias("kurtosis"),
    )


def term_structure_share(
    wide: DataFrame, value: str = "vix_term", threshold: float = 1.0
) -> DataFrame:
    """Share of rows above and below the threshold (contango, backwardation) and the mean."""
    v = F.col(value)
    return wide.where(v.isNotNull()).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg((v > threshold).cast("double")).alias("share_above"),
        F.avg((v < threshold).cast("double")).alias("share_below"),
        F.avg(v).alias("mean_ratio"),
    )


def pair_returns(
    bars: DataFrame, a: str, b: str, *, series: str = "series", order: str = "bar"
) -> DataFrame:
    """Returns of two series on the bars both have."""
    one = lambda s: bars.where(F.col(series) == s).select(order, F.col("ret").alias(f"ret_{s}"))
    return one(a).join(one(b), order)


def safe_corr(a: Column, b: Column) -> Column:
    """Aggregate correlation over rows where both are present; null for a constant side."""
    complete = a.isNotNull() & b.isNotNull()
    x, y = F.when(complete, a), F.when(complete, b)
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def pair_corr(df: DataFrame, a: str, b: str, by: Sequence[str] = ()) -> DataFrame:
    x, y = F.col(a), F.col(b)
    return df.groupBy(*by).agg(
        F.count_if(x.isNotNull() & y.isNotNull()).alias("n"), safe_corr(x, y).alias("corr")
    )


def corr_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pairwise-complete correlations of all column pairs, one row per ordered pair.

    Each row yields its column pairs inside the task that reads it, where they are
    combined at once; only one partial result per pair and task is shuffled.
    """
    p = len(columns)
    values = df.select(F.array(*[F.col(c).cast("double") for c in columns]).alias("_xs"))
    # The outer form keeps the optimiser from copying the whole array below the windows
    # of the input as an inferred "array is not empty" filter.
    left = values.select("_xs", F.posexplode_outer("_xs").alias("_i", "_x")).where(
        "_x IS NOT NULL"
    )
    rest = F.slice("_xs", F.col("_i") + 1, F.lit(p))
    cells = (
        left.select("_i", "_x", F.posexplode_outer(rest).alias("_k", "_y"))
        .where("_y IS NOT NULL")
        .groupBy("_i", (F.col("_i") + F.col("_k")).alias("_j"))
        .agg(
            F.try_divide(
                F.covar_pop("_x", "_y"), F.stddev_pop("_x") * F.stddev_pop("_y")
            ).alias("corr")
        )
    )
    # The pair grid is fixed by the column list, so pairs without data still appear.
    pairs = [(i, j) for i in range(p) for j in range(i, p)]
    grid = df.sparkSession.createDataFrame(pairs, "_i int, _j int")
    corr = F.when(F.col("_i") == F.col("_j"), F.signum("corr")).otherwise(F.col("corr"))
    full = grid.join(cells, ["_i", "_j"], "left").withColumn("corr", corr)
    names = F.array(*[F.lit(c) for c in columns])
    both = F.when(F.col("_i") == F.col("_j"), F.array(F.struct("_i", "_j"))).otherwise(
        F.array(F.struct("_i", "_j"), F.struct(F.col("_j").alias("_i"), F.col("_i").alias("_j")))
    )
    ordered = full.select(F.explode(both).alias("_c"), "corr")
    return ordered.select(
        names[F.col("_c._i")].alias("a"), names[F.col("_c._j")].alias("b"), "corr"
    )


def high_corr_pairs(matrix: DataFrame, limit: float = 0.9) -> DataFrame:
    """Pairs (each once) whose absolute correlation exceeds the limit."""
    return matrix.where((F.col("a") < F.col("b")) & (F.abs("corr") > limit)).withColumn(
        "abs_corr", F.abs("corr")
    )


def return_histogram(
    bars: DataFrame, bins: int, by: Sequence[str] = ("series",), value: str = "ret"
) -> DataFrame:
    """Equi-width counts between the smallest and largest value of each group.

    Values are counted per group after a combine step; the group's range is
    attached with a salted join, so one very large group stays spread out.
    """
    present = bars.where(F.col(value).isNotNull()).select(*by, F.col(value).alias("_v"))
    limits = present.groupBy(*by).agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    joined = attach_group_value(present, limits, by, "_v")
    width = (F.col("_hi") - F.col("_lo")) / bins
    bin_no = F.least(
        F.coalesce(F.floor(F.try_divide(F.col("_v") - F.col("_lo"), width)), F.lit(0)) + 1,
        F.lit(bins),
    ).cast("long")
    counted = joined.groupBy(*by, bin_no.alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.max("_lo").alias("_lo"), F.max("_hi").alias("_hi")
    )
    step = (F.col("_hi") - F.col("_lo")) / bins
    return counted.select(
        *by,
        "bin",
        (F.col("_lo") + step * (F.col("bin") - 1)).alias("low"),
        (F.col("_lo") + step * F.col("bin")).alias("high"),
        "n",
    )


#: Accuracy of the sketch behind exact quantiles, and the rows up to which a group is ranked without one.
SKETCH, FEW = 10_000, 40_000


def exact_quantiles(values: DataFrame, probs: Sequence[float], by: Sequence[str], value: str = "value") -> DataFrame:
    """Exact linear-interpolated quantiles per group without sorting a group in one task.

    A mergeable sketch brackets the wanted ranks of each group. A second pass combines values
    inside a bracket to (value, count) and those between brackets to one count each, so
    of a large group a thousandth is shuffled for each rank. A group one of whose ranks is
    not inside a bracket is ranked whole (:func:`_ranked_quantiles`).
    """
    by, k, margin = list(by), len(probs), 3.0 / SKETCH
    present = values.where(F.col(value).isNotNull()).select(*by, F.col(value).cast("double").alias("_v"))
    cuts = [min(max(float(p) + side, 0.0), 1.0) for side in (-margin, margin) for p in probs]
    sketch = present.groupBy(*by).agg(
        F.count(F.lit(1)).alias("_total"), F.percentile_approx("_v", cuts, SKETCH).alias("_cuts")
    )
    few = F.col("_total") <= FEW  # one bracket around all values; NaN is the largest number
    edge = lambda i, all_: F.when(few, F.lit(all_)).otherwise(F.col("_cuts")[i])
    lows = [edge(i, float("-inf")).alias(f"_lo{i}") for i in range(k)]
    highs = [edge(k + i, float("nan")).alias(f"_hi{i}") for i in range(k)]
    brackets = stored(sketch.select(*by, "_total", *lows, *highs), "brackets")
    joined = present.join(brackets, by) if by else present.crossJoin(F.broadcast(brackets))
    v, inside, passed = F.col("_v"), F.lit(False), []
    for i in range(k):
        inside = inside | ((v >= F.col(f"_lo{i}")) & (v <= F.col(f"_hi{i}")))
        passed.append(F.when(F.col(f"_hi{i}") < v, F.col(f"_hi{i}")))
    last_passed = F.greatest(*passed) if k > 1 else passed[0]
    dealt = joined.select(*by, "_total", inside.alias("_in"), F.when(inside, v).otherwise(last_passed).alias("_at"))
    counted = dealt.groupBy(*by, "_at", "_in").agg(F.count(F.lit(1)).alias("_n"), F.max("_total").alias("_total"))
    in_order = Window.partitionBy(*by).orderBy(F.col("_at").asc_nulls_first(), F.col("_in").desc())
    upto = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = counted.withColumn("_last", F.sum("_n").over(upto) - 1)
    first = F.col("_last") - F.col("_n") + 1
    points, found = [], F.lit(True)
    for p in probs:
        a = (F.col("_total") - 1) * F.lit(float(p))
        ends = []
        for rank in (F.floor(a), F.ceil(a)):
            held = F.col("_in") & (first <= rank) & (F.col("_last") >= rank)
            ends.append(F.max(F.when(held, F.col("_at"))))
            found = found & F.bool_or(held)
        lo, hi = ends
        points.append(lo + (hi - lo) * F.max(a - F.floor(a)))
    out = stored(ranked.groupBy(*by).agg(F.array(*points).alias("quantiles"), found.alias("_found")), "quantiles")
    rest = out.where(~F.col("_found"))
    if rest.isEmpty():
        return out.drop("_found")
    whole = values.join(rest.select(*by), by, "left_semi") if by else values
    return out.where("_found").drop("_found").unionByName(_ranked_quantiles(whole, probs, by, value))


def _ranked_quantiles(values: DataFrame, probs: Sequence[float], by: Sequence[str], value: str = "value") -> DataFrame:
    """The quantiles of :func:`exact_quantiles` from all values.

    Equal values of a group are combined to (value, count), dealt by ranges of (group,
    value) and written; the counts of a group's ranges, summed in order, say in which
    ranges its wanted ranks lie, and only those ranges are ranked.
    """
    present = values.where(F.col(value).isNotNull())
    counted = present.groupBy(*by, F.col(value).cast("double").alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    parts = int(values.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = counted.repartitionByRange(parts, *by, "_v").withColumn("_range", F.spark_partition_id())
    dealt = stored(dealt, "quantiles")
    upto = (Window.unboundedPreceding, Window.currentRow)
    of_group = Window.partitionBy(*by)
    sums = dealt.groupBy(*by, "_range").agg(F.sum("_n").alias("_in"))
    sums = sums.withColumns(
        {
            "_total": F.sum("_in").over(of_group),
            "_start": F.sum("_in").over(of_group.orderBy("_range").rowsBetween(*upto)) - F.col("_in"),
        }
    )
    at = [(F.col("_total") - 1) * F.lit(float(p)) for p in probs]
    ranks = F.array(*[f(a) for a in at for f in (F.floor, F.ceil)])
    end = F.col("_start") + F.col("_in") - 1
    wanted = sums.where(F.exists(ranks, lambda r: (r >= F.col("_start")) & (r <= end)))
    rows = dealt.join(wanted, [*by, "_range"])
    last = F.col("_start") + F.sum("_n").over(Window.partitionBy(*by, "_range").orderBy("_v").rowsBetween(*upto)) - 1
    ranked = rows.withColumn("_last", last)
    first = F.col("_last") - F.col("_n") + 1
    holds = lambda rank: F.max(F.when((first <= rank) & (F.col("_last") >= rank), F.col("_v")))
    points = []
    for a in at:
        lo, hi, share = holds(F.floor(a)), holds(F.ceil(a)), F.max(a - F.floor(a))
        points.append(lo + (hi - lo) * share)
    return ranked.groupBy(*by).agg(F.array(*points).alias("quantiles"))


PROFILE_QUANTILES = (0.25, 0.5, 0.75)


def column_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, std, min, quartiles, max of each column, one row per column.

    The plain statistics are one aggregate over the table; only the quartiles look at
    single values. A column without values has no row.
    """
    v = {c: F.col(c).cast("double") for c in columns}
    stats = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"), F.count(v[c]).alias("count"), F.avg(v[c]).alias("mean"),
                F.stddev_samp(v[c]).alias("std"), F.min(v[c]).alias("min"), F.max(v[c]).alias("max"),
            )
            for c in columns
        ]
    )
    plain = df.agg(stats.alias("_s")).select(F.explode("_s").alias("_s")).select("_s.*")
    quantiles = exact_quantiles(_long(df, columns, ()), PROFILE_QUANTILES, ["column"])
    q = F.col("quantiles")
    return plain.join(quantiles, "column").select(
        "column",
        "count",
        "mean",
        "std",
        "min",
        *[q[i].alias(f"q{int(p * 100)}") for i, p in enumerate(PROFILE_QUANTILES)],
        "max",
    )


def residual_stats(
    scored: DataFrame, by: Sequence[str], y: str = "rv_5d", p: str = "prediction"
) -> DataFrame:
    """mean, population std, min, max and exact median of the residuals."""
    residuals = scored.select(*by, (F.col(y) - F.col(p)).alias("value")).where("value IS NOT NULL")
    v = F.col("value")
    stats = residuals.groupBy(*by).agg(
        F.avg(v).alias("mean"),
        F.stddev_pop(v).alias("std"),
        F.min(v).alias("min"),
        F.max(v).alias("max"),
    )
    median = exact_quantiles(residuals, [0.5], by)
    return stats.join(median, list(by)).select(
        *by, "mean", "std", "min", "max", F.col("quantiles")[0].alias("median")
    )


def residual_quantiles(
    scored: DataFrame,
    by: Sequence[str],
    points: int = 9,
    y: str = "rv_5d",
    p: str = "prediction",
) -> DataFrame:
    """Residual quantiles next to the standard normal quantiles of the same probabilities."""
    probs = [i / (points + 1) for i in range(1, points + 1)]
    residuals = scored.select(*by, (F.col(y) - F.col(p)).alias("value"))
    table = exact_quantiles(residuals, probs, by)
    rows = [
        F.struct(
            F.lit(prob).alias("prob"),
            F.lit(NormalDist().inv_cdf(prob)).alias("normal"),
            F.col("quantiles")[i].alias("residual"),
        )
        for i, prob in enumerate(probs)
    ]
    return table.select(*by, F.explode(F.array(*rows)).alias("row")).select(*by, "row.*")


def residual_shape(
    scored: DataFrame, by: Sequence[str], y: str = "rv_5d", p: str = "prediction"
) -> DataFrame:
    """Population skewness and excess kurtosis of the residuals and the near-normal flag."""
    residuals = scored.select(*by, (F.col(y) - F.col(p)).alias("e")).where("e IS NOT NULL")
    shape = residuals.groupBy(*by).agg(
        F.skewness("e").alias("skewness"), F.kurtosis("e").alias("kurtosis")
    )
    near = (F.abs("skewness") < 0.5) & (F.abs("kurtosis") < 3)
    return shape.withColumn("near_normal", near)


def cumulative_return(
    bars: DataFrame,
    *,
    ret: str = "ret",
    simple: bool = False,
    out: str = "growth",
    keys: Sequence[str] = ("series",),
    order: str = "bar",
    grain: str | None = None,
    slot: Slot = None,
) -> DataFrame:
    """Growth of one unit since the first bar; null where the return is null.

    Log returns compound as ``exp(sum)``. ``simple`` gives the product of
    ``1 + ret`` instead; returns of -100 % or less have no logarithm and are left
    out of it.
    """
    r = F.col(ret)
    step = F.when(r > -1, F.log1p(r)) if simple else r
    total = running_sum(bars, keys, order, step, "_log", grain=grain, slot=slot)
    return total.withColumn(out, F.when(r.isNotNull(), F.exp("_log"))).drop("_log")


def warmup_check(
    df: DataFrame,
    columns: Sequence[str],
    *,
    keys: Sequence[str] = (),
    order: str = "bar",
    grain: str | None = None,
    slot: Slot = None,
) -> DataFrame:
    """First valid position, null count and nulls after the first valid row, per column."""
    numbered = number_rows(df, keys, order, grain=grain, slot=slot)
    firsts = [F.min(F.when(F.col(c).isNotNull(), F.col("position"))) for c in columns]
    row = numbered.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"),
        *[f.alias(f"_f{i}") for i, f in enumerate(firsts)],
        *[F.count_if(F.col(c).isNull()).alias(f"_n{i}") for i, c in enumerate(columns)],
    )
    entries = [
        F.struct(
            F.lit(c).alias("feature"),
            F.col(f"_f{i}").alias("first_valid"),
            F.col(f"_n{i}").alias("nulls"),
            (F.col(f"_n{i}") - F.coalesce(F.col(f"_f{i}") - 1, F.col("rows"))).alias(
                "nulls_after_first"
            ),
        )
        for i, c in enumerate(columns)
    ]
    return row.select(*keys, F.explode(F.array(*entries)).alias("e")).select(*keys, "e.*")


def price_ratio(
    bars: DataFrame, a: str, b: str, *, series: str = "series", order: str = "bar"
) -> DataFrame:
    """Ratio of two series' closes on the bars both have."""
    one = lambda s, name: bars.where(F.col(series) == s).select(order, F.col("close").alias(name))
    return one(a, "_a").join(one(b, "_b"), order).select(
        order, ratio(F.col("_a"), F.col("_b")).alias("ratio")
    )
