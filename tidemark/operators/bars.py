"""Bars: normalising vendor frames, building OHLCV bars, deduplication, log returns."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import bar_start, log_return
from tidemark.operators.frames import over_rows

# Fixed column names of a raw bar.
PRICE_COLUMNS = ("open", "high", "low", "close")
NORMALISED = ("symbol", "date", *PRICE_COLUMNS, "adj_close", "volume")


def _plain_name(name: str) -> str:
    """First level of a two-level header such as ``('Adj Close', 'SPY')``, lower case."""
    two_level = re.match(r"^\(\s*'([^']+)'\s*,.*\)$", name)
    return (two_level.group(1) if two_level else name).strip().lower().replace(" ", "_")


def normalise_bars(df: DataFrame, symbol: str | None = None) -> DataFrame:
    """Vendor frame -> ``symbol, date, open, high, low, close, adj_close, volume``.

    Header levels are flattened, names lower-cased, times cut to the date, and
    ``close`` stands in for a missing adjusted close.
    """
    out = df.toDF(*[_plain_name(c) for c in df.columns])
    if symbol is not None:
        out = out.withColumn("symbol", F.lit(symbol))
    if "adj_close" not in out.columns and "close" in out.columns:
        out = out.withColumn("adj_close", F.col("close"))
    missing = [c for c in NORMALISED if c not in out.columns]
    if missing:
        raise ValueError(f"bars lack the columns {missing}")
    return out.select(
        "symbol",
        F.to_date("date").alias("date"),
        *PRICE_COLUMNS,
        F.coalesce("adj_close", "close").alias("adj_close"),
        "volume",
    )


def raw_bars(df: DataFrame) -> DataFrame:
    """The seven raw columns with a date and a floating volume."""
    return df.select(
        "symbol",
        F.to_date("date").alias("date"),
        *PRICE_COLUMNS,
        F.col("volume").cast("double").alias("volume"),
    )


def ohlcv_bars(
    df: DataFrame,
    *,
    series: str,
    ts: str,
    value: str,
    every: str,
    volume: Column | None = None,
) -> DataFrame:
    """Ticks -> bars; ties of ``ts`` within one bar must not occur.

    All aggregates are combined before the shuffle, so a series holding most of
    the ticks costs no more than any other once it reaches the reducers.
    """
    at, v = F.col(ts), F.col(value)
    volume = F.count(F.lit(1)) if volume is None else volume
    bars = df.groupBy(
        F.col(series).alias("series"),
        bar_start(at, every, df.schema[ts].dataType).alias("bar"),
    ).agg(
        F.min_by(v, at).alias("open"),
        F.max(v).alias("high"),
        F.min(v).alias("low"),
        F.max_by(v, at).alias("close"),
        volume.cast("double").alias("volume"),
    )
    return bars.select(
        "series", "bar", *PRICE_COLUMNS, F.col("close").alias("adj_close"), "volume"
    )


def vwap_bars(
    df: DataFrame,
    *,
    series: Column,
    ts: str,
    amount: Column,
    quantity: Column,
    every: str,
    minor_units: int = 100,
) -> DataFrame:
    """Trades -> bars whose close is the quantity-weighted price (no order of ticks needed).

    Amounts are summed in whole minor units: integer sums are exact, so a bar does
    not depend on the order in which tasks deliver their partial sums.
    """
    minor = F.rint(amount * minor_units).cast("long")
    close = F.try_divide(F.col("_amount") / F.lit(float(minor_units)), F.col("volume"))
    return (
        df.groupBy(
            series.alias("series"),
            bar_start(F.col(ts), every, df.schema[ts].dataType).alias("bar"),
        )
        .agg(F.sum(minor).alias("_amount"), F.sum(quantity).alias("volume"))
        .select("series", "bar", close.alias("close"), close.alias("adj_close"), "volume")
    )


def dedupe_last(df: DataFrame, keys: Sequence[str], seq: Sequence[str]) -> DataFrame:
    """Keep, per ``keys``, the row with the greatest ``seq`` (an explicit load order).

    A combined aggregate instead of a ranking: a key with a very large number of
    copies is reduced to one row in every map task.
    """
    rest = [c for c in df.columns if c not in keys]
    payload = F.struct(*[F.col(c) for c in seq], *[F.col(c) for c in rest if c not in seq])
    best = df.groupBy(*keys).agg(F.max(payload).alias("_last"))
    return best.select(
        *[F.col(c) if c in keys else F.col(f"_last.{c}").alias(c) for c in df.columns]
    )


def log_returns(
    bars: DataFrame,
    price: str = "adj_close",
    *,
    keys: Sequence[str] = ("series",),
    order: str = "bar",
    keep_first: bool = False,
    grain: str | None = None,
    **chunking,
) -> DataFrame:
    """Add ``ret`` against the previous available bar of the series.

    Rows without a return (the first bar, non-positive prices) are dropped unless
    ``keep_first`` is set.
    """
    out = over_rows(
        bars,
        keys,
        order,
        [
            lambda w: {"_prev": F.lag(price).over(w)},
            lambda w: {"ret": log_return(F.col(price), F.col("_prev"))},
        ],
        back=1,
        grain=grain,
        **chunking,
    ).drop("_prev")
    return out if keep_first else out.where(F.col("ret").isNotNull())


def null_return_report(bars: DataFrame, order: str = "bar") -> DataFrame:
    """Number of rows without a return per bar time."""
    return (
        bars.where(F.col("ret").isNull())
        .groupBy(order)
        .agg(F.count(F.lit(1)).alias("null_rows"))
    )


def pivot_wide(
    bars: DataFrame,
    columns: Mapping[str, tuple[str, str]],
    *,
    series: str = "series",
    order: str = "bar",
) -> DataFrame:
    """Long -> wide: one row per bar, ``columns`` maps output name to (series, field).

    Written as conditional aggregates, so no job is needed to discover the series
    and rows of other series are filtered at the scan. Input must be unique per
    (series, bar); see :func:`dedupe_last`.
    """
    used = sorted({s for s, _ in columns.values()}, key=str)
    aggs = [
        F.max(F.when(F.col(series) == s, F.col(field))).alias(name)
        for name, (s, field) in columns.items()
    ]
    return bars.where(F.col(series).isin(used)).groupBy(order).agg(*aggs)


def missing_series(bars: DataFrame, wanted: Sequence[str], series: str = "series") -> DataFrame:
    """Validation row per wanted series that has no bars at all."""
    spark = bars.sparkSession
    names = spark.createDataFrame([(s,) for s in wanted], f"{series} string")
    return names.join(bars.select(series).distinct(), series, "left_anti")
