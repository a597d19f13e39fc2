"""Ordered work on long series without one task per series.

A window partitioned by series alone puts a whole series into one task. That is
safe only when the number of rows per series has a fixed bound. Bars of an hour
or longer have one: a (series, bar) pair is unique, so two hundred years are at
most 1.8 million hourly rows. Callers state this with ``grain``. Without it the
functions here cut every long series into chunks of about ``rows`` rows. ``slot`` sets
the length of the time slots; by default slots are even in rows, not in time: a slot
that holds more rows of a series than wanted is cut into shorter ones, down to a
microsecond, so a burst makes more slots and not longer chunks (rows of one series at the
very same microsecond cannot be told apart and stay together):

* rows are counted per (series, time slot) -- a small, map-side combined table;
* running totals over that table, within ranges of slots and then over the ranges, give
  each slot its exact row offset;
* a slot is sent to its own chunk and, as a halo, to each neighbouring chunk
  whose frames can reach it; copies are dropped after the window has run.

The offsets are exact for any gaps, so the chunked result equals the plain one.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tidemark.sources.store import stored

BOUNDED_GRAINS = ("hour", "day", "week", "month", "quarter", "year")
ROWS_PER_CHUNK = 262_144
SLOTS_PER_CHUNK = 16

CHUNK, HOME, SLOT = "_chunk", "_home", "_slot"

Step = Callable[[WindowSpec], dict[str, Column]]
Slot = Column | timedelta | None


def is_bounded(grain: str | None) -> bool:
    return grain in BOUNDED_GRAINS


def _seconds(order: str) -> Column:
    """Whole seconds of a date or time, monotone and free of time-zone shifts."""
    at = F.col(order)
    day = F.date_diff(F.to_date(at), F.lit("1970-01-01").cast("date")).cast("long")
    clock = at.cast("timestamp_ntz")
    return day * 86_400 + F.hour(clock) * 3_600 + F.minute(clock) * 60 + F.second(clock)


def time_slot(order: str, length: timedelta) -> Column:
    """Number of the time slot of the given length that holds a row."""
    return F.floor(_seconds(order) / F.lit(int(length.total_seconds()))).cast("long")


def _micros(order: str) -> Column:
    """Microseconds of a date or time, monotone and free of time-zone shifts."""
    clock = F.col(order).cast("timestamp_ntz")
    part = (F.extract(F.lit("SECOND"), clock) * 1_000_000).cast("long") - F.second(clock) * 1_000_000
    return _seconds(order) * 1_000_000 + part


#: A slot with too many rows is cut into this many at least.
FINER = 64


def even_slots(
    df: DataFrame, keys: Sequence[str], order: str, rows: int
) -> tuple[DataFrame, DataFrame]:
    """Rows with their slot, and the stored (keys, slot, rows) counts; no slot above ``rows`` that time can cut.

    Slots start as equal spans that hold half of ``rows`` on average. Slots that hold more are cut
    by how many more they hold, again and again: each round ends after one combined count, and
    there are as many as it takes to get from the first length to a microsecond, six or so
    at the worst. A slot is named by its first microsecond.
    """
    at = _micros(order)
    span, n = df.select(F.max(at) - F.min(at) + 1, F.count(at)).first()
    length = max(int((span or 1) * rows / (2 * max(n, 1))), 1)
    width = F.lit(length).cast("long")
    tagged = df.withColumns({"_us": at, "_w": width}).withColumn(SLOT, F.col("_us") - F.pmod("_us", "_w"))
    names = [f"_k{i}" for i in range(len(keys))]
    while True:
        counts = stored(tagged.groupBy(*keys, SLOT, "_w").agg(F.count(F.lit(1)).alias("_n")), "slots")
        parts = F.greatest(F.lit(FINER), F.ceil(F.col("_n") * 2 / F.lit(rows)))
        dense = counts.where((F.col("_n") > rows) & (F.col("_w") > 1)).select(
            *[F.col(k).alias(c) for k, c in zip(keys, names)],
            F.col(SLOT).alias("_at"),
            F.greatest(F.lit(1), F.floor(F.col("_w") / parts)).cast("long").alias("_finer"),
        )
        if dense.isEmpty():
            return tagged.drop("_us", "_w"), counts.drop("_w")
        same = [tagged[SLOT] == dense["_at"], *[tagged[k].eqNullSafe(dense[c]) for k, c in zip(keys, names)]]
        inside = F.col("_us") - F.col(SLOT)
        tagged = (
            tagged.join(dense, same, "left")
            .withColumns(
                {
                    SLOT: F.when(F.col("_finer").isNull(), F.col(SLOT)).otherwise(F.col("_us") - F.pmod(inside, F.col("_finer"))),
                    "_w": F.coalesce("_finer", "_w"),
                }
            )
            .drop("_at", "_finer", *names)
        )


def _with_slot(
    df: DataFrame, keys: Sequence[str], order: str, slot: Slot, rows: int
) -> tuple[DataFrame, DataFrame]:
    """Rows with their slot, and the (keys, slot, rows) counts."""
    if slot is None:
        return even_slots(df, keys, order, max(1, rows // SLOTS_PER_CHUNK))
    if isinstance(slot, timedelta):
        slot = time_slot(order, slot)
    tagged = df.withColumn(SLOT, slot)
    return tagged, stored(tagged.groupBy(*keys, SLOT).agg(F.count(F.lit(1)).alias("_n")), "slots")


def slot_totals(counts: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """``counts`` with ``_before``, the sum over the key's earlier slots, and ``_total``, its whole sum.

    Summed in two levels: within ranges of slots, one task each, and over the ranges of a key,
    of which there are as many as shuffle partitions at most.
    """
    parts = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = counts.repartitionByRange(parts, *keys, SLOT).withColumn("_range", F.spark_partition_id())
    dealt = stored(dealt, "ranges")
    earlier = (Window.unboundedPreceding, -1)
    ranges = dealt.groupBy(*[F.col(k).alias(f"_r_{k}") for k in keys], F.col("_range").alias("_r")).agg(F.sum(value).alias("_in"))
    of_key = Window.partitionBy(*[f"_r_{k}" for k in keys])
    ranges = ranges.withColumns(
        {"_start": F.sum("_in").over(of_key.orderBy("_r").rowsBetween(*earlier)), "_total": F.sum("_in").over(of_key)}
    )
    same = [dealt["_range"] == ranges["_r"], *[dealt[k].eqNullSafe(ranges[f"_r_{k}"]) for k in keys]]
    joined = dealt.join(F.broadcast(ranges) if not keys else ranges, same)
    local = F.sum(value).over(Window.partitionBy(*keys, "_range").orderBy(SLOT).rowsBetween(*earlier))
    some = local.isNotNull() | F.col("_start").isNotNull()
    before = F.when(some, F.coalesce(local, F.lit(0)) + F.coalesce("_start", F.lit(0)))
    return joined.withColumn("_before", before).drop("_range", "_r", "_in", "_start", *[f"_r_{k}" for k in keys])


def slot_offsets(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per (keys, slot): its row count, first 0-based row number and the key's total."""
    return slot_totals(counts, keys, "_n").select(
        *keys, SLOT, "_n", F.coalesce("_before", F.lit(0)).alias("_first"), "_total"
    )


def number_rows(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    *,
    grain: str | None = None,
    slot: Slot = None,
    position: str = "position",
    total: str = "total",
) -> DataFrame:
    """Add the exact 1-based ``position`` of each row within its keys and the keys' ``total``."""
    if is_bounded(grain):
        w = Window.partitionBy(*keys)
        return df.withColumns(
            {
                position: F.row_number().over(w.orderBy(order)).cast("long"),
                total: F.count(F.lit(1)).over(w),
            }
        )
    tagged, counts = _with_slot(df, keys, order, slot, ROWS_PER_CHUNK)
    offsets = slot_offsets(counts, keys).select(
        *keys, SLOT, "_first", F.col("_total").alias(total)
    )
    within = Window.partitionBy(*keys, SLOT).orderBy(order)
    return (
        tagged.join(offsets, [*keys, SLOT])
        .withColumn(position, F.col("_first") + F.row_number().over(within))
        .drop(SLOT, "_first")
    )


def halo_chunks(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    back: int,
    ahead: int = 0,
    *,
    rows: int = ROWS_PER_CHUNK,
    slot: Slot = None,
) -> DataFrame:
    """Assign rows to chunks, with copies wherever a frame of another chunk can reach.

    Adds ``_chunk`` (partition windows by it) and ``_home`` (keep rows where the
    two agree). Series of at most ``rows`` rows stay whole in chunk 0.
    """
    tagged, counts = _with_slot(df, keys, order, slot, rows)
    own = F.floor(F.col("_first") / F.lit(rows)).cast("long")
    last_reader = F.floor((F.col("_first") + F.col("_n") - 1 + back) / F.lit(rows)).cast("long")
    by_slot = Window.partitionBy(*keys).orderBy(SLOT)
    long_series = (
        slot_offsets(counts, keys)
        .where(F.col("_total") > rows)
        .withColumns({HOME: own, "_hi": last_reader, "_lo": own})
    )
    if ahead > 0:
        # Earlier chunks whose last rows look up to ``ahead`` rows into this slot.
        reach = (
            Window.partitionBy(*keys)
            .orderBy(F.col("_first") - 1)
            .rangeBetween(-(ahead - 1), Window.currentRow)
        )
        long_series = long_series.withColumn("_before", F.lag(HOME).over(by_slot)).withColumn(
            "_lo", F.coalesce(F.min("_before").over(reach), F.col(HOME))
        )
    copies = long_series.select(*keys, SLOT, HOME, F.sequence("_lo", "_hi").alias("_readers"))
    return (
        tagged.join(copies, [*keys, SLOT], "left")
        .withColumns(
            {
                CHUNK: F.explode(F.coalesce("_readers", F.array(F.lit(0).cast("long")))),
                HOME: F.coalesce(HOME, F.lit(0).cast("long")),
            }
        )
        .drop(SLOT, "_readers")
    )


def over_rows(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    steps: Sequence[Step],
    *,
    back: int,
    ahead: int = 0,
    grain: str | None = None,
    rows: int = ROWS_PER_CHUNK,
    slot: Slot = None,
) -> DataFrame:
    """Add window columns, step by step, over rows ordered within ``keys``.

    All steps share one partitioning and one sort. ``back`` / ``ahead`` state how
    many rows the steps together reach before / after the current row.
    """
    if is_bounded(grain):
        w = Window.partitionBy(*keys).orderBy(order)
        for step in steps:
            df = df.withColumns(step(w))
        return df
    out = halo_chunks(df, keys, order, back, ahead, rows=rows, slot=slot)
    w = Window.partitionBy(*keys, CHUNK).orderBy(order)
    for step in steps:
        out = out.withColumns(step(w))
    return out.where(F.col(CHUNK) == F.col(HOME)).drop(CHUNK, HOME)


def running_sum(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    value: Column,
    out: str,
    *,
    grain: str | None = None,
    slot: Slot = None,
) -> DataFrame:
    """Running total from the start of each series (nulls add nothing)."""
    upto = (Window.unboundedPreceding, Window.currentRow)
    if is_bounded(grain):
        w = Window.partitionBy(*keys).orderBy(order).rowsBetween(*upto)
        return df.withColumn(out, F.sum(value).over(w))
    tagged, _ = _with_slot(df.withColumn("_v", value), keys, order, slot, ROWS_PER_CHUNK)
    sums = stored(tagged.groupBy(*keys, SLOT).agg(F.sum("_v").alias("_s")), "sums")
    starts = slot_totals(sums, keys, "_s").select(*keys, SLOT, F.col("_before").alias("_start"))
    within = Window.partitionBy(*keys, SLOT).orderBy(order).rowsBetween(*upto)
    local = F.sum("_v").over(within)
    total = F.when(
        local.isNotNull() | F.col("_start").isNotNull(),
        F.coalesce(local, F.lit(0.0)) + F.coalesce("_start", F.lit(0.0)),
    )
    return tagged.join(starts, [*keys, SLOT]).withColumn(out, total).drop(SLOT, "_v", "_start")


def last_rows(df: DataFrame, keys: Sequence[str], order: str, n: int) -> DataFrame:
    """The ``n`` latest rows per key, oldest position last (``recency`` 1 = latest).

    The rank filter is applied before the shuffle as well, so each task passes on
    at most ``n`` rows per key however many rows the key has.
    """
    w = Window.partitionBy(*keys).orderBy(F.col(order).desc())
    return df.withColumn("recency", F.row_number().over(w)).where(F.col("recency") <= n)


def attach_group_value(
    rows: DataFrame,
    groups: DataFrame,
    keys: Sequence[str],
    spread_by: str,
    salts: int = 16,
    *,
    few: bool = False,
) -> DataFrame:
    """Join one row per group onto all rows of the group, hot groups included.

    Rows of a group are spread over ``salts`` partitions by a hash of
    ``spread_by``; the one-row side is copied to each. A salted key is needed
    because adaptive skew splitting does not apply below an aggregate on the same
    keys. ``few`` states that the groups are named by the plan, not by the data
    (column names, say); only then is their table broadcast.
    """
    if few:
        return rows.join(F.broadcast(groups), list(keys))
    salt = F.pmod(F.xxhash64(spread_by), F.lit(salts))
    copies = groups.withColumn(
        "_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long")))
    )
    return rows.withColumn("_salt", salt).join(copies, [*keys, "_salt"]).drop("_salt")
