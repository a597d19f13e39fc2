"""Incremental runs: what is new, how much context it needs, and merging the result.

Each job gives the same rows as a full recomputation on everything it was shown.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.bars import log_returns
from tidemark.operators.features import DEFAULT_ROLES, wide_bars, wide_features
from tidemark.operators.frames import attach_group_value, last_rows
from tidemark.operators.labels import HORIZON, LABEL, forward_rv
from tidemark.sources import versions
from tidemark.sources.store import stored

CONTEXT_ROWS = 70
CONTEXT_DAYS = 150


#: Keys that a task compares at most, about, where :func:`dates_to_process` is told their number.
KEYS_A_TASK = 500_000


def dates_to_process(
    available: DataFrame, processed: DataFrame, on: Sequence[str] = ("bar",), *, keys: int | None = None
) -> DataFrame:
    """Available keys that have not been processed, gaps included; only those left are made distinct.

    ``keys``, the rows of ``available``, sets the number of tasks, so that a task's memory does
    not grow with the tables.
    """
    on = list(on)
    available, processed = available.select(*on), processed.select(*on)
    if keys is not None:
        parts = max(-(-keys // KEYS_A_TASK), 1)
        available, processed = available.repartition(parts, *on), processed.repartition(parts, *on)
    return available.join(processed, on, "left_anti").distinct()


def dates_after_watermark(
    available: DataFrame,
    processed: DataFrame,
    *,
    keys: Sequence[str] = (),
    order: str = "bar",
) -> DataFrame:
    """Available times after the last processed one (per key when keys are given)."""
    times = available.select(*keys, order).distinct()
    if not keys:
        mark = processed.select(F.max(order)).scalar()
        return times.where(F.col(order) > F.coalesce(mark, F.lit("0001-01-01").cast("timestamp_ntz")))
    marks = processed.groupBy(*keys).agg(F.max(order).alias("_mark"))
    late = times.join(marks, list(keys), "left")
    return late.where(F.col("_mark").isNull() | (F.col(order) > F.col("_mark"))).drop("_mark")


def _before_first(existing: DataFrame, new: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Existing rows strictly before the first new row of their key."""
    if not keys:
        return existing.where(F.col(order) < new.select(F.min(order)).scalar())
    firsts = new.groupBy(*keys).agg(F.min(order).alias("_first"))
    return (
        attach_group_value(existing, firsts, keys, order)
        .where(F.col(order) < F.col("_first"))
        .drop("_first")
    )


def with_context(
    new: DataFrame,
    existing: DataFrame,
    rows: int = CONTEXT_ROWS,
    *,
    keys: Sequence[str] = ("series",),
    order: str = "bar",
) -> DataFrame:
    """``new`` plus the last ``rows`` existing rows before it per key, flagged ``is_context``."""
    before = last_rows(_before_first(existing, new, keys, order), keys, order, rows)
    context = before.drop("recency").withColumn("is_context", F.lit(True))
    return context.unionByName(
        new.withColumn("is_context", F.lit(False)), allowMissingColumns=True
    )


def context_by_days(
    existing: DataFrame, new: DataFrame, days: int = CONTEXT_DAYS, *, order: str = "bar"
) -> DataFrame:
    """Existing rows from ``days`` calendar days before the first new time to the last one."""
    first, last = new.select(F.min(order)).scalar(), new.select(F.max(order)).scalar()
    at = F.col(order)
    return existing.where((at >= first - F.expr(f"INTERVAL {days} DAYS")) & (at <= last))


def incremental_returns(
    new_bars: DataFrame,
    curated: DataFrame,
    *,
    keys: Sequence[str] = ("series",),
    order: str = "bar",
    price: str = "adj_close",
    grain: str | None = None,
    **chunking,
) -> DataFrame:
    """Returns of new bars, the last stored bar of each series being the predecessor."""
    joined = with_context(new_bars, curated.drop("ret"), 1, keys=keys, order=order)
    out = log_returns(
        joined, price, keys=keys, order=order, keep_first=True, grain=grain, **chunking
    )
    return out.where(~F.col("is_context") & F.col("ret").isNotNull()).drop("is_context")


def incremental_features(
    curated: DataFrame,
    features: DataFrame,
    roles: Mapping[str, str] = DEFAULT_ROLES,
    *,
    context: int = CONTEXT_ROWS,
    order: str = "bar",
    grain: str | None = None,
    **chunking,
) -> DataFrame:
    """Features of the bars that have none yet.

    Only bars from ``context`` bars before the first missing one are read; the
    bound is a subquery, so it prunes the partitions of a stored table. With no
    features at all this is the full build.
    """
    times = curated.select(order).distinct()
    target = dates_to_process(times, features, [order])
    first = target.select(F.min(order)).scalar()
    earlier = times.where(F.col(order) < first).orderBy(F.col(order).desc()).limit(context)
    start = earlier.select(F.min(order)).scalar()
    loaded = curated.where(F.col(order) >= F.coalesce(start, first))
    computed = wide_features(
        wide_bars(loaded, roles, order=order), order=order, grain=grain, **chunking
    )
    return computed.join(target, [order], "left_semi")


def master_changes(
    master: DataFrame,
    new_features: DataFrame,
    *,
    ret: str = "spy_ret_1d",
    label: str = LABEL,
    horizon: int = HORIZON,
    keys: Sequence[str] = (),
    order: str = "bar",
    grain: str | None = None,
    **chunking,
) -> DataFrame:
    """New rows and every stored row whose label they can change.

    A row at one position only enters the labels of the ``horizon`` rows before
    it, so the stored rows from ``horizon`` before the first new row on are
    enough. A label once known is never replaced by null.
    """
    on = [*keys, order]
    stored = master.join(new_features.select(*on), on, "left_anti")
    old = F.col("_old")
    context = with_context(new_features, stored, horizon, keys=keys, order=order)
    if keys:
        firsts = new_features.groupBy(*keys).agg(F.min(order).alias("_first"))
        later = attach_group_value(stored, firsts, keys, order).where(F.col(order) > F.col("_first"))
        later = later.drop("_first")
    else:
        later = stored.where(F.col(order) > new_features.select(F.min(order)).scalar())
    rows = context.drop("is_context").unionByName(later, allowMissingColumns=True)
    labelled = forward_rv(
        rows.withColumnRenamed(label, "_old"),
        horizon,
        ret=ret,
        label=label,
        keys=keys,
        order=order,
        grain=grain,
        **chunking,
    )
    return labelled.withColumn(label, F.coalesce(label, old)).select(*master.columns)


def master_upsert(
    master: DataFrame,
    new_features: DataFrame,
    *,
    keys: Sequence[str] = (),
    order: str = "bar",
    **options,
) -> DataFrame:
    """The master table with new rows appended and waiting labels filled in.

    To update a large stored table, write :func:`master_changes` over the partitions
    it touches instead of rewriting the whole.
    """
    changes = master_changes(master, new_features, keys=keys, order=order, **options)
    on = [*keys, order]
    return master.join(changes.select(*on), on, "left_anti").unionByName(changes)


def upsert_partitions(path: str, new_features: DataFrame, by, *, keys: Sequence[str] = (), order: str = "bar", **options) -> versions.Version:
    """:func:`master_upsert` of a versioned table: only the partitions of new rows and of labels that they settle are written.

    Rows whose label stays as it is are no changes, so they touch no partition.
    """
    spark = new_features.sparkSession
    master = versions.read(spark, path)
    label = options.get("label", LABEL)
    on = [*keys, order]
    changes = stored(master_changes(master, new_features, keys=keys, order=order, **options), "changes")
    before = master.select(*[F.col(c).alias(f"_{c}") for c in on], F.col(label).alias("_was"))
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in on] + [F.col(label).eqNullSafe(F.col("_was"))]
    known = new_features.select(*on)
    fresh = changes.join(known, on, "left_semi")
    settled = changes.join(known, on, "left_anti").join(before, same, "left_anti")
    return versions.merge(fresh.unionByName(settled), path, by, order, on)


def ingest_range(
    manifest: DataFrame, partitions: DataFrame, default_start, today, *, by: str = "date"
) -> DataFrame:
    """One row (start, end, mode): manifest first, then partitions, then the default start."""
    tagged = manifest.select(F.col(by).alias("_d"), F.lit("m").alias("_from")).unionByName(
        partitions.select(F.col(by).alias("_d"), F.lit("p").alias("_from"))
    )
    latest = lambda source: F.max(F.when(F.col("_from") == source, F.col("_d")))
    marks = tagged.agg(latest("m").alias("_m"), latest("p").alias("_p"))
    last = F.coalesce("_m", "_p")
    end = F.lit(today).cast("date")
    start = F.coalesce(F.date_add(last, 1), F.lit(default_start).cast("date"))
    done = last.isNotNull() & (start >= end)
    return marks.select(
        F.when(~done, start).alias("start"),
        F.when(~done, end).alias("end"),
        F.when(last.isNull(), "full")
        .when(done, "up_to_date")
        .otherwise("incremental")
        .alias("mode"),
    )
