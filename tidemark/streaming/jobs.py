"""The incremental chain as streams: late-row bars, feature updates, stateful features."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidemark.operators.features import DEFAULT_ROLES
from tidemark.operators.frames import last_rows
from tidemark.operators.incremental import CONTEXT_ROWS, incremental_features
from tidemark.sources.store import exists, stored

BATCH = "batch"


def streaming_bars(
    ticks: DataFrame,
    *,
    series: str,
    ts: str,
    value: str,
    every: str = "1 hour",
    late: str = "10 minutes",
) -> DataFrame:
    """OHLCV bars of a tick stream; a bar is final once the watermark has passed its end.

    Ticks later than ``late`` are ignored. Of ticks at one time the smallest opens and the largest
    closes a bar. Partial bars are combined before the
    shuffle, so the state holds one row per open (series, bar).
    """
    at = F.col(ts).cast("timestamp")
    timed = ticks.select(F.col(series).alias("series"), at.alias("_at"), F.col(value).alias("_v"))
    return (
        timed.withWatermark("_at", late)
        .groupBy("series", F.window("_at", every))
        .agg(
            F.min(F.struct("_at", "_v"))["_v"].alias("open"),
            F.max("_v").alias("high"),
            F.min("_v").alias("low"),
            F.max(F.struct("_at", "_v"))["_v"].alias("close"),
            F.count(F.lit(1)).cast("double").alias("volume"),
        )
        .select(
            "series",
            F.col("window.start").alias("bar"),
            "open",
            "high",
            "low",
            "close",
            F.col("close").alias("adj_close"),
            "volume",
        )
    )


def write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """Replace the partition of this batch: a repeated batch leaves one copy of its rows."""
    (
        df.withColumn(BATCH, F.lit(batch_id).cast("long"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(BATCH)
        .parquet(path)
    )


def feature_stream(
    spark: SparkSession,
    curated_path: str,
    features_path: str,
    checkpoint: str,
    schema,
    features_schema,
    roles: Mapping[str, str] = DEFAULT_ROLES,
    *,
    context: int = CONTEXT_ROWS,
    grain: str | None = None,
) -> StreamingQuery:
    """Process the curated files that have arrived since the last run, then stop.

    Each micro-batch runs the incremental feature job on the stored table. The
    checkpoint is the progress mark; a replayed batch ignores its own earlier
    output and writes the same partition again.
    """

    def run(arrived: DataFrame, batch_id: int) -> None:
        session = arrived.sparkSession
        reader = session.read.schema(f"{features_schema}, {BATCH} long")
        done = reader.option("ignoreMissingFiles", True).parquet(features_path)
        done = done.where(F.col(BATCH) != batch_id)
        curated = session.read.schema(schema).parquet(curated_path)
        write_batch(
            incremental_features(curated, done, roles, context=context, grain=grain),
            features_path,
            batch_id,
        )

    return (
        spark.readStream.schema(schema)
        .parquet(curated_path)
        .writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _tail_folders(session: SparkSession, path: str) -> list[int]:
    """Batches whose tails were written whole, oldest first."""
    folder = session._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(session._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return []
    names = [f.getPath().getName() for f in fs.listStatus(folder)]
    return sorted(int(n) for n in names if n.isdigit() and exists(session, f"{path}/{n}/_SUCCESS"))


def tail_batch(
    arrived: DataFrame,
    batch_id: int,
    out: str,
    state: str,
    update: Callable[[DataFrame], DataFrame],
    *,
    keys: Sequence[str] = ("series",),
    order: str = "bar",
    rows: int = CONTEXT_ROWS,
) -> None:
    """One batch of :func:`tail_stream`: the rows that arrived, after the tails of the batches before it."""
    session, keys = arrived.sparkSession, list(keys)
    known = [n for n in _tail_folders(session, f"{state}/tails") if n < batch_id]
    if known:
        tails = session.read.schema(arrived.schema).parquet(f"{state}/tails/{known[-1]}")
    else:
        tails = session.createDataFrame([], arrived.schema)
    marks = tails.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.max(order).alias("_mark"))
    helpers = [*(f"_{k}" for k in keys), "_mark"]
    new = F.col(order).isNotNull() & (F.col("_mark").isNull() | (F.col(order) > F.col("_mark")))

    def with_mark(df: DataFrame) -> DataFrame:
        return df.join(marks, [df[k].eqNullSafe(marks[f"_{k}"]) for k in keys], "left")

    marked = stored(with_mark(arrived), "arrived")
    write_batch(marked.where(~new).drop(*helpers), f"{state}/late", batch_id)
    both = tails.unionByName(marked.where(new).drop(*helpers))
    computed = with_mark(update(both)).where(new).drop(*helpers)
    write_batch(computed, out, batch_id)
    last_rows(both, keys, order, rows).drop("recency").write.mode("overwrite").parquet(f"{state}/tails/{batch_id}")
    for n in known[:-1]:
        old = session._jvm.org.apache.hadoop.fs.Path(f"{state}/tails/{n}")
        old.getFileSystem(session._jsc.hadoopConfiguration()).delete(old, True)


def tail_stream(
    spark: SparkSession,
    arrivals: str,
    out: str,
    state: str,
    checkpoint: str,
    schema,
    update: Callable[[DataFrame], DataFrame],
    *,
    keys: Sequence[str] = ("series",),
    order: str = "bar",
    rows: int = CONTEXT_ROWS,
    files: int | None = 1,
) -> StreamingQuery:
    """Rolling results of arriving files, each batch reading what arrived and a table of tails, then stop.

    The tails are the last ``rows`` rows of every key: as long as the keys are many, whatever the
    history. ``update`` turns rows of ``schema`` into results with the same keys and order, none of
    which looks back further than ``rows``; it never sees stored history or earlier results. A row
    at or before the last one of its key (late, or without a time) is not worked in: it is
    kept under ``state``/late for a batch job to repair. Rows of one batch need no order. A batch takes
    ``files`` files, or all that have arrived (None).

    A batch writes its own partition of ``out`` and its own tails and reads those of the batch
    before it, so a batch that failed half-way, or runs twice, leaves the same files.
    """

    def run(arrived: DataFrame, batch_id: int) -> None:
        tail_batch(arrived, batch_id, out, state, update, keys=keys, order=order, rows=rows)

    reader = spark.readStream.schema(schema)
    if files is not None:
        reader = reader.option("maxFilesPerTrigger", files)
    return (
        reader.parquet(arrivals)
        .writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


#: Rows of a state are kept as the bytes of their doubles (and longs): one value each to write and read, not one a row.
STATE_SCHEMA = "rets binary"


def _volatilities(x: np.ndarray, new: int, windows: Sequence[int]) -> dict[str, np.ndarray]:
    """Root of the summed squares over the last n values, for the last ``new`` of ``x``; NaN without n finite ones."""
    squares = x * x
    squares[np.isinf(squares)] = np.nan
    out = {}
    for n in windows:
        seen = squares[max(len(x) - new - n + 1, 0) :]
        vol = np.full(new, np.nan)
        if len(seen) >= n:
            sums = np.lib.stride_tricks.sliding_window_view(seen, n).sum(axis=1)
            vol[new - len(sums) :] = np.sqrt(sums)
        out[f"vol_{n}"] = vol
    return out


def _by_time(times: pd.Series) -> np.ndarray:
    """Positions in order of time, rows without one last."""
    if times.dtype == object:
        return times.reset_index(drop=True).sort_values(kind="stable").index.to_numpy()
    return np.argsort(times.to_numpy(), kind="stable")


def rolling_state(
    curated: DataFrame,
    windows: Sequence[int] = (5, 20, 60),
    *,
    series: str = "series",
    order: str = "bar",
    ret: str = "ret",
) -> DataFrame:
    """Rolling volatility of a stream of returns, the last rows of each series kept as state.

    Within a micro-batch the rows of a series are ordered by time; across batches
    they must arrive in order. State per series is bounded by the longest window, the
    rows a task sees at once by the source's rate limit (``maxFilesPerTrigger``). For a
    backlog use :func:`feature_stream`, whose frames are split like any batch job's.
    """
    keep = max(windows) - 1
    kinds = {f.name: f.dataType.simpleString() for f in curated.schema.fields}
    out = f"{series} {kinds[series]}, {order} {kinds[order]}, " + ", ".join(
        f"vol_{n} double" for n in windows
    )

    def update(
        key: tuple, batches: Iterable[pd.DataFrame], state: GroupState
    ) -> Iterator[pd.DataFrame]:
        frames = list(batches)
        rows = frames[0] if len(frames) == 1 else pd.concat(frames)
        at = _by_time(rows[order])
        past = np.frombuffer(state.get[0] if state.exists else b"", dtype=float)
        x = np.concatenate([past, rows[ret].to_numpy(dtype=float)[at]])
        new = len(rows)
        state.update((x[-keep:].tobytes(),))
        yield pd.DataFrame({series: [key[0]] * new, order: rows[order].to_numpy()[at], **_volatilities(x, new, windows)})

    return curated.select(series, order, ret).groupBy(series).applyInPandasWithState(
        update, out, STATE_SCHEMA, "append", GroupStateTimeout.NoTimeout
    )


ORDERED_STATE = "pending_at binary, pending binary, tail binary, last bigint"


def ordered_volatility(
    curated: DataFrame,
    windows: Sequence[int] = (5, 20, 60),
    *,
    series: str = "series",
    order: str = "bar",
    ret: str = "ret",
    late: str = "7 days",
    idle_days: int = 365,
) -> DataFrame:
    """Rolling volatility of a stream whose rows come out of order, up to ``late``.

    A row waits in the state until the watermark has passed it, then rows leave in order
    of time with the values that a batch job gives them, in whatever micro-batches they
    came. Rows behind the watermark, or at a time that has left already, are ignored. A
    series without rows for ``idle_days`` of event time is forgotten and begins anew. State
    per series: the longest window's rows and those of ``late``.
    """
    keep, idle = max(windows) - 1, idle_days * 86_400_000_000
    kind = curated.schema[series].dataType.simpleString()
    out = f"{series} {kind}, {order} timestamp, " + ", ".join(f"vol_{n} double" for n in windows)

    def update(key: tuple, batches: Iterable[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        at, waiting, tail, last = state.get if state.exists else (b"", b"", b"", None)
        mark = state.getCurrentWatermarkMs() * 1000
        times, values = [np.frombuffer(at, dtype="int64")], [np.frombuffer(waiting, dtype=float)]
        for rows in () if state.hasTimedOut else batches:
            came = rows["_at"].to_numpy().astype("datetime64[us]").astype("int64")
            fresh = (came > mark) | (mark <= 0)
            if last is not None:
                fresh &= came > last
            times.append(came[fresh])
            values.append(rows[ret].to_numpy(dtype=float)[fresh])
        at, waiting = np.concatenate(times), np.concatenate(values)
        due = at <= mark
        if due.any():
            by_time = np.argsort(at[due], kind="stable")
            left = at[due][by_time]
            x = np.concatenate([np.frombuffer(tail, dtype=float), waiting[due][by_time]])
            bars = pd.DatetimeIndex(left.astype("datetime64[us]")).tz_localize("UTC")
            tail, last = x[-keep:].tobytes(), int(left[-1])
            yield pd.DataFrame({series: [key[0]] * len(left), order: bars, **_volatilities(x, len(left), windows)})
        at, waiting = at[~due], waiting[~due]
        if not len(at) and last is not None and mark >= last + idle:
            state.remove()
            return
        state.update((at.tobytes(), waiting.tobytes(), tail, last))
        due_next = int(at.min()) if len(at) else (last or 0) + idle
        state.setTimeoutTimestamp(max(due_next // 1000, mark // 1000) + 1)

    timed = curated.select(series, F.col(order).cast("timestamp").alias("_at"), F.col(ret).cast("double").alias(ret))
    return (
        timed.withWatermark("_at", late)
        .groupBy(series)
        .applyInPandasWithState(update, out, ORDERED_STATE, "append", GroupStateTimeout.EventTimeTimeout)
    )
