"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources import workers
from tidemark.sources.store import scratch_root

#: Text bytes that a Python step looks at together.
CHUNK = 1 << 21


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows of an Arrow batch, at most: a batch of whole texts must fit beside the executor's heap.
BATCH_ROWS = 1000
BATCH_KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"


def shipped(spark: SparkSession) -> None:
    """Hand this package to the Python workers, once per application (Spark's file server delivers it).

    Also lowers the session's Arrow batch to ``BATCH_ROWS`` rows where it is larger.
    """
    if not 0 < int(spark.conf.get(BATCH_KEY)) <= BATCH_ROWS:
        spark.conf.set(BATCH_KEY, str(BATCH_ROWS))
    workers.shipped(spark)


def arrow_map(df: DataFrame, f, schema) -> DataFrame:
    """``df.mapInArrow`` with this package on the workers."""
    shipped(df.sparkSession)
    return df.mapInArrow(f, schema)


def arrow_groups(df: DataFrame, keys: list[str], f, schema) -> DataFrame:
    """``groupBy(keys).applyInArrow`` with this package on the workers."""
    shipped(df.sparkSession)
    return df.groupBy(*keys).applyInArrow(f, schema)


def settled(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared folder of ``spark.checkpoint.dir``.

    Spark removes the files when the frame is no longer referenced, if
    ``spark.cleaner.referenceTracking.cleanCheckpoints`` is on.
    """
    sc = df.sparkSession.sparkContext
    root = scratch_root(df.sparkSession)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return df.checkpoint()


def crc_mod(column, n: int):
    """crc32 of the column as text, modulo ``n``; null stays null."""
    return F.crc32(F.col(column).cast("string")) % n


def text_chunks(column: pa.Array, size: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, row bounds in them) of whole texts, about ``size`` bytes at a time.

    A null text is empty. One text longer than ``size`` comes alone.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    n = len(column)
    if n == 0:
        return
    wide = pa.types.is_large_string(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)
    offsets = offsets[column.offset : column.offset + n + 1].astype(np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        end = int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1
        end = min(max(end, first + 1), n)
        at = offsets[first : end + 1]
        yield first, end, data[at[0] : at[-1]], at - at[0]
        first = end


def counted_up(df: DataFrame, by: str) -> DataFrame:
    """Adds ``_pid`` and ``_local``: the row's number among the rows of its partition with its ``by``.

    ``by`` is an integer column of few values (shards, lengths) without nulls.
    """
    schema = T.StructType([*df.schema.fields, T.StructField("_pid", T.LongType()), T.StructField("_local", T.LongType())])

    def count(batches):
        from pyspark import TaskContext

        pid = TaskContext.get().partitionId()
        seen: dict[int, int] = {}
        for batch in batches:
            local = running_counts(batch.column(by).to_numpy(zero_copy_only=False), seen)
            columns = [*batch.columns, pa.array(np.full(batch.num_rows, pid, np.int64)), pa.array(local)]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "_pid", "_local"])

    return arrow_map(df, count, schema)


def running_counts(keys: np.ndarray, seen: dict[int, int]) -> np.ndarray:
    """How many equal keys came before each key, here and in ``seen``, which is updated."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    fresh = np.ones(len(keys), bool)
    fresh[1:] = ordered[1:] != ordered[:-1]
    starts = np.flatnonzero(fresh)
    sizes = np.diff(np.append(starts, len(keys)))
    values = ordered[starts].tolist()
    before = np.array([seen.get(k, 0) for k in values], np.int64)
    local = np.empty(len(keys), np.int64)
    local[order] = np.arange(len(keys)) - np.repeat(starts - before, sizes)
    for k, n in zip(values, sizes.tolist()):
        seen[k] = seen.get(k, 0) + n
    return local


def starts_of(marked: DataFrame, by: str) -> DataFrame:
    """(by, _pid, _start): the number at which a partition's count of its ``by`` begins."""
    before = Window.partitionBy(by).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    sizes = marked.groupBy(by, "_pid").agg((F.max("_local") + 1).alias("_n"))
    return sizes.select(by, "_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).cast("long").alias("_start"))


def numbered(df: DataFrame, by: str, name: str) -> DataFrame:
    """Adds ``name``: gapless numbers from 0 within each value of ``by``, in any order.

    No task sees a whole group: rows are counted where they lie, and partition
    totals are added up apart (one row per partition and group).
    """
    marked = settled(counted_up(df, by))
    return (
        marked.join(starts_of(marked, by), [by, "_pid"])
        .withColumn(name, F.col("_start") + F.col("_local"))
        .drop("_pid", "_local", "_start")
    )
