"""Partitioned tables, manifests, run logs and documents on the shared file system."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.scalars import bar_start, iso_date, partition_value

CHECKPOINT_KEY = "spark.checkpoint.dir"


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by the cluster; a temporary one only for a local master."""
    sc = spark.sparkContext
    named = (
        spark.conf.get(CHECKPOINT_KEY, None)
        or sc.getConf().get(CHECKPOINT_KEY)
        or sc.getCheckpointDir()
    )
    if named:
        return named
    if not sc.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_KEY} to a folder that all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-"))
    return sc.getCheckpointDir()


def _own_scratch(spark: SparkSession) -> str:
    return f"{scratch_root(spark).rstrip('/')}/tidemark/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the scratch root; :func:`drop_scratch` removes it."""
    return f"{_own_scratch(spark)}/{name}-{uuid.uuid4().hex}"


def drop(spark: SparkSession, path: str) -> None:
    """Remove a folder of files that nothing reads any more."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    found.getFileSystem(spark._jsc.hadoopConfiguration()).delete(found, True)


def drop_scratch(spark: SparkSession) -> None:
    """Remove all that this application wrote below the scratch root; results read from there end with it."""
    drop(spark, _own_scratch(spark))


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, in whatever store Spark reads it from."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()).exists(found)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and read it back: later plans start from files, not from its lineage."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_partitions(
    df: DataFrame, path: str, *, order: str = "date", by: str = "date", unit: str | None = None
) -> None:
    """Replace the partitions present in ``df``; others stay.

    ``unit`` ("month", say) coarsens the partition key: one small file per day is
    the worst layout for a long table. Rows are rebalanced by the key, which
    splits a partition that is far larger than the rest over several files.
    """
    key = bar_start(F.col(order), unit, df.schema[order].dataType) if unit else F.col(order)
    (
        df.withColumn(by, iso_date(key) if by != order or unit else F.col(order))
        .hint("rebalance", F.col(by))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(by)
        .parquet(path)
    )


def read_partitions(
    spark: SparkSession, path: str, schema=None, *, tolerant: bool = False
) -> DataFrame:
    """Read a partitioned table; ``tolerant`` skips missing and corrupt files."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    if tolerant:
        reader = reader.option("ignoreMissingFiles", True).option("ignoreCorruptFiles", True)
    return reader.parquet(path)


def partition_dates(df: DataFrame, by: str = "date") -> DataFrame:
    """Distinct partition values: a scan of that column alone. A versioned table lists them from its manifest."""
    return df.select(by).distinct()


def partition_facts(spark: SparkSession, path: str, order: str, by: str = "date", schema=None) -> DataFrame:
    """(by, rows, first, last) of a partitioned table's partitions, from file footers: no row is read.

    Counts and ranges of numbers and dates are pushed into the reader; for another type of
    ``order`` (times, text) the footers do not tell, and Spark scans that column.
    """
    facts = scratch_path(spark, "facts")
    footer_facts(spark, path, order, by, schema).write.parquet(facts)
    return spark.read.parquet(facts)


def footer_facts(spark: SparkSession, path: str, order: str, by: str = "date", schema=None) -> DataFrame:
    """The plan of :func:`partition_facts`, in a session of its own whose parquet reader answers aggregates."""
    session = spark.newSession()
    session.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    session.conf.set("spark.sql.sources.useV1SourceList", "")
    session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    reader = session.read if schema is None else session.read.schema(schema)
    facts = [F.count(F.lit(1)).alias("rows"), F.min(order).alias("first"), F.max(order).alias("last")]
    return reader.parquet(path).groupBy(by).agg(*facts)


def folder_dates(folders: DataFrame, path: str = "path", key: str = "date") -> DataFrame:
    """Partition values spelled in folder names; other folders are ignored."""
    value = partition_value(F.col(path), key)
    return folders.select(value.alias(key)).where(F.col(key).isNotNull()).distinct()


def missing_partitions(wanted: DataFrame, present: DataFrame, by: str = "date") -> DataFrame:
    """Wanted partitions the table does not have."""
    return wanted.select(by).distinct().join(present.select(by).distinct(), by, "left_anti")


def read_by_dates(table: DataFrame, wanted: DataFrame, by: str = "date") -> DataFrame:
    """Rows of the wanted partitions only (pruned at run time from the list)."""
    return table.join(wanted.select(by).distinct(), by, "left_semi")


def merge_manifest(*sources: DataFrame, by: str = "date") -> DataFrame:
    """Union of the dates known to a manifest, found on disk and newly written."""
    dates = [s.select(by) for s in sources]
    out = dates[0]
    for d in dates[1:]:
        out = out.unionByName(d)
    return out.distinct()


def dataset_status(datasets: dict[str, DataFrame], order: str = "bar") -> DataFrame:
    """(dataset, last_date, rows, partitions) over all named datasets."""
    out = None
    for name, df in datasets.items():
        one = df.agg(
            F.max(order).alias("last_date"),
            F.min(order).alias("first_date"),
            F.count(F.lit(1)).alias("rows"),
            F.count_distinct(F.to_date(order)).alias("dates"),
        ).select(F.lit(name).alias("dataset"), "first_date", "last_date", "rows", "dates")
        out = one if out is None else out.unionByName(one)
    return out


def legacy_status(flat: DataFrame) -> DataFrame:
    """Flat status record (``<dataset>_last_date``, ``<dataset>_rows``) -> one row per dataset."""
    names = sorted({c.removesuffix("_last_date") for c in flat.columns if c.endswith("_last_date")})
    out = None
    for name in names:
        rows = F.col(f"{name}_rows") if f"{name}_rows" in flat.columns else F.lit(None)
        one = flat.select(
            F.lit(name).alias("dataset"),
            F.col(f"{name}_last_date").alias("last_date"),
            rows.cast("long").alias("rows"),
        )
        out = one if out is None else out.unionByName(one)
    return out


def append_records(df: DataFrame, path: str) -> None:
    """Append one JSON line per row."""
    df.write.mode("append").json(path)


def read_records(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).json(path)


# Fixed fields of one forecast in the history.
HISTORY_FIELDS = {
    "prediction_date": "string",
    "predicted_volatility": "double",
    "features_date": "string",
    "model_path": "string",
    "prediction_timestamp": "string",
}


def prediction_history(predictions: DataFrame) -> DataFrame:
    """All published forecasts with the history fields in their stored types."""
    return predictions.select(
        [F.col(name).cast(kind).alias(name) for name, kind in HISTORY_FIELDS.items()]
    )


def latest_snapshot(df: DataFrame, run: str = "run_date") -> DataFrame:
    """Rows of the newest run; a one-value subquery prunes the run partitions."""
    newest = df.select(F.max(run).alias("newest")).scalar()
    return df.where(F.col(run) == newest)


def write_documents(documents: DataFrame, path: str, body: str = "document") -> None:
    """One JSON document per row as text."""
    documents.select(body).write.mode("overwrite").text(path)


def export_splits(df: DataFrame, path: str, *, order: str, label: str, split: str = "split"):
    """Row index (CSV), features and labels (parquet), each partitioned by split."""
    features = [c for c in df.columns if c not in (order, label)]
    df.select(order, split).write.mode("overwrite").partitionBy(split).csv(
        f"{path}/indices", header=True
    )
    df.select(order, *features).write.mode("overwrite").partitionBy(split).parquet(f"{path}/x")
    df.select(order, label, split).write.mode("overwrite").partitionBy(split).parquet(f"{path}/y")


def union_layers(layers: Sequence[DataFrame]) -> DataFrame:
    """Stack frames by column name; columns missing from one layer become null."""
    out = layers[0]
    for layer in layers[1:]:
        out = out.unionByName(layer, allowMissingColumns=True)
    return out
