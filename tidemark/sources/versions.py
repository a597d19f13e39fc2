"""Versioned tables: new files first, then one atomic switch of the manifest.

A version is a manifest: one JSON line for each partition with the folder that holds it, its
rows and its range. A writer puts new partitions into a folder of its own commit and then
creates the next manifest, which fails if another writer was first. Readers take the
highest manifest, so they see one version; a writer that dies leaves the table as it was.
Partitions that a commit does not touch keep their folders. Listings, counts and ranges
come from the manifest, without a scan.

``by`` names partitions (a date cut to its month, say): as many as the calendar has, however
many rows there are.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PART = "_part"


class Conflict(RuntimeError):
    """Another writer has made the version that this one was about to make."""


class Version(NamedTuple):
    number: int
    schema: T.StructType | None
    parts: dict[str, dict]  # partition -> folder, rows, first, last


def _named(by):
    return (F.expr(by) if isinstance(by, str) else by).cast("string").alias(PART)


def _hadoop(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def current(spark: SparkSession, path: str, number: int | None = None) -> Version:
    """The newest version, or the one of that number; number 0 and no partitions where there is no table."""
    fs, folder = _hadoop(spark, f"{path}/manifest")
    if not fs.exists(folder):
        return Version(0, None, {})
    found = sorted(int(f.getPath().getName()) for f in fs.listStatus(folder) if f.getPath().getName().isdigit())
    if number is None:
        number = found[-1] if found else 0
    if number == 0:
        return Version(0, None, {})
    if number not in found:
        raise ValueError(f"{path} has no version {number}")
    head, *lines = [r[0] for r in spark.read.text(f"{path}/manifest/{number:012d}").coalesce(1).collect()]  # one line for each partition
    parts = {x.pop("part"): x for x in map(json.loads, lines)}
    return Version(number, T.StructType.fromJson(json.loads(head)), parts)


def _commit(spark: SparkSession, path: str, version: Version) -> None:
    """Creates the version's manifest, whole or not at all."""
    fs, target = _hadoop(spark, f"{path}/manifest/{version.number:012d}")
    _, draft = _hadoop(spark, f"{path}/manifest/_{uuid.uuid4().hex}")
    fs.mkdirs(target.getParent())
    out = fs.create(draft, False)
    lines = [version.schema.json(), *(json.dumps({"part": p, **x}) for p, x in sorted(version.parts.items()))]
    out.write("\n".join(lines).encode())
    out.close()
    if fs.exists(target) or not fs.rename(draft, target):
        fs.delete(draft, False)
        raise Conflict(f"version {version.number} of {path} is there already")


def read(spark: SparkSession, path: str, *, parts: Iterable[str] | None = None, number: int | None = None) -> DataFrame:
    """One version of the table; with ``parts`` only those partitions, whose folders alone are listed."""
    version = current(spark, path, number)
    if version.schema is None:
        raise ValueError(f"{path} has no version")
    wanted = version.parts if parts is None else {p: version.parts[p] for p in parts if p in version.parts}
    folders = sorted(x["folder"] for x in wanted.values())
    if not folders:
        return spark.createDataFrame([], version.schema)
    return spark.read.schema(version.schema).parquet(*[f"{path}/data/{f}" for f in folders])


def _written(df: DataFrame, path: str, by, order: str) -> dict[str, dict]:
    """Writes partitions into a new folder; their entries of the manifest."""
    spark, commit = df.sparkSession, uuid.uuid4().hex
    marked = df.withColumn(PART, _named(by))
    marked.hint("rebalance", F.col(PART)).write.partitionBy(PART).parquet(f"{path}/data/{commit}")
    there = spark.read.schema(T.StructType([*df.schema.fields, T.StructField(PART, T.StringType())])).parquet(f"{path}/data/{commit}")
    facts = there.groupBy(PART).agg(F.count(F.lit(1)).alias("n"), F.min(order).cast("string").alias("first"), F.max(order).cast("string").alias("last"))
    fs, root = _hadoop(spark, f"{path}/data/{commit}")
    names = {spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName(f.getPath().getName().split("=", 1)[1]): f.getPath().getName() for f in fs.listStatus(root) if f.isDirectory()}
    return {r[PART]: {"folder": f"{commit}/{names[r[PART]]}", "rows": r["n"], "first": r["first"], "last": r["last"]} for r in facts.collect()}


def create(df: DataFrame, path: str, by, order: str) -> Version:
    """The first version. ``by``: the expression (or its SQL) that names a row's partition, never null."""
    version = Version(1, df.schema, _written(df, path, by, order))
    _commit(df.sparkSession, path, version)
    return version


def merge(changes: DataFrame, path: str, by, order: str, on: Sequence[str]) -> Version:
    """The next version: ``changes`` in place of rows of the same keys ``on``, and new ones added.

    A key must lie in one partition (``by`` follows from ``on``). Only partitions that changes
    fall into are read and written; without changes there is no new version. A key that
    repeats in ``changes`` is not told apart: deduplicate before.
    """
    spark = changes.sparkSession
    base = current(spark, path)
    if base.schema is None:
        raise ValueError(f"{path} has no version")
    changes = changes.select(*base.schema.names)
    touched = [r[0] for r in changes.select(_named(by)).distinct().collect()]  # partitions
    if not touched:
        return base
    old = read(spark, path, parts=touched, number=base.number)
    same = [old[c].eqNullSafe(F.col(f"_{c}")) for c in on]
    kept = old.join(changes.select(*[F.col(c).alias(f"_{c}") for c in on]).distinct(), same, "left_anti")
    version = Version(base.number + 1, base.schema, {**base.parts, **_written(kept.unionByName(changes), path, by, order)})
    _commit(spark, path, version)
    return version


def partitions(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """(part, rows, first, last) of a version, from its manifest alone."""
    parts = current(spark, path, number).parts
    rows = [(p, x["rows"], x["first"], x["last"]) for p, x in sorted(parts.items())]
    return spark.createDataFrame(rows, "part string, rows bigint, first string, last string")


def drop_unused(spark: SparkSession, path: str, keep: int = 1) -> int:
    """Deletes partition folders that none of the last ``keep`` versions names, and older manifests; how many folders went.

    Call it when no reader of an older version and no writer is at work.
    """
    newest = current(spark, path).number
    kept = [current(spark, path, n) for n in range(max(1, newest - keep + 1), newest + 1)]
    used = {x["folder"] for v in kept for x in v.parts.values()}
    fs, root = _hadoop(spark, f"{path}/data")
    gone = 0
    for commit in fs.listStatus(root):
        for part in fs.listStatus(commit.getPath()):
            name = f"{commit.getPath().getName()}/{part.getPath().getName()}"
            if part.isDirectory() and name not in used:
                fs.delete(part.getPath(), True)
                gone += 1
    for n in range(1, newest - keep + 1):
        fs.delete(_hadoop(spark, f"{path}/manifest/{n:012d}")[1], False)
    return gone
