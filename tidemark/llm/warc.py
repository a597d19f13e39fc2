"""Merkle fixity audit of WARC records.

A record is known by its archive, offset, length and SHA-256. A tree per archive and
replica: a leaf covers the records that begin in one range of ``LEAF_BYTES`` offsets, a
node the ``FANOUT`` ranges below it, the root the archive; each hashes what it covers in
order of offset. Ranges are fixed by offsets, so a long archive is many groups and no
task sees all of it. Two replicas are compared root by root; only below mismatching
nodes are children compared, down to the records that differ.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import arrow_map, settled

LEAF_BYTES = 1 << 16
FANOUT = 16
#: Pages of one archive, by page_id.
PER_ARCHIVE = 256
END = "\r\n\r\n"
#: A capture's date when the table has none.
DATE = "1970-01-01T00:00:00Z"


def _record(pages: DataFrame, page_id: str, url: str, html: str, per_archive: int) -> DataFrame:
    """(archive, page_id, url, payload, length, record, sha256) of each page."""
    p = pages.select(F.col(page_id).cast("long").alias("page_id"), F.coalesce(F.col(url).cast("string"), F.lit("")).alias("url"), F.coalesce(F.col(html), F.lit("")).alias("html"))
    uri = F.regexp_replace("url", r"[\r\n]", "%0A")
    record = F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: resource\r\nWARC-Target-URI: "), uri, F.lit(f"\r\nWARC-Date: {DATE}\r\nWARC-Record-ID: <urn:sha256:"), F.sha2("html", 256),
        F.lit(">\r\nContent-Type: text/html\r\nContent-Length: "), F.octet_length("html").cast("string"), F.lit(END), F.col("html"),
    )
    rows = p.select(F.floor(F.col("page_id") / per_archive).cast("long").alias("archive"), "page_id", "url", F.octet_length("html").cast("long").alias("payload"), record.alias("record"))
    return rows.withColumn("length", (F.octet_length("record") + len(END)).cast("long")).withColumn("sha256", digest(F.col("record")))


def digest(record):
    """SHA-256 of a record with its closing blank lines."""
    return F.sha2(F.concat(record, F.lit(END)), 256)


def _laid_out(rows: DataFrame) -> DataFrame:
    """Adds ``offset``, from totals of pieces of archives, so that no task holds a whole one.

    A piece is an archive's part of one range of all rows in order; rows that are equal
    throughout may be in several. The ranges are dealt once and kept in the shared folder.
    """
    order = ["page_id", "url", "sha256"]
    ranges = rows.withColumn("_tie", F.rand(0)).repartitionByRange("archive", *order, "_tie").drop("_tie")
    dealt = settled(ranges.withColumn("_piece", F.spark_partition_id()))
    before = lambda by: by.rowsBetween(Window.unboundedPreceding, -1)
    sizes = dealt.groupBy(F.col("archive").alias("_archive"), F.col("_piece").alias("_at")).agg(F.sum("length").alias("_size"))
    starts = sizes.withColumn("_start", F.coalesce(F.sum("_size").over(before(Window.partitionBy("_archive").orderBy("_at"))), F.lit(0)))
    inner = F.coalesce(F.sum("length").over(before(Window.partitionBy("archive", "_piece").orderBy(*order))), F.lit(0))
    placed = dealt.withColumn("_inner", inner).join(starts, F.col("archive").eqNullSafe(F.col("_archive")) & (F.col("_piece") == F.col("_at")))
    return placed.select(*rows.columns, (F.col("_start") + F.col("_inner")).cast("long").alias("offset"))


def records(pages: DataFrame, *, page_id: str = "page_id", url: str = "url", html: str = "html", per_archive: int = PER_ARCHIVE) -> DataFrame:
    """(archive, page_id, offset, length, payload, sha256, record): a WARC resource record for each page, laid out in archives.

    Archive: page_id in steps of ``per_archive`` (null ids have one of their own, null); order:
    page_id, url, digest. Null urls and pages are empty; repeated rows are records each.
    ``record`` is without its closing blank lines, ``length`` and ``sha256`` count them;
    ``payload`` is the page's bytes.
    """
    return _laid_out(_record(pages, page_id, url, html, per_archive)).drop("url")


def fixity(pages: DataFrame, more=None, *, page_id: str = "page_id", url: str = "url", html: str = "html", per_archive: int = PER_ARCHIVE) -> DataFrame:
    """``records`` without the records themselves: only their digests are shuffled into archives.

    ``more``: further columns by name, computed from the columns of ``records`` but offset.
    """
    rows = _record(pages, page_id, url, html, per_archive).withColumns(more or {}).drop("record")
    return _laid_out(rows).drop("url")


def write_archives(rows: DataFrame, path: str) -> None:
    """One folder ``archive=<n>`` with a WARC file of the records in order of offset."""
    (
        rows.repartition("archive").sortWithinPartitions("archive", "offset").select("archive", "record")
        .write.partitionBy("archive").option("lineSep", END).text(path)
    )


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """(archive, offset, length, sha256) of the records in the files that ``write_archives`` laid out.

    A record that is cut short, or whose header cannot be read, ends its file: what is
    left of the file is one record. Files are read whole, so archives must be of bounded size.
    """
    head = re.compile(rb"WARC/1\.\d\r\n(?:[^\r\n]+\r\n)*?Content-Length: *(\d+)\r\n(?:[^\r\n]+\r\n)*\r\n", re.I)

    def parse(batches):
        for batch in batches:
            out = []
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = re.search(r"archive=(-?\d+)/", name)
                at = 0
                while at < len(data):
                    m = head.match(data, at)
                    end = m.end() + int(m[1]) + len(END) if m else len(data)
                    end = end if data[end - len(END) : end] == END.encode() else len(data)
                    out.append((int(found[1]) if found else None, at, end - at, hashlib.sha256(data[at:end]).hexdigest()))
                    at = end
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names=["archive", "offset", "length", "sha256"])

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "content")
    return arrow_map(files, parse, "archive bigint, offset bigint, length bigint, sha256 string")


def _hashed(rows: DataFrame, node, *key: str) -> DataFrame:
    """Groups rows under ``node``: the hash of their hashes in order."""
    parts = F.array_sort(F.collect_list(F.struct(*key, "sha256")))
    joined = F.array_join(F.transform(parts, lambda p: p["sha256"]), "")
    return rows.groupBy("archive", node.alias("node")).agg(F.sha2(joined, 256).alias("sha256"))


def tree(rows: DataFrame, *, leaf_bytes: int = LEAF_BYTES, fanout: int = FANOUT, levels: int) -> list[DataFrame]:
    """Levels of (archive, node, sha256) from the leaves up; the last is the roots. Each is kept in the shared folder."""
    out = [settled(_hashed(rows, F.floor(F.col("offset") / leaf_bytes).cast("long"), "offset", "length"))]
    for _ in range(levels):
        out.append(settled(_hashed(out[-1], F.floor(F.col("node") / fanout).cast("long"), "node")))
    return out


def audit(source: DataFrame, replica: DataFrame, *, leaf_bytes: int = LEAF_BYTES, fanout: int = FANOUT) -> DataFrame:
    """(archive, offset, status) of the records that differ: ``changed``, ``missing`` (from the replica) or ``extra``.

    Inputs have archive, offset, length, sha256. Rows of one archive and offset are one
    record each: several of them match if their sorted hashes do. Null archives are an
    archive of their own. Empty replicas miss everything.
    """
    last = max(df.agg(F.max("offset")).first()[0] or 0 for df in (source, replica))
    levels, nodes = 0, last // leaf_bytes + 1
    while nodes > 1:
        levels, nodes = levels + 1, -(-nodes // fanout)
    own, other = (tree(df, leaf_bytes=leaf_bytes, fanout=fanout, levels=levels) for df in (source, replica))
    bad = None
    for a, b in zip(reversed(own), reversed(other)):
        if bad is not None:  # only the children of mismatching nodes
            parent = (F.floor(F.col("node") / fanout).cast("long")).alias("parent")
            a, b = (_below(df.select("*", parent), bad) for df in (a, b))
        bad = settled(_mismatches(a, b))
    leaf = F.floor(F.col("offset") / leaf_bytes).cast("long").alias("parent")

    def suspects(df):
        kept = _below(df.select("archive", "offset", "length", "sha256", leaf), bad)
        return kept.groupBy("archive", "offset").agg(F.array_join(F.array_sort(F.collect_list("sha256")), "").alias("sha256"))

    a, b = suspects(source).alias("a"), suspects(replica).alias("b")
    status = F.when(F.col("b.sha256").isNull(), "missing").when(F.col("a.sha256").isNull(), "extra").otherwise("changed")
    return (
        a.join(b, F.col("a.archive").eqNullSafe(F.col("b.archive")) & (F.col("a.offset") == F.col("b.offset")), "full")
        .where(~F.col("a.sha256").eqNullSafe(F.col("b.sha256")))
        .select(F.coalesce("a.archive", "b.archive").alias("archive"), F.coalesce("a.offset", "b.offset").alias("offset"), status.alias("status"))
    )


def _below(rows: DataFrame, bad: DataFrame) -> DataFrame:
    """Rows whose parent is among the mismatching nodes."""
    b = bad.select(F.col("archive").alias("bad_archive"), F.col("node").alias("bad_node"))
    return rows.join(b, rows["archive"].eqNullSafe(b["bad_archive"]) & (rows["parent"] == b["bad_node"]), "left_semi").drop("parent")


def _mismatches(a: DataFrame, b: DataFrame) -> DataFrame:
    """(archive, node) whose hashes differ or that one side lacks."""
    a, b = a.alias("a"), b.alias("b")
    same = F.col("a.archive").eqNullSafe(F.col("b.archive")) & (F.col("a.node") == F.col("b.node"))
    return (
        a.join(b, same, "full").where(~F.col("a.sha256").eqNullSafe(F.col("b.sha256")))
        .select(F.coalesce("a.archive", "b.archive").alias("archive"), F.coalesce("a.node", "b.node").alias("node"))
    )
