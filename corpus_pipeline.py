"""The corpus pipeline: language, toxicity, near-duplicates, decontamination, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the one before kept. All but
the last return the columns of ``docs``, whatever they are called: kept rows are chosen
by conditions on the text, or by a join on a key that is dropped again.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontam, jaccard, langid, packing, toxicity
from tidemark.llm.common import settled, table
from tidemark.sources.store import scratch_path

#: Keys of dropped rows up to this many are broadcast (24 bytes each); more are joined by shuffle.
BROADCAST_KEYS = 200_000

#: The near-duplicate stage follows op5's rule: words of a shingle, least similarity in percent.
SHINGLE, PERCENT = 3, 90


def _key() -> str:
    return f"key_{uuid.uuid4().hex}"


def _matched(docs: DataFrame, columns: list, keys: DataFrame, how: str) -> DataFrame:
    """``docs`` joined to the rows of ``keys``, whose columns ``columns`` are compared with, in order; null equals null."""
    keys = settled(keys.distinct())
    named = keys.toDF(*[_key() for _ in keys.columns])
    same = [c.eqNullSafe(F.col(k)) for c, k in zip(columns, named.columns)]
    if keys.count() <= BROADCAST_KEYS:
        named = F.broadcast(named)
    return docs.join(named, same, how)


def _without(docs: DataFrame, column, gone: DataFrame) -> DataFrame:
    """``docs`` without the rows whose ``column`` is the only column of ``gone``; null keys stay."""
    return _matched(docs, [column], gone.na.drop(), "left_anti")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts of no language and texts ambiguous between languages (learned from the labelled ones)."""
    return docs.where(~langid.rejects(docs, langid.fit(docs)))


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts that the lexicon, learned from the labelled ones, finds toxic."""
    lexicon = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return docs.where(~toxicity.rejects(docs, lexicon))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each similarity class of texts: that of the smallest doc_id (null last), then of the smallest MD5.

    The texts make the classes; a doc_id only decides which row of a class stays, so rows that share
    one are told apart, and rows without one are compared like all others. Equal rows are as many
    copies of one text. Null texts and texts without words belong to no class and stay. A text goes by a
    64-bit hash; texts that collide there (told by their MD5) stay as well.
    """
    mark = F.xxhash64(F.lit("text"), "text")
    keyed = docs.where(F.col("text").isNotNull()).select(mark.alias("id"), F.col("doc_id").alias("own"), "text")
    found = jaccard.similarity_classes(keyed.select(F.col("id").alias("doc_id"), "text"), shingle=SHINGLE, percent=PERCENT)
    classes = settled(found.where("n_shingles > 0").select(F.col("doc_id").alias("id"), "component_id").distinct())
    rows = settled(keyed.groupBy("id", "own").agg(F.count("*").alias("n"), F.min(F.md5("text")).alias("low"), F.max(F.md5("text")).alias("high")))
    best = F.min(F.struct(F.col("own").isNull().alias("none"), "own")).alias("best")
    texts = rows.groupBy("id").agg(best, F.min("low").alias("low"), F.max("high").alias("high")).where("low = high")
    texts = settled(texts.join(classes, "id"))
    kept = texts.groupBy("component_id").agg(F.min(F.struct("best", "low", "id")).alias("k"))
    kept = settled(kept.select(F.col("k.id").alias("kept_id"), F.col("k.best.own").alias("kept_own")))
    told = [F.col("id") == F.col("kept_id"), F.col("own").eqNullSafe(F.col("kept_own"))]
    gone = rows.join(texts.select("id"), "id", "left_semi").join(kept, told, "left_anti").select("id", "own")
    keys = [mark, docs["doc_id"]]
    out = _matched(docs, keys, gone, "left_anti")
    repeated = settled(rows.where("n > 1").join(kept, told, "left_semi").select("id", "own"))
    if repeated.isEmpty():
        return out
    names = _key(), _key()
    again = _matched(docs, keys, repeated, "left_semi").withColumns({names[0]: mark, names[1]: docs["doc_id"]})
    again = again.dropDuplicates(list(names)).select(*docs.columns)
    return _matched(out, keys, repeated, "left_anti").unionByName(again)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the contract's rule finds contaminated; the text decides, so equal texts go together."""
    keyed = docs.select(F.md5("text").alias("doc_id"), "text")
    found = decontam.contamination(keyed, table(spark, sf_dir, "benchmark"))
    return _without(docs, F.md5("text"), found.where("contaminated").select("doc_id"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in the packed sequences."""
    return packing.packed_documents(docs, specials=True)


STAGES = [
    ("language_id", language),
    ("toxicity", clean),
    ("jaccard_join", distinct),
    ("decontamination", decontaminated),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        out = stage(spark, docs, sf_dir)
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs


#: Learned decisions and differencing cannot be stated in SQL; tests hold the stages against brute force.
ORACLE_SQL = None
