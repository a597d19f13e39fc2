"""Small inputs and plain brute-force versions for the tests of the training-data operators."""

import random
import re

WORDS6 = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
WORDS5 = re.compile(r"[^\x20\x09-\x0D]+")


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def sentence(rng: random.Random, n: int, words: int = 400) -> str:
    return " ".join(f"w{rng.randrange(words)}" for _ in range(n))


def docs_frame(spark, rows, extra=True):
    """(doc_id, text) rows as a documents table, with columns whose names the operators use themselves."""
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    full = [(i, t, "en", "s", len(t or "")) for i, t in rows]
    df = spark.createDataFrame(full, schema)
    if extra:
        from pyspark.sql import functions as F

        for name in ("row", "n", "key", "hits", "component_id", "label", "_pid", "_local", "length", "shard", "score", "id", "digest"):
            df = df.withColumn(name, F.lit("clash"))
    return df
