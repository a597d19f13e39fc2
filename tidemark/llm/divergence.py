"""Source divergence audit: how the sources of a language differ in their use of terms.

Terms are runs of letters (A-Z as a-z, and all signs beyond ASCII). A language keeps the
terms found in at least ``least`` of its documents. In exact whole numbers, a group of
N kept occurrences gives a kept term p = 1 + floor(10^9 * (count + 1) / (N + V)), V the
language's kept terms; p diverges from q by floor((p - q)^2 / q).

1. Counting is an Arrow pipeline inside mapInArrow: ``ascii_lower``,
   ``split_pattern_regex``, ``dictionary_encode`` and hash ``group_by``, first by (document,
   term), then by (group, term). A task merges its counts and hands them on when they
   grow over ``HELD`` bytes, so memory is bounded.
2. Partial counts are added up by (language, source, term), then cut to the kept terms.
3. Counts are dealt into columnar shards by a hash of (language, term), about ``SHARD``
   counts each. A shard is a matrix of terms by the language's sources; equal rows are
   one row with a weight. It returns one partial sum for each two sources, not rows by
   term, and each source's ``top`` terms. Sources beyond ``ACROSS`` are dealt over
   several copies of a shard.
4. Partial sums are added and ranked.

The pairs of a language's sources are the result itself; nothing else grows with their
square but the partial sums of a shard.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import arrow_map, settled, shipped

#: Separators between terms: all that is no letter in ASCII.
SEPARATORS = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
LEAST = 3
TOP = 200
UNIT = 1_000_000_000
#: Bytes of text that are split together, bytes of counts that a task holds.
STEP = 1 << 22
HELD = 48 << 20
#: Counts of a shard; sources whose sums a task holds against all others of the language.
SHARD = 1 << 18
ACROSS = 256
#: Numbers of a matrix that a shard looks at together.
CELLS = 1 << 20

KEYS = ["lang", "source", "term"]


def _step_counts(lang: pa.Array, source: pa.Array, text: pa.Array) -> pa.Table:
    """(lang, source, term, n, docs) of a few documents; a group's row without a term says that it occurs."""
    groups = pa.table({"lang": lang, "source": source})
    words = pc.split_pattern_regex(pc.ascii_lower(text), SEPARATORS)
    term = pc.list_flatten(words)
    doc = pc.list_parent_indices(words)
    found = pc.greater(pc.binary_length(term), 0)
    coded = term.filter(found).dictionary_encode()
    terms = coded.dictionary
    at = pa.table({"doc": doc.filter(found), "code": coded.indices})
    at = at.group_by(["doc", "code"], use_threads=False).aggregate([([], "count_all")])
    names = {n: groups.column(n).combine_chunks().dictionary_encode() for n in ("lang", "source")}
    at = pa.table({
        "lang": names["lang"].indices.take(at.column("doc").combine_chunks()), "source": names["source"].indices.take(at.column("doc").combine_chunks()),
        "code": at.column("code"), "n": at.column("count_all"),
    })
    at = at.group_by(["lang", "source", "code"], use_threads=False).aggregate([("n", "sum"), ("n", "count")])
    decoded = lambda n: names[n].dictionary.take(at.column(n).combine_chunks())
    counts = pa.table({"lang": decoded("lang"), "source": decoded("source"), "term": terms.take(at.column("code").combine_chunks()), "n": at.column("n_sum"), "docs": at.column("n_count")})
    there = groups.group_by(["lang", "source"], use_threads=False).aggregate([])
    zeros = pa.array(np.zeros(there.num_rows, np.int64))
    there = pa.table({"lang": there.column("lang"), "source": there.column("source"), "term": pa.nulls(there.num_rows, terms.type), "n": zeros, "docs": zeros})
    return pa.concat_tables([counts.cast(there.schema), there])


def _merged(tables: list[pa.Table]) -> pa.Table:
    table = pa.concat_tables(tables).group_by(KEYS, use_threads=False).aggregate([("n", "sum"), ("docs", "sum")])
    return table.rename_columns([*KEYS, "n", "docs"] if table.column_names[0] == "lang" else ["n", "docs", *KEYS]).select([*KEYS, "n", "docs"])


def partial_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): each task's occurrences and documents; nulls are empty strings.

    A row with a null term for each group says that the group occurs, with or without terms.
    """

    def steps(batch):
        lang, source, text = (c.cast(pa.string()) if pa.types.is_null(c.type) else c for c in batch.columns)
        sizes = pc.fill_null(pc.binary_length(text), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        total = np.concatenate([[0], np.cumsum(sizes)])
        a = 0
        while a < batch.num_rows:
            b = max(a + 1, int(np.searchsorted(total, total[a] + STEP, "right")) - 1)
            yield (pc.fill_null(c.slice(a, b - a), "") for c in (lang, source, text))
            a = b

    def run(batches):
        held: list[pa.Table] = []
        size = 0
        for batch in batches:
            for lang, source, text in steps(batch):
                held.append(_step_counts(lang, source, text))
                size += held[-1].nbytes
                if size >= HELD:
                    held = [_merged(held)]
                    size = held[0].nbytes
                    if size >= HELD // 2:
                        yield from held[0].to_batches(max_chunksize=1 << 16)
                        held, size = [], 0
        if held:
            yield from _merged(held).to_batches(max_chunksize=1 << 16)

    return arrow_map(docs.select("lang", "source", "text"), run, "lang string, source string, term string, n bigint, docs bigint")


def share(count: np.ndarray, total: int) -> np.ndarray:
    """1 + floor(10^9 * (count + 1) / total), exact in 64 bits by three steps of long division."""
    rest = count + 1
    out = np.zeros_like(rest)
    for _ in range(3):
        rest = rest * 1000
        out = out * 1000 + rest // total
        rest = rest % total
    return out + 1


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // q


def _shard(counts: pa.Table, groups: pa.Table, top: int) -> pa.Table:
    """(source, item, part, value) of one shard of a language: partial sums of its block of sources against all, top terms."""
    names = groups.column("source")
    n, home = groups.column("total").to_numpy(), groups.column("home").to_numpy(zero_copy_only=False)
    v, whole = int(groups.column("v")[0].as_py()), int(groups.column("whole")[0].as_py())
    column = pc.index_in(counts.column("source"), value_set=names.combine_chunks()).to_numpy(zero_copy_only=False).astype(np.int64)
    coded = counts.column("term").combine_chunks().dictionary_encode()
    if isinstance(coded, pa.ChunkedArray):
        coded = coded.combine_chunks()
    code, terms = coded.indices.to_numpy().astype(np.int64), coded.dictionary
    value = counts.column("n").to_numpy()
    order = np.argsort(code, kind="stable")
    code, column, value = code[order], column[order], value[order]
    mine = np.flatnonzero(home)
    sums = np.zeros((len(mine), len(names)), np.int64)
    best: dict[int, list] = {i: [] for i in mine.tolist()}
    step = max(1, CELLS // len(names))
    for a in range(0, len(terms), step):
        lo, hi = np.searchsorted(code, [a, a + step])
        height = min(step, len(terms) - a)
        matrix = np.zeros((height, len(names)), np.int64)
        np.add.at(matrix, (code[lo:hi] - a, column[lo:hi]), value[lo:hi])
        q = share(matrix.sum(axis=1), whole + v)
        for i in mine.tolist():
            c = matrix[:, i]
            p = share(c, int(n[i]) + v)
            at = np.flatnonzero((c > 0) & (p > q))
            f = divergence(p[at], q[at])
            if len(at) > top:
                floor = np.partition(f, len(f) - top)[len(f) - top]
                keep = f >= floor
                at, f = at[keep], f[keep]
            best[i] += zip(f.tolist(), (a + at).tolist())
        rows, weight = np.unique(matrix, axis=0, return_counts=True)
        p = np.stack([share(rows[:, j], int(n[j]) + v) for j in range(len(names))], axis=1)
        for k, i in enumerate(mine.tolist()):
            sums[k] += (divergence(p[:, [i]], p) * weight[:, None]).sum(axis=0)
    texts = terms.to_pylist()
    source = names.to_pylist()
    out = []
    for i, found in best.items():
        found = sorted(((-f, texts[t].encode(), texts[t]) for f, t in found))[:top]
        out += [(source[i], t, "term", -f) for f, _, t in found]
    out += [(source[i], source[j], "pair", int(sums[k, j])) for k, i in enumerate(mine.tolist()) for j in range(len(source)) if j != i]
    return pa.table({name: pa.array([r[c] for r in out], kind) for c, (name, kind) in enumerate(SHARD_SCHEMA)})


SHARD_SCHEMA = (("source", pa.string()), ("item", pa.string()), ("part", pa.string()), ("value", pa.int64()))


def audit(docs: DataFrame, *, least: int = LEAST, top: int = TOP, shard: int = SHARD, across: int = ACROSS) -> DataFrame:
    """(lang, source, part, item, value, rank) for each (lang, source) that occurs.

    ``pair``: each other source of the language, ``value`` the divergence from it summed
    over the language's kept terms (0 if none), all ranks. ``term``: each kept term that
    the group has and uses more than its language, its divergence from the language,
    ranks up to ``top``. Ranks follow value downwards, then item by UTF-8. Null text,
    lang and source are empty strings; groups without terms take part; repeated rows are
    documents each; an empty table gives no rows. Other columns are not looked at.
    """
    spark = docs.sparkSession
    counted = partial_counts(docs).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    counted = settled(counted)
    kept = counted.where("term IS NOT NULL").groupBy("lang", "term").agg(F.sum("docs").alias("docs")).where(F.col("docs") >= least).select("lang", "term")
    kept = settled(counted.where("term IS NOT NULL").join(kept, ["lang", "term"], "left_semi").select("lang", "source", "term", "n"))

    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    sizes = kept.groupBy("lang", "term").agg(F.sum("n").alias("n")).groupBy("lang").agg(F.count("*").alias("v"), F.sum("n").alias("whole"))
    by_name = Window.partitionBy("lang").orderBy("source")
    groups = counted.where("term IS NULL").select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(sizes, "lang", "left")
    groups = groups.na.fill(0, ["total", "v", "whole"]).withColumn("block", F.expr(f"(row_number() over (partition by lang order by source) - 1) div {across}"))
    groups = settled(groups)

    n, blocks = kept.count(), groups.agg(F.max("block")).first()[0]
    shards = max(1, -(-n // shard))
    number = F.pmod(F.xxhash64("lang", "term"), F.lit(shards)).alias("shard")
    dealt = kept.select("lang", number, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks or 0).cast("long"))).alias("block"), "source", "term", "n")
    used = dealt.select("lang", "shard", "block").distinct().withColumnRenamed("block", "of")
    beside = used.join(groups, "lang")
    beside = beside.select(F.col("lang").alias("in_lang"), F.col("shard").alias("in_shard"), F.col("of").alias("in_block"), "source", "total", "v", "whole", (F.col("block") == F.col("of")).alias("home"))

    def compared(key, left, right):
        if left.num_rows == 0 or not any(right.column("home").to_pylist()):
            out = pa.table({name: pa.array([], kind) for name, kind in SHARD_SCHEMA})
        else:
            out = _shard(left, right, top)
        return out.add_column(0, "lang", pa.array([key[0].as_py()] * out.num_rows, pa.string()))

    shipped(spark)
    pairs = dealt.groupBy("lang", "shard", "block").cogroup(beside.groupBy("in_lang", "in_shard", "in_block"))
    found = pairs.applyInArrow(compared, "lang string, source string, item string, part string, value bigint")
    found = settled(found)
    ranked = lambda df: df.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")))
    terms = ranked(found.where("part = 'term'").select("lang", "source", "part", "item", "value")).where(F.col("rank") <= top)
    none = groups.where("v = 0").select("lang", "source")
    none = none.join(none.select("lang", F.col("source").alias("item")), "lang").where("source <> item").withColumn("value", F.lit(0).cast("long"))
    sums = found.where("part = 'pair'").groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    pairs = ranked(sums.unionByName(none).select("lang", "source", F.lit("pair").alias("part"), "item", "value"))
    return pairs.unionByName(terms)
