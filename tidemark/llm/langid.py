"""Language identification by error-correcting output codes.

Each language has a codeword; for each bit a binary classifier over hashed byte n-grams
says how much a text looks like the languages whose bit is 1. Decoding sums, for each
codeword, the logistic losses of the bits' margins, weighted by how well the bit's two
sides can be told apart; the least loss wins. A text whose two best codewords are close
is flagged as ambiguous.

Counts of n-grams cover every labelled row: each task adds up its rows (languages x
``2 ** bits`` numbers) and the tables are summed by language. The model is of that
fixed size, whatever the input.
"""

from __future__ import annotations

import itertools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import arrow_groups, arrow_map, shipped, text_chunks

UNKNOWN = "und"
#: log2 of the number of n-gram buckets, and the n-gram length in bytes.
BITS = 14
NGRAM = 3
#: Texts whose best codeword's share of the decoded weight is below this are ambiguous.
AMBIGUOUS = 0.55

#: Text bytes that are looked at together: what a task holds does not grow with a text.
BLOCK = 1 << 18

# Letters keep their byte (A-Z lower-cased), the rest is one blank.
_FOLD = np.arange(256, dtype=np.uint32)
_FOLD[65:91] += 32
_FOLD[:65] = _FOLD[91:97] = _FOLD[123:128] = 32


def codewords(k: int) -> np.ndarray:
    """(k, bits) of -1 and 1: all splits of up to 6 languages, else rows of a Hadamard matrix.

    Columns that do not split the languages, or split them as another does, are left out.
    """
    if k < 2:
        return np.ones((k, 1), np.int8)
    if k <= 6:
        rest = itertools.product((1, -1), repeat=k - 1)
        return np.array([(1, *r) for r in rest if -1 in r], np.int8).T
    order = 1 << int(np.ceil(np.log2(2 * k)))
    h = np.ones((1, 1), np.int8)
    while len(h) < order:
        h = np.block([[h, h], [h, -h]])
    h = h[:k] * h[0]
    columns = {tuple(c * c[0]) for c in h.T if abs(c.sum()) < k}
    return np.array(sorted(columns), np.int8).T


def buckets(data: np.ndarray, bounds: np.ndarray, bits: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of the n-gram at each byte, whether it counts): it lies in one text and its middle is no blank."""
    f = _FOLD[data]
    m = len(f) - n + 1
    if m <= 0:
        return np.zeros(0, np.int64), np.zeros(0, bool)
    code = np.zeros(m, np.uint32)
    for j in range(n):
        code = code * np.uint32(0x01000193) + f[j : j + m] * np.uint32(0x9E3779B1)
        code ^= code >> np.uint32(15)
    code = (code * np.uint32(0x85EBCA6B)) >> np.uint32(32 - bits)
    counts = f[n // 2 : n // 2 + m] != 32
    for b in bounds[1:-1].tolist():  # n-grams that reach into the next text
        counts[max(0, b - n + 1) : b] = False
    return code.astype(np.int64), counts


def gram_blocks(texts, bits: int, n: int):
    """(first row, end row, buckets, whether they count, row bounds) over ``BLOCK`` bytes of texts at a time.

    A longer text comes in several blocks; each of its n-grams is in one of them.
    """
    for lo, hi, data, bounds in text_chunks(texts, BLOCK):
        if hi - lo > 1 or len(data) <= BLOCK:
            yield lo, hi, *buckets(data, bounds, bits, n), bounds
        else:
            for a in range(0, len(data), BLOCK):
                part = data[a : a + BLOCK + n - 1]
                yield lo, hi, *buckets(part, np.array([0, len(part)]), bits, n), np.array([0, len(part)])


@dataclass
class Model:
    """langs, their codewords, one row of margins per bucket, bit weights; sized by ``bits`` and the code."""

    langs: list[str]
    codes: np.ndarray
    weights: np.ndarray
    reliability: np.ndarray
    bits: int
    ngram: int
    ambiguous: float


def _counted(labelled: DataFrame, bits: int, n: int) -> list:
    """Rows (lang, counts as bytes): n-gram counts of each language over all its texts."""
    size = 1 << bits

    def count(batches):
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = batch.column(0).to_pylist()
            for lo, hi, code, counts, bounds in gram_blocks(batch.column(1), bits, n):
                for name in set(langs[lo:hi]):
                    own = np.zeros(hi - lo, bool)
                    own[[i for i in range(hi - lo) if langs[lo + i] == name]] = True
                    use = counts & np.repeat(own, np.diff(bounds))[: len(counts)]
                    total.setdefault(name, np.zeros(size, np.int64))
                    total[name] += np.bincount(code[use], minlength=size)
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array([x.tobytes() for x in total.values()], pa.binary())], names=["lang", "counts"])

    def add(table):
        held = [np.frombuffer(x, np.int64) for x in table.column("counts").to_pylist()]
        return pa.table({"part": table.column("part")[:1], "lang": table.column("lang")[:1], "counts": pa.array([np.sum(held, axis=0).tobytes()], pa.binary())})

    tables = arrow_map(labelled, count, "lang string, counts binary")
    parts = tables.withColumn("part", F.pmod(F.spark_partition_id(), F.lit(64)))
    for _ in range(2):  # 64 sums a language first, then one
        parts = arrow_groups(parts, ["part", "lang"], add, "part int, lang string, counts binary").withColumn("part", F.lit(0))
    return parts.collect()  # one row per language


def fit(labelled: DataFrame, *, lang: str = "lang", text: str = "text", bits: int = BITS, ngram: int = NGRAM, ambiguous: float = AMBIGUOUS) -> Model:
    """The classifiers, from all rows with a language and a text; the languages are those that occur."""
    rows = labelled.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text")).where("lang IS NOT NULL AND text IS NOT NULL")
    counts = {r["lang"]: np.frombuffer(r["counts"], np.int64) for r in _counted(rows, bits, ngram)}
    langs = sorted(counts)
    codes = codewords(len(langs))
    if not langs:
        return Model([], codes, np.zeros((1 << bits, 0), np.float32), np.zeros(0), bits, ngram, ambiguous)
    share = np.array([(counts[x] + 0.5) / (counts[x].sum() + 0.5 * (1 << bits)) for x in langs])  # a language's own distribution: no priors
    weights, reliability = [], []
    for b in range(codes.shape[1]):
        one, zero = share[codes[:, b] > 0], share[codes[:, b] < 0]
        if not len(zero):
            weights.append(np.zeros(1 << bits))
            reliability.append(1.0)
            continue
        p, q = one.mean(axis=0), zero.mean(axis=0)
        weights.append(np.log(p / q))
        reliability.append(float(((p - q) * np.log(p / q)).sum()))  # symmetric divergence of the two sides
    reliability = np.array(reliability)
    return Model(langs, codes, np.array(weights, np.float32).T.copy(), reliability / max(reliability.sum(), 1e-12), bits, ngram, ambiguous)


def decode(margins: np.ndarray, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """(best language, share of its weight) from each text's bit margins, by weighted logistic loss."""
    z = margins[:, None, :] * model.codes[None, :, :]
    loss = (np.logaddexp(0, -z) * model.reliability).sum(axis=2)
    weight = np.exp(-(loss - loss.min(axis=1, keepdims=True)) * model.codes.shape[1])
    best = loss.argmin(axis=1)
    return best, weight[np.arange(len(best)), best] / weight.sum(axis=1)


def _has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def classifier(model: Model):
    """An Arrow UDF: text -> struct(lang_pred, score, ambiguous)."""
    kind = pa.struct([("lang_pred", pa.string()), ("score", pa.float64()), ("ambiguous", pa.bool_())])

    @F.arrow_udf("lang_pred string, score double, ambiguous boolean")
    def predict(texts: pa.Array) -> pa.Array:
        n = len(texts)
        lang, score, unclear = [UNKNOWN] * n, np.zeros(n), np.ones(n, bool)
        total, seen = np.zeros((n, model.codes.shape[1])), np.zeros(n)
        for lo, hi, code, counts, bounds in gram_blocks(texts, model.bits, model.ngram) if model.langs else ():
            ends = np.minimum(bounds, len(code))
            sums = np.zeros((len(code) + 1, total.shape[1]))
            np.cumsum(model.weights[code] * counts[:, None], axis=0, out=sums[1:])
            total[lo:hi] += sums[ends[1:]] - sums[ends[:-1]]
            sums = np.concatenate([[0], np.cumsum(counts)])
            seen[lo:hi] += sums[ends[1:]] - sums[ends[:-1]]
        # like evidence for each n-gram up to 64 of them: longer texts are not surer without end
        lettered = [i for lo in range(0, n, 500) for i, t in enumerate(texts[lo : lo + 500].to_pylist(), lo) if _has_letter(t)]
        if lettered and model.langs:
            margins = (total / np.maximum(seen, 1)[:, None] * np.minimum(seen, 64)[:, None] / 4)[lettered]
            best, share = decode(margins, model)
            for i, b, s in zip(lettered, best.tolist(), share.tolist()):
                lang[i], score[i], unclear[i] = model.langs[b], s, s < model.ambiguous
        return pa.StructArray.from_arrays([pa.array(lang, pa.string()), pa.array(score), pa.array(unclear)], fields=list(kind))

    return predict


def identified(docs: DataFrame, model: Model, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, lang_pred, score, ambiguous for every row.

    ``und`` with score 0, ambiguous, if the text is null, has no letter, or no language
    was learned. Whole texts count; equal texts get equal results; repeated rows, null
    doc_ids and an empty table are kept as they are. Of equal losses the language first
    in the alphabet wins.
    """
    shipped(docs.sparkSession)
    return docs.select(F.col(doc_id).alias("doc_id"), classifier(model)(F.col(text)).alias("p")).select("doc_id", "p.*")


def rejects(docs: DataFrame, model: Model, *, text: str = "text"):
    """A condition: the text is of no language, or ambiguous between languages."""
    shipped(docs.sparkSession)
    found = classifier(model)(F.col(text))
    return found["ambiguous"]  # texts of no language are, too
