"""Toxicity by a weighted lexicon, matched by Aho-Corasick on folded text.

Folding: compatibility forms, case, look-alike letters of other scripts, digits and signs
that stand for letters, invisible marks; what is no letter becomes one blank. The
lexicon is learned from labelled texts: word beginnings and whole words that mark
toxic texts, weighted by log odds; exception phrases are words that begin like an
entry, and entry-with-neighbour phrases, that clean texts use. A score is the logistic
of the weighted matches outside exceptions, as such and for each hundred words.

The lexicon is fitted on at most ``SAMPLE`` labelled rows, chosen by hash of doc_id.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import arrow_map, settled, shipped

#: Labelled rows that the lexicon is learned from, at most.
SAMPLE = 40_000
#: Texts (and contexts) an entry must mark; its share of toxic texts.
SUPPORT = 5
PRECISION = 0.8
#: Tallies that a task holds, about.
TALLY = 100_000
#: Log likelihood ratio that an entry must reach: chance among millions of terms does not.
SURPRISE = 18.0
PREFIXES = (4, 5, 6, 7, 8)

# Look-alike letters (Cyrillic, Greek and others), and signs that stand for letters.
HOMOGLYPHS = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "ё": "e", "ғ": "f", "һ": "h", "н": "h", "і": "i", "ї": "i", "ј": "j", "к": "k",
    "ӏ": "l", "м": "m", "п": "n", "о": "o", "р": "p", "ԛ": "q", "г": "r", "ѕ": "s", "т": "t", "ц": "u", "ѵ": "v", "ѡ": "w", "х": "x",
    "у": "y", "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "μ": "u", "ν": "v", "ο": "o", "ρ": "p", "σ": "o", "τ": "t",
    "υ": "u", "χ": "x", "γ": "y", "ω": "w", "ı": "i", "ɑ": "a", "ɡ": "g", "ʟ": "l", "ո": "n", "ս": "u", "օ": "o",
}
SIGNS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "|": "i", "€": "e"}
INVISIBLE = "­​‌‍⁠﻿"

_TABLE = {ord(a): b for a, b in HOMOGLYPHS.items()} | {ord(c): None for c in INVISIBLE}
_SIGN_TABLE = {ord(a): b for a, b in SIGNS.items()}
_HAS_SIGN = re.compile(r"[01345789@$|€]")
_MARK = re.compile(r"(?<=[^\W\d_])!(?=[^\W\d_])")
_BREAK = re.compile(r"[\W_]+")
#: Anything but ASCII and the letters of Latin-1, which need no folding but that of case.
_ODD = re.compile(r"[^\x00-\x7FÀ-ÖØ-öø-ÿ]")
_SEPARATE = bytes(c if c > 127 or chr(c).isalnum() else 32 for c in range(256))


def _letters_for_signs(word: str) -> str:
    """A word with digits or signs and two letters or more, read with its signs as letters."""
    return word.translate(_SIGN_TABLE) if _HAS_SIGN.search(word) and sum(map(str.isalpha, word)) >= 2 else word


def folded(text: str) -> str:
    """The text as words of folded letters with one blank around each."""
    t = text.lower()
    odd = _ODD.search(t)
    if odd:
        t = unicodedata.normalize("NFKC", text).lower().translate(_TABLE)
    if "!" in t:
        t = _MARK.sub("i", t)  # an exclamation mark only between letters
    if _HAS_SIGN.search(t):
        t = " ".join(map(_letters_for_signs, t.replace("!", " ").split()))
    t = _BREAK.sub(" ", t) if odd else t.encode().translate(_SEPARATE).decode()
    return f" {' '.join(t.split())} "


@dataclass
class Lexicon:
    """weights: pattern (blank + beginning, or blank + word + blank) to weight; exceptions: phrases with blanks around."""

    weights: dict[str, float] = field(default_factory=dict)
    exceptions: set[str] = field(default_factory=set)
    coefficients: tuple[float, float, float] = (-3.0, 1.0, 0.0)

    def automaton(self):
        import ahocorasick

        a = ahocorasick.Automaton()
        for p, w in self.weights.items():
            a.add_word(p, (len(p), w))
        for p in self.exceptions:
            a.add_word(p, (len(p), None))
        if len(a):
            a.make_automaton()
        return a


def evidence(text: str, automaton) -> tuple[float, float]:
    """(sum of the weights matched outside exceptions, words); of matches that begin at one place the heaviest counts."""
    t = folded(text)
    words = t.count(" ") - 1 if len(t) > 2 else 0
    if not len(automaton):
        return 0.0, words
    at: dict[int, float] = {}
    spared: list[tuple[int, int]] = []
    for end, (n, w) in automaton.iter(t):
        begin = end - n + 1
        if w is None:
            spared.append((begin, end))
        elif w > at.get(begin, 0.0):
            at[begin] = w
    if not spared:
        return sum(at.values()), words
    spared.sort()
    total, reach, i = 0.0, -1, 0
    for b, w in sorted(at.items()):  # both from left to right
        while i < len(spared) and spared[i][0] <= b:
            reach = max(reach, spared[i][1])
            i += 1
        if b >= reach:
            total += w
    return total, words


def features(weight: float, words: float) -> tuple[float, float, float]:
    return 1.0, math.log1p(weight), math.log1p(100.0 * weight / max(words, 1.0))


def probability(weight: float, words: float, coefficients) -> float:
    z = sum(a * b for a, b in zip(features(weight, words), coefficients))
    return 1.0 / (1.0 + math.exp(-max(-60.0, min(60.0, z))))


# ---- learning -------------------------------------------------------------------


def _terms(words: list[str]) -> set[str]:
    out = set()
    for w in set(words):
        out.add(f" {w} ")
        out.update(f" {w[:k]}" for k in PREFIXES if len(w) >= k)
    return out


def _tallied(rows: DataFrame, found, name: str) -> DataFrame:
    """(name, toxic, n): rows that hold each string of ``found(text)``; a task passes its tallies on before they grow large."""

    def count(batches):
        total: Counter = Counter()

        def out():
            keys = list(total)
            columns = [pa.array([t for t, _ in keys], pa.string()), pa.array([y for _, y in keys], pa.int32()), pa.array([total[k] for k in keys], pa.int64())]
            total.clear()
            return pa.RecordBatch.from_arrays(columns, names=[name, "toxic", "n"])

        for batch in batches:
            for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                total.update((t, y) for t in found(text or ""))
                if len(total) > TALLY:
                    yield out()
        yield out()

    counts = arrow_map(rows.select("text", "toxic"), count, f"{name} string, toxic int, n bigint")
    return counts.groupBy(name, "toxic").agg(F.sum("n").alias("n"))


def _counted(rows: DataFrame, wanted: set[str] | None) -> DataFrame:
    """(term, toxic, n): texts that hold each term; ``wanted`` limits the terms looked at."""

    def found(text):
        terms = _terms(folded(text).split())
        return terms if wanted is None else terms & wanted

    return _tallied(rows, found, "term")


def _log_odds(a: float, b: float, na: float, nb: float) -> float:
    return math.log((a + 0.5) / (na - a + 0.5)) - math.log((b + 0.5) / (nb - b + 0.5))


def surprise(a: float, b: float, share: float) -> float:
    """Log likelihood ratio of ``a`` toxic among ``a + b`` against the general share of toxic texts."""
    n = a + b
    out = 0.0
    for k, p in ((a, share), (b, 1.0 - share)):
        if k:
            out += k * math.log(k / n / max(p, 1e-12))
    return out


def choose(toxic: dict[str, int], clean: dict[str, int], n_toxic: int, n_clean: int) -> dict[str, float]:
    """Entries with weights: terms that mark toxic texts.

    Of a term and its beginnings the shortest that marks is taken, and made longer as long
    as that marks toxic texts (almost) as surely.
    """
    share = n_toxic / max(n_toxic + n_clean, 1)

    def sure(t):
        return surprise(toxic[t], clean.get(t, 0), share)

    def marks(t):
        a, b = toxic[t], clean.get(t, 0)
        return a >= SUPPORT and a >= PRECISION * (a + b) and sure(t) >= SURPRISE

    longer: dict[str, list[str]] = {}
    for t in toxic:
        if t.endswith(" "):
            parent = next((t[:k] for k in range(len(t) - 1, 1, -1) if t[:k] in toxic), None)
        else:
            parent = t[:-1] if t[:-1] in toxic else None
        if parent:
            longer.setdefault(parent, []).append(t)
    out: dict[str, float] = {}
    for t in sorted(filter(marks, toxic), key=lambda t: (len(t.strip()), t)):
        if any(t[:k] in out for k in range(2, len(t) + 1)):
            continue
        top = t
        while more := [x for x in longer.get(top, ()) if marks(x) and sure(x) >= 0.98 * sure(top)]:
            top = max(more, key=lambda x: (sure(x), x))
        out[top] = round(_log_odds(toxic[top], clean.get(top, 0), n_toxic, n_clean), 6)
    return out


def _contexts(rows: DataFrame, lexicon: Lexicon) -> DataFrame:
    """(entry, toxic, contexts): different pairs of neighbour words that an entry's matches have.

    Copies of one text give one context, so their words cannot pass for a lexicon.
    """

    def find(batches):
        automaton = lexicon.automaton()
        for batch in batches:
            seen = set()
            for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                t = folded(text or "")
                for end, (n, _) in automaton.iter(t) if len(automaton) else ():
                    b = end - n + 1
                    e = t.index(" ", b + 1)
                    after = t.find(" ", e + 1)
                    before = t.rfind(" ", 0, b) if b else 0
                    seen.add((t[b : end + 1], y, t[before:b] + "|" + t[e : max(after, e)]))
            entry, y, context = zip(*seen) if seen else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(entry, pa.string()), pa.array(y, pa.int32()), pa.array(context, pa.string())], names=["entry", "toxic", "context"])

    found = arrow_map(rows.select("text", "toxic"), find, "entry string, toxic int, context string").distinct()
    return found.groupBy("entry", "toxic").agg(F.count("*").alias("contexts"))


def varied(weights: dict[str, float], contexts: dict[tuple[str, int], int], share: float) -> dict[str, float]:
    """The entries that still mark toxic texts when each context counts once, best first."""
    out = []
    for t, w in weights.items():
        a, b = contexts.get((t, 1), 0), contexts.get((t, 0), 0)
        if a >= SUPPORT and a >= PRECISION * (a + b) and surprise(a, b, share) >= SURPRISE:
            out.append((-w, t))
    return {t: -w for w, t in sorted(out)}


def _phrases(rows: DataFrame, lexicon: Lexicon) -> DataFrame:
    """(phrase, toxic, n): words that hold an entry, and such words with a neighbour, by texts."""

    held: list = []

    def around(text):
        if not held:  # built by the task
            held.append(lexicon.automaton())
        t = folded(text)
        found = set()
        for end, (n, _) in held[0].iter(t) if len(held[0]) else ():
            b = end - n + 1
            e = t.index(" ", b + 1)
            found.add(t[b : e + 1])
            after = t.find(" ", e + 1)
            before = t.rfind(" ", 0, b) if b else -1
            if after > 0:
                found.add(t[b : after + 1])
            if before >= 0:
                found.add(t[before : e + 1])
        return found

    counts = _tallied(rows, around, "phrase")
    return counts.groupBy("phrase").agg(F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("clean"), F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("toxic"))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, rounds: int = 50) -> np.ndarray:
    """Coefficients by Newton's method with a small penalty; classes weigh as they occur."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (y - p) - ridge * w
        h = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + ridge * np.eye(x.shape[1])
        step = np.linalg.solve(h, g)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", toxic: str = "toxic", sample: int = SAMPLE) -> Lexicon:
    """A lexicon from at most ``sample`` labelled rows; without toxic rows or clean ones it is empty.

    The rows with the smallest hashes, of the doc_ids with the smallest hashes; a row that
    repeats doc_id and text counts once.
    """
    chosen = labels.select(F.col(doc_id).alias("doc_id"), (F.col(toxic) == 1).cast("int").alias("toxic")).where("doc_id IS NOT NULL AND toxic IS NOT NULL")
    chosen = chosen.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).where("text IS NOT NULL").join(F.broadcast(chosen), "doc_id")  # of ``sample`` rows
    rows = rows.withColumn("h", F.xxhash64("doc_id", "text"))
    most = rows.select("h").distinct().orderBy("h").limit(sample).agg(F.max("h")).first()[0]
    rows = settled(rows.where(F.col("h") <= F.lit(most)).dropDuplicates(["h"]).select("text", "toxic"))
    sizes = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n_toxic, n_clean = sizes.get(1, 0), sizes.get(0, 0)
    lexicon = Lexicon()
    if not n_toxic or not n_clean:
        return lexicon
    frequent = _counted(rows.where("toxic = 1"), None).where(F.col("n") >= SUPPORT)  # terms of the sample
    marked = {r["term"]: r["n"] for r in frequent.collect()}
    clean = {r["term"]: r["n"] for r in _counted(rows.where("toxic = 0"), set(marked)).collect()}
    lexicon.weights = choose(marked, clean, n_toxic, n_clean)
    contexts = {(r["entry"], r["toxic"]): r["contexts"] for r in _contexts(rows, lexicon).collect()}
    lexicon.weights = varied(lexicon.weights, contexts, n_toxic / (n_toxic + n_clean))
    spared = _phrases(rows, lexicon).where(F.col("clean") >= 3).where(F.col("toxic") <= 0.25 * (F.col("clean") + F.col("toxic")))
    lexicon.exceptions = {r["phrase"] for r in spared.collect()} - set(lexicon.weights)
    seen = [(r["weight"], r["words"], r["toxic"]) for r in _measured(rows, lexicon).collect()]  # ``sample`` rows at most
    x = np.array([features(w, n) for w, n, _ in seen])
    lexicon.coefficients = tuple(round(float(c), 9) for c in logistic(x, np.array([y for *_, y in seen], float)))
    return lexicon


def _measured(rows: DataFrame, lexicon: Lexicon) -> DataFrame:
    def measure(batches):
        automaton = lexicon.automaton()
        for batch in batches:
            found = [evidence(t or "", automaton) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.float64()), pa.array([float(f[1]) for f in found]), batch.column(1)], names=["weight", "words", "toxic"])

    return arrow_map(rows.select("text", "toxic"), measure, "weight double, words double, toxic int")


# ---- scoring --------------------------------------------------------------------


def scorer(lexicon: Lexicon):
    """An Arrow UDF: text -> probability of label 1."""
    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        automaton = lexicon.automaton()
        for texts in batches:
            out = []
            for lo in range(0, len(texts), 500):
                for t in texts[lo : lo + 500].to_pylist():
                    out.append(probability(*evidence(t or "", automaton), lexicon.coefficients))
            yield pa.array(out, pa.float64())

    return score


def scored(docs: DataFrame, lexicon: Lexicon, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, score, predicted (1 if score >= 0.5) for every row's whole text.

    Null and empty texts score as texts without matches. Repeated rows, null doc_ids and
    an empty table are kept as they are; other columns are not looked at.
    """
    shipped(docs.sparkSession)
    out = docs.select(F.col(doc_id).alias("doc_id"), scorer(lexicon)(F.col(text)).alias("score"))
    return out.select("doc_id", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def rejects(docs: DataFrame, lexicon: Lexicon, *, text: str = "text"):
    """A condition: the text is more likely toxic than not."""
    shipped(docs.sparkSession)
    return scorer(lexicon)(F.col(text)) >= 0.5
