"""Best-fit packing by length patterns: enumerate patterns, fit their repeats by non-negative least squares, round, pack the rest.

Texts become token ids and pieces of at most ``capacity`` ids where they are read. Only
the histogram of piece lengths (``capacity`` rows at most, whatever the input) reaches
the driver. There

1. lengths are put in coarse bins, and all patterns of up to ``parts`` bins that fill a
   sequence are enumerated;
2. non-negative least squares fits how often each pattern is used to the histogram;
3. rounded down, each pattern is filled with real lengths, the last one by best fit;
   a step fills as many equal sequences as the scarcest of its lengths allows;
4. what is left is packed best-fit, longest first, into the gaps and into new sequences.

The plan is a list of runs (lengths, how many equal sequences), a few for each length.
A piece finds its place by its length and its number among the pieces of its length;
numbers come from per-partition counts, so no task sees all pieces of a common length.
"""

from __future__ import annotations

import base64
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import arrow_map, running_counts, settled, starts_of

CAPACITY = 2048
BINS = 64
PARTS = 4
#: Closes each document.
END = 0

_ENCODERS: dict = {}


def encoder(path: str):
    """The byte-level BPE at ``path`` (tiktoken ranks), kept by the Python worker."""
    if path not in _ENCODERS:
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _ENCODERS[path] = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _ENCODERS[path]


def default_vocabulary() -> str:
    """The ranks of the vocabulary ``byte_bpe_50k.json``; ids are equal (tested), but for special tokens."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


#: The vocabulary's special token, one id where the tokenizers library meets it in a text.
SPECIAL = "<|endoftext|>"
#: White space in a row that is still encoded by ranks; their pattern's stack overflows at some more than 600,000.
BLANKS = 100_000
#: Share of a sequence that a pattern may leave empty.
WASTE = 1 / 256
_BLANK_RUNS = re.compile(r"\s++")  # a run is looked at once


def encode(text: str, path: str, specials: bool = False) -> list[int]:
    """The ids of ``text``. Long white space, and with ``specials`` a text with ``SPECIAL``, takes the tokenizers library itself.

    It reads the json beside the ranks at ``path``.
    """
    special = specials and SPECIAL in text
    if not special and (len(text) < BLANKS or all(m.end() - m.start() < BLANKS for m in _BLANK_RUNS.finditer(text))):
        return encoder(path).encode_ordinary(text)
    if (key := (path, specials)) not in _ENCODERS:
        from tokenizers import Tokenizer

        _ENCODERS[key] = Tokenizer.from_file(path.removesuffix(".tiktoken") + ".json")
        _ENCODERS[key].encode_special_tokens = not specials
    return _ENCODERS[key].encode(text, add_special_tokens=False).ids


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``n`` ids; only the first may be shorter than ``capacity``."""
    head = n - capacity * ((n - 1) // capacity)
    return [(0, head), *((s, capacity) for s in range(head, n, capacity))]


def pieces(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", vocabulary: str | None = None, capacity: int = CAPACITY, keep_ids: bool = False, specials: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 (and ids), and its number among equal lengths of the partition.

    A null or empty text is the closing id alone. ``specials``: the vocabulary's special
    token is its one id where it stands in a text, as in the tokenizers library's default.
    """
    path = vocabulary or default_vocabulary()
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(batches):
        from pyspark import TaskContext

        pid, seen = TaskContext.get().partitionId(), {}
        for batch in batches:
            for lo in range(0, batch.num_rows, 1000):
                part = batch.slice(lo, 1000)
                take, rows = [], []
                for i, t in enumerate(part.column(1).to_pylist()):
                    ids = np.array(encode(t, path, specials) if t else [], "<u4")
                    ids = np.append(ids, np.uint32(END)).astype("<u4")
                    for k, (start, length) in enumerate(cut(len(ids), capacity)):
                        take.append(i)
                        own = ids[start : start + length]
                        rows.append((k, start, length, zlib.crc32(own.tobytes()), own.astype(np.int32) if keep_ids else None))
                k, start, length, crc, own = zip(*rows)
                length = np.array(length, np.int64)
                columns = [part.column(0).take(pa.array(take)), pa.array(k, pa.int32()), pa.array(start, pa.int64()), pa.array(length), pa.array(crc, pa.int64()), pa.array(np.full(len(k), pid, np.int64)), pa.array(running_counts(length, seen))]
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "_pid", "_local"]
                if keep_ids:
                    columns.append(pa.array(own, pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, _pid bigint, _local bigint" + ", ids array<int>" * keep_ids
    return arrow_map(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), run, schema)


# ---- the plan, from the histogram of lengths ------------------------------------


def patterns(bins: int, parts: int) -> list[tuple[int, ...]]:
    """All multisets of up to ``parts`` bin numbers from 1 that add up to ``bins``, largest first."""
    out = []

    def grow(left, most, chosen):
        if left == 0:
            out.append(tuple(chosen))
        elif len(chosen) < parts:
            for b in range(min(left, most), 0, -1):
                grow(left - b, b, [*chosen, b])

    grow(bins, bins, [])
    return out


def nnls(a: np.ndarray, b: np.ndarray, rounds: int = 2000) -> np.ndarray:
    """Least squares with non-negative coefficients, by the active-set method of Lawson and Hanson."""
    n = a.shape[1]
    x, active = np.zeros(n), np.zeros(n, bool)
    slope = a.T @ b
    tolerance = 1e-9 * max(1.0, np.abs(slope).max(initial=0))
    for _ in range(rounds):
        free = np.where(active, -np.inf, slope)
        if active.all() or free.max() <= tolerance:
            break
        active[int(free.argmax())] = True
        while True:
            s = np.zeros(n)
            s[active] = np.linalg.lstsq(a[:, active], b, rcond=None)[0]
            if s[active].min(initial=1) > 1e-12:
                break
            bad = active & (s <= 1e-12)
            step = (x[bad] / np.maximum(x[bad] - s[bad], 1e-300)).min(initial=1)
            x = x + step * (s - x)
            active &= x > 1e-12
            x[~active] = 0
            if not active.any():
                s = np.zeros(n)
                break
        x = s
        slope = a.T @ (b - a @ x)
    return x


def plan(histogram: dict[int, int], capacity: int = CAPACITY, bins: int = BINS, parts: int = PARTS) -> list[tuple[tuple[int, ...], int]]:
    """Runs (lengths of one sequence, how many such sequences) that hold every piece.

    Never more sequences than best fit without patterns takes, which is the plan where it needs fewer.
    """
    left = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        left[length] = n
    runs: list[tuple[tuple[int, ...], int]] = []
    if left[capacity]:
        runs.append(((capacity,), int(left[capacity])))
        left[capacity] = 0

    width = capacity / bins
    bin_of = np.clip(np.rint(np.arange(capacity + 1) / width).astype(int), 1, bins)
    in_bin = np.bincount(bin_of, weights=left, minlength=bins + 1)[1:]
    known = [p for p in patterns(bins, parts) if len(p) > 1 and all(in_bin[b - 1] for b in p)]
    if known:
        a = np.zeros((bins, len(known)))
        for j, p in enumerate(known):
            for b in p:
                a[b - 1, j] += 1
        weight = np.sqrt(np.arange(1, bins + 1) / bins)[:, None]  # long pieces are harder to place later
        fitted = nnls(a * weight, in_bin * weight[:, 0])
        for j in sorted(np.flatnonzero(fitted >= 1).tolist(), key=lambda j: known[j], reverse=True):
            runs += _filled(known[j], int(fitted[j]), left, bin_of, capacity)
    planned = _best_fit(runs, left, capacity)
    plain = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        plain[length] = n
    plain = _best_fit([], plain, capacity)
    return min(planned, plain, key=lambda found: sum(m for _, m in found))


def _filled(pattern, repeats, left, bin_of, capacity):
    """Runs of the pattern with lengths that are left: of each bin the longest that fits, and last the best fit."""
    out = []
    low = {b: int(np.searchsorted(bin_of, b, "left")) for b in pattern}
    high = {b: int(np.searchsorted(bin_of, b, "right")) for b in pattern}
    while repeats > 0:
        chosen: list[int] = []
        room = capacity
        for i, b in enumerate(pattern):
            last = i == len(pattern) - 1
            lo, hi = (1, room + 1) if last else (max(1, low[b]), min(high[b], room + 1))
            free = left[lo:hi].copy()
            for c in chosen:
                if lo <= c < hi:
                    free[c - lo] -= 1
            at = np.flatnonzero(free > 0)
            if not len(at):
                return out
            chosen.append(lo + int(at[-1]))
            room -= chosen[-1]
        if room > WASTE * capacity:  # best fit does better with what is left
            return out
        need = {c: chosen.count(c) for c in chosen}
        m = min(repeats, *(int(left[c]) // k for c, k in need.items()))
        for c, k in need.items():
            left[c] -= m * k
        out.append((tuple(chosen), m))
        repeats -= m
    return out


def _best_fit(runs, left, capacity):
    """Places what is left, longest first, into the smallest gap that takes it, else into new sequences."""
    open_runs: dict[int, list] = {}
    for lengths, m in runs:
        open_runs.setdefault(capacity - sum(lengths), []).append((lengths, m))
    gaps = np.zeros(capacity + 1, bool)
    gaps[list(open_runs)] = True
    for length in range(capacity, 0, -1):
        n = int(left[length])
        while n:
            at = np.flatnonzero(gaps[length:])
            if len(at):
                gap = length + int(at[0])
                lengths, m = open_runs[gap].pop()
                used = min(m, n)
                if m > used:
                    open_runs[gap].append((lengths, m - used))
                if not open_runs[gap]:
                    gaps[gap] = False
                copies = 1
            else:  # new sequences, each begun with as many of this length as it takes
                gap, lengths = capacity, ()
                copies = min(capacity // length, n)
                used = n // copies
            gap -= length * copies
            open_runs.setdefault(gap, []).append((lengths + (length,) * copies, used))
            gaps[gap] = True
            n -= used * copies
    return [run for gap in sorted(open_runs) for run in open_runs[gap]]


def slots(runs) -> np.ndarray:
    """(length, first number, pieces, first sequence, offset) of each place of each run, by length and first number."""
    used: dict[int, int] = {}
    rows, base = [], 0
    for lengths, m in runs:
        offset = 0
        for length in lengths:
            rows.append((length, used.get(length, 0), m, base, offset))
            used[length] = used.get(length, 0) + m
            offset += length
        base += m
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def pack(cut_up: DataFrame, *, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with sequence_id and offset: no sequence over ``capacity``, offsets gapless from 0."""
    kept = settled(cut_up)
    histogram = {r["length"]: r["n"] for r in kept.groupBy("length").agg(F.count("*").alias("n")).collect()}  # capacity rows at most
    place = slots(plan(histogram, capacity))
    keys = (place[:, 0] << 44) + place[:, 1]
    numbered = kept.join(starts_of(kept, "length"), ["length", "_pid"]).withColumn("_rank", F.col("_start") + F.col("_local"))
    names = [c for c in kept.columns if c not in ("_pid", "_local")]
    schema = ", ".join(f"`{c}` {kept.schema[c].dataType.simpleString()}" for c in names) + ", sequence_id bigint, offset bigint"

    def put(batches):
        for batch in batches:
            rank = batch.column("_rank").to_numpy()
            at = np.searchsorted(keys, (batch.column("length").to_numpy() << 44) + rank, "right") - 1
            columns = [batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(place[at, 3] + rank - place[at, 1]), pa.array(place[at, 4])], names=[*names, "sequence_id", "offset"])

    return arrow_map(numbered.select(*names, "_rank"), put, schema)


def packed_documents(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", vocabulary: str | None = None, capacity: int = CAPACITY, keep_ids: bool = False, specials: bool = False) -> DataFrame:
    """One row per piece of every document: doc_id, piece, start, length, ids_crc32, (ids,) sequence_id, offset.

    Rows are packed each on its own, so repeated rows and null doc_ids are kept; a null
    text is empty; an empty table gives no rows; other columns are not looked at.
    """
    return pack(pieces(docs, doc_id=doc_id, text=text, vocabulary=vocabulary, capacity=capacity, keep_ids=keep_ids, specials=specials), capacity=capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids): the packed sequences themselves, from pieces with ids (at most ``capacity`` ids each)."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))


