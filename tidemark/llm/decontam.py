"""Benchmark decontamination by winnowing.

Every window of ``window`` words shared by a document and a benchmark item holds a
common fingerprint: the least hash of its k-word grams. Fingerprints of both sides
are joined, and a hit is extended to all windows of words around it; a window that
an item holds word for word marks its words in the document.

* An item of fewer words than ``window``, but not none, is one window of its own
  length; grams and fingerprints are then chosen for that length too.
* Fingerprints kept by a document are first looked up in a bitmap of fixed size
  (2 MB) built from the benchmark's, so only likely hits leave the scan.
* The extension joins on windows, each benchmark window once: the rows it makes
  follow the documents' hits, however many items or documents share a passage.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import textnp
from tidemark.llm.common import arrow_map, settled, text_chunks

WINDOW = 13
GRAM = 5
_BITS = 24


def _scheme(length: int) -> tuple[int, int]:
    """(k, w) of the fingerprints that are sure to hit a shared span of ``length`` words: k + w - 1 = length."""
    k = min(GRAM, length)
    return k, length - k + 1


def _fingerprints(h, first, length):
    k, w = _scheme(length)
    grams = textnp.gram_hashes(h, k, salt=length)
    at = textnp.winnowed(grams, first, k, w)
    return grams[at], at


def _joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, a: int, b: int) -> str:
    low = textnp.LOWER[data[starts[a] : ends[b - 1]]].tobytes()
    o = starts[a]
    return b" ".join(low[s - o : e - o] for s, e in zip(starts[a:b].tolist(), ends[a:b].tolist())).decode()


def item_windows(items: DataFrame, item_id: str = "item_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """(item_id, span, passage, prints): every window of every item with its fingerprints.

    ``span`` is its length in words, ``passage`` its lower-cased words. Items without words have none.
    """

    def cut(batches):
        for batch in batches:
            ids, out = batch.column(0).to_pylist(), ([], [], [], [])
            for lo, hi, data, bounds in text_chunks(batch.column(1)):
                starts, ends, first = textnp.words(data, bounds, textnp.ALNUM)
                h = textnp.word_hashes(data, starts, ends)
                for i in range(hi - lo):
                    a, b = int(first[i]), int(first[i + 1])
                    span = min(window, b - a)
                    if not span:
                        continue
                    for s in range(a, b - span + 1):
                        prints, _ = _fingerprints(h[s : s + span], np.array([0, span]), span)
                        for x, y in zip(out, (ids[lo + i], span, _joined(data, starts, ends, s, s + span), prints.view(np.int64).tolist())):
                            x.append(y)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], batch.schema.field(0).type), pa.array(out[1], pa.int32()), pa.array(out[2], pa.string()), pa.array(out[3], pa.list_(pa.int64()))],
                names=["item_id", "span", "passage", "prints"],
            )

    kind = items.schema[item_id].dataType.simpleString()
    source = items.select(F.col(item_id).alias("item_id"), F.col(text).alias("text"))
    return arrow_map(source, cut, f"item_id {kind}, span int, passage string, prints array<bigint>")


def _bitmap(prints: DataFrame) -> np.ndarray:
    """A bit for each leading 24 bits of a fingerprint: 512 pieces of 4 KB at most, whatever the benchmark's size."""
    slot = F.shiftrightunsigned("print", 64 - _BITS)
    pieces = (
        prints.select(F.bitmap_bucket_number(slot).alias("b"), F.bitmap_bit_position(slot).alias("p"))
        .groupBy("b").agg(F.bitmap_construct_agg("p").alias("bits")).collect()
    )
    # Spark numbers buckets from 1 for values 1..32768 and puts value v at bit (v - 1) % 32768.
    bits = np.zeros((1 << _BITS) // 8 + 8192, np.uint8)
    for r in pieces:
        bits[r["b"] * 4096 : (r["b"] + 1) * 4096] = np.frombuffer(r["bits"], np.uint8)
    return bits


def _likely(prints: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Whether the bitmap has each fingerprint."""
    slot = (prints >> np.uint64(64 - _BITS)).astype(np.int64)
    # bucket 0 holds only value 0, at bit 0; value v > 0 lies at bit (v - 1) of the buckets from 1
    at = np.where(slot > 0, slot - 1 + 32768, 0)
    return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0


def _scan(docs: DataFrame, bits: np.ndarray, spans: list[int]) -> DataFrame:
    """Per document: words, and the likely hits with the words around them."""

    def scan(batches):
        for batch in batches:
            n = batch.num_rows
            count = np.zeros(n, np.int64)
            hits: list[list] = [[] for _ in range(n)]
            for lo, hi, data, bounds in text_chunks(batch.column(2)):
                starts, ends, first = textnp.words(data, bounds, textnp.ALNUM)
                count[lo:hi] = np.diff(first)
                h = textnp.word_hashes(data, starts, ends)
                for span in spans:
                    prints, at = _fingerprints(h, first, span)
                    keep = _likely(prints, bits)
                    k, w = _scheme(span)
                    prints, at = prints[keep], at[keep]
                    rows = np.searchsorted(first, at, "right") - 1
                    for g, p, r in zip(prints.view(np.int64).tolist(), at.tolist(), rows.tolist()):
                        a, b = max(int(first[r]), p - w + 1), min(int(first[r + 1]), p + k + w - 1)
                        hits[lo + r].append({"print": g, "span": span, "start": a - int(first[r]), "around": _joined(data, starts, ends, a, b)})
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(count), pa.array(hits, HITS)], names=["row", "doc_id", "n_words", "hits"]
            )

    HITS = pa.list_(pa.struct([("print", pa.int64()), ("span", pa.int32()), ("start", pa.int64()), ("around", pa.string())]))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return arrow_map(docs, scan, f"row bigint, doc_id {kind}, n_words bigint, hits array<struct<print:bigint,span:int,start:bigint,around:string>>")


def contamination(docs: DataFrame, items: DataFrame, *, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = WINDOW) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    A document word inside any occurrence of an item's window is hit. Contaminated:
    n_hit > 0 and 20 * n_hit >= n_words. ``items_sha256`` is of the items' ids, sorted
    as strings and comma-joined. Null and empty texts have no words and no hits; rows
    that repeat a doc_id, or lack one, are judged each on its own; items without an id
    mark words but are not counted; an empty benchmark marks nothing. Other columns of
    the inputs are not looked at.
    """
    windows = settled(item_windows(items, item_id, item_text, window))
    spans = sorted(r[0] for r in windows.select("span").distinct().collect())  # window lengths: 13 values at most
    prints = windows.select(F.explode("prints").alias("print"), "span").distinct()
    source = docs.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    scanned = settled(_scan(source, _bitmap(prints), spans))

    hits = scanned.select("row", F.explode("hits").alias("h")).select("row", "h.*")
    hits = hits.join(prints, ["print", "span"], "left_semi")
    around = F.split("around", " ")
    spread = hits.select(
        "row", "span", F.posexplode(F.transform(F.sequence(F.lit(1), F.size(around) - F.col("span") + 1), lambda i: F.array_join(F.slice(around, i, F.col("span")), " "))).alias("i", "passage"), "start",
    )
    spread = spread.select("row", "span", (F.col("start") + F.col("i")).alias("start"), "passage").distinct()
    known = windows.select("span", "passage").distinct()
    found = settled(spread.join(known, ["span", "passage"], "left_semi"))

    in_order = Window.partitionBy("row").orderBy("start", "span")
    end = F.col("start") + F.col("span")
    reached = F.max(end).over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.greatest(end - F.greatest("start", F.coalesce(reached, F.lit(0))), F.lit(0))
    words = found.select("row", fresh.alias("fresh")).groupBy("row").agg(F.sum("fresh").alias("n_hit"))

    named = windows.where("item_id IS NOT NULL").select("span", "passage", F.col("item_id").cast("string").alias("item")).distinct()
    held = found.select("row", "span", "passage").distinct().join(named, ["span", "passage"]).select("row", "item").distinct()
    per_row = held.groupBy("row").agg(F.count("*").alias("n_items"), F.array_join(F.array_sort(F.collect_list("item")), ",").alias("items"))

    n_hit = F.coalesce("n_hit", F.lit(0))
    return (
        scanned.drop("hits").join(words, "row", "left").join(per_row, "row", "left")
        .select(
            "doc_id", "n_words", n_hit.alias("n_hit"), F.coalesce("n_items", F.lit(0)).alias("n_items"),
            F.sha2(F.coalesce("items", F.lit("")), 256).alias("items_sha256"),
            ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"),
        )
    )
