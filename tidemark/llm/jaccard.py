"""N-gram Jaccard join over count vectors: hash shingles into groups, index the group counts in R-trees, verify.

Two sets of shingles are linked when 100 * |A & B| >= percent * |A | B|. Then
|A ^ B| <= (|A| + |B|) * (100 - percent) / (100 + percent): few shingles differ.

1. Equal sets are one class; one member stands for it.
2. Shingles are hashed into G groups, G above the differing shingles that a link of
   that size allows. Each differing shingle touches one group, so linked sets agree in
   a whole group: the agreement (group, hash sum, count) is the key that brings them
   together, and no pair is lost. G belongs to a size class; a set just below a class
   boundary takes part in the class above too.
3. All sets that share a key with the same smallest set form a block. A block's sets
   are points: their shingles' counts in DIMS groups. In each page of a block (at
   most PAGE points, dealt by hash) an R-tree over the points gives, for each point,
   those whose summed coordinate minima reach the overlap that a link needs; they are
   verified on the whole sets, unless earlier links of the page connect them already.
   The block's smallest set is in each of its pages, so pages of copies connect there.
4. In blocks of several pages, sets that are not connected to the smallest one meet
   all pages of their block once more, in chunks of about PAGE sets.
5. Components of the links found: smallest label over neighbours, with label jumping.

Links that add nothing to a component are not listed; components lose none.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import textnp
from tidemark.llm.common import arrow_groups, arrow_map, settled, text_chunks

SHINGLE = 3
PERCENT = 90
DIMS = 64
PAGE = 1024
LEAF = 16
_U = np.uint64
_CLASS_RATIO = 1.5


def size_classes(percent: int, top: int = 1 << 40) -> list[int]:
    """Upper bounds of the size classes; the first holds the sets that only equal sets can link with."""
    alone = 0  # the nearest unequal sets have alone + 1 and alone + 2 shingles, and one differs
    while (2 * alone + 3) * (100 - percent) < 100 + percent and alone < 1 << 20:
        alone += 1
    out = [alone]
    while out[-1] < top:
        out.append(max(out[-1] + 1, int(out[-1] * _CLASS_RATIO)))
    return out


def allowed(total: int, percent: int) -> int:
    """The most shingles that may differ between linked sets of ``total`` shingles together."""
    return total * (100 - percent) // (100 + percent)


def class_groups(high: int, percent: int) -> int:
    """Groups of a size class: one more than can differ, and some for groups that are empty."""
    g = allowed(2 * high, percent) + 2
    return g + g // 256


def signatures(h: np.ndarray, high: int, percent: int) -> np.ndarray:
    """Keys of the set's groups in the class up to ``high``; ``h`` is sorted and distinct.

    Empty groups give no key, unless so many are empty that a partner might agree with
    the set in empty groups only; then they give keys too, so such partners meet there.
    """
    g = class_groups(high, percent)
    edges = (np.arange(1, g, dtype=np.float64) * (2.0**64 / g)).astype(_U)
    cut = np.concatenate([[0], np.searchsorted(h, edges), [len(h)]])
    sums = np.zeros(len(h) + 1, _U)
    np.cumsum(textnp.mixed(h), out=sums[1:])
    sums = sums[cut[1:]] - sums[cut[:-1]]
    filled = np.diff(cut)
    keys = textnp.mixed(textnp.mixed(sums + filled.astype(_U)) + np.arange(g, dtype=_U) * _U(0x9E3779B97F4A7C15) + _U(high))
    partner = min(high, len(h) * 100 // percent)
    empty = int((filled == 0).sum())
    return keys if empty and g - allowed(len(h) + partner, percent) - empty < 1 else keys[filled > 0]


def all_signatures(h: np.ndarray, classes: list[int], percent: int) -> np.ndarray:
    n = len(h)
    if n <= classes[0]:
        return np.zeros(0, _U)
    c = int(np.searchsorted(classes, n))
    out = [signatures(h, classes[c], percent)]
    if n * 100 >= (classes[c] + 1) * percent:  # a partner may be in the class above
        out.append(signatures(h, classes[c + 1], percent))
    return np.concatenate(out)


def _shingles(h: np.ndarray, k: int) -> np.ndarray:
    """The sorted distinct shingle hashes of one row's word hashes."""
    if len(h) == 0:
        return h
    return np.unique(textnp.gram_hashes(h, min(k, len(h)), salt=min(k, len(h))))


def _sets(column, k):
    """(row, sorted distinct shingle hashes) of each row of a batch column."""
    for lo, hi, data, bounds in text_chunks(column):
        starts, ends, first = textnp.words(data, bounds, textnp.NOT_SPACE)
        h = textnp.word_hashes(data, starts, ends)
        for i in range(hi - lo):
            yield lo + i, _shingles(h[first[i] : first[i + 1]], k)


def _fingerprint(h: np.ndarray) -> tuple[int, int, int]:
    """(size, h1, h2) of a shingle set, the hashes as signed 64-bit values."""
    sums = np.array([textnp.mixed(h).sum(dtype=_U), textnp.mixed(h ^ _U(0x5851F42D4C957F2D)).sum(dtype=_U)], _U).view(np.int64)
    return len(h), int(sums[0]), int(sums[1])


def _fingerprinted(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """(row, doc_id, mark, n, h1, h2, keys) of (row, doc_id, mark, text)."""
    classes = size_classes(percent)

    def scan(batches):
        for batch in batches:
            n, a, b, keys = [], [], [], []
            for _, h in _sets(batch.column(3), k):
                for column, value in zip((n, a, b), _fingerprint(h)):
                    column.append(value)
                keys.append(all_signatures(h, classes, percent).view(np.int64))
            flat = np.concatenate(keys) if keys else np.zeros(0, np.int64)
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in keys])]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], *(pa.array(x, pa.int64()) for x in (n, a, b)), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))],
                names=["row", "doc_id", "mark", "n", "h1", "h2", "keys"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return arrow_map(docs, scan, f"row bigint, doc_id {kind}, mark bigint, n bigint, h1 bigint, h2 bigint, keys array<bigint>")


def _points(docs: DataFrame, k: int, dims: int) -> DataFrame:
    """(id, n, h1, h2, again, point, hashes): a document's count vector and its whole shingle set, as bytes.

    Of (id, n, h1, h2, again, text) only the rows whose text has that fingerprint.
    """

    def scan(batches):
        for batch in batches:
            wanted = list(zip(*(c.to_pylist() for c in batch.columns[1:4])))
            rows, points, hashes = [], [], []
            for i, h in _sets(batch.column(5), k):
                if _fingerprint(h) == wanted[i]:
                    rows.append(i)
                    points.append(np.bincount((h >> _U(40)).astype(np.int64) % dims, minlength=dims).astype(np.int32).tobytes())
                    hashes.append(h.tobytes())
            kept = [c.take(pa.array(rows, pa.int64())) for c in batch.columns[:5]]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(points, pa.binary()), pa.array(hashes, pa.binary())], names=["id", "n", "h1", "h2", "again", "point", "hashes"])

    return arrow_map(docs, scan, "id bigint, n bigint, h1 bigint, h2 bigint, again boolean, point binary, hashes binary")


# ---- R-tree over count vectors --------------------------------------------------


class CountTree:
    """A packed R-tree over count vectors, searched by the overlap that coordinate minima allow."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray, leaf: int = LEAF):
        self.order = self._packed(points, sizes, leaf)
        self.points, self.sizes = points[self.order], sizes[self.order]
        self.levels = []  # from the leaves up: (coordinate maxima, least size, greatest size)
        top, low, high = self.points, self.sizes, self.sizes
        while len(top) > leaf or not self.levels:
            cuts = np.arange(0, len(top), leaf)
            top = np.maximum.reduceat(top, cuts)
            low, high = np.minimum.reduceat(low, cuts), np.maximum.reduceat(high, cuts)
            self.levels.append((top, low, high))
        self.leaf = leaf

    @staticmethod
    def _packed(points, sizes, leaf):
        """Sort-tile order: slabs by size, then by the widest coordinate, then by the next."""
        n = len(sizes)
        wide = np.argsort(-points.var(axis=0))[:2]
        order = np.argsort(sizes, kind="stable")
        slab = max(leaf, int(np.ceil(n / max(1, round((n / leaf) ** (1 / 3))))))
        out = []
        for i in range(0, n, slab):
            part = order[i : i + slab]
            part = part[np.argsort(points[part, wide[0]], kind="stable")]
            strip = max(leaf, int(np.ceil(len(part) / max(1, round((len(part) / leaf) ** 0.5)))))
            for j in range(0, len(part), strip):
                piece = part[j : j + strip]
                out.append(piece[np.argsort(points[piece, wide[-1]], kind="stable")])
        return np.concatenate(out)

    def search(self, point: np.ndarray, size: int, percent: int) -> np.ndarray:
        """Indices of the points whose overlap bound lets them link with a set of ``size``."""

        def may(top, low, high):
            least = np.maximum(low, -(-size * percent // 100))
            # a link of sizes a and b needs an overlap of (a + b) * percent / (100 + percent)
            need = (size + least) * percent
            fits = (low * percent <= size * 100) & (high * 100 >= size * percent)
            return fits & (np.minimum(top, point).sum(axis=1) * (100 + percent) >= need)

        at = np.arange(len(self.levels[-1][1]))
        for top, low, high in reversed(self.levels):
            at = at[may(top[at], low[at], high[at])]
            at = (at[:, None] * self.leaf + np.arange(self.leaf)).ravel()
            below = len(self.points) if top is self.levels[0][0] else len(self.levels[self._depth(top) - 1][1])
            at = at[at < below]
        at = at[may(self.points[at], self.sizes[at], self.sizes[at])]
        return self.order[at]

    def _depth(self, top) -> int:
        return next(i for i, level in enumerate(self.levels) if level[0] is top)


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Common values of two sorted distinct arrays."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum()) if len(b) else 0


def page_links(ids, points, hashes, percent, probes=None) -> list[tuple[int, int]]:
    """Links that connect the page's sets as all their links do; ``probes``: only from these."""
    sets = [np.frombuffer(x, _U) for x in hashes]
    sizes = np.array([len(x) for x in sets], np.int64)
    points = np.frombuffer(b"".join(points), np.int32).reshape(len(sets), -1)
    tree = CountTree(points, sizes)
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    out = []
    for i in range(len(sets)) if probes is None else probes:
        for j in np.sort(tree.search(points[i], int(sizes[i]), percent)).tolist():
            if j == i or find(i) == find(j):
                continue
            both = overlap(sets[i], sets[j])
            if 100 * both >= percent * (sizes[i] + sizes[j] - both):
                root[find(i)] = find(j)
                out.append((int(ids[i]), int(ids[j])))
    return out


# ---- components -----------------------------------------------------------------


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node of each node's component; nodes without edges are left out.

    Each round takes the least label among neighbours, then the label's own label. Only
    counts reach the driver.
    """
    both = settled(edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a")).distinct())
    labels = settled(both.groupBy(F.col("u").alias("node")).agg(F.least(F.min("v"), F.first("u")).alias("label")))
    while True:
        near = both.join(labels.select(F.col("node").alias("v"), F.col("label").alias("near")), "v")
        least = near.groupBy(F.col("u").alias("node")).agg(F.min("near").alias("near"))
        stepped = labels.join(least, "node").select("node", F.col("label").alias("was"), F.least("label", "near").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
        stepped = settled(stepped.join(jump, "label", "left").select("node", "was", F.least("label", F.coalesce("further", "label")).alias("label")))
        labels = stepped.select("node", "label")
        if stepped.where("was <> label").isEmpty():
            return labels


def similarity_classes(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, percent: int = PERCENT, dims: int = DIMS, page: int = PAGE) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest doc_id reachable by links).

    A document's set: distinct ``shingle``-word shingles of its whole text, A-Z
    lower-cased; with fewer words, the whole sequence as one. Without words or text the
    set is empty and linked with nothing. Rows that repeat a doc_id are one document
    when their component is taken (each row is returned with its own n_shingles); rows
    without a doc_id are returned without a component and link nothing. doc_id is an
    integer. Other columns are not looked at.
    """
    # A row's number is made once, in what is written here; texts are read again by what they themselves are.
    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).withColumn("mark", F.xxhash64("text"))
    numbered = source.select(F.monotonically_increasing_id().alias("row"), "doc_id", "mark", "text")
    marked = settled(_fingerprinted(numbered, shingle, percent))
    known = marked.where("n > 0 AND doc_id IS NOT NULL")
    best = F.min_by(F.struct("row", "mark"), F.struct("doc_id", "row"))
    classes = known.groupBy("n", "h1", "h2").agg(F.min("doc_id").alias("id"), best.alias("best")).select("n", "h1", "h2", "id", "best.row", "best.mark")
    classes = settled(classes)

    # blocks: the smallest set of each key, and those that share the key
    # (dealt by key once: most keys occur once, so counting them first would shuffle as many rows again)
    keyed = marked.join(classes.select("row", "id"), "row").select("id", F.explode("keys").alias("key")).repartition("key")
    shared = keyed.groupBy("key").agg(F.min("id").alias("block"), F.max("id").alias("last")).where("block < last").select("key", "block")
    members = settled(keyed.join(shared, "key").select("block", "id").distinct())

    # a class's points come from the text of the row that stands for it, or of one that is equal in doc_id and text
    used = members.select("id").distinct().join(classes, "id")
    copies = known.groupBy(F.col("doc_id").alias("id"), "mark").count().where("count > 1")
    used = used.join(copies, ["id", "mark"], "left").select("id", "mark", "n", "h1", "h2", F.col("count").isNotNull().alias("again"))
    texts = source.join(used.withColumnRenamed("id", "doc_id"), ["doc_id", "mark"])
    points = settled(_points(texts.select(F.col("doc_id").alias("id"), "n", "h1", "h2", "again", "text"), shingle, dims))
    again = points.where("again")
    if not again.isEmpty():
        points = points.where("NOT again").union(settled(again.dropDuplicates(["id", "n", "h1", "h2"])))
    points = points.select("id", "point", "hashes")

    width = members.groupBy("block").agg(F.ceil(F.count("*") / page).cast("int").alias("pages"))
    dealt = members.join(width, "block").select("block", "id", "pages", F.pmod(F.xxhash64("id"), "pages").cast("int").alias("page"))
    dealt = settled(dealt)
    leaders = dealt.where("pages > 1 AND id = block").select("block", "id", "pages", F.explode(F.sequence(F.lit(0), F.col("pages") - 1)).alias("page"))
    first = dealt.union(leaders.select("block", "id", "pages", "page")).distinct().withColumn("chunk", F.lit(0))
    found = settled(_paged(first.withColumn("probe", F.lit(True)), points, percent))

    # blocks of several pages: what the block's smallest set does not reach meets every page
    own = found.where("pages > 1").select("block", "page", "a", "b")
    reach = _page_reach(dealt.where("pages > 1"), own)
    rest = settled(dealt.where("pages > 1").join(reach, ["block", "page", "id"], "left_anti"))
    if not rest.isEmpty():
        second = _second_search(dealt.where("pages > 1"), rest, page)
        found = found.union(settled(_paged(second, points, percent)))

    links = found.select("a", "b")
    same = known.join(classes.select("n", "h1", "h2", "id"), ["n", "h1", "h2"]).select(F.col("doc_id").alias("a"), F.col("id").alias("b")).where("a <> b")
    labels = components(links.union(same))
    return (
        marked.join(labels.withColumnRenamed("node", "doc_id"), "doc_id", "left")
        .select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("label", "doc_id").alias("component_id"))
    )


def _second_search(dealt: DataFrame, rest: DataFrame, page: int) -> DataFrame:
    """(block, page, chunk, id, pages, probe): every page of a block once with each chunk of its ``rest``.

    A chunk is about ``page`` sets, so a group is about two pages, however large the block and its rest.
    """
    chunks = rest.groupBy("block").agg(F.ceil(F.count("*") / page).cast("int").alias("chunks"))
    all_of = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    own = F.pmod(F.xxhash64(F.lit("chunk"), "id"), F.col("chunks")).cast("int").alias("chunk")
    probes = rest.join(chunks, "block").select("block", all_of("pages").alias("page"), own, "id", "pages", F.lit(True).alias("probe"))
    others = dealt.join(chunks, "block").select("block", "page", all_of("chunks").alias("chunk"), "id", "pages", F.lit(False).alias("probe"))
    return probes.union(others).groupBy("block", "page", "chunk", "id").agg(F.max("pages").alias("pages"), F.max("probe").alias("probe"))


def _paged(dealt: DataFrame, points: DataFrame, percent: int) -> DataFrame:
    """(block, page, pages, a, b): connecting links within each page and chunk of each block, from its probes."""

    def search(key, table):
        probes = np.flatnonzero(table.column("probe").to_numpy(zero_copy_only=False))
        found = page_links(table.column("id").to_numpy(), table.column("point").to_pylist(), table.column("hashes").to_pylist(), percent, probes.tolist())
        a, b = [x for x, _ in found], [y for _, y in found]
        n = len(found)
        return pa.table({"block": pa.array([key[0].as_py()] * n, pa.int64()), "page": pa.array([key[1].as_py()] * n, pa.int32()), "pages": pa.array([table.column("pages")[0].as_py()] * n, pa.int32()), "a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    rows = dealt.join(points, "id")
    return arrow_groups(rows, ["block", "page", "chunk"], search, "block bigint, page int, pages int, a bigint, b bigint")


def _page_reach(dealt: DataFrame, links: DataFrame) -> DataFrame:
    """(block, page, id) of the sets that their page's links connect to the block's smallest set."""
    def spread(key, table):
        root: dict[int, int] = {}

        def find(i):
            while root.setdefault(i, i) != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        for a, b in zip(table.column("a").to_pylist(), table.column("b").to_pylist()):
            root[find(a)] = find(b)
        top = find(key[0].as_py())
        ids = [i for i in list(root) if find(i) == top]
        return pa.table({"block": pa.array([key[0].as_py()] * len(ids), pa.int64()), "page": pa.array([key[1].as_py()] * len(ids), pa.int32()), "id": pa.array(ids, pa.int64())})

    connected = arrow_groups(links, ["block", "page"], spread, "block bigint, page int, id bigint")
    leaders = dealt.where("id = block").select("block", "page", "id")
    return connected.union(leaders).distinct()
