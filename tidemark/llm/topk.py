"""Exact top-k inner products by a pivot-distance index.

Vectors become integers, floor(256 * x). One more coordinate, sqrt(R^2 - |x|^2) with R
the greatest norm, makes all of one length (a query's is 0), so the greatest inner
product is the least distance. Every vector is keyed by its nearest pivot and its
distance to it; sorted by both, they are cut into annuli of a pivot, of at most ``block``
vectors. For a query at distance d from the pivot, a vector of the annulus [lo, hi] is
no nearer than max(lo - d, d - hi): its inner product has a bound.

A query first expands the annuli of the greatest bounds; its k-th best score there is
its threshold. It then visits only the annuli whose bound reaches the threshold, and
stops; all others cannot hold a better or an equal score. Pivots are fitted on at most
``PIVOT_SAMPLE`` vectors; every vector is indexed.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import arrow_map, settled, shipped

K = 5
SCALE = 256
PIVOTS = 64
PIVOT_SAMPLE = 4096
#: Vectors of an annulus; annuli of an index, at most (beyond, they grow); queries that travel together.
BLOCK = 2048
DIRECTORY = 1 << 15
QUERIES = 256
#: Query packets of one task and annulus.
TOGETHER = 16
#: Annuli that a query expands before it has a threshold.
FIRST = 2


def integers(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(vec_id, v, norm2): 64-bit whole components as bytes, and the squared length.

    Vectors that are null, hold a null or non-finite component, or one of 2^62 or more once
    scaled (whose scores no 64-bit number holds), are left out, and so are rows without a vec_id.
    """

    def run(batches):
        for batch in batches:
            ids, out, norms = [], [], []
            column = batch.column(1)
            values = column.values.to_numpy(zero_copy_only=False).astype(np.float64)  # null components become NaN
            offsets = column.offsets.to_numpy()
            known = ~np.asarray(column.is_null())
            numbers = batch.column(0).to_pylist()
            for i in range(batch.num_rows):
                x = np.floor(values[offsets[i] : offsets[i + 1]] * scale)
                if known[i] and numbers[i] is not None and np.isfinite(x).all() and (np.abs(x) < 2**62).all():
                    x = x.astype("<i8")
                    ids.append(numbers[i])
                    out.append(x.tobytes())
                    norms.append(float((x.astype(np.float64) ** 2).sum()))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(out, pa.binary()), pa.array(norms, pa.float64())], names=["vec_id", "v", "norm2"])

    source = df.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
    return arrow_map(source, run, "vec_id bigint, v binary, norm2 double")


def matrix(rows: list[bytes], dim: int) -> np.ndarray:
    """Rows of the integer vectors; shorter ones end in zeros."""
    if all(len(r) == 8 * dim for r in rows):
        return np.frombuffer(b"".join(rows), "<i8").reshape(len(rows), dim)
    out = np.zeros((len(rows), dim), np.int64)
    for i, r in enumerate(rows):
        out[i, : len(r) // 8] = np.frombuffer(r, "<i8")
    return out


def packed(x: np.ndarray) -> bytes:
    """Rows of whole numbers, in 4 bytes each where all fit."""
    return x.astype("<i4" if np.abs(x).max(initial=0) < 2**31 else "<i8").tobytes()


def unpacked(data: bytes, n: int, dim: int) -> np.ndarray:
    return np.frombuffer(data, "<i4" if len(data) == 4 * n * dim else "<i8").reshape(n, dim).astype(np.int64)


def lifted(x: np.ndarray, top: float) -> np.ndarray:
    """The vectors with the coordinate that gives all the squared length ``top``."""
    extra = np.sqrt(np.maximum(top - (x**2).sum(axis=1), 0.0))
    return np.hstack([x, extra[:, None]])


def distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    square = (x**2).sum(axis=1)[:, None] + (pivots**2).sum(axis=1)[None, :] - 2 * x @ pivots.T
    return np.sqrt(np.maximum(square, 0.0))


def choose_pivots(x: np.ndarray, n: int, rounds: int = 8) -> np.ndarray:
    """Means of clusters of the sample: farthest-first seeds, then Lloyd's steps."""
    if len(x) == 0:
        return np.zeros((0, x.shape[1]))
    seeds = [0]
    near = ((x - x[0]) ** 2).sum(axis=1)
    while len(seeds) < min(n, len(x)) and near.max() > 0:
        seeds.append(int(near.argmax()))
        near = np.minimum(near, ((x - x[seeds[-1]]) ** 2).sum(axis=1))
    pivots = x[seeds]
    for _ in range(rounds):
        own = distances(x, pivots).argmin(axis=1)
        pivots = np.array([x[own == p].mean(axis=0) if (own == p).any() else pivots[p] for p in range(len(pivots))])
    return pivots


def _dot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products: floating while they fit 53 bits, else 64-bit integers."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(a.shape[1], 1)
    if most < 2**53:
        return (a.astype(float) @ b.astype(float).T).astype(np.int64)
    return a @ b.T


def build(vectors: DataFrame, *, pivots: int = PIVOTS, block: int = BLOCK):
    """(index, pivots, top, dim): the annuli, each a row of packed vectors, kept in the shared folder."""
    n, top, longest = vectors.agg(F.count("*"), F.max("norm2"), F.max(F.length("v"))).first()
    dim, top = (longest or 0) // 8, float(top or 0.0)
    sample = vectors.orderBy(F.xxhash64("vec_id"), "vec_id", "v").limit(PIVOT_SAMPLE).select("v").collect()  # PIVOT_SAMPLE rows at most
    centre = choose_pivots(lifted(matrix([bytes(r[0]) for r in sample], dim).astype(float), top), pivots)
    block = max(block, n // DIRECTORY)

    def key(batches):
        for batch in batches:
            if batch.num_rows == 0:
                continue
            d = distances(lifted(matrix(batch.column(1).to_pylist(), dim).astype(float), top), centre)
            own = d.argmin(axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(own.astype(np.int32)), pa.array(d[np.arange(len(own)), own]), batch.column(0), batch.column(1)], names=["pivot", "distance", "vec_id", "v"])

    def cut(batches):
        from pyspark import TaskContext

        made, held = 0, []
        pid = TaskContext.get().partitionId()

        def annulus(rows):
            nonlocal made
            made += 1
            p, d, ids, v = zip(*rows)
            rows = packed(matrix(list(v), dim))
            return [(pid << 32) + made, p[0], min(d), max(d), len(ids), np.array(ids, "<i8").tobytes(), rows]

        def out(rows):
            kinds = (pa.int64(), pa.int32(), pa.float64(), pa.float64(), pa.int32(), pa.binary(), pa.binary())
            names = ["block", "pivot", "lo", "hi", "n", "ids", "vectors"]
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)

        for batch in batches:
            done = []
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if held and (held[0][0] != row[0] or len(held) >= block):
                    done.append(annulus(held))
                    held = []
                held.append(row)
            yield out(done)
        if held:
            yield out([annulus(held)])

    keyed = arrow_map(vectors.select("vec_id", "v"), key, "pivot int, distance double, vec_id bigint, v binary")
    parts = max(1, math.ceil(n / (4 * block)))
    ranged = keyed.repartitionByRange(parts, "pivot", "distance", "vec_id").sortWithinPartitions("pivot", "distance", "vec_id")
    index = arrow_map(ranged, cut, "block bigint, pivot int, lo double, hi double, n int, ids binary, vectors binary")
    return settled(index), centre, top, dim


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Positions of the ``k`` highest scores, ties to the smaller id, best first."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        at = np.flatnonzero(scores >= least)
    else:
        at = np.arange(len(scores))
    return at[np.lexsort((ids[at], -scores[at]))][:k]


def top_k(vectors: DataFrame, queries: DataFrame, *, k: int = K, pivots: int = PIVOTS, block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``k`` highest inner products among the other vec_ids.

    ``vectors`` and ``queries`` are rows of ``integers``. Ties go to the smaller vec_id;
    fewer than ``k`` candidates are all returned. Vectors of different length are
    compared over their common components. Rows that repeat a vec_id are candidates
    each, but never of a query of their own id; queries that repeat an id are answered
    together. An empty table gives no rows.
    """
    index, centre, top, dim = build(vectors, pivots=pivots, block=block)
    known = index.select("block", "pivot", "lo", "hi", "n").collect()  # DIRECTORY annuli and some at most
    if not known:
        return vectors.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    blocks = np.array([r["block"] for r in known], np.int64)
    of_pivot = np.array([r["pivot"] for r in known])
    lo, hi = np.array([r["lo"] for r in known]), np.array([r["hi"] for r in known])

    def bounds(q: np.ndarray) -> np.ndarray:
        """The greatest score that each annulus (columns) may hold for each query, rounding errors included."""
        d = distances(np.hstack([q, np.zeros((len(q), 1))]), centre)[:, of_pivot]
        slack = 1e-6 * (1.0 + math.sqrt(top) + d)
        gap = np.maximum(np.maximum(lo[None, :] - d, d - hi[None, :]) - slack, 0.0)
        return ((q**2).sum(axis=1)[:, None] + top - gap**2) / 2 + 1.0 + 1e-9 * top

    def packets(batches, first: bool):
        from pyspark import TaskContext

        sent, pid = 0, TaskContext.get().partitionId()
        for batch in batches:
            for a in range(0, batch.num_rows, QUERIES):
                part = batch.slice(a, QUERIES)
                ids = part.column(0).to_numpy()
                q = matrix(part.column(1).to_pylist(), dim)
                most = bounds(q.astype(float))
                begun = np.zeros(most.shape, bool)
                np.put_along_axis(begun, np.argsort(-most, axis=1, kind="stable")[:, :FIRST], True, axis=1)
                if first:
                    use = begun
                else:
                    floor = part.column(2).to_numpy(zero_copy_only=False).astype(np.float64)  # NaN: no threshold yet
                    use = ~begun & ~(most < floor[:, None])
                rows = []
                for j in np.flatnonzero(use.any(axis=0)).tolist():
                    i = np.flatnonzero(use[:, j])
                    rows.append((int(blocks[j]), (pid << 32) + sent // TOGETHER, ids[i].astype("<i8").tobytes(), packed(q[i])))
                sent += 1
                yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in enumerate((pa.int64(), pa.int64(), pa.binary(), pa.binary()))], names=["block", "packet", "qids", "qvectors"])

    def match(key, left, right):
        names = ["query_id", "vec_id", "score"]
        out: list[tuple] = []
        if left.num_rows and right.num_rows:
            ids = np.frombuffer(left.column("ids")[0].as_py(), "<i8")
            x = unpacked(left.column("vectors")[0].as_py(), len(ids), dim)
            for qids, qs in zip(right.column("qids").to_pylist(), right.column("qvectors").to_pylist()):
                qids = np.frombuffer(qids, "<i8")
                q = unpacked(qs, len(qids), dim)
                scores = _dot(q, x)
                for i, me in enumerate(qids.tolist()):
                    other = np.flatnonzero(ids != me)
                    best = other[_best(ids[other], scores[i, other], k)]
                    out += [(me, int(ids[b]), int(scores[i, b])) for b in best.tolist()]
        return pa.table({n: pa.array([r[c] for r in out], pa.int64()) for c, n in enumerate(names)})

    shipped(vectors.sparkSession)

    def visited(asked: DataFrame, first: bool) -> DataFrame:
        schema = "block bigint, packet bigint, qids binary, qvectors binary"
        wanted = arrow_map(asked, lambda batches: packets(batches, first), schema)
        wanted = settled(wanted)
        copies = wanted.select("block", "packet").distinct().join(index.select("block", "ids", "vectors"), "block")
        copies = copies.select(F.col("block").alias("at"), F.col("packet").alias("part"), "ids", "vectors")
        pairs = copies.groupBy("at", "part").cogroup(wanted.groupBy("block", "packet"))
        found = pairs.applyInArrow(match, "query_id bigint, vec_id bigint, score bigint")
        return _ranked(found, k)

    asked = queries.select("vec_id", "v").repartition(max(1, math.ceil(queries.count() / (4 * QUERIES))))
    begun = settled(visited(asked, True))
    floors = begun.where(F.col("rank") == k).groupBy("query_id").agg(F.max("score").alias("floor"))
    again = queries.select("vec_id", "v").join(floors, queries["vec_id"] == floors["query_id"], "left").select("vec_id", "v", "floor")
    rest = visited(again, False)
    both = begun.select("query_id", "vec_id", "score").union(rest.select("query_id", "vec_id", "score"))
    return _ranked(both, k).select("query_id", "rank", "vec_id", "score")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


