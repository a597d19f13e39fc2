"""Near-duplicate vectors by E8 lattice hashing.

Two vectors are linked when their cosine is at least ``cosine``.

1. Equal vectors are one class, which weighs as many rows as it has.
2. Each table projects unit vectors at random to ``blocks`` times 8 dimensions and decodes
   every 8 of them to the nearest point of the lattice E8: that is the vector's own cell.
   It also probes the ``probes`` neighbouring cells (one block moved by one of the 240
   shortest lattice vectors) that it is nearest to. Two vectors meet in a table if one's
   own cell is the other's own or probed cell.
3. Rows (cell, class, sketch) bring cells together; 32 bytes of another projection tell
   nearly all strangers apart, and only rows that are near another one of their cell get
   their vectors. Cells over ``PAGE`` rows skip this filter: all their rows go on.
4. Vectors of a cell are compared by their cosines in double precision. A pair counts in
   the first cell in which it meets (tables in order), so it counts once; it is never a
   row. A task returns each class's number of links and a forest of links. Cells over
   ``PAGE`` rows are dealt over pairs of pages: every row meets every own row there.
5. Components of the forest: smallest label over neighbours, with label jumping.

The tables grow with the number of classes (``lattice``): more blocks keep the strangers
of a cell few, more tables keep the recall. At a cosine of exactly 0.9 in 64 dimensions a
pair meets in one of the tables with a probability of 0.99 up to 2^20 classes; nearer
pairs are found more often. The work of one group of near copies grows with the square
of its size (in comparisons, not in rows), as every vector's links are counted.
"""

from __future__ import annotations

import math
from functools import lru_cache
from itertools import combinations, product
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import arrow_groups, arrow_map, settled
from tidemark.llm.jaccard import components
from tidemark.llm.textnp import mixed

COSINE = 0.9
#: Rows of a cell that one task compares with as many others.
PAGE = 4096
SKETCH = 32
#: A sketch passes up to this many times the squared distance that a link allows.
SLACK = 2.3
SEED = 20
_U = np.uint64


class Lattice(NamedTuple):
    """``blocks`` E8 points a key, cells of ``width`` (of the projection's unit), ``probes``, ``tables``."""

    blocks: int
    width: float
    probes: int
    tables: int


def lattice(classes: int) -> Lattice:
    """Tables for so many classes; see the module's text."""
    if classes <= 1 << 20:
        return Lattice(1, 1.6, 6, 4)
    if classes <= 1 << 27:
        return Lattice(2, 2.0, 12, 8)
    return Lattice(3, 2.0, 12, 24)


# ---- E8 ---------------------------------------------------------------------------


def _checkerboard(x: np.ndarray) -> np.ndarray:
    """The nearest points of D8: whole coordinates of an even sum."""
    near = np.rint(x)
    gap = x - near
    worst = np.abs(gap).argmax(axis=-1)[..., None]
    step = np.where(np.take_along_axis(gap, worst, -1) >= 0, 1.0, -1.0)
    odd = (near.sum(axis=-1, keepdims=True) % 2) != 0
    np.put_along_axis(near, worst, np.take_along_axis(near, worst, -1) + np.where(odd, step, 0.0), -1)
    return near


def decode(x: np.ndarray) -> np.ndarray:
    """The nearest points of E8 (D8, or D8 shifted by one half) to the rows of 8 coordinates."""
    whole, half = _checkerboard(x), _checkerboard(x - 0.5) + 0.5
    nearer = ((x - whole) ** 2).sum(axis=-1) <= ((x - half) ** 2).sum(axis=-1)
    return np.where(nearer[..., None], whole, half)


@lru_cache(maxsize=1)
def neighbours() -> np.ndarray:
    """The 240 shortest vectors of E8."""
    out = []
    for i, j in combinations(range(8), 2):
        for a, b in product((1.0, -1.0), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = a, b
            out.append(v)
    out += [np.array(s) for s in product((0.5, -0.5), repeat=8) if sum(x < 0 for x in s) % 2 == 0]
    return np.array(out)


@lru_cache(maxsize=64)
def projection(dim: int, to: int, salt: int) -> np.ndarray:
    """``dim`` by ``to``: directions that keep a squared length as ``to`` on average."""
    draw = np.random.default_rng([SEED, salt, dim, to]).normal(size=(dim, to))
    return np.linalg.qr(draw)[0] * math.sqrt(dim) if to <= dim else draw


def cells(unit: np.ndarray, plan: Lattice) -> tuple[np.ndarray, np.ndarray]:
    """(own, probed): 64-bit keys of the cells, one for each table, ``probes`` for each table in turn."""
    n, dim = unit.shape
    own = np.empty((n, plan.tables), _U)
    probed = np.empty((n, plan.tables, plan.probes), _U)
    near = neighbours()
    for t in range(plan.tables):
        x = (unit @ projection(dim, 8 * plan.blocks, t)).reshape(n, plan.blocks, 8) / plan.width
        at = decode(x)
        further = -2.0 * np.einsum("nbd,gd->nbg", x - at, near).reshape(n, -1)
        best = np.argpartition(further, plan.probes, axis=1)[:, : plan.probes]
        own[:, t] = _key(at, t, dim)
        for p in range(plan.probes):
            moved = at.copy()
            moved[np.arange(n), best[:, p] // 240] += near[best[:, p] % 240]
            probed[:, t, p] = _key(moved, t, dim)
    return own, probed.reshape(n, -1)


def _key(points: np.ndarray, t: int, dim: int) -> np.ndarray:
    doubled = np.rint(2 * points).astype(np.int64).reshape(len(points), -1).view(_U)
    h = np.full(len(points), t * 0x9E3779B97F4A7C15 + dim & (1 << 64) - 1, _U)
    for i in range(doubled.shape[1]):
        h = mixed(h + doubled[:, i] * _U(0xD1342543DE82EF95) + _U(i + 1))
    return h


def sketches(unit: np.ndarray) -> np.ndarray:
    """``SKETCH`` signed bytes of each unit vector: distances between them are near those of the vectors."""
    dim = unit.shape[1]
    z = unit @ projection(dim, SKETCH, -1 & 0xFFFF) / math.sqrt(SKETCH)
    return np.clip(np.rint(z * 90), -127, 127).astype(np.int8)


def units(x: np.ndarray) -> np.ndarray:
    """Rows of length 1; scaled by the greatest component first, so no square over- or underflows."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


# ---- steps ------------------------------------------------------------------------


def encoded(df: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """(vec_id, v): components as bytes, 4 each of a float column and 8 each of others; null if the vector links with nothing."""
    kind = df.schema[vector].dataType.simpleString()
    small = kind == "array<float>"

    def run(batches):
        for batch in batches:
            column = batch.column(1)
            values = column.values.to_numpy(zero_copy_only=False).astype("<f4" if small else "<f8")  # null components become NaN
            values = values + values.dtype.type(0)  # no negative zeros
            at, known = column.offsets.to_numpy(), ~np.asarray(column.is_null())
            fine = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
            there = np.concatenate([[0], np.cumsum(values != 0)])
            ok = known & (fine[at[1:]] == fine[at[:-1]]) & (there[at[1:]] > there[at[:-1]])
            out = [values[a:b].tobytes() if good else None for a, b, good in zip(at[:-1], at[1:], ok)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=["vec_id", "v"])

    source = df.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast(kind if small else "array<double>").alias("v"))
    return arrow_map(source, run, "vec_id bigint, v binary").withColumn("width", F.lit(4 if small else 8))


def _vectors(column, width: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Dimension -> (positions, rows) of the byte vectors."""
    lengths = np.array([len(x) for x in column])
    out = {}
    for n in np.unique(lengths).tolist():
        at = np.flatnonzero(lengths == n)
        x = np.frombuffer(b"".join(column[i] for i in at.tolist()), f"<f{width}").reshape(len(at), -1)
        out[n // width] = (at, x.astype(np.float64))
    return out


def _indexed(classes: DataFrame, plan: Lattice, width: int) -> DataFrame:
    """Adds ``own``, ``probed`` and ``sketch`` to (id, weight, least, v)."""

    def run(batches):
        for batch in batches:
            for part in (batch.slice(i, 256) for i in range(0, batch.num_rows, 256)):
                n = part.num_rows
                own, probed = np.zeros((n, plan.tables), _U), np.zeros((n, plan.tables * plan.probes), _U)
                short = np.zeros((n, SKETCH), np.int8)
                for at, x in _vectors(part.column(3).to_pylist(), width).values():
                    x = units(x)
                    own[at], probed[at] = cells(x, plan)
                    short[at] = sketches(x)
                lists = [pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * a.shape[1]), pa.array(a.view(np.int64).ravel())) for a in (own, probed)]
                yield pa.RecordBatch.from_arrays([*part.columns, *lists, pa.array([r.tobytes() for r in short], pa.binary())], names=["id", "weight", "least", "v", "own", "probed", "sketch"])

    schema = "id bigint, weight bigint, least bigint, v binary, own array<bigint>, probed array<bigint>, sketch binary"
    return arrow_map(classes, run, schema)


def _near_another(rows: DataFrame, limit: float) -> DataFrame:
    """The (key, t, id, own) whose sketch is near that of an own row of the cell, or of any row if it is an own one.

    ``rows`` are (key, t, id, own, sketch), of few rows a key.
    """

    def marks(own: np.ndarray, s: np.ndarray) -> np.ndarray:
        s = s.astype(np.float32)
        square = (s * s).sum(axis=1)
        found = np.zeros(len(s), bool)
        home = np.flatnonzero(own)
        for a in range(0, len(home), 512):
            o = home[a : a + 512]
            close = square[o][:, None] + square[None, :] - 2 * s[o] @ s.T <= limit
            close[np.arange(len(o)), o] = False
            found |= close.any(axis=0)
            found[o] |= close.any(axis=1)
        return found

    def run(batches):
        held = None

        def done(part: pa.Table, end: int) -> pa.RecordBatch:
            key, own = part.column("key").to_numpy()[:end], np.asarray(part.column("own"))[:end]
            s = np.frombuffer(b"".join(part.column("sketch").to_pylist()[:end]), np.int8).reshape(end, SKETCH)
            cut = np.append(np.flatnonzero(np.append(True, key[1:] != key[:-1])) if end else [], end).astype(np.int64)
            homes = np.concatenate([[0], np.cumsum(own)])
            keep = np.zeros(end, bool)
            for i in np.flatnonzero((np.diff(cut) > 1) & (homes[cut[1:]] > homes[cut[:-1]])).tolist():
                a, b = cut[i], cut[i + 1]
                keep[a:b] = marks(own[a:b], s[a:b])
            return part.slice(0, end).select(["key", "t", "id", "own"]).filter(pa.array(keep)).combine_chunks()

        for batch in batches:
            if batch.num_rows == 0:
                continue
            held = pa.table(batch) if held is None else pa.concat_tables([held, pa.table(batch)])
            key = held.column("key").to_numpy()
            end = int(np.flatnonzero(key != key[-1])[-1]) + 1 if key[0] != key[-1] else 0
            if end:
                yield from done(held, end).to_batches()
                held = held.slice(end)
        if held is not None:
            yield from done(held, held.num_rows).to_batches()

    dealt = rows.repartition("key").sortWithinPartitions("key")
    return arrow_map(dealt.select("key", "t", "id", "own", "sketch"), run, "key bigint, t int, id bigint, own boolean")


def _linked(rows: DataFrame, plan: Lattice, cosine: float, width: int) -> DataFrame:
    """(id, links, other): weights of the links counted for ``id`` here, or (links null) a link of the task's forest."""

    def pairs(table: pa.Table, t: int):
        ids = table.column("id").to_numpy()
        order = np.argsort(ids, kind="stable")
        table, ids = table.take(pa.array(order)), ids[order]
        weight = table.column("weight").to_numpy()
        own = table.column("cells").combine_chunks().flatten().to_numpy().reshape(len(ids), -1)
        probed = table.column("probed").combine_chunks().flatten().to_numpy().reshape(len(ids), plan.tables, -1)
        asks, holds = np.asarray(table.column("asks")), np.asarray(table.column("holds"))

        def probes(a, b, s):  # whether a probes b's cell of table s
            return (probed[a, s] == own[b, s][:, None]).any(axis=1)

        links, root = np.zeros(len(ids), np.int64), np.arange(len(ids))

        def find(i):
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        forest = []

        def unite(a, b):
            while True:
                while (root[root] != root).any():
                    root[:] = root[root]
                apart = root[a] != root[b]
                a, b = a[apart], b[apart]
                if len(a) == 0:
                    return
                pick = np.unique(root[a], return_index=True)[1]
                for i, j in zip(a[pick].tolist(), b[pick].tolist()):
                    x1, x2 = find(i), find(j)
                    if x1 != x2:
                        root[x1] = x2
                        forest.append((i, j))

        for at, x in _vectors(table.column("v").to_pylist(), width).values():
            x = units(x)
            homes, askers = at[holds[at]], at[asks[at]]
            xh, xa = x[holds[at]], x[asks[at]]
            for i in range(0, len(homes), 256):
                score = xh[i : i + 256] @ xa.T
                o, r = np.nonzero(score >= cosine - 1e-12)
                edge = np.flatnonzero(score[o, r] < cosine + 1e-12)
                exact = [math.fsum(xh[i + a] * xa[b]) >= cosine for a, b in zip(o[edge].tolist(), r[edge].tolist())]
                fine = np.ones(len(o), bool)
                fine[edge] = exact
                o, r = homes[i + o[fine]], askers[r[fine]]
                same = own[o, t] == own[r, t]
                first = (o != r) & np.where(same, o < r, True)
                o, r, same = o[first], r[first], same[first]
                # the larger class's cell counts only if the smaller's own cell is not probed by the larger
                later = ~same & (o > r) & probes(o, r, t)
                for s in range(t):
                    later |= (own[o, s] == own[r, s]) | probes(o, r, s) | probes(r, o, s)
                o, r = o[~later], r[~later]
                np.add.at(links, o, weight[r])
                np.add.at(links, r, weight[o])
                unite(o, r)
        return ids, links, forest

    def search(key, table):
        ids, links, forest = pairs(table, int(key[1].as_py()))
        some = np.flatnonzero(links)
        a = np.concatenate([ids[some], [ids[i] for i, _ in forest]]).astype(np.int64)
        b = pa.array(np.concatenate([links[some], np.zeros(len(forest), np.int64)]).astype(np.int64), mask=np.arange(len(a)) >= len(some))
        c = pa.array(np.concatenate([np.zeros(len(some), np.int64), [ids[j] for _, j in forest]]).astype(np.int64), mask=np.arange(len(a)) < len(some))
        return pa.table({"id": pa.array(a), "links": b, "other": c})

    return arrow_groups(rows, ["key", "t", "page", "chunk"], search, "id bigint, links bigint, other bigint")


def near_duplicates(df: DataFrame, *, vec_id: str = "vec_id", vector: str = "embedding", cosine: float = COSINE, plan: Lattice | None = None, page: int = PAGE) -> DataFrame:
    """One row per row of ``df``: vec_id, n_links, component_id, kept.

    ``n_links``: other rows linked directly; ``component_id``: the smallest vec_id that
    links reach, the row's own included; ``kept``: vec_id = component_id. Vectors that are
    null, empty, zero or hold a null or non-finite component link with nothing; vectors
    of different length are not linked. Rows that repeat a vec_id are vectors each, linked
    if they are alike. A row without a vec_id takes part but is never kept; its component_id
    is null if its links reach no vec_id. An empty table gives no rows. Other columns are
    not looked at.
    """
    rows = encoded(df, vec_id, vector)
    width = 4 if df.schema[vector].dataType.simpleString() == "array<float>" else 8
    rows = rows.select("vec_id", "v", F.xxhash64("v").alias("h1"), F.xxhash64(F.lit(1), "v").alias("h2"))
    grouped = rows.where("v IS NOT NULL").groupBy("v").agg(F.count("*").alias("weight"), F.min("vec_id").alias("least"))
    grouped = settled(grouped.select(F.monotonically_increasing_id().alias("id"), "weight", "least", "v"))
    plan = plan or lattice(grouped.count())
    classes = settled(_indexed(grouped, plan, width))

    met = classes.select("id", "sketch", F.posexplode(F.concat("own", "probed")).alias("at", "key"))
    own = F.col("at") < plan.tables
    table = F.when(own, F.col("at")).otherwise(F.expr(f"(at - {plan.tables}) div {plan.probes}")).cast("int")
    met = met.select("key", table.alias("t"), "id", own.alias("own"), "sketch")
    sizes = met.select("key", F.col("own").cast("int").alias("home"))
    large = sizes.groupBy("key").agg(F.count("*").alias("n"), F.sum("home").alias("homes")).where((F.col("n") > page) & (F.col("homes") > 0))
    large = settled(large)  # at most one key for each PAGE rows

    # squared distance of a link, in the sketch's units
    limit = 2 * (1 - cosine) * SLACK * 90**2
    few = _near_another(met.join(large, "key", "left_anti"), limit).withColumns({"pages": F.lit(1), "chunks": F.lit(1)})
    many = met.join(large, "key").select("key", "t", "id", "own", F.ceil(F.col("homes") / page).cast("int").alias("pages"), F.ceil(F.col("n") / page).cast("int").alias("chunks"))
    met = settled(few.unionByName(many)).join(classes.select("id", "weight", "v", F.col("own").alias("cells"), "probed"), "id")

    # every row asks once in each page of own rows; an own row is held by its page in each chunk
    mine = lambda n, salt: F.pmod(F.xxhash64(F.lit(salt), "id"), F.col(n)).cast("int")
    dealt = met.withColumns({"page": mine("pages", 1), "chunk": mine("chunks", 2)})
    alone = dealt.where("pages = 1 AND chunks = 1").withColumns({"asks": F.lit(True), "holds": F.col("own")})
    spread = dealt.where("chunks > 1")
    asks = spread.withColumn("page", F.explode(F.expr("sequence(0, pages - 1)"))).withColumns({"asks": F.lit(True), "holds": F.col("own") & (F.col("page") == mine("pages", 1))})
    holds = spread.where("own").withColumn("at", F.col("chunk")).withColumn("chunk", F.explode(F.expr("sequence(0, chunks - 1)"))).where("chunk <> at").drop("at")
    holds = holds.withColumns({"asks": F.lit(False), "holds": F.lit(True)})
    columns = ["key", "t", "page", "chunk", "id", "weight", "v", "cells", "probed", "asks", "holds"]
    found = settled(_linked(alone.select(columns).union(asks.select(columns)).union(holds.select(columns)), plan, cosine, width))

    counted = found.where("links IS NOT NULL").groupBy("id").agg(F.sum("links").alias("links"))
    labels = components(found.where("links IS NULL").select(F.col("id").alias("a"), F.col("other").alias("b")))
    known = classes.select("id", "weight", "least", F.xxhash64("v").alias("h1"), F.xxhash64(F.lit(1), "v").alias("h2"))
    known = known.join(labels.withColumnRenamed("node", "id"), "id", "left").withColumn("label", F.coalesce("label", "id"))
    least = known.groupBy("label").agg(F.min("least").alias("component_id"))
    known = settled(known.join(least, "label").join(counted, "id", "left").select("h1", "h2", (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id"))
    linked = rows.where("v IS NOT NULL").select("vec_id", "h1", "h2").join(known, ["h1", "h2"]).select("vec_id", "n_links", "component_id")
    apart = rows.where("v IS NULL").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.union(apart).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
