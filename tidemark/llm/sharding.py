"""Shards of near equal bytes by Karmarkar-Karp differencing over indivisible groups.

Equal texts form a group that stays in one shard; its weight is its rows' sizes. Groups
are dealt by hash into buckets of about ``per_task`` groups. In each bucket the two
partial partitions of the largest spread are combined, oppositely ordered, until one
is left. A bucket's partition is then itself an item of the next level, which combines
up to ``per_task`` of them in a task, until one partition holds everything. Heavy groups
(at most ``per_task``) and one bucket's groups are items of the last level, so what the
buckets leave uneven is evened out there. Only counts and sums reach the driver.
"""

from __future__ import annotations

import heapq
import math

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import arrow_groups, numbered, settled

SHARDS = 16
PER_TASK = 4096


def differenced(items: list[list[int]], parts: int) -> tuple[list[list[int]], list[int]]:
    """Combine partial partitions by largest differencing.

    ``items``: for each item the sums of its parts. Gives, for each item, the final part
    that each of its parts goes to, and the final sums. Equal spreads: lower index first.
    """
    trees: list = []  # leaf: (item, order of its parts); node: (left, right, left's order, right's order)
    heap = []
    for i, sums in enumerate(items):
        order = sorted(range(parts), key=lambda p: (-sums[p], p))
        trees.append(("leaf", i, order))
        held = [sums[p] for p in order]
        heap.append((held[-1] - held[0], i, held))
    heapq.heapify(heap)
    while len(heap) > 1:
        _, a, x = heapq.heappop(heap)
        _, b, y = heapq.heappop(heap)
        sums = [p + q for p, q in zip(x, reversed(y))]  # largest with smallest
        order = sorted(range(parts), key=lambda p: (-sums[p], p))
        held = [sums[p] for p in order]
        trees.append(("node", a, b, order))
        heapq.heappush(heap, (held[-1] - held[0], len(trees) - 1, held))
    where: list[list[int]] = [[0] * parts for _ in items]
    if not heap:
        return where, [0] * parts
    stack = [(heap[0][1], list(range(parts)))]
    while stack:
        t, final = stack.pop()  # final[r]: the final part of this tree's r-th largest part
        if trees[t][0] == "leaf":
            _, i, order = trees[t]
            for r, p in enumerate(order):
                where[i][p] = final[r]
        else:
            _, a, b, order = trees[t]
            of_slot = [0] * parts
            for r, slot in enumerate(order):
                of_slot[slot] = final[r]
            stack.append((a, of_slot))
            stack.append((b, of_slot[::-1]))
    return where, heap[0][2]


def _first_level(groups: DataFrame, parts: int) -> DataFrame:
    """(bucket, digest, part, weight): each bucket's groups in a partition of their own."""

    def run(key, table):
        order = sorted(range(table.num_rows), key=table.column("digest").to_pylist().__getitem__)  # the same whatever the arrival
        weights = table.column("weight").to_pylist()
        where, _ = differenced([[weights[i]] + [0] * (parts - 1) for i in order], parts)
        found = [0] * len(order)
        for k, i in enumerate(order):
            found[i] = where[k][0]
        return pa.table({"bucket": table.column("bucket"), "digest": table.column("digest"), "part": pa.array(found, pa.int32()), "weight": table.column("weight")})

    return arrow_groups(groups, ["bucket"], run, "bucket bigint, digest binary, part int, weight bigint")


def _next_level(sums: DataFrame, parts: int) -> DataFrame:
    """(bucket, part, above, into, weight): where the parts of the buckets of each group of buckets go."""

    def run(key, table):
        items: dict[int, list[int]] = {}
        for b, p, w in zip(table.column("bucket").to_pylist(), table.column("part").to_pylist(), table.column("weight").to_pylist()):
            items.setdefault(b, [0] * parts)[p] = w
        names = sorted(items)
        where, _ = differenced([items[b] for b in names], parts)
        rows = [(b, p, key[0].as_py(), where[i][p], items[b][p]) for i, b in enumerate(names) for p in range(parts)]
        b, p, above, into, w = zip(*rows)
        return pa.table({"bucket": pa.array(b, pa.int64()), "part": pa.array(p, pa.int32()), "above": pa.array(above, pa.int64()), "into": pa.array(into, pa.int32()), "weight": pa.array(w, pa.int64())})

    return arrow_groups(sums, ["above"], run, "bucket bigint, part int, above bigint, into int, weight bigint")


def balanced(groups: DataFrame, *, shards: int = SHARDS, per_task: int = PER_TASK) -> DataFrame:
    """(digest, shard) for groups (digest binary, weight long): sums of weights near equal."""
    groups = settled(groups)
    n, total = groups.agg(F.count("*"), F.sum("weight")).first()
    buckets = math.ceil(n / per_task)
    bucket = F.pmod(F.xxhash64("digest"), F.lit(max(buckets, 1))).cast("long")
    dealt = groups.select("digest", "weight", bucket.alias("bucket"))
    # what the last task combines one by one: groups of a per_task-th of all bytes or more, and one bucket's
    alone = (F.col("bucket") == 0) | (F.col("weight") * per_task >= (total or 0))
    singles = settled(dealt.where(alone).select("digest", "weight", (-1 - F.monotonically_increasing_id()).alias("bucket"), F.lit(0).alias("part")))
    level = settled(_first_level(dealt.where(~alone), shards))
    placed = level.select("digest", "bucket", "part")
    sums = level.groupBy("bucket", "part").agg(F.sum("weight").cast("long").alias("weight"))
    while buckets > per_task:
        step = settled(_next_level(sums.withColumn("above", F.floor(F.col("bucket") / per_task).cast("long")), shards))
        placed = _moved(placed, step)
        buckets = math.ceil(buckets / per_task)
        sums = step.groupBy(F.col("above").alias("bucket"), F.col("into").alias("part")).agg(F.sum("weight").cast("long").alias("weight"))
    items = sums.select("bucket", "part", "weight").union(singles.select("bucket", "part", "weight"))
    last = settled(_next_level(items.withColumn("above", F.lit(0).cast("long")), shards))
    return _moved(placed.union(singles.select("digest", "bucket", "part")), last).select("digest", F.col("part").alias("shard"))


def _moved(placed: DataFrame, step: DataFrame) -> DataFrame:
    """Where the groups are after one more level."""
    joined = placed.join(step.select("bucket", "part", "above", "into"), ["bucket", "part"])
    return joined.select("digest", F.col("above").alias("bucket"), F.col("into").alias("part"))


def shards_by_bytes(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", shards: int = SHARDS, per_task: int = PER_TASK) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law ('bytes'), shard, slot, grown_shard (null).

    size: UTF-8 bytes of the text (null: none) plus 1. Rows of equal texts, repeated rows
    among them, share a shard; a null text counts as an empty one. Slots are gapless from 0
    in each shard, in any order. A null doc_id is kept; other columns are not looked at;
    an empty table gives no rows. A group heavier than total / shards has a shard to
    itself as far as the balance allows; groups are never cut.
    """
    value = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), (F.octet_length(value) + 1).cast("long").alias("size"),
        F.crc32(value).alias("text_crc32"), F.unhex(F.md5(value)).alias("digest"),
    )
    rows = settled(rows)
    groups = rows.groupBy("digest").agg(F.sum("size").cast("long").alias("weight"))
    placed = balanced(groups, shards=shards, per_task=per_task)
    sharded = rows.join(placed, "digest").select("doc_id", "size", "text_crc32", "shard")
    out = numbered(sharded, "shard", "slot")
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
