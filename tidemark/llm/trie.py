"""Prefix trie of conversations by truncation peeling.

A node of depth d is a distinct sequence of the first d turns (role and text) of some
conversation. A conversation is a path of turn tokens: 16 bytes of the SHA-256 of role
and text, and the number of the text's code points.

The trie is peeled from its greatest depth: the nodes of depth d are the conversations
that end there, merged with the nodes that were left when the last turn of each node of
depth d + 1 was stripped. Regrouping finds a node, and its members, children, leaves and
subtree totals at the same time; hot prefixes are combined before the shuffle. A level is
written before the next one starts from it.

The turns of a path that no other path shares form a tail: a chain without branches, which
is stripped at once and joins the peeling where the sharing ends. So the deepest prefix
that two different paths share sets the number of levels, not the longest conversation.

Paths are cut into segments of ``SEGMENT`` turns, each with the digest of all before it. A
node carries only the open part of its own segment, so what is shuffled grows with the
number of turns, not with its square; at a segment's edge the node's smallest member
hands in the segment before.

The ids of the conversations that end at a node are sorted by range over all tasks and
joined to pieces of ``PIECE`` bytes there; a SHA-256 is sequential, so one node's pieces
go through one task as a stream, in constant memory.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import arrow_map, settled
from tidemark.sources.store import scratch_path

SEGMENT = 16
#: Bytes of a turn's token: digest, code points.
TOKEN, DIGEST = 24, 16
PIECE = 1 << 16
#: Nodes of a level that one task writes.
LEVEL_ROWS = 1 << 17
#: A conversation takes its first turns, fewer than this many, from the first one of its hundred.
HEADS = 6


def _digest(*parts):
    return F.substring(F.unhex(F.sha2(F.concat(*parts), 256)), 1, DIGEST)


def turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, tie, token) of rows that have a conv_id; null roles and texts are empty."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = _digest(F.length(role).cast("string").cast("binary"), F.lit(b":"), role.cast("binary"), text.cast("binary"))
    size = F.unhex(F.lpad(F.hex(F.length(text).cast("long")), 16, "0"))
    order = F.concat_ws("\0", role, F.md5(text))
    return conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", order.alias("tie"), F.concat(digest, size).alias("token")
    )


def ordered(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, token): turns numbered from 1 by turn, null first; equal turns by role and text's digest.

    Rows are sorted by range and numbered where they lie; only the first conversation of a
    range may have begun before it. One row for each range tells where it goes on.
    """
    keys = ["conv_id", F.col("turn").asc_nulls_first(), "tie", "token"]
    dealt = turns(conversations).repartitionByRange(*keys).sortWithinPartitions(*keys).select("conv_id", "token")

    def count(batches):
        from pyspark import TaskContext

        pid, last, seen = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            local = []
            for c in batch.column(0).to_pylist():
                seen = seen + 1 if c == last else 1
                last = c
                local.append(seen)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([pid] * len(local), pa.int32()), pa.array(local, pa.int64())], names=["conv_id", "token", "part", "local"])

    marked = settled(arrow_map(dealt, count, "conv_id bigint, token binary, part int, local bigint"))
    ranges = marked.groupBy("part").agg(F.min("conv_id").alias("begins"), F.max(F.struct("conv_id", "local")).alias("ends"))
    ranges = sorted(ranges.collect())  # one row for each range of the shuffle
    starts, known, conv = [], 0, None
    for part, begins, (last, local) in ranges:
        if begins == conv:
            starts.append((part, begins, known))
        known = known + local if last == conv else local
        conv = last
    starts = marked.sparkSession.createDataFrame(starts, "part int, conv_id bigint, start bigint")
    joined = marked.join(F.broadcast(starts), ["part", "conv_id"], "left")
    return joined.select("conv_id", (F.col("local") + F.coalesce("start", F.lit(0))).alias("pos"), "token")


def rebuilt(rows: DataFrame, heads: int = HEADS) -> DataFrame:
    """(conv_id, d, token) of ``ordered`` rows, with a shared beginning; d is null for one without turns.

    Every conversation c begins with the first h turns of conversation c - c % 100 (all if
    it has fewer, none if it is absent), h = crc32(c in decimal) % ``heads``; its own turns
    after its first h follow.
    """
    h = F.crc32(F.col("conv_id").cast("string")) % heads
    base = rows.where((F.col("conv_id") % 100 == 0) & (F.col("pos") < heads))
    base = base.groupBy(F.col("conv_id").alias("base")).agg(F.array_sort(F.collect_list(F.struct("pos", "token"))).alias("head"))
    begun = rows.groupBy("conv_id").agg(F.max("pos").alias("own")).withColumn("base", F.expr("conv_id - conv_id % 100"))
    begun = begun.join(base, "base", "left").withColumn("head", F.slice(F.coalesce("head", F.array()), 1, h.cast("int")))
    begun = settled(begun.select("conv_id", "own", "head", h.alias("h"), F.size("head").alias("shared")))
    taken = begun.where("shared > 0 OR own <= h").select("conv_id", F.explode_outer("head").alias("t"))
    taken = taken.select("conv_id", F.col("t.pos").alias("d"), F.col("t.token").alias("token"))
    late = rows.where(F.col("pos") > h).join(begun.where("own > h").select("conv_id", "h", "shared"), "conv_id")
    return taken.union(late.select("conv_id", (F.col("pos") - F.col("h") + F.col("shared")).alias("d"), "token"))


def paths(rows: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """(conv_id, segment, before, path, depth): segments of a conversation, and the digest of all before each.

    The last segment has the conversation's depth (else null); it may be empty, and then
    holds no turn: a depth of a multiple of ``segment`` ends in an empty one.
    """
    parts = rows.groupBy("conv_id", F.expr(f"coalesce((d - 1) div {segment}, 0)").alias("segment"))
    token = F.array_sort(F.collect_list(F.when(F.col("d").isNotNull(), F.struct("d", "token"))))
    parts = parts.agg(token.alias("tokens")).select("conv_id", "segment", F.size("tokens").alias("n"), F.expr("aggregate(tokens, X'', (a, t) -> concat(a, t.token))").alias("path"))
    parts = settled(parts)
    chain = parts.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("segment", _digest("path").alias("own")))).alias("s"),
        F.sum("n").alias("depth"),
    )
    empty = F.col("depth") % segment == 0
    last = F.expr(f"depth div {segment}")
    step = "aggregate(s, array(X''), (a, x) -> concat(a, array(substring(unhex(sha2(concat(element_at(a, -1), x.own), 256)), 1, 16))))"
    # digests[i]: of all turns before segment i; a conversation that ends on an edge has one segment more, an empty one
    chain = chain.withColumn("digests", F.expr(step)).select("conv_id", "depth", F.posexplode("digests").alias("segment", "before"))
    chain = chain.where(F.col("segment") <= last)
    joined = chain.join(parts, ["conv_id", "segment"], "left")
    path = F.when(empty & (F.col("segment") == last), F.lit(b"")).otherwise(F.coalesce("path", F.lit(b"")))
    return joined.select("conv_id", F.col("segment").cast("long").alias("segment"), "before", path.alias("path"), F.when(F.col("segment") == last, F.col("depth")).alias("depth"))


def _ends_digests(ended: DataFrame, piece: int = PIECE) -> DataFrame:
    """(node, ends): SHA-256 of the ascending, comma-joined conv_ids of (node, conv_id)."""

    def joined(batches):
        """Runs of one node as pieces of text; ``first`` orders them."""
        node, first, text, size = None, 0, [], 0
        out: list[tuple] = []

        def close():
            if text:
                out.append((node, first, ",".join(text)))

        for batch in batches:
            for n, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if n != node or size >= piece:
                    close()
                    node, first, text, size = n, c, [], 0
                text.append(str(c))
                size += len(text[-1]) + 1
            yield _pieces(out)
            out = []
        close()
        yield _pieces(out)

    def _pieces(out):
        columns = [pa.array([r[i] for r in out], k) for i, k in enumerate((pa.binary(), pa.int64(), pa.string()))]
        return pa.RecordBatch.from_arrays(columns, names=["node", "first", "piece"])

    def hashed(batches):
        node, h, out = None, None, []
        for batch in batches:
            for n, p in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if n == node:
                    h.update(b"," + p.encode())
                    continue
                if h is not None:
                    out.append((node, h.hexdigest()))
                node, h = n, hashlib.sha256(p.encode())
            yield pa.RecordBatch.from_arrays([pa.array([n for n, _ in out], pa.binary()), pa.array([x for _, x in out], pa.string())], names=["node", "ends"])
            out = []
        if h is not None:
            yield pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([h.hexdigest()])], names=["node", "ends"])

    ranged = ended.repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id")
    pieces = arrow_map(ranged.select("node", "conv_id"), joined, "node binary, first bigint, piece string")
    dealt = pieces.repartition("node").sortWithinPartitions("node", "first").select("node", "piece")
    return arrow_map(dealt, hashed, "node binary, ends string")


EMPTY = hashlib.sha256(b"").hexdigest()


def _foldered(df: DataFrame, by: str) -> DataFrame:
    """``df`` in the shared folder, a folder for each value of ``by``: a level reads its own."""
    path = scratch_path(df.sparkSession, f"trie-{by}")
    df.hint("rebalance", F.col(by)).write.partitionBy(by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


SCHEMA = "node binary, parent binary, conv_id bigint, depth bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint"
COLUMNS = [f.split(" ")[0] for f in SCHEMA.split(", ")]


def _node(depth, before, path):
    return _digest(F.concat(depth.cast("string"), F.lit(":")).cast("binary"), before, path)


def _code_points(path):
    """The code points of the last turn of ``path``."""
    return F.conv(F.hex(F.substring(path, -(TOKEN - DIGEST), TOKEN - DIGEST)), 16, 10).cast("long")


def _prefixes(segments: DataFrame, segment: int) -> DataFrame:
    """(conv_id, d, node, size): every depth from 1 of the conversations of ``segments``, the last turn's code points."""
    k = F.explode(F.expr(f"sequence(1, length(path) div {TOKEN})")).alias("k")
    each = segments.where("length(path) > 0").select("conv_id", "segment", "before", "path", k)
    d = F.col("segment") * segment + F.col("k")
    cut = F.expr(f"substring(path, 1, k * {TOKEN})")
    node = F.when(F.col("k") == segment, _node(d, _digest("before", _digest("path")), F.lit(b""))).otherwise(_node(d, F.col("before"), cut))
    return each.select("conv_id", d.alias("d"), node.alias("node"), _code_points(cut).alias("size"))


def _tails(ends: DataFrame, segments: DataFrame, segment: int) -> tuple[DataFrame, DataFrame]:
    """(nodes, entries): the unshared nodes of each path, and the paths as they join the peeling.

    ``ends``: one row for each distinct path; ``entries``: (at, before, path, conv_id,
    n_convs, child, leaves, saved), ended paths at their depth and tails where they begin.
    """
    each = settled(_prefixes(segments.join(ends.select("conv_id"), "conv_id", "left_semi"), segment))
    single = each.groupBy("d", "node").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("paths")).where("paths = 1")
    first = single.groupBy("conv_id").agg(F.min("d").alias("first"))
    ends = settled(ends.join(first, "conv_id", "left"))

    tail = each.join(ends.where("first IS NOT NULL").select("conv_id", "first", "depth", F.col("n").alias("n_convs")), "conv_id").where("d >= first - 1")
    down = Window.partitionBy("conv_id").orderBy("d")
    below = Window.partitionBy("conv_id").orderBy(F.desc("d")).rowsBetween(Window.unboundedPreceding, 0)
    root = _node(F.lit(0), F.lit(b""), F.lit(b""))
    tail = tail.withColumn("parent", F.when(F.col("d") == 1, root).otherwise(F.lag("node").over(down)))
    tail = tail.withColumn("saved_tokens", (F.col("n_convs") - 1) * F.sum("size").over(below)).where("d >= first")
    one = F.lit(1).cast("long")
    nodes = settled(tail.select("node", "parent", "conv_id", F.col("d").alias("depth"), "n_convs", (F.col("d") < F.col("depth")).cast("long").alias("n_children"), one.alias("n_leaves"), "saved_tokens", "first"))

    zero = F.lit(0).cast("long")
    ended = ends.where("first IS NULL").select(F.col("depth").alias("at"), "before", "path", "conv_id", F.col("n").alias("n_convs"), zero.alias("child"), zero.alias("leaves"), zero.alias("saved"))
    begun = nodes.where("depth = first").select((F.col("first") - 1).alias("at"), "conv_id", "n_convs", "saved_tokens").withColumn("segment", F.expr(f"at div {segment}"))
    begun = begun.join(segments.select("conv_id", "segment", "before", "path"), ["conv_id", "segment"])
    left = F.expr(f"substring(path, 1, at % {segment} * {TOKEN})")
    begun = begun.select("at", "before", left.alias("path"), "conv_id", "n_convs", one.alias("child"), one.alias("leaves"), F.col("saved_tokens").alias("saved"))
    return nodes.select(COLUMNS), ended.union(begun)


def peeled(segments: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """All nodes of the trie of ``paths``: node, parent (digests), conv_id, depth, n_convs, n_children, n_leaves, saved_tokens."""
    ends = segments.where("depth IS NOT NULL").groupBy("depth", "before", "path").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n"))
    tails, entries = _tails(settled(ends), segments.drop("depth"), segment)
    entries, segments = _foldered(entries, "at"), _foldered(segments.drop("depth"), "segment")
    sizes = dict(entries.groupBy("at").count().collect())  # one row for each level
    top, most = max(sizes, default=None), 0
    levels = [tails]
    alive: DataFrame | None = None
    for depth in range(-1 if top is None else top, -1, -1):
        most += sizes.get(depth, 0)
        rows = entries.where(F.col("at") == depth).drop("at")
        if alive is not None:
            if (depth + 1) % segment == 0:  # the edge of a segment: the smallest member hands in the one before
                at = segments.where(F.col("segment") == depth // segment).select("conv_id", F.col("before").alias("b"), F.col("path").alias("p"))
                alive = alive.join(at, "conv_id").withColumns({"before": F.col("b"), "path": F.col("p")})
            left = F.expr(f"substring(path, 1, length(path) - {TOKEN})")
            rows = rows.union(alive.select("before", left.alias("path"), "conv_id", "n_convs", F.lit(1).cast("long"), "n_leaves", "saved_tokens"))
        nodes = rows.groupBy("before", "path").agg(
            F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"), F.sum("child").alias("n_children"),
            F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"),
        )
        alive = settled(_finished(nodes, depth, segment, segments).coalesce(-(-most // LEVEL_ROWS)))
        levels.append(alive.select(COLUMNS))
    out = levels[0]
    for level in levels[1:]:
        out = out.union(level)
    return out


def _finished(nodes: DataFrame, depth: int, segment: int, segments: DataFrame) -> DataFrame:
    """Adds the node's and its parent's digest, its leaves and what its subtree saves."""
    if depth and depth % segment == 0:  # the last turn lies in the segment before
        at = segments.where(F.col("segment") == depth // segment - 1).select("conv_id", F.col("before").alias("up"), F.col("path").alias("end"))
        nodes = nodes.join(at, "conv_id")
    else:
        nodes = nodes.withColumns({"up": F.col("before"), "end": F.col("path")})
    own = (F.col("n_convs") - 1) * _code_points("end") if depth else F.lit(0).cast("long")
    parent = _node(F.lit(depth - 1), F.col("up"), F.expr(f"substring(end, 1, length(end) - {TOKEN})")) if depth else F.lit(None).cast("binary")
    return nodes.select(
        "before", "path", "conv_id", "n_convs", "n_children",
        F.greatest("leaves", F.lit(1)).alias("n_leaves"), (F.col("saved") + own).alias("saved_tokens"),
        F.lit(depth).cast("long").alias("depth"), _node(F.lit(depth), F.col("before"), F.col("path")).alias("node"), parent.alias("parent"),
    )


def prefix_trie(rows: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """One row per node of the trie of (conv_id, d, token) rows.

    conv_id (smallest member), depth, parent_conv_id (null for the root), n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256. Conversations without turns (a row
    whose d is null) are members of the root. No rows give no nodes, not even a root.
    """
    segments = settled(paths(rows, segment))
    nodes = peeled(segments, segment)
    last = segments.where("depth IS NOT NULL")
    ends = _ends_digests(last.select(_node(F.col("depth"), F.col("before"), F.col("path")).alias("node"), "conv_id"))
    above = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    out = nodes.join(ends, "node", "left").join(above, "parent", "left")
    return out.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends", F.lit(EMPTY)).alias("ends_sha256"),
    )


def conversation_trie(conversations: DataFrame, heads: int = HEADS) -> DataFrame:
    """The trie of all rebuilt conversations of (conv_id, turn, role, text).

    Rows without a conv_id belong to no conversation. Null turns come first; rows of one
    turn are ordered by role and the text's digest; equal rows are as many turns. Null
    roles and texts are empty. Other columns are not looked at.
    """
    return prefix_trie(rebuilt(ordered(conversations), heads))
