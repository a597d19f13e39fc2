"""Lattice near-duplicates, the source audit and the prefix trie against brute force, with unpleasant input."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import divergence, lattice, trie
from llm_util import lowered

CLASH = ("id", "v", "key", "t", "own", "node", "path", "before", "d", "term", "n", "docs", "label", "weight", "least", "pos", "token", "item", "value", "rank", "block")


def clashing(df):
    for name in CLASH:
        df = df.withColumn(name, F.lit("clash"))
    return df


# ---- op11 -------------------------------------------------------------------------


def planted(n, cosine, dim=64, seed=5):
    rng = np.random.default_rng(seed)
    x = lattice.units(rng.normal(size=(n, dim)))
    o = rng.normal(size=(n, dim))
    o = lattice.units(o - (o * x).sum(axis=1, keepdims=True) * x)
    return np.concatenate([x, cosine * x + np.sqrt(1 - cosine**2) * o])


def test_decode_gives_the_nearest_lattice_point():
    rng = np.random.default_rng(1)
    x = rng.normal(scale=2, size=(300, 8))
    at = lattice.decode(x)
    doubled = np.rint(2 * at).astype(int)
    assert ((doubled % 2).min(axis=1) == (doubled % 2).max(axis=1)).all() and (at.sum(axis=1) % 2 == 0).all()
    gap = ((x - at) ** 2).sum(axis=1)
    assert gap.max() <= 1 + 1e-9  # the covering radius
    for v in lattice.neighbours():
        assert (gap <= ((x - at - v) ** 2).sum(axis=1) + 1e-9).all()


@pytest.mark.parametrize("classes", [1 << 10, 1 << 25, 1 << 30])
def test_recall_at_the_threshold(spark, classes):
    x = planted(600, 0.9005)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>")
    got = lattice.near_duplicates(df, plan=lattice.lattice(classes)).agg(F.sum("n_links")).first()[0]
    assert got / 1200 >= 0.95


def brute_links(rows):
    """vec_id, n_links, component_id by all pairs; rows of (vec_id, vector or None)."""
    unit = []
    for _, v in rows:
        good = v is not None and len(v) and all(c is not None and np.isfinite(c) for c in v) and any(v)
        unit.append(lattice.units(np.array([v], float))[0] if good else None)
    n = len(rows)
    near = [[j for j in range(n) if j != i and unit[i] is not None and unit[j] is not None and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= 0.9] for i in range(n)]
    out = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        out.append((rows[i][0], len(near[i]), min(ids) if ids else None))
    return Counter(out)


@pytest.mark.parametrize("page", [4096, 40])
def test_near_duplicates_equal_all_pairs(spark, page):
    rng = np.random.default_rng(9)
    base = lattice.units(rng.normal(size=(60, 16)))
    vectors = [v.tolist() for v in base]
    vectors += [(v + rng.normal(scale=0.02, size=16)).tolist() for v in base[:20] for _ in range(3)]
    vectors += [(base[0] + rng.normal(scale=0.01, size=16)).tolist() for _ in range(150)]  # a large group of near copies
    vectors += [base[1].tolist()] * 70  # and one of copies
    vectors += [(base[2] * s).tolist() for s in (1e-200, 1e200, 3.0)]
    rows = list(enumerate(vectors))
    rows += [(7, vectors[8]), (7, None), (900, []), (901, [0.0] * 16), (902, [float("nan")] + [1.0] * 15), (903, [None] + [1.0] * 15), (None, vectors[3]), (None, None), (904, [1.0, 2.0]), (905, [2.0, 4.0]), (906, [0.0, -0.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = lattice.near_duplicates(clashing(df), page=page)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    found = got.collect()
    assert Counter((r.vec_id, r.n_links, r.component_id) for r in found) == brute_links(rows)
    assert all(r.kept == (r.vec_id is not None and r.vec_id == r.component_id) for r in found)


def test_no_vectors(spark):
    df = spark.createDataFrame([], "vec_id bigint, embedding array<float>")
    assert lattice.near_duplicates(df).collect() == []


# ---- op12 -------------------------------------------------------------------------

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def brute_audit(rows, least=3, top=200):
    rows = [(lang or "", source or "", TERM.findall(lowered(text))) for text, lang, source in rows]
    docs, counts = defaultdict(Counter), defaultdict(Counter)
    for lang, source, words in rows:
        counts[lang, source].update(words)
        docs[lang].update(set(words))
    out = set()
    for lang in docs:
        kept = sorted(t for t, n in docs[lang].items() if n >= least)
        groups = {s: {t: counts[g, s][t] for t in kept} for g, s in counts if g == lang}
        whole = {t: sum(c[t] for c in groups.values()) for t in kept}
        shares = lambda c: {t: 1 + 10**9 * (c[t] + 1) // (sum(c.values()) + len(kept)) for t in kept}
        p, q = {s: shares(c) for s, c in groups.items()}, shares(whole)
        for s, c in groups.items():
            pairs = [(sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o) for o in groups if o != s]
            terms = [((p[s][t] - q[t]) ** 2 // q[t], t) for t in kept if c[t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, len(pairs)), ("term", terms, top)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out |= {(lang, s, part, item, f, i + 1) for i, (f, item) in enumerate(found[:most])}
    return out


def audit_rows():
    rng = random.Random(3)
    rows = []
    for _ in range(260):
        source = rng.choice(["a", "a", "a", "b", "c", None, ""])
        words = [rng.choice(["alpha", "Beta", "GAMMA", "Ünder", "ünder", "naïve", f"w{chr(97 + rng.randrange(20))}{source}", "日本", "x-y", "İI"]) for _ in range(rng.randrange(30))]
        rows.append((rng.choice([" ", "\n", "1", "."]).join(words), rng.choice(["en", "en", "de", None]), source))
    rows += [rows[0]] * 5 + [(None, "en", "z"), ("", "fr", "only"), (" 12 ", "fr", "other"), ("zwei zwei", "xx", "p"), ("wort " * 60_000, "de", "long"), ("q" * 300_000, "en", "a")]
    return rows


@pytest.mark.parametrize("shard, across", [(1 << 18, 256), (7, 2)])
def test_audit_equals_brute_force(spark, shard, across):
    rows = audit_rows()
    df = clashing(spark.createDataFrame(rows, "text string, lang string, source string"))
    got = divergence.audit(df.repartition(5), shard=shard, across=across)
    assert {tuple(r) for r in got.select("lang", "source", "part", "item", "value", "rank").collect()} == brute_audit(rows)


def test_audit_cuts_terms_only_at_top(spark):
    rows = audit_rows()
    got = divergence.audit(spark.createDataFrame(rows, "text string, lang string, source string"), top=2, shard=5)
    assert {tuple(r) for r in got.collect()} == brute_audit(rows, top=2)


def test_audit_of_nothing(spark):
    assert divergence.audit(spark.createDataFrame([], "text string, lang string, source string")).collect() == []


def test_partial_counts_survive_small_budgets(spark, monkeypatch):
    """However often a task hands its counts on, the sums are the same."""
    lang, source = divergence.pa.array(["en"] * 9), divergence.pa.array(["a", "b", "a"] * 3)
    text = divergence.pa.array(["x y x", "y", "", "Z z", "x", "y x", "z", "", "x"])
    whole = divergence._merged([divergence._step_counts(lang, source, text)])
    parts = [divergence._step_counts(lang.slice(i, 2), source.slice(i, 2), text.slice(i, 2)) for i in range(0, 9, 2)]
    sort = lambda t: sorted(map(str, t.to_pylist()))
    assert sort(divergence._merged(parts)) == sort(whole)


def test_share_is_exact():
    rng = random.Random(4)
    for _ in range(200):
        total = rng.randrange(1, 9 * 10**14)
        count = rng.randrange(total)
        assert int(divergence.share(np.array([count]), total)[0]) == 1 + 10**9 * (count + 1) // total


# ---- op13 -------------------------------------------------------------------------


def brute_trie(rows):
    turns = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            turns[c].append((turn is not None, turn or 0, role or "", hashlib.md5((text or "").encode()).hexdigest(), text or ""))
    own = {c: [(r, x) for *_, r, _, x in sorted(t)] for c, t in turns.items()}
    paths = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        base = c - int(np.fmod(c, 100))
        paths[c] = tuple(own.get(base, [])[:h] + own[c][h:])
    members = defaultdict(list)
    for c, p in paths.items():
        for d in range(len(p) + 1):
            members[p[:d]].append(c)
    kids = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += kids[p] == 0
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1]) if p else 0
    return Counter(
        (min(m), len(p), min(members[p[:-1]]) if p else None, len(m), kids[p], leaves[p], saved[p], hashlib.sha256(",".join(map(str, sorted(c for c in m if len(paths[c]) == len(p)))).encode()).hexdigest())
        for p, m in members.items()
    )


def trie_rows():
    rng = random.Random(8)
    rows = []
    for c in [*range(-3, 40), *range(100, 130), 205, 206, 700, 2**40]:
        for t in range(rng.choice([1, 2, 3, 6, 9])):
            rows.append((c, rng.choice([t, t, None]), rng.choice(["user", "assistant", None]), rng.choice(["", "hi", "hé", "a" * 50, None])))
    for c in (300, 301, 302, 303):  # long ones that share 40 turns and then part
        rows += [(c, t, "user", f"turn {t}") for t in range(40 if c < 303 else 33)]
        rows += [(c, 100 + t, "user", f"{c} {t}") for t in range(c - 300)]
    rows += [(310, t, "user", f"own {t}") for t in range(75)]
    rows += [(c, t, "user", "common") for c in range(400, 480) for t in range(3)]  # copies
    rows += [(None, 1, "user", "lost"), (5, 1, "user", "x" * 200_000), (5, 1, "user", "same"), (5, 1, "user", "same")]
    return rows


@pytest.mark.parametrize("segment", [16, 3])
def test_trie_equals_brute_force(spark, segment):
    rows = trie_rows()
    df = clashing(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")).repartition(6)
    got = trie.prefix_trie(trie.rebuilt(trie.ordered(df)), segment)
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert Counter(tuple(r) for r in got.collect()) == brute_trie(rows)


def test_hot_node_is_hashed_in_pieces(spark):
    ended = spark.range(5000).select(F.lit(b"n").alias("node"), F.col("id").alias("conv_id")).repartition(7)
    got = trie._ends_digests(ended, piece=100).collect()
    assert [(bytes(r.node), r.ends) for r in got] == [(b"n", hashlib.sha256(",".join(map(str, range(5000))).encode()).hexdigest())]


def test_a_long_conversation_costs_no_levels(spark, monkeypatch):
    levels = []
    finished = trie._finished
    monkeypatch.setattr(trie, "_finished", lambda nodes, depth, *a: levels.append(depth) or finished(nodes, depth, *a))
    rows = [(1, t, "user", str(t)) for t in range(300)] + [(2, 0, "user", "other")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    assert Counter(tuple(r) for r in trie.conversation_trie(df).collect()) == brute_trie(rows)
    assert len(levels) <= 2


def test_no_conversations(spark):
    df = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    assert trie.conversation_trie(df).collect() == []
