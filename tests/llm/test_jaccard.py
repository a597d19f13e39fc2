import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_util import WORDS5, docs_frame, lowered, sentence
from tidemark.llm import jaccard, textnp


def shingles(text, k=3):
    w = WORDS5.findall(lowered(text))
    if not w:
        return frozenset()
    n = min(k, len(w))
    return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1))


def brute(docs, percent=90):
    sets = [shingles(t) for _, t in docs]
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            if docs[i][0] is None or docs[j][0] is None:
                continue
            both = len(sets[i] & sets[j])
            same = docs[i][0] == docs[j][0]
            if same or sets[i] and sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted(((d, len(sets[i]), least[find(i)] if d is not None else None) for i, (d, _) in enumerate(docs)), key=repr)


def edited(rng, text, n):
    w = text.split()
    for _ in range(n):
        w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
    return " ".join(w)


def cases():
    rng = random.Random(11)
    docs = [(i, sentence(rng, rng.choice([1, 2, 3, 4, 9, 12, 30, 100, 400]))) for i in range(40)]
    n = 1000
    for size in (12, 25, 40, 90, 200, 700):  # around the threshold, at class boundaries, in chains
        base = sentence(rng, size, 5000)
        for k in range(12):
            docs.append((n, edited(rng, base, k % 4 + (size > 90) * (k // 2))))
            n -= 1
        chain = base
        for k in range(6):
            chain = edited(rng, chain, max(1, size // 90))
            docs.append((n, chain))
            n -= 1
    docs += [(5000, None), (5001, ""), (5002, " \t\n"), (5003, "A b"), (5004, "a  B"), (5005, "a"), (5006, None)]
    docs += [(5010, docs[45][1].upper()), (5010, "quite another text than that one"), (None, docs[45][1]), (-3, docs[45][1])]
    docs += [(6000 + k, "same words again and again for ever " * 40 + f"tail{k // 3}") for k in range(30)]
    return docs


def test_equals_brute_force(spark):
    docs = cases()
    got = jaccard.similarity_classes(docs_frame(spark, docs))
    assert sorted(map(tuple, got.collect()), key=repr) == brute(docs)


def test_large_group_over_several_pages(spark):
    """Small pages: copies meet through their smallest member, the rest through the second search."""
    rng = random.Random(3)
    base = sentence(rng, 150, 5000)
    docs = [(i, edited(rng, base, rng.choice([0, 1, 2, 3, 4, 5, 6]))) for i in range(160)]
    got = jaccard.similarity_classes(docs_frame(spark, docs), page=16)
    assert sorted(map(tuple, got.collect()), key=repr) == brute(docs)


@pytest.mark.parametrize("docs", [[], [(1, None)], [(None, "a b c d"), (None, "a b c d")]])
def test_nothing_to_link(spark, docs):
    got = jaccard.similarity_classes(docs_frame(spark, docs))
    assert sorted(map(tuple, got.collect()), key=repr) == brute(docs)


@pytest.mark.parametrize("n", [10, 13, 19, 20, 57, 100, 333, 1200])
def test_linked_sets_share_a_signature(n):
    """Any two sets within the allowed difference agree in a group, empty groups included."""
    rng = np.random.default_rng(n)
    classes = jaccard.size_classes(90)
    for _ in range(40):
        a = np.unique(textnp.mixed(rng.integers(0, 1 << 62, n).astype(np.uint64)))
        drop = rng.integers(0, max(1, n // 10))
        grown = rng.integers(0, max(1, n // 10))
        b = np.unique(np.concatenate([a[drop:], textnp.mixed(rng.integers(0, 1 << 62, grown).astype(np.uint64))]))
        both = jaccard.overlap(a, b)
        if 100 * both >= 90 * (len(a) + len(b) - both) and not np.array_equal(a, b):
            x, y = (set(jaccard.all_signatures(s, classes, 90).tolist()) for s in (a, b))
            assert x & y


@pytest.mark.parametrize("percent", [67, 80, 90, 95])
def test_small_linked_sets_share_a_signature(percent):
    """All sizes up to 30, one shingle more, or one exchanged."""
    rng = np.random.default_rng(percent)
    classes = jaccard.size_classes(percent)
    linked = 0
    for n in range(1, 31):
        for _ in range(10):
            h = np.unique(textnp.mixed(rng.integers(0, 1 << 62, n + 1).astype(np.uint64)))
            out = rng.integers(0, n + 1)
            for a, b in ((h, np.delete(h, out)), (np.delete(h, out), np.delete(h, (out + 1) % (n + 1)))):
                both = jaccard.overlap(a, b)
                if 100 * both >= percent * (len(a) + len(b) - both) and not np.array_equal(a, b):
                    linked += 1
                    assert set(jaccard.all_signatures(a, classes, percent).tolist()) & set(jaccard.all_signatures(b, classes, percent).tolist())
    assert linked


def test_nine_shingles_inside_ten(spark):
    words = [f"w{i}" for i in range(12)]
    docs = [(1, " ".join(words[:11])), (2, " ".join(words)), (3, " ".join(words[:10]))]
    got = jaccard.similarity_classes(docs_frame(spark, docs))
    assert sorted(map(tuple, got.collect())) == brute(docs) == [(1, 9, 1), (2, 10, 1), (3, 8, 3)]


def test_tree_finds_what_a_scan_finds():
    rng = np.random.default_rng(2)
    points = rng.poisson(4, (300, 16)).astype(np.int32)
    points[100:140] = points[100]
    points[140:160, 0] += 1
    sizes = points.sum(axis=1).astype(np.int64)
    tree = jaccard.CountTree(points, sizes)
    for i in range(300):
        need = (sizes[i] + sizes) * 90
        want = np.flatnonzero((np.minimum(points, points[i]).sum(axis=1) * 190 >= need) & (sizes * 90 <= sizes[i] * 100) & (sizes * 100 >= sizes[i] * 90))
        assert sorted(tree.search(points[i], int(sizes[i]), 90).tolist()) == want.tolist()


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a bigint, b bigint")
    got = {r["node"]: r["label"] for r in jaccard.components(edges).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


def test_scans_may_split_the_files_differently(spark, tmp_path, monkeypatch):
    """Each step reads the table in other partitions than the one before, as on a cluster that gains or loses cores."""
    docs = cases()
    path = str(tmp_path / "documents")
    docs_frame(spark, docs, extra=False).repartition(12).write.parquet(path)
    key, calls = "spark.sql.files.maxPartitionBytes", []
    was, settled = spark.conf.get(key), jaccard.settled

    def resplit(df):
        calls.append(df)
        spark.conf.set(key, "64k" if len(calls) % 2 else "1g")
        return settled(df.select("*"))  # planned under the new setting

    monkeypatch.setattr(jaccard, "settled", resplit)
    try:
        for turn in range(2):
            calls[:] = [None] * turn
            got = sorted(map(tuple, jaccard.similarity_classes(spark.read.parquet(path)).collect()), key=repr)
            assert got == brute(docs)
    finally:
        spark.conf.set(key, was)


def test_no_group_of_the_second_search_holds_its_block(spark, monkeypatch):
    """Texts of one template, each too far from the others: all meet, a few pages' worth at a time."""
    rng = random.Random(5)
    base, sizes, paged = sentence(rng, 185, 5000), [], jaccard._paged
    docs = [(i, f"{base} " + " ".join(f"u{i}x{k // 2 if i % 7 == 0 else k}" for k in range(15))) for i in range(300)]
    docs += [(1000 + i, f"{docs[i][1]} tail") for i in range(0, 300, 10)]

    def seen(dealt, points, percent):
        keys = [c for c in ("block", "page", "chunk") if c in dealt.columns]
        sizes.append(dealt.groupBy(*keys).count().agg(F.max("count")).first()[0])
        return paged(dealt, points, percent)

    monkeypatch.setattr(jaccard, "_paged", seen)
    got = jaccard.similarity_classes(docs_frame(spark, docs), page=16)
    assert sorted(map(tuple, got.collect()), key=repr) == brute(docs)
    assert len(sizes) == 2 and max(sizes) <= 4 * 16
