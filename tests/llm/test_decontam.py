import hashlib
import random

import pytest

from llm_util import WORDS6, docs_frame, lowered, sentence
from tidemark.llm import decontam, textnp


def brute(docs, items, window=13):
    wins = []
    for item, text in items:
        w = WORDS6.findall(lowered(text))
        if w:
            n = min(window, len(w))
            wins += [(item, tuple(w[i : i + n])) for i in range(len(w) - n + 1)]
    out = []
    for doc, text in docs:
        w = WORDS6.findall(lowered(text))
        hit, found = set(), set()
        for item, p in wins:
            for i in range(len(w) - len(p) + 1):
                if tuple(w[i : i + len(p)]) == p:
                    hit.update(range(i, i + len(p)))
                    if item is not None:
                        found.add(str(item))
        names = ",".join(sorted(found))
        out.append((doc, len(w), len(hit), len(found), hashlib.sha256(names.encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


def cases():
    rng = random.Random(5)
    items = [(i, sentence(rng, 20 + i, 300)) for i in range(8)]
    items += [(100, "one short item"), (101, "Two"), (102, None), (103, ""), (104, "... !!"), (None, sentence(rng, 15, 300)), (105, items[0][1])]
    docs = [(i, sentence(rng, rng.choice([0, 1, 5, 12, 13, 14, 80, 300]), 300)) for i in range(30)]
    for k in range(40):  # pieces of items of every length, in other case and punctuation
        words = items[k % 8][1].split()
        a, n = rng.randrange(4), 10 + k % 10
        piece = ", ".join(w.upper() if rng.random() < 0.3 else w for w in words[a : a + n])
        docs.append((200 + k, f"{sentence(rng, rng.randrange(60), 300)} {piece}; {sentence(rng, rng.randrange(60), 300)}"))
    docs += [(300, None), (301, ""), (302, " .,;"), (303, "a ONE short item two"), (303, "a ONE short item two"), (None, items[1][1]), (304, "x " * 30000 + items[2][1])]
    docs += [(305, "w1 " * 500), (306, "é ü " * 10 + items[3][1])]
    return docs, items


def test_equals_brute_force(spark):
    docs, items = cases()
    got = decontam.contamination(docs_frame(spark, docs), spark.createDataFrame(items, "item_id bigint, text string"))
    assert sorted(map(tuple, got.collect()), key=repr) == brute(docs, items)


@pytest.mark.parametrize("docs, items", [([], [(1, "a b c")]), ([(1, "a b c"), (2, None)], []), ([], [])])
def test_empty_tables(spark, docs, items):
    got = decontam.contamination(docs_frame(spark, docs), spark.createDataFrame(items, "item_id bigint, text string"))
    assert sorted(map(tuple, got.collect()), key=repr) == brute(docs, items)


def test_low_entropy_text(spark):
    """Equal least hashes in one window: all are kept, so repeats cannot hide a window."""
    items = [(1, "a " * 13), (2, "a b " * 7), (3, "b " * 30)]
    docs = [(1, "a " * 12), (2, "a " * 13), (3, "b a " * 9), (4, "c " + "b " * 13 + "c"), (5, "a b " * 6 + "a")]
    got = decontam.contamination(docs_frame(spark, docs), spark.createDataFrame(items, "item_id bigint, text string"))
    assert sorted(map(tuple, got.collect()), key=repr) == brute(docs, items)


def test_winnowing_keeps_one_gram_of_every_window():
    import numpy as np

    rng = np.random.default_rng(1)
    grams = rng.integers(1, 50, 200).astype(np.uint64)
    first = np.array([0, 90, 95, 104, 204])  # words; the last row has 100 words, grams end before it
    at = set(textnp.winnowed(grams, first, 5, 9).tolist())
    for a, b in zip(first[:-1], first[1:]):
        for s in range(a, b - 12):
            window = range(s, s + 9)
            least = min(grams[list(window)])
            assert {i for i in window if grams[i] == least} <= at
