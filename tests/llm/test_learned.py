"""Language identification and toxicity: accuracy on rows that were not learned from, and edge cases."""

import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_util import docs_frame
from tidemark.llm import langid, toxicity

LETTERS = {"aa": "abcdefgh", "bb": "ijklmnop", "cc": "qrstuvwx", "dd": "äöüéèçñó", "ee": "acegikmo", "ff": "bdfhjlnp", "gg": "zyxwvuts"}


def text_of(rng, lang, n):
    return " ".join("".join(rng.choice(LETTERS[lang]) for _ in range(rng.randrange(2, 7))) for _ in range(n))


def lang_rows(n=350, langs=("aa", "bb", "cc", "dd", "ee", "ff", "gg")):
    rng = random.Random(4)
    return [(i, text_of(rng, lang, rng.randrange(3, 60)), lang) for i in range(n) for lang in [rng.choice(langs)]]


@pytest.mark.parametrize("k", range(2, 12))
def test_codewords_differ_and_split(k):
    c = langid.codewords(k)
    assert c.shape[0] == k and len({tuple(r) for r in c}) == k
    assert (np.abs(c.sum(axis=0)) < k).all() and len({tuple(x * x[0]) for x in c.T}) == c.shape[1]
    least = min((a != b).sum() for i, a in enumerate(c) for b in c[:i])
    assert least >= (1 if k < 4 else 3)  # from four languages on, a wrong bit is corrected


def test_held_out_languages(spark):
    rows = lang_rows()
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").withColumn("score", F.lit("clash")).withColumn("p", F.lit(1))
    model = langid.fit(df.where("doc_id % 3 <> 0"))
    found = {r["doc_id"]: r for r in langid.identified(df.where("doc_id % 3 = 0"), model).collect()}
    right = [found[i]["lang_pred"] == lang for i, _, lang in rows if i % 3 == 0]
    assert np.mean(right) >= 0.97
    assert all(0 <= r["score"] <= 1 for r in found.values())


def test_language_edge_cases(spark):
    df = spark.createDataFrame(lang_rows(60, ("aa", "bb")), "doc_id bigint, text string, lang string")
    model = langid.fit(df.union(spark.createDataFrame([(900, "qq", None), (901, None, "zz"), (902, "", "yy")], df.schema)))
    assert model.langs == ["aa", "bb", "yy"]
    odd = [(1, None), (2, ""), (3, " 12 .,!\n"), (4, "abc " * 200_000), (5, "hgf"), (5, "hgf"), (None, "mno"), (6, "日本 ١٢٣"), (7, "١٢٣")]
    got = [tuple(r) for r in langid.identified(docs_frame(spark, odd), model).collect()]
    by = {}
    for i, lang, score, unclear in got:
        by.setdefault(i, []).append((lang, score, unclear))
    assert len(got) == len(odd) and by[5][0] == by[5][1]
    for i in (1, 2, 3, 7):
        assert by[i] == [("und", 0.0, True)]
    assert by[4][0][0] == "aa" and by[None][0][0] == "bb" and by[6][0][0] != "und"
    assert langid.identified(docs_frame(spark, []), model).collect() == []


def test_nothing_or_one_language_learned(spark):
    none = langid.fit(spark.createDataFrame([], "doc_id bigint, text string, lang string"))
    assert [r["lang_pred"] for r in langid.identified(docs_frame(spark, [(1, "abc")]), none).collect()] == ["und"]
    one = langid.fit(spark.createDataFrame([(1, "abc abc", "aa")], "doc_id bigint, text string, lang string"))
    assert [r["lang_pred"] for r in langid.identified(docs_frame(spark, [(1, "abc"), (2, "7")]), one).collect()] == ["aa", "und"]


# ---- toxicity -------------------------------------------------------------------


def toxic_rows(n=1200):
    rng = random.Random(8)
    words = [f"{a}{b}{c}" for a in "bdfgklm" for b in "aeiou" for c in "nrst"]
    rows = []
    for i in range(n):
        body = [rng.choice(words) for _ in range(rng.randrange(5, 80))]
        bad = rng.random() < 0.25
        if bad:
            for _ in range(rng.randrange(1, 4)):
                w = rng.choice(["zorgol", "vexxum" + rng.choice(["a", "o", "ent", "is"])])
                if rng.random() < 0.3:
                    w = w.replace("o", "0").replace("e", "3")
                if rng.random() < 0.2:
                    w = w.replace("o", "о").upper()
                body.insert(rng.randrange(len(body)), w)
        elif rng.random() < 0.05:
            body.insert(rng.randrange(len(body)), "vexxumburg")  # a harmless word that begins like an entry
        rows.append((i, " ".join(body), int(bad)))
    return rows


def test_held_out_toxicity(spark):
    rows = toxic_rows()
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id bigint, text string").withColumn("toxic", F.lit("clash")).withColumn("words", F.lit(1))
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(None, 1), (5, None), (99999, 1)], "doc_id bigint, toxic int")
    lexicon = toxicity.fit(docs, labels.where("coalesce(doc_id, 1) % 5 <> 0"))
    assert any(w.startswith(" vexx") for w in lexicon.weights) and " vexxumburg " in lexicon.exceptions
    found = {r["doc_id"]: r for r in toxicity.scored(docs.where("doc_id % 5 = 0"), lexicon).collect()}
    held = [(y, found[i]["predicted"], found[i]["score"]) for i, _, y in rows if i % 5 == 0]
    assert sum(y == p for y, p, _ in held) >= 0.98 * len(held)
    assert all(0 <= s <= 1 and p == int(s >= 0.5) for _, p, s in held)


def test_folding():
    assert toxicity.folded("1D10T") == " idiot "
    assert toxicity.folded("ѕсum, tr4sh!") == " scum trash "
    assert toxicity.folded("ｓｃｕｍ z​ero") == " scum zero "
    assert toxicity.folded("10 men, 108.51 3rd!") == " 10 men 108 51 erd "
    assert toxicity.folded("w!nd m4$h. no!") == " wind mash no "
    assert toxicity.folded("!!! \n") == "  "
    for text in ("Été, ÜBER_all – «ça»!", "Été, ÜBER_all ça! x9y @b2c c-d", "A\x00b\x1fc\u00a0d"):  # both ways of folding agree
        slow = toxicity.folded(text + " —")
        assert toxicity.folded(text) == slow


def test_matches_follow_the_lexicon():
    lexicon = toxicity.Lexicon({" stem": 2.0, " whole ": 3.0, " stemmed ": 5.0}, {" stemware ", " whole grain "})
    a = lexicon.automaton()

    def brute(text):
        t = toxicity.folded(text)
        total = 0.0
        for b in range(len(t)):
            if any(t.startswith(e, s) and s <= b < s + len(e) - 1 for e in lexicon.exceptions for s in range(len(t))):
                continue
            total += max([w for p, w in lexicon.weights.items() if t.startswith(p, b)], default=0.0)
        return total

    rng = random.Random(3)
    for _ in range(200):
        text = " ".join(rng.choice(["stem", "stems", "stemmed", "stemware", "whole", "grain", "wholes", "the", "whole grain"]) for _ in range(rng.randrange(12)))
        assert toxicity.evidence(text, a)[0] == brute(text)


def test_toxicity_edge_cases(spark):
    lexicon = toxicity.Lexicon({" bad ": 4.0}, set(), (-4.0, 3.0, 0.5))
    odd = [(1, None), (2, ""), (3, "bad"), (3, "bad"), (None, "bad bad"), (4, "fine " * 300_000 + "bad")]
    got = [tuple(r) for r in toxicity.scored(docs_frame(spark, odd), lexicon).collect()]
    assert len(got) == 6 and got.count((3, *next(g[1:] for g in got if g[0] == 3))) == 2
    by = {g[0]: g for g in got}
    assert by[1][1:] == by[2][1:] and by[1][2] == 0 and by[3][2] == 1 and by[None][2] == 1
    empty = toxicity.fit(docs_frame(spark, odd), spark.createDataFrame([(3, 0)], "doc_id bigint, toxic int"))
    assert empty.weights == {} and {r["predicted"] for r in toxicity.scored(docs_frame(spark, odd), empty).collect()} == {0}
    assert toxicity.scored(docs_frame(spark, []), lexicon).collect() == []


def test_many_matches_and_exceptions_take_linear_time():
    lexicon = toxicity.Lexicon({" bad": 2.0}, {" badge ", " bad badge "})
    start = time.time()
    weight, words = toxicity.evidence("badge bad " * 100_000, lexicon.automaton())
    assert time.time() - start < 10 and words == 200_000
    assert weight == 2.0 * 1  # all but the last are spared by " bad badge "


def test_rows_to_learn_from_are_bounded(spark):
    """A doc_id that many rows share does not lift the bound; equal rows count once."""
    rows = [(1, f"text number {i} zorgol") for i in range(300)] + [(2, "same")] * 300 + [(i, f"clean {i}") for i in range(3, 60)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(1, 1)] + [(i, 0) for i in range(2, 60)], "doc_id bigint, toxic int")
    seen = []
    settled = toxicity.settled
    toxicity.settled = lambda df: seen.append(settled(df)) or seen[-1]
    try:
        toxicity.fit(docs, labels, sample=100)
    finally:
        toxicity.settled = settled
    assert seen[0].count() == 100 and seen[0].where("text = 'same'").count() <= 1
