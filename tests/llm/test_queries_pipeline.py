"""The registered queries against their SQL, and the pipeline's stages against brute force."""

import os
import hashlib
import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from llm_util import sentence
from oracle import compare, duck
from test_decontam import brute as brute_contamination
from test_jaccard import brute as brute_classes
from test_packing_sharding import check_packed, check_shards
from tidemark.llm import extract, queries

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are not here")


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_sql(spark, name):
    assert compare(queries.QUERIES[name](spark, SF), duck(SF), queries.ORACLE[name]) == ""


def documents(spark):
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]


def test_packing_query(spark):
    check_packed(queries.QUERIES["op4_pattern_packing"](spark, SF).collect(), documents(spark), 2048)


def test_sharding_query(spark):
    sums = check_shards(queries.QUERIES["op9_differencing_shards"](spark, SF).collect(), documents(spark), 16)
    assert max(sums) - min(sums) <= 0.02 * sum(sums) / 16


def test_html_query(spark):
    want = {r["page_id"]: extract.main_text(r["html"]) for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = queries.QUERIES["op10_block_rules"](spark, SF).collect()
    assert {r["page_id"]: r["text"] for r in got} == want and all(r["n_chars"] == len(r["text"]) for r in got)


def test_learned_queries(spark):
    langs = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = queries.QUERIES["op2_ecoc_language"](spark, SF).collect()
    held = [r["lang_pred"] == langs[r["doc_id"]] for r in got if r["held_out"]]
    assert len(got) == len(langs) and sum(held) >= 0.97 * len(held)
    toxic = queries.QUERIES["op8_lexicon_toxicity"](spark, SF).collect()
    assert len(toxic) == len(langs) and all(r["predicted"] == int(r["score"] >= 0.5) for r in toxic)


# ---- pipeline -------------------------------------------------------------------

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, component_id string, score string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, "s", len(t or ""), "clash", "clash") for i, t, lang in rows], SCHEMA)


def test_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "toxicity", "jaccard_join", "decontamination", "packing"]


def test_every_stage_but_the_last_keeps_the_columns(spark):
    docs = frame(spark, [(i, f"some words of one kind number {i}", "en") for i in range(30)])
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and out.count() == 30


def test_language_stage_drops_what_is_no_language(spark):
    rng = random.Random(1)
    rows = [(i, sentence(rng, 30), "en") for i in range(40)] + [(100, None, None), (101, "", "en"), (102, "12 34", "en"), (None, "w1 w2 w3", None)]
    assert sorted(-1 if r["doc_id"] is None else r["doc_id"] for r in corpus_pipeline.language(spark, frame(spark, rows), SF).collect()) == [-1, *range(40)]


def test_distinct_stage_keeps_one_of_each_class(spark):
    """Classes are made of texts: no unique text goes, whatever its doc_id, and one row of each class stays."""
    rng = random.Random(2)
    base = sentence(rng, 200, 5000)
    rows = [(10 + i, base + f" tail{i}", "en") for i in range(20)] + [(5, base, "en"), (201, None, "en"), (None, base, "en"), (7, "", "en"), (8, "", "en")]
    rows += [(200, sentence(rng, 50), "en"), (200, "quite different", "en"), (200, "a third text", "en"), (200, base, "en")]  # one doc_id, texts of their own and a copy
    rows += [(None, "copies without an id", "en")] * 3 + [(300, "equal rows", "en")] * 4 + [(None, "equal rows", "en"), (301, "equal rows", "fr")]
    for order in (rows, rows[::-1]):
        got = corpus_pipeline.distinct(spark, frame(spark, order), SF)
        kept = sorted(((r["doc_id"], r["text"]) for r in got.collect()), key=repr)
        numbered = {c: i for i, c in enumerate(sorted({t for _, t, _ in rows if t}))}
        classes = {d: c for d, _, c in brute_classes([(i, t) for t, i in numbered.items()])}
        want = [(d, t) for d, t, _ in rows if not t]
        for c in set(classes.values()):
            mine = [(d, t) for d, t, _ in rows if t and classes[numbered[t]] == c]
            want.append(min(mine, key=lambda r: (r[0] is None, r[0] or 0, hashlib.md5(r[1].encode()).hexdigest())))
        assert kept == sorted(want, key=repr)


def test_distinct_stage_names_its_rule(spark, monkeypatch):
    asked, classes = [], corpus_pipeline.jaccard.similarity_classes
    monkeypatch.setattr(corpus_pipeline.jaccard, "similarity_classes", lambda docs, **rule: asked.append(rule) or classes(docs, **rule))
    corpus_pipeline.distinct(spark, frame(spark, [(1, "a b c d", "en")]), SF)
    assert asked == [{"shingle": 3, "percent": 90}]


def test_decontamination_stage_follows_the_rule(spark):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    rng = random.Random(3)
    rows = [(i, f"{sentence(rng, n)} {items[i][1]} {sentence(rng, n)}", "en") for i, n in enumerate([0, 5, 50, 200, 2000])]
    rows += [(50, sentence(rng, 100), "en"), (51, None, "en"), (52, "", "en"), (None, items[7][1], "en"), (None, "fine", "en"), (53, items[8][1], "en"), (53, "fine too", "en")]
    kept = {(r["doc_id"], r["text"]) for r in corpus_pipeline.decontaminated(spark, frame(spark, rows), SF).collect()}
    bad = [brute_contamination([(i, t)], items)[0][5] for i, t, _ in rows]
    assert kept == {(i, t) for (i, t, _), b in zip(rows, bad) if not b} and sum(bad) >= 5


def test_toxicity_stage_follows_the_labels(spark, tmp_path):
    rng = random.Random(4)
    rows = [(i, sentence(rng, 40) + (" vexxum and zorgol" if i % 4 == 0 else ""), "en") for i in range(400)]
    spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i, _, _ in rows[:300]], "doc_id bigint, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    kept = {r["doc_id"] for r in corpus_pipeline.clean(spark, frame(spark, rows), str(tmp_path)).collect()}
    assert kept == {i for i, _, _ in rows if i % 4}


def test_run_packs_what_the_stages_keep(spark):
    out = corpus_pipeline.run(spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
    kept = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    check_packed(out.collect(), kept, 2048)
    assert 0.5 * len(documents(spark)) < len(kept) < len(documents(spark))
