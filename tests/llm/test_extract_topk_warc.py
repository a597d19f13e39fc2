import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import extract, topk, warc
from tidemark.llm.common import settled

LONG = "The story of the town and its people is told in the long rows of houses that stand by the river, and in the mills that once fed all of them for many years."


@pytest.mark.parametrize(
    "page, want",
    [
        (None, ""),
        ("", ""),
        ("no markup", ""),
        (f"<article><h1>Head</h1><p>{LONG}</p><p>Short.</p></article>", f"Head\n\n{LONG}\n\nShort."),
        (f"<nav><a href=x>Menu</a></nav><article><p>{LONG}</p></article><footer>&copy; me</footer>", LONG),
        (f"<article><p>a&amp;b &lt;i&gt; &#233;&nbsp;x</p><p>{LONG}</p></article>", f"a&b <i> é x\n\n{LONG}"),
        (f'<article><p>{LONG}</p><div class="ad">Buy now</div><aside><p>{LONG}</p></aside><p>End</p></article>', f"{LONG}\n\nEnd"),
        (f'<article><p>{LONG}</p></article><section id="comments"><p>{LONG}</p></section>', LONG),
        (f'<header><p>{LONG}</p></header><main><p>{LONG}</p><form><p>Mail</p></form></main>', LONG),
        (f"<article><p>one\n  two<br>three <b>bo</b>ld</p><script>var t = '</p>'; if (a<b) x()</script><style>p{{}}</style><p>{LONG}", f"one two three bold\n\n{LONG}"),
        (f"<article><p>{LONG}</p><p>cut <a hre", f"{LONG}\n\ncut"),
        (f"<article><p>{LONG}</p><!-- <p>hidden</p> --><p>x<!-- open", f"{LONG}\n\nx"),
        ("<article><p>Be.</p></article>", "Be."),
        (f"<div><a href=a>one</a> <a href=b>two</a></div><div><h2>Head</h2><p>{LONG}</p><p>Tail.</p></div><div><a href=c>three</a> <a href=d>four</a></div>", f"Head\n\n{LONG}"),
        (f'<body class="menu"><article><p class="notice">Cookies</p><p>{LONG}</p><span class="advert">x</span></article></body>', LONG),
        ("<article><p>1 < 2 & 3 > 2</p></article>", "1 < 2 & 3 > 2"),
    ],
)
def test_main_text(page, want):
    assert extract.main_text(page) == want


@pytest.mark.parametrize(
    "notice",
    [
        '<img class="banner" src=x>', '<hr class="ad">', '<input class="search widget">', '<img aria-hidden="true">', '<img alt="a hidden village">', '<div title="a hidden village" data-x="display: none"></div>',
        '<p class="notice">Cookies', '<p class="notice">Cookies<p></p>', '<ul><li class="ad">Buy<li></ul>', '<dl><dt class="ad">Buy<dd></dl>', '<table><tr><td class="ad">Buy<td></table>', '<table><tr class="ad"><td>Buy<tr></table>',
        '<div><div class="ad">Buy</section></div></div>', '<section><div class="ad"><div>Buy</div></section>', '<section><span class="ad">Buy</section>', '<div hidden><b><div>Buy</b></div>Buy</div>', '<table><tr><td class="ad"><table><tr><td>Buy<td>Buy</table>Buy</table>',
    ],
)
def test_boilerplate_ends_where_its_element_does(notice):
    assert extract.main_text(f"<article>{notice}<p>{LONG}</p></article>") == LONG
    assert extract.main_text(f"{notice}<p>{LONG}</p>") == LONG


PROSE = " ".join([LONG] * 2)
RUSSIAN = " ".join(["Город стоит на берегу реки, и его дома видны с холма. Люди здесь живут давно, и все они знают друг друга. В мае у воды сидят старики и говорят о том, что было."] * 2)
CHINESE = "这座城市位于河边，居民们已经在这里生活了很多年。春天的时候，孩子们在广场上玩耍，老人们坐在水边谈论过去的事情。" * 3


@pytest.mark.parametrize(
    "page, want",
    [
        (f'<main class="with-sidebar"><p>{PROSE}</p></main>', PROSE),
        (f'<div class="content has-sidebar"><p>{PROSE}</p></div>', PROSE),
        (f'<article class="post no-comments"><p>{PROSE}</p></article>', PROSE),
        (f'<article id="related-1"><p>{PROSE}</p></article>', PROSE),
        (f'<main class="page alert-none"><p>{PROSE}</p></main>', PROSE),
        (f'<div class="related"><main><p>{PROSE}</p></main></div><div class="related"><p>{PROSE}</p></div>', PROSE),
        (f'<body><form id="aspnetForm"><div><a href=x>Home</a></div><p>{PROSE}</p></form></body>', PROSE),
        (f"<form><main><p>{PROSE}</p></main></form>", PROSE),
        (f"<p>{PROSE}</p><form><p>{LONG}</p></form>", PROSE),
        (f'<a name="top"><p>{PROSE}</p><p>{PROSE}</p>', f"{PROSE}\n\n{PROSE}"),
        (f"<div><a href=x>Home</div><p>{PROSE}</p>", PROSE),
        (f"<p>{RUSSIAN}</p><div><a href=x>Главная</a> <a href=y>Ещё</a></div>", RUSSIAN),
        (f"<p>{CHINESE}</p>", CHINESE),
        (PROSE, PROSE),
        ("<h1>Closed</h1><p>We are away.</p>", "Closed\n\nWe are away."),
        (f"<head><title>x</title><meta a><p>{PROSE}</p>", PROSE),
        (f'<article><p>{PROSE}</p></article><div class="comments"><article class="comment"><p>{PROSE}{PROSE}</p></article></div>', PROSE),
        (f'<p>{PROSE}</p><div id="comments"><p>{PROSE}{PROSE}{PROSE}</p></div>', PROSE),
        (f'<p>{PROSE}</p><div class="sidebar"><p>{LONG}</p></div><div class="cookie-notice"><p>{LONG}</p></div>', PROSE),
    ],
)
def test_articles_in_doubtful_elements_stay(page, want):
    assert extract.main_text(page) == want


def test_pages_frame(spark):
    rows = [(1, "u", f"<article><p>{LONG}</p></article>"), (1, "u", f"<article><p>{LONG}</p></article>"), (None, None, None), (2, "v", "<p>" + "word the " * 100_000)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("text", F.lit("clash")).withColumn("n_chars", F.lit(-1))
    got = sorted(map(tuple, extract.extracted(df).collect()), key=repr)
    assert got == sorted([(1, "u", LONG, len(LONG))] * 2 + [(None, None, "", 0), (2, "v", ("word the " * 100_000).strip(), 899_999)], key=repr)
    assert extract.extracted(df.where("page_id = 9")).collect() == []


# ---- top-k ----------------------------------------------------------------------


def brute_topk(rows, every, k=5):
    good = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, a in good:
        if q % every == 0:
            scores = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in good if i != q)[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores)]
    return sorted(out)


@pytest.mark.parametrize("block", [16, 2048])
def test_topk_equals_brute_force(spark, block):
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(6, 12))
    rows = [(i, (centres[i % 6] + 0.3 * rng.normal(size=12)).astype(np.float32).tolist()) for i in range(400)]
    rows += [(400 + i, rows[7][1]) for i in range(60)]  # one vector many times: ties
    rows += [(500, None), (501, [float("nan")] * 12), (502, [None] + [0.0] * 11), (503, [float("inf")] * 12), (504, []), (505, [1.0, 2.0]), (510, [0.0] * 12), (None, [1.0] * 12)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumn("score", F.lit("clash")).withColumn("block", F.lit(1))
    vectors = topk.integers(df)
    got = topk.top_k(vectors, vectors.where("vec_id % 10 = 0"), block=block, pivots=8)
    assert sorted(map(tuple, got.collect())) == brute_topk(rows, 10)


def test_topk_of_few_or_no_vectors(spark):
    schema = "vec_id bigint, embedding array<float>"
    few = [(0, [1.0]), (50, [-1.0]), (3, [2.0])]
    vectors = topk.integers(spark.createDataFrame(few, schema))
    assert sorted(map(tuple, topk.top_k(vectors, vectors.where("vec_id % 50 = 0")).collect())) == brute_topk(few, 50)
    none = topk.integers(spark.createDataFrame([], schema))
    assert topk.top_k(none, none).collect() == []


def test_large_components_are_exact(spark):
    rng = np.random.default_rng(3)
    rows = [(i, (rng.integers(-(2**22), 2**22, 4)).astype(float).tolist()) for i in range(60)]
    vectors = topk.integers(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>"))
    got = topk.top_k(vectors, vectors.where("vec_id % 10 = 0"))
    assert sorted(map(tuple, got.collect())) == brute_topk(rows, 10)


def test_components_beyond_32_bits_take_part(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=3).astype(np.float32).tolist()) for i in range(40)] + [(100, [1e7, 1.0, 0.0]), (101, [-1e7, 0.5, 2.0]), (110, [float(2**23), -(2.0**23), 1.0]), (120, [1e7, 1.0, 0.0])]
    vectors = topk.integers(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>"))
    got = topk.top_k(vectors, vectors.where("vec_id % 10 = 0"), block=8, pivots=4)
    assert sorted(map(tuple, got.collect())) == brute_topk(rows, 10)


# ---- WARC -----------------------------------------------------------------------


def pages(spark):
    rng = random.Random(5)
    rows = [(i, f"http://x/{i}", "<p>" + "é" * rng.randrange(300) + "\r\n\r\nWARC/1.0</p>") for i in range(600)]
    rows += [(700, None, None), (None, "u", "null id"), (5, "http://x/5", "again"), (701, "a\r\nb", "")]
    return spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("offset", F.lit("clash"))


def test_audit_finds_what_differs(spark):
    a = settled(warc.fixity(pages(spark), per_archive=100))
    rows = {(r["archive"], r["offset"]): r["sha256"] for r in a.collect()}
    assert len(rows) == 604
    rng = random.Random(1)
    bad = rng.sample(sorted(rows, key=repr), 9)
    changed, missing = set(bad[:5]), set(bad[5:])
    schema = "archive bigint, offset bigint, length bigint, sha256 string"
    other = [(k[0], k[1], 1, "x" if k in changed else v) for k, v in rows.items() if k not in missing] + [(99, 7, 1, "new"), (0, 3, 1, "between")]
    b = spark.createDataFrame(other, schema)
    want = {(*k, "changed") for k in changed} | {(*k, "missing") for k in missing} | {(99, 7, "extra"), (0, 3, "extra")}
    for leaf, fanout in ((1 << 16, 16), (256, 2), (1 << 30, 16)):
        assert set(map(tuple, warc.audit(a, b, leaf_bytes=leaf, fanout=fanout).collect())) == want
    assert warc.audit(a, a).collect() == []
    assert warc.audit(a, a.limit(0)).count() == 604 and warc.audit(a.limit(0), a.limit(0)).collect() == []


def test_files_hold_the_records(spark, tmp_path):
    rows = warc.records(pages(spark), per_archive=100)
    path = str(tmp_path / "warc")
    warc.write_archives(rows, path)
    got = {tuple(r) for r in warc.read_archives(spark, path).collect()}
    want = {(r["archive"], r["offset"], r["length"], r["sha256"]) for r in warc.fixity(pages(spark), per_archive=100).collect()}
    assert got == want
    data = rows.where("archive = 1").orderBy("offset").collect()
    text = "".join(r["record"] + "\r\n\r\n" for r in data).encode()
    assert all(text[r["offset"] : r["offset"] + r["length"]] == (r["record"] + "\r\n\r\n").encode() for r in data)
    assert hashlib.sha256(text[: data[0]["length"]]).hexdigest() in {s for *_, s in want}


def test_fixity_query_audits_pages_without_an_id(spark, tmp_path):
    from tidemark.llm import queries

    rows = [(None if i % 3 else i, f"http://x/{i % 50}", "x" * (i % 400)) for i in range(900)] + [(7, "u", "same")] * 500
    spark.createDataFrame(rows, "page_id bigint, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    got = queries.op3_merkle_fixity(spark, str(tmp_path)).collect()
    seen = {(r["archive"], r["offset"]): r for r in got}
    assert len(seen) == len(got) == len(rows)
    for archive in {r["archive"] for r in got}:
        at = 0
        for r in sorted((r for r in got if r["archive"] == archive), key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
    for k, (i, _, html) in enumerate(rows):
        rows[k] = (i, "missing" if len(html) % 89 == 0 else "changed" if len(html) % 97 == 0 else "ok")
    assert sorted(map(repr, rows)) == sorted(repr((r["page_id"], r["status"])) for r in got)


def test_one_archive_of_equal_rows_is_laid_out(spark):
    rows = spark.range(4000).selectExpr("CAST(NULL AS BIGINT) AS page_id", "'u' AS url", "'same' AS html")
    laid = warc.fixity(rows)
    assert laid.agg(F.count_distinct("offset"), F.max(F.col("offset") / F.col("length"))).first()[:] == (4000, 3999.0)
