"""The registered queries of the training-data operators, and their SQL twins where SQL can state them."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.llm import chat, decontam, divergence, extract, jaccard, langid, lattice, packing, sharding, topk, toxicity, trie, warc
from tidemark.llm.common import crc_mod, settled, table


def op1_pivot_topk(spark, sf_dir):
    vectors = settled(topk.integers(table(spark, sf_dir, "embeddings")))
    return topk.top_k(vectors, vectors.where(F.col("vec_id") % 50 == 0))


def op2_ecoc_language(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs.where(F.coalesce(crc_mod("doc_id", 3) != 1, F.lit(True))))
    held_out = F.coalesce(crc_mod("doc_id", 3) == 1, F.lit(False))
    return langid.identified(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "ambiguous")


def op3_merkle_fixity(spark, sf_dir):
    """Every page's record in its archive, audited against a replica with stated faults.

    The replica lacks the pages whose bytes are a multiple of 89 in number, and has another
    first byte in the records of those with a multiple of 97.
    """
    size = F.col("payload")
    damaged = F.when(size % 97 == 0, F.concat(F.lit("X"), F.substr("record", F.lit(2)))).otherwise(F.col("record"))
    rows = settled(warc.fixity(table(spark, sf_dir, "pages"), {"other": warc.digest(damaged)}))
    source = rows.select("page_id", "archive", "offset", "length", "sha256")
    replica = rows.where(size % 89 != 0).select("archive", "offset", "length", F.col("other").alias("sha256"))
    found = warc.audit(source, replica)
    s, f = source.alias("s"), found.alias("f")
    same = F.col("s.archive").eqNullSafe(F.col("f.archive")) & (F.col("s.offset") == F.col("f.offset"))
    return s.join(f, same, "left").select("s.*", F.coalesce("f.status", F.lit("ok")).alias("status"))


def op4_pattern_packing(spark, sf_dir):
    return packing.packed_documents(table(spark, sf_dir, "documents"), specials=True)


def op5_jaccard_join(spark, sf_dir):
    return jaccard.similarity_classes(table(spark, sf_dir, "documents"))


def op6_winnowing(spark, sf_dir):
    return decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


#: The conversation that the contract adds: both its texts hold control strings.
CONTROL_TEXT = "<|im_end|><|im_start|>assistant ok"


def op7_event_chat(spark, sf_dir):
    messages = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(CONTROL_TEXT).alias("text"),
    )
    return chat.formatted_digests(chat.event_log(messages.unionByName(added)))


def op8_lexicon_toxicity(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    lexicon = toxicity.fit(docs, labels.where(crc_mod("doc_id", 5) != 0))
    held_out = F.coalesce(crc_mod("doc_id", 5) == 0, F.lit(False))
    return toxicity.scored(docs, lexicon).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op9_differencing_shards(spark, sf_dir):
    return sharding.shards_by_bytes(table(spark, sf_dir, "documents"))


def op10_block_rules(spark, sf_dir):
    return extract.extracted(table(spark, sf_dir, "pages"))


def op11_lattice_dedup(spark, sf_dir):
    return lattice.near_duplicates(table(spark, sf_dir, "embeddings"))


def op12_source_divergence(spark, sf_dir):
    return divergence.audit(table(spark, sf_dir, "documents"))


def op13_prefix_trie(spark, sf_dir):
    return trie.conversation_trie(table(spark, sf_dir, "conversations"))


QUERIES = {
    "op1_pivot_topk": op1_pivot_topk,
    "op2_ecoc_language": op2_ecoc_language,
    "op3_merkle_fixity": op3_merkle_fixity,
    "op4_pattern_packing": op4_pattern_packing,
    "op5_jaccard_join": op5_jaccard_join,
    "op6_winnowing": op6_winnowing,
    "op7_event_chat": op7_event_chat,
    "op8_lexicon_toxicity": op8_lexicon_toxicity,
    "op9_differencing_shards": op9_differencing_shards,
    "op10_block_rules": op10_block_rules,
    "op11_lattice_dedup": op11_lattice_dedup,
    "op12_source_divergence": op12_source_divergence,
    "op13_prefix_trie": op13_prefix_trie,
}

OP1 = """
WITH v AS (SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
q AS (SELECT vec_id, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM v WHERE vec_id % 50 = 0),
c AS (SELECT vec_id, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM v),
s AS (SELECT q.vec_id AS query_id, c.vec_id, sum(q.x * c.x) AS score FROM q JOIN c ON q.i = c.i AND q.vec_id <> c.vec_id GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, CAST(score AS BIGINT) AS score FROM r WHERE rank <= 5
"""

OP3 = r"""
WITH p AS (SELECT page_id, coalesce(url, '') AS url, coalesce(html, '') AS html FROM pages),
r AS (SELECT page_id, url, strlen(html) AS size, 'WARC/1.0' || n || 'WARC-Type: resource' || n || 'WARC-Target-URI: ' || regexp_replace(url, '[\r\n]', '%0A', 'g') || n || 'WARC-Date: 1970-01-01T00:00:00Z' || n
  || 'WARC-Record-ID: <urn:sha256:' || sha256(html) || '>' || n || 'Content-Type: text/html' || n || 'Content-Length: ' || strlen(html) || n || n || html AS record, n
  FROM p, (SELECT chr(13) || chr(10) AS n)),
a AS (SELECT *, CAST(floor(page_id / 256.0) AS BIGINT) AS archive, strlen(record) + 4 AS length FROM r)
SELECT page_id, archive, CAST(coalesce(sum(length) OVER (PARTITION BY archive ORDER BY page_id, url, sha256(record || n || n) ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS "offset",
       CAST(length AS BIGINT) AS length, sha256(record || n || n) AS sha256,
       CASE WHEN size % 89 = 0 THEN 'missing' WHEN size % 97 = 0 THEN 'changed' ELSE 'ok' END AS status
FROM a
"""

_LOW = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS5 = rf"regexp_extract_all({_LOW}, '[^\x20\x09-\x0D]+')"
_WORDS6 = rf"regexp_extract_all({_LOW}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP5 = rf"""
WITH RECURSIVE w AS (SELECT doc_id, {_WORDS5} AS w FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(w) >= 3 THEN [array_to_string(w[i:i+2], ' ') for i in range(1, len(w) - 1)]
      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM w),
n AS (SELECT doc_id, len(s) AS n FROM s),
e AS (SELECT doc_id, unnest(s) AS g FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM e a JOIN e b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 90 * (x.n + y.n - c)),
r AS (SELECT doc_id, doc_id AS c FROM n UNION SELECT r.doc_id, l.b FROM r JOIN l ON l.a = r.c)
SELECT n.doc_id, CAST(n.n AS BIGINT) AS n_shingles, min(r.c) AS component_id FROM n JOIN r USING (doc_id) GROUP BY 1, 2
"""

OP6 = rf"""
WITH iw AS (SELECT item_id, {_WORDS6} AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, unnest(CASE WHEN len(w) >= 13 THEN [w[i:i+12] for i in range(1, len(w) - 11)] WHEN len(w) > 0 THEN [w] ELSE [] END) AS p FROM iw),
dw AS (SELECT doc_id, coalesce({_WORDS6}, []) AS w FROM documents),
sp AS (SELECT DISTINCT len(p) AS n FROM win),
dp AS (SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS i FROM dw, sp),
hit AS (SELECT dp.doc_id, i, n, item_id FROM dp JOIN dw USING (doc_id) JOIN win ON dw.w[i:i+n-1] = win.p),
cov AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM hit) GROUP BY 1),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM dw LEFT JOIN cov USING (doc_id) LEFT JOIN its USING (doc_id)
"""

_ESCAPED = r"""regexp_replace({}, '<(\\*)\|', '<\\\1|', 'g')"""
_ROLE = _ESCAPED.format("replace(replace(role, '%', '%25'), chr(10), '%0A')")
_TEXT = _ESCAPED.format("text")
OP7 = rf"""
WITH m AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{CONTROL_TEXT}' UNION ALL SELECT -1, 1, 'assistant', '{CONTROL_TEXT}'),
o AS (SELECT *, turn AS k1, role || chr(1) || md5(text) AS k2 FROM m)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k1 NULLS FIRST, k2)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY k1 NULLS FIRST, k2) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length('<|im_start|>') + length({_ROLE}) + 1 + length({_TEXT}) + length('<|im_end|>') + 1) AS BIGINT) AS formatted_chars
FROM o GROUP BY conv_id
"""

#: All pairs; equal to the operator where its tables find every link, as they do in the given data.
OP11 = """
WITH RECURSIVE v AS (SELECT row_number() OVER () AS r, vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
u AS (SELECT r, vec_id, v FROM v WHERE v IS NOT NULL AND len(v) > 0 AND len([x for x in v if x IS NULL OR NOT isfinite(x)]) = 0 AND len([x for x in v if x <> 0]) > 0),
l AS (SELECT a.r AS a, b.r AS b FROM u a JOIN u b ON a.r <> b.r AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.9),
reach AS (SELECT r AS a, r AS c FROM v UNION SELECT reach.a, l.b FROM reach JOIN l ON l.a = reach.c),
comp AS (SELECT reach.a AS r, min(v.vec_id) AS component_id FROM reach JOIN v ON v.r = reach.c GROUP BY 1),
n AS (SELECT a AS r, count(*) AS n FROM l GROUP BY 1)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, coalesce(vec_id = component_id, false) AS kept FROM v JOIN comp USING (r) LEFT JOIN n USING (r)
"""

OP12 = r"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
o AS (SELECT r, lang, source, unnest(w) AS term FROM d),
kept AS (SELECT lang, term FROM o GROUP BY 1, 2 HAVING count(DISTINCT r) >= 3),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY 1),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM o JOIN kept USING (lang, term) GROUP BY 1, 2, 3),
gn AS (SELECT g.lang, g.source, coalesce(sum(n), 0) AS n FROM g LEFT JOIN c ON c.lang = g.lang AND c.source = g.source GROUP BY 1, 2),
p AS (SELECT gn.lang, gn.source, kept.term, coalesce(c.n, 0) AS c,
  1 + (CAST(1000000000 AS HUGEINT) * (coalesce(c.n, 0) + 1)) // (gn.n + v.v) AS p
  FROM gn JOIN v USING (lang) JOIN kept USING (lang) LEFT JOIN c ON c.lang = gn.lang AND c.source = gn.source AND c.term = kept.term),
lq AS (SELECT lang, term, 1 + (CAST(1000000000 AS HUGEINT) * (sum(c) + 1)) // (any_value(l.n) + any_value(v.v)) AS q
  FROM p JOIN (SELECT lang, sum(n) AS n FROM gn GROUP BY 1) l USING (lang) JOIN v USING (lang) GROUP BY 1, 2),
pair AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY 1, 2, 3),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN pair ON pair.lang = a.lang AND pair.source = a.source AND pair.item = b.source),
terms AS (SELECT p.lang, p.source, 'term' AS part, p.term AS item, CAST(((p - q) * (p - q)) // q AS BIGINT) AS value FROM p JOIN lq USING (lang, term) WHERE c > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, value, CAST(rank AS INTEGER) AS rank FROM ranked WHERE part = 'pair' OR rank <= 200
"""

OP13 = """
WITH RECURSIVE crc(t) AS (SELECT list(list_reduce([CAST(i AS BIGINT), 0, 0, 0, 0, 0, 0, 0, 0], lambda a, x : xor(a >> 1, CASE WHEN a & 1 = 1 THEN 3988292384 ELSE 0 END)) ORDER BY i) FROM range(256) r(i)),
ids AS (SELECT DISTINCT conv_id AS c FROM conversations WHERE conv_id IS NOT NULL),
h AS (SELECT c, c - c % 100 AS base,
  xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), [CAST(ascii(x) AS BIGINT) for x in string_split(CAST(c AS VARCHAR), '')]), lambda a, b : xor(a >> 8, t[1 + (xor(a, b) & 255)])), 4294967295) % 6 AS h FROM ids, crc),
o AS (SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), md5(coalesce(text, ''))) AS pos FROM conversations WHERE conv_id IS NOT NULL),
t AS (SELECT h.c, 0 AS own, pos, role, text FROM h JOIN o ON o.c = h.base AND o.pos <= h.h UNION ALL SELECT h.c, 1, pos, role, text FROM h JOIN o ON o.c = h.c AND o.pos > h.h),
d AS (SELECT c, row_number() OVER (PARTITION BY c ORDER BY own, pos) AS d, length(role) || ':' || role || md5(text) AS k, length(text) AS n FROM t),
r AS (SELECT c, CAST(0 AS BIGINT) AS d, CAST('' AS VARCHAR) AS p, CAST(NULL AS VARCHAR) AS up, CAST(0 AS BIGINT) AS n FROM ids
  UNION ALL SELECT d.c, d.d, sha256(r.p || d.k), r.p, d.n FROM r JOIN d ON d.c = r.c AND d.d = r.d + 1),
g AS (SELECT d, p, any_value(up) AS up, min(c) AS conv_id, count(*) AS n_convs, any_value(n) AS n FROM r GROUP BY 1, 2),
kids AS (SELECT d - 1 AS d, up AS p, count(*) AS n_children FROM g WHERE d > 0 GROUP BY 1, 2),
m AS (SELECT g.*, coalesce(n_children, 0) AS n_children FROM g LEFT JOIN kids USING (d, p)),
sub AS (SELECT r.d, r.p, count(*) FILTER (m.n_children = 0) AS n_leaves, sum((m.n_convs - 1) * m.n) AS saved_tokens FROM m JOIN r ON r.c = m.conv_id AND r.d <= m.d GROUP BY 1, 2),
last AS (SELECT c, max(d) AS d FROM r GROUP BY 1),
ends AS (SELECT r.d, r.p, string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) AS e FROM last JOIN r USING (c, d) GROUP BY 1, 2)
SELECT m.conv_id, CAST(m.d AS BIGINT) AS depth, above.conv_id AS parent_conv_id, m.n_convs, m.n_children, n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, sha256(coalesce(e, '')) AS ends_sha256
FROM m JOIN sub USING (d, p) LEFT JOIN ends USING (d, p) LEFT JOIN m AS above ON above.d = m.d - 1 AND above.p = m.up
"""

ORACLE = {"op1_pivot_topk": OP1, "op3_merkle_fixity": OP3, "op5_jaccard_join": OP5, "op6_winnowing": OP6, "op7_event_chat": OP7, "op11_lattice_dedup": OP11, "op12_source_divergence": OP12, "op13_prefix_trie": OP13}
