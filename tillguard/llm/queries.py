"""Registered queries of the training-data operators and their oracle SQL."""

from __future__ import annotations

from . import byte_bpe, html_diff, imatch, jaccard, lexical, packing, quality, secrets, sharding, topk, toxicity, warc, whitening
from .common import table


def op9_byte_bpe(spark, sf_dir):
    return byte_bpe.digest(table(spark, sf_dir, "documents"))


def op3_packing(spark, sf_dir):
    return packing.digest(table(spark, sf_dir, "documents"))


def op6_quality_rules(spark, sf_dir):
    return quality.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_secret_scan(spark, sf_dir):
    return secrets.digest(table(spark, sf_dir, "documents"))


def op2_toxicity(spark, sf_dir):
    return toxicity.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op1_kd_sharding(spark, sf_dir):
    return sharding.digest(table(spark, sf_dir, "documents"))


def op10_warc(spark, sf_dir):
    return warc.digest(table(spark, sf_dir, "pages"))


def op8_jaccard_join(spark, sf_dir):
    return jaccard.join(table(spark, sf_dir, "documents"))


def op5_imatch(spark, sf_dir):
    return imatch.digest(table(spark, sf_dir, "documents"))


def op7_html_extraction(spark, sf_dir):
    return html_diff.digest(table(spark, sf_dir, "pages"))


def op11_whitening(spark, sf_dir):
    return whitening.digest(table(spark, sf_dir, "embeddings"))


def op12_topk(spark, sf_dir):
    return topk.digest(table(spark, sf_dir, "embeddings"))


def op13_lexical_search(spark, sf_dir):
    return lexical.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {"op11_whitening": op11_whitening, "op12_topk": op12_topk, "op13_lexical_search": op13_lexical_search,
           "op7_html_extraction": op7_html_extraction, "op5_imatch": op5_imatch, "op8_jaccard_join": op8_jaccard_join, "op1_kd_sharding": op1_kd_sharding, "op10_warc": op10_warc, "op2_toxicity": op2_toxicity, "op4_secret_scan": op4_secret_scan, "op6_quality_rules": op6_quality_rules, "op3_packing": op3_packing, "op9_byte_bpe": op9_byte_bpe}
ORACLES: dict[str, str] = {
    # all pairs by common shingles, exact; classes by transitive closure
    "op8_jaccard_join": r"""
WITH RECURSIVE d AS (
  SELECT doc_id, text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' ')))
                             WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM d),
size AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
copy AS (SELECT doc_id, min(doc_id) OVER (PARTITION BY text) AS text_id FROM d),
link AS (
  SELECT x, y FROM shared JOIN size p ON p.doc_id = x JOIN size q ON q.doc_id = y WHERE 5 * c >= 4 * (p.n + q.n - c)
  UNION SELECT a.doc_id, b.doc_id FROM copy a JOIN copy b ON a.text_id = b.text_id AND a.doc_id < b.doc_id),
pair AS (SELECT x, y FROM link UNION SELECT y, x FROM link),
reach AS (SELECT x, y FROM pair UNION SELECT r.x, p.y FROM reach r JOIN pair p ON r.y = p.x)
SELECT c.doc_id, c.text_id, least(c.doc_id, coalesce((SELECT min(y) FROM reach r WHERE r.x = c.doc_id), c.doc_id)) AS class_id,
       (SELECT count(*) FROM pair p WHERE p.x = c.doc_id) AS n_links,
       (SELECT count(DISTINCT o.text_id) FROM pair p JOIN copy o ON o.doc_id = p.y WHERE p.x = c.doc_id AND o.text_id <> c.text_id) AS n_text_links
FROM copy c""",
    "op10_warc": """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
q AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
FROM q""",
    # every product of a query and a row
    "op12_topk": """
WITH f AS (
  SELECT vec_id, list_transform(embedding, lambda c: CAST(floor(256 * CAST(c AS DOUBLE)) AS DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM f q JOIN f c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= 5""",
    # every document with a term of the item, by its terms' counts
    "op13_lexical_search": r"""
WITH d AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
size AS (SELECT doc_id, count(*) AS n FROM d GROUP BY doc_id),
a AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS total FROM size),
tf AS (SELECT doc_id, term, count(*) AS tf FROM d GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w FROM tf, a GROUP BY term, docs),
b AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                     '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
s AS (
  SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // total)))) AS BIGINT) AS score
  FROM b JOIN w USING (term) JOIN tf USING (term) JOIN size USING (doc_id), a GROUP BY item_id, doc_id)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM s WHERE score > 0 QUALIFY rank <= 10""",
}
