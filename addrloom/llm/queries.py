"""Queries of this subpackage, as __spark_entry__ registers them, and their SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from . import audio, divergence, fingerprint, html_extract, merkle, mixing, neardup, packing, quality, token_files, tokens, topk, toxicity
from .common import stored, table


def op1_phrase_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprint_pairs(table(spark, sf_dir, "documents"))


def op2_telephony(spark: SparkSession, sf_dir: str) -> DataFrame:
    media = stored(audio.store_telephony(table(spark, sf_dir, "documents")), **audio.LAYOUT)
    return audio.read_features(stored(audio.telephony_features(media, keep_pcm=True), **audio.LAYOUT))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_tokens(table(spark, sf_dir, "documents"), tokens.tokenizer_path("word_bpe_49k.json"))


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.read_digests(token_files.write_token_files(table(spark, sf_dir, "documents"), tokens.tokenizer_path("byte_bpe_50k.json"), end_id=2))


def op5_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(stored(mixing.sizes(table(spark, sf_dir, "documents"))))


def op6_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(packing.pieces(table(spark, sf_dir, "documents"), tokens.tokenizer_path("word_bpe_49k.json"), end_id=1))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    forest = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.score_documents(docs, partial(quality.text_scores, forest), modulus=4, held_out=2)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return quality.score_documents(docs, model.scores, modulus=3, held_out=1)


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def op11_pivot_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verify(merkle.manifest(merkle.leaves(table(spark, sf_dir, "documents"))))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: v for k, v in globals().items() if k.startswith("op") and callable(v)}


#: Near-duplicates by counting shared shingles of all pairs that share one, and the least id reachable.
NEAR_DUPLICATES_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM words),
shingles AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS k FROM shingles a JOIN shingles b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM shared WHERE 100 * k >= 75 * (na + nb - k)),
reached AS (SELECT doc_id AS a, doc_id AS least FROM documents UNION SELECT l.b, r.least FROM reached r JOIN links l ON r.a = l.a),
component AS (SELECT a AS doc_id, min(least) AS component_id FROM reached GROUP BY a)
SELECT doc_id, len(s)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept FROM sets JOIN component USING (doc_id)"""

#: Text of pages that mark their article and hold only paragraphs and headings in it, as those of the test tables do.
PAGE_TEXT_SQL = r"""
WITH marked AS (SELECT page_id, url, regexp_extract(coalesce(html, ''), '<article>(.*?)</article>', 1, 's') AS article FROM pages),
blocks AS (SELECT page_id, url, list_transform(regexp_split_to_array(replace(article, '<br>', ' '), '</?(?:p|h1)>'), lambda b: regexp_replace(b, '<[^>]+>', '', 'g')) AS b FROM marked),
plain AS (SELECT page_id, url, list_filter(list_transform(b, lambda x: trim(regexp_replace(replace(replace(replace(replace(replace(x, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#x27;', chr(39)), '&amp;', '&'), '\s+', ' ', 'g'))), lambda x: x <> '') AS b FROM blocks),
joined AS (SELECT page_id, url, coalesce(array_to_string(b, chr(10)), '') AS text FROM plain)
SELECT *, length(text)::BIGINT AS n_chars FROM joined"""

#: The highest inner products by computing all of them.
TOP_K_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM pairs)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10"""

#: Leaves, all levels of both trees, and each leaf's walk up with its own and with the tampered digest.
MERKLE_SQL = r"""
WITH RECURSIVE fields AS (
  SELECT doc_id, source, concat(
    coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-'), coalesce(strlen(source) || ':' || source, '-'), coalesce(strlen(lang) || ':' || lang, '-'),
    coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-')) AS head, text,
    xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
      lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END)), 4294967295::BIGINT) AS crc FROM documents),
leaves AS (
  SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    CASE WHEN crc % 2 = 0 THEN sha256(head || coalesce(strlen(replace(text, chr(10), '')) || ':' || replace(text, chr(10), ''), '-')) END AS tampered FROM fields),
placed AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY source) AS n FROM leaves),
tree AS (
  SELECT source, 0 AS level, pos, n, leaf AS d FROM placed
  UNION ALL
  SELECT source, level + 1, pos // 3, (any_value(n) + 2) // 3, sha256(string_agg(d, '' ORDER BY pos)) FROM tree WHERE n > 1 GROUP BY source, level, pos // 3),
subroots AS (SELECT source, d AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM tree WHERE n = 1),
top AS (
  SELECT 0 AS level, pos, n, subroot AS d FROM subroots
  UNION ALL
  SELECT level + 1, pos // 3, (any_value(n) + 2) // 3, sha256(string_agg(d, '' ORDER BY pos)) FROM top WHERE n > 1 GROUP BY level, pos // 3),
runs AS (SELECT source, level, pos // 3 AS run, list(d ORDER BY pos) AS ds FROM tree WHERE n > 1 GROUP BY ALL),
tops AS (SELECT level, pos // 3 AS run, list(d ORDER BY pos) AS ds FROM top WHERE n > 1 GROUP BY ALL),
walk AS (
  SELECT source, pos AS start, 0 AS level, pos, coalesce(tampered, leaf) AS d, '' AS proof FROM placed
  UNION ALL
  SELECT w.source, w.start, w.level + 1, w.pos // 3,
    sha256(array_to_string(list_concat(r.ds[:w.pos % 3], [w.d], r.ds[w.pos % 3 + 2:]), '')), w.proof || array_to_string(list_concat(r.ds[:w.pos % 3], r.ds[w.pos % 3 + 2:]), '')
  FROM walk w JOIN runs r ON w.source IS NOT DISTINCT FROM r.source AND w.level = r.level AND w.pos // 3 = r.run),
ended AS (SELECT source, start, arg_max(d, level) AS d, arg_max(proof, level) AS proof FROM walk GROUP BY source, start),
climb AS (
  SELECT e.source, e.start, 0 AS level, s.pos, e.d, e.proof FROM ended e JOIN subroots s ON e.source IS NOT DISTINCT FROM s.source
  UNION ALL
  SELECT w.source, w.start, w.level + 1, w.pos // 3,
    sha256(array_to_string(list_concat(r.ds[:w.pos % 3], [w.d], r.ds[w.pos % 3 + 2:]), '')), w.proof || array_to_string(list_concat(r.ds[:w.pos % 3], r.ds[w.pos % 3 + 2:]), '')
  FROM climb w JOIN tops r ON w.level = r.level AND w.pos // 3 = r.run),
done AS (SELECT source, start, arg_max(d, level) AS folded, arg_max(proof, level) AS proof FROM climb GROUP BY source, start)
SELECT p.doc_id, p.leaf, s.subroot, t.d AS root, sha256(x.proof) AS proof_sha256, x.folded AS folded_root, x.folded = t.d AS verified
FROM placed p JOIN done x ON p.source IS NOT DISTINCT FROM x.source AND p.pos = x.start JOIN subroots s ON p.source IS NOT DISTINCT FROM s.source
JOIN (SELECT d FROM top WHERE n = 1) t ON true"""

#: Divergences of all pairs of sources by all kept terms of their language, in 128-bit integers.
DIVERGENCE_SQL = r"""
WITH words AS (
  SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
seen AS (SELECT doc, lang, source, t, count(*)::HUGEINT AS n FROM (SELECT doc, lang, source, unnest(w) AS t FROM words) GROUP BY ALL),
kept AS (SELECT lang, t, sum(n)::HUGEINT AS n FROM seen GROUP BY lang, t HAVING count(*) >= 3),
langs AS (SELECT lang, count(*)::HUGEINT AS v, sum(n)::HUGEINT AS total FROM kept GROUP BY lang),
per AS (SELECT lang, source, t, sum(s.n)::HUGEINT AS n FROM seen s JOIN kept k USING (lang, t) GROUP BY ALL),
groups AS (
  SELECT g.lang, g.source, coalesce(sum(p.n), 0)::HUGEINT AS total FROM (SELECT DISTINCT lang, source FROM words) g LEFT JOIN per p USING (lang, source) GROUP BY ALL),
dense AS (
  SELECT g.lang, g.source, k.t, coalesce(p.n, 0) AS n, 1 + (1000000000 * (coalesce(p.n, 0) + 1)) // (g.total + l.v) AS p, 1 + (1000000000 * (k.n + 1)) // (l.total + l.v) AS q
  FROM groups g JOIN kept k USING (lang) JOIN langs l USING (lang) LEFT JOIN per p ON p.lang = g.lang AND p.source = g.source AND p.t = k.t),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value FROM dense a JOIN dense b ON a.lang = b.lang AND a.t = b.t AND a.source <> b.source GROUP BY ALL),
found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(p.value, 0)::BIGINT AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
  UNION ALL
  SELECT lang, source, 'term', t, ((p - q) * (p - q) // q)::BIGINT FROM dense WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM found)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 200"""


def oracle_sql() -> dict[str, str]:
    return {"op12_source_divergence": DIVERGENCE_SQL, "op13_merkle_manifest": MERKLE_SQL, "op11_pivot_search": TOP_K_SQL, "op5_source_mix": mixing.mix_sql(), "op6_page_text": PAGE_TEXT_SQL, "op10_near_duplicates": NEAR_DUPLICATES_SQL}
