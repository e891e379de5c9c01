"""Registered queries of the corpus operators, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lagwatch.llm import (
    conversation_repair,
    exact_dedup,
    packing,
    quality_classifier,
    quality_rules,
    sentence_pieces,
    simhash,
    spelling,
    substring_dedup,
    topk,
    toxicity,
    url_filter,
    wordpiece,
)
from lagwatch.llm.common import read_table

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")

URL_RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "labels")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir), WORD_BPE)


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged, _ = quality_rules.judge(documents(spark, sf_dir), labels(spark, sf_dir))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(documents(spark, sf_dir))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(read_table(spark, sf_dir, "pages"), URL_RULES)


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.digests(documents(spark, sf_dir))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(documents(spark, sf_dir))
    return found.select("doc_id", simhash.hex_digits("fp").alias("fingerprint"), "component_id")


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wordpiece.token_counts(documents(spark, sf_dir), PIECE_BPE)


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.judge(documents(spark, sf_dir), labels(spark, sf_dir))


def op9_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentence_pieces.digests(documents(spark, sf_dir), PIECE_BPE)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.judge(documents(spark, sf_dir), labels(spark, sf_dir))


def op11_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(read_table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 100 == 0)


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair(conversation_repair.damage(read_table(spark, sf_dir, "conversations")))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(documents(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_packing, op2_quality_rules, op3_exact_dedup, op4_url_filter, op5_substring_dedup,
        op6_simhash, op7_token_counts, op8_quality_classifier, op9_sentence_pieces, op10_toxicity,
        op11_topk, op12_conversation_repair, op13_spelling,
    )
}


def _quoted(pattern: str) -> str:
    return pattern.replace("'", "''")


def _sql_rule() -> tuple[str, str]:
    rule, verdict = "CASE", "CASE"
    for kind, host, path in url_filter.ordered(URL_RULES):
        fits = f" WHEN ('.' || host) LIKE '%.{host}' AND starts_with(path, '{path}') THEN "
        rule += f"{fits}'{host}{path}'"
        verdict += f"{fits}'{kind}'"
    return f"{rule} END", f"{verdict} END"


EXACT_SQL = r"""
WITH t AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents
)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = min(doc_id) OVER g AS kept, sha256(norm) AS text_sha256
FROM t WINDOW g AS (PARTITION BY norm)
"""

SUBSTRING_SQL = r"""
WITH w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
  FROM documents
),
windows AS (
  SELECT doc_id, i, array_to_string(words[i:i + 49], ' ') AS window_words
  FROM (SELECT doc_id, words, unnest(generate_series(1, len(words) - 49)) AS i FROM w WHERE len(words) >= 50)
),
firsts AS (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY window_words) AS holder FROM windows),
covered AS (
  SELECT doc_id, list(DISTINCT word_at) AS gone
  FROM (SELECT doc_id, unnest(generate_series(i, i + 49)) AS word_at FROM firsts WHERE holder < doc_id)
  GROUP BY doc_id
)
SELECT w.doc_id, len(words)::BIGINT AS n_words, coalesce(len(gone), 0)::BIGINT AS n_removed,
       sha256(coalesce(array_to_string(
         CASE WHEN gone IS NULL THEN words
              ELSE list_filter(words, lambda x, i: NOT list_contains(gone, i)) END, ' '), '')) AS kept_sha256
FROM w LEFT JOIN covered c ON c.doc_id = w.doc_id
"""

RULE, VERDICT = _sql_rule()
URL_SQL = rf"""
WITH RECURSIVE p AS (
  SELECT page_id, html,
         regexp_extract(coalesce(url, ''), '^.*?://', 0) AS head,
         lower(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1)) AS host,
         regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1) AS path,
         regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^#]*)', 1) AS rest
  FROM pages
),
links AS (
  SELECT head, host, rest, unnest([
    regexp_extract(regexp_extract(html, '{_quoted(url_filter.CANONICAL)}', 0), '{_quoted(url_filter.HREF)}', 1),
    regexp_extract(regexp_extract(html, '{_quoted(url_filter.REFRESH)}', 0), '{_quoted(url_filter.TARGET)}', 1)]) AS link
  FROM p WHERE head <> '' AND html IS NOT NULL
),
targets AS (
  SELECT host || rest AS a,
         CASE WHEN contains(link, '://') THEN link WHEN starts_with(link, '//') THEN 'x:' || link
              WHEN starts_with(link, '/') THEN head || host || link END AS t
  FROM links WHERE link <> ''
),
edges AS (
  SELECT a, lower(regexp_extract(t, '^.*?://([^/?#]*)', 1)) || regexp_extract(t, '^.*?://[^/?#]*([^#]*)', 1) AS b
  FROM targets WHERE t IS NOT NULL
),
both_ways AS (SELECT a, b FROM edges WHERE a <> b UNION SELECT b, a FROM edges WHERE a <> b),
reach AS (
  SELECT a AS node, b AS other FROM both_ways
  UNION SELECT r.node, e.b FROM reach r JOIN both_ways e ON e.a = r.other
),
other AS (
  SELECT node, regexp_extract(other, '^[^/?#]*', 0) AS host, regexp_extract(other, '^[^/?#]*([^?#]*)', 1) AS path FROM reach
),
spread AS (
  SELECT node, bool_or(v = 'block') AND NOT bool_or(v = 'allow') AS blocked
  FROM (SELECT node, coalesce({VERDICT}, '') AS v FROM other) GROUP BY node
)
SELECT page_id, host, path, {RULE} AS rule,
       coalesce({VERDICT}, CASE WHEN s.blocked THEN 'block' END, 'allow') AS verdict
FROM p LEFT JOIN spread s ON s.node = p.host || p.rest
"""

TOP_K_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id AND len(c.e) = len(q.e)
)
SELECT query_id, CAST(r AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM scored)
WHERE r <= 10
"""

ORACLE_SQL: dict[str, str] = {
    "op3_exact_dedup": EXACT_SQL,
    "op4_url_filter": URL_SQL,
    "op5_substring_dedup": SUBSTRING_SQL,
    "op11_topk": TOP_K_SQL,
}
