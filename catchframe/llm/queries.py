"""One registered query per operator, over its whole table, and SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catchframe.llm import (
    bpe, dialogs, langid, lm, merkle, mixing, pii, quality, simhash, topk, toxicity, urlfilter, warc,
)
from catchframe.llm.common import table
from catchframe.llm.statements import DIALOG_SQL, MERKLE_SQL, URL_SQL

RANKS = "byte_bpe_50k.tiktoken"
PIECES = "piece_bpe_32k.model"


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(spark, table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"), pii.session_key(spark))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(table(spark, sf_dir, "documents"))


def op4_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, vectors.where("vec_id % 20 = 0"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.verdicts_of(table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.predict_held_out(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.predict_held_out(table(spark, sf_dir, "documents"))


def op9_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECES))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents").select("doc_id", "text"), public_tokenizers.path(RANKS))


def op11_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.tamper_report(table(spark, sf_dir, "documents"))


def op13_dialogs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dialogs.repair_report(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc": op1_warc,
    "op2_pii": op2_pii,
    "op3_mixing": op3_mixing,
    "op4_topk": op4_topk,
    "op5_simhash": op5_simhash,
    "op6_quality": op6_quality,
    "op7_toxicity": op7_toxicity,
    "op8_language": op8_language,
    "op9_lattice": op9_lattice,
    "op10_bpe": op10_bpe,
    "op11_urls": op11_urls,
    "op12_merkle": op12_merkle,
    "op13_dialogs": op13_dialogs,
}

# Five hex digits are twenty bits, which are four characters of base 32.
WARC_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, strlen(h) AS payload_bytes, sha1(h) AS x, min(page_id) OVER (PARTITION BY h) AS least FROM p)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    (((('0x' || substr(x, ((i // 4) * 5 + 1)::INT, 5))::INT >> (15 - 5 * (i % 4))::INT) & 31) + 1)::INT, 1)), '') AS payload_digest,
  CASE WHEN least = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN least <> page_id THEN least END AS refers_to
FROM d
"""

TOPK_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS q FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS query_id, b.vec_id AS vec_id, list_inner_product(a.q, b.q)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM s)
SELECT query_id, place::INTEGER AS rank, vec_id, score FROM r WHERE place <= 20
"""

QUALITY_SQL = r"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, source, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words FROM d),
u AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM w),
g AS (SELECT doc_id, i, [word, lead(word, 1) OVER o, lead(word, 2) OVER o] AS g, lead(i, 2) OVER o AS last FROM u
  WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
f AS (SELECT doc_id, i, last IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, g, last IS NULL) > 1 AS hit FROM g),
c AS (SELECT doc_id, bool_or(hit) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS covered FROM f),
n AS (SELECT doc_id, count_if(covered)::BIGINT AS n_repeat_words FROM c GROUP BY doc_id),
l AS (SELECT doc_id, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
b AS (SELECT w.doc_id, source, len(words)::BIGINT AS n_words,
  coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
  length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
  (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
  coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM w JOIN l USING (doc_id) LEFT JOIN n USING (doc_id)),
j AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM b),
r AS (SELECT source, unnest(['few_words', 'repetition', 'symbols', 'repeated_lines']) AS rule, unnest([n_words < 50,
  100 * n_repeat_words > 50 * n_words, n_symbols * 10 > n_words, n_dup_lines * 20 > n_words]) AS hit FROM j),
h AS (SELECT source, rule, count(*)::DOUBLE AS docs, count_if(hit)::DOUBLE AS failed FROM r GROUP BY source, rule),
m AS (SELECT rule, avg(failed / docs) AS m, greatest(var_pop(failed / docs) - avg(failed / docs) * (1 - avg(failed / docs)) * avg(1 / docs), 1e-6) AS v FROM h GROUP BY rule),
z AS (SELECT rule, m, least(greatest(m * (1 - m) / v - 1, 1.0), 1e4) AS size FROM m),
q AS (SELECT source, m, docs + size AS size, (failed + m * size) / (docs + size) AS rate FROM h JOIN z USING (rule)),
k AS (SELECT source, bool_and(rate - 2.326 * sqrt(rate * (1 - rate) / (size + 1)) <= greatest(0.5, 2 * m)) AS ok FROM q GROUP BY source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND ok AS kept
FROM j JOIN k ON j.source IS NOT DISTINCT FROM k.source
"""

# Keyed draws, fingerprints by XXH64, pair merging and trained models have no SQL form:
# the tests hold those queries against brute force, a library, round trips or held-out labels.
ORACLE: dict[str, str] = {
    "op1_warc": WARC_SQL, "op4_topk": TOPK_SQL, "op6_quality": QUALITY_SQL,
    "op11_urls": URL_SQL, "op12_merkle": MERKLE_SQL, "op13_dialogs": DIALOG_SQL,
}
