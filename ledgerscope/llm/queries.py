"""Registered queries of the document operators, one per operator, over whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerscope.llm import alignment, decontam, exact_dedup, langid, line_dedup, lm, merkle, pieces, pii, sharding, simhash, token_counts, toxicity
from ledgerscope.llm.common import table
from ledgerscope.session import shared_dir


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts.count_tokens(table(spark, sf_dir, "documents"))
    return counts.withColumn("over_limit", F.col("n_tokens") > 4096)


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.identify(docs, langid.learn(docs))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_texts(table(spark, sf_dir, "documents"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(table(spark, sf_dir, "documents"))


def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_personal_data(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2(F.col("base_spans"), 256).alias("base_sha256"), "spans"
    )


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digests(pieces.round_trip(table(spark, sf_dir, "documents")))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.score_texts(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_dir(spark, f"shards-{uuid.uuid4().hex}")
    return sharding.shard_rows(sharding.write_shards(table(spark, sf_dir, "documents"), folder))


def op12_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verify_rows(table(spark, sf_dir, "documents"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_corpus(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    every = (
        op1_simhash,
        op2_token_counts,
        op3_language_id,
        op4_decontamination,
        op5_lm_scoring,
        op6_line_dedup,
        op7_personal_data,
        op8_exact_dedup,
        op9_sentencepiece,
        op10_toxicity,
        op11_sharding,
        op12_manifest,
        op13_alignment,
    )
    return {f.__name__: f for f in every}


def oracle_sql() -> dict[str, str]:
    return {"op8_exact_dedup": EXACT_DEDUP_SQL, "op12_manifest": MANIFEST_SQL}


EXACT_DEDUP_SQL = """
WITH d AS (
    SELECT doc_id, coalesce(text, '') AS t,
           regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g') AS norm
    FROM documents
), r AS (
    SELECT doc_id, norm,
           first_value(doc_id) OVER w AS keep_id,
           count(*) OVER (PARTITION BY norm) AS group_size,
           row_number() OVER w AS place
    FROM d WINDOW w AS (PARTITION BY norm ORDER BY length(t) DESC, doc_id NULLS LAST)
)
SELECT doc_id, keep_id, group_size, place = 1 AS kept, sha256(norm) AS text_sha256 FROM r
"""

MANIFEST_SQL = """
WITH RECURSIVE said AS (
    SELECT doc_id, lang,
           coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
           || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head,
           coalesce(strlen(text) || ':' || text, '-') AS body,
           coalesce(strlen(text) || ':' || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-') AS lower_body,
           list_transform(range(1, length(doc_id::VARCHAR) + 1), lambda i: ascii((doc_id::VARCHAR)[i])::UBIGINT) AS codes
    FROM documents
), crc AS (
    SELECT *, xor(4294967295::UBIGINT, list_reduce(codes, lambda c, b: list_reduce(CAST(range(8) AS UBIGINT[]), lambda v, _: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384::UBIGINT) ELSE v >> 1 END, xor(c, b)), 4294967295::UBIGINT)) AS crc
    FROM said
), leaves AS (
    SELECT doc_id, lang, sha256(head || body) AS leaf,
           sha256(head || CASE WHEN crc % 3 = 0 THEN lower_body ELSE body END) AS claimed,
           row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS place,
           count(*) OVER (PARTITION BY lang) AS n
    FROM crc
), nodes(lang, level, place, n, digest) AS (
    SELECT lang, 0, place, n, leaf FROM leaves
    UNION ALL
    SELECT lang, level + 1, place // 8, (n + 7) // 8, sha256(string_agg(digest, '' ORDER BY place))
    FROM nodes WHERE n > 1 GROUP BY lang, level, n, place // 8
), subroots AS (
    SELECT lang, digest, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place, count(*) OVER () AS n FROM nodes WHERE n = 1
), upper(level, place, n, digest) AS (
    SELECT 0, place, n, digest FROM subroots
    UNION ALL
    SELECT level + 1, place // 8, (n + 7) // 8, sha256(string_agg(digest, '' ORDER BY place))
    FROM upper WHERE n > 1 GROUP BY level, n, place // 8
), steps AS (
    SELECT lang, false AS top, level, place, digest, n FROM nodes UNION ALL SELECT NULL, true, level, place, digest, n FROM upper
), siblings AS (
    SELECT lang, top, level, place,
           coalesce(string_agg(digest, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
           coalesce(string_agg(digest, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
    FROM steps WHERE n > 1 WINDOW w AS (PARTITION BY lang, top, level, place // 8 ORDER BY place)
), walk(doc_id, lang, level, place, digest, proof) AS (
    SELECT doc_id, lang, 0, place, claimed, '' FROM leaves
    UNION ALL
    SELECT w.doc_id, w.lang, w.level + 1, w.place // 8, sha256(s.l || w.digest || s.r), w.proof || s.l || s.r
    FROM walk w JOIN siblings s ON NOT s.top AND s.lang IS NOT DISTINCT FROM w.lang AND s.level = w.level AND s.place = w.place
), inner_walk AS (
    SELECT doc_id, lang, arg_max(digest, level) AS digest, arg_max(proof, level) AS proof FROM walk GROUP BY doc_id, lang
), outer_walk(doc_id, lang, level, place, digest, proof) AS (
    SELECT w.doc_id, w.lang, 0, t.place, w.digest, w.proof FROM inner_walk w JOIN subroots t ON t.lang IS NOT DISTINCT FROM w.lang
    UNION ALL
    SELECT w.doc_id, w.lang, w.level + 1, w.place // 8, sha256(s.l || w.digest || s.r), w.proof || s.l || s.r
    FROM outer_walk w JOIN siblings s ON s.top AND s.level = w.level AND s.place = w.place
), folded AS (
    SELECT doc_id, lang, arg_max(digest, level) AS digest, arg_max(proof, level) AS proof FROM outer_walk GROUP BY doc_id, lang
), root AS (SELECT digest FROM upper WHERE n = 1)
SELECT d.doc_id, d.leaf, t.digest AS subroot, root.digest AS root, sha256(f.proof) AS proof_sha256, f.digest AS folded_root,
       f.digest = root.digest AS verified
FROM leaves d JOIN folded f ON f.doc_id = d.doc_id AND f.lang IS NOT DISTINCT FROM d.lang
JOIN subroots t ON t.lang IS NOT DISTINCT FROM d.lang CROSS JOIN root
"""
