"""The queries of the corpus operators: each applies one operator to its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .bpe import encode_documents
from .common import documents
from .exact_dedup import exact_dedup
from .filter_audit import audit_filters
from .fingerprints import align_recordings, fingerprint_media
from .langid import identify_languages
from .licenses import scan_licenses
from .lm import score_documents
from .minhash import near_components
from .packing import pack
from .spelling import spelling_variants
from .suffix_dedup import suffix_dedup
from .token_counts import prefix_counts, token_counts
from .toxicity import score_toxicity


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(documents(spark, sf_dir))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(documents(spark, sf_dir))


def op3_chroma_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tables hold no audio: each document's bytes are taken as 8-bit mono samples, so copies are equal recordings."""
    media = documents(spark, sf_dir).selectExpr("doc_id", "cast(text as binary) as content")
    return align_recordings(fingerprint_media(media, "doc_id")).withColumnsRenamed({"media_id": "doc_id"})


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(documents(spark, sf_dir))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_languages(documents(spark, sf_dir))


def op6_deleted_interpolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(documents(spark, sf_dir))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(documents(spark, sf_dir))


def op9_minhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_components(documents(spark, sf_dir), percent=85)


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_filters(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(documents(spark, sf_dir))


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(prefix_counts(documents(spark, sf_dir)), limit=2048)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_exact_dedup, op2_suffix_dedup, op3_chroma_fingerprints, op4_byte_bpe, op5_language_id, op6_deleted_interpolation,
        op7_toxicity, op8_license_scan, op9_minhash_components, op10_best_fit_packing, op11_filter_audit, op12_spelling_variants,
        op13_token_counts,
    )
}

#: Only where SQL can express the whole result.
ORACLE_SQL: dict[str, str] = {
    "op1_exact_dedup": r"""
        WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents),
             g AS (SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY 1)
        SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id IS NOT DISTINCT FROM g.keep_id AS kept, d.text_sha256 FROM d JOIN g USING (text_sha256)
    """,
    "op11_filter_audit": r"""
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t, coalesce(lang, '') AS part FROM documents),
             w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words, min(doc_id) OVER (PARTITION BY t) AS first FROM d),
             f AS (SELECT part, doc_id,
                          CASE WHEN len(words) < 100 THEN 'A' ELSE '' END
                          || CASE WHEN 100 * len(list_distinct(words)) < 80 * len(words) THEN 'B' ELSE '' END
                          || CASE WHEN 100 * len(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * len(t) THEN 'C' ELSE '' END
                          || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
                          || CASE WHEN first < doc_id THEN 'E' ELSE '' END AS fails FROM w),
             m AS (SELECT part, fails, count(*) AS n, count(*) FILTER (doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)) AS good,
                          count(*) FILTER (doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1)) AS toxic FROM f GROUP BY 1, 2),
             l(x) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
             o AS (SELECT a.x || b.x || c.x || e.x || g.x AS filter_order FROM l a, l b, l c, l e, l g
                   WHERE len(list_distinct([a.x, b.x, c.x, e.x, g.x])) = 5),
             s AS (SELECT m.*, filter_order, step, filter_order[step] AS letter, contains(fails, filter_order[step]) AS now,
                          len(translate(filter_order[1:step - 1], fails, '')) < step - 1 AS earlier
                   FROM m, o, (SELECT unnest(range(1, 6)) AS step)),
             r AS (SELECT part, filter_order, step, letter,
                          coalesce(sum(n) FILTER (NOT now AND NOT earlier), 0) AS kept, coalesce(sum(n) FILTER (now AND NOT earlier), 0) AS removed,
                          coalesce(sum(n) FILTER (now AND earlier), 0) AS redundant, coalesce(sum(n) FILTER (fails = letter), 0) AS unique_fails,
                          coalesce(sum(good) FILTER (now AND NOT earlier), 0) AS good_lost, coalesce(sum(toxic) FILTER (now AND NOT earlier), 0) AS toxic_lost
                   FROM s GROUP BY 1, 2, 3, 4)
        SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
               unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
               (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley FROM r
    """,
}
