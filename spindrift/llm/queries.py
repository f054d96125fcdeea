"""The operators applied to their whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from spindrift.llm import (
    divergence, fertility, language, main_text, mixing, neighbours, packing, passages, prefix_tree, quality, simhash,
    suffix_dedup, warc,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {
    "op3_warc": """
        WITH p AS (SELECT page_id, url, coalesce(html, '') AS html FROM pages),
        d AS (SELECT page_id, url, CAST(strlen(html) AS BIGINT) AS payload_bytes, sha256(html) AS payload_digest FROM p),
        f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM d)
        SELECT page_id, url, payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to
        FROM f""",
    "op4_suffix_dedup": """
        WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS body FROM documents),
        sized AS (SELECT *, octet_length(body) AS n FROM d),
        windows AS (
            SELECT doc_id, pos, array_slice(body, pos + 1, pos + 100) AS gram
            FROM (SELECT doc_id, body, unnest(range(0, greatest(n - 99, 0))) AS pos FROM sized)),
        placed AS (SELECT doc_id, pos, row_number() OVER (PARTITION BY gram ORDER BY doc_id, pos) AS nth FROM windows),
        later AS (
            SELECT doc_id, pos, pos > lag(pos) OVER (PARTITION BY doc_id ORDER BY pos) + 100 AS apart
            FROM placed WHERE nth > 1),
        runs AS (
            SELECT doc_id, pos, count(*) FILTER (WHERE apart) OVER (PARTITION BY doc_id ORDER BY pos) AS run FROM later),
        spans AS (SELECT doc_id, min(pos) AS first, max(pos) + 100 AS past FROM runs GROUP BY doc_id, run),
        edges AS (SELECT doc_id, 0 AS first, 0 AS past FROM d UNION ALL SELECT doc_id, first, past FROM spans),
        kept AS (
            SELECT doc_id, past AS start, past - first AS removed,
                   lead(first) OVER (PARTITION BY doc_id ORDER BY past) AS stop FROM edges)
        SELECT doc_id, CAST(any_value(n) AS BIGINT) AS n_bytes, CAST(sum(removed) AS BIGINT) AS n_removed,
               count(*) FILTER (WHERE removed > 0) AS n_spans,
               sha256(unhex(string_agg(hex(array_slice(body, start + 1, coalesce(stop, n))), '' ORDER BY start)))
                   AS kept_sha256
        FROM kept JOIN sized USING (doc_id) GROUP BY doc_id""",
    "op12_divergence": r"""
        WITH d AS (
            SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS row,
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
            FROM documents),
        w AS (
            SELECT lang, source, row, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term
            FROM d),
        c AS (SELECT lang, source, term, count(*) AS n, count(DISTINCT row) AS docs FROM w GROUP BY ALL),
        v AS (SELECT lang, term, sum(n) AS lang_n FROM c GROUP BY ALL HAVING sum(docs) >= 10),
        g AS (SELECT DISTINCT lang, source FROM d),
        counted AS (
            SELECT lang, source, term, coalesce(n, 0) AS n, lang_n
            FROM g JOIN v USING (lang) LEFT JOIN c USING (lang, source, term)),
        sized AS (
            SELECT *, sum(n) OVER own AS total, sum(lang_n) OVER own AS lang_total, count(*) OVER own AS terms
            FROM counted WINDOW own AS (PARTITION BY lang, source)),
        p AS (
            SELECT lang, source, term, n,
                   1 + CAST(1000000000 * CAST(n + 2 AS HUGEINT) // (total + 2 * terms) AS BIGINT) AS p,
                   1 + CAST(1000000000 * CAST(lang_n + 2 AS HUGEINT) // (lang_total + 2 * terms) AS BIGINT) AS q
            FROM sized),
        sums AS (
            SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
            FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
        pairs AS (
            SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
            FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
            LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
        terms AS (
            SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // (p + q) AS value
            FROM p WHERE n > 0 AND p > q),
        ranked AS (
            SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
            FROM (FROM pairs UNION ALL FROM terms))
        SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
        FROM ranked WHERE part = 'pair' OR rank <= 10""",
    "op13_prefix_trie": prefix_tree.SQL,
}


def _query(build):
    QUERIES[build.__name__] = build
    return build


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@_query
def op1_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(_table(spark, folder, "documents"))


@_query
def op2_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, folder, "documents"))


@_query
def op3_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.archived(_table(spark, folder, "pages"))


@_query
def op4_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.digest(_table(spark, folder, "documents"))


@_query
def op5_hilbert_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.nearest(_table(spark, folder, "embeddings"), F.col("id") % 20 == 0)


@_query
def op6_chained_passages(spark: SparkSession, folder: str) -> DataFrame:
    return passages.shared_passages(_table(spark, folder, "documents"))


@_query
def op7_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(_table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@_query
def op8_language(spark: SparkSession, folder: str) -> DataFrame:
    documents = _table(spark, folder, "documents")
    return language.identify(documents, language.learn(documents.where(~language.held_out("doc_id"))))


@_query
def op9_fertility_rules(spark: SparkSession, folder: str) -> DataFrame:
    return fertility.judge(_table(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@_query
def op10_quality(spark: SparkSession, folder: str) -> DataFrame:
    documents, labels = _table(spark, folder, "documents"), _table(spark, folder, "labels")
    return quality.score(documents, quality.learn(documents, labels.where(~language.held_out("doc_id"))))


@_query
def op11_line_blocks(spark: SparkSession, folder: str) -> DataFrame:
    return main_text.extract(_table(spark, folder, "pages"))


@_query
def op12_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.audit(_table(spark, folder, "documents"))


@_query
def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_tree.rollup(_table(spark, folder, "conversations"))
