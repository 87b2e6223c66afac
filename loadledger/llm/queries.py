"""The registered queries of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from loadledger.llm import (
    ann,
    bpe,
    exact_dedup,
    filter_audit,
    near_dedup,
    order_minhash,
    packing,
    pii,
    quality,
    ranked_search,
    secret_scan,
    url_filter,
    warc,
)
from loadledger.llm.tables import table

TOKENIZER = "byte_bpe_50k.json"


# The rules that every page is judged by, as (verdict, host, path).
PREFIX_RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)


def op1_warc_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived_pages(spark, table(spark, sf_dir, "pages"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return packing.pack_documents(docs, public_tokenizers.path(TOKENIZER))


def op3_quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_minhash_near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dedup.near_copies(table(spark, sf_dir, "documents"), length=3, percent=85)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [url_filter.prefix_rule(host, path, verdict) for verdict, host, path in PREFIX_RULES]
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), rules)


def op6_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return bpe.token_digests(docs, public_tokenizers.path(TOKENIZER))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return secret_scan.find_secrets(docs, secret_scan.learn(docs))


def op8_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.fingerprints(table(spark, sf_dir, "documents"))


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pii.find_personal_data(docs, pii.learn(docs))


def op10_multiprobe_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(
        spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit_documents(
        spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    )


def op13_exact_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_copies(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc_bundles": op1_warc_bundles,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_quality_scores": op3_quality_scores,
    "op4_minhash_near_copies": op4_minhash_near_copies,
    "op5_url_filter": op5_url_filter,
    "op6_bpe_round_trip": op6_bpe_round_trip,
    "op7_secret_scan": op7_secret_scan,
    "op8_order_minhash": op8_order_minhash,
    "op9_personal_data": op9_personal_data,
    "op10_multiprobe_neighbours": op10_multiprobe_neighbours,
    "op11_ranked_search": op11_ranked_search,
    "op12_filter_audit": op12_filter_audit,
    "op13_exact_copies": op13_exact_copies,
}

_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

ORACLE_SQL: dict[str, str] = {
    "op1_warc_bundles": f"""
        WITH p AS (
            SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages
        ), g AS (
            SELECT *, min(page_id) OVER (PARTITION BY html) AS first_id FROM p
        )
        SELECT page_id,
               CAST(strlen(html) AS BIGINT) AS payload_bytes,
               array_to_string(list_transform(range(32), lambda n: substr('{_BASE32}',
                   1 + ((CAST('0x' || substr(hex, 1 + 5 * CAST(floor(n / 4) AS INT), 5) AS BIGINT)
                         >> (5 * (3 - CAST(n % 4 AS INT)))) & 31), 1)), '') AS payload_digest,
               CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> first_id THEN first_id END AS refers_to
        FROM g""",
    "op5_url_filter": r"""
        WITH u AS (
            SELECT page_id, CASE WHEN strpos(url, '://') > 0
                       THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
        ), h AS (
            SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM u
        ), s AS (
            SELECT page_id,
                   translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM h
        ), r AS (
            SELECT *, '.' || host AS d, CASE
                WHEN ('.' || host) LIKE '%.www.example.com' AND starts_with(path, '/en/') THEN 'www.example.com/en/'
                WHEN ('.' || host) LIKE '%.example.com' AND starts_with(path, '/en/') THEN 'example.com/en/'
                WHEN ('.' || host) LIKE '%.net' AND starts_with(path, '/es/') THEN 'net/es/'
                WHEN ('.' || host) LIKE '%.net' AND starts_with(path, '/fr/') THEN 'net/fr/'
                WHEN ('.' || host) LIKE '%.com' AND starts_with(path, '/') THEN 'com/' END AS rule FROM s
        )
        SELECT page_id, host, path, rule, CASE
            WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow'
            WHEN rule IS NOT NULL THEN 'block'
            WHEN contains(d, '.ads.') THEN 'block'
            WHEN contains(path, '/login/') OR contains(path, '/tracking/') THEN 'block'
            ELSE 'allow' END AS verdict FROM r""",
    "op11_ranked_search": r"""
        WITH d AS (
            SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
                       translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents
        ), i AS (
            SELECT DISTINCT item_id, unnest(regexp_extract_all(
                       translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
        ), c AS (
            SELECT CAST(count(*) AS BIGINT) AS nn, CAST(sum(len(terms)) AS BIGINT) AS ll FROM d WHERE len(terms) > 0
        ), t AS (
            SELECT r, doc_id, CAST(len(terms) AS BIGINT) AS n, unnest(terms) AS term FROM d
        ), p AS (
            SELECT r, doc_id, n, term, count(*) AS tf FROM t
            WHERE term IN (SELECT term FROM i) GROUP BY r, doc_id, n, term
        ), w AS (
            SELECT term, CAST(floor(1000 * ln((2.0::DOUBLE * nn + 2) / (2.0::DOUBLE * count(*) + 1))) AS BIGINT) AS w
            FROM p, c GROUP BY term, nn
        ), s AS (
            SELECT item_id, r, doc_id, CAST(sum(w * ((1000000000 * tf)
                       // (1000 * tf + 8 * (10 + (90 * n * nn) // ll)))) AS BIGINT) AS score
            FROM i JOIN p USING (term) JOIN w USING (term), c GROUP BY item_id, r, doc_id
        ), k AS (
            SELECT item_id, CAST(row_number() OVER (
                       PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INT) AS rank, doc_id, score
            FROM s WHERE score > 0
        )
        SELECT item_id, rank, doc_id, score FROM k WHERE rank <= 10""",
    "op12_filter_audit": r"""
        WITH RECURSIVE letters AS (
            SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f
        ), orders AS (
            SELECT f AS o FROM letters
            UNION ALL
            SELECT o || f FROM orders, letters WHERE strpos(o, f) = 0
        ), d AS (
            SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents
        ), w AS (
            SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
                   min(doc_id) OVER (PARTITION BY text) AS first_id FROM d
        ), l AS (
            SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id
        ), t AS (
            SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
                   concat(CASE WHEN len(words) < 200 THEN 'A' END,
                          CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 'B' END,
                          CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text) THEN 'C' END,
                          CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' END,
                          CASE WHEN first_id < w.doc_id THEN 'E' END) AS failed
            FROM w LEFT JOIN l ON l.doc_id = w.doc_id
        ), g AS (
            SELECT part, failed, count(*) AS n, count(*) FILTER (WHERE good) AS good,
                   count(*) FILTER (WHERE toxic) AS toxic FROM t GROUP BY part, failed
        ), s AS (
            SELECT o AS filter_order, i AS step, o[i:i] AS f, o[1:i-1] AS before
            FROM orders, range(1, 6) r(i) WHERE length(o) = 5
        ), j AS (
            SELECT part, filter_order, CAST(step AS INT) AS step, f, failed, n, good, toxic,
                   contains(failed, f) AS fails,
                   before <> '' AND failed <> '' AND regexp_matches(failed, '[' || before || '_]') AS gone
            FROM g, s
        ), r AS (
            SELECT part, filter_order, step, f,
                   CAST(coalesce(sum(n) FILTER (WHERE NOT fails AND NOT gone), 0) AS BIGINT) AS kept,
                   CAST(coalesce(sum(n) FILTER (WHERE fails AND NOT gone), 0) AS BIGINT) AS removed,
                   CAST(coalesce(sum(n) FILTER (WHERE fails AND gone), 0) AS BIGINT) AS redundant,
                   CAST(coalesce(sum(n) FILTER (WHERE failed = f), 0) AS BIGINT) AS unique_fails,
                   CAST(coalesce(sum(good) FILTER (WHERE fails AND NOT gone), 0) AS BIGINT) AS good_lost,
                   CAST(coalesce(sum(toxic) FILTER (WHERE fails AND NOT gone), 0) AS BIGINT) AS toxic_lost
            FROM j GROUP BY part, filter_order, step, f
        )
        SELECT * EXCLUDE (f), CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley FROM r""",
    "op13_exact_copies": """
        WITH d AS (
            SELECT doc_id, coalesce(text, '') AS text FROM documents
        ), g AS (
            SELECT *, max(doc_id) OVER (PARTITION BY text) AS keep_id, count(*) OVER (PARTITION BY text) AS n FROM d
        )
        SELECT doc_id, keep_id, CAST(n AS BIGINT) AS group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept,
               sha256(text) AS text_sha256
        FROM g""",
}
