"""Registered queries of the training-data operators, with DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (bpe, exact_dedup, fill_middle, html_text, language_id, licenses, line_dedup, mixing, order_minhash,
                          quality, sharding, warc, whitening)
from tidemark.llm.common import store, table


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = language_id.document_records(table(spark, sf_dir, "documents"))
    return language_id.identify(records).withColumnRenamed("id", "doc_id").withColumn("kept", ~F.col("rejected"))


def language_id_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same over web pages, with the language of the markup and the host's name as evidence."""
    pages = table(spark, sf_dir, "pages")
    # Stored, so that the extraction's Python workers don't stand beside the scorer's, and run once.
    records = store(language_id.page_records(pages, html_text.extract(F.coalesce("html", F.lit("")))), "op1_pages")
    return language_id.identify(records).withColumnRenamed("id", "page_id")


def op2_temperature_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).drop("row_key")


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"),
                           quality.trusted_labels(table(spark, sf_dir, "labels")))


def op4_warc_captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.resolve(warc.archive_and_read(table(spark, sf_dir, "pages")))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(table(spark, sf_dir, "documents"))


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = bpe.round_trip(table(spark, sf_dir, "documents").select("doc_id", "text"),
                          public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return done.select("row.doc_id", (F.octet_length("token_ids") / 4).cast("long").alias("n_tokens"),
                       F.sha2("token_ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op7_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.near_dedup(table(spark, sf_dir, "documents")).drop("text_hash")


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = line_dedup.line_dedup(table(spark, sf_dir, "documents"))
    cleaned = F.coalesce("lines.cleaned", F.lit(""))
    return done.select("row.doc_id", "row.source", "lines.n_lines", "lines.n_removed",
                       F.length(cleaned).cast("long").alias("n_chars_left"),
                       F.sha2(cleaned, 256).alias("cleaned_sha256"))


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_pages(table(spark, sf_dir, "pages"))


def op11_feast_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = fill_middle.fill_in_middle(table(spark, sf_dir, "documents"))
    return done.select("doc_id", F.col("n_units").alias("n"), "form", "prefix_chars", "middle_chars",
                       F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"))


def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = sharding.shard(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                       F.lit(None).cast("int").alias("grown_shard"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": op1_language_id,
    "language_id_pages": language_id_pages,
    "op2_temperature_mixing": op2_temperature_mixing,
    "op3_quality": op3_quality,
    "op4_warc_captures": op4_warc_captures,
    "op5_license_scan": op5_license_scan,
    "op6_byte_bpe": op6_byte_bpe,
    "op7_order_minhash": op7_order_minhash,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_line_dedup": op9_line_dedup,
    "op10_html_text": op10_html_text,
    "op11_feast_whitening": op11_feast_whitening,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_sharding": op13_sharding,
}

ORACLES: dict[str, str] = {
    "op2_temperature_mixing": r"""
        WITH RECURSIVE u AS (
            SELECT doc_id, source, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS n_tokens FROM documents),
        s AS (SELECT source, sum(n_tokens)::BIGINT AS tokens FROM u GROUP BY source HAVING sum(n_tokens) > 0),
        t AS (SELECT sum(tokens)::BIGINT AS total, count(*) AS n FROM s),
        p AS (SELECT source, tokens, ln(tokens / total::DOUBLE) AS lp, total, n FROM s, t),
        b(i, lo_e, hi_e, lo_r, hi_r) AS (
            SELECT 0, 0.0::DOUBLE, 1.0::DOUBLE, 0.0::DOUBLE, 1.0::DOUBLE
            UNION ALL
            SELECT i + 1, CASE WHEN e THEN me ELSE lo_e END, CASE WHEN e THEN hi_e ELSE me END,
                   CASE WHEN r THEN mr ELSE lo_r END, CASE WHEN r THEN hi_r ELSE mr END
            FROM (SELECT i, lo_e, hi_e, lo_r, hi_r, (lo_e + hi_e) / 2 AS me, (lo_r + hi_r) / 2 AS mr,
                         ln(sum(exp(lp * (lo_e + hi_e) / 2))) - (lo_e + hi_e) / 2 * sum(exp(lp * (lo_e + hi_e) / 2) * lp)
                             / sum(exp(lp * (lo_e + hi_e) / 2)) >= 0.995 * ln(any_value(n)) AS e,
                         max(exp(lp * ((lo_r + hi_r) / 2 - 1))) / sum(exp(lp * (lo_r + hi_r) / 2)) > 4.0 AS r
                  FROM b, p WHERE i < 40 GROUP BY i, lo_e, hi_e, lo_r, hi_r)),
        a AS (SELECT round(greatest((lo_e + hi_e) / 2, (lo_r + hi_r) / 2), 6) AS exponent FROM b WHERE i = 40),
        w AS (SELECT source, tokens, total, pow(tokens / total::DOUBLE, exponent) AS power FROM p, a),
        q AS (SELECT source, tokens, total, floor(round(power / (SELECT sum(power) FROM w) * total::DOUBLE, 3))::BIGINT AS quota
              FROM w),
        c AS (SELECT doc_id, u.source, n_tokens, tokens, total, quota, epoch,
                     md5('17|' || epoch || '|' || doc_id) AS key
              FROM u JOIN q USING (source), range(0, 100) r(epoch)
              WHERE quota > 0 AND epoch * tokens < quota),
        d AS (SELECT *, coalesce(sum(n_tokens) OVER (PARTITION BY source, epoch ORDER BY key
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS spent FROM c),
        e AS (SELECT *, ceil(total / 1048576.0)::BIGINT AS n_blocks FROM d WHERE epoch * tokens + spent < quota
                  OR epoch < quota // tokens),
        f AS (SELECT *, least(floor((epoch * tokens + spent)::DOUBLE / quota * n_blocks::DOUBLE)::BIGINT, n_blocks - 1)
                  AS block FROM e)
        SELECT doc_id, source, n_tokens, epoch, block,
               row_number() OVER (PARTITION BY block ORDER BY key, doc_id, epoch) AS rank, quota FROM f
    """,
    "op4_warc_captures": r"""
        WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
        g AS (SELECT h, min(page_id) AS first FROM p WHERE strlen(h) >= 100 GROUP BY h),
        j AS (SELECT p.page_id, p.h, CASE WHEN g.first <> p.page_id THEN g.first END AS refers_to
              FROM p LEFT JOIN g ON p.h = g.h)
        SELECT page_id, strlen(h) AS payload_bytes, sha256(h) AS payload_digest,
               CASE WHEN refers_to IS NULL THEN 'response' ELSE 'revisit' END AS record_type, refers_to FROM j
    """,
    "op8_exact_dedup": r"""
        WITH t AS (
            SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents),
        g AS (SELECT norm, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY norm)
        SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id AS kept, sha256(t.norm) AS text_sha256
        FROM t JOIN g USING (norm)
    """,
    "op9_line_dedup": r"""
        WITH l AS (
            SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line,
                   generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents),
        k AS (SELECT *, trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS key FROM l),
        n AS (SELECT count(*)::DOUBLE AS n FROM documents GROUP BY source),
        t AS (SELECT greatest(3, floor(round(sum(1 - pow(1 - n / (SELECT sum(n) FROM n), 20)) * 0.7, 6))) AS least FROM n),
        b AS (SELECT key, count(DISTINCT source) AS n_sites, min((doc_id, pos)) AS first FROM k
              WHERE key <> '' GROUP BY key HAVING count(DISTINCT source) >= (SELECT least FROM t)),
        m AS (SELECT k.*, b.key IS NOT NULL AND (k.doc_id, k.pos) <> b.first AS gone FROM k LEFT JOIN b ON k.key = b.key),
        d AS (SELECT doc_id, source, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed,
                     coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '') AS cleaned
              FROM m GROUP BY doc_id, source)
        SELECT doc_id, source, n_lines, n_removed, length(cleaned) AS n_chars_left,
               sha256(cleaned) AS cleaned_sha256 FROM d
    """,
    "op12_fill_in_middle": r"""
        WITH t AS (
            SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS units,
                   sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS hex FROM documents),
        h AS (SELECT *, len(units) AS n, ('0x' || hex[1:8])::BIGINT AS h1, ('0x' || hex[9:16])::BIGINT AS h2,
                     ('0x' || hex[17:24])::BIGINT AS h3, ('0x' || hex[25:32])::BIGINT AS h4 FROM t),
        c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
                     CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                               OR h3 % 100 >= 90 THEN 'plain'
                          WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
        p AS (SELECT *, array_to_string(units[1:a], '') AS prefix, array_to_string(units[a + 1:b], '') AS middle,
                     array_to_string(units[b + 1:], '') AS suffix FROM c)
        SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
               CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                           ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
               sha256(text) AS restored_sha256 FROM p
    """,
}
