"""The corpus operators bound to the test tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.llm import (
    ball_kmeans,
    byte_bpe,
    class_ngrams,
    cover_tree,
    filter_audit,
    license_scan,
    line_dedup,
    packing,
    quality_classifier,
    quality_rules,
    simhash,
    substring_dedup,
    token_files,
)
from tabloom.llm.common import on_workers

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
JSON_NAME, RANKS_NAME = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"


def query(function: Callable[[SparkSession, str], DataFrame]):
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return on_workers(spark).read.parquet(f"{folder}/{name}.parquet")


@query
def op1_token_files(spark: SparkSession, folder: str) -> DataFrame:
    index = token_files.write_tokens(
        table(spark, folder, "documents"),
        public_tokenizers.path(JSON_NAME),
        token_files.shard_folder(spark),
        end_id=2,
    )
    return token_files.read_tokens(index).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )


@query
def op2_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.judge(table(spark, folder, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
        "n_repeat_words", "base_failed", "kept",
    )


@query
def op3_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = quality_classifier.train(docs, table(spark, folder, "labels"))
    return quality_classifier.score(docs, model).select(
        "doc_id",
        quality_classifier.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        "predicted",
    )


@query
def op4_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substring_dedup.remove_repeats(table(spark, folder, "documents")).select(
        F.col("id").alias("doc_id"),
        "n_words",
        "n_removed",
        F.sha2("kept_text", 256).alias("kept_sha256"),
    )


# The base phrases of op5's contract.
LICENCES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}


@query
def op5_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return license_scan.scan(docs, base=LICENCES).drop("places")


@query
def op6_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


@query
def op7_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, folder, "documents")).select(
        F.col("id").alias("doc_id"),
        "n_lines",
        "n_removed",
        F.sha2(F.coalesce("kept_text", F.lit("")), 256).alias("kept_sha256"),
    )


@query
def op8_cover_tree(spark: SparkSession, folder: str) -> DataFrame:
    return cover_tree.near_duplicates(table(spark, folder, "embeddings"))


@query
def op9_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    ranks = public_tokenizers.path(RANKS_NAME)
    encoded = byte_bpe.encode(
        table(spark, folder, "documents"), ranks, public_tokenizers.PATTERN
    )
    return byte_bpe.decode(encoded, ranks).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op10_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(
        table(spark, folder, "documents"), public_tokenizers.path(JSON_NAME), end_id=0
    )


@query
def op11_ball_kmeans(spark: SparkSession, folder: str) -> DataFrame:
    codes, books = ball_kmeans.compress(table(spark, folder, "embeddings"))
    return codes.withColumn("codebooks_sha256", F.lit(books.digest()))


@query
def op12_class_ngrams(spark: SparkSession, folder: str) -> DataFrame:
    return class_ngrams.score(table(spark, folder, "documents"))


@query
def op13_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    return filter_audit.audit(
        table(spark, folder, "documents"), table(spark, folder, "labels")
    )


def _rounds_sql(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """Codebooks by plain assignment of all vectors to all entries, round by round."""
    ctes = [
        """usable AS (
            SELECT row_number() OVER (ORDER BY vec_id, embedding) AS r, vec_id, label,
                list_transform(embedding,
                    lambda x: floor(4096 * x::DOUBLE)::BIGINT) AS v
            FROM embeddings
            WHERE len(embedding) > 0 AND len(list_filter(embedding,
                lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding))""",
        f"""x AS (
            SELECT r, p, v[len(v) * p // {parts} + 1 : len(v) * (p + 1) // {parts}] AS v
            FROM usable, range({parts}) AS t(p))""",
        f"b0 AS (SELECT p, (r - 1)::BIGINT AS e, v FROM x WHERE r <= {entries})",
    ]
    for i in range(rounds + 1):
        ctes.append(
            f"""a{i} AS (
            SELECT r, p, x.v, arg_min(e, d) AS e, min(d) // 256 AS d
            FROM (SELECT x.r, x.p, x.v, b.e, 256 * list_sum(list_transform(
                    list_zip(x.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT
                    + b.e AS d
                  FROM x JOIN b{i} b USING (p)) x
            GROUP BY r, p, x.v)"""
        )
        if i < rounds:
            ctes.append(
                f"""b{i + 1} AS (
            SELECT p, e, coalesce(m, b.v) AS v FROM b{i} b LEFT JOIN (
                SELECT p, e, list(m ORDER BY k) AS m FROM (
                    SELECT p, e, k, (sum(z) - ((sum(z) % count(*)) + count(*)) % count(*))
                        // count(*) AS m
                    FROM (SELECT p, e, unnest(v) AS z, unnest(range(len(v))) AS k
                          FROM a{i}) GROUP BY p, e, k)
                GROUP BY p, e) USING (p, e))"""
            )
    return f"""
        WITH {", ".join(ctes)},
        coded AS (
            SELECT r, string_agg(printf('%02x', e), '' ORDER BY p) AS code,
                sum(d)::BIGINT AS error
            FROM a{rounds} GROUP BY r),
        books AS (
            SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, e)) AS digest
            FROM b{rounds})
        SELECT vec_id, code, error,
            (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
            digest AS codebooks_sha256
        FROM coded JOIN usable USING (r), books"""


# DuckDB twins. The others have none: their hashes, token ids or models are not SQL.
ORACLE_SQL: dict[str, str] = {
    "op2_quality_rules": r"""
        WITH d AS (
            SELECT doc_id, coalesce(text, '') AS t,
                regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
                list_filter(string_split(coalesce(text, ''), chr(10)),
                            lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
            FROM documents),
        windows AS (
            SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
            FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
        covered AS (
            SELECT doc_id, count(DISTINCT i + k) AS n
            FROM (SELECT doc_id, i FROM windows
                  QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1), range(3) AS r(k)
            GROUP BY doc_id),
        m AS (
            SELECT d.doc_id, len(w)::BIGINT AS n_words,
                length(array_to_string(w, ''))::BIGINT AS word_chars,
                length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
                (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
                coalesce(n, 0)::BIGINT AS n_repeat_words,
                len(l) AS n_lines,
                length(regexp_replace(t, '[^A-Z]', '', 'g')) AS upper_case,
                length(regexp_replace(t, '[^A-Za-z]', '', 'g')) AS letters,
                length(regexp_replace(t, '[^!]', '', 'g')) AS marks
            FROM d LEFT JOIN covered USING (doc_id)),
        b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words
                  AS base_failed FROM m)
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
            base_failed,
            NOT (base_failed OR 20 * n_symbols > word_chars OR 2 * upper_case > letters
                 OR 50 * marks > word_chars OR 2 * n_dup_lines > n_lines
                 OR word_chars < 2 * n_words OR word_chars > 20 * n_words) AS kept
        FROM b""",
    "op4_substring_dedup": r"""
        WITH d AS (
            SELECT doc_id,
                regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
            FROM documents),
        words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d),
        windows AS (
            SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS g
            FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d)),
        gone AS (
            SELECT DISTINCT doc_id, i + k AS i
            FROM (SELECT doc_id, i FROM windows
                  QUALIFY min(doc_id) OVER (PARTITION BY g) < doc_id), range(13) AS r(k)),
        kept AS (
            SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS t
            FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
        SELECT doc_id, len(w)::BIGINT AS n_words,
            (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
            sha256(coalesce(t, '')) AS kept_sha256
        FROM d LEFT JOIN kept USING (doc_id)""",
    "op8_cover_tree": r"""
        WITH RECURSIVE usable AS (
            SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
            WHERE label IS NOT NULL AND len(embedding) > 0
              AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
                  = len(embedding)
              AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
        links AS (
            SELECT a.vec_id AS a, b.vec_id AS b
            FROM usable a JOIN usable b ON a.label = b.label AND a.vec_id <> b.vec_id
                AND len(a.v) = len(b.v)
            WHERE list_cosine_similarity(a.v, b.v) >= 0.98),
        reach AS (
            SELECT vec_id, vec_id AS r FROM embeddings
            UNION
            SELECT reach.vec_id, links.b FROM reach JOIN links ON reach.r = links.a),
        least AS (SELECT vec_id, min(r) AS component_id FROM reach GROUP BY vec_id),
        degree AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
        SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id,
            vec_id = component_id AS kept
        FROM least LEFT JOIN degree USING (vec_id)""",
    "op13_filter_audit": r"""
        WITH w AS (
            SELECT doc_id, coalesce(text, '') AS t, coalesce(lang, '') AS part,
                regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
            FROM documents),
        f AS (
            SELECT doc_id, part, [
                len(w) < 200,
                100 * len(list_distinct(w)) < 50 * len(w),
                100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t),
                regexp_matches(t, '[#$%&*|]'),
                doc_id > min(doc_id) OVER (PARTITION BY t)] AS fails
            FROM w),
        d AS (
            SELECT f.*, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic
            FROM f LEFT JOIN (
                SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic
                FROM labels GROUP BY doc_id) l USING (doc_id)),
        n AS (
            SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good,
                count(*) FILTER (toxic) AS toxic
            FROM d GROUP BY ALL),
        letters AS (SELECT unnest(range(1, 6)) AS i),
        orders AS (
            SELECT [a.i, b.i, c.i, e.i, g.i] AS o
            FROM letters a, letters b, letters c, letters e, letters g
            WHERE len(list_distinct([a.i, b.i, c.i, e.i, g.i])) = 5),
        steps AS (SELECT o, unnest(range(1, 6)) AS step FROM orders),
        s AS (
            SELECT part, o, step, n, good, toxic, fails[o[step]] AS own,
                len(list_filter(o[:step - 1], lambda i: fails[i])) > 0 AS earlier,
                len(list_filter(fails, lambda x: x)) AS failed
            FROM n, steps),
        r AS (
            SELECT part, o, step,
                sum(CASE WHEN NOT own AND NOT earlier THEN n ELSE 0 END) AS kept,
                sum(CASE WHEN own AND NOT earlier THEN n ELSE 0 END) AS removed,
                sum(CASE WHEN own AND earlier THEN n ELSE 0 END) AS redundant,
                sum(CASE WHEN own AND failed = 1 THEN n ELSE 0 END) AS unique_fails,
                sum(CASE WHEN own AND NOT earlier THEN good ELSE 0 END) AS good_lost,
                sum(CASE WHEN own AND NOT earlier THEN toxic ELSE 0 END) AS toxic_lost
            FROM s GROUP BY part, o, step)
        SELECT part,
            array_to_string(list_transform(o, lambda i: 'ABCDE'[i]), '') AS filter_order,
            step::INTEGER AS step, kept::BIGINT AS kept, removed::BIGINT AS removed,
            redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails,
            good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
            (sum(removed) OVER (PARTITION BY part, o[step]))::BIGINT AS shapley
        FROM r""",
    "op11_ball_kmeans": _rounds_sql(),
}
