"""One registered query per operator, over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import (
    fingerprints, hard_negatives, jaccard_join, packing, piece_encoding, pivot_search, ppm, secret_scan,
    token_counts, token_output, toxicity, warc_output, whitening,
)
from millrace.llm.common import read, scratch
from millrace.llm.tokenizing import tokenizer_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(query: Query) -> Query:
    QUERIES[query.__name__] = query
    return query


@register
def op1_elias_fano_output(spark, sf_dir):
    return token_output.token_output(read(spark, sf_dir, "documents"),
                                     tokenizer_path("word_bpe_49k.json"), end_id=2)


@register
def op2_ngram_jaccard_join(spark, sf_dir):
    return jaccard_join.jaccard_components(read(spark, sf_dir, "documents"))


@register
def op3_piece_encoding(spark, sf_dir):
    return piece_encoding.encode_documents(read(spark, sf_dir, "documents"),
                                           tokenizer_path("piece_bpe_32k.model"))


@register
def op4_pivot_topk(spark, sf_dir):
    return pivot_search.pivot_top_k(read(spark, sf_dir, "embeddings"),
                                    F.col("vec_id") % 50 == 0, k=5, scale=256).drop("evaluated")


@register
def op5_secret_scan(spark, sf_dir):
    return secret_scan.scan(read(spark, sf_dir, "documents"))


@register
def op6_threshold_sketch(spark, sf_dir):
    return fingerprints.fingerprints(read(spark, sf_dir, "documents"))


@register
def op7_best_fit_packing(spark, sf_dir):
    return packing.pack_documents(read(spark, sf_dir, "documents"),
                                  tokenizer_path("byte_bpe_50k.json"), end_id=1, capacity=2048)


@register
def op8_ppm_scoring(spark, sf_dir):
    return ppm.score_documents(read(spark, sf_dir, "documents"))


@register
def op9_toxicity(spark, sf_dir):
    return toxicity.predictions(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@register
def op10_token_counts(spark, sf_dir):
    return token_counts.count_tokens(read(spark, sf_dir, "documents"),
                                     tokenizer_path("piece_bpe_32k.model"),
                                     cache_path=scratch(spark, "token-cache"), limit=4096)


@register
def op11_embedding_whitening(spark, sf_dir):
    return whitening.whiten(read(spark, sf_dir, "embeddings"), components=8, scale=1024, shift=100_000)


@register
def op12_warc_output(spark, sf_dir):
    path = scratch(spark, "warc")
    warc_output.write_archives(read(spark, sf_dir, "pages"), path)
    return warc_output.read_archives(spark, path, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@register
def op13_hard_negatives(spark, sf_dir):
    label = F.col("label").cast("bigint")
    return hard_negatives.hard_negatives(
        read(spark, sf_dir, "embeddings"), anchor=F.col("vec_id") % 100 == 0,
        label=F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label), positives=5, negatives=10,
        low=30, high=90, scale=256).drop("evaluated")


# Over the pairs of a query and a candidate; vectors as lists of integers.
SQL = {
    "op4_pivot_topk": """
        WITH v AS (SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS q
                   FROM embeddings
                   WHERE vec_id IS NOT NULL AND len(embedding) > 0
                     AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
        s AS (SELECT a.vec_id AS query_id, b.vec_id,
                     CAST(list_sum([p[1] * p[2] FOR p IN list_zip(a.q, b.q)]) AS BIGINT) AS score
              FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id AND len(a.q) = len(b.q)),
        r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""",
    # Base32 from the hexadecimal digest: every five digits are four characters.
    "op12_warc_output": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
        k AS (SELECT page_id, octet_length(encode(h)) AS n, sha1(h) AS d, max(page_id) OVER (PARTITION BY h) AS w FROM p),
        b AS (SELECT *, [CAST('0x' || substr(d, CAST(5 * i + 1 AS INTEGER), 5) AS BIGINT) FOR i IN range(8)] AS five FROM k)
        SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
               array_to_string([array_to_string([
                   substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((v >> s) & 31 AS INTEGER) + 1, 1)
                   FOR s IN [15, 10, 5, 0]], '') FOR v IN five], '') AS payload_digest,
               CASE WHEN page_id = w THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> w THEN w END AS refers_to
        FROM b""",
    "op13_hard_negatives": """
        WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                          [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS q
                   FROM embeddings
                   WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
                     AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
        s AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
                     CAST(list_sum([p[1] * p[2] FOR p IN list_zip(a.q, b.q)]) AS BIGINT) AS score
              FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.q) = len(b.q)),
        p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
              QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
        n AS (SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
                     CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank
              FROM p JOIN s USING (anchor_id)
              WHERE NOT s.same AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score)
        SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10""",
}


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
