"""Token counts through a cache keyed by digests of content and tokenizer."""

from __future__ import annotations

import hashlib
from functools import lru_cache

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import map_rows, whole_text

CACHE = "content binary, tokenizer string, n_tokens bigint"
BATCH = 64


@lru_cache(maxsize=2)
def counter(path: str):
    """A function from texts to token counts, without added tokens."""
    if path.endswith(".model"):
        import sentencepiece
        pieces = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(x) for x in pieces.encode(texts, num_threads=1)]
    from millrace.llm.tokenizing import encoder
    coder = encoder(path)
    return lambda texts: [len(coder.ids(x)) // 4 for x in texts]


def tokenizer_digest(path: str) -> str:
    """Digest of the tokenizer's file: another version never meets this one's counts."""
    with open(path, "rb") as file:
        return hashlib.sha256(file.read()).hexdigest()


def read_cache(spark: SparkSession, path: str) -> DataFrame:
    """The cache; an absent one is empty. Should two runs have added the same digest, one row is kept."""
    try:
        return spark.read.schema(CACHE).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], CACHE)


def count_tokens(docs: DataFrame, tokenizer: str, cache_path: str, limit: int = 4096,
                 normalise: Column | None = None) -> DataFrame:
    """Per row of ``docs``: doc_id, n_bytes, n_tokens, over_limit; new counts are added to the cache.

    ``normalise`` is the content that is counted; by default the text itself, null as empty (any
    other must not change counts). Repeated texts meet in one partial aggregation before the shuffle
    and are encoded once; counts come back over a join that is split where a digest is very common.
    Null doc_ids and repeated rows keep their rows; an empty input gives no row.
    """
    spark = docs.sparkSession
    version = tokenizer_digest(tokenizer)
    content = (docs.select(F.col("doc_id").cast("bigint"),
                           (whole_text() if normalise is None else normalise).alias("body"))
               .withColumn("content", F.unhex(F.sha2("body", 256))))
    stored = read_cache(spark, cache_path).filter(F.col("tokenizer") == version)
    misses = (content.groupBy("content").agg(F.first("body").alias("body"))
              .join(stored.select("content"), "content", "left_anti"))

    def start():
        count = counter(tokenizer)

        def step(batch):
            if batch is None:
                return
            for at in range(0, batch.num_rows, BATCH):
                part = batch.slice(at, BATCH)
                yield {"content": part["content"].to_pylist(),
                       "tokenizer": [version] * part.num_rows,
                       "n_tokens": count(part["body"].to_pylist())}
        return step

    map_rows(misses, CACHE, start).write.mode("append").parquet(cache_path)
    counts = (read_cache(spark, cache_path).filter(F.col("tokenizer") == version)
              .groupBy("content").agg(F.max("n_tokens").alias("n_tokens")))
    return (content.select("doc_id", "content", F.octet_length("body").cast("bigint").alias("n_bytes"))
            .join(counts, "content")
            .select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")))
