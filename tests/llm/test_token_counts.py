import sentencepiece
from cases import awkward_texts, frame

from millrace.llm import token_counts as tc
from millrace.llm.tokenizing import tokenizer_path

MODEL = tokenizer_path("piece_bpe_32k.model")


def plain(texts):
    pieces = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    return [len(pieces.encode(x or "")) for x in texts]


def test_counts_and_cache(spark, tmp_path):
    cache, texts = str(tmp_path / "cache"), awkward_texts()
    docs = frame(spark, texts, extra=True).repartition(3)
    got = sorted(tc.count_tokens(docs, MODEL, cache, limit=100).collect())
    counts = plain(texts)
    assert [tuple(r) for r in got] == [
        (i, len((t or "").encode()), n, n > 100) for i, (t, n) in enumerate(zip(texts, counts))]
    assert spark.read.parquet(cache).count() == len({t or "" for t in texts})
    more = frame(spark, [texts[-1], "quite new", None])
    assert sorted(r.n_tokens for r in tc.count_tokens(more, MODEL, cache).collect()) == sorted(
        plain([texts[-1], "quite new", None]))
    assert spark.read.parquet(cache).count() == len({t or "" for t in texts}) + 1


def test_stored_counts_are_used_and_versions_kept_apart(spark, tmp_path):
    cache, docs = str(tmp_path / "cache"), frame(spark, ["one two"])
    tc.count_tokens(docs, MODEL, cache).collect()
    changed = spark.read.parquet(cache).selectExpr("content", "tokenizer", "n_tokens + 90 AS n_tokens").collect()
    other = str(tmp_path / "other")
    spark.createDataFrame(changed, tc.CACHE).write.parquet(other)
    assert tc.count_tokens(docs, MODEL, other).first().n_tokens == plain(["one two"])[0] + 90
    bpe = tokenizer_path("byte_bpe_50k.json")
    assert tc.count_tokens(docs, bpe, other).first().n_tokens == 2


def test_repeated_rows_null_ids_no_rows(spark, tmp_path):
    docs = frame(spark, ["a", "a", None], [None, None, 3])
    assert tc.count_tokens(docs, MODEL, str(tmp_path / "a")).count() == 3
    assert tc.count_tokens(frame(spark, []), MODEL, str(tmp_path / "b")).count() == 0
