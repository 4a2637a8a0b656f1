"""The pipeline, stage by stage and whole, against brute force over small documents."""

import random
import zlib
from itertools import combinations

import corpus_pipeline
from cases import frame
from millrace.llm.packing import pack_documents
from millrace.llm.secret_scan import redacted_text
from millrace.llm.tokenizing import tokenizer_path

ABUSE = ["moron", "scumbag", "idiot", "vermin"]


def corpus():
    """Texts by id: abuse, near copies, secrets, blank texts of every kind, and plain ones."""
    rng = random.Random(6)
    words = [f"word{i}" for i in range(400)]
    texts = {}
    for i in range(240):
        text = rng.choices(words, k=rng.randrange(8, 60))
        if i % 6 == 0:
            for _ in range(4):
                text.insert(rng.randrange(len(text)), f"you {rng.choice(ABUSE)}")
        texts[i] = " ".join(text)
    long = rng.choices(words, k=300)
    for i in range(240, 270):
        near = list(long)
        near[rng.randrange(300)] = f"other{i}"
        texts[i] = " ".join(near)
    for i in range(270, 274):
        texts[i] = "password = hunter2hunter2hunter2 " + " ".join(rng.choices(words, k=20))
    for i, blank in enumerate([None, "", " \t\n", "\x85", "  ", " \x85", "\x85"]):
        texts[280 + i] = blank
    texts[290] = texts[291] = texts[1]
    return texts


def tables(spark, tmp_path, texts, extra):
    docs = frame(spark, list(texts.values()), list(texts))
    for name in extra:
        docs = docs.withColumn(name, docs.doc_id * 2)
    docs.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, 1, int(i < 240 and i % 6 == 0)) for i in texts if i < 240]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    return spark.read.parquet(f"{tmp_path}/documents.parquet")


def grams(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def survivors(texts):
    """Smallest id of every group of near copies; texts without a word all stay."""
    sets, root = {i: grams(t) for i, t in texts.items()}, {i: i for i in texts}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in combinations([i for i in texts if sets[i]], 2):
        if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
            a, b = sorted((find(a), find(b)))
            root[b] = a
    return {i for i in texts if find(i) == i}


def test_whole_run_against_brute_force(spark, tmp_path):
    texts = corpus()
    names = ["__own", "__masked", "__doc", "__node", "__nth", "node", "own", "masked", "c0", "a.b"]
    docs = tables(spark, tmp_path, texts, names)
    kept = {}
    stage = docs
    for name, function in corpus_pipeline.STAGES:
        before, stage = stage, function(spark, stage, str(tmp_path))
        if name != "packing":
            assert stage.columns == docs.columns
            rows = stage.collect()
            assert all(r[n] == 2 * r.doc_id for r in rows for n in names)
            kept[name] = {r.doc_id: (r.text, r.n_chars) for r in rows}
            assert len(rows) == len(kept[name])
    toxic = {i for i in texts if i < 240 and i % 6 == 0}
    assert set(kept["toxicity"]) == set(texts) - toxic
    clean = {i: t for i, t in texts.items() if i not in toxic}
    assert set(kept["ngram_jaccard_join"]) == survivors(clean)
    for i, (text, n_chars) in kept["secrets"].items():
        want = None if texts[i] is None else redacted_text(texts[i], "[secret]")
        assert text == want and n_chars == (None if want is None else len(want))
        assert "hunter2" not in (text or "")
    assert any("[secret]" in (t or "") for t, _ in kept["secrets"].values())
    ids = sorted(kept["secrets"])
    want = pack_documents(frame(spark, [kept["secrets"][i][0] for i in ids], ids), tokenizer_path("byte_bpe_50k.json"),
                          end_id=1, capacity=2048)
    pieces = [(r.doc_id, r.start, r.length, r.ids_crc32) for r in stage.collect()]
    whole = {}
    for doc_id, _, length, _ in pieces:
        whole[doc_id] = whole.get(doc_id, 0) + length
    assert whole == {r.doc_id: r.doc_tokens for r in want.collect()}
    run = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted((r.doc_id, r.doc_tokens) for r in run.collect()) == sorted((r.doc_id, r.doc_tokens) for r in stage.collect())


def test_empty_tables(spark, tmp_path):
    tables(spark, tmp_path, {}, [])
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
