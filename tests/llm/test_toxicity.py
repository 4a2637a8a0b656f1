import random
import zlib

from cases import awkward_texts, frame

from millrace.llm import toxicity as tx

LABELS = "doc_id bigint, quality int, toxic int"


def corpus(n):
    rng = random.Random(8)
    words = ["".join(rng.choices("aeiourstnlm", k=rng.randint(2, 9))) for _ in range(800)]
    bad, texts, labels = ["frobnik", "grumple", "snarkist"], [], []
    for _ in range(n):
        text = rng.choices(words, k=rng.randint(5, 200))
        toxic = rng.random() < .2
        for _ in range(rng.randint(2, 5) if toxic else 0):
            text[rng.randrange(len(text))] = rng.choice(bad + ["wexi" + "".join(rng.choices("abcdefgh", k=3))])
        texts.append(" ".join(text))
        labels.append(int(toxic))
    return texts, labels


def test_held_out_accuracy_misspellings_and_quotation(spark):
    texts, labels = corpus(500)
    table = spark.createDataFrame([(i, 1, t) for i, t in enumerate(labels)] + [(None, 1, 1), (3, 0, None)], LABELS)
    docs = frame(spark, texts + awkward_texts(), extra=True)
    model = tx.fit(docs, table)
    assert set(model.lexicon.terms) >= {"frobnik", "grumple", "snarkist"}
    assert any("wexi".startswith(s[:4]) for s in model.lexicon.stems)
    got = {r.doc_id: r for r in tx.predictions(docs, table).collect()}
    assert len(got) == len(texts) + len(awkward_texts())
    held = [i for i in range(500) if zlib.crc32(str(i).encode()) % 3 == 1]
    assert all(got[i].held_out == (i in set(held)) for i in range(500))
    right = sum(got[i].predicted == labels[i] for i in held)
    assert right >= 0.97 * len(held)
    assert all(got[i].predicted == 0 and 0 <= got[i].score <= 1 for i in range(500, len(got)))
    assert model.lexicon.weight("frobnyk") > 0 and model.lexicon.weight("frobk") == 0
    plain, quoted = "mi re frobnik lo ta", 'mi re said "frobnik" lo ta'
    assert model.score(plain)[0] > model.score(quoted)[0]
    kept = tx.without_toxic(docs, model)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if not r.predicted}


def test_automaton_finds_exactly_terms_within_an_edit():
    rng = random.Random(3)
    terms = {"".join(rng.choices("abc", k=rng.randint(5, 7))): 1.0 for _ in range(30)}
    lexicon = tx.Lexicon(terms)

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row = next_row(row, x, b, i)
        return row[-1]

    def next_row(row, x, b, i):
        out = [i]
        for j, y in enumerate(b):
            out.append(min(out[j] + 1, row[j + 1] + 1, row[j] + (x != y)))
        return out

    for _ in range(600):
        word = "".join(rng.choices("abc", k=rng.randint(5, 8)))
        near = min(distance(word, t) for t in terms)
        assert (lexicon.weight(word) > 0) == (near <= 1)


def test_no_labels_no_rows(spark):
    none = spark.createDataFrame([], LABELS)
    got = tx.predictions(frame(spark, ["a", None]), none).collect()
    assert [r.predicted for r in got] == [0, 0]
    assert tx.predictions(frame(spark, []), none).count() == 0


def test_terms_that_clean_documents_quote_stay(spark):
    texts, labels = corpus(500)
    rng = random.Random(4)
    clean = [i for i in range(500) if not labels[i] and zlib.crc32(str(i).encode()) % 3 != 1]
    for i in rng.sample(clean, 12):
        words = texts[i].split()
        words.insert(rng.randrange(len(words)), f'said "{rng.choice(["frobnik", "grumple", "snarkist"])}"')
        texts[i] = " ".join(words)
    table = spark.createDataFrame([(i, 1, t) for i, t in enumerate(labels)], LABELS)
    docs = frame(spark, texts)
    model = tx.fit(docs, table)
    assert set(model.lexicon.terms) >= {"frobnik", "grumple", "snarkist"} and model.lexicon.weight("frobnyk") > 0
    assert len(model.lexicon.terms) < 20
    got = {r.doc_id: r for r in tx.predictions(docs, table).collect()}
    held = [i for i in range(500) if zlib.crc32(str(i).encode()) % 3 == 1]
    assert sum(got[i].predicted == labels[i] for i in held) >= 0.97 * len(held)
    abuse, quoted = "mi re frobnik lo ta grumple si", 'mi re said "frobnik" lo ta si'
    assert model.score(abuse)[0] >= tx.THRESHOLD > model.score(quoted)[0]
