import math
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import plain_ppm
import pytest
from cases import awkward_texts, frame

from millrace.llm import ppm


def brute(rows):
    def held_out(i):
        return i is not None and zlib.crc32(str(i).encode()) % 7 == 2

    def tokens(t):
        return [*(t or "").encode().lower().split(), b"\n"]
    seen = Counter(x for i, t in rows if not held_out(i) for x in tokens(t))
    n, v = sum(seen.values()), len(seen)
    return [(i, held_out(i), len(tokens(t)), sum(x in seen for x in tokens(t)), n,
             sum(math.log10((seen[x] + 1) / (n + v + 1)) for x in tokens(t))) for i, t in rows]


def test_base_and_counts_against_brute_force(spark):
    texts = awkward_texts() * 3
    rows = list(enumerate(texts))
    for frequent in (5, 100_000):  # words by the join, words by the broadcast
        got = sorted(ppm.score_documents(frame(spark, texts, extra=True).repartition(3), frequent=frequent).collect())
        for r, e in zip(got, brute(rows)):
            assert (r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens) == e[:5]
            assert math.isclose(r.base_score, e[5], rel_tol=1e-9, abs_tol=1e-9)
            assert r.score < 0


def plain_step(counts, gram):
    """P(last byte | before) with escape and exclusion, from all counts of contexts."""
    p, excluded = 1.0, set()
    for begin in range(len(gram)):
        after = {s: n for s, n in counts.get(gram[begin:-1], {}).items() if s not in excluded}
        if not after:
            continue
        total = 2 * sum(after.values())
        if gram[-1] in after:
            return p * (2 * after[gram[-1]] - 1) / total
        p *= len(after) / total
        excluded |= set(after)
    return p / (256 - len(excluded))


def test_model_is_a_distribution_and_agrees_with_a_plain_one(spark):
    words = {b"abc": 5, b"abd": 2, b"b": 9, b"cab": 1, b"\n": 4}
    df = spark.createDataFrame([(bytearray(w), n) for w, n in words.items()], ppm.VOCABULARY)
    trie = plain_ppm.context_trie(plain_ppm.context_counts(df, 3), 1000)
    scorer = plain_ppm.Scorer(trie, 3)
    counts = {c: dict(zip(s, n)) for c, (s, n) in trie.items()}
    assert counts[b""][ord("a")] == 8 and counts[b"ab"] == {ord("c"): 5, ord("d"): 2, ord(" "): 1}
    for context in (b" ", b" ab", b"abc", b" zz", b"cab"):
        total = 0
        for symbol in range(256):
            gram = context + bytes([symbol])
            p = 10 ** scorer.step(gram)
            assert math.isclose(p, plain_step(counts, gram))
            total += p
        assert math.isclose(total, 1.0)
    assert scorer.word(b"abc") > scorer.word(b"abq") > scorer.word(b"xyzzyq")
    assert len(plain_ppm.context_trie(plain_ppm.context_counts(df, 3), 3)) <= 3


def test_few_rows(spark):
    assert ppm.score_documents(frame(spark, [])).count() == 0
    got = ppm.score_documents(frame(spark, [None, "a a", "a a"], [None, 1, 1])).collect()
    assert sorted(r.n_tokens for r in got) == [1, 3, 3]
    alone = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    r = ppm.score_documents(frame(spark, ["ab"], [alone])).first()
    assert r.train_tokens == 0 and r.base_score == 0 and math.isclose(r.score, -4 * math.log10(256))


def plain_scores(rows, order):
    """Scores over whole texts from all contexts, in one dict."""
    def line(t):
        return b"\xff" * order + b" " + b"".join(w + b" " for w in (t or "").encode().lower().split()) + b"\n"

    counts = {}
    for i, t in rows:
        if i is None or zlib.crc32(str(i).encode()) % 7 != 2:
            x = line(t)
            for at in range(order + 1, len(x)):
                for begin in range(at - order, at + 1):
                    counts.setdefault(x[begin:at], Counter())[x[at]] += 1
    return [sum(math.log10(plain_step(counts, x[at - order:at + 1])) for at in range(order + 1, len(x)))
            for x in (line(t) for _, t in rows)]


def test_scores_over_whole_texts_and_all_contexts(spark, monkeypatch):
    monkeypatch.setattr(ppm, "BLOCK_BYTES", 3000)  # several blocks a task
    monkeypatch.setattr(ppm, "PART_BYTES", 4000)   # several parts,
    monkeypatch.setattr(ppm, "PIECE", 50)
    monkeypatch.setattr(ppm, "MAX_PARTS", 7)       # met by blocks in several groups
    assert ppm.ORDER == 5
    texts = awkward_texts() + [f"word{i} of the {chr(97 + i % 26) * (i % 7)} lot {i * i}" for i in range(150)]
    texts += ["zq\x00xj ꙮ"] * 7
    for order in (5, 2):
        got = sorted(ppm.score_documents(frame(spark, texts, extra=True).repartition(3), order).collect())
        for r, e in zip(got, plain_scores(list(enumerate(texts)), order), strict=True):
            assert math.isclose(r.score, e, rel_tol=1e-9), r


def test_order_of_words_matters(spark):
    texts = ["of the word and the end of it"] * 9 + ["of the word", "the of word", "word the of"]
    got = sorted(ppm.score_documents(frame(spark, texts)).collect())[-3:]
    assert got[0].score > max(got[1].score, got[2].score) and len({round(r.base_score, 9) for r in got}) == 1


@pytest.mark.parametrize("piece", [1, 3, 64, 1 << 20])
def test_counts_and_places_by_pieces_are_those_of_the_whole(monkeypatch, piece):
    monkeypatch.setattr(ppm, "PIECE", piece)
    rng = np.random.default_rng(3)
    for size, kinds in ((0, 1), (1, 1), (200, 1), (300, 7), (500, 400)):
        grams = rng.integers(0, kinds, size) * 0xFFFF_FFFF_FF  # up to seven bytes
        train = rng.random(size) < 0.6
        distinct, inverse = np.unique(grams, return_inverse=True)
        got, n = ppm.sorted_counts(grams.copy(), train)
        assert got.tolist() == distinct.tolist()
        assert n.tolist() == np.bincount(inverse[train], minlength=len(distinct)).tolist()
        places, found = ppm.sorted_places(grams)
        assert found.tolist() == distinct.tolist() and places.tolist() == inverse.tolist()


def test_arrays_of_a_block_stay_below_two_of_its_grams(monkeypatch):
    """A block's grams are one array of 8 bytes a place; counting them needs little beside it."""
    monkeypatch.setattr(ppm, "PIECE", 1 << 16)
    data = np.random.default_rng(5).integers(97, 107, 4 << 20).astype(np.uint8).tobytes()
    starts = np.arange(0, len(data), 1 << 16)
    tracemalloc.start()
    grams, sizes = ppm.place_grams(data, starts, ppm.ORDER)
    ppm.sorted_counts(grams, np.ones(len(grams), bool))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sizes.sum() == len(grams) and peak < 2 * 8 * len(data)


def test_grams_by_ranges_are_those_of_the_whole(monkeypatch):
    monkeypatch.setattr(ppm, "PIECE", 37)
    for order in (1, 5, 6):
        streams = [ppm.stream_of(t or "", order) for t in awkward_texts()] * 2
        data, starts = b"".join(streams), np.cumsum([0, *map(len, streams[:-1])])
        held_out = np.arange(len(streams)) % 3 == 1
        grams, sizes = ppm.place_grams(data, starts, order)
        distinct, inverse = np.unique(grams, return_inverse=True)
        train = np.repeat(~held_out, sizes)
        got, n = ppm.block_counts(data, starts, held_out, order)
        assert got.tolist() == distinct.tolist()
        assert n.tolist() == np.bincount(inverse[train], minlength=len(distinct)).tolist()
        places, found = ppm.block_places(data, starts, order)
        assert found.tolist() == distinct.tolist() and places[places >= 0].tolist() == inverse.tolist()
        assert np.flatnonzero(places >= 0).tolist() == np.flatnonzero(ppm.coded_places(len(data), starts, order)).tolist()


def test_a_block_is_counted_and_placed_range_by_range(monkeypatch):
    """Bytes of arrays for a byte of a block; 11 and 21 with all its grams at once."""
    monkeypatch.setattr(ppm, "PIECE", 1 << 16)
    data = np.random.default_rng(5).integers(97, 103, 4 << 20).astype(np.uint8).tobytes()
    starts = np.arange(0, len(data), 1 << 16)
    for most, work in ((8, lambda: ppm.block_counts(data, starts, np.zeros(len(starts), bool), ppm.ORDER)),
                       (13, lambda: ppm.block_places(data, starts, ppm.ORDER))):
        tracemalloc.start()
        work()
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < most * len(data)
