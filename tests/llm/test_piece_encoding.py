import random
import zlib

import numpy as np
import sentencepiece
from cases import awkward_texts, frame
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm.piece_encoding import MARKER, DoubleArray, Pieces, encode_documents
from millrace.llm.tokenizing import tokenizer_path

MODEL = tokenizer_path("piece_bpe_32k.model")
LOADED = Pieces(MODEL)


def test_double_array_holds_exactly_its_keys():
    rng = random.Random(1)
    keys = {bytes(rng.choices(b"abc\xff\x00", k=rng.randint(1, 6))): i for i in range(500)}
    keys = {k: i for i, k in enumerate(keys)}
    trie = DoubleArray(keys)

    def find(key):
        state = 0
        for byte in key:
            after = trie.base[state] + byte
            if trie.check[after] != state or not after:
                return -1
            state = after
        return trie.value[state]

    assert all(find(k) == i for k, i in keys.items())
    for _ in range(2000):
        key = bytes(rng.choices(b"abcd\xff\x00", k=rng.randint(1, 7)))
        assert find(key) == keys.get(key, -1)


def brute_score(text):
    """Best sum over all segmentations, by plain dynamic programming over characters."""
    pieces = {LOADED.raw[i].decode(): LOADED.scores[i] for i in range(len(LOADED.raw))
              if LOADED.raw[i] and not LOADED.is_byte[i]}
    text = " " + text
    best = [0.0] + [None] * len(text)
    for end in range(1, len(text) + 1):
        options = []
        for begin in range(max(0, end - 48), end):
            piece = text[begin:end]
            if best[begin] is not None and piece in pieces:
                options.append(best[begin] + pieces[piece])
        if text[end - 1] not in pieces and best[end - 1] is not None:
            options.append(best[end - 1] + len(text[end - 1].encode()) * LOADED.scores[LOADED.byte_ids[0]])
        best[end] = max(options, default=None)
    return best[-1]


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("the quick   andng\n\té日本🙂ꙮ<s>")), min_size=1, max_size=30))
def test_best_score_and_round_trip(text):
    ids = LOADED.encode(text)
    assert abs(LOADED.score_table[ids].sum() - brute_score(text)) < 1e-3
    assert LOADED.decode(ids.tolist()) == text


def test_decoding_agrees_with_the_library():
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    for text in filter(None, awkward_texts()):
        assert library.decode(LOADED.encode(text).tolist()) == LOADED.decode(LOADED.encode(text).tolist())


def test_documents(spark):
    texts = awkward_texts() + [f"a{MARKER}b"]
    got = sorted(encode_documents(frame(spark, texts, extra=True).repartition(3), MODEL).collect())
    for r, text in zip(got, texts):
        ids = LOADED.encode(text or "")
        assert (r.n_tokens, r.ids_crc32) == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        assert r.round_trip == (MARKER not in (text or ""))
    assert encode_documents(frame(spark, []), MODEL).count() == 0
    assert encode_documents(frame(spark, ["a", "a"], [None, None]), MODEL).count() == 2
