import random
import zlib
from collections import defaultdict

import numpy as np
from cases import awkward_texts, frame
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from millrace.llm import packing
from millrace.llm.tokenizing import tokenizer_path

BPE = tokenizer_path("byte_bpe_50k.json")


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 70), max_size=60), st.sampled_from([1, 7, 16, 20]))
def test_windows_hold_every_token_once_without_padding(lengths, capacity):
    windows = packing.pack(lengths, capacity)
    seen = defaultdict(list)
    for window in windows:
        used = sum(length for *_, length in window)
        assert 0 < used <= capacity and (used == capacity or not used & (used - 1))
        for doc, start, length in window:
            assert length > 0
            seen[doc].append((start, length))
    for doc, length in enumerate(lengths):
        at = 0
        for start, size in sorted(seen[doc]):
            assert start == at
            at += size
        assert at == length


def test_tightest_window_is_taken():
    rng, tree, plain = random.Random(3), packing.OpenWindows(50), []
    for window in range(400):
        if plain and rng.random() < .5:
            need = rng.randint(1, 50)
            fits = [room for room, _ in plain if room >= need]
            got = tree.take(need)
            assert (got and got[0]) == (min(fits) if fits else None)
            if got:
                plain.remove(got)
        else:
            plain.append((rng.randint(1, 50), window))
            tree.add(*plain[-1])


def test_best_fit_needs_few_cuts():
    rng = random.Random(1)
    lengths = [rng.randint(1, 2000) for _ in range(3000)]
    pieces = sum(map(len, packing.pack(lengths, 2048)))
    assert pieces < 1.25 * len(lengths)


def test_pieces_of_documents(spark):
    texts = awkward_texts()
    docs = frame(spark, texts, extra=True).repartition(2)
    plain = Tokenizer.from_file(BPE)
    for group in (1, 1 << 22):
        got = packing.pack_documents(docs, BPE, 1, 256, group).collect()
        pieces, sequences = defaultdict(list), defaultdict(list)
        for r in got:
            pieces[r.doc_id].append(r)
            sequences[r.sequence_id].append((r.offset, r.length))
        for doc_id, text in enumerate(texts):
            ids = plain.encode(text or "", add_special_tokens=False).ids + [1]
            at = 0
            for r in sorted(pieces[doc_id], key=lambda r: r.start):
                assert (r.start, r.doc_tokens) == (at, len(ids))
                part = np.array(ids[at:at + r.length], "<u4")
                assert r.ids_crc32 == zlib.crc32(part.tobytes())
                at += r.length
            assert at == len(ids)
        for parts in sequences.values():
            at = 0
            for offset, length in sorted(parts):
                assert offset == at
                at += length
            assert at <= 256 and (at == 256 or not at & (at - 1))
    assert packing.pack_documents(frame(spark, []), BPE, 1).count() == 0
    assert packing.pack_documents(frame(spark, ["a", "a"], [None, None]), BPE, 1).count() == 2
