import zlib

import numpy as np
import pytest
from cases import awkward_texts, frame
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from millrace.llm import token_output as to
from millrace.llm.tokenizing import Encoder, tokenizer_path

BPE = tokenizer_path("word_bpe_49k.json")


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_stretches_give_the_librarys_ids(name):
    plain, ours = Tokenizer.from_file(tokenizer_path(name)), Encoder(tokenizer_path(name), 40)

    @settings(max_examples=300, deadline=None)
    @given(st.text(alphabet=st.sampled_from(list("ab Z1.'\n\t\r\x1c\x85\xa0é́́<|>endoftxt 　🙂")), max_size=40))
    def same(text):
        got = np.frombuffer(ours.ids(text), "<u4").tolist()
        assert got == plain.encode(text, add_special_tokens=False).ids

    same()
    for text in filter(None, awkward_texts()):
        got = np.frombuffer(ours.ids(text), "<u4").tolist()
        assert got == plain.encode(text, add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 5000), max_size=400))
def test_elias_fano_round_trip(values):
    values = sorted(values)
    coded = to.EliasFano.build(np.array(values, np.int64), values[-1] if values else 0)
    assert coded.values().tolist() == values
    assert [coded.select(i) for i in range(len(values))] == values


def test_elias_fano_is_small():
    ends = np.cumsum(np.full(10000, 900))
    coded = to.EliasFano.build(ends, int(ends[-1])).columns()
    assert sum(len(coded[k][0]) for k in ("lows", "highs", "marks")) < 10000 * 13 / 8 + 1000


def expected(texts, ids):
    plain, at, out = Tokenizer.from_file(BPE), 0, []
    for doc_id, text in zip(ids, texts):
        got = plain.encode(text or "", add_special_tokens=False).ids + [2]
        out.append((doc_id, at, len(got), zlib.crc32(np.array(got, "<u4").tobytes())))
        at += len(got)
    return out


@pytest.mark.parametrize("block", [10, 1 << 20])
def test_documents_against_the_library(spark, block):
    texts = awkward_texts()
    ids = list(range(0, 3 * len(texts), 3))
    docs = frame(spark, texts, ids, extra=True).repartition(3)
    got = to.token_output(docs, BPE, 2, block_tokens=block).collect()
    assert sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got) == expected(texts, ids)


def test_repeated_and_null_ids_and_no_rows(spark):
    docs = frame(spark, ["b", "b", "c c", None], [7, 7, None, None])
    got = sorted(to.token_output(docs, BPE, 2).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [None, None, 7, 7]
    assert [r.start for r in got][1:] == list(np.cumsum([r.n_tokens for r in got]))[:-1]
    assert to.token_output(frame(spark, []), BPE, 2).count() == 0


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_all_latin_letters_give_the_librarys_ids(name):
    plain, ours = Tokenizer.from_file(tokenizer_path(name)), Encoder(tokenizer_path(name))
    for letter in filter(str.isalpha, map(chr, range(0x250))):
        for text in (letter, f"{letter}ab", f"a{letter}b", f"x {letter}a. B{letter},", f"{letter}{letter}\n{letter}\u0130stanbul"):
            got = np.frombuffer(ours.ids(text), "<u4").tolist()
            assert got == plain.encode(text, add_special_tokens=False).ids, text


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_words_with_marks_need_no_whole_tokenizer(name, monkeypatch):
    plain, ours = Tokenizer.from_file(tokenizer_path(name)), Encoder(tokenizer_path(name))
    marks = ["%%%", "***", ".)", "&&&", "!?", ";", '"', "-", "`~", "<|", "|>"]
    for mark in marks:
        ours.ids(f"a a{mark}")
    ours.ids("a\nb")
    monkeypatch.setattr(ours, "_library", None)
    text = "a " + " ".join(f"word{chr(97 + i)}{mark} Straße{mark}" for i, mark in enumerate(marks))
    text = f"{text} {text}"
    assert np.frombuffer(ours.ids(text), "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_keys_of_stretches_stay_apart(name):
    """With and without the blank before them, wide white space between, one after another in one memory."""
    plain, ours = Tokenizer.from_file(tokenizer_path(name)), Encoder(tokenizer_path(name))
    for text in ("ab", " ab", "\nab", "  ab", " \nab", "\n ab", "ab ", "ab\n", " ", "\n", "", "x ab", "x\nab", "x  ab", "x \nab",
                 "x\n\nab.", "x ab. ", "x ab.\n", "ab ab\nab  ab", "ab, Ab, AB,", "'s 's x's", "ab <|endoftext|> ab<|endoftext|>ab"):
        for _ in range(2):
            assert np.frombuffer(ours.ids(text), "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids, text
