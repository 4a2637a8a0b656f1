"""Exact token ids of whole texts, with one library call per distinct stretch of text.

A tokenizer that never joins characters across the start of a white-space run gives the same ids
for a text as for its stretches one after another. A task therefore remembers the ids of stretches
it has seen; only new ones go to the ``tokenizers`` library. Texts with white space on which Python
and the library may disagree go to the library whole.
"""

from __future__ import annotations

import os
import re
import sys
from array import array
from collections.abc import Callable

from millrace.llm.common import kept

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # one Spark task is one core

#: White space other than blank and line feed.
ODD_SPACE = [c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n"] + ["᠎"]
STRETCH = re.compile(r"[ \n]*[^ \n]+|[ \n]+")
#: White space that is not one blank or line feed between two words, other than at the end.
WIDE_SPACE = ("  ", " \n", "\n ", "\n\n")
MEMO_ENTRIES = 450_000

# Byte-level models write bytes as characters: printable ones as themselves, the rest from 256 on.
SHOWN = {*range(33, 127), *range(161, 173), *range(174, 256)}
BYTE_NAMES = {b: 256 + i for i, b in enumerate(x for x in range(256) if x not in SHOWN)}
BLANK = chr(BYTE_NAMES[32])
#: Below this, letters have no combining forms and, but for one, one-to-one lower case.
LATIN_END = "\u0250"
DOTTED_I = "\u0130"  # its lower case is two characters, and the library splits between them
LATIN = re.compile(f"[\0-{chr(ord(DOTTED_I) - 1)}{chr(ord(DOTTED_I) + 1)}-{chr(ord(LATIN_END) - 1)}]*")
LETTERS = "".join(c for c in map(chr, range(ord(LATIN_END))) if c.isalpha() and c != DOTTED_I)
#: A Latin word, after a line feed and before marks (other than an apostrophe) at most.
WORD = re.compile(rf"(\n?)([{LETTERS}]+)([!-&(-/:-@\[-`{{-~]*)")


def little_endian(ids: list[int]) -> bytes:
    """Unsigned 32-bit integers."""
    out = array("I", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


class Memo(dict):
    """Ids of stretches: taken over from the older generation or encoded when first met."""

    def __init__(self, older: dict[str, bytes], encode: Callable[[str], bytes]):
        self.older, self.encode = older, encode

    def __missing__(self, key: str) -> bytes:
        ids = self.older.get(key)
        if ids is None:
            ids = self.encode(key)
        self[key] = ids
        return ids


class Encoder:
    """``ids(text)``: ids as little-endian unsigned 32-bit integers, without added special tokens.

    A stretch that is one Latin word, with a blank or line feed before and a run of marks after it at most, splits
    in a known way; its parts go straight to the library's BPE model. All others pass the whole tokenizer. A stretch
    of a blank and a word is remembered by its word; words without the blank are remembered apart. Two generations of
    remembered stretches bound the memory.
    """

    def __init__(self, path: str, memo_entries: int = MEMO_ENTRIES):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.memo, self.bare, self.memo_entries = Memo({}, self._stretch), {}, memo_entries
        self.drops_space = self._library("a \n b") == self._library("a") + self._library("b")
        self.lowers = self._library("A") == self._library("a")
        words = ("Word", "naïve", "straße,", "word.", "a-", "Éa***", "A%%%") + (() if self.drops_space else ("\nThe", "\nÉa&&."))
        self.splits_words = True
        self.splits_words = all(self._stretch(x) == self._library(self._whole(x)) for x in words)
        self.bare.clear()

    def _library(self, text: str) -> bytes:
        found = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)
        return little_endian(found[0].ids)

    def _model(self, part: str) -> bytes:
        if self.lowers:
            part = part.lower()
        if not part.isascii():
            part = part.encode().decode("latin-1").translate(BYTE_NAMES)
        elif part[0] == " ":
            part = BLANK + part[1:]
        return little_endian([x.id for x in self.model.tokenize(part)])

    def _whole(self, key: str) -> str:
        """The stretch remembered by ``key``."""
        return key if self.drops_space or key[0] in " \n" else " " + key

    def _stretch(self, key: str) -> bytes:
        """Ids of the stretch remembered by ``key``."""
        found = WORD.fullmatch(key) if self.splits_words else None
        if not found:
            return self._library(self._whole(key))
        feed, word, marks = found.groups()
        if feed:
            ids = self._bare(feed) + self._bare(word)
        elif marks:
            ids = self.memo.get(word) or self.memo.older.get(word)
            if ids is None:
                self.memo[word] = ids = self._model(self._whole(word))
        else:
            return self._model(self._whole(word))
        return ids + self._bare(marks) if marks else ids

    def _bare(self, part: str) -> bytes:
        """Ids of a part without white space before it."""
        ids = self.bare.get(part)
        if ids is None:
            if len(self.bare) > self.memo_entries // 8:
                self.bare.clear()
            self.bare[part] = ids = self._library(part)
        return ids

    def ids(self, text: str) -> bytes:
        if any(c in text for c in ODD_SPACE):
            return self._library(text)
        start = b""
        if self.drops_space:
            if self.lowers and (text.isascii() or LATIN.fullmatch(text)):
                text = text.lower()
            parts = text.split()
        else:
            if text[-1:] in (" ", "\n") or any(x in text for x in WIDE_SPACE):
                parts = [x[1:] if x[0] == " " and x[1:2] not in ("", " ", "\n") else x for x in STRETCH.findall(text)]
            else:
                parts = text.replace("\n", " \n").split(" ")
            if text[:1] not in (" ", "\n"):
                start = self._bare(parts[0]) if text else b""
                del parts[0]
            elif not parts[0]:
                del parts[0]
        if len(self.memo) > self.memo_entries:
            self.memo.older = {}
            self.memo = Memo(self.memo, self._stretch)
        out = b"".join(map(self.memo.__getitem__, parts))
        return start + out if start else out


def encoder(path: str) -> Encoder:
    """One encoder per worker process; its memory is kept from task to task."""
    return kept(("encoder", path), lambda: Encoder(path))


def tokenizer_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)
