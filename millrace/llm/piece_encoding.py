"""Encode texts into the pieces of a SentencePiece model by unigram Viterbi, and decode them.

The best segmentation has the highest sum of piece scores; pieces are looked up in a double-array
trie. Blanks become the marker, one stands before the text; a character without a piece becomes the
pieces of its UTF-8 bytes. No piece crosses the start of a run of markers, so a text is encoded
stretch by stretch, and a task remembers stretches it has seen.
"""

from __future__ import annotations

import re
import zlib
from array import array

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import kept, map_rows, whole_text

MARKER = "▁"
STRETCH = re.compile(r" *[^ ]+| +")
MEMO_ENTRIES = 400_000
BYTE_PENALTY = 10.0
ENCODED = ("doc_id bigint, n_tokens bigint, n_byte_tokens bigint, ids_crc32 bigint, score double, "
           "round_trip boolean")


class DoubleArray:
    """Trie over byte strings: the child of state s for byte b is ``base[s] + b`` if ``check`` of it is s."""

    def __init__(self, keys: dict[bytes, int]):
        children: list[dict[int, int]] = [{}]
        ends: dict[int, int] = {}
        for key, value in sorted(keys.items()):
            node = 0
            for byte in key:
                if byte not in children[node]:
                    children[node][byte] = len(children)
                    children.append({})
                node = children[node][byte]
            ends[node] = value
        # Several children take a stretch of their own at the end; single ones fill the holes it leaves.
        size, end = 1024, 512
        base, check, value = [0] * size, [-1] * size, [-1] * size
        check[0] = 0
        queue, single, free = [(0, 0)], [], 257
        while queue or single:
            node, state = (queue or single).pop()
            value[state] = ends.get(node, -1)
            own = sorted(children[node])
            if len(own) == 1 and queue:
                single.append((node, state))
                continue
            if len(own) == 1:
                while check[free] >= 0:
                    free += 1
                base[state] = free - own[0]
            elif own:
                base[state] = end - own[0]
                end += own[-1] - own[0] + 1
            while len(check) < max(end, free) + 512:
                base += [0] * size
                check += [-1] * size
                value += [-1] * size
                size *= 2
            for byte in own:
                check[base[state] + byte] = state
                queue.append((children[node][byte], base[state] + byte))
        self.base, self.check, self.value = base, check, value


class Pieces:
    """A model's pieces, their scores, and what each decodes to."""

    def __init__(self, model: str):
        import sentencepiece
        loaded = sentencepiece.SentencePieceProcessor(model_file=model)
        ids = range(loaded.get_piece_size())
        self.scores = [loaded.get_score(i) for i in ids]
        self.byte_ids, plain = [0] * 256, {}
        self.raw = [b""] * len(self.scores)
        for i in ids:
            piece = loaded.id_to_piece(i)
            if loaded.is_byte(i):
                self.byte_ids[int(piece[1:-1], 16)] = i
                self.raw[i] = bytes([int(piece[1:-1], 16)])
            elif not (loaded.is_control(i) or loaded.is_unknown(i) or loaded.is_unused(i)):
                plain[piece] = i
                self.raw[i] = piece.replace(MARKER, " ").encode()
        lowest = min(self.scores[i] for i in plain.values()) - BYTE_PENALTY
        for i in self.byte_ids:
            self.scores[i] = lowest
        self.score_table = np.array(self.scores)
        self.is_byte = np.zeros(len(self.scores), bool)
        self.is_byte[self.byte_ids] = True
        self.trie = DoubleArray({p.replace(MARKER, " ").encode(): i for p, i in plain.items()})
        self.by_stretch = not any(re.search(f"[^{MARKER}]{MARKER}", p) for p in plain)
        self.memo: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def viterbi(self, data: bytes) -> list[int]:
        """Ids of the best segmentation; of equal ones that whose last piece begins first, and so on."""
        n, base, check, value, scores = len(data), self.trie.base, self.trie.check, self.trie.value, self.scores
        best, back = [None] * (n + 1), [None] * (n + 1)
        best[0] = 0.0
        for i in range(n):
            here = best[i]
            if here is None:
                continue
            byte = data[i]
            width = 1 if byte < 0x80 else 2 if byte < 0xE0 else 3 if byte < 0xF0 else 4
            state, alone = 0, False
            for j in range(i, n):
                after = base[state] + data[j]
                if check[after] != state or not after:
                    break
                state = after
                piece = value[state]
                if piece >= 0:
                    total = here + scores[piece]
                    alone |= j + 1 - i == width
                    if best[j + 1] is None or total > best[j + 1]:
                        best[j + 1], back[j + 1] = total, (i, piece)
            if not alone:
                total = here + width * scores[self.byte_ids[0]]
                if best[i + width] is None or total > best[i + width]:
                    best[i + width], back[i + width] = total, (i, None)
        out, at = [], n
        while at:
            begin, piece = back[at]
            if piece is None:
                out += [self.byte_ids[b] for b in reversed(data[begin:at])]
            else:
                out.append(piece)
            at = begin
        return out[::-1]

    def encode(self, text: str) -> np.ndarray:
        if not text:
            return np.empty(0, "<u4")
        text = " " + text.replace(MARKER, " ")
        parts = STRETCH.findall(text) if self.by_stretch else [text]
        if len(self.memo) > MEMO_ENTRIES:
            self.memo, self.older = {}, self.memo
        for part in set(parts).difference(self.memo):
            ids = self.older.get(part)
            self.memo[part] = ids if ids is not None else array("I", self.viterbi(part.encode())).tobytes()
        return np.frombuffer(b"".join(map(self.memo.__getitem__, parts)), "<u4")

    def decode(self, ids) -> str:
        """The text of ids: markers are blanks, the one before the text goes; byte pieces are read as UTF-8."""
        return b"".join(map(self.raw.__getitem__, ids)).decode("utf-8", "replace").removeprefix(" ")


def pieces(model: str) -> Pieces:
    """One per worker process."""
    return kept(("pieces", model), lambda: Pieces(model))


def encode_documents(docs: DataFrame, model: str) -> DataFrame:
    """Per row: doc_id, n_tokens, n_byte_tokens, ids_crc32 (of little-endian unsigned 32-bit ids), score (sum of
    piece scores), round_trip (whether decoding gives the text back; it doesn't where a text holds the marker itself).

    Null texts count as empty and have no token; every row keeps its row; nothing is shuffled.
    """
    def start():
        coder = pieces(model)

        def step(batch):
            if batch is None:
                return
            out = {name.split()[0]: [] for name in ENCODED.split(", ")}
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist()):
                ids = coder.encode(text)
                row = (doc_id, len(ids), int(coder.is_byte[ids].sum()), zlib.crc32(ids.tobytes()),
                       float(coder.score_table[ids].sum()), coder.decode(ids.tolist()) == text)
                for column, value in zip(out.values(), row):
                    column.append(value)
            yield out
        return step
    return map_rows(docs.select(F.col("doc_id").cast("bigint"), whole_text().alias("text")), ENCODED, start)
