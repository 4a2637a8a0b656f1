"""Pack documents into sequences of a fixed length: best-fit decreasing, cuts only where needed."""

from __future__ import annotations

import zlib

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import map_rows, whole_text
from millrace.llm.tokenizing import encoder

GROUP_TOKENS = 4 << 20
PIECES = ("doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
          "sequence_id bigint, offset bigint")


class OpenWindows:
    """Open windows by remaining room, under a segment tree that finds the tightest fit."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.tree = bytearray(2 * self.size)
        self.windows: list[list[int]] = [[] for _ in range(capacity + 1)]

    def add(self, room: int, window: int) -> None:
        self.windows[room].append(window)
        i = room + self.size
        while i and not self.tree[i]:
            self.tree[i] = 1
            i >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """(room, window) of a window with the least room of at least ``need``."""
        i = need + self.size
        if not self.tree[i]:
            while i > 1 and (i & 1 or not self.tree[i + 1]):
                i >>= 1
            if i <= 1:
                return None
            i += 1
            while i < self.size:
                i = 2 * i if self.tree[2 * i] else 2 * i + 1
        room = i - self.size
        window = self.windows[room].pop()
        if not self.windows[room]:
            while i and not (i < self.size and (self.tree[2 * i] or self.tree[2 * i + 1])):
                self.tree[i] = 0
                i >>= 1
        return room, window


Piece = tuple[int, int, int]  # document, start in it, length


def pack(lengths: list[int], capacity: int) -> list[list[Piece]]:
    """Windows of pieces, none longer than ``capacity``; their order in a window is final.

    Documents longer than a window are cut into full windows first; what is left of each goes, the
    longest first, into the open window it fits most tightly. Then gaps are filled with cuts from
    the emptiest windows, and the one window left over is cut to powers of two. So every window
    is full or holds a power of two (only those need no padding).
    """
    windows: list[list[Piece]] = []
    rests: list[Piece] = []
    for doc, length in enumerate(lengths):
        full = length // capacity
        windows += [[(doc, k * capacity, capacity)] for k in range(full)]
        if length % capacity:
            rests.append((doc, full * capacity, length % capacity))
    rests.sort(key=lambda piece: -piece[2])
    opened, room_of = OpenWindows(capacity), {}
    for piece in rests:
        room, window = opened.take(piece[2]) or (capacity, len(windows))
        if window == len(windows):
            windows.append([])
        windows[window].append(piece)
        room_of[window] = room - piece[2]
        if room_of[window]:
            opened.add(room_of[window], window)
    return fill_gaps(windows, room_of, capacity)


def fill_gaps(windows: list[list[Piece]], room_of: dict[int, int], capacity: int):
    def padded(window: int) -> bool:
        used = capacity - room_of[window]
        return used < capacity and bool(used & (used - 1))

    gaps = sorted(filter(padded, room_of), key=lambda w: room_of[w])  # fullest first
    last = len(gaps) - 1
    for k, window in enumerate(gaps):
        while room_of[window] and k < last:
            donor = gaps[last]
            doc, start, length = windows[donor].pop()
            moved = min(length, room_of[window])
            if moved < length:
                windows[donor].append((doc, start, length - moved))
            windows[window].append((doc, start + length - moved, moved))
            room_of[window] -= moved
            room_of[donor] += moved
            if not windows[donor]:
                last -= 1
        if k >= last:
            break
    if gaps and last >= 0 and padded(gaps[last]):
        rest, windows[gaps[last]] = windows[gaps[last]], []
        windows += powers_of_two(rest)
    return [window for window in windows if window]


def powers_of_two(pieces: list[Piece]) -> list[list[Piece]]:
    """The same tokens in windows whose lengths are the binary digits of their number."""
    total = sum(length for *_, length in pieces)
    out, pieces = [], pieces[::-1]
    for bit in reversed(range(total.bit_length())):
        need, window = total & 1 << bit, []
        while need:
            doc, start, length = pieces.pop()
            if length > need:
                pieces.append((doc, start + need, length - need))
            window.append((doc, start, min(length, need)))
            need -= window[-1][2]
        if window:
            out.append(window)
    return out


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = 2048,
                   group_tokens: int = GROUP_TOKENS) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Each task packs its own documents in groups of about ``group_tokens`` ids (or one longer
    document), so its memory is bounded and nothing is shuffled; sequence ids carry the task's number.
    Null texts count as empty and give one piece with the end id; repeated rows and null doc_ids are
    packed as documents of their own; an empty input gives no row.
    """
    def start():
        coder, end = encoder(tokenizer), np.array([end_id], "<u4").tobytes()
        sequence = TaskContext.get().partitionId() << 32
        doc_ids, ids, held = [], [], 0

        def flush():
            nonlocal doc_ids, ids, held, sequence
            rows = []
            for window in pack([len(x) for x in ids], capacity):
                offset = 0
                for doc, begin, length in window:
                    part = ids[doc][begin:begin + length].astype("<u4")
                    rows.append((doc_ids[doc], begin, length, zlib.crc32(part.tobytes()),
                                 len(ids[doc]), sequence, offset))
                    offset += length
                sequence += 1
            doc_ids, ids, held = [], [], 0
            return dict(zip([x.split()[0] for x in PIECES.split(", ")], zip(*rows)))

        def step(batch):
            nonlocal held
            if batch is None:
                if doc_ids:
                    yield flush()
                return
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"]):
                got = np.frombuffer(coder.ids(text.as_py()) + end, "<u4")
                doc_ids.append(doc_id)
                ids.append(got.astype("<u2") if got.max() < 1 << 16 else got)
                held += len(got)
                if held >= group_tokens:
                    yield flush()
        return step

    return map_rows(docs.select(F.col("doc_id").cast("bigint"), whole_text().alias("text")),
                    PIECES, start)
