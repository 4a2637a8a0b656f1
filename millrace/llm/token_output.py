"""Token ids of a corpus as binary blocks with Elias-Fano coded document boundaries.

File format: a Parquet table, one row per block. A block holds whole documents, in ascending
doc_id order over all blocks of all shards (a shard is one range of doc_id, written by one task):

==============  ===================================================================
shard, block    place in the order
shard_start     ids of this shard before this block
doc_ids         the documents of the block
id_bytes, ids   all ids one after another, little-endian, 2 or 4 bytes each
low_bits        Elias-Fano parameter
lows, highs     low bits packed; high parts in unary
marks           position in ``highs`` of every 64th boundary, for select
==============  ===================================================================

``n`` boundaries below ``u`` take about ``n * (2 + log2(u / n))`` bits.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.common import map_rows, scratch, whole_text
from millrace.llm.tokenizing import encoder

BLOCK_TOKENS = 1 << 20
STRIDE = 64
BLOCKS = ("shard int, block int, shard_start bigint, n_tokens bigint, n_docs int, "
          "doc_ids array<bigint>, id_bytes int, ids binary, low_bits int, lows binary, "
          "highs binary, marks binary")
READ_BACK = "doc_id bigint, shard int, at bigint, n_tokens bigint, ids_crc32 bigint"


class EliasFano:
    """Non-decreasing integers in ``[0, universe]``."""

    def __init__(self, n: int, low_bits: int, lows: bytes, highs: bytes, marks: bytes):
        self.n, self.low_bits = n, low_bits
        self.lows = np.frombuffer(lows, np.uint8)
        self.highs = np.frombuffer(highs, np.uint8)
        self.marks = np.frombuffer(marks, "<u4")

    @classmethod
    def build(cls, values: np.ndarray, universe: int) -> "EliasFano":
        values = np.asarray(values, np.int64)
        n = len(values)
        low_bits = max(0, (int(universe) // n).bit_length() - 1) if n else 0
        places = (values >> low_bits) + np.arange(n)
        bits = np.zeros(int(places[-1]) + 1 if n else 0, np.uint8)
        bits[places] = 1
        low = (values[:, None] >> np.arange(low_bits)) & 1
        return cls(n, low_bits, np.packbits(low.astype(np.uint8).ravel()).tobytes(),
                   np.packbits(bits).tobytes(), places[::STRIDE].astype("<u4").tobytes())

    def columns(self) -> dict:
        return {"low_bits": [self.low_bits], "lows": [self.lows.tobytes()],
                "highs": [self.highs.tobytes()], "marks": [self.marks.tobytes()]}

    def _low(self, i: np.ndarray) -> np.ndarray:
        at = np.asarray(i)[:, None] * self.low_bits + np.arange(self.low_bits)
        bits = (self.lows[at >> 3] >> (7 - (at & 7))) & 1
        return (bits.astype(np.int64) << np.arange(self.low_bits)).sum(axis=1)

    def select(self, i: int) -> int:
        """The i-th value: from the mark at or before it, over at most 64 ones."""
        place = int(self.marks[i // STRIDE])
        rest = i % STRIDE
        byte = place >> 3
        current = int(self.highs[byte]) & (0xFF >> (place & 7))
        while (ones := current.bit_count()) <= rest:
            rest -= ones
            byte += 1
            current = int(self.highs[byte])
        place = byte * 8 + np.flatnonzero(np.unpackbits(np.array([current], np.uint8)))[rest]
        return ((int(place) - i) << self.low_bits) | int(self._low(np.array([i]))[0])

    def values(self) -> np.ndarray:
        """All values, as select would give them one by one."""
        places = np.flatnonzero(np.unpackbits(self.highs))[:self.n]
        return ((places - np.arange(self.n)) << self.low_bits) | self._low(np.arange(self.n))


def block_row(shard: int, block: int, shard_start: int, doc_ids: list, parts: list[bytes],
              narrow: bool) -> dict:
    ids = np.frombuffer(b"".join(parts), "<u4")
    ends = np.cumsum([len(x) // 4 for x in parts])
    width = 2 if narrow else 4
    return {"shard": [shard], "block": [block], "shard_start": [shard_start],
            "n_tokens": [len(ids)], "n_docs": [len(doc_ids)], "doc_ids": [doc_ids],
            "id_bytes": [width], "ids": [ids.astype(f"<u{width}").tobytes()],
            **EliasFano.build(ends, len(ids)).columns()}


def read_block(row: dict) -> Iterator[tuple]:
    """(doc_id, offset in the block, its ids) of a block's documents."""
    ids = np.frombuffer(row["ids"], f"<u{row['id_bytes']}").astype("<u4")
    ends = EliasFano(row["n_docs"], row["low_bits"], row["lows"], row["highs"],
                     row["marks"]).values().tolist()
    for doc_id, begin, end in zip(row["doc_ids"], [0, *ends], ends):
        yield doc_id, begin, ids[begin:end]


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int,
                 block_tokens: int = BLOCK_TOKENS) -> None:
    """Encode every text, append ``end_id`` to each and write blocks to ``path``.

    Null texts count as empty; null doc_ids come first; rows that repeat a doc_id are documents of
    their own, in the order of a hash of their texts. A document is never cut: one longer than a
    block makes a longer block. An empty input writes an empty table.
    """
    def start():
        coder = encoder(tokenizer)
        end = np.array([end_id], "<u4").tobytes()
        narrow = max(coder.tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16
        shard = TaskContext.get().partitionId()
        doc_ids, parts, held, block, done = [], [], 0, 0, 0

        def flush():
            nonlocal doc_ids, parts, held, block, done
            row = block_row(shard, block, done, doc_ids, parts, narrow)
            block, done = block + 1, done + held
            doc_ids, parts, held = [], [], 0
            return row

        def step(batch):
            nonlocal held
            if batch is None:
                if doc_ids:
                    yield flush()
                return
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"]):
                ids = coder.ids(text.as_py()) + end
                doc_ids.append(doc_id)
                parts.append(ids)
                held += len(ids) // 4
                if held >= block_tokens:
                    yield flush()
        return step

    ordered = (docs.select(F.col("doc_id").cast("bigint"), whole_text().alias("text"))
               .withColumn("tie", F.xxhash64("text"))
               .repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie"))
    map_rows(ordered, BLOCKS, start).write.parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Per document of a written table: doc_id, start, n_tokens, ids_crc32, shard."""
    def start():
        def step(batch):
            for row in batch.to_pylist() if batch is not None else []:
                got = [(d, row["shard_start"] + at, len(ids), zlib.crc32(ids.tobytes()))
                       for d, at, ids in read_block(row)]
                yield dict(zip(("doc_id", "at", "n_tokens", "ids_crc32"), zip(*got)),
                           shard=[row["shard"]] * len(got))
        return step

    blocks = spark.read.schema(BLOCKS).parquet(path)
    # One row per shard, that is per task of the writing job: small enough for one window and a
    # broadcast whatever the corpus holds.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = (blocks.groupBy("shard").agg(F.sum("n_tokens").alias("ids_in_shard"))
              .select("shard", F.coalesce(F.sum("ids_in_shard").over(before), F.lit(0))
                      .alias("shard_base")))
    return (map_rows(blocks, READ_BACK, start).join(F.broadcast(shards), "shard")
            .select("doc_id", (F.col("shard_base") + F.col("at")).alias("start"), "n_tokens",
                    "ids_crc32", "shard"))


def token_output(docs: DataFrame, tokenizer: str, end_id: int,
                 block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Write the blocks to a new path in the shared folder and read them back per document."""
    path = scratch(docs.sparkSession, "token-blocks")
    write_tokens(docs, path, tokenizer, end_id, block_tokens)
    return read_tokens(docs.sparkSession, path)
