"""Score texts with prediction by partial matching over bytes, next to a word unigram base.

A text is a byte stream: its words with a blank before each and after the last, then an end sign. The
contexts of a byte are the ``order`` bytes before it and all their ends, across blanks; before a text
stand pad bytes. Escapes follow method D, and symbols of the longer contexts are excluded from the
shorter ones. All contexts of all training documents make up the model, which is a table: texts are
gathered in blocks, the distinct grams of each block, packed, meet those of other blocks by parts and get
their code lengths, and every block is scored with its own. Nothing of the model is broadcast.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import arrow_schema, map_rows, tidy, whole_text, written
from millrace.llm.jaccard_join import from_planes, planes

ORDER = 5
MAX_ORDER = 6  # a context and its symbol are one bigint
BLOCK_BYTES = 10 << 20
FREQUENT = 1_000_000  # words of a share of at least one in this many are broadcast: so many at most
FREQUENT_BYTES = 64
FLUSH = 400_000
BLANK, END = b" ", b"\n"  # no word holds white space
PAD = b"\xff"  # in no UTF-8
VOCABULARY = "word binary, n bigint"
BLOCKS = "block bigint, doc_id array<bigint>, held_out array<boolean>, start array<bigint>, data binary, bytes bigint"
PIECE = 1 << 20  # places of a block that are looked up at once
RANGES = 16  # of values: the grams of a block are counted and their places found one range at a time
WORKER = 160 << 20  # resident bytes from which a worker hands memory back: heap and idle workers share an executor
PART_BYTES = 16 << 20  # text whose grams meet in a part, about; blocks meet it in groups where there are MAX_PARTS
MAX_PARTS = 4096
MIX = 1_500_450_271  # a fixed odd number; times 32 bits it stays within 63
GRAMS = "part bigint, block bigint, grams binary, n binary"
COUNTED = "gram bigint, n bigint"
CODES = "block bigint, part bigint, codes binary"
PARTS = ("row bigint, doc_id bigint, held_out boolean, word binary, n bigint, n_tokens bigint, "
         "n_known bigint, base double")


def words_of(text: str) -> list[bytes]:
    """A-Z lower-cased, split at ASCII white space."""
    return text.encode().lower().split()


def counted(df: DataFrame, schema: str, add) -> DataFrame:
    """Sums of what ``add`` puts into a counter per batch; the counter is emptied where it grows large."""
    def start():
        counts: Counter = Counter()

        def step(batch):
            if batch is not None:
                for part in range(0, batch.num_rows, 256):
                    add(counts, batch.slice(part, 256))
                    if len(counts) > FLUSH:
                        yield {"word": list(counts), "n": list(counts.values())}
                        counts.clear()
            elif counts:
                yield {"word": list(counts), "n": list(counts.values())}
        return step
    return map_rows(df, schema, start, WORKER).groupBy("word").agg(F.sum("n").alias("n"))


def vocabulary(texts: DataFrame) -> DataFrame:
    """(word, n) over whole texts, the end sign once per text among them."""
    def add(counts, batch):
        for text in batch["text"].to_pylist():
            counts.update(words_of(text))
            counts[END] += 1
    return counted(texts.select("text"), VOCABULARY, add)


def stream_of(text: str, order: int) -> bytes:
    return PAD * order + BLANK + b"".join(word + BLANK for word in words_of(text)) + END


def text_blocks(rows: DataFrame, order: int) -> DataFrame:
    """Streams of about ``BLOCK_BYTES`` together, compressed; a row's number is its block's and its place in it."""
    def start():
        first, done = TaskContext.get().partitionId() << 32, 0
        ids, held, streams, size = [], [], [], 0

        def emptied():
            nonlocal done, size
            if streams:
                data = b"".join(streams)
                ends = np.cumsum([len(x) for x in streams])
                yield {"block": [first + done], "doc_id": [list(ids)], "held_out": [list(held)],
                       "start": [[0, *ends[:-1].tolist()]], "bytes": [len(data)],
                       "data": [pa.compress(data, codec="zstd", asbytes=True)]}
                done += len(streams)
                size = 0
                for x in (ids, held, streams):
                    x.clear()

        def step(batch):
            nonlocal size
            if batch is None:
                yield from emptied()
                return
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                for doc_id, held_out, text in zip(*(part[c].to_pylist() for c in ("doc_id", "held_out", "text"))):
                    stream = stream_of(text, order)
                    ids.append(doc_id)
                    held.append(held_out)
                    streams.append(stream)
                    size += len(stream)
                    if size >= BLOCK_BYTES:
                        yield from emptied()
        return step
    return map_rows(rows, BLOCKS, start, WORKER)


def stream_bytes(batch, i: int) -> bytes:
    return pa.decompress(batch["data"][i].as_py(), batch["bytes"][i].as_py(), codec="zstd", asbytes=True)


def coded_places(length: int, starts: np.ndarray, order: int) -> np.ndarray:
    """Whether gram i codes byte i + order. Pads and the first blank of a text are given, not coded."""
    coded = np.ones(length - order, bool)
    for k in range(order + 1):
        at = starts + k - order
        coded[at[at >= 0]] = False
    return coded


def gram_ranges(data: bytes, starts: np.ndarray, order: int, ranges: int = RANGES):
    """(places, grams) of the coded bytes, one range of values at a time, rising: never all grams of a block at once.
    Place i codes byte i + order."""
    length = len(data) - order
    eights = np.ndarray(length, ">u8", data + bytes(8), strides=(1,))  # a gram begins each of them,
    twos = np.ndarray(length, ">u2", data, strides=(1,))               # and each gram with one of these
    seen = np.bincount(twos[::max(1, length // (1 << 16))], minlength=1 << 16)
    range_of = ((np.cumsum(seen) - seen) * ranges // seen.sum()).astype(np.uint8)
    of = np.empty(length, np.uint8)
    for a in range(0, length, PIECE):
        of[a:a + PIECE] = range_of[twos[a:a + PIECE]]
    of[~coded_places(len(data), starts, order)] = ranges
    rest = np.uint64(56 - 8 * order)
    for k in range(ranges):
        own = np.flatnonzero(of == k)
        yield own, (eights[own] >> rest).astype(np.int64)


def place_grams(data: bytes, starts: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """(gram of every coded byte, how many each text has): all at once, the plain form of ``gram_ranges``."""
    x = np.frombuffer(data, np.uint8)
    sizes = np.diff(starts, append=len(x)) - order - 1
    coded = coded_places(len(x), starts, order)
    grams, done = np.empty(np.count_nonzero(coded), np.int64), 0
    for a in range(0, len(coded), PIECE):
        own = coded[a:a + PIECE]
        piece = np.zeros(len(own), np.int64)
        for k in range(order + 1):
            piece <<= 8
            piece |= x[a + k:a + k + len(own)]
        piece = piece[own]
        grams[done:done + len(piece)] = piece
        done += len(piece)
    return grams, sizes


def sorted_counts(grams: np.ndarray, train: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct grams in order, how often each is at a place of ``train``). ``grams`` are overwritten: sorting them in
    place, with the mark as their last bit, needs no second array of their size."""
    grams <<= 1
    grams |= train
    grams.sort()
    new = np.ones(len(grams), bool)
    for a in range(0, len(grams), PIECE):
        piece = grams[a:a + PIECE + 1]
        new[a + 1:a + PIECE + 1] = (piece[1:] ^ piece[:-1]) > 1
    first = np.flatnonzero(new)
    n = np.zeros(len(first), np.int64)
    for a in range(0, len(grams), PIECE):
        marked = np.concatenate(([0], np.cumsum(grams[a:a + PIECE] & 1)))
        low, high = np.searchsorted(first, [a, a + len(marked) - 1])
        sums = np.diff(marked[np.concatenate(([0], first[low:high] - a, [len(marked) - 1]))])
        if low:  # what is left of the last piece's last gram
            n[low - 1] += sums[0]
        n[low:high] += sums[1:]
    return grams[first] >> 1, n


def sorted_places(grams: np.ndarray, ranges: int = RANGES) -> tuple[np.ndarray, np.ndarray]:
    """(place of each gram among the distinct ones, those in order), one range of values at a time: the tables that
    find places are a range's, not a block's."""
    sample = np.sort(grams[::max(1, len(grams) // 4096)])
    cuts = np.unique(sample[np.linspace(0, len(sample), ranges, endpoint=False, dtype=int)[1:]]) if len(sample) else sample
    of, places, distinct = np.empty(len(grams), np.uint8), np.empty(len(grams), np.int32), []
    for a in range(0, len(grams), PIECE):
        of[a:a + PIECE] = np.searchsorted(cuts, grams[a:a + PIECE], side="right")
    before = 0
    for k in range(len(cuts) + 1):
        own = np.flatnonzero(of == k)
        codes, found = pd.factorize(grams[own], sort=True)
        places[own] = codes + before
        before += len(found)
        distinct.append(found)
    return places, np.concatenate(distinct)


def part_of(gram, parts: int):
    """The part of a gram, as numpy array or column: grams that share all but two bytes share it, so a part holds
    runs of near values, and no beginning of a context is more than a few of them."""
    mixed = (gram >> 16) * MIX if isinstance(gram, np.ndarray) else F.shiftright(gram, 16) * MIX
    return (mixed >> 20) % parts if isinstance(gram, np.ndarray) else F.shiftright(mixed, 20) % parts


def packed_by_part(distinct: np.ndarray, parts: int) -> list[np.ndarray]:
    """Places of sorted grams, part by part."""
    part = part_of(distinct, parts)
    order = np.argsort(part, kind="stable")
    return np.split(order, np.flatnonzero(np.diff(part[order])) + 1)


def block_counts(data: bytes, starts: np.ndarray, held_out: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """(distinct grams of a block in order, how often each is in training rows)."""
    train = np.repeat(~held_out, np.diff(starts, append=len(data)))[order:]
    found = [sorted_counts(grams, train[own]) for own, grams in gram_ranges(data, starts, order)]
    return tuple(np.concatenate(x) for x in zip(*found))


def block_places(data: bytes, starts: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """(place of each byte's gram among the distinct ones, -1 where none is coded; the distinct ones in order)."""
    places, distinct, before = np.full(len(data) - order, -1, np.int32), [], 0
    for own, grams in gram_ranges(data, starts, order):
        codes, found = pd.factorize(grams, sort=True)
        places[own] = codes + before
        before += len(found)
        distinct.append(found)
    return places, np.concatenate(distinct)


def block_grams(blocks: DataFrame, order: int, parts: int) -> DataFrame:
    """Distinct grams of each block with their number in training rows, packed: one row per block and part, the
    grams sorted and as differences."""
    def start():
        def step(batch):
            for i in range(batch.num_rows if batch is not None else 0):
                distinct, n = block_counts(stream_bytes(batch, i), np.array(batch["start"][i].as_py()),
                                           np.array(batch["held_out"][i].as_py(), bool), order)
                rows = packed_by_part(distinct, parts)
                yield {"part": [int(part_of(distinct[x[:1]], parts)[0]) for x in rows],
                       "block": [batch["block"][i].as_py()] * len(rows),
                       "grams": [planes(np.diff(distinct[x], prepend=0)) for x in rows],
                       "n": [planes(n[x]) for x in rows]}
        return step
    return map_rows(blocks, GRAMS, start, WORKER)


def unpacked(grams: bytes) -> np.ndarray:
    return np.cumsum(from_planes(grams, "<i8"))


def counted_grams(packed: DataFrame, groups: int) -> DataFrame:
    """(gram, n) of all blocks. A group of rows that meet is a part's, of one in ``groups`` blocks."""
    schema = arrow_schema(packed.sparkSession, COUNTED)

    def summed(table: pa.Table) -> pa.Table:
        grams = np.concatenate([unpacked(x.as_py()) for x in table["grams"]])
        n = np.concatenate([from_planes(x.as_py(), "<i8") for x in table["n"]])
        order = np.argsort(grams)
        grams, n = grams[order], n[order]
        del order
        first = np.flatnonzero(np.diff(grams, prepend=-1))
        return pa.table([grams[first], np.add.reduceat(n, first)], schema=schema)

    def merge(table: pa.Table) -> pa.Table:
        found = summed(table)
        del table
        tidy(WORKER)
        return found

    merged = packed.groupBy("part", F.pmod(F.xxhash64("block"), F.lit(groups)).alias("group")).applyInArrow(merge, COUNTED)
    return merged if groups == 1 else merged.groupBy("gram").agg(F.sum("n").alias("n"))


def block_codes(packed: DataFrame, codes: DataFrame, parts: int, groups: int) -> DataFrame:
    """Code lengths of each block's grams, in the order of its packed grams: one row per block and part."""
    schema = arrow_schema(packed.sparkSession, CODES)

    def picked(rows: pa.Table, known: pa.Table) -> pa.Table:
        found = {"block": rows["block"], "part": rows["part"], "codes": []}
        if rows.num_rows:
            gram, code = known["gram"].to_numpy(), known["code"].to_numpy()
            by = np.argsort(gram)
            gram, code = gram[by], code[by]
            for x in rows["grams"]:
                own = unpacked(x.as_py())
                at = np.minimum(np.searchsorted(gram, own), len(gram) - 1)
                if (gram[at] != own).any():
                    raise ValueError("grams of a block without their code lengths")
                found["codes"].append(planes(code[at]))
        return pa.Table.from_arrays([pa.chunked_array(found[f.name], f.type) if isinstance(found[f.name], pa.ChunkedArray)
                                     else pa.array(found[f.name], f.type) for f in schema], schema=schema)

    def pick(rows: pa.Table, known: pa.Table) -> pa.Table:
        found = picked(rows, known)
        tidy(WORKER)
        return found

    group = F.pmod(F.xxhash64("block"), F.lit(groups))
    sent = codes.withColumn("part", part_of(F.col("gram"), parts)).withColumn(
        "group", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(groups - 1).cast("bigint"))))
    return (packed.withColumn("group", group).groupBy("part", "group")
            .cogroup(sent.groupBy("part", "group")).applyInArrow(pick, CODES))


def code_lengths(grams: DataFrame, order: int) -> DataFrame:
    """(gram, code): log10 P(last byte | the ``order`` bytes before it) of distinct grams with their counts (gram, n);
    those of n = 0 are not in the model, only asked for.

    From the shortest contexts to the longest. Of a gram's level are kept: its count, kinds and total of its
    context, ``code`` as if this context were the first asked, and ``after``, the code once the context was left by
    an escape, its symbols excluded. A level's rows meet the next shorter one's by the gram without its first byte
    and their own context's by all but the last: at most 256 rows share either, however common a context is.
    """
    levels = [written(grams, f"grams-{order}")]
    for k in range(order - 1, -1, -1):
        levels.insert(0, written(levels[0].groupBy(F.col("gram").bitwiseAND((1 << 8 * (k + 1)) - 1).alias("gram"))
                                 .agg(F.sum("n").alias("n")), f"grams-{k}"))
    n, kinds, total = F.col("n"), F.col("kinds"), F.col("total")
    seen = F.sum(F.when(n > 0, 1).otherwise(0))
    lowest = levels[0].agg(seen.alias("kinds"), F.coalesce(F.sum("n"), F.lit(0)).alias("total")).first()
    own, escape = F.log10((2 * n - 1) / (2 * total)), F.log10(kinds / (2 * total))
    after = F.lit(-math.log10(max(1, 256 - (lowest["kinds"] or 0))))
    done = levels[0].withColumns({"kinds": F.lit(lowest["kinds"] or 0), "total": F.lit(lowest["total"]), "after": after}
                                 ).withColumn("code", F.when(total == 0, after).when(n > 0, own).otherwise(escape + after))
    for k in range(1, order + 1):
        shorter = done.select(F.col("gram").alias("end"), F.col("n").alias("n_"), F.col("kinds").alias("kinds_"),
                              F.col("total").alias("total_"), F.col("code").alias("code_"), F.col("after").alias("after_"))
        context = Window.partitionBy(F.shiftright("gram", 8))
        left = 2 * (F.col("total_") - F.col("excluded"))
        onward = F.when(F.col("n_") > 0, F.log10((2 * F.col("n_") - 1) / left)).otherwise(
            F.col("after_") + F.when(F.col("kinds_") > kinds, F.log10((F.col("kinds_") - kinds) / left)).otherwise(0.0))
        done = (levels[k].withColumn("end", F.col("gram").bitwiseAND((1 << 8 * k) - 1)).join(shorter, "end")
                .withColumns({"kinds": seen.over(context), "total": F.sum("n").over(context),
                              "excluded": F.sum(F.when(n > 0, F.col("n_")).otherwise(0)).over(context)})
                .withColumn("after", F.when((total > 0) & (n == 0), onward))
                .withColumn("code", F.when(total == 0, F.col("code_")).when(n > 0, own).otherwise(escape + F.col("after")))
                .select("gram", "n", "kinds", "total", "code", "after"))
    return done.select("gram", "code")


def pieces(first: np.ndarray, end: int):
    """Beginnings of texts in runs of about ``PIECE`` places, each with the run's first and last place."""
    cuts = np.unique(np.searchsorted(first, np.arange(0, end, PIECE), side="left"))
    for a, b in zip(cuts, [*cuts[1:].tolist(), len(first)]):
        if a < b:
            yield first[a:b], int(first[a]), int(first[b]) if b < len(first) else end


def block_scores(blocks: DataFrame, codes: DataFrame, order: int, parts: int) -> DataFrame:
    """(row, score): sums of the code lengths of each text's bytes; ``codes`` are those of ``block_codes``."""
    tables = codes.groupBy("block").agg(F.collect_list(F.struct("part", "codes")).alias("codes"))

    def start():
        def step(batch):
            for i in range(batch.num_rows if batch is not None else 0):
                starts = np.array(batch["start"][i].as_py())
                places, distinct = block_places(stream_bytes(batch, i), starts, order)
                packed = {x["part"]: x["codes"] for x in batch["codes"][i].as_py()}
                code = np.zeros(len(distinct) + 1)  # the last one for bytes that are not coded
                for rows in packed_by_part(distinct, parts):
                    code[rows] = from_planes(packed[int(part_of(distinct[rows[:1]], parts)[0])], "<f8")
                first = np.maximum(starts - order, 0)
                sums = np.concatenate([np.add.reduceat(code[places[a:b]], own - a)
                                       for own, a, b in pieces(first, len(places))])
                block = batch["block"][i].as_py()
                yield {"row": np.arange(block, block + len(starts)), "score": sums}
        return step
    return map_rows(blocks.select("block", "start", "data", "bytes").join(tables, "block"), "row bigint, score double",
                    start, WORKER)


def score_documents(docs: DataFrame, order: int = ORDER, frequent: int = FREQUENT) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10).

    Training rows are those whose crc32(doc_id as text) mod 7 is not 2; a null doc_id is a training row.
    Null texts count as empty: one token, the end. Repeated rows count and are scored as often as they
    occur. With no training rows every byte has the same probability. An empty input gives no row.
    """
    if not 1 <= order <= MAX_ORDER:
        raise ValueError(f"order must be 1 to {MAX_ORDER}")
    sc = docs.sparkSession.sparkContext
    rows = docs.select(F.col("doc_id").cast("bigint"), whole_text().alias("text")).withColumn(
        "held_out", F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 2, F.lit(False)))
    words = written(vocabulary(rows.filter(~F.col("held_out"))), "vocabulary")
    sums = words.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    tokens, room = sums["n"] or 0, (sums["n"] or 0) + sums["v"] + 1
    common = sc.broadcast({bytes(r["word"]): math.log10((r["n"] + 1) / room) for r in words.filter(
        (F.col("n") * frequent >= tokens) & (F.octet_length("word") <= FREQUENT_BYTES)).toLocalIterator()})
    blocks = written(text_blocks(rows, order), "blocks")
    size = blocks.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    n_parts = min(MAX_PARTS, max(1, -(-size // PART_BYTES)))
    groups = max(1, -(-size // (PART_BYTES * n_parts)))
    packed = written(block_grams(blocks, order, n_parts), "block-grams")
    codes = block_codes(packed, code_lengths(counted_grams(packed, groups), order), n_parts, groups)

    def start():
        known = common.value

        def step(batch):
            for at in range(batch.num_rows if batch is not None else 0):
                data, block = stream_bytes(batch, at), batch["block"][at].as_py()
                ids, held_out, begins = (batch[c][at].as_py() for c in ("doc_id", "held_out", "start"))
                ends = begins[1:] + [len(data)]
                for first in range(0, len(ids), 512):
                    rare_row, rare_word, rare_n, own = [], [], [], []
                    for i in range(first, min(first + 512, len(ids))):
                        row, n_known, base = block + i, 0, 0.0
                        counts = Counter(data[begins[i] + order:ends[i]].split())
                        n_tokens = counts.total() + 1
                        counts[END] = 1
                        rare = []
                        for word, n in counts.items():
                            share = known.get(word)
                            if share is None:
                                rare.append(word)
                            else:
                                n_known += n
                                base += n * share
                        # The counts of the others are joined in.
                        rare_row += [row] * len(rare)
                        rare_word += rare
                        rare_n += map(counts.__getitem__, rare)
                        own.append((row, ids[i], held_out[i], END + row.to_bytes(8, "big"), 0, n_tokens, n_known, base))
                    # A document's own row has a key that is no word and spreads over the join.
                    rows_, ids_, held, keys, zeros, *sums_ = map(list, zip(*own))
                    none = [None] * len(rare_row)
                    yield dict(zip([x.split()[0] for x in PARTS.split(", ")], (
                        rare_row + rows_, none + ids_, none + held, rare_word + keys, rare_n + zeros,
                        *(none + x for x in sums_))))
        return step

    parts = map_rows(blocks, PARTS, start, WORKER)
    joined = parts.join(words.select("word", F.col("n").alias("seen")), "word", "left").select(
        "row", "doc_id", "held_out", "n_tokens", "n_known", "base", "n", "seen")
    scores = block_scores(blocks, codes, order, n_parts)
    return joined.unionByName(scores, allowMissingColumns=True).groupBy("row").agg(
        F.max("doc_id").alias("doc_id"), F.max("held_out").alias("held_out"),
        F.max("n_tokens").alias("n_tokens"),
        F.sum(F.when(F.col("seen").isNotNull(), F.col("n"))).alias("rare_known"),
        F.max("n_known").alias("n_known"),
        F.sum(F.col("n") * F.log10((F.coalesce("seen", F.lit(0)) + 1) / F.lit(float(room)))).alias("rare"),
        F.max("base").alias("base"), F.max("score").alias("score"),
    ).select("doc_id", "held_out", "n_tokens",
             (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
             F.lit(tokens).cast("bigint").alias("train_tokens"),
             (F.col("base") + F.col("rare")).alias("base_score"), "score")
