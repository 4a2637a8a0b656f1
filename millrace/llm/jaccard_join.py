"""Exact Jaccard join of documents on word n-grams, by blocked sparse products.

1. Every document becomes the set of 64-bit hashes of its n-grams. Documents with equal sets are one
   node, keyed by the hash of the set.
2. The incidence of documents and n-grams is cut into column blocks by n-gram, packed by flush: the distinct
   sets a task held at once, numbered from 0, so that no node key travels with an n-gram. A block counts
   per n-gram the sets of all flushes that have it (up to 127, before 56 bits of the hash) and sends back
   those of two or more. A node knows in how many flushes it lies itself: n-grams counted more often are
   shared with another node. With fewer than ``threshold`` of its n-grams shared it can't have a partner
   and is dropped: that leaves the near copies.
3. A partner must share one of a node's first ``n - ceil(threshold * n) + 1`` n-grams, in the order
   (rarest first, then by hash). Nodes joined by such n-grams, directly or not, form a group;
   links never leave it.
4. Inside a group, rows are multiplied in blocks: overlap counts of all pairs of a block whose sizes
   allow a link. Large groups run in two steps: every block by itself together with the group's pivots,
   which joins nearly all; then every node outside the group's largest component against all blocks.
   A block reports a spanning forest of its links, never all pairs.
"""

from __future__ import annotations

import math
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import LongType, StructField, StructType

from millrace.llm.common import arrow_schema, bounded_batches, kept, map_rows, tidy, whole_text, written
from millrace.llm.components import components

WORDS, THRESHOLD = 5, 75  # a shingle's words; percent
BLOCK_GRAMS = 1 << 21     # n-grams of a column block, about
FLUSH_GRAMS, FLUSH_DOCS = 1 << 21, 60_000
BLOCK_NODES, BLOCK_CELLS = 512, 1 << 20  # nodes and n-grams of a row block, about
PIVOTS = 32
LOCAL_HOT, HOT = 16, 127  # nodes of an n-gram: in one flush, to bypass its block; highest count kept
COLUMNS = 2048
KNOWN = np.uint16(65535)
MEMO_WORDS = 150_000
TEXT_BYTES = 4 << 20      # rows for a worker at once
# Fixed odd multipliers, one per word of a shingle and one for the number of words.
MULTIPLIERS = np.random.default_rng(20).integers(0, 1 << 63, 64, np.uint64) * np.uint64(2) + np.uint64(1)


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > MEMO_WORDS:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


def word_hashes() -> WordHashes:
    """One per worker process."""
    return kept("word hashes", WordHashes)


def shingles(text: str, words: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the text's shingles; with fewer words, of all of them as one."""
    tokens = text.encode().lower().split()  # bytes: lower-cases A-Z, splits at ASCII white space
    if not tokens:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(word_hashes().__getitem__, tokens), np.uint64, len(tokens))
    size = min(words, len(tokens))
    out = np.full(len(tokens) - size + 1, np.uint64(size)) * MULTIPLIERS[-1]
    for k in range(size):
        out += hashes[k:len(tokens) - size + 1 + k] * MULTIPLIERS[k]
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        out = (out ^ (out >> np.uint64(shift))) * np.uint64(factor)
    return np.unique(out ^ (out >> np.uint64(31)))


def node_of(grams: np.ndarray) -> int | None:
    """Key of a set: its hash as a signed integer, null for the empty set."""
    return int(np.int64(np.uint64(xxhash.xxh3_64_intdigest(grams.tobytes())))) if len(grams) else None


def sizes(docs: DataFrame, words: int) -> DataFrame:
    def start():
        def step(batch):
            if batch is not None:
                sets = [shingles(x.as_py(), words) for x in batch["text"]]
                yield {"doc_id": batch["doc_id"].to_pylist(), "node": [node_of(x) for x in sets],
                       "n": [len(x) for x in sets]}
        return step
    return map_rows(docs, "doc_id bigint, node bigint, n bigint", start)


def planes(values: np.ndarray) -> bytes:
    """Compressed, bytes by significance: the high ones of sorted values repeat."""
    by_byte = np.ascontiguousarray(values.view(np.uint8).reshape(-1, values.itemsize).T)
    return zstandard.compress(by_byte.tobytes(), 1)


def from_planes(data: bytes, dtype: str) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    by_byte = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(size, -1)
    return np.ascontiguousarray(by_byte.T).view(dtype).ravel()


def pack_sorted(values: np.ndarray) -> bytes:
    """Sorted values as their differences, in planes."""
    return planes(np.diff(values, prepend=values.dtype.type(0)))


def from_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(from_planes(data, "<u8"), dtype=np.uint64)


#: Incidences of a block within a flush: n-grams (56 bits, sorted) and places in the flush's ``nodes``. The
#: flush's nodes and their sizes are a row of their own, with block null.
INCIDENCE = "block bigint, flush bigint, grams binary, at binary, nodes array<bigint>, sizes array<bigint>"


def flush_rows(name: int, sets: list[tuple[int, np.ndarray]], blocks: int) -> Iterator[dict]:
    """Rows of a flush of sets (node, n-grams). ``sets`` is emptied, and what is no longer needed is dropped before
    the next step: a worker holds about three times the n-grams at most."""
    sizes = [len(x) for _, x in sets]
    yield {"block": [None], "flush": [name], "grams": [None], "at": [None],
           "nodes": [[node for node, _ in sets]], "sizes": [sizes]}
    grams = np.concatenate([x for _, x in sets])
    sets.clear()
    grams >>= np.uint64(8)
    at = np.repeat(np.arange(len(sizes), dtype=np.uint16), sizes)
    order = np.argsort(grams)
    grams, at = grams[order], at[order]
    del order
    same = grams[LOCAL_HOT:] == grams[:-LOCAL_HOT]
    if same.any():
        common = np.zeros(len(grams), bool)
        for k in range(LOCAL_HOT + 1):
            common[k:k + len(same)] |= same
        yield incidence_row(blocks + name % blocks, name, grams[common], at[common])
        at[common] = KNOWN
        told = ~common
        told[0] |= common[0]
        told[1:] |= common[1:] & (grams[1:] != grams[:-1])
        grams, at = grams[told], at[told]
    # Blocks are ranges of the hash: ascending here, and what a block holds differs little.
    lows = (np.arange(blocks, dtype=np.uint64) << np.uint64(32)) + np.uint64(blocks - 1)
    cuts = np.searchsorted(grams, (lows // np.uint64(blocks)) << np.uint64(24)).tolist()
    for block, (low, high) in enumerate(zip(cuts, [*cuts[1:], len(grams)])):
        if low < high:
            yield incidence_row(block, name, grams[low:high], at[low:high])


def incidence_row(block: int, name: int, grams: np.ndarray, at: np.ndarray) -> dict:
    return {"block": [block], "flush": [name], "grams": [pack_sorted(grams)], "at": [planes(at)],
            "nodes": [None], "sizes": [None]}


def incidence(docs: DataFrame, blocks: int, words: int) -> DataFrame:
    """Rows of the column blocks. What a task sends for one n-gram is bounded: of an n-gram that is very
    common in the flush its block hears once, and its places go to a block ``blocks + flush % blocks``.
    Flushes get random names: write the rows before use, so that no recomputed task renames them."""
    def start():
        sets, held, seen = [], 0, set()

        def flush():
            nonlocal held
            held = 0
            seen.clear()
            return flush_rows(int.from_bytes(os.urandom(8), "little") >> 1, sets, blocks)

        def step(batch):
            nonlocal held
            for text in batch["text"] if batch is not None else []:
                grams = shingles(text.as_py(), words)
                node = node_of(grams)
                if node is None or node in seen:
                    continue
                seen.add(node)
                sets.append((node, grams))
                held += len(grams)
                if held >= FLUSH_GRAMS or len(sets) >= FLUSH_DOCS:
                    yield from flush()
            if batch is None and sets:
                yield from flush()
        return step
    return map_rows(docs.select("text"), INCIDENCE, start)


SHARED = "flush bigint, grams binary, at binary, counts binary"


def set_counts(grams: list[np.ndarray], known: np.ndarray) -> np.ndarray:
    """Of every n-gram of a block in how many sets it lies, up to ``HOT``; ``known`` ones are ``HOT``."""
    every = np.concatenate(grams)
    order = np.argsort(every, kind="stable")
    every = every[order]
    first = np.flatnonzero(np.r_[True, every[1:] != every[:-1]]).astype(np.int32)
    del every
    run = np.diff(first, append=np.int32(len(order)))
    counts = np.minimum(run, HOT).astype(np.uint8)
    counts[np.logical_or.reduceat(known[order], first)] = HOT
    seen = np.empty(len(order), np.uint8)
    seen[order] = np.repeat(counts, run)
    return seen


def shared_grams(rows: DataFrame, blocks: int) -> DataFrame:
    """Incidences of the n-grams that several sets have, with their counts, by flush."""
    schema = arrow_schema(rows.sparkSession, SHARED)

    def count(table: pa.Table) -> pa.Table:
        tidy()
        names, plain = table["flush"].to_pylist(), table["block"][0].as_py() < blocks
        grams = [from_sorted(x) for x in table["grams"].to_pylist()]
        at = [from_planes(x, "<u2") for x in table["at"].to_pylist()]
        ends = np.cumsum([len(x) for x in grams])
        if plain:
            known = np.concatenate([x == KNOWN for x in at])
            seen = set_counts(grams, known)
        else:
            known, seen = np.zeros(ends[-1], bool), np.full(ends[-1], HOT, np.uint8)
        out = {name: [] for name in schema.names}
        for name, own, place, high in zip(names, grams, at, ends):
            part = slice(high - len(own), high)
            keep = (seen[part] > 1) & ~known[part]
            if keep.any():
                out["flush"].append(name)
                out["grams"].append(pack_sorted(own[keep]))
                out["at"].append(planes(place[keep]))
                out["counts"].append(planes(seen[part][keep]))
        return pa.table(out, schema=schema)

    return (rows.filter("block IS NOT NULL").select("block", "flush", "grams", "at")
            .groupBy("block").applyInArrow(count, SHARED))


NEAR = "node bigint, n bigint, grams array<bigint>"


def gathered(shared: DataFrame, rows: DataFrame, threshold: int) -> DataFrame:
    """Nodes with ``threshold`` percent of their n-grams shared: node, n, those n-grams, sorted. A node of
    several flushes comes from the one of the smallest name."""
    schema = arrow_schema(shared.sparkSession, NEAR)
    members = rows.filter("block IS NULL").select("flush", F.posexplode(F.arrays_zip("nodes", "sizes"))).select(
        "flush", F.col("pos").alias("place"), F.col("col.nodes").alias("node"), F.col("col.sizes").alias("n"))
    copies = members.groupBy("node").agg(F.count("*").alias("copies"), F.min("flush").alias("chosen"))
    members = members.join(copies, "node").select(
        "flush", "place", "node", "n", "copies", (F.col("flush") == F.col("chosen")).alias("chosen"))

    def gather(table: pa.Table, known: pa.Table) -> pa.Table:
        tidy()
        if not table.num_rows:
            return schema.empty_table()
        known = known.take(np.argsort(known["place"].to_numpy()))
        node, n, copies = (known[c].to_numpy() for c in ("node", "n", "copies"))
        chosen = known["chosen"].to_numpy()
        parts = []
        for row in zip(*(table[c].to_pylist() for c in ("grams", "at", "counts"))):
            at, counts = from_planes(row[1], "<u2"), from_planes(row[2], "u1")
            keep = chosen[at] & ((counts > copies[at]) | (counts == HOT))
            own = from_sorted(row[0])[keep]
            own |= counts[keep].astype(np.uint64) << np.uint64(56)
            parts.append((own, at[keep]))
        grams, at = (np.concatenate(x) for x in zip(*parts))
        del parts
        order = np.lexsort((grams, at))
        grams, at = grams[order], at[order]
        del order
        one = np.r_[True, (grams[1:] != grams[:-1]) | (at[1:] != at[:-1])][:len(at)]
        grams, at = grams[one], at[one]
        first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]][:len(at)])
        run = np.diff(np.r_[first, len(at)])
        place = at[first]
        near = run * 100 >= n[place] * threshold
        offsets = np.r_[0, np.cumsum(run[near])].astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(grams[np.repeat(near, run)].view(np.int64)))
        return pa.Table.from_arrays([pa.array(node[place][near]), pa.array(n[place][near]), lists],
                                    names=schema.names).cast(schema)

    return (shared.groupBy("flush").cogroup(members.groupBy("flush"))
            .applyInArrow(gather, NEAR))


def spanning_links(n: np.ndarray, sets: list[np.ndarray], threshold: int) -> list[tuple[int, int]]:
    """A spanning forest of the links among the rows of a block: sparse product, tile by tile."""
    order = np.argsort(n, kind="stable")
    n, sets = n[order], [sets[i] for i in order]
    grams, column = np.unique(np.concatenate(sets), return_inverse=True)
    row = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    common = np.bincount(column) > 1
    renamed = np.cumsum(common) - 1
    row, column = row[common[column]], renamed[column[common[column]]]
    by_column = np.argsort(column, kind="stable")
    row, column = row[by_column], column[by_column]
    overlap = np.zeros((len(sets), len(sets)), np.float32)
    # Rows are sorted by size: partners of row i end where sizes pass size_i * 100 / threshold.
    ends = np.searchsorted(n, n * 100 // threshold, side="right")
    for low in range(0, int(common.sum()), COLUMNS):
        a, b = np.searchsorted(column, (low, low + COLUMNS))
        part = np.zeros((len(sets), COLUMNS), np.float32)
        part[row[a:b], column[a:b] - low] = 1
        for i in range(0, len(sets), 64):
            end = ends[min(i + 63, len(sets) - 1)]
            overlap[i:i + 64, i:end] += part[i:i + 64] @ part[i:end].T
    total = n[:, None] + n[None, :]
    linked = np.triu((100 + threshold) * overlap.astype(np.int64) >= threshold * total, 1)
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            root[i] = i = root[root[i]]
        return i

    links = []
    for i, j in np.argwhere(linked).tolist():
        a, b = find(i), find(j)
        if a != b:
            root[b] = a
            links.append((int(order[i]), int(order[j])))
    return links


LINKS = "a bigint, b bigint"


def products(rows: DataFrame, unit: list[str], threshold: int) -> DataFrame:
    """Links found in each unit of rows (node, n, grams); a unit's size is bounded by who made it."""
    schema = arrow_schema(rows.sparkSession, LINKS)

    def multiply(table: pa.Table) -> pa.Table:
        tidy()
        node = table["node"].to_numpy()
        _, one = np.unique(node, return_index=True)
        found = []
        if len(one) > 1:
            sets = table["grams"].combine_chunks()
            found = [(int(node[one[i]]), int(node[one[j]])) for i, j in spanning_links(
                table["n"].to_numpy()[one], [np.asarray(sets[int(i)].values) for i in one], threshold)]
        return pa.table([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], schema=schema)

    return rows.groupBy(*unit).applyInArrow(multiply, LINKS)


def near_copies(docs: DataFrame, total: int, words: int, threshold: int) -> DataFrame:
    """Nodes that may have a partner: node, n, their shared n-grams."""
    blocks = max(1, math.ceil(total / BLOCK_GRAMS))
    rows = written(incidence(docs, blocks, words), "incidence")
    return written(gathered(shared_grams(rows, blocks), rows, threshold), "near-copies")


def groups_of(near: DataFrame, threshold: int) -> DataFrame:
    """(node, group, block, blocks, pivot): nodes that may link are in one group."""
    spare = F.col("n") - F.ceil(F.col("n") * threshold / F.lit(100.0))
    first = F.slice("grams", 1, (spare + 1 - F.col("n") + F.size("grams")).cast("int"))
    spread = near.select("node", F.explode(first).alias("gram"))
    heads = (spread.groupBy("gram").agg(F.min("node").alias("head"), F.count("*").alias("nodes"))
             .filter("nodes > 1").select("gram", "head"))
    found = components(spread.join(heads, "gram").select(F.col("node").alias("a"), F.col("head").alias("b")))
    members = (near.select("node", F.size("grams").alias("cells"))
               .join(found.select("node", F.col("component").alias("group")), "node"))
    shape = members.groupBy("group").agg(F.count("*").alias("nodes"), F.sum("cells").alias("cells")).select(
        "group", "nodes", F.greatest(F.ceil(F.col("nodes") / BLOCK_NODES),
                                     F.ceil(F.col("cells") / BLOCK_CELLS)).alias("blocks"))
    return written(members.join(shape, "group").select(
        "node", "group", "blocks", F.pmod(F.xxhash64("node"), F.col("blocks")).alias("block"),
        ((F.col("blocks") > 1) & (F.pmod(F.xxhash64("node", F.lit(1)), F.col("nodes")) < PIVOTS))
        .alias("pivot")), "groups")


def links_of(near: DataFrame, threshold: int) -> DataFrame:
    """Links (a, b) with the components of all links among ``near``."""
    placed = groups_of(near, threshold)
    every = F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)
    pivots = placed.filter("pivot").withColumn("block", F.explode(every))
    units = placed.select("node", "group", "block").union(pivots.select("node", "group", "block"))
    first = written(products(near.join(units, "node"), ["group", "block"], threshold), "links")

    large = placed.filter("blocks > 1")
    if large.isEmpty():
        return first
    # What is not in its group's largest component meets every block of the group.
    joined = large.join(components(first), "node", "left").withColumn(
        "component", F.coalesce("component", F.col("node")))
    counts = joined.groupBy("group", "component").agg(F.count("*").alias("members"))
    largest = counts.groupBy("group").agg(F.max_by("component", F.struct("members", "component")).alias("largest"))
    left = written(joined.join(largest, "group").withColumn("rest", F.col("component") != F.col("largest")),
                   "components")
    rest = left.filter("rest").withColumn("i", F.col("block")).withColumn("j", F.explode(every))
    blocks_of_rest = left.filter("rest").select("group", F.col("block").alias("i")).distinct()
    whole = left.withColumnRenamed("block", "j").join(blocks_of_rest, "group")
    pairs = rest.select("node", "group", "i", "j").union(whole.select("node", "group", "i", "j"))
    return first.union(written(products(near.join(pairs, "node"), ["group", "i", "j"], threshold), "links"))


def placed_nodes(docs: DataFrame, words: int, threshold: int) -> tuple[DataFrame, DataFrame]:
    """(rows as doc_id, node, n), (nodes as node, their smallest doc_id, component)."""
    bounded_batches(docs.sparkSession, TEXT_BYTES)
    texts = docs.select(F.col("doc_id").cast("bigint"), whole_text().alias("text"))
    meta = written(sizes(texts, words), "sizes")
    nodes = meta.filter("node IS NOT NULL").groupBy("node").agg(
        F.min("doc_id").alias("doc"))
    total = meta.agg(F.sum("n")).first()[0] or 0
    found = components(links_of(near_copies(texts, total, words, threshold), threshold))
    return meta, (nodes.join(found, "node", "left")
                  .select("node", "doc", F.coalesce("component", "node").alias("component")))


def jaccard_components(docs: DataFrame, words: int = WORDS, threshold: int = THRESHOLD) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id.

    Two documents link when ``100 * |A and B| >= threshold * |A or B|`` over their sets of
    ``words``-word shingles (all words as one shingle where there are fewer). ``component_id`` is
    the smallest doc_id that links reach. A null, empty or blank text has no shingle and no link: its
    component is itself. Rows with equal sets link, also where they share a doc_id; null doc_ids take part
    but name no component unless all of it is null. An empty input gives no row.
    """
    meta, members = placed_nodes(docs, words, threshold)
    smallest = members.groupBy("component").agg(F.min("doc").alias("component_id"))
    ids = members.join(smallest, "component").select(F.col("node").alias("key"), "component_id")
    # Rows without a set get keys of their own: an outer join doesn't gather them in one task.
    key = F.coalesce("node", F.xxhash64("doc_id"))
    return (meta.withColumn("key", key).join(ids, "key", "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
                    .alias("component_id")))


def keep_one(docs: DataFrame, words: int = WORDS, threshold: int = THRESHOLD) -> DataFrame:
    """One row of every component of ``jaccard_components``, that of the smallest doc_id (null last; of
    equal ones the smaller set hash, of rows that repeat both any one), and all rows without a shingle."""
    _, members = placed_nodes(docs, words, threshold)
    doc = F.col("doc")
    winners = members.groupBy("component").agg(
        F.min_by(F.struct("doc", "node"), F.struct(doc.isNull(), doc, F.col("node"))).alias("kept")
    ).select(F.col("kept.doc").alias("doc"), F.col("kept.node").alias("own"))
    keyed, doc_id = with_node(docs, words)
    met = keyed.filter("node IS NOT NULL").join(winners, (F.col("node") == F.col("own"))
                                                & doc_id.eqNullSafe(F.col("doc"))).drop("doc", "own")
    once = Window.partitionBy("node", doc_id).orderBy("node")
    kept = met.withColumn("nth", F.row_number().over(once)).filter("nth = 1").drop("nth")
    return kept.unionByName(keyed.filter("node IS NULL")).drop("node").toDF(*docs.columns)


def with_node(docs: DataFrame, words: int) -> tuple[DataFrame, "F.Column"]:
    """The rows, columns renamed c0, c1, ... so that no name clashes, with their node; and their doc_id."""
    bounded_batches(docs.sparkSession)
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    text, schema = docs.columns.index("text"), StructType([*plain.schema.fields, StructField("node", LongType())])
    arrow = to_arrow_schema(schema)

    def run(batches):
        for batch in batches:
            nodes = [node_of(shingles(x.as_py() or "", words)) for x in batch.column(text)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(nodes, pa.int64())], schema=arrow)
        tidy()

    return plain.mapInArrow(run, schema), F.col(f"c{docs.columns.index('doc_id')}").cast("bigint")
