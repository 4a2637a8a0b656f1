"""Threshold-scaled sketches of texts, in built-in functions only.

A sketch keeps every shingle hash below a fixed fraction of the hash range, so its size follows the
text's, sketches of parts merge into the sketch of the whole, and any two can be compared. Texts too
short to have ``LEAST`` hashes there keep their ``LEAST`` smallest; comparison goes up to the lower of
the two thresholds, below which both are whole.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import whole_text, written

WORDS = 5
FRACTION = 1 / 8
LEAST = 32
ALL = (1 << 63) - 1


def with_sketch(df: DataFrame, text: str, name: str, words: int = WORDS, fraction: float = FRACTION,
                least: int = LEAST) -> DataFrame:
    """Add ``name``: struct of hashes (sorted, distinct) and below (all hashes up to it are kept).

    Words are runs without white space, lower-cased. Fewer than ``words`` make one shingle; no words, none.
    """
    limit = F.lit(int(-(1 << 63) + fraction * (1 << 64)) - 1 if fraction < 1 else ALL)
    parts = F.filter(F.split(F.lower(text), r"\s+"), lambda x: x != "")
    df = df.withColumn(f"__w_{name}", F.transform(parts, lambda x: F.xxhash64(x)))
    hashes = F.col(f"__w_{name}")
    shingles = (F.when(F.size(hashes) >= words, F.transform(
        F.sequence(F.lit(0), F.size(hashes) - words),
        lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(words)])))
        .when(F.size(hashes) > 0, F.array(F.xxhash64(hashes)))
        .otherwise(F.array().cast("array<bigint>")))
    df = df.withColumn(f"__s_{name}", shingles)
    every = F.col(f"__s_{name}")
    df = df.withColumn(f"__k_{name}", F.array_sort(F.array_distinct(F.filter(every, lambda x: x <= limit))))
    kept = F.col(f"__k_{name}")
    df = df.withColumn(f"__l_{name}", F.when(F.size(kept) < least, F.slice(
        F.array_sort(F.array_distinct(every)), 1, least + 1)))
    low = F.col(f"__l_{name}")
    return df.withColumn(name, F.when(low.isNull(), F.struct(kept.alias("hashes"), limit.alias("below")))
                         .when(F.size(low) <= least, F.struct(low.alias("hashes"), F.lit(ALL).alias("below")))
                         .otherwise(F.struct(F.slice(low, 1, least).alias("hashes"),
                                             F.get(low, F.lit(least - 1)).alias("below")))
                         ).drop(*[f"__{x}_{name}" for x in "wskl"])


def as_text(sketch: str) -> Column:
    """A sketch as a string: threshold, then hashes, hexadecimal."""
    return F.concat_ws(":", F.lower(F.hex(f"{sketch}.below")), F.array_join(
        F.transform(f"{sketch}.hashes", lambda x: F.lower(F.hex(x))), "."))


def common_parts(a: str, b: str) -> tuple[Column, Column]:
    """Both sketches' hashes, where both are whole."""
    limit = F.least(F.col(f"{a}.below"), F.col(f"{b}.below"))
    return tuple(F.filter(f"{x}.hashes", lambda h: h <= limit) for x in (a, b))


def with_likeness(df: DataFrame, a: str, b: str, name: str) -> DataFrame:
    """Add the estimated Jaccard similarity; of two sketches without hashes: 1."""
    left, right = common_parts(a, b)
    df = df.withColumn("__a", left).withColumn("__b", right)
    both, total = F.size(F.array_intersect("__a", "__b")), F.size("__a") + F.size("__b")
    return df.withColumn(name, F.when(total == 0, F.lit(1.0)).otherwise(both / (total - both))).drop("__a", "__b")


def containment(a: str, b: str) -> Column:
    """Estimated share of a's shingles that b has; null where a has none to judge by."""
    left, right = common_parts(a, b)
    return F.when(F.size(left) > 0, F.size(F.array_intersect(left, right)) / F.size(left))


def merged(a: str, b: str) -> Column:
    """Sketch of two parts together (but for shingles across the cut)."""
    left, right = common_parts(a, b)
    return F.struct(F.array_sort(F.array_union(left, right)).alias("hashes"),
                    F.least(f"{a}.below", f"{b}.below").alias("below"))


RANGE_CHARS, MAX_RANGES = 1 << 22, 100_000  # characters of a range, about; more where that would be too many ranges
SAMPLED = 8                                 # sampled documents per range


def cuts_of(keys: DataFrame, range_chars: int) -> list[tuple[int, int]]:
    """First (doc_id, tie) of every range but the first, from a sample by content."""
    n, chars = keys.agg(F.count("*"), F.coalesce(F.sum("n_chars"), F.lit(0))).first()
    ranges = min(MAX_RANGES, n, -(-chars // range_chars))
    if ranges < 2:
        return []
    share = min(1.0, SAMPLED * ranges / n)
    chosen = F.xxhash64("doc_id", "tie") < int((share - 0.5) * (1 << 64)) if share < 1 else F.lit(True)
    sample = sorted(tuple(r) for r in keys.filter(chosen).select(first_id(), "tie", "n_chars").collect())
    step, reached, cuts = sum(x[2] for x in sample) / ranges, 0, []
    for doc_id, tie, size in sample:
        if reached >= step * (len(cuts) + 1):
            cuts.append((doc_id, tie))
        reached += size
    return sorted(set(cuts))


def first_id() -> Column:
    """Null ids come first."""
    return F.coalesce("doc_id", F.lit(-(1 << 63)))


def range_of(cuts: list[tuple[int, int]]) -> Column:
    """Number of cuts at or before (doc_id, tie): first among groups of cuts, then within one."""
    # Never a constant: the window and the join by range would lose their key.
    cuts = cuts or [((1 << 63) - 1, (1 << 63) - 1)]
    width = max(1, round(len(cuts) ** 0.5))
    groups = [cuts[i:i + width] for i in range(0, len(cuts), width)]
    key, cut = F.struct(first_id().alias("d"), F.col("tie").alias("t")), "struct<d:bigint,t:bigint>"

    def constant(value, kind: str) -> Column:
        return F.from_json(F.lit(json.dumps(value)), kind)

    def named(pairs):
        return [{"d": d, "t": t} for d, t in pairs]

    heads = constant(named(group[0] for group in groups), f"array<{cut}>")
    inner = constant([named(group) for group in groups], f"array<array<{cut}>>")
    group = F.size(F.filter(heads, lambda x: x <= key)) - 1
    within = F.size(F.filter(F.get(inner, group), lambda x: x <= key))
    return F.when(group < 0, F.lit(0)).otherwise(group * width + within)


def same_key(left: DataFrame, right: DataFrame, doc_id: str, tie: str) -> Column:
    return left["doc_id"].eqNullSafe(right[doc_id]) & (left["tie"] == right[tie])


def documents_once(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows with ``copies``: rows that repeat doc_id and text are one, collapsed in the map tasks; rows of other
    keys are not shuffled for it."""
    repeated = written(keys.groupBy("doc_id", "tie").agg(F.count("*").alias("copies")).filter("copies > 1")
                       .select(F.col("doc_id").alias("d"), F.col("tie").alias("t")), "repeated-keys")
    if repeated.isEmpty():
        return rows.withColumn("copies", F.lit(1).cast("bigint"))
    same = same_key(rows, repeated, "d", "t")
    once = rows.join(repeated, same, "left_semi").groupBy("doc_id", "tie").agg(
        F.first("text").alias("text"), F.first("n_chars").alias("n_chars"), F.count("*").alias("copies"))
    return rows.join(repeated, same, "left_anti").withColumn("copies", F.lit(1).cast("bigint")).unionByName(once)


def next_of_ranges(rows: DataFrame, keys: DataFrame, place: Column) -> DataFrame:
    """Per range the document after its last one (after the last range: the first document): range, what the
    last one wants of it, and its text."""
    key = F.struct(F.col("doc_id").alias("d"), F.col("tie").alias("t"), F.col("n_chars").alias("n"))
    ranges = keys.withColumn("range", place).groupBy("range").agg(F.min(key).alias("first"), F.max(key).alias("last"))
    order = Window.orderBy("range")  # over one row per range
    first = F.first("first").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    giver = ranges.withColumn("giver", F.coalesce(F.lead("first").over(order), first)).select(
        "range", F.col("giver.d").alias("d"), F.col("giver.t").alias("t"),
        F.floor(F.col("last.n") / 4).cast("int").alias("wanted"))
    giver = F.broadcast(giver)  # at most MAX_RANGES rows of four numbers
    return (rows.join(giver, same_key(rows, giver, "d", "t")).dropDuplicates(["range"])
            .select(F.col("range").alias("end_range"), F.substr("text", F.lit(1), "wanted").alias("end_beginning"),
                    F.col("text").alias("end_text")))


def fingerprints(docs: DataFrame, words: int = WORDS, fraction: float = FRACTION,
                 least: int = LEAST, range_chars: int = RANGE_CHARS) -> DataFrame:
    """Per row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text ends, for its last quarter, with the beginning of the next document in ascending
    doc_id (null first; rows of one doc_id by a hash of their texts; rows that repeat both are one document, and
    the only document follows itself). Null texts count as empty. An empty input gives no row.

    Texts are shuffled once, by ranges of that order; inside a range the next document is the next row, and
    only the document after a range's last one comes from elsewhere.
    """
    rows = docs.select(F.col("doc_id").cast("bigint"), whole_text().alias("text")).withColumn(
        "tie", F.xxhash64("text")).withColumn("n_chars", F.length("text").cast("bigint"))
    keys = written(rows.select("doc_id", "tie", "n_chars"), "document-keys")
    place = range_of(cuts_of(keys, range_chars))
    ends = with_sketch(next_of_ranges(rows, keys, place), "end_text", "end_sketch", words, fraction, least).drop("end_text")
    placed = documents_once(rows, keys).withColumn("range", place).repartition("range")
    order = Window.partitionBy("range").orderBy("doc_id", "tie")
    met = (with_sketch(placed, "text", "sketch", words, fraction, least)
           .withColumn("next_text", F.lead("text").over(order)).withColumn("next_sketch", F.lead("sketch").over(order)))
    out = met.join(ends, F.col("range") == F.col("end_range"))
    quarter = F.floor(F.col("n_chars") / 4).cast("int")
    beginning = F.when(F.col("next_sketch").isNull(), F.col("end_beginning")).otherwise(
        F.substr("next_text", F.lit(1), quarter))
    out = out.withColumn("edited", F.concat(
        F.substr("text", F.lit(1), F.col("n_chars").cast("int") - quarter), beginning)
    ).withColumn("next_sketch", F.coalesce("next_sketch", "end_sketch")).drop("next_text", "text", "end_beginning", "end_sketch")
    out = with_sketch(out, "edited", "edited_sketch", words, fraction, least)
    out = with_likeness(out, "sketch", "edited_sketch", "near_edited")
    out = with_likeness(out, "sketch", "next_sketch", "near_next")
    return out.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), "copies"))).select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        as_text("sketch").alias("fingerprint"), as_text("edited_sketch").alias("edited_fingerprint"),
        "near_edited", "near_next")
