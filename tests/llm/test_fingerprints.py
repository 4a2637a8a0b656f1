import hashlib
import random
import struct
from bisect import bisect_right

import xxhash
from cases import awkward_texts, frame
from pyspark.sql import functions as F

from millrace.llm import fingerprints as fp


def edited(text, after):
    cut = len(text) // 4
    return text[:len(text) - cut] + after[:cut]


def true_likeness(a, b):
    def grams(t):
        w = t.lower().split()
        return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    x, y = grams(a), grams(b)
    return len(x & y) / len(x | y) if x | y else 1.0


def test_edited_texts_and_likeness(spark):
    rng = random.Random(1)
    words = [f"w{i}" for i in range(3000)]
    texts = awkward_texts() + [" ".join(rng.choices(words, k=n)) for n in (3, 12, 60, 400, 2000, 6000)]
    docs = frame(spark, texts, list(range(0, 2 * len(texts), 2)), extra=True).repartition(3)
    got = sorted(fp.fingerprints(docs).collect())
    texts = [t or "" for t in texts]
    for i, (r, text) in enumerate(zip(got, texts)):
        after = texts[(i + 1) % len(texts)]
        new = edited(text, after)
        assert r.doc_id == 2 * i and r.n_chars == len(text)
        assert r.edited_sha256 == hashlib.sha256(new.encode()).hexdigest()
        if "\x1c" not in text + after and "\x85" not in text + after:
            assert abs(r.near_edited - true_likeness(text, new)) < .15
            assert abs(r.near_next - true_likeness(text, after)) < .15
    by_text = {}
    for r, text in zip(got, texts):
        assert by_text.setdefault(text, r.fingerprint) == r.fingerprint
    assert len(set(by_text.values())) >= len(by_text) - 3


def test_small_ranges_and_repeated_rows(spark):
    rng = random.Random(3)
    texts = [" ".join(rng.choices(["a", "bc", "def"], k=rng.randrange(1, 60))) for _ in range(300)]
    rows = [(None if i % 40 == 0 else i // 2 * 3, t) for i, t in enumerate(texts)] + [(7, texts[5])] * 150 + [(None, "n n")] * 3
    docs = frame(spark, [t for _, t in rows], [i for i, _ in rows], extra=True).repartition(5)
    whole = sorted(map(tuple, fp.fingerprints(docs).collect()), key=repr)
    assert len(whole) == len(rows) and sum(r[0] == 7 for r in whole) == 150
    cut = fp.fingerprints(docs, range_chars=300)
    keys = docs.select("doc_id", F.xxhash64("text").alias("tie"), F.length("text").alias("n_chars"))
    cuts = fp.cuts_of(keys, 300)
    for r in keys.withColumn("range", fp.range_of(cuts)).collect():
        assert r.range == bisect_right(cuts, (-(1 << 63) if r.doc_id is None else r.doc_id, r.tie))
    assert len(cuts) > 15
    assert sorted(map(tuple, cut.collect()), key=repr) == whole
    # Distinct documents in order, the texts of one id by Spark's hash of them.
    tie = {t: xxhash.xxh64_intdigest(t.encode(), 42) for t in texts + ["n n"]}
    signed = {t: v - (1 << 64) if v >> 63 else v for t, v in tie.items()}
    order = sorted(set(rows), key=lambda x: (x[0] is not None, x[0] or 0, signed[x[1]]))
    want = {}
    for (i, t), (_, after) in zip(order, order[1:] + order[:1]):
        want.setdefault((i, len(t)), set()).add(hashlib.sha256(edited(t, after).encode()).hexdigest())
    assert all(r[2] in want[r[0], r[1]] for r in whole)


def long_hash(values, seed=42):
    for v in values:
        seed = xxhash.xxh64_intdigest(struct.pack("<q", v), seed)
        seed_signed = seed - (1 << 64) if seed >> 63 else seed
    return seed_signed


def test_sketches_are_recomputed(spark):
    rng = random.Random(8)
    words = [f"W{i}" for i in range(900)]
    texts = [" ".join(rng.choices(words, k=n)) for n in (0, 1, 3, 5, 20, 36, 40, 250, 3000)]
    got = fp.with_sketch(frame(spark, texts), "text", "sketch").orderBy("doc_id").collect()
    limit = -(1 << 63) + (1 << 61) - 1
    for text, r in zip(texts, got):
        w = []
        for x in text.lower().split():
            h = xxhash.xxh64_intdigest(x.encode(), 42)
            w.append(h - (1 << 64) if h >> 63 else h)
        grams = {long_hash(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {long_hash(w)} if w else set()
        kept = sorted(h for h in grams if h <= limit)
        if len(kept) >= 32:
            assert (r.sketch.hashes, r.sketch.below) == (kept, limit)
        elif len(grams) <= 32:
            assert (r.sketch.hashes, r.sketch.below) == (sorted(grams), (1 << 63) - 1)
        else:
            assert (r.sketch.hashes, r.sketch.below) == (sorted(grams)[:32], sorted(grams)[31])


def test_only_repeated_null_and_no_rows(spark):
    one = fp.fingerprints(frame(spark, ["abcdefgh"], [4])).first()
    assert one.edited_sha256 == hashlib.sha256(b"abcdefab").hexdigest() and one.near_next == 1.0
    got = fp.fingerprints(frame(spark, ["abcd", "abcd", "wxyz", None], [None, None, 3, 9])).collect()
    assert sorted(r.edited_sha256 for r in got if r.doc_id is None) == [hashlib.sha256(b"abcw").hexdigest()] * 2
    assert len(got) == 4
    assert fp.fingerprints(frame(spark, [])).count() == 0


def test_containment_of_unequal_documents_and_merging(spark):
    rng = random.Random(2)
    words = [f"w{i}" for i in range(5000)]
    part, rest = (" ".join(rng.choices(words, k=n)) for n in (800, 9000))
    df = spark.createDataFrame([(part, rest, part + " " + rest)], "a string, b string, c string")
    for c in "abc":
        df = fp.with_sketch(df, c, f"s{c}")
    df = df.withColumn("m", fp.merged("sa", "sb"))
    r = fp.with_likeness(df, "m", "sc", "near").select(
        "near", fp.containment("sa", "sc").alias("within"), fp.containment("sa", "sb").alias("apart"),
        F.size("sb.hashes").alias("kept")).first()
    assert r.near > .99 and r.within > .98 and r.apart < .02
    assert abs(r.kept - 9000 / 8) < 120


def test_plan_is_native(spark):
    plan = fp.fingerprints(frame(spark, ["a b"]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
