import math
import random
import time

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from millrace.llm.pivot_search import pivot_top_k, search_block

VECTORS = "vec_id bigint, embedding array<float>, label int, spread string, dim string"


def brute(rows, k, every):
    usable = sorted({(i, tuple(math.floor(256 * x) for x in v)) for i, v in rows if i is not None and v
                     and all(x is not None and math.isfinite(x) for x in v)})
    out = []
    for i, q in usable:
        if i % every == 0:
            scores = sorted((-sum(a * b for a, b in zip(q, c)), j) for j, c in usable
                            if j != i and len(c) == len(q))[:k]
            out += [(i, n, j, -s) for n, (s, j) in enumerate(scores, 1)]
    return sorted(out)


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1, "a", "b") for i, v in rows], VECTORS)


def test_against_brute_force_in_small_blocks(spark):
    rng = random.Random(2)
    base = [[rng.choice([-.5, -.25, 0., .25, .125]) for _ in range(6)] for _ in range(40)]
    rows = [(i, base[i % 40] if i % 3 else [x + rng.choice([0., .0625]) for x in base[i % 40]])
            for i in range(300)]
    rows += [(900, None), (901, []), (910, [None] + [0.] * 5), (920, [math.nan] * 6),
             (930, [math.inf] * 6), (None, [1.] * 6), (940, [1., 2.]), (941, [1., 3.]), rows[3], rows[10]]
    for blocks in ((7, 50), (2048, 8192)):
        got = pivot_top_k(vectors(spark, rows), F.col("vec_id") % 10 == 0, 5, 256, 4, *blocks)
        assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got.collect()) == brute(rows, 5, 10)


def test_bounds_stop_the_search(spark):
    rng = random.Random(4)
    centres = [[rng.uniform(-1, 1) for _ in range(4)] for _ in range(10)]
    rows = []
    for i in range(6000):
        v = [c + rng.gauss(0, .01) for c in centres[i % 10]]
        norm = math.sqrt(sum(x * x for x in v))
        rows.append((i, [x / norm for x in v]))
    got = pivot_top_k(vectors(spark, rows), F.col("vec_id") % 500 == 0).collect()
    assert max(r.evaluated for r in got) < 3000


def test_few_rows(spark):
    assert pivot_top_k(vectors(spark, []), F.col("vec_id") % 2 == 0).count() == 0
    assert pivot_top_k(vectors(spark, [(0, [1.])]), F.col("vec_id") % 2 == 0).count() == 0
    got = pivot_top_k(vectors(spark, [(0, [1.]), (1, [1.]), (3, [1.])]), F.col("vec_id") % 2 == 0)
    assert [(r.vec_id, r.score) for r in got.orderBy("rank").collect()] == [(1, 65536), (3, 65536)]


def test_large_components(spark):
    rows = [(0, [30000., 1., -30000.]), (1, [-30000., 2., 30000.]), (2, [29999., 1., 0.]), (3, [0., 32000., 0.]), (5, [1., 1., 1.])]
    got = pivot_top_k(vectors(spark, rows), F.col("vec_id") % 2 == 0, 5)
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got.collect()) == brute(rows, 5, 2)
    for huge in (1e8, -1e20):
        with pytest.raises(PySparkException):
            pivot_top_k(vectors(spark, [(0, [huge]), (1, [1.])]), F.col("vec_id") % 2 == 0).collect()


def block(rng, n, dim, first=0):
    x = rng.integers(-200, 200, (n, dim))
    pivots = rng.integers(-200, 200, (48, dim))
    return {"vec_id": np.arange(first, first + n), "vector": x, "norm": (x * x).sum(axis=1),
            "distances": np.sqrt(((x[:, None].astype(float) - pivots[None]) ** 2).sum(axis=2))}


def test_a_block_without_clusters_costs_little():
    """Nearly every candidate of every query is evaluated: a bound for each would take 3 s."""
    rng = np.random.default_rng(1)
    candidates = block(rng, 8192, 64)
    queries = {name: x[::13] for name, x in candidates.items()}
    start = time.process_time()
    got = search_block(queries, candidates, 5)
    assert time.process_time() - start < 1.8
    want = []
    for q, x in zip(queries["vec_id"].tolist(), queries["vector"]):
        scores = sorted(zip((-(candidates["vector"] @ x)).tolist(), candidates["vec_id"].tolist()))
        want += [(q, j, -s) for s, j in [y for y in scores if y[1] != q][:5]]
    assert [x[:3] for x in got] == want
    assert max(x[3] for x in got) <= 8191
