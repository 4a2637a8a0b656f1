import math
import random

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from millrace.llm import hard_negatives as h

VECTORS = "vec_id bigint, embedding array<float>, label int, home string, uid string, w int, anchor string, norm int"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, label, "a", "b", 1, "c", 2) for i, v, label in rows], VECTORS)


def mined(df, every=10, **options):
    got = h.hard_negatives(df, F.col("vec_id") % every == 0, F.col("label"), **options)
    return sorted(tuple(r)[:6] for r in got.collect())


def brute(rows, every=10, positives=5, negatives=10):
    usable = sorted({(i, label, tuple(math.floor(256 * float(np.float32(x))) for x in v)) for i, v, label in rows
                     if i is not None and label is not None and v and all(x is not None and math.isfinite(x) for x in v)})
    out = []
    for i, label, q in usable:
        if i % every:
            continue
        scores = [(-sum(a * b for a, b in zip(q, c)), j, other == label) for j, other, c in usable
                  if j != i and len(c) == len(q)]
        for p, positive in sorted((s, j) for s, j, same in scores if same)[:positives]:
            found = sorted((s, j) for s, j, same in scores if not same and 30 * -p <= 100 * -s <= 90 * -p)[:negatives]
            out += [(i, positive, n, j, -p, -s) for n, (s, j) in enumerate(found, 1)]
    return sorted(out)


def clustered(n, dim, seed, centres=12):
    rng = random.Random(seed)
    middles = [[rng.uniform(-1, 1) for _ in range(dim)] for _ in range(centres)]
    return [(i, [c + rng.choice([0., 0., .125, -.25]) for c in middles[i % centres]], rng.randrange(4)) for i in range(n)]


def test_against_brute_force_in_small_blocks(spark):
    rows = clustered(500, 6, 1)
    # Copies: a third of all rows have one vector; ties everywhere.
    rows += [(1000 + i, rows[3][1], i % 5) for i in range(250)]
    rows += [(2000, None, 1), (2010, [], 1), (2020, [math.nan] * 6, 1), (2030, [1.] * 6, None), (None, [1.] * 6, 1),
             (2040, [math.inf] + [1.] * 5, 1), (2050, [None] * 6, 1), (2060, [1., 2.], 1), (2061, [1., 3.], 2),
             (2062, [2., 3.], 1), (2070, [0.] * 6, 1), rows[0], rows[7]]
    want = brute(rows)
    assert len(want) > 1000
    for block, query_block in ((40, 7), (8192, 8192)):
        assert mined(vectors(spark, rows).repartition(3), block=block, query_block=query_block) == want


def test_negative_scores_have_no_window(spark):
    rows = [(0, [1., 0.], 1), (1, [-1., .5], 1), (2, [-.5, 0.], 2), (3, [-.7, 0.], 2)]
    assert mined(vectors(spark, rows)) == brute(rows) == []


def test_bounds_skip_most_points_of_clustered_data(spark):
    rng = random.Random(4)
    centres = [[rng.uniform(-1, 1) for _ in range(4)] for _ in range(40)]
    rows = []
    for i in range(6000):
        v = [c + rng.gauss(0, .01) for c in centres[i % 40]]
        norm = math.sqrt(sum(x * x for x in v))
        rows.append((i, [x / norm for x in v], (i % 40) % 3))
    got = h.hard_negatives(vectors(spark, rows), F.col("vec_id") % 500 == 0, F.col("label"), block=1000).collect()
    assert sorted(tuple(r)[:6] for r in got) == brute(rows, 500)
    assert sum(r.evaluated for r in got) / len(got) < 1500


def test_cover_tree_invariants():
    x = np.random.default_rng(1).normal(size=(900, 5)).round(1) * 50
    x[100:400] = x[100]
    m2 = float((x * x).sum(1).max())
    tree = h.cover_tree(x, m2, leaf=8, fanout=6)
    assert sorted(tree["order"].tolist()) == list(range(900))
    lifted = np.c_[x, np.sqrt(np.maximum(m2 - (x * x).sum(1), 0))]
    for (a, b), centre, radius, (first, last) in zip(tree["spans"], tree["centres"], tree["radii"], tree["children"]):
        own = tree["order"][a:b]
        assert centre in own and np.linalg.norm(lifted[own] - lifted[centre], axis=1).max() <= radius
        if first < last:
            parts = tree["spans"][first:last]
            assert parts[0][0] == a and parts[-1][1] == b and (parts[1:, 0] == parts[:-1, 1]).all()
            heads = lifted[tree["centres"][first:last]]
            apart = np.linalg.norm(heads[:, None] - heads[None], axis=2)[~np.eye(last - first, dtype=bool)]
            assert apart.min() > (radius - 1e-5) / h.RATIO


def test_few_rows_and_large_components(spark):
    assert mined(vectors(spark, [])) == []
    assert mined(vectors(spark, [(1, [1.], 1)])) == []
    assert mined(vectors(spark, [(0, [1.], 1), (1, [1.], 1)])) == []
    big = [(0, [30000., 1.], 1), (1, [30000., 5.], 1), (2, [20000., 0.], 2), (3, [9000., 7.], 2)]
    assert mined(vectors(spark, big)) == brute(big) != []
    with pytest.raises(PySparkException):
        mined(vectors(spark, [(0, [1e6], 1), (1, [1.], 1)]))


@pytest.mark.parametrize("same", [True, False])
def test_queries_search_a_tree_together(same):
    rng = np.random.default_rng(7)
    x = rng.integers(-60, 60, (3000, 8)).astype(float)
    x[500:1300] = x[500]  # more copies than a tile holds
    ids, labels, m2 = rng.permutation(3000), rng.integers(0, 3, 3000), float((x * x).sum(1).max())
    tree = h.cover_tree(x, m2)
    order = tree.pop("order")
    tree |= {"centres": x[tree["centres"]], "x": x[order], "ids": ids[order], "labels": labels[order]}
    leaves, tiles, first = h.tiles_of(tree)
    sizes = np.diff(tiles, axis=1)[:, 0]
    assert sizes.min() > 0 and sizes.max() <= h.LEAF
    assert tiles[0, 0] == 0 and tiles[-1, 1] == 3000 and (tiles[1:, 0] == tiles[:-1, 1]).all()
    assert len(tiles) < len(leaves) / 2
    asked = np.r_[0:40, 500:520]
    own = labels[asked]
    own[3] = 9  # a label no point has
    low = np.tile([-(1 << 62), 3000, 1 << 62], (60, 1))
    high = np.tile([1 << 62, 9000, -(1 << 62)], (60, 1))
    best, evaluated = h.search(tree, m2, x[asked], (x[asked] ** 2).sum(1), ids[asked], own, low, high, 5, same)
    for i, q in enumerate(asked):
        scores = (x @ x[q]).astype(int).tolist()
        allowed = [(-s, int(j)) for s, j, label in zip(scores, ids, labels) if (label == own[i]) == same and j != ids[q]]
        for w in range(3):
            want = sorted(p for p in allowed if low[i, w] <= -p[0] <= high[i, w])[:5]
            found = [(-int(s), int(j)) for s, j in zip(best.scores[3 * i + w], best.ids[3 * i + w]) if s > h.LOWEST]
            assert found == want
    assert evaluated.max() <= 3000 and evaluated.sum() < 60 * 3000
