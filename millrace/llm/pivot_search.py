"""Exact top-k by inner product with pivot-table elimination.

Every vector carries its distances to the same pivots. For a query q and a candidate c the largest
``|d(q, p) - d(c, p)|`` is a lower bound of their distance, which with both norms bounds their inner
product from above. Candidates near the same pivot stand together in tiles, whose ranges of distances bound all
their candidates at once. A query's tiles are evaluated in the order of that bound until no bound reaches the
k-th best score: the rest cannot enter the result, nor tie with it. The queries that evaluate a tile at the same
turn do so as one matrix product.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import arrow_schema, map_rows, written

PIVOTS = 48
QUERY_BLOCK = 2048
CANDIDATE_BLOCK = 8192
TILE = 256
LARGEST = 1 << 23
LOWEST = -(1 << 62)  # below every score
TABLE = ("vec_id bigint, dim int, vector array<bigint>, norm bigint, distances array<double>, "
         "is_query boolean, spread bigint")
HITS = "query_id bigint, vec_id bigint, score bigint, evaluated bigint"


def quantised(column: str, scale: int) -> "F.Column":
    """Components as ``floor(scale * x)``, computed as double. From ``LARGEST`` on they raise an error: sums of
    products would not stay exact."""
    def component(x):
        y = x.cast("double") * scale
        return F.when(F.abs(y) < LARGEST, F.floor(y)).otherwise(
            F.raise_error(F.lit(f"a component times {scale} reaches {LARGEST}")).cast("bigint"))
    return F.transform(column, component)


def usable(column: str) -> "F.Column":
    """Neither null nor empty, and all components finite."""
    return F.coalesce((F.size(column) > 0) & F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x)
                      & (F.abs(x.cast("double")) < float("inf"))), F.lit(False))


def pivot_table(vectors: DataFrame, pivots: dict[int, np.ndarray]) -> DataFrame:
    def start():
        def step(batch):
            if batch is None or not batch.num_rows:
                return
            ids, dims = batch["vec_id"].to_pylist(), batch["dim"].to_numpy()
            for dim in np.unique(dims):
                rows = np.flatnonzero(dims == dim)
                x = matrix(batch["vector"].take(pa.array(rows))).astype(np.float64)
                table = np.sqrt(np.stack([((x - p) ** 2).sum(axis=1) for p in pivots[dim]], axis=1))
                yield {"vec_id": [ids[i] for i in rows], "dim": [int(dim)] * len(rows),
                       "vector": list(x.astype(np.int64)), "norm": (x * x).sum(axis=1).astype(int),
                       "distances": list(table),
                       "is_query": batch["is_query"].take(pa.array(rows)).to_pylist(),
                       "spread": batch["spread"].take(pa.array(rows)).to_pylist()}
        return step
    return map_rows(vectors, TABLE, start)


def tiles_of(candidates: dict) -> tuple[np.ndarray, list[tuple[int, int]], tuple]:
    """(order, tiles as ranges of it, (lowest, highest) distances to pivots and largest norm of each)."""
    distances = candidates["distances"]
    nearest = distances.argmin(axis=1)
    order = np.lexsort((distances[np.arange(len(nearest)), nearest], nearest))
    starts = np.arange(0, len(order), TILE)
    distances = distances[order]
    bounds = (np.minimum.reduceat(distances, starts), np.maximum.reduceat(distances, starts),
              np.maximum.reduceat(candidates["norm"][order], starts).astype(np.float64))
    return order, [(int(x), min(int(x) + TILE, len(order))) for x in starts], bounds


def tile_bounds(queries: dict, lowest: np.ndarray, highest: np.ndarray, norms: np.ndarray) -> np.ndarray:
    """Per query and tile what no inner product of the two exceeds. Scores are integers; the bounds' rounding is
    far below 0.5 or, for large norms, the share of them that is added."""
    gap = np.zeros((len(queries["vec_id"]), len(norms)))
    for p in range(lowest.shape[1]):
        own = queries["distances"][:, p, None]
        np.maximum(gap, lowest[None, :, p] - own, gap)
        np.maximum(gap, own - highest[None, :, p], gap)
    own = queries["norm"].astype(np.float64)
    return ((own[:, None] + norms[None] - gap * gap) / 2 + 0.5
            + 1e-9 * (own[:, None] + norms.max(initial=0)))


def search_block(queries: dict, candidates: dict, k: int) -> list[tuple]:
    """Top k of each query among the candidates of a block, tiles in bound order."""
    order, tiles, bounds = tiles_of(candidates)
    ids = candidates["vec_id"][order]
    bound = tile_bounds(queries, *bounds)
    turn = np.argsort(-bound, axis=1, kind="stable")
    sides = queries["vector"], candidates["vector"][order]
    largest = [float(np.abs(x).max(initial=0)) for x in sides]
    # Doubles are multiplied faster, and as exactly while every sum stays below 2^53.
    kind = np.float64 if largest[0] * largest[1] * sides[0].shape[1] < 1 << 53 else np.int64
    left, right = (x.astype(kind) for x in sides)
    own = np.isin(ids, queries["vec_id"])
    best: list[list] = [[] for _ in range(len(left))]
    reached = np.full(len(left), LOWEST, kind)  # the k-th best score
    evaluated = np.zeros(len(left), np.int64)
    active = np.arange(len(left))
    for nth in range(len(tiles)):
        active = active[bound[active, turn[active, nth]] >= reached[active]]
        chosen = turn[active, nth]
        for t in np.unique(chosen).tolist():
            rows, (low, high) = active[chosen == t], tiles[t]
            scores = left[rows] @ right[low:high].T
            evaluated[rows] += high - low
            for column in np.flatnonzero(own[low:high]):
                mine = queries["vec_id"][rows] == ids[low + column]
                scores[mine, column] = LOWEST
                evaluated[rows[mine]] -= 1
            least = reached[rows]
            if high - low > k and (least == LOWEST).any():
                least = np.maximum(least, np.partition(scores, -k, axis=1)[:, -k])
            hit = (scores >= least[:, None]) & (scores > LOWEST)
            row, column = np.nonzero(hit)
            cuts = np.searchsorted(row, np.arange(len(rows) + 1)).tolist()
            found = list(zip((-scores[row, column]).tolist(), ids[low + column].tolist()))
            for i, q in enumerate(rows.tolist()):
                if cuts[i] < cuts[i + 1]:
                    best[q] = sorted(best[q] + found[cuts[i]:cuts[i + 1]])[:k]
                    if len(best[q]) == k:
                        reached[q] = -best[q][-1][0]
    return [(int(queries["vec_id"][q]), vec_id, int(-score), int(evaluated[q]))
            for q in range(len(left)) for score, vec_id in best[q]]


def matrix(column) -> np.ndarray:
    """Lists of equal length as rows."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def as_arrays(table: pa.Table) -> dict:
    return {"vec_id": table["vec_id"].to_numpy(), "norm": table["norm"].to_numpy(),
            "vector": matrix(table["vector"]), "distances": matrix(table["distances"])}


def pivot_top_k(vectors: DataFrame, is_query: "F.Column", k: int = 5, scale: int = 256,
                n_pivots: int = PIVOTS, query_block: int = QUERY_BLOCK,
                candidate_block: int = CANDIDATE_BLOCK) -> DataFrame:
    """Per query its k best candidates: query_id, rank, vec_id, score, evaluated.

    ``vectors`` has vec_id and embedding. Null, empty or non-finite vectors and null ids take no
    part; vectors meet those of their own length only. Equal rows count once; a row whose vec_id is
    the query's is no candidate. Ties go to the smaller vec_id; an empty input gives no row.
    Queries and candidates meet in blocks of bounded size, every query block with every candidate
    block once. ``evaluated`` counts the candidates whose score was computed.
    """
    spark = vectors.sparkSession
    rows = (vectors.filter(F.col("vec_id").isNotNull() & usable("embedding"))
            .select(F.col("vec_id").cast("bigint"), quantised("embedding", scale).alias("vector"))
            .distinct()
            .select("vec_id", F.size("vector").alias("dim"), "vector",
                    F.coalesce(is_query, F.lit(False)).alias("is_query"),
                    F.xxhash64("vec_id", "vector").alias("spread")))
    dims = {r["dim"]: r for r in rows.groupBy("dim").agg(
        F.count("*").alias("n"), F.count_if("is_query").alias("queries")).collect()}
    # A bounded number of vectors, the first by hash, serve as pivots.
    pivots = {dim: np.array([r["vector"] for r in rows.filter(F.col("dim") == dim)
                             .orderBy("spread", "vec_id").limit(n_pivots).collect()], np.float64)
              for dim in dims}
    table = written(pivot_table(rows, pivots), "pivot-table")

    def blocks(dim: int, name: str, size: int) -> int:
        return -(-dims[dim][name] // size)

    count = {dim: (max(1, blocks(dim, "queries", query_block)), blocks(dim, "n", candidate_block))
             for dim in dims}
    sizes = spark.createDataFrame([(d, q, c) for d, (q, c) in count.items()],
                                  "dim int, query_blocks int, candidate_blocks int")
    placed = (table.join(F.broadcast(sizes), "dim")
              .withColumn("qb", F.pmod("spread", "query_blocks"))
              .withColumn("cb", F.pmod(F.shiftright("spread", 20), "candidate_blocks")))
    queries = (placed.filter("is_query")
               .withColumn("cb", F.explode(F.sequence(F.lit(0), F.col("candidate_blocks") - 1)))
               .select(*[F.col(c).cast("bigint").alias(c) for c in ("dim", "qb", "cb")],
                       *[F.col(c).alias(c) for c in ("vec_id", "vector", "norm", "distances")]))
    candidates = (placed
                  .withColumn("qb", F.explode(F.sequence(F.lit(0), F.col("query_blocks") - 1)))
                  .select(*[F.col(c).cast("bigint").alias(c) for c in ("dim", "qb", "cb")],
                          "vec_id", "vector", "norm", "distances"))
    schema = arrow_schema(spark, HITS)

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        hits = []
        if left.num_rows and right.num_rows:
            hits = search_block(as_arrays(left), as_arrays(right), k)
        return pa.Table.from_arrays(
            [pa.array(list(x), pa.int64()) for x in zip(*hits)] or [pa.array([], pa.int64())] * 4,
            schema=schema)

    found = (queries.groupBy("dim", "qb", "cb")
             .cogroup(candidates.groupBy("dim", "qb", "cb")).applyInArrow(search, HITS))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    # A vec_id with several vectors counts once per score.
    return (found.groupBy("query_id", "vec_id", "score").agg(F.sum("evaluated").alias("evaluated"))
            .withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score", "evaluated"))
