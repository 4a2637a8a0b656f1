"""Hard negatives by inner product, from cover trees over norm-augmented vectors.

With one component more, ``sqrt(m2 - |x|^2)``, all candidates of a length lie on a sphere and a query, with a
zero there, is the nearer to a candidate the larger their inner product. Candidates belong to the nearest of
a bounded number of landmarks; every landmark's candidates, in blocks of bounded size, become cover trees:
a node's children are centres more than its covering radius, divided by ``RATIO``, apart. The radius around a
node's centre bounds from both sides the inner products a query can have below it, and below its children no more
than that. Leaves of the same parent stand together in tiles, which a query takes best first, in turns of doubling
length; tiles above or below all its windows are skipped, and so is everything that no longer reaches the k-th score
so far. The queries that take a tile in the same turn verify its points as one product of exact integers.

A query first searches the blocks of its own landmark; with the scores found there it then goes only to those
landmarks whose bounds can still matter.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import arrow_schema, written
from millrace.llm.pivot_search import usable

BLOCK, QUERY_BLOCK = 8192, 8192  # candidates of a tree, queries that meet it in one task, about
LANDMARKS = 1024                 # at most, per vector length
LEAF, FANOUT, RATIO = 256, 32, 1.3  # points of a leaf or tile, about
TOGETHER = 1024                  # queries that search a tree at once
LARGEST = 1 << 23                # components beyond raise: sums of products must be exact
LOWEST = -(1 << 62)

POINT = "vec_id bigint, label bigint, dim int, vector array<int>, norm bigint, anchor boolean, uid bigint"
HOMED = POINT + ", home int, distance double"
WINDOWS = "array<struct<w:int,low:bigint,high:bigint,least:bigint>>"
TREE = "dim int, home int, sub int, tree binary"
HIT = "uid bigint, w int, vec_id bigint, score bigint, evaluated bigint"


def prepared(vectors: DataFrame, anchor: "F.Column", label: "F.Column", scale: int) -> DataFrame:
    def component(x):
        y = F.floor(x.cast("double") * scale)
        return F.when(F.abs(x.cast("double")) * scale < LARGEST, y).otherwise(
            F.raise_error(F.lit(f"a component times {scale} reaches {LARGEST}")).cast("bigint")).cast("int")

    return (vectors.withColumn("label", label)
            .filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable("embedding"))
            .select(F.col("vec_id").cast("bigint"), F.col("label").cast("bigint"),
                    F.size("embedding").alias("dim"), F.transform("embedding", component).alias("vector"),
                    F.coalesce(anchor, F.lit(False)).alias("anchor"))
            .distinct()
            .withColumn("norm", F.aggregate("vector", F.lit(0).cast("bigint"),
                                            lambda s, x: s + x.cast("bigint") * x))
            .withColumn("uid", F.xxhash64("vec_id", "label", "vector"))
            .select(*[c.split()[0] for c in POINT.split(", ")]))


def matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def homed(points: DataFrame, landmarks: dict[int, np.ndarray], m2: dict[int, int]) -> DataFrame:
    """Points with their nearest landmark (of their length) and its distance, after augmentation."""
    schema = arrow_schema(points.sparkSession, HOMED)

    def run(batches):
        for batch in batches:
            dims = batch["dim"].to_numpy()
            for dim in np.unique(dims).tolist():
                part = batch.take(pa.array(np.flatnonzero(dims == dim)))
                x, norm = matrix(part["vector"], dim), part["norm"].to_numpy().astype(np.float64)
                marks = landmarks[dim]
                lifted = np.sqrt(np.maximum(m2[dim] - norm, 0))
                height = np.sqrt(np.maximum(m2[dim] - (marks * marks).sum(1), 0))
                near = 2 * (m2[dim] - x @ marks.T - lifted[:, None] * height)
                home = near.argmin(1)
                exact = np.sqrt(((x - marks[home]) ** 2).sum(1) + (lifted - height[home]) ** 2)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(home.astype(np.int32)), pa.array(exact)],
                                                 schema=schema)
    return points.mapInArrow(run, HOMED)


def cover_tree(x: np.ndarray, m2: float, leaf: int = LEAF, fanout: int = FANOUT) -> dict:
    """Nodes in breadth-first order. ``order`` lists the points so that every node's are together."""
    lifted = np.c_[x, np.sqrt(np.maximum(m2 - (x * x).sum(1), 0))]

    def distances(points, centre):
        return np.sqrt(((lifted[points] - lifted[centre]) ** 2).sum(1))

    order = np.arange(len(x))
    middle = ((lifted - lifted.mean(0)) ** 2).sum(1).argmin()
    spans, centres, radii, children = [(0, len(x))], [int(middle)], [], []
    at = 0
    while at < len(spans):
        begin, end = spans[at]
        members = order[begin:end]
        near = distances(members, centres[at])
        radius = near.max()
        radii.append(radius * (1 + 1e-9) + 1e-6)
        children.append((len(spans), len(spans)))
        if end - begin > leaf and radius > 0:
            own, owner = [centres[at]], np.zeros(len(members), int)
            while near.max() > radius / RATIO and len(own) < fanout:
                own.append(int(members[near.argmax()]))
                from_new = distances(members, own[-1])
                closer = from_new < near
                owner[closer] = len(own) - 1
                near[closer] = from_new[closer]
            order[begin:end] = members[np.argsort(owner, kind="stable")]
            cuts = begin + np.r_[0, np.cumsum(np.bincount(owner, minlength=len(own)))]
            spans += [(int(a), int(b)) for a, b in zip(cuts, cuts[1:])]
            centres += own
            children[at] = (children[at][0], len(spans))
        at += 1
    return {"order": order, "spans": np.array(spans), "centres": np.array(centres),
            "radii": np.array(radii), "children": np.array(children)}


def trees_of(placed: DataFrame, m2: dict[int, int]) -> DataFrame:
    schema = arrow_schema(placed.sparkSession, TREE)

    def build(table: pa.Table) -> pa.Table:
        dim, home, sub = (table[c][0].as_py() for c in ("dim", "home", "sub"))
        x = matrix(table["vector"], dim)
        tree = cover_tree(x, float(m2[dim]))
        order = tree.pop("order")
        tree |= {"centres": x[tree["centres"]].astype(np.int32), "x": x[order].astype(np.int32),
                 "ids": table["vec_id"].to_numpy()[order], "labels": table["label"].to_numpy()[order]}
        return pa.table([[dim], [home], [sub], [pickle.dumps(tree)]], schema=schema)

    return placed.groupBy("dim", "home", "sub").applyInArrow(build, TREE)


def tiles_of(tree: dict, most: int = LEAF) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(leaves in the order of their points, (begin, end) of tiles, first leaf of each). A tile is a run of leaves of one
    parent, or a piece of a leaf, of at most ``most`` points."""
    spans, children = tree["spans"], tree["children"]
    inner = children[:, 0] < children[:, 1]
    parent = np.full(len(spans), -1)
    for node in np.flatnonzero(inner):
        parent[slice(*children[node])] = node
    leaves = np.flatnonzero(~inner)
    leaves = leaves[np.argsort(spans[leaves, 0])]
    tiles, first = [], []
    for i, leaf in enumerate(leaves):
        begin, end = spans[leaf].tolist()
        if tiles and parent[leaf] == parent[leaves[i - 1]] and end - tiles[-1][0] <= most:
            tiles[-1][1] = end
        else:
            for a in range(begin, end, most):
                tiles.append([a, min(a + most, end)])
                first.append(i)
    return leaves, np.array(tiles), np.array(first)


def bounds(dots: np.ndarray, radii: np.ndarray, norm: float | np.ndarray, m2: float) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest inner product below centres, from the query's products with them."""
    total = norm + m2
    distance = np.sqrt(np.maximum(total - 2 * dots, 0))
    slack = 1 + 1e-9 * total
    nearest, furthest = np.maximum(distance - radii, 0), distance + radii
    return (total - furthest ** 2) / 2 - slack, (total - nearest ** 2) / 2 + slack


def tile_bounds(tree: dict, q: np.ndarray, norms: np.ndarray, m2: float, leaves: np.ndarray,
                first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per query and tile the least and largest inner product, from its leaves and all nodes above them."""
    lower, upper = bounds(q @ tree["centres"].astype(np.float64).T, tree["radii"], norms[:, None], m2)
    for node, (begin, end) in enumerate(tree["children"].tolist()):
        if begin < end:
            np.minimum(upper[:, begin:end], upper[:, node, None], upper[:, begin:end])
            np.maximum(lower[:, begin:end], lower[:, node, None], lower[:, begin:end])
    return np.minimum.reduceat(lower[:, leaves], first, axis=1), np.maximum.reduceat(upper[:, leaves], first, axis=1)


class Best:
    """The k best (score, id) of each of some windows, ties to smaller ids."""

    def __init__(self, windows: int, k: int, kind: type):
        self.scores = np.full((windows, k), LOWEST, kind)
        self.ids = np.full((windows, k), np.iinfo(np.int64).max)

    def add(self, window: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Windows that got something."""
        k = self.scores.shape[1]
        by = np.lexsort((ids, -scores, window))
        window, scores, ids = window[by], scores[by], ids[by]
        starts = np.flatnonzero(np.diff(window, prepend=-1))
        sizes = np.diff(starts, append=len(window))
        nth = np.arange(len(window)) - np.repeat(starts, sizes)
        kept, own = nth < k, window[starts]
        at = np.repeat(np.arange(len(own)), sizes)[kept], k + nth[kept]
        all_scores = np.c_[self.scores[own], np.full((len(own), k), LOWEST, self.scores.dtype)]
        all_ids = np.c_[self.ids[own], np.full((len(own), k), np.iinfo(np.int64).max)]
        all_scores[at], all_ids[at] = scores[kept], ids[kept]
        by = np.lexsort((all_ids, -all_scores), axis=-1)[:, :k]
        self.scores[own] = np.take_along_axis(all_scores, by, 1)
        self.ids[own] = np.take_along_axis(all_ids, by, 1)
        return own


def search(tree: dict, m2: float, q: np.ndarray, norms: np.ndarray, vec_ids: np.ndarray, labels: np.ndarray,
           low: np.ndarray, high: np.ndarray, k: int, same: bool) -> tuple[Best, np.ndarray]:
    """Of queries (rows) and their windows the k best points with the query's label, or with others, and how many
    points each query verified. ``low`` and ``high`` have a row per query; windows with low > high are empty."""
    exact = np.float64 if m2 < 2 ** 52 else np.int64
    leaves, tiles, first = tiles_of(tree)
    lower, upper = tile_bounds(tree, q, norms, m2, leaves, first)
    kinds, kind = np.unique(tree["labels"], return_inverse=True)
    own_kind = np.searchsorted(kinds, labels)
    known = kinds[np.minimum(own_kind, len(kinds) - 1)] == labels
    sizes = np.diff(tiles, axis=1)[:, 0]
    for t, (begin, end) in enumerate(tiles.tolist()):  # a tile is a chance only where allowed points lie in it
        count = np.bincount(kind[begin:end], minlength=len(kinds) + 1)
        alike = np.where(known, count[own_kind], 0)
        upper[(alike if same else sizes[t] - alike) == 0, t] = -np.inf
    turn = np.argsort(np.argsort(-upper, axis=1, kind="stable"), axis=1)
    need, high = low.astype(exact), high.astype(exact)
    reached, n_windows = need.reshape(-1), need.shape[1]
    best, evaluated = Best(need.size, k, exact), np.zeros(len(q), np.int64)
    points, q = tree["x"].astype(exact), q.astype(exact)
    since, until = 0, 1
    while since < len(tiles):
        for t, (begin, end) in enumerate(tiles.tolist()):
            rows = np.flatnonzero((turn[:, t] >= since) & (turn[:, t] < until))
            chance = (need[rows] <= upper[rows, t, None]) & (high[rows] >= lower[rows, t, None])
            rows = rows[chance.any(1)]
            if not len(rows):
                continue
            evaluated[rows] += end - begin
            scores = q[rows] @ points[begin:end].T
            row, point = np.nonzero((scores >= need[rows].min(1)[:, None]) & (scores <= high[rows].max(1)[:, None]))
            scores, row, point = scores[row, point], rows[row], point + begin
            allowed = ((tree["labels"][point] == labels[row]) == same) & (tree["ids"][point] != vec_ids[row])
            scores, row, point = scores[allowed], row[allowed], point[allowed]
            hit, window = np.nonzero((scores[:, None] >= need[row]) & (scores[:, None] <= high[row]))
            if len(hit):
                own = best.add(row[hit] * n_windows + window, scores[hit], tree["ids"][point[hit]])
                reached[own] = np.maximum(reached[own], best.scores[own, -1])
        since, until = until, 2 * until
    return best, evaluated


class Trees:
    """What is fixed for a search: landmarks, sizes, and the trees' table."""

    def __init__(self, points: DataFrame, block: int, query_block: int):
        self.spark, self.query_block = points.sparkSession, query_block
        stats = {r["dim"]: r for r in points.groupBy("dim").agg(
            F.count("*").alias("n"), F.max("norm").alias("m2"), F.count_if("anchor").alias("anchors")).collect()}
        self.m2 = {dim: r["m2"] for dim, r in stats.items()}
        self.parts = {dim: max(1, -(-r["anchors"] // query_block)) for dim, r in stats.items()}
        marks = {dim: min(LANDMARKS, -(-r["n"] // block)) for dim, r in stats.items()}
        # Landmarks: the first by hash among a share of the points that holds enough of them.
        sizes = self.spark.createDataFrame(
            [(d, marks[d], min(1.0, 16 * marks[d] / r["n"] + 1e-6)) for d, r in stats.items()],
            "dim int, marks int, share double")
        first = Window.partitionBy("dim").orderBy("spread", "uid")
        chosen = (points.join(F.broadcast(sizes), "dim").withColumn("spread", F.xxhash64("uid"))
                  .filter((F.col("share") >= 1) | (F.col("spread") / 2.0 ** 64 + 0.5 < F.col("share")))
                  .withColumn("nth", F.row_number().over(first)).filter("nth <= marks")
                  .select("dim", "vector").collect())
        self.landmarks = {dim: np.array([r["vector"] for r in chosen if r["dim"] == dim], np.float64).reshape(-1, dim)
                          for dim in stats}
        for dim, rows in self.landmarks.items():
            if not len(rows):  # a share without rows: the origin serves
                self.landmarks[dim] = np.zeros((1, dim))
        placed = written(homed(points, self.landmarks, self.m2), "homed-points")
        around = placed.groupBy("dim", "home").agg(F.count("*").alias("n"), F.max("distance").alias("radius")).collect()
        self.subs = {(r["dim"], r["home"]): -(-r["n"] // block) for r in around}
        self.radii = {dim: np.full(len(rows), -1.0) for dim, rows in self.landmarks.items()}
        for r in around:
            self.radii[r["dim"]][r["home"]] = r["radius"] * (1 + 1e-9) + 1e-6
        subs = self.spark.createDataFrame([(*k, n) for k, n in self.subs.items()], "dim int, home int, subs int")
        dealt = (placed.join(F.broadcast(subs), ["dim", "home"])
                 .withColumn("sub", F.pmod("uid", "subs").cast("int")))
        self.anchors = placed.filter("anchor").drop("anchor", "distance")
        parts = F.broadcast(self.spark.createDataFrame(list(self.parts.items()), "dim int, parts int"))
        built = written(trees_of(dealt, self.m2), "cover-trees")
        # Queries of a block meet it in parts of bounded size.
        self.table = (built.join(parts, "dim").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
                      .drop("parts"))

    def met(self, queries: DataFrame, k: int, same: bool, at_home: bool) -> DataFrame:
        """Hits of the queries in the blocks of their own landmark, or of all others that can matter."""
        landmarks, radii, subs, m2, parts = self.landmarks, self.radii, self.subs, self.m2, self.parts
        columns = ["uid", "vec_id", "label", "dim", "vector", "norm", "home", "windows"]
        sent = ("uid bigint, vec_id bigint, label bigint, dim int, vector array<int>, norm bigint, "
                f"home int, windows {WINDOWS}, sub int, part int")
        sent_schema, hit_schema = arrow_schema(self.spark, sent), arrow_schema(self.spark, HIT)

        def targets(row: dict) -> list[int]:
            if at_home:
                return [row["home"]]
            dim = row["dim"]
            lower, upper = bounds(landmarks[dim] @ np.array(row["vector"], np.float64), radii[dim], row["norm"], m2[dim])
            fit = np.zeros(len(lower), bool)
            for w in row["windows"]:
                fit |= (upper >= max(w["low"], w["least"])) & (lower <= w["high"])
            fit &= radii[dim] >= 0
            fit[row["home"]] = False
            return np.flatnonzero(fit).tolist()

        def route(batches):
            for batch in batches:
                which, home, sub, part = [], [], [], []
                for i, row in enumerate(batch.to_pylist()):
                    for mark in targets(row):
                        for s in range(subs[row["dim"], mark]):
                            which.append(i), home.append(mark), sub.append(s)
                            part.append(row["uid"] % parts[row["dim"]])
                rows = batch.take(pa.array(which, pa.int64()))
                values = {c: rows[c] for c in columns} | {
                    "home": pa.array(home, pa.int32()), "sub": pa.array(sub, pa.int32()), "part": pa.array(part, pa.int32())}
                yield pa.RecordBatch.from_arrays([values[f.name].cast(f.type) for f in sent_schema], schema=sent_schema)

        def match(asked: pa.Table, table: pa.Table) -> pa.Table:
            hits = []
            if asked.num_rows and table.num_rows:
                tree, dim = pickle.loads(table["tree"][0].as_py()), asked["dim"][0].as_py()
                for begin in range(0, asked.num_rows, TOGETHER):
                    part = asked.slice(begin, TOGETHER)
                    windows = part["windows"].to_pylist()
                    most = max(map(len, windows), default=0)
                    low, high, name = (np.full((len(windows), most), x, np.int64) for x in (-LOWEST, LOWEST, 0))
                    for i, own in enumerate(windows):
                        low[i, :len(own)] = [max(w["low"], w["least"]) for w in own]
                        high[i, :len(own)] = [w["high"] for w in own]
                        name[i, :len(own)] = [w["w"] for w in own]
                    best, evaluated = search(
                        tree, float(m2[dim]), matrix(part["vector"], dim), part["norm"].to_numpy().astype(np.float64),
                        part["vec_id"].to_numpy(), part["label"].to_numpy(), low, high, k, same)
                    own, nth = np.nonzero(best.scores > LOWEST)
                    query = own // most
                    hits.append(pa.table([part["uid"].to_numpy()[query], name.reshape(-1)[own].astype(np.int32),
                                          best.ids[own, nth], best.scores[own, nth].astype(np.int64), evaluated[query]],
                                         schema=hit_schema))
            return pa.concat_tables(hits) if hits else hit_schema.empty_table()

        asked = queries.select(*columns).mapInArrow(route, sent)
        keys = ("dim", "home", "sub", "part")
        return (asked.groupBy(*keys).cogroup(self.table.groupBy(*keys)).applyInArrow(match, HIT))

    def best(self, queries: DataFrame, k: int, same: bool) -> DataFrame:
        """Per query (uid) and window its k best: uid, w, rank, vec_id, score, evaluated."""
        home = written(self.met(queries, k, same, at_home=True), "hits")
        known = (ranked(home, k).groupBy("uid", "w").agg(F.count("*").alias("n"), F.min("score").alias("kth"))
                 .filter(F.col("n") == k).groupBy("uid")
                 .agg(F.map_from_entries(F.collect_list(F.struct("w", "kth"))).alias("kth")))
        asked = queries.join(known, "uid", "left").withColumn("windows", F.transform("windows", lambda x: F.struct(
            x["w"].alias("w"), x["low"].alias("low"), x["high"].alias("high"),
            F.coalesce(F.col("kth")[x["w"]], x["least"]).alias("least")))).drop("kth")
        away = written(self.met(asked, k, same, at_home=False), "hits")
        return ranked(home.union(away), k)


def ranked(hits: DataFrame, k: int) -> DataFrame:
    """The k best of a query and window; a vec_id with several vectors counts once per score."""
    order = Window.partitionBy("uid", "w").orderBy(F.desc("score"), "vec_id")
    return (hits.groupBy("uid", "w", "vec_id", "score").agg(F.sum("evaluated").alias("evaluated"))
            .withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k))


MINED = ("anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, "
         "negative_score bigint, evaluated bigint")


def hard_negatives(vectors: DataFrame, anchor: "F.Column", label: "F.Column", positives: int = 5, negatives: int = 10,
                   low: int = 30, high: int = 90, scale: int = 256, block: int = BLOCK,
                   query_block: int = QUERY_BLOCK) -> DataFrame:
    """Per anchor and positive its hardest negatives: anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score, evaluated.

    ``vectors`` has vec_id, embedding and what ``anchor`` and ``label`` use. Components become
    ``floor(scale * x)``; scores are integer inner products. An anchor's positives are the ``positives`` best
    rows of its label, the negatives of a positive the ``negatives`` best rows of other labels with
    ``low * p <= 100 * score <= high * p``, p the positive's score; ties go to the smaller vec_id. Below a
    negative p that window is empty.

    Null ids or labels and null, empty or non-finite vectors take no part, vectors meet those of their own
    length only, rows that repeat id, label and vector count once, and rows with the anchor's own id are neither its
    positives nor its negatives. Components that reach 2^23 after scaling raise an error. No anchor, no
    positive or no negative gives no row. ``evaluated`` counts the points verified in the blocks that contributed.
    """
    spark = vectors.sparkSession
    points = written(prepared(vectors, anchor, label, scale), "points")
    if points.isEmpty():
        return spark.createDataFrame([], MINED)
    trees = Trees(points, block, query_block)
    whole = F.array(F.struct(F.lit(0).alias("w"), F.lit(LOWEST).alias("low"), F.lit(-LOWEST).alias("high"),
                             F.lit(LOWEST).alias("least")))
    found = written(trees.best(trees.anchors.withColumn("windows", whole), positives, same=True)
                    .select("uid", F.col("rank").alias("w"), F.col("vec_id").alias("positive_id"),
                            F.col("score").alias("positive_score")), "positives")
    p = F.col("positive_score")
    # Whole numbers: at least low * p / 100, rounded up, and at most high * p / 100, rounded down.
    windows = (found.select("uid", "w", (-F.expr(f"(-{low} * positive_score - pmod(-{low} * positive_score, 100)) div 100"))
                            .alias("low"),
                            F.expr(f"({high} * positive_score - pmod({high} * positive_score, 100)) div 100").alias("high"))
               .filter("low <= high").groupBy("uid")
               .agg(F.collect_list(F.struct("w", "low", "high", F.lit(LOWEST).alias("least"))).alias("windows")))
    mined = trees.best(trees.anchors.join(windows, "uid"), negatives, same=False)
    ids = trees.anchors.select("uid", F.col("vec_id").alias("anchor_id"))
    return (mined.join(found, ["uid", "w"]).join(ids, "uid")
            .select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), p,
                    F.col("score").alias("negative_score"), "evaluated"))
