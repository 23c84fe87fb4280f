"""Nearest neighbours by stable projections, a kd-tree and a chi-square stopping test.

Vectors are lifted by one coordinate so that the largest inner product is the
smallest distance, then projected by ``DIMENSIONS`` Gaussian directions. For a pair at
distance ``d``, the squared projected distance over ``d^2`` follows a chi-square
distribution with as many degrees of freedom. The projected neighbours nearest to a query
are verified first, by their inner products. Then leaf after leaf of the tree is verified that
holds a projected point so near that a neighbour better than the k-th found could be there; the
search of a query stops when the test says of all other points that such a neighbour would be seen
nearer with a chance of ``TRUST``. Queries are worked on in blocks: one matrix
product per leaf serves all whose search is still open there.

The upper levels of the kd-tree are fitted on at most ``SAMPLE`` vectors and deal all
vectors into cells; a task searches one cell with a tree of its own. A query first
searches its own cell. The k-th distance found there and the test leave only some of
the other cells to visit.

Vectors that are null, zero, or hold a null or a component that is not finite, or that
have another length than most, take no part. Equal vectors are kept once with the
``k + 1`` smallest ids, which is all that any result can hold. Equal ids are ordered as
one. An empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import common

DIMENSIONS = 24
SAMPLE = 16_384
#: Chance with which the stopping test keeps a true neighbour.
TRUST = 0.8
#: Vectors of a cell, and of a leaf of its tree; queries of a block.
CELL, LEAF, QUERIES = 16_384, 64, 256


def chi_square_quantile(share: float, freedom: int) -> float:
    """Quantile for an even number of degrees of freedom, by bisection of the closed form."""
    low, high = 0.0, 1000.0
    for _ in range(200):
        x = (low + high) / 2
        term, total = 1.0, 1.0
        for k in range(1, freedom // 2):
            term *= x / 2 / k
            total += term
        if 1 - math.exp(-x / 2) * total < share:
            low = x
        else:
            high = x
    return high


def usable(vectors: DataFrame, key: str, column: str) -> DataFrame:
    """``(id, v)`` of the vectors that take part, as doubles, of the most frequent length."""
    made = vectors.select(F.col(key).cast("long").alias("id"), F.col(column).cast("array<double>").alias("v"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    made = made.where(F.col("id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0) & fine)
    made = made.where(F.exists("v", lambda x: x != 0))
    return made


def _splits(points: np.ndarray, cells: int) -> list[tuple[int, float]]:
    """Median cuts of a balanced kd-tree as a heap: ``(axis, value)`` of each inner node."""
    depth = max(0, math.ceil(math.log2(max(1, cells))))
    nodes: list[tuple[int, float]] = []
    level = [points]
    for _ in range(depth):
        following = []
        for part in level:
            axis = int(np.argmax(part.max(axis=0) - part.min(axis=0))) if len(part) else 0
            value = float(np.median(part[:, axis])) if len(part) else 0.0
            nodes.append((axis, value))
            following += [part[part[:, axis] <= value], part[part[:, axis] > value]]
        level = following
    return nodes


def _cell_of(points: np.ndarray, nodes: list[tuple[int, float]]) -> np.ndarray:
    at = np.zeros(len(points), dtype=np.int64)
    if nodes:
        axes = np.array([a for a, _ in nodes])
        values = np.array([v for _, v in nodes])
        for _ in range(int(math.log2(len(nodes) + 1))):
            at = 2 * at + 1 + (points[np.arange(len(points)), axes[at]] > values[at])
    return at - len(nodes)


def _boxes(nodes: list[tuple[int, float]], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest corner of each cell."""
    low, high = [np.full(width, -np.inf)], [np.full(width, np.inf)]
    for k, (axis, value) in enumerate(nodes):
        for side in (0, 1):
            a, b = low[k].copy(), high[k].copy()
            (b if side == 0 else a)[axis] = value
            low.append(a)
            high.append(b)
    return np.array(low[len(nodes) :]), np.array(high[len(nodes) :])


def _gap(point: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distance from a point to each box."""
    return (np.maximum(np.maximum(low - point, point - high), 0) ** 2).sum(axis=1)


class Tree:
    """kd-tree of the projected points of a cell: ``order`` puts the points of a leaf side by side."""

    def __init__(self, points: np.ndarray):
        leaves: list[np.ndarray] = []
        stack = [np.arange(len(points))]
        while stack:
            own = stack.pop()
            if len(own) <= LEAF:
                leaves.append(own)
                continue
            spread = points[own].max(axis=0) - points[own].min(axis=0)
            order = own[np.argsort(points[own, int(np.argmax(spread))], kind="stable")]
            stack += [order[: len(own) // 2], order[len(own) // 2 :]]
        self.order = np.concatenate(leaves)
        self.ends = np.cumsum([len(x) for x in leaves])


def _best(scores: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` highest scores of each line with their rows; equal ones by smaller id. Not in order."""
    if scores.shape[1] <= k:
        return scores, rows
    top = np.argpartition(-scores, k - 1, axis=1)[:, :k]
    least = np.take_along_axis(scores, top, axis=1).min(axis=1)
    tied = np.flatnonzero(((scores >= least[:, None]).sum(axis=1) > k) & np.isfinite(least))
    for line in tied:
        top[line] = np.lexsort((ids[rows[line]], -scores[line]))[:k]
    return np.take_along_axis(scores, top, axis=1), np.take_along_axis(rows, top, axis=1)


def _search(tree, vectors, points, ids, queries, places, known, limit, bound, k):
    """The best ``k`` rows of a cell for a block of queries: ``(scores, rows, verified)``.

    ``vectors``, ``points`` and ``ids`` are in the tree's order. ``places`` are the projected
    queries, ``known`` the k-th scores found elsewhere. ``limit`` is the chi-square quantile;
    ``bound`` gives the squared distances of inner products. A score of minus infinity stands
    for no row; ``verified`` counts the inner products taken.
    """
    far = (places**2).sum(axis=1)[:, None] + (points**2).sum(axis=1) - 2 * (places @ points.T)
    lines, near = np.arange(len(queries))[:, None], min(4 * k, len(vectors))
    rows = np.argpartition(far, near - 1, axis=1)[:, :near] if near < len(vectors) else np.tile(np.arange(near), (len(queries), 1))
    seen = np.zeros(far.shape, dtype=bool)
    seen[lines, rows] = True
    scores = np.einsum("qd,qnd->qn", queries, vectors[rows])
    verified = scores.size
    scores, rows = _best(scores, rows, ids, k)
    starts = np.concatenate([[0], tree.ends[:-1]])
    nearest = np.minimum.reduceat(far, starts, axis=1)

    def reach() -> np.ndarray:
        """Projected distance up to which a better neighbour is looked for."""
        worst = scores.min(axis=1) if scores.shape[1] == k else np.full(len(scores), -np.inf)
        return limit * np.maximum(bound(np.maximum(worst, known)), 0)

    within = reach()
    for leaf in np.argsort(nearest.min(axis=0)):
        start, end = starts[leaf], tree.ends[leaf]
        still = np.flatnonzero(nearest[:, leaf] <= within)
        if not len(still):
            continue
        found = queries[still] @ vectors[start:end].T
        verified += found.size
        found[seen[still, start:end]] = -np.inf
        own = np.broadcast_to(np.arange(start, end), found.shape)
        both = _best(np.hstack([scores[still], found]), np.hstack([rows[still], own]), ids, k)
        if scores.shape[1] < both[0].shape[1]:
            grow = both[0].shape[1] - scores.shape[1]
            scores = np.pad(scores, ((0, 0), (0, grow)), constant_values=-np.inf)
            rows = np.pad(rows, ((0, 0), (0, grow)))
        scores[still], rows[still] = both
        within = reach()
    return scores, rows, verified


def search(vectors: DataFrame, queries: DataFrame, k: int, key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """``(query_id, rank, vec_id, score)`` of the ``k`` rows with the largest inner product."""
    spark = vectors.sparkSession
    room = common.scratch(spark, "nearest")
    every = usable(vectors, key, column)
    twin = Window.partitionBy("v").orderBy("id")
    # Equal vectors may be a third of all rows; the rank limit is applied before the shuffle.
    ranked = every.withColumn("_rank", F.row_number().over(twin)).where(F.col("_rank") <= k + 1)
    once = ranked.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    held = room.save(once.select(F.col("ids")[0].alias("id"), "ids", "v"), "vectors")
    norm = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    facts = held.groupBy(F.size("v").alias("width")).agg(F.count("*").alias("n"), F.max(norm).alias("most")).collect()
    schema = "query_id long, rank int, vec_id long, score double"
    if not facts:
        return spark.createDataFrame([], schema)
    width, count, most = max(((r["width"], r["n"], r["most"]) for r in facts), key=lambda x: x[1])
    held = held.where(F.size("v") == width)
    rng = np.random.RandomState(20_240_607)
    directions = rng.standard_normal((width + 1, DIMENSIONS))
    limit = chi_square_quantile(TRUST, DIMENSIONS)
    sample = held.orderBy(F.xxhash64("id"), "id").select("v").limit(SAMPLE).toPandas()

    def lifted(x: np.ndarray) -> np.ndarray:
        return np.column_stack([x, np.sqrt(np.maximum(most - (x * x).sum(axis=1), 0))]) @ directions

    nodes = _splits(lifted(np.stack(sample["v"].to_list())), math.ceil(count / CELL))
    low, high = _boxes(nodes, DIMENSIONS)
    asked = usable(queries, key, column).where(F.size("v") == width).groupBy("id").agg(F.min("v").alias("v"))

    def dealt(batches):
        for frame in batches:
            if len(frame):
                frame["cell"] = _cell_of(lifted(np.stack(frame["v"].to_list())), nodes)
                yield frame

    cells = room.save(held.mapInPandas(dealt, "id long, ids array<long>, v array<double>, cell long"), "cells")
    sizes = cells.groupBy("cell").count().collect()  # one a cell
    parts = {r["cell"]: max(1, round(r["count"] / CELL)) for r in sizes}
    shares = F.create_map(*(F.lit(x) for pair in parts.items() for x in pair))
    cells = cells.withColumn("part", F.pmod(F.xxhash64("id"), F.element_at(shares, F.col("cell"))))

    def own_point(x):
        return np.concatenate([x, [0.0]]) @ directions

    def home(batches):
        for frame in batches:
            if len(frame):
                points = np.stack([own_point(x) for x in frame["v"]])
                frame["cell"] = _cell_of(points, nodes)
                frame["known"] = np.nan
                yield frame[["id", "v", "cell", "known"]]

    def expanded(batches):
        for frame in batches:
            if len(frame):
                frame["part"] = [list(range(parts.get(c, 0))) for c in frame["cell"]]
                frame = frame.explode("part").dropna(subset=["part"])
                frame["part"] = frame["part"].astype("int64")
                yield frame[["id", "v", "cell", "known", "part"]]

    asked_schema = "id long, v array<double>, cell long, known double"

    def visit(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            base = np.stack(left["v"].to_list())
            points = lifted(base)
            tree = Tree(points)
            base, points = base[tree.order], points[tree.order]
            ids, alike = left["id"].to_numpy()[tree.order], left["ids"].to_numpy()[tree.order]
            for start in range(0, len(right), QUERIES):
                some = right.iloc[start : start + QUERIES]
                asking = np.stack(some["v"].to_list())
                square = (asking * asking).sum(axis=1)
                places = np.column_stack([asking, np.zeros(len(asking))]) @ directions
                known = some["known"].fillna(-np.inf).to_numpy()
                # A row of copies that holds the query itself still stands for the others.
                scores, rows, _ = _search(
                    tree, base, points, ids, asking, places, known, limit, lambda s, q=square: most + q - 2 * s, k + 1
                )
                for own, line, found_rows in zip(some["id"], scores, rows, strict=True):
                    for s, r in zip(line.tolist(), found_rows.tolist()):
                        if s > -math.inf:
                            out += [(own, i, s) for i in alike[r] if i != own]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    def found(questions: DataFrame) -> DataFrame:
        pairs = cells.groupBy("cell", "part").cogroup(
            questions.mapInPandas(expanded, f"{asked_schema}, part long").groupBy("cell", "part")
        )
        return pairs.applyInPandas(visit, "query_id long, vec_id long, score double")

    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")

    def best(pairs: DataFrame) -> DataFrame:
        return pairs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    first = room.save(best(found(asked.mapInPandas(home, asked_schema))), "home")
    reached = first.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("worst"))
    others = asked.join(reached, asked["id"] == reached["query_id"], "left").select("id", "v", "n", "worst")

    def abroad(batches):
        for frame in batches:
            out = []
            for own, x, n, worst in zip(frame["id"], frame["v"], frame["n"], frame["worst"]):
                point = own_point(x)
                near = _gap(point, low, high)
                reach = np.inf if not n >= k else limit * max(most + float(x @ x) - 2 * worst, 0.0)
                home_cell = int(_cell_of(point[None], nodes)[0])
                known = np.nan if not n >= k else worst
                out += [(own, x, int(c), known) for c in np.flatnonzero(near <= reach) if c != home_cell]
            yield pd.DataFrame(out, columns=["id", "v", "cell", "known"])

    more = found(others.mapInPandas(abroad, asked_schema))
    every_found = first.select("query_id", "vec_id", "score").unionByName(more).dropDuplicates(["query_id", "vec_id"])
    return best(every_found).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
