"""Centroid clustering of vectors: rounds of assignment through a vantage-point tree.

Vectors and centroids are whole numbers, so distances, sums and means are exact. Each round
builds a vantage-point tree over the centroids and broadcasts it; each vector searches it
best first, and leaves out a branch only if every centroid in it is farther than the best
one so far, so equally near centroids are all seen and the smaller number wins.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surtido.llm.common import by_value, stored

by_value(__name__)

DIMENSIONS = 64
CLUSTERS = 8
ROUNDS = 10
SEED = 3
# Whole steps per unit of a component.
SCALE = 1024
# Whole components beyond this would give squared distances above a 64-bit number.
LARGEST = 1 << 27
# Bounds held at a time: vectors times nodes of the tree.
BOUNDS_AT_ONCE = 1 << 22
# Relative slack of a bound from rounded square roots.
_SLACK = 1e-12


# --- The tree -----------------------------------------------------------------

@dataclass(frozen=True)
class Tree:
    """A node per centroid: its vantage point, and the near and far halves of the rest.

    ``low`` and ``high`` bound the distances of a child's centroids from the vantage point.
    """

    points: np.ndarray   # whole components, a row per node
    numbers: np.ndarray  # the centroid's number
    child: np.ndarray    # two columns, -1 where there is none
    low: np.ndarray
    high: np.ndarray


def squares(gaps: np.ndarray) -> np.ndarray:
    return np.einsum("ij,ij->i", gaps, gaps)


def build_tree(centroids: np.ndarray) -> Tree:
    """The vantage-point tree of whole centroids; the median distance parts every branch."""
    order: list[int] = []
    child, low, high = [], [], []
    todo = [(np.arange(len(centroids)), None, 0)]
    while todo:
        members, parent, side = todo.pop()
        node, vantage = len(order), members[0]
        order.append(int(vantage))
        child.append([-1, -1])
        low.append([0.0, 0.0])
        high.append([0.0, 0.0])
        if parent is not None:
            child[parent][side] = node
        rest = members[1:]
        gaps = np.sqrt(squares(centroids[rest] - centroids[vantage]).astype(np.float64))
        turn = np.argsort(gaps, kind="stable")
        half = (len(rest) + 1) // 2
        for s, part in enumerate((turn[:half], turn[half:])):
            if len(part):
                low[node][s], high[node][s] = gaps[part[0]], gaps[part[-1]]
                todo.append((np.sort(rest[part]), node, s))
    return Tree(centroids[order], np.array(order, np.int64), np.array(child, np.int64),
                np.array(low), np.array(high))


def nearest(vectors: np.ndarray, tree: Tree) -> tuple[np.ndarray, np.ndarray]:
    """(number of the nearest centroid, squared distance) of every vector, exact.

    Every vector goes through its open nodes by their least possible distance. A node whose
    bound equals the radius is still opened; when the least bound passes the radius, the
    vector is done. Vectors take their steps side by side.
    """
    best = np.full(len(vectors), np.iinfo(np.int64).max)
    number = np.full(len(vectors), -1, np.int64)
    rows = max(1, BOUNDS_AT_ONCE // len(tree.points))
    for start in range(0, len(vectors), rows):
        part = slice(start, start + rows)
        _search(vectors[part], tree, best[part], number[part])
    return number, best


def _search(vectors: np.ndarray, tree: Tree, best: np.ndarray, number: np.ndarray) -> None:
    bounds = np.full((len(vectors), len(tree.points)), np.inf)
    bounds[:, 0] = 0.0
    radius = np.full(len(vectors), np.finfo(np.float64).max)
    active = np.arange(len(vectors))
    while len(active):
        node = bounds[active].argmin(axis=1)
        bound = bounds[active, node]
        going = bound <= radius[active]
        active, node, bound = active[going], node[going], bound[going]
        bounds[active, node] = np.inf
        found = squares(vectors[active] - tree.points[node])
        better = (found < best[active]) | (
            (found == best[active]) & (tree.numbers[node] < number[active]))
        moved = active[better]
        best[moved], number[moved] = found[better], tree.numbers[node[better]]
        radius[moved] = np.sqrt(found[better].astype(np.float64)) * (1 + _SLACK)
        away = np.sqrt(found.astype(np.float64))
        for side in (0, 1):
            child = tree.child[node, side]
            has = child >= 0
            low, high = tree.low[node, side], tree.high[node, side]
            least = np.maximum(away - high, low - away) - _SLACK * (away + high)
            bounds[active[has], child[has]] = np.maximum(least, bound)[has]


# --- Rounds -------------------------------------------------------------------

def whole_vectors(rows: DataFrame, vector_col: str, id_col: str, dimensions: int = DIMENSIONS,
                  scale: int = SCALE) -> DataFrame:
    """(vec_id, x): the vectors with exactly ``dimensions`` finite components, in whole steps.

    ``x`` is floor(scale * component). A component beyond ``LARGEST`` steps leaves its vector
    out, like one that is not finite: squared distances would not be 64-bit numbers.
    """
    value: Column = F.col(vector_col)
    good = F.forall(value, lambda c: F.coalesce(
        F.abs(c.cast("double")) < LARGEST / scale, F.lit(False)))
    ints = F.transform(value, lambda c: F.floor(c.cast("double") * scale).cast("int"))
    return rows.where(F.size(value) == dimensions).where(good).select(
        F.col(id_col).alias("vec_id"), ints.alias("x"))


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    flat = batch.column("x").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return flat.reshape(batch.num_rows, -1)


def _sums(shared) -> Callable:
    def worker(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = shared.value
        total = np.zeros(tree.points.shape, np.int64)
        count = np.zeros(len(total), np.int64)
        for batch in batches:
            x = _matrix(batch)
            number, _ = nearest(x, tree)
            turn = np.argsort(number, kind="stable")
            which, first = np.unique(number[turn], return_index=True)
            if len(which):
                total[which] += np.add.reduceat(x[turn], first, axis=0)
                count += np.bincount(number, minlength=len(count))
        held = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(held, pa.int64()), pa.array(count[held]),
             pa.array(list(total[held]), pa.list_(pa.int64()))], ["cluster", "n", "total"])
    return worker


def _assigned(shared) -> Callable:
    def worker(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number, best = nearest(_matrix(batch), shared.value)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(number.astype(np.int32)), pa.array(best)],
                ["vec_id", "cluster", "distance"])
    return worker


def first_centroids(kept: DataFrame, clusters: int, seed: int) -> np.ndarray:
    """The vectors with the smallest hashes of ``seed:vec_id``; ties by their components."""
    text = F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string"))
    first = kept.orderBy(F.asc_nulls_last(F.sha2(text, 256)), "x").limit(clusters).collect()
    return np.array([r["x"] for r in first], np.int64)


def next_centroids(kept: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Componentwise floor of the exact mean of every cluster; an empty one stays.

    A task sends one row per cluster it holds; Spark adds them up, and as many rows as the
    centroids have components come to the driver.
    """
    shared = kept.sparkSession.sparkContext.broadcast(build_tree(centroids))
    parts = kept.mapInArrow(_sums(shared), "cluster bigint, n bigint, total array<bigint>")
    added = parts.select("cluster", "n", F.posexplode("total").alias("at", "value")).groupBy(
        "cluster", "at").agg(F.sum("n").alias("n"),
                             F.sum(F.col("value").cast("decimal(38,0)")).alias("value")).collect()
    shared.unpersist()
    moved = centroids.copy()
    for r in added:
        moved[r["cluster"], r["at"]] = int(r["value"]) // r["n"]
    return moved


def cluster(rows: DataFrame, vector_col: str = "embedding", id_col: str = "vec_id",
            clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED,
            dimensions: int = DIMENSIONS, scale: int = SCALE) -> tuple[DataFrame, np.ndarray]:
    """(``vec_id, cluster, distance, cluster_inertia, inertia, centroid`` per vector, centroids).

    ``centroid`` is the array of the cluster's final whole components, ``inertia`` a decimal
    sum. Vectors that are null, of another length, or with a component that is null, not
    finite or beyond ``LARGEST`` steps are left out. With fewer vectors than ``clusters``
    there are fewer clusters; an empty table gives no rows. Repeated rows count as often as
    they are given; a null vec_id comes last among the first centroids and is otherwise like
    any other. Other columns are left out.
    """
    kept = stored(whole_vectors(rows, vector_col, id_col, dimensions, scale))
    kind = kept.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {kind}, cluster int, distance bigint"
    spark = kept.sparkSession
    centroids = first_centroids(kept, clusters, seed)
    if not len(centroids):
        found = spark.createDataFrame([], schema)
    else:
        for _ in range(rounds):
            centroids = next_centroids(kept, centroids)
        shared = spark.sparkContext.broadcast(build_tree(centroids))
        found = stored(kept.mapInArrow(_assigned(shared), schema))
        shared.unpersist()

    exact = F.sum(F.col("distance").cast("decimal(20,0)"))
    sums = {r["cluster"]: r["n"] for r in found.groupBy("cluster").agg(exact.alias("n")).collect()}
    total = sum(sums.values())
    sides = spark.createDataFrame(
        [(c, n, total, centroids[c].tolist()) for c, n in sums.items()],
        "cluster int, cluster_inertia decimal(38,0), inertia decimal(38,0), centroid array<int>")
    return found.join(F.broadcast(sides), "cluster"), centroids  # one row per cluster


def centroid_hash(centroid: Column) -> Column:
    """SHA-256 of the components as decimal integers joined by commas."""
    return F.sha2(F.array_join(centroid.cast("array<string>"), ",").cast("binary"), 256)

