"""Approximate nearest neighbours by stable projections, a kd-tree and a chi-square stopping test."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tunewright.llm.common import prepare, staged

#: Dimensions of the projection; even, so that the chi-square distribution has a short sum.
PROJECTED = 8
#: Confidence that no nearer vector is left when a search stops.
CONFIDENCE = 0.99
#: Rows of a shard and queries of a block, on average.
SHARD_ROWS = 4096
BLOCK_QUERIES = 4096
LEAF = 32


def chi_square(x: float, degrees: int = PROJECTED) -> float:
    """Distribution function for even degrees of freedom."""
    half = x / 2
    return 1 - math.exp(-half) * sum(half**i / math.factorial(i) for i in range(degrees // 2))


def chi_square_point(p: float, degrees: int = PROJECTED) -> float:
    low, high = 0.0, 1.0
    while chi_square(high, degrees) < p:
        high *= 2
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square(middle, degrees) < p else (low, middle)
    return high


def projection(dim: int, projected: int = PROJECTED, seed: int = 17) -> np.ndarray:
    """Normal directions: a projected squared distance over the true one is chi-square distributed."""
    return np.random.default_rng([seed, dim]).standard_normal((dim, projected))


class Tree:
    """A kd-tree of projected points as a list of leaves with their boxes."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        self.points = points
        leaves, todo = [], [np.arange(len(points))]
        while todo:
            at = todo.pop()
            spread = np.ptp(points[at], axis=0) if len(at) else np.zeros(1)
            if len(at) <= leaf or not spread.max() > 0:
                leaves.append(at)
                continue
            axis, middle = int(spread.argmax()), len(at) // 2
            order = at[np.argpartition(points[at, axis], middle)]
            todo += [order[:middle], order[middle:]]
        self.leaves = [at for at in leaves if len(at)]
        self.low = np.stack([points[at].min(axis=0) for at in self.leaves])
        self.high = np.stack([points[at].max(axis=0) for at in self.leaves])

    def near(self, query: np.ndarray, step: int = 4):
        """Points in order of projected distance, in runs: (positions, squared distance all later ones have at least)."""
        gaps = np.maximum(np.maximum(self.low - query, query - self.high), 0)
        gaps = np.einsum("ij,ij->i", gaps, gaps)
        order = np.argsort(gaps, kind="stable")
        waiting, far = np.zeros(0, np.int64), np.zeros(0)
        for at in range(0, len(order), step):
            new = np.concatenate([self.leaves[i] for i in order[at : at + step]])
            away = self.points[new] - query
            waiting = np.concatenate([waiting, new])
            far = np.concatenate([far, np.einsum("ij,ij->i", away, away)])
            bound = gaps[order[at + step]] if at + step < len(order) else math.inf
            out = far <= bound
            if out.any():
                run, waiting, far = waiting[out], waiting[~out], far[~out]
                yield run, min(bound, far.min() if len(far) else math.inf)


def search(ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int, confidence: float = CONFIDENCE):
    """Per query, the k nearest found among the rows: (query, id, distance), ties to the smaller id.

    Rows are verified on the original vectors in order of projected distance. With d the k-th
    distance so far, a nearer row would be projected within the current distance with probability
    chi-square(current / d); the search stops once that reaches the confidence.
    """
    matrix = projection(vectors.shape[1])
    tree, sought = Tree(vectors @ matrix), queries @ matrix
    stop = chi_square_point(confidence)
    for name, query, point in zip(query_ids, queries, sought):
        best_d, best_id = np.zeros(0), np.zeros(0, np.int64)
        for run, beyond in tree.near(point):
            run = run[ids[run] != name]
            away = vectors[run] - query
            best_d = np.concatenate([best_d, np.einsum("ij,ij->i", away, away)])
            best_id = np.concatenate([best_id, ids[run]])
            if len(best_d) > k:
                top = np.lexsort((best_id, best_d))[:k]
                best_d, best_id = best_d[top], best_id[top]
            if len(best_d) >= k and beyond > stop * best_d.max():
                break
        top = np.lexsort((best_id, best_d))[:k]
        for i in top:
            yield name, best_id[i], math.sqrt(best_d[i])


def nearest(
    embeddings: DataFrame, queries: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = 10, confidence: float = CONFIDENCE
) -> DataFrame:
    """(query_id, rank from 1, key, score) of the k nearest rows found for each query.

    score is the Euclidean distance in double precision; ties go to the smaller key. Vectors that are
    null, empty, zero or hold null or non-finite components, and null keys, take no part; rows are
    compared with queries of their own length only. A row with the query's own key is never its
    neighbour. Repeated rows are candidates each; a repeated query is one. Empty tables give an empty one.

    Rows are dealt by hash to shards of about 4,096, each indexed anew by a kd-tree; queries come in
    blocks of about 4,096 to every shard, so no task holds more than one of each.
    """
    prepare(embeddings.sparkSession)

    def clean(df: DataFrame) -> DataFrame:
        values = F.col("vector")
        return (
            df.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"))
            .where("id IS NOT NULL AND vector IS NOT NULL AND size(vector) > 0")
            .where(F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
            .where(F.exists(values, lambda x: x != 0))
            .withColumn("dim", F.size("vector"))
        )

    rows, asked = staged(clean(embeddings), "rows"), staged(clean(queries).dropDuplicates(["id"]), "asked")
    shards = max(1, math.ceil(rows.count() / SHARD_ROWS))
    blocks = max(1, math.ceil(asked.count() / BLOCK_QUERIES))
    left = rows.withColumn("shard", F.pmod(F.xxhash64("id"), F.lit(shards))).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    right = asked.withColumn("block", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(blocks)).cast("int")).withColumn(
        "shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long")))
    )

    def run(data: pd.DataFrame, wanted: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(data) and len(wanted):
            found = list(
                search(data["id"].to_numpy(), np.stack(data["vector"].to_numpy()), wanted["id"].to_numpy(), np.stack(wanted["vector"].to_numpy()), k, confidence)
            )
        return pd.DataFrame(found, columns=["query_id", "id", "score"]).astype({"query_id": "int64", "id": "int64", "score": "float64"})

    by = ["dim", "shard", "block"]
    found = left.groupBy(*by).cogroup(right.groupBy(*by)).applyInPandas(run, "query_id long, id long, score double")
    best = Window.partitionBy("query_id").orderBy("score", "id")
    return (
        found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias(key), "score")
    )
