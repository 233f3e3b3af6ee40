"""Exact k-means over integer vectors, with bounds loosened by the norm of total displacement."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tunewright.llm.common import prepare, release, staged

CENTROIDS = 40
ROUNDS = 5
DIM = 64
SEED = 2
SCALE = 256
#: Components beyond it could make a squared distance that a long does not hold.
LARGEST = 1 << 27
#: Bounds are kept apart from what they bound by this share, far more than their rounding.
SLACK = 1e-6

STATE = "assigned binary, near binary, near_at binary, far binary, far_at binary, evaluated long"


def _blocks(dim: int, scale: int):
    """Batches of (id, vector) to a row each: the ids and the integers of the vectors that count."""

    def run(batches):
        for batch in batches:
            ids, vectors = batch.column(0), batch.column(1)
            kept, rows = [], []
            for i, vector in enumerate(vectors):
                if vector.is_valid and len(vector.values) == dim and vector.values.null_count == 0:
                    values = np.floor(vector.values.to_numpy(zero_copy_only=False).astype(np.float64) * scale)
                    if (np.abs(values) <= LARGEST).all():  # false too for what is not finite
                        kept.append(i)
                        rows.append(values.astype("<i4"))
            if kept:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([ids.take(pa.array(kept)).to_pylist()], pa.list_(ids.type)), pa.array([np.stack(rows).tobytes()], pa.binary())],
                    ["ids", "ints"],
                )

    return run


def _smallest(k: int, dim: int, seed: int):
    """The k smallest digests of a task's vectors, with the vectors."""

    def run(batches):
        best: list[tuple[str, list[int]]] = []
        for batch in batches:
            for ids, ints in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                names = ["" if i is None else i for i in ids]
                rows = np.frombuffer(ints, "<i4").reshape(-1, dim)
                found = [hashlib.sha256(f"{seed}:{name}".encode()).hexdigest() for name in names]
                best = sorted([*best, *((d, rows[i].tolist()) for i, d in enumerate(found) if len(best) < k or d <= best[-1][0])])[:k]
        yield pa.RecordBatch.from_arrays(
            [pa.array([d for d, _ in best], pa.string()), pa.array([v for _, v in best], pa.list_(pa.int32()))], ["digest", "vector"]
        )

    return run


def squared(rows: np.ndarray, centroid: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer rows from one centroid, or from one each."""
    apart = rows - centroid
    return np.einsum("ij,ij->i", apart, apart)


def _norms(history: np.ndarray) -> np.ndarray:
    """(time, centroid): how far the newest centroid is from where it was at that time."""
    apart = (history[-1][None] - history).astype(np.float64)
    return np.sqrt((apart * apart).sum(axis=2))


class Bounds:
    """Assignments of some vectors, and what was last measured of each (vector, centroid) and when.

    near: distance from the own centroid, near_at: the round of that. far, far_at: the same for
    every centroid. In a later round a centroid is as much nearer at most as the norm of its total
    displacement since; the sum of its steps, which is longer, is never used.
    """

    def __init__(self, rows: np.ndarray, state: tuple | None, k: int):
        self.rows, n = rows.astype(np.int64), len(rows)
        if state is None:
            self.assigned, self.near, self.near_at = np.zeros(n, np.int32), np.full(n, np.inf), np.zeros(n, np.uint8)
            self.far, self.far_at = np.zeros((n, k), np.float32), np.zeros((n, k), np.uint8)
        else:
            kinds = (np.int32, np.float64, np.uint8, np.float32, np.uint8)
            self.assigned, self.near, self.near_at, far, far_at = (np.frombuffer(b, t).copy() for b, t in zip(state, kinds))
            self.far, self.far_at = far.reshape(n, k), far_at.reshape(n, k)

    def state(self) -> list[bytes]:
        return [x.tobytes() for x in (self.assigned, self.near, self.near_at, self.far, self.far_at)]

    def own(self, centroids: np.ndarray, at: np.ndarray) -> np.ndarray:
        return squared(self.rows[at], centroids[self.assigned[at]])

    def assign(self, history: np.ndarray) -> int:
        """Move to the nearest of the newest centroids, ties to the smaller number; distances evaluated."""
        now, centroids = len(history) - 1, history[-1]
        n, k = self.far.shape
        each, moved = np.arange(k), _norms(history)
        below = self.far * (1 - SLACK) - moved[self.far_at, each] * (1 + SLACK) - SLACK
        above = self.near * (1 + SLACK) + moved[self.near_at, self.assigned] * (1 + SLACK) + SLACK
        failed = below <= above[:, None]
        failed[np.arange(n), self.assigned] = False
        at = np.flatnonzero(failed.any(axis=1) | np.isinf(self.near))
        if not len(at):
            return 0
        best, chosen = self.own(centroids, at), self.assigned[at].copy()
        above = np.sqrt(best.astype(np.float64))
        self.far[at, chosen], self.far_at[at, chosen] = above, now
        failed = failed[at] & (below[at] <= (above * (1 + SLACK) + SLACK)[:, None])
        evaluated = len(at)
        for j in each:
            some = np.flatnonzero(failed[:, j])
            if len(some):
                found = squared(self.rows[at[some]], centroids[j])
                self.far[at[some], j], self.far_at[at[some], j] = np.sqrt(found.astype(np.float64)), now
                evaluated += len(some)
                wins = (found < best[some]) | ((found == best[some]) & (j < chosen[some]))
                best[some[wins]], chosen[some[wins]] = found[wins], j
        self.assigned[at], self.near[at], self.near_at[at] = chosen, np.sqrt(best.astype(np.float64)), now
        return evaluated


def _assigned(history: np.ndarray, first: bool):
    """Rows (ids, ints[, state]) to the same with the state after this round."""
    k, dim = history.shape[1:]

    def run(batches):
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns[1:7]]
            states, evaluated = [], []
            for row in zip(*columns):
                bounds = Bounds(np.frombuffer(row[0], "<i4").reshape(-1, dim), None if first else row[1:6], k)
                evaluated.append(bounds.assign(history))
                states.append(bounds.state())
            state = [pa.array([s[i] for s in states], pa.binary()) for i in range(5)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *state, pa.array(evaluated, pa.int64())],
                ["ids", "ints", "assigned", "near", "near_at", "far", "far_at", "evaluated"],
            )

    return run


def _sums(k: int, dim: int):
    """A task's vectors and their sum per cluster."""

    def run(batches):
        sums, counts = np.zeros((k, dim), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            for ints, assigned in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                cluster = np.frombuffer(assigned, np.int32)
                np.add.at(sums, cluster, np.frombuffer(ints, "<i4").reshape(-1, dim))
                counts += np.bincount(cluster, minlength=k)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at.astype(np.int32)), pa.array(counts[at]), pa.array(list(sums[at]), pa.list_(pa.int64()))], ["cluster", "n", "sums"]
        )

    return run


def _members(history: np.ndarray):
    """Rows of blocks to a row per vector: id, cluster and exact squared distance."""
    dim = history.shape[2]

    def run(batches):
        for batch in batches:
            for ids, ints, assigned in zip(batch.column(0), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                cluster = np.frombuffer(assigned, np.int32)
                away = squared(np.frombuffer(ints, "<i4").reshape(-1, dim).astype(np.int64), history[-1][cluster])
                yield pa.RecordBatch.from_arrays([ids.values, pa.array(cluster), pa.array(away)], ["id", "cluster", "distance"])

    return run


def _moved(blocks: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Exact floor of every cluster's mean; a cluster without vectors stays. k * dim numbers reach the driver."""
    k, dim = centroids.shape
    parts = blocks.select("ints", "assigned").mapInArrow(_sums(k, dim), "cluster int, n long, sums array<long>")
    sizes = {r["cluster"]: r["n"] for r in parts.groupBy("cluster").agg(F.sum("n").alias("n")).collect()}
    out = centroids.copy()
    for r in parts.select("cluster", F.posexplode("sums").alias("at", "x")).groupBy("cluster", "at").agg(F.sum("x").alias("x")).collect():
        out[r["cluster"], r["at"]] = r["x"] // sizes[r["cluster"]]
    return out


def fit(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = CENTROIDS, rounds: int = ROUNDS, dim: int = DIM,
    seed: int = SEED, scale: int = SCALE,
) -> tuple[DataFrame, np.ndarray]:
    """(blocks, history): vectors with their last bounds and assignment, and the centroids of every round.

    A row of blocks holds the vectors of one Arrow batch (ids, ints, assigned, ...; `evaluated` counts
    the distances that its last round measured). Each round is one pass over blocks, written to the shared folder
    and read again; the round before is deleted then. Nothing is shuffled but sums per cluster.
    """
    prepare(vectors.sparkSession)
    kind = vectors.schema[key].dataType.simpleString()
    blocks = staged(
        vectors.select(F.col(key), F.col(vector).cast("array<double>")).mapInArrow(_blocks(dim, scale), f"ids array<{kind}>, ints binary"), "vectors"
    )
    first = blocks.mapInArrow(_smallest(k, dim, seed), "digest string, vector array<int>").orderBy("digest", "vector").limit(k).collect()
    history = np.array([[r["vector"] for r in first]], np.int64).reshape(1, len(first), dim)
    for turn in range(rounds + 1):
        if turn:
            history = np.concatenate([history, _moved(blocks, history[-1])[None]])
        now = staged(blocks.mapInArrow(_assigned(history, turn == 0), f"ids array<{kind}>, ints binary, {STATE}"), "round")
        release(blocks)
        blocks = now
    return blocks, history


def cluster(vectors: DataFrame, key: str = "vec_id", **options) -> DataFrame:
    """key, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every vector that counts.

    Vectors count that have `dim` components, none null or not finite (nor, times `scale`, beyond 2^27,
    whose squared distances a long may not hold); others have no row. Components become floor(scale *
    x). The first centroids are the k vectors of smallest sha256 of `<seed>:<key>`, ties by components;
    fewer vectors make fewer centroids. Vectors at one distance from several centroids go to the smaller
    number. Repeated keys are vectors of their own, a null key is like the empty text; an empty table
    gives an empty one; extra columns are not read.
    """
    blocks, history = fit(vectors, key, **options)
    spark, kind = vectors.sparkSession, vectors.schema[key].dataType.simpleString()
    members = blocks.select("ids", "ints", "assigned").mapInArrow(_members(history), f"id {kind}, cluster int, distance long")
    digests = [(i, hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for i, c in enumerate(history[-1].tolist())]
    named = spark.createDataFrame(digests, T.StructType.fromDDL("cluster int, centroid_sha256 string"))
    sums = members.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    total = sums.agg(F.sum("cluster_inertia").alias("inertia")).first()[0]
    known = named.join(sums, "cluster").withColumn("inertia", F.lit(total).cast("long"))  # k rows
    return members.join(F.broadcast(known), "cluster").select(
        F.col("id").alias(key), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
