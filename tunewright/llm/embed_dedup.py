"""Near-duplicate vectors by randomised-rotation binary codes with stored correction factors."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunewright.llm.common import prepare, staged
from tunewright.llm.components import components

THRESHOLD = 0.98
#: Chance that a pair right at the threshold meets in no table.
MISS = 1e-4
#: Vectors that a table's bucket has on average, where they are spread evenly.
BUCKET = 256
#: Most vectors of a block; a bucket of more is compared block by block.
BLOCK = 1536
#: Width of the confidence bound in deviations of the estimate.
BOUND = 4.5
#: Pairs recomputed at once.
CHUNK = 200_000


def rotations(dim: int, count: int, seed: int = 5) -> np.ndarray:
    """Random orthogonal matrices, one below the other."""
    draw = np.random.default_rng([seed, dim])
    return np.concatenate([np.linalg.qr(draw.standard_normal((dim, dim)))[0].T for _ in range(count)])


def plan(rows: int, threshold: float = THRESHOLD, miss: float = MISS) -> tuple[int, int]:
    """Bits of a key and number of tables for so many vectors of a label.

    Bits grow with the logarithm of the rows so that buckets stay small; tables are as many as the
    chance of a miss asks for.
    """
    bits = max(1, min(24, round(math.log2(max(2, rows / BUCKET)))))
    same = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(miss) / math.log(1 - same)))


def _codes(vectors: np.ndarray, bits: int, tables: int):
    """(keys of each table, code, correction factor) of unit vectors."""
    dim = vectors.shape[1]
    turned = vectors @ rotations(dim, max(1, -(-bits * tables // dim))).T
    signs = turned > 0
    factor = np.abs(turned[:, :dim]).sum(axis=1) / math.sqrt(dim)  # inner product of the vector and its code
    weights = 1 << np.arange(bits)
    keys = (signs[:, : bits * tables].reshape(len(vectors), tables, bits) * weights).sum(axis=2)
    return keys.astype(np.int64), np.packbits(signs[:, :dim], axis=1), factor


def _encode(plans: dict[tuple[int, int], tuple[int, int]]):
    """Batches of (id, label, vector bytes, copies) to the rows with their keys, code and factor."""

    def run(batches):
        for batch in batches:
            labels, vectors = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            keys, codes, factors = [None] * len(labels), [None] * len(labels), np.zeros(len(labels))
            groups: dict = {}
            for i, (label, vector) in enumerate(zip(labels, vectors)):
                groups.setdefault((label, len(vector) // 4), []).append(i)
            for group, at in groups.items():
                unit = np.stack([np.frombuffer(vectors[i], "<f4") for i in at]).astype(np.float64)
                unit /= np.abs(unit).max(axis=1, keepdims=True)
                unit /= np.linalg.norm(unit, axis=1, keepdims=True)
                key, code, factor = _codes(unit, *plans[group])
                for j, i in enumerate(at):
                    keys[i], codes[i], factors[i] = key[j].tolist(), code[j].tobytes(), factor[j]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(keys, pa.list_(pa.int64())), pa.array(codes, pa.binary()), pa.array(factors)],
                ["id", "label", "vector", "copies", "keys", "code", "factor"],
            )

    return run


def _exact(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return np.einsum("ij,ij->i", left, right)


def compare_block(pdf: pd.DataFrame, threshold: float = THRESHOLD, bound: float = BOUND) -> pd.DataFrame:
    """Links of one block of a table: (id, links, low) of the rows that have any.

    The estimate of an inner product from one code and its factor is unbiased; where its upper bound
    reaches the threshold the pair is recomputed in double precision. A pair counts in the first
    table in which it meets. `low` is the least id connected within the block.
    """
    pdf = pdf.sort_values("id", kind="stable")
    vectors = np.stack([np.frombuffer(v, "<f4") for v in pdf["vector"]]).astype(np.float64)
    unit = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    dim = unit.shape[1]
    turned = (unit @ rotations(dim, 1).T).astype(np.float32)
    codes = np.unpackbits(np.stack([np.frombuffer(c, np.uint8) for c in pdf["code"]]), axis=1)[:, :dim]
    signs = (codes.astype(np.float32) * 2 - 1) / math.sqrt(dim)
    factor = pdf["factor"].to_numpy()
    slack = bound * np.sqrt(np.maximum(0, 1 - factor**2)) / factor / math.sqrt(max(1, dim - 1))
    keys = np.stack(pdf["keys"].to_numpy())
    ids, copies, block = pdf["id"].to_numpy(), pdf["copies"].to_numpy(), pdf["block"].to_numpy()
    table, one, two = int(pdf["table"].iloc[0]), pdf["one"].iloc[0], pdf["two"].iloc[0]
    links = np.zeros(len(ids), np.int64)
    low = np.arange(len(ids))
    step = max(1, CHUNK // len(ids))
    for at in range(0, len(ids), step):
        estimate = (signs[at : at + step] @ turned.T) / factor[at : at + step, None]
        a, b = np.nonzero(estimate + slack[at : at + step, None] >= threshold - 1e-5)
        a += at
        pick = a < b
        if one != two:
            pick &= block[a] != block[b]
        a, b = a[pick], b[pick]
        if table:
            fresh = ~(keys[a, :table] == keys[b, :table]).any(axis=1)
            a, b = a[fresh], b[fresh]
        near = _exact(unit[a], unit[b]) >= threshold
        a, b = a[near], b[near]
        links += np.bincount(a, copies[b], len(ids)).astype(np.int64) + np.bincount(b, copies[a], len(ids)).astype(np.int64)
        low = _join(low, a, b)
    found = links > 0
    return pd.DataFrame({"id": ids[found], "links": links[found], "low": ids[low[found]]})


def _join(low: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least position connected with each, after links a-b; positions are in order of id."""
    while len(a):
        root_a, root_b = low[a], low[b]
        apart = root_a != root_b
        if not apart.any():
            break
        a, b, root_a, root_b = a[apart], b[apart], root_a[apart], root_b[apart]
        np.minimum.at(low, np.maximum(root_a, root_b), np.minimum(root_a, root_b))
        while (low[low] != low).any():
            low = low[low]
    return low


def _vector_rows(batches):
    """(id, label, vector) to (id, label, vector bytes, digest); both null for vectors that link with nothing."""
    for batch in batches:
        packed, digests = [], []
        for label, vector in zip(batch.column(1), batch.column(2)):
            data = digest = None
            if label.is_valid and vector.is_valid and vector.values.null_count == 0 and len(vector.values):
                values = vector.values.to_numpy(zero_copy_only=False).astype("<f4")
                if np.isfinite(values).all() and values.any():
                    data = (values + np.float32(0)).tobytes()  # -0 is 0
                    digest = hashlib.blake2b(data, digest_size=16).digest()
            packed.append(data)
            digests.append(digest)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(packed, pa.binary()), pa.array(digests, pa.binary())], ["id", "label", "vector", "digest"]
        )


def near_duplicates(
    embeddings: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", threshold: float = THRESHOLD
) -> DataFrame:
    """key, n_links, component_id, kept of every row.

    Rows link if their labels are equal and not null, their vectors have the same length and the
    cosine in double precision is at least the threshold. Vectors that are null, empty, zero or hold
    null or non-finite components link with nothing and are kept. Equal vectors of a label are one
    before the search and count as links after it. Repeated keys are vectors of their own; a null
    key has a null class. An empty table gives an empty one; extra columns are not read.

    Vectors are compared only within buckets of equal bits of their codes, in several tables, so that
    a pair at the threshold meets but for a chance of 1e-4. Buckets of more than a block of vectors are
    compared block by block; pairs are counted where they meet and never written out.
    """
    spark = prepare(embeddings.sparkSession)
    kind = embeddings.schema[label].dataType.simpleString()
    rows = staged(
        embeddings.select(F.col(key).cast("long").alias("id"), F.col(label).alias("label"), F.col(vector).cast("array<float>").alias("vector"))
        .mapInArrow(_vector_rows, f"id long, label {kind}, vector binary, digest binary"),
        "vectors",
    )
    valid = rows.where("digest IS NOT NULL AND id IS NOT NULL")
    classes = staged(valid.groupBy("label", "digest").agg(F.min("id").alias("rep"), F.count("*").alias("copies")), "classes")
    reps = (
        valid.join(classes.select("label", "digest", F.col("rep").alias("id"), "copies"), ["label", "digest", "id"])
        .dropDuplicates(["label", "digest"])
        .select("id", "label", "vector", "copies")
    )
    reps = staged(reps, "reps")
    sizes = reps.groupBy("label", (F.octet_length("vector") / 4).cast("int").alias("dim")).agg(F.count("*").alias("n")).collect()
    plans = {(r["label"], r["dim"]): plan(r["n"], threshold) for r in sizes}  # a row a label
    coded = staged(
        reps.mapInArrow(_encode(plans), f"id long, label {kind}, vector binary, copies long, keys array<long>, code binary, factor double"), "codes"
    )
    tables = coded.withColumn("dim", F.octet_length("vector")).select("*", F.posexplode("keys").alias("table", "bucket"))
    spread = ["label", "dim", "table", "bucket"]
    large = tables.groupBy(*spread).agg(F.count("*").alias("n")).where(F.col("n") > BLOCK)
    large = large.select(*spread, F.ceil(F.col("n") / (BLOCK // 2)).cast("int").alias("blocks"))
    blocks = (
        tables.join(staged(large, "large"), spread, "left")
        .withColumn("blocks", F.coalesce("blocks", F.lit(1)))
        .withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("one", F.least("block", "other"))
        .withColumn("two", F.greatest("block", "other"))
        .select(*spread, "one", "two", "block", "id", "copies", "vector", "keys", "code", "factor")
    )
    found = staged(
        blocks.groupBy(*spread, "one", "two").applyInPandas(lambda pdf: compare_block(pdf, threshold), "id long, links long, low long"), "found"
    )
    linked = found.groupBy("id").agg(F.sum("links").alias("links"))
    label_of = components(found.select(F.col("id").alias("a"), F.col("low").alias("b")))
    known = (
        classes.join(linked, classes["rep"] == linked["id"], "left").drop("id")
        .join(label_of, F.col("rep") == label_of["id"], "left")
        .select("label", "digest", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"), F.coalesce("component", "rep").alias("comp"))
    )
    return rows.drop("vector").join(known, ["label", "digest"], "left").select(
        F.col("id").alias(key),
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("id").isNotNull(), F.coalesce("comp", "id")).alias("component_id"),
        F.coalesce(F.coalesce("comp", "id") == F.col("id"), F.lit(True)).alias("kept"),
    )
