"""Connected components of a table of links, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunewright.llm.common import release, staged


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of every node move to the least node of its neighbourhood."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("low")).withColumn("low", F.least("a", "low"))
    return (
        both.join(least, "a")
        .where("b > a")
        .select(F.col("b").alias("a"), F.col("low").alias("b"))
        .where("a <> b")
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours move to the least of them; needs a > b."""
    least = edges.groupBy("a").agg(F.min("b").alias("low"))
    moved = edges.join(least, "a").where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return moved.unionByName(least.select("a", F.col("low").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """Links (a, b) of integers to (id, component): the least id that each linked id reaches.

    Only ids that occur in a link between two different ids are returned. Nulls link nothing,
    repeated links count once, an empty table gives an empty one. Each round is written to the
    shared folder; rounds grow with the logarithm of the longest chain, and a node with very many
    links is only ever joined and pre-aggregated, never gathered.
    """
    now = staged(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "links",
    )
    seen = None
    while True:
        digest = now.agg(F.count("*"), F.sum(F.hash("a", "b").cast("long")), F.sum(F.xxhash64("b", "a") % 1_000_003)).first()
        if digest == seen:
            return now.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(
                now.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
            )
        seen = digest
        then = staged(_small_star(_large_star(now)), "links")
        release(now)
        now = then
