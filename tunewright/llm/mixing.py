"""Mixing sources to target weights by weighted fair queueing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tunewright.llm.common import staged

#: A document is taken so many times at most.
COPIES = 3
#: Pieces of a source whose running totals are made apart; a fixed number at every size.
LOTS = 4096
#: Pieces of the virtual time axis, likewise.
SPANS = 8192
#: A table of more sources than that is not broadcast.
BROADCAST_SOURCES = 50_000
WORDS = r"[^\x20\x09-\x0D]+"


def n_words(text: str = "text") -> Column:
    """Words of the whole text; 0 for null."""
    return F.coalesce(F.size(F.regexp_extract_all(F.col(text), F.lit(WORDS), F.lit(0))), F.lit(0)).cast("long")


def _draw(key: str, seed: int) -> Column:
    """A number from 0 to 2^60 - 1 by a hash of the key: the order of the shuffle."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def targets(sizes: DataFrame, copies: int = COPIES) -> DataFrame:
    """(source, source_size) to (source, source_size, weight, target).

    Sources by code point, null last, weigh 1, 2, 3, repeating. They share the sum of all sizes by
    weight; none gets more than `copies` times its size, and what is over is shared again by weight.
    The share a weight gets is found in one pass: sources in order of size per weight are full up to
    one of them, and the rest divide what is left. One narrow row per source goes through one task.
    """
    ranked = sizes.withColumn(
        "weight", (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % 3 + 1
    ).withColumn("cap", F.col("source_size") * copies)
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    shared = (
        ranked.withColumn("total", F.sum("source_size").over(everything))
        .withColumn("full", F.coalesce(F.sum("cap").over(before), F.lit(0)))
        .withColumn("rest", F.sum("weight").over(onward))
        .withColumn("level", (F.col("total") - F.col("full")) / F.col("rest"))
        # the first source that its share does not overfill sets the level; later ones would set it lower
        .withColumn("fits", F.col("level") * F.col("weight") <= F.col("cap"))
        .withColumn("level", F.max(F.when(F.col("fits"), F.col("level"))).over(everything))
    )
    return shared.select(
        "source", "source_size", "weight",
        F.when(F.col("level").isNull(), F.col("cap").cast("double"))
        .otherwise(F.least(F.col("cap").cast("double"), F.col("level") * F.col("weight"))).alias("target"),
    )


def mix(documents: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", copies: int = COPIES, seed: int = 42):
    """(sized, order): every row with its size and target, and the rows that the mix takes, in order.

    Documents of a source are shuffled by a hash of the key and queue up to `copies` times. A copy
    finishes at virtual time (words of its source up to its end) / target; copies are sorted by finish
    over all sources and taken while their running total is within the budget, the sum of all sizes.
    Both sums are made in two steps, pieces of bounded number first, so no source and no time is one task.

    sized: (row, key, size, source, source_size, target). order: (row, key, draw, source, copy, finish, size, position). Null
    texts and empty ones have size 0 and are never taken; repeated rows queue one by one; null keys
    and null sources are like others; extra columns are not read; an empty table gives an empty mix.
    """
    sized = staged(
        documents.select(F.col(key).alias("key"), F.col(source).alias("source"), n_words(text).alias("size"), _draw(key, seed).alias("draw")),
        "sizes",
    )
    goal = staged(targets(sized.groupBy("source").agg(F.sum("size").alias("source_size"))), "targets")
    if goal.count() <= BROADCAST_SOURCES:
        goal = F.broadcast(goal)
    sized = staged(
        sized.join(goal, sized["source"].eqNullSafe(goal["source"]), "left").drop(goal["source"]).withColumn("row", F.monotonically_increasing_id()),
        "sized",
    )
    queue = sized.where("size > 0").withColumn("lot", F.expr(f"div(draw, {(1 << 60) // LOTS}L)"))
    lots = queue.groupBy("source", "lot").agg(F.sum("size").alias("words"))
    before = Window.partitionBy("source").orderBy("lot").rowsBetween(Window.unboundedPreceding, -1)
    lots = lots.select(
        F.col("source").alias("_source"), F.col("lot").alias("_lot"), F.coalesce(F.sum("words").over(before), F.lit(0)).alias("start")
    )
    inside = Window.partitionBy("source", "lot").orderBy("draw", "key", "size", "row").rowsBetween(Window.unboundedPreceding, 0)
    placed = queue.withColumn("upto", F.sum("size").over(inside)).join(
        lots, F.col("source").eqNullSafe(F.col("_source")) & (F.col("lot") == F.col("_lot"))
    )
    turns = (
        placed.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
        .withColumn("end", F.col("copy") * F.col("source_size") + F.col("start") + F.col("upto"))
        .where(F.col("end") - F.col("size") < F.col("target"))
        .select("row", "key", "draw", "source", "copy", "size", (F.col("end") / F.col("target")).alias("finish"))
        .withColumn("span", F.least(F.floor(F.col("finish") * SPANS), F.lit(2 * SPANS)))
    )
    turns = staged(turns, "turns")
    spans = turns.groupBy("span").agg(F.sum("size").alias("words"))
    ahead = Window.orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.select("span", F.coalesce(F.sum("words").over(ahead), F.lit(0)).alias("ahead"))
    budget = sized.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    within = (
        Window.partitionBy("span").orderBy("finish", "draw", "key", "source", "copy", "row").rowsBetween(Window.unboundedPreceding, 0)
    )
    order = (
        turns.withColumn("sofar", F.sum("size").over(within))
        .join(spans, "span")
        .where(F.col("ahead") + F.col("sofar") <= budget)
        .select("row", "key", "draw", "source", "copy", "finish", "size", (F.col("ahead") + F.col("sofar")).alias("position"))
    )
    return sized, order


def mixed_sizes(documents: DataFrame, key: str = "doc_id", **names) -> DataFrame:
    """Per row: key, size, source_size, target, taken (words the mix takes, repeats counted)."""
    sized, order = mix(documents, key, **names)
    took = order.groupBy("row").agg(F.sum("size").alias("taken"))
    return sized.join(took, "row", "left").select(
        F.col("key").alias(key), "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken")
    )


def take_mix(documents: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", seed: int = 42, **names) -> DataFrame:
    """The documents of the mix with all their columns, each as many times as it is taken.

    Of a source, the mix takes the documents up to one place of its last copy, and one copy less of
    those after it. That place is found over numbers; documents are kept by comparing their key's draw with
    it, without a shuffle. Only rows with the very key of the place are numbered, those of fewer words first.

    Null texts and those without words are never taken; repeated rows are taken one by one; null keys
    and null sources are like others; columns of any name pass through; an empty table gives an empty one.
    """
    _, order = mix(documents, key, source, text, seed=seed, **names)
    place = F.struct("copy", "draw", "key")
    order = staged(order.select("source", place.alias("place")), "order")
    last = order.groupBy("source").agg(F.max("place").alias("place"))
    cuts = order.alias("o").join(last.alias("l"), F.col("o.source").eqNullSafe(F.col("l.source")) & F.col("o.place").eqNullSafe(F.col("l.place")))
    cuts = cuts.groupBy(F.col("l.source").alias("source"), F.col("l.place").alias("place")).agg(F.count("*").alias("at_cut"))
    cuts = staged(cuts, "cuts")
    if cuts.count() <= BROADCAST_SOURCES:
        cuts = F.broadcast(cuts)
    rows = documents.select(F.struct("*").alias("row"), F.col(key).alias("key"), F.col(source).alias("of"), _draw(key, seed).alias("draw"), F.col(text).alias("said"))
    met = rows.where(F.rlike("said", F.lit(WORDS))).join(cuts, F.col("of").eqNullSafe(F.col("source")))
    mine, there = F.struct("draw", "key"), F.struct("place.draw", "place.key")
    met = met.select("row", "place.copy", "at_cut", "source", n_words("said").alias("size"), (mine < there).alias("before"), mine.eqNullSafe(there).alias("at"))
    sure = met.where("NOT at").select("row", (F.col("copy") + F.col("before").cast("int")).alias("times"))
    # rows at the cut: numbered within what one task of one write has of one size, after the counts of those before
    cut = staged(met.where("at").withColumn("task", F.spark_partition_id()), "at_cut")
    cells = cut.groupBy("source", "size", "task").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("source").orderBy("size", "task").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select(
        F.col("source").alias("_source"), F.col("size").alias("_size"), F.col("task").alias("_task"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("ahead")
    )
    inside = F.row_number().over(Window.partitionBy("source", "size", "task").orderBy(F.lit(0)))
    numbered = cut.withColumn("number", inside).join(
        cells, F.col("source").eqNullSafe(F.col("_source")) & (F.col("size") == F.col("_size")) & (F.col("task") == F.col("_task"))
    )
    tied = numbered.select("row", (F.col("copy") + (F.col("ahead") + F.col("number") <= F.col("at_cut")).cast("int")).alias("times"))
    return sure.unionByName(tied).where("times > 0").select("row", F.explode(F.sequence(F.lit(1), "times"))).select("row.*")
