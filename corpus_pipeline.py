"""The corpus pipeline: each stage takes what the one before kept, written as Parquet and read again."""

from __future__ import annotations

import functools
import os
import sys

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tunewright.llm import jaccard, language, mixing, packing, quality  # noqa: E402
from tunewright.llm.common import prepare, release, remembered, staged, table  # noqa: E402

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
#: What the stage before wrote for itself; its result is written when the next one starts.
_LEFT: list[DataFrame] = []


def stage(fn):
    """A stage starts by deleting what the one before has written for itself, and remembers its own such tables."""

    @functools.wraps(fn)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        release(*_LEFT)
        _LEFT.clear()
        prepare(spark)
        with remembered() as written:
            out = fn(spark, docs, sf_dir)
        _LEFT.extend(written)
        return out

    return run_stage


@stage
def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, learnt from the labels of those at hand, does not reject."""
    return quality.keep_good(docs, quality.train(docs, table(spark, sf_dir, "labels")))


@stage
def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with letters of which one language holds a good share."""
    return language.keep_identified(docs, language.train(docs))


@stage
def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of links by 5-word sets with a similarity of 0.8 or more."""
    return jaccard.keep_one(docs, n=5, percent=80)


@stage
def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources; a document taken twice is there twice."""
    return mixing.take_mix(docs)


@stage
def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in packed windows."""
    return packing.pack_documents(docs, TOKENIZER)


STAGES = [
    ("quality", good),
    ("language", identified),
    ("near_duplicates", distinct),
    ("mixing", mixed),
    ("packing", packed),
]

#: No SQL: the first two stages score with fitted models, the last one packs by task.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; of what they write only the last one's input stays, which the result reads.

    A table without rows passes through every stage. Null texts and texts without letters go with the languages;
    rows that repeat a key with one text stay or go together; columns of any name pass to the fourth stage.
    """
    docs = table(spark, sf_dir, "documents")
    for name, fn in STAGES[:-1]:
        kept = staged(fn(spark, docs, sf_dir), name)
        release(docs)
        docs = kept
    return STAGES[-1][1](spark, docs, sf_dir)
