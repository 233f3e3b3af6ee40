"""Queries over stored datasets: files, splits, versions, pages and counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from tunewright.operators import split as splits
from tunewright.operators import synth
from tunewright.operators.ranged import with_position
from tunewright.queries.adapt import PAIRS_SQL, RECORDS_SQL, records, table
from tunewright.queries.corpus import DOCUMENT, damaged_json, prompt_completion
from tunewright.queries.registry import query, sql_draw, sql_split
from tunewright.session import fresh_dir
from tunewright.sources import catalog
from tunewright.sources import records as record_files
from tunewright.sources import splits as split_files


@query(f"SELECT doc_id, {sql_split('doc_id')} AS split FROM documents")
def train_test_split(spark, folder):
    """The shuffle-free split."""
    return splits.train_test_split(table(spark, folder, "documents").select("doc_id"), "doc_id")


@query(f"""
    SELECT doc_id, CASE WHEN rank <= ceil(n * 0.1) THEN 'test' ELSE 'train' END AS split
    FROM (SELECT doc_id, count(*) OVER () AS n,
                 row_number() OVER (ORDER BY {sql_draw(42, 'doc_id')}, doc_id) AS rank
          FROM documents) r""")
def train_test_split_exact(spark, folder):
    documents = table(spark, folder, "documents").select("doc_id")
    return splits.train_test_split(documents, "doc_id", exact=True)


@query("SELECT doc_id, 'train' AS split FROM documents")
def train_only(spark, folder):
    documents = table(spark, folder, "documents").select("doc_id")
    return splits.train_test_split(documents, "doc_id", test_size=0)


def _split_documents(spark, folder):
    documents = table(spark, folder, "documents").select("doc_id", F.col("lang").alias("config"))
    return splits.train_test_split(documents, "doc_id")


CATALOG_SQL = f"""
    SELECT lang AS config, {sql_split('doc_id')} AS split, count(*) AS num_examples
    FROM documents GROUP BY ALL"""


@query(CATALOG_SQL)
def split_catalog(spark, folder):
    return catalog.split_catalog(_split_documents(spark, folder))


@query(f"""
    SELECT coalesce(max(config) FILTER (WHERE config = 'default' AND split = 'train'), min(config))
               AS config,
           'train' AS split, bool_or(config = 'default' AND split = 'train') AS found
    FROM ({CATALOG_SQL}) c""")
def choose_config(spark, folder):
    return catalog.choose_config(catalog.split_catalog(_split_documents(spark, folder)))


@query("SELECT DISTINCT lang AS config FROM documents")
def distinct_configs(spark, folder):
    return catalog.distinct_configs(table(spark, folder, "documents"), "lang")


@query(f"""
    SELECT count(*) FILTER (WHERE split = 'train') AS train,
           count(*) FILTER (WHERE split = 'test') AS test
    FROM (SELECT {sql_split('doc_id')} AS split FROM documents) s""")
def split_counts(spark, folder):
    return splits.split_counts(_split_documents(spark, folder))


@query("SELECT doc_id, text FROM documents ORDER BY doc_id LIMIT 100")
def head_n(spark, folder):
    return splits.head(table(spark, folder, "documents").select("doc_id", "text"), "doc_id", 100)


@query("""
    SELECT doc_id, lang FROM documents ORDER BY doc_id LIMIT (SELECT count(*) // 2 FROM documents)""")
def head_half(spark, folder):
    """A first-n too large for one task: rows numbered over all tasks."""
    documents = table(spark, folder, "documents").select("doc_id", "lang")
    numbered = with_position(documents, [], "doc_id")
    return numbered.where(F.col("position") <= documents.count() // 2).drop("position")


@query("SELECT doc_id, text FROM documents ORDER BY doc_id LIMIT 5 OFFSET 20")
def page_rows(spark, folder):
    documents = table(spark, folder, "documents").select("doc_id", "text")
    return catalog.page_rows(documents, "doc_id", offset=20, length=5)


@query("""
    SELECT doc_id, category, question, example_answer,
           coalesce(correctness, '') AS correctness FROM ({}) r""".format(RECORDS_SQL))
def records_roundtrip(spark, folder):
    """Records written as JSON and read again."""
    path = fresh_dir(spark, "records")
    record_files.write_records(records(spark, folder), path)
    schema = (
        "doc_id BIGINT, category STRING, question STRING, example_answer STRING, correctness STRING"
    )
    return record_files.read_records(spark, path, schema).withColumn(
        "correctness", F.coalesce("correctness", F.lit(""))
    )


@query("""
    SELECT n_chars % 11 = 0 AS is_corrupt, CASE WHEN n_chars % 11 != 0 THEN lang END AS lang,
           count(*) AS entries
    FROM documents GROUP BY ALL""")
def read_with_rejects(spark, folder):
    """A JSON file with malformed records: they are counted, not fatal."""
    path = fresh_dir(spark, "damaged")
    damaged_json(spark, folder).select(F.col("raw").alias("value")).write.text(path)
    read = record_files.read_with_rejects(spark, path, DOCUMENT)
    bad = F.col("corrupt").isNotNull()
    return read.groupBy(
        bad.alias("is_corrupt"), F.when(~bad, F.col("lang")).alias("lang")
    ).agg(F.count(F.lit(1)).alias("entries"))


@query(f"""
    SELECT doc_id, prompt, completion FROM ({PAIRS_SQL}) p
    WHERE {sql_split('doc_id')} = 'train'""")
def split_roundtrip(spark, folder):
    """A split dataset on disk, one split read back."""
    path = fresh_dir(spark, "split")
    examples = splits.train_test_split(prompt_completion(spark, folder), "doc_id")
    split_files.write_split(examples, path)
    return split_files.load_dataset(spark, path, "train").drop("split")


@query(f"""
    SELECT doc_id, 'train' AS split FROM documents WHERE {sql_split('doc_id')} = 'train'
    UNION ALL SELECT doc_id, 'test' FROM documents WHERE {sql_split('doc_id')} = 'test'
    UNION ALL SELECT item_id, 'train' FROM benchmark""")
def save_version(spark, folder):
    """A merged version written beside the one it was read from; the newest is read."""
    base = fresh_dir(spark, "versions")
    first = splits.train_test_split(table(spark, folder, "documents").select("doc_id"), "doc_id")
    split_files.save_version(first, base, "20240101T000000")
    added = table(spark, folder, "benchmark").select(F.col("item_id").alias("doc_id"))
    merged = synth.merge_batch(split_files.read_version(spark, base), added)
    split_files.save_version(merged, base, "20240102T000000")
    return split_files.read_version(spark, base)


@query("""
    SELECT doc_id AS id, text FROM documents UNION ALL SELECT item_id, text FROM benchmark""")
def concat_corpora(spark, folder):
    documents = table(spark, folder, "documents").select(F.col("doc_id").alias("id"), "text")
    items = table(spark, folder, "benchmark").select(F.col("item_id").alias("id"), "text")
    return synth.concat(documents, items)
