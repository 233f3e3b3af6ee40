"""The pipeline over odd rows, and its stages by what they keep."""

import os
import random

import pytest

import corpus_pipeline
from tunewright.llm import common
from tunewright.session import shared_dir

WORDS = "the river runs past old mill and people of town walk there in evening while children play near bridge".split()


def _tables(spark, folder, rows):
    full = [(i, t, "en", s, len(t or ""), 1, "k") for i, t, s in rows]
    spark.createDataFrame(full, "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG, size LONG, source_size STRING").write.parquet(f"{folder}/documents.parquet")
    labels = [(i, int(not (t or "").isupper()), 0) for i, t, _ in rows if i is not None and i < 150]
    spark.createDataFrame(labels, "doc_id LONG, quality INT, toxic INT").write.parquet(f"{folder}/labels.parquet")


def _rows():
    rnd, rows = random.Random(3), []
    for i in range(220):
        text = " ".join(rnd.choices(WORDS, k=60))
        rows.append((i, text.upper().replace(" ", "!! ") if i % 4 == 0 and i < 150 else text, f"s{i % 3}"))
    near = rows[201][1].split()
    near[30] = "meadow"
    rows += [(300, rows[201][1], "s0"), (301, " ".join(near), "s1"), (302, rows[202][1], None), (302, rows[202][1], None)]
    return rows + [(400, None, "s0"), (401, "", "s1"), (402, "12 34 ...", "s2"), (None, " ".join(rnd.choices(WORDS, k=300)), "s2")]


def test_each_stage_keeps_what_it_should(spark, tmp_path):
    folder = str(tmp_path)
    rows = _rows()
    _tables(spark, folder, rows)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        out.write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        kept[name] = docs.collect()
        assert docs.columns == columns or name == "packing"
    ids = {name: {r.doc_id for r in got} for name, got in kept.items()}
    shouting = {i for i, t, _ in rows if t and t.isupper() and i is not None and i < 150}
    assert not shouting & ids["quality"] and len(ids["quality"]) > 160
    assert not {400, 401, 402} & ids["language"] and ids["language"] == ids["quality"] - {400, 401, 402}
    assert not {300, 301, 302} & ids["near_duplicates"] and {201, 202} <= ids["near_duplicates"] == ids["language"] - {300, 301, 302}
    assert ids["mixing"] <= ids["near_duplicates"] and len(ids["mixing"]) > 100
    assert ids["packing"] == ids["mixing"]
    times = sum(1 for _ in kept["mixing"])
    assert sum(r.start == 0 for r in kept["packing"]) == times


def test_run_is_its_stages_and_leaves_one_table(spark, tmp_path):
    folder = str(tmp_path)
    _tables(spark, folder, _rows())
    before = set(os.listdir(shared_dir(spark).removeprefix("file:")))
    with common.remembered() as written:
        out = corpus_pipeline.run(spark, folder)
    rows = out.collect()
    assert rows
    left = set(os.listdir(shared_dir(spark).removeprefix("file:"))) - before
    assert len(written) > 10 and {name.rsplit("-", 1)[0] for name in left} == {"mixing"}
    assert sorted(map(str, corpus_pipeline.run(spark, folder).select("doc_id", "start", "length", "ids_crc32").collect())) == sorted(
        map(str, out.select("doc_id", "start", "length", "ids_crc32").collect())
    )


@pytest.mark.parametrize("rows", [[], [(1, None, None)]])
def test_nothing_passes_through(spark, tmp_path, rows):
    _tables(spark, str(tmp_path), rows)
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
