"""Splits and the operators that must hold when one group has much of the data."""

import random
from collections import Counter, defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tunewright.operators import chat, metrics, monitor, split
from tunewright.operators.gather import gather, row_octets
from tunewright.operators.ranged import with_position
from tunewright.session import setting
from tunewright.sources import catalog


def _splits(df):
    return {r.id: r.split for r in df.collect()}


def test_split_is_complete_and_stable(spark):
    df = spark.range(2000)
    first = _splits(split.train_test_split(df, "id"))
    assert set(first.values()) == {"train", "test"} and len(first) == 2000
    assert 120 < sum(v == "test" for v in first.values()) < 280
    assert _splits(split.train_test_split(df.repartition(7), "id")) == first
    longer = _splits(split.train_test_split(spark.range(3000), "id"))
    assert all(longer[k] == v for k, v in first.items())
    assert _splits(split.train_test_split(df, "id", seed=1)) != first


def test_split_does_not_shuffle(spark, plan):
    assert "Exchange" not in plan(split.train_test_split(spark.range(10), "id"))


def test_no_test_set(spark):
    assert set(_splits(split.train_test_split(spark.range(50), "id", 0)).values()) == {"train"}


@pytest.mark.parametrize("rows", [0, 1, 9, 1001])
@pytest.mark.parametrize("size", [0.1, 0.34, 1.0])
def test_exact_split(spark, rows, size):
    got = _splits(split.train_test_split(spark.range(rows), "id", size, exact=True))
    assert len(got) == rows
    assert sum(v == "test" for v in got.values()) == -int(-rows * size // 1)


def test_exact_split_keeps_copies_together(spark):
    df = spark.range(100).unionAll(spark.range(1).join(spark.range(50).select(), how="cross"))
    rows = split.train_test_split(df, "id", 0.1, exact=True).collect()
    sides = defaultdict(set)
    for r in rows:
        sides[r.id].add(r.split)
    assert len(rows) == 150 and all(len(s) == 1 for s in sides.values())
    assert sum(r.split == "test" for r in rows) >= 15


def test_counts_of_no_data(spark):
    empty = spark.range(0).withColumn("split", F.lit("train"))
    assert tuple(split.split_counts(empty).first()) == (0, 0)


@pytest.mark.parametrize("top", [10**5, 1])
def test_head_and_pages(spark, monkeypatch, top):
    for module in (split, catalog):
        monkeypatch.setattr(module, "TOP_ROWS", top)  # top rows, or rows numbered over all tasks
    df = spark.range(1000).select((F.col("id") * 7 % 1000).alias("id"))
    assert sorted(r.id for r in split.head(df, "id", 130).collect()) == list(range(130))
    assert sorted(r.id for r in split.head(df, "id", 3).collect()) == [0, 1, 2]
    assert split.head(df, "id", 5000).count() == 1000
    page = catalog.page_rows(df, "id", 990, 20)
    assert sorted(r.id for r in page.collect()) == list(range(990, 1000))
    assert sorted(r.id for r in catalog.page_rows(df, "id", 5, 2).collect()) == [5, 6]
    assert catalog.page_rows(df, "id", 2000, 20).collect() == [] == split.head(df.limit(0), "id", 4).collect()


def test_pages_with_ties_and_nulls(spark):
    keys = [None, None, 1, 1, 1, 2, 3, 3, 4]
    df = spark.createDataFrame([(k, f"v{i}") for i, k in enumerate(keys)], "k INT, v STRING")
    for offset in range(10):
        for length in range(1, 10):
            got = [r.k for r in catalog.page_rows(df, "k", offset, length).collect()]
            assert got == keys[offset : offset + length]


def test_a_page_reads_whole_rows_only_between_its_keys(spark, plan, folder):
    documents = spark.read.parquet(f"{folder}/documents.parquet")
    text = plan(split.head(documents, "doc_id", 10))
    assert "LessThanOrEqual(doc_id,9)" in text and "GreaterThanOrEqual(doc_id,0)" in text


def test_config_falls_back_to_the_first_by_name(spark):
    rows = spark.createDataFrame([("b", "train"), ("a", "test")], "config STRING, split STRING")
    known = catalog.split_catalog(rows)
    assert tuple(catalog.choose_config(known, "b", "train").first()) == ("b", "train", True)
    assert tuple(catalog.choose_config(known, "b", "test").first()) == ("a", "test", False)


def test_position_with_a_hot_group_and_null_keys(spark):
    rnd = random.Random(1)
    rows = [(rnd.choice(["hot"] * 8 + ["a", None]), i) for i in rnd.sample(range(100000), 3000)]
    df = spark.createDataFrame(rows, "k STRING, s BIGINT")
    got = with_position(df, ["k"], "s").collect()
    want = {}
    for k in {k for k, _ in rows}:
        for i, s in enumerate(sorted(s for key, s in rows if key == k)):
            want[(k, s)] = i + 1
    assert {(r.k, r.s): r.position for r in got} == want


@pytest.mark.parametrize("partitions", ["3", "8", "40"])
def test_position_with_many_copies(spark, partitions):
    rows = [("a", 5, "x")] * 700 + [("a", 5, "y")] * 30 + [("a", i, "z") for i in range(40)]
    rows += [(None, 7, "x")] * 90 + [("b", i * 3, "w") for i in range(50)]
    df = spark.createDataFrame(rows, "k STRING, s BIGINT, v STRING")
    with setting(spark, "spark.sql.shuffle.partitions", partitions), setting(spark, "spark.sql.adaptive.coalescePartitions.enabled", "false"):
        got = with_position(df, ["k"], "s").collect()
    assert Counter((r.k, r.s, r.v) for r in got) == Counter(rows)
    for k in ("a", "b", None):
        mine = sorted((r.position, r.s) for r in got if r.k == k)
        assert [p for p, _ in mine] == list(range(1, len(mine) + 1))
        assert [s for _, s in mine] == sorted(s for _, s in mine)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(k=st.integers(1, 9), parts=st.integers(1, 40), batch=st.integers(1, 30), seed=st.integers(0, 99))
def test_smoothing_across_ranges_is_exact(spark, k, parts, batch, seed):
    rnd = random.Random(seed)
    rows = [(rnd.choice("ab"), "m", s, rnd.random()) for s in rnd.sample(range(1000), 120)]
    df = spark.createDataFrame(rows, "run STRING, metric STRING, step BIGINT, value DOUBLE")
    with setting(spark, "spark.sql.shuffle.partitions", str(parts)), setting(spark, "spark.sql.adaptive.coalescePartitions.enabled", "false"):
        with setting(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", str(batch)):
            got = metrics.smooth(df, k).collect()
    assert len(got) == len(rows)
    for run in "ab":
        points = sorted((s, v) for r, _, s, v in rows if r == run)
        smoothed = {r.step: r.smoothed for r in got if r.run == run}
        for i, (s, _) in enumerate(points):
            last = [v for _, v in points[max(0, i - k + 1) : i + 1]]
            assert smoothed[s] == pytest.approx(sum(last) / len(last))


def test_smoothing_with_nulls_and_many_runs(spark):
    rows = [(None, "m", i, None if i % 3 == 0 else float(i)) for i in range(40)] + [(f"r{i}", "m", 1, 2.0) for i in range(60)]
    df = spark.createDataFrame(rows, "run STRING, metric STRING, step BIGINT, value DOUBLE")
    got = {(r.run, r.step): r.smoothed for r in metrics.smooth(df, 2).collect()}
    assert got[None, 0] is None and got[None, 3] == 2.0 and got[None, 5] == 4.5 and all(got[f"r{i}", 1] == 2.0 for i in range(60))
    assert metrics.smooth(df.limit(0), 3).collect() == []


def test_one_cell_of_distinct_rows_is_on_several_tasks(spark, plan):
    """200,000 rows of one group and place: one shuffle, and no task holds them all."""
    df = spark.range(200_000).selectExpr("1 AS k", "7 AS s", "id AS v")
    with setting(spark, "spark.sql.adaptive.coalescePartitions.enabled", "false"):
        got = with_position(df, ["k"], "s")
        sizes = got.groupBy(F.spark_partition_id()).count().collect()
        assert len(sizes) >= 6 and max(r["count"] for r in sizes) < 60_000
        assert tuple(got.agg(F.min("position"), F.max("position"), F.count_distinct("position")).first()) == (1, 200_000, 200_000)
        assert "Exchange" not in plan(got) and "Window" not in plan(got)


def _turns(spark):
    rnd = random.Random(3)
    rows = [(c, t, rnd.choice(["user", "assistant"]), f"{c}-{t}") for c in range(40) for t in range(rnd.randint(1, 9))]
    rows += [(7, t, "user", f"long {t}") for t in range(9, 300)]  # a long conversation
    rows += [(8, 3, "user", f"other {i}") for i in range(400)]  # many turns of one number
    rows += [(9, 0, "user", "copy")] * 500  # copies of one turn
    rows += [(None, 1, "user", f"no id {i}") for i in range(100)]
    return spark.createDataFrame(rows, "conv_id INT, turn INT, role STRING, text STRING"), rows


@pytest.mark.parametrize("octets", [1600, 6000, 1 << 24])
def test_conversations_are_whole_and_no_row_is_long(spark, octets):
    df, rows = _turns(spark)
    got = chat.turns_to_conversation(df, octets_per_part=octets).collect()
    built = defaultdict(list)
    for r in sorted(got, key=lambda r: (r.conv_id is None, r.conv_id, r.part, r.slice)):
        built[r.conv_id] += [tuple(t) for t in r.conversations]
    for conv in {r[0] for r in rows}:
        by_turn = defaultdict(Counter)
        for c, t, role, text in rows:
            if c == conv:
                by_turn[t][(role, text)] += 1
        at = 0
        for t in sorted(by_turn):
            n = sum(by_turn[t].values())
            assert Counter(built[conv][at : at + n]) == by_turn[t]
            at += n
        assert at == len(built[conv])
    assert all(min(r.part for r in got if r.conv_id == conv) == 0 for conv in built)
    size = lambda r: sum(64 + len(t.role) + len(t.content) for t in r.conversations)
    assert max(map(size, got)) <= octets + 100
    alone = chat.turns_to_conversation(df.where("conv_id = 7"), octets_per_part=octets).collect()
    assert sorted(map(str, alone)) == sorted(str(r) for r in got if r.conv_id == 7)  # whatever else is in the table


def test_short_groups_take_one_shuffle(spark, plan):
    text = plan(chat.turns_to_conversation(_turns(spark)[0]))
    assert text.count("Exchange") == 1 and "Join" not in text and "Union" not in text


def test_a_long_group_is_on_several_tasks(spark, plan):
    df = spark.range(60_000).selectExpr("1 AS k", "id AS o", "repeat('x', 100) AS t")
    with setting(spark, "spark.sql.adaptive.coalescePartitions.enabled", "false"):
        got = gather(df, "k", "o", ["t"], row_octets(F.col("t")), 100_000)
        parts = got.select("part", F.size("items").alias("n"), F.spark_partition_id().alias("task")).collect()
    assert sum(r.n for r in parts) == 60_000 and max(r.n for r in parts) <= 610 and len({r.task for r in parts}) > 4


def test_gathering_any_payload(spark):
    df = spark.createDataFrame([(1, 2, [5], True), (1, 0, [3, 4], False)], "k INT, o INT, ids ARRAY<INT>, t BOOLEAN")
    items = gather(df, "k", "o", ["ids", "t"], F.lit(8)).first()["items"]
    assert [tuple(i) for i in items] == [([3, 4], False), ([5], True)]


def test_top_rows_are_cut_before_the_shuffle(spark, plan):
    lines = spark.createDataFrame([("l", 1, "x")], "log STRING, seq BIGINT, line STRING").withColumn(
        "ts", F.current_timestamp()
    )
    text = plan(monitor.tail_log(lines))
    before_shuffle = text[text.index("Exchange") :]
    assert "WindowGroupLimit" in before_shuffle and "Partial" in before_shuffle


@pytest.mark.parametrize(
    "name",
    ["chat_render_split", "cost_report", "job_report", "memory_fit", "flavor_tier", "liveness_report",
     "prefer_log", "smooth", "schema_checks", "train_test_split_exact", "synth_round_robin"],
)
def test_no_query_pairs_all_rows(spark, folder, plan, name):
    from tunewright.queries import all_queries

    text = plan(all_queries()[name](spark, folder))
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text


def test_wide_rows_are_not_sorted_for_a_join(spark, tmp_path):
    """Joins of large tables: hashed at run time where the other side's partitions are small."""
    wide = spark.range(5000).withColumn("text", F.repeat(F.lit("x"), 50))
    narrow = spark.range(5000).withColumn("q", F.col("id") % 2)
    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"), setting(
        spark, "spark.sql.adaptive.autoBroadcastJoinThreshold", "-1"
    ):
        joined = wide.join(narrow, "id", "left")
        joined.collect()
        final = joined._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "ShuffledHashJoin" in final


def test_filters_and_columns_reach_the_scan(spark, folder, plan):
    from tunewright.queries import all_queries

    text = plan(all_queries()["compare_runs"](spark, folder))
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint,event_type:string,value:double>" in text
    assert text.count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("seed", range(4))
def test_exact_split_among_copies(spark, seed):
    df = spark.range(1200).select(F.when(F.col("id") < 1000, 7).otherwise(F.col("id")).alias("k"), F.lit("x").alias("v"))
    marked = split.mark_smallest(df, "k", "m", n=10, seed=seed)
    assert marked.count() == 1200 and marked.where("m").count() == 10
    test = split.train_test_split(df, "k", 0.5, seed=seed, exact=True).where("split = 'test'")
    assert test.count() == 600


@pytest.mark.parametrize("n", [50, 1001, 5000])
def test_first_rows_of_a_hot_group(spark, n):
    df = spark.range(20000).select(F.lit("a").alias("log"), F.col("id").alias("seq"), F.lit(0).alias("ts"))
    got = monitor.tail_log(df, n)
    assert got.count() == n and got.agg(F.min("seq"), F.max("from_end")).first() == (20000 - n, n)
