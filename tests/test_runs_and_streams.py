"""Run metrics, logs, telemetry, streams and batch inference."""

import datetime as dt

import uuid

import pytest
from pyspark.sql import functions as F

from tunewright.operators import infer, metrics, monitor
from tunewright.queries.adapt import as_lines, as_metrics
from tunewright.schemas import EVENTS
from tunewright.streaming import files, liveness

T0 = dt.datetime(2024, 1, 1)


def _losses(spark, rows):
    return spark.createDataFrame(rows, "run STRING, step BIGINT, metric STRING, value DOUBLE")


def test_overfit(spark):
    df = _losses(
        spark,
        [
            ("flagged", 1, "train_loss", 9.0), ("flagged", 2, "train_loss", 1.0),
            ("flagged", 2, "eval_loss", 1.6),
            ("fine", 1, "train_loss", 1.0), ("fine", 1, "eval_loss", 1.5),
            ("zero", 1, "train_loss", 0.0), ("zero", 1, "eval_loss", 1.0),
            ("missing", 1, "eval_loss", 1.0),
        ],
    )
    got = {r.run: r.overfitting for r in metrics.overfit_check(df).collect()}
    assert got == {"flagged": True, "fine": False, "zero": None, "missing": None}


def test_throughput(spark):
    rows = [("r", 0, T0), ("r", 120, T0 + dt.timedelta(seconds=60)), ("one", 1, T0)]
    df = spark.createDataFrame(rows, "run STRING, step BIGINT, ts TIMESTAMP")
    got = {r.run: r for r in metrics.throughput(df).collect()}
    assert (got["r"].steps_per_second, got["r"].minutes) == (2.0, 1.0)
    assert got["one"].steps_per_second is None


def test_checkpoints(spark):
    paths = ["checkpoint-9", "checkpoint-100", "model.safetensors", "checkpoint-45", "checkpoint-x"]
    df = spark.createDataFrame(
        [("r", f"models/r/{p}") for p in paths] + [("none", "models/none/log")], "run STRING, path STRING"
    )
    latest = {r.run: r.path for r in metrics.latest_checkpoint(df).collect()}
    assert latest == {"r": "models/r/checkpoint-100", "none": None}
    kept = metrics.retained_checkpoints(df, 2).orderBy("rank").collect()
    assert [r.step for r in kept] == [100, 45]


def test_compare_and_filter(spark):
    rows = [("p", "r1", 1, "a", 1.0), ("p", "r1", 2, "a", 2.0), ("q", "r2", 1, "a", 3.0)]
    df = spark.createDataFrame(rows, "project STRING, run STRING, step BIGINT, metric STRING, value DOUBLE")
    got = metrics.compare_runs(metrics.filter_project(df, "p"), ["a", "b"]).collect()
    assert [tuple(r) for r in got] == [("r1", 2.0, None)]


def test_liveness(spark):
    now = T0 + dt.timedelta(seconds=1201)
    rows = [("exact", T0 + dt.timedelta(seconds=1)), ("late", T0)]
    df = spark.createDataFrame(rows, "log STRING, ts TIMESTAMP")
    expected = spark.createDataFrame([("exact",), ("late",), ("unknown",)], "log STRING")
    got = {
        r.log: (r.age_seconds, r.status)
        for r in monitor.liveness(df, "log", F.lit(now), expected).collect()
    }
    assert got == {
        "exact": (1200, "ACTIVE"), "late": (1201, "INACTIVE"), "unknown": (None, "MISSING"),
    }


def test_gpu_line(spark):
    df = spark.createDataFrame([("0, NVIDIA A10G, 97, 41, 23028, 9731, 63",)], "line STRING")
    assert tuple(monitor.parse_gpu(df).first())[1:] == (0, "NVIDIA A10G", 97, 41, 23028, 9731, 63)


def _log(spark, rows):
    return spark.createDataFrame(
        [(r, lg, p, i, T0 + dt.timedelta(minutes=i), line) for i, (r, lg, p, line) in enumerate(rows)],
        "run STRING, log STRING, priority INT, seq BIGINT, ts TIMESTAMP, line STRING",
    )


def test_preferred_log_and_tail(spark):
    lines = _log(
        spark,
        [("a", "fresh", 0, "x"), ("a", "old", 1, "y"), ("b", "old", 1, "z"), ("a", "fresh", 0, "w"),
         (None, "old", 1, "n")],
    )
    kept = monitor.prefer_log(lines)
    assert sorted(r.line for r in kept.collect()) == ["n", "w", "x", "z"]
    tail = monitor.tail_log(kept, 1, by="run").collect()
    assert sorted(r.line for r in tail) == ["n", "w", "z"]


def test_match_lines(spark):
    lines = _log(spark, [("a", "l", 0, "python train.py"), ("a", "l", 0, "grep train.py"), ("b", "l", 0, "idle")])
    got = monitor.match_lines(lines, "train[.]py", "grep", by="run", none_message="no training process")
    assert sorted((r.run, r.line) for r in got.collect()) == [
        ("a", "python train.py"), ("b", "no training process"),
    ]
    assert monitor.match_lines(lines, "train").count() == 2


def test_monitor_inherits_its_last_update(spark):
    rows = [(1, None), (2, T0 + dt.timedelta(minutes=20)), (3, None), (4, None)]
    df = spark.createDataFrame(
        [("r", T0 + dt.timedelta(minutes=15 * i), T0 + dt.timedelta(minutes=15 * (i + 1)), m) for i, m in rows],
        "run STRING, window_start TIMESTAMP, window_end TIMESTAMP, monitor_ts TIMESTAMP",
    )
    got = monitor.monitor_status(df, ["run"]).orderBy("window_start").collect()
    assert [r.status for r in got] == ["MISSING", "INACTIVE", "INACTIVE", "INACTIVE"]
    assert [r.age_seconds for r in got] == [None, 1500, 2400, 3300]


def _snapshots(spark, rows, readings=(), every=600, **options):
    """rows: (run, minute, priority, line); readings: (run, minute, line)."""
    lines = spark.createDataFrame(
        [(r, p, i, None if m is None else T0 + dt.timedelta(minutes=m), line) for i, (r, m, p, line) in enumerate(rows)],
        "run STRING, priority INT, seq BIGINT, ts TIMESTAMP, line STRING",
    )
    gpu = spark.createDataFrame(
        [(r, i, T0 + dt.timedelta(minutes=m), line) for i, (r, m, line) in enumerate(readings)], "run STRING, seq BIGINT, ts TIMESTAMP, line STRING"
    )
    whole = monitor.heartbeat_full(lines, gpu, every, "python", "grep", **options)
    return {(r.run, int((r.tick_ts - T0).total_seconds() // 60)): r for r in whole.collect()}


def test_a_whole_heartbeat_has_silent_ticks(spark):
    rows = [
        ("a", 0, 1, "python x"), ("a", 0.5, 1, "python grep"), ("a", 25, 0, "first"), ("a", 30, 0, "models/checkpoint-7"),
        ("a", 31, 0, "third"), ("b", 10, 2, "watching"), ("a", 55, 0, "models/checkpoint-3"), ("b", None, 0, "no time"),
    ]
    readings = [("a", 3, "0, G, 50, 1, 2, 3, 40"), ("a", 12, "0, G, 60, 1, 2, 3, 41"), ("a", 11, "0, G, 99, 1, 2, 3, 41")]
    got = _snapshots(spark, rows, readings, n=2, n_monitor=1, sources=spark.createDataFrame([("never",)], "run STRING"))
    assert sorted(got) == [(run, m) for run in ("a", "b", "never") for m in range(0, 61, 10)]
    a = [got["a", m] for m in range(0, 61, 10)]
    assert [r.processes for r in a] == [1, 0, 0, 0, 0, 0, 0]
    assert [r.process_note for r in a] == [None] + ["no training process"] * 6
    assert [r.util for r in a] == [None, 50, 60, 60, 60, 60, 60] and a[0].gpu_note and not a[1].gpu_note
    assert [r.checkpoint for r in a] == [None, None, None, 7, 7, 7, 7]
    fallback, primary = "python x\npython grep", "first\nmodels/checkpoint-7"
    assert [r.tail for r in a] == ["python x", fallback, fallback, primary, "models/checkpoint-7\nthird", "models/checkpoint-7\nthird", "third\nmodels/checkpoint-3"]
    b = [got["b", m] for m in range(0, 61, 10)]
    assert [r.status for r in b] == ["MISSING", "ACTIVE", "ACTIVE", "ACTIVE", "INACTIVE", "INACTIVE", "INACTIVE"]
    assert [r.age_seconds for r in b] == [None, 0, 600, 1200, 1800, 2400, 3000] and b[3].monitor_tail == "watching" and b[3].tail is None
    assert {got["never", m].status for m in range(0, 61, 10)} == {"MISSING"}


def test_tails_reach_over_ticks_and_are_cut_in_each(spark):
    rows = [("r", m / 10, 0, f"line {m}") for m in range(1, 400)] + [("r", 50 + m, 0, f"late {m}") for m in (1, 11, 21)]
    got = _snapshots(spark, rows, n=3)
    assert got["r", 10].tail == "line 98\nline 99\nline 100" and got["r", 40].tail == "line 397\nline 398\nline 399" == got["r", 50].tail
    assert got["r", 60].tail == "line 398\nline 399\nlate 1" and got["r", 80].tail == "late 1\nlate 11\nlate 21"


def test_heartbeats_of_nothing(spark):
    assert _snapshots(spark, []) == {} and _snapshots(spark, [("r", None, 0, "x")]) == {}
    (row,) = _snapshots(spark, [(None, 0, 0, None)]).values()
    assert (row.run, row.processes, row.tail) == (None, 0, "")


def test_a_busy_source_is_cut_before_it_is_sorted(spark, plan):
    """Windows sort ticks of a source, or pieces of one tick, never the lines of a source."""
    events = files.event_time(spark.read.parquet("/root/testdata/sf0.001/events.parquet"))
    lines = as_lines(events)
    text = plan(monitor.heartbeat_full(lines, lines.select("run", "seq", "ts", "line"), 900, "x"))
    windows = [line for line in text.splitlines() if " Window " in line]
    assert windows and all("tick" in line for line in windows)


# ---- streams ----


@pytest.fixture(scope="module")
def event_folders(spark, tmp_path_factory):
    """The events in one file, and in many files in order of time."""
    base = tmp_path_factory.mktemp("events")
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    events.coalesce(1).write.parquet(str(base / "one"))
    for day in range(6):
        part = events.where(f"dayofmonth(ts) div 6 = {day}").coalesce(1)
        part.write.mode("append").parquet(str(base / "many"))
    return {"one": str(base / "one"), "many": str(base / "many")}


def _stream(spark, folders, form):
    stream = files.read_stream(spark, folders[form], EVENTS, max_files=1000 if form == "one" else 1)
    return files.event_time(stream)


def _run(started):
    started.awaitTermination()
    assert started.exception() is None


def test_heartbeats_are_the_same_from_one_file_and_many(spark, event_folders, tmp_path):
    got = {}
    for form in event_folders:
        beats = monitor.heartbeat(
            as_lines(_stream(spark, event_folders, form)), "5 minutes", watermark="10 minutes"
        )
        out = str(tmp_path / form)
        _run(files.append_report(beats, out, str(tmp_path / f"{form}-state")))
        got[form] = sorted(tuple(r) for r in spark.read.parquet(out).collect())
    assert got["one"] == got["many"] and len(got["one"]) > 100


@pytest.mark.parametrize("again", [False, True])
def test_the_last_windows_are_in_a_finished_report_once(spark, event_folders, tmp_path, again):
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    parts = monitor.snapshot_parts(include="^purchase")
    events = files.event_time(spark.read.parquet(event_folders["many"]))
    want = monitor.heartbeat(as_lines(events), "5 minutes", extra=parts)
    for _ in range(1 + again):  # started and finished again, it adds nothing
        beats = monitor.heartbeat(
            as_lines(_stream(spark, event_folders, "many")), "5 minutes", watermark="10 minutes", extra=parts
        )
        _run(files.append_report(beats, out, state))
        files.finish_report(spark, out, state, monitor.SNAPSHOT_STATE)
    got = files.read_report(spark, out)
    rows = lambda df: sorted(map(str, df.select(sorted(df.columns)).collect()))
    assert spark.read.parquet(out).count() < want.count() and rows(got) == rows(want)


def test_a_stream_goes_on_after_a_finish(spark, event_folders, tmp_path):
    """Windows that were open at a finish and closed later are those of the whole stream."""
    source, out, state = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state")
    events = files.event_time(spark.read.parquet(event_folders["many"]))
    middle = events.agg(F.percentile_approx("event_id", 0.5)).first()[0]
    for some in (events.where(F.col("event_id") <= middle), events.where(F.col("event_id") > middle)):
        some.write.mode("append").parquet(source)
        stream = files.read_stream(spark, source, EVENTS)
        _run(files.append_report(monitor.heartbeat(as_lines(files.event_time(stream)), by=("run",), watermark="0 seconds"), out, state))
        files.finish_report(spark, out, state, {k: v for k, v in monitor.SNAPSHOT_STATE.items() if k[:1] == "l"})
    got = files.read_report(spark, out, ("window_start", "run")).select("run", "window_start", "lines", "last_line")
    want = monitor.heartbeat(as_lines(events), by=("run",)).select("run", "window_start", "lines", "last_line")
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_state_of_other_aggregates_is_refused(spark, event_folders, tmp_path):
    state = str(tmp_path / "state")
    means = as_lines(_stream(spark, event_folders, "one")).withWatermark("ts", "0 seconds").groupBy(F.window("ts", "1 hour").alias("w"))
    _run(files.append_report(means.agg(F.avg("value").alias("mean")), str(tmp_path / "out"), state))
    assert all(r.mean is not None for r in files.open_windows(spark, state, {"mean": "mean"}).collect())
    with pytest.raises(ValueError):
        files.open_windows(spark, state, {"mean": "last"})


def _liveness(spark, folder, tmp_path, expected=None, **options):
    name = uuid.uuid4().hex
    stream = files.event_time(files.read_stream(spark, folder, EVENTS, max_files=1))
    reports = liveness.liveness_stream(stream, "user_id", expected, **options)
    _run(files.append_report(reports, str(tmp_path / name), str(tmp_path / f"{name}-state")))
    return spark.read.parquet(str(tmp_path / name))


def _events(spark, rows):
    return spark.createDataFrame([(i, T0 + dt.timedelta(seconds=s), u, "view", 1.0, "{}") for i, (u, s) in enumerate(rows)], EVENTS.replace("TIMESTAMP_NTZ", "TIMESTAMP"))


@pytest.mark.parametrize("order", ["ts", "-ts", "hash"])
def test_liveness_is_the_same_in_any_order_of_files(spark, tmp_path, order):
    """Rows of sources long silent come after newer rows of others, a file at a time."""
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").where("user_id % 4 > 0 OR dayofmonth(ts) < 20")
    span = "dayofmonth(ts) div 9"
    places = [r[0] for r in events.selectExpr(f"{span} AS d").distinct().orderBy("d").collect()]
    places = {"ts": places, "-ts": places[::-1], "hash": sorted(places, key=lambda d: d * 3 % 5)}[order]
    folder = str(tmp_path / "in")
    for place in places:  # files are taken in order of their time
        events.where(f"{span} = {place}").coalesce(1).write.mode("append").parquet(folder)
    expected = spark.range(-2, 15).withColumnRenamed("id", "user_id")
    final = liveness.latest_status(_liveness(spark, folder, tmp_path, expected))
    got = {r.source: (r.last_ts, r.status) for r in final.select("source", F.col("last_ts").cast("timestamp_ntz").alias("last_ts"), "status").collect()}
    newest = events.agg(F.max("ts")).first()[0]
    want = {str(i): (None, "MISSING") for i in range(-2, 15)}
    for r in events.groupBy("user_id").agg(F.max("ts").alias("ts")).collect():
        age = newest - r.ts
        want[str(r.user_id)] = (r.ts, "ACTIVE" if age <= dt.timedelta(seconds=1200) else "INACTIVE")
    assert got == want and len({s for _, s in got.values()}) == 3


def test_silence_starts_right_after_its_limit(spark, tmp_path):
    folder = str(tmp_path / "in")
    for rows in ([(1, 0), (2, 0.001), (3, 5)], [(4, 1200.001)]):
        _events(spark, rows).coalesce(1).write.mode("append").parquet(folder)
    final = {r.source: r.status for r in liveness.latest_status(_liveness(spark, folder, tmp_path)).collect()}
    assert final == {"1": "INACTIVE", "2": "ACTIVE", "3": "ACTIVE", "4": "ACTIVE"}


def test_a_source_comes_back(spark, tmp_path):
    folder = str(tmp_path / "in")
    expected = spark.createDataFrame([(1,), (9,), (9,)], "user_id BIGINT")
    for rows in ([(1, 0), (1, 0)], [(2, 5000)], [(1, 9000), (9, 9000)], [(1, 100), (None, 8000)]):
        _events(spark, rows).coalesce(1).write.mode("append").parquet(folder)
    reports = _liveness(spark, folder, tmp_path, expected)
    said = {s: sorted(((r.last_ts - T0).total_seconds() if r.last_ts else -1.0, r.status) for r in reports.where(F.col("source") == s).collect()) for s in ("1", "9")}
    assert said["1"] == [(0.0, "ACTIVE"), (0.0, "INACTIVE"), (9000.0, "ACTIVE")]
    assert {status for _, status in said["9"]} == {"MISSING", "ACTIVE"}
    final = {r.source: r.status for r in liveness.latest_status(reports).collect()}
    assert final == {"1": "ACTIVE", "2": "INACTIVE", "9": "ACTIVE", None: "ACTIVE"}


def test_liveness_deals_sources_to_buckets(spark, tmp_path):
    """Many sources share a few calls of the state store, and few buckets give what many give."""
    folder = str(tmp_path / "in")
    for rows in ([(i, i) for i in range(500)], [(i, 5000 + i) for i in range(250, 750)], [(i, 200 + i) for i in range(100)] + [(None, 5600)]):
        _events(spark, rows).coalesce(1).write.mode("append").parquet(folder)
    expected = spark.createDataFrame([(i,) for i in [*range(0, 1500, 3), None]], "user_id BIGINT")
    few, many = ([tuple(r) for r in _liveness(spark, folder, tmp_path, expected, buckets=n).collect()] for n in (3, 4096))
    assert sorted(few, key=str) == sorted(many, key=str)
    assert sorted(int(s) for s, _, status in few if status == "MISSING" and s) == list(range(750, 1500, 3))
    final = {r.source: r.status for r in liveness.latest_status(spark.createDataFrame(few, "source STRING, last_ts TIMESTAMP, status STRING")).collect()}
    assert final[None] == "ACTIVE" and len(final) == 750 + 250 + 1
    assert {s for s, status in final.items() if status == "ACTIVE" and s} == {str(i) for i in range(250, 750)}


def test_final_flush_goes_on_where_the_last_one_ended(spark, event_folders, tmp_path):
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    for _ in range(2):
        stream = as_metrics(_stream(spark, event_folders, "many"))
        _run(files.sync_metrics(stream, out, state, final=True))
    assert spark.read.parquet(out).count() == 1000


def test_a_bounded_stream_takes_the_bound_and_no_more(spark, event_folders, tmp_path):
    for form in event_folders:
        out, state = str(tmp_path / form), str(tmp_path / f"{form}-state")
        for _ in range(2):  # started again, it takes nothing more
            stream = files.read_stream(spark, event_folders[form], EVENTS, max_files=1)
            _run(files.stream_dataset(stream, out, state, "event_id", max_steps=50, rows_per_step=8))
        taken = spark.read.parquet(out)
        assert taken.count() == 400 == taken.select("event_id").distinct().count()


def test_a_short_stream_is_taken_whole(spark, event_folders, tmp_path):
    out = str(tmp_path / "all")
    stream = files.read_stream(spark, event_folders["many"], EVENTS, max_files=2)
    _run(files.stream_dataset(stream, out, str(tmp_path / "s"), "event_id", 10**6, 8))
    assert spark.read.parquet(out).count() == 1000


# ---- inference ----


def test_requests_have_defaults_and_errors(spark):
    df = spark.createDataFrame(
        [(1, "hi", None, None), (2, "", 5, 0.0), (3, None, 5, 0.1)],
        "id BIGINT, prompt STRING, max_new_tokens INT, temperature DOUBLE",
    )
    rows = infer.prepare_requests(df).orderBy("id").collect()
    assert (rows[0].max_new_tokens, rows[0].temperature, rows[0].do_sample, rows[0].error) == (64, 0.0, False, None)
    assert [r.error for r in rows[1:]] == ["missing prompt", "missing prompt"]
    assert rows[2].do_sample
    bare = infer.prepare_requests(df.select("id", "prompt")).orderBy("id").first()
    assert (bare.max_new_tokens, bare.temperature) == (64, 0.0)


def test_generation_failures_are_rows(spark):
    def load():
        return "model"

    def broken_load():
        raise RuntimeError("no weights")

    def generate(model, prompts, max_new_tokens, temperature, do_sample):
        if "boom" in prompts:
            raise ValueError("bad prompt")
        return [f"{model}/{prompt}/{max_new_tokens}/{temperature}/{do_sample}" for prompt in prompts]

    df = spark.createDataFrame([(1, "hi"), (2, "boom"), (3, "")], "id BIGINT, prompt STRING")
    requests = infer.prepare_requests(df)
    got = {r.id: tuple(r)[1:] for r in infer.batch_generate(requests, load, generate).collect()}
    assert got == {
        1: ("model/hi/64/0.0/False", None, None),
        2: (None, "generation_failed", "bad prompt"),
        3: (None, "missing prompt", None),
    }
    broken = infer.batch_generate(requests, broken_load, generate).orderBy("id").collect()
    assert [r.error for r in broken] == ["model not loaded", "model not loaded", "missing prompt"]
    assert broken[0].detail == "no weights"


def test_a_failed_load_is_not_tried_again(spark, tmp_path):
    def broken_load():
        (tmp_path / uuid.uuid4().hex).touch()
        raise RuntimeError("no weights")

    requests = infer.prepare_requests(spark.range(100).coalesce(1).selectExpr("id", "'hi' AS prompt"))
    rows = infer.batch_generate(requests, broken_load, lambda *a: []).collect()
    assert {r.error for r in rows} == {"model not loaded"} and len(rows) == 100
    assert len(list(tmp_path.iterdir())) == 1


def test_two_tokenizers_in_one_session(spark):
    df = spark.createDataFrame([("a bb",)], "text STRING").coalesce(1)
    for n in (1, 2):
        ids = infer.tokenize(F.col("text"), lambda n=n: lambda texts: [[n] for _ in texts])
        assert df.select(ids.alias("ids")).first().ids == [n]
