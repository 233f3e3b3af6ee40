"""Queries over events: run metrics, checkpoints, logs, telemetry, streams, inference."""

from __future__ import annotations

from pyspark.sql import functions as F

from tunewright.operators import infer, metrics, monitor
from tunewright.queries.adapt import (
    GPU_SQL,
    LINES_SQL,
    METRIC_NAMES,
    METRICS_SQL,
    as_gpu_lines,
    as_lines,
    as_metrics,
    naive,
    table,
)
from tunewright.queries.registry import query, sql_draw
from tunewright.schemas import EVENTS
from tunewright.session import fresh_dir
from tunewright.streaming import files, liveness


def _metrics(spark, folder):
    return as_metrics(table(spark, folder, "events"))


def _lines(spark, folder):
    return as_lines(table(spark, folder, "events"))


@query(f"""
    SELECT run, total_steps, seconds, seconds / 60 AS minutes,
           total_steps / nullif(seconds, 0) AS steps_per_second
    FROM (SELECT run, count(*) AS total_steps,
                 (epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6 AS seconds
          FROM ({METRICS_SQL}) m GROUP BY run) t""")
def run_throughput(spark, folder):
    """Every event is a step."""
    return metrics.throughput(_metrics(spark, folder), steps=F.count(F.lit(1)))


def _last(name):
    return f"arg_max(value, step) FILTER (WHERE metric = '{name}')"


@query(f"""
    SELECT run, train_loss, eval_loss,
           CASE WHEN train_loss != 0 AND eval_loss != 0 THEN eval_loss / train_loss END AS ratio,
           CASE WHEN train_loss != 0 AND eval_loss != 0 THEN eval_loss / train_loss END > 1.5
               AS overfitting
    FROM (SELECT run, {_last('train_loss')} AS train_loss, {_last('eval_loss')} AS eval_loss
          FROM ({METRICS_SQL}) m GROUP BY run) l""")
def overfit(spark, folder):
    return metrics.overfit_check(_metrics(spark, folder))


@query(f"""
    SELECT run, {', '.join(f'{_last(n)} AS {n}' for n in METRIC_NAMES.values())}
    FROM ({METRICS_SQL}) m WHERE project = 'project-1' GROUP BY run""")
def compare_runs(spark, folder):
    """The runs of one project side by side."""
    project = metrics.filter_project(_metrics(spark, folder), "project-1")
    return metrics.compare_runs(project, list(METRIC_NAMES.values()))


@query(f"""
    SELECT grp, count(*) AS runs, sum(points)::BIGINT AS points, min(last) AS best,
           max(last) AS worst, round(avg(last), 9) AS mean
    FROM (SELECT grp, run, {_last('train_loss')} AS last, count(*) AS points
          FROM ({METRICS_SQL}) m GROUP BY grp, run) r GROUP BY grp""")
def group_runs(spark, folder):
    return metrics.group_runs(_metrics(spark, folder)).withColumn("mean", F.round("mean", 9))


@query(f"""
    SELECT run, metric, step, value,
           round(avg(value) OVER (PARTITION BY run, metric ORDER BY step
                                  ROWS BETWEEN 4 PRECEDING AND CURRENT ROW), 6) AS smoothed
    FROM ({METRICS_SQL}) m""")
def smooth(spark, folder):
    curves = metrics.smooth(_metrics(spark, folder), k=5)
    return curves.select("run", "metric", "step", "value", F.round("smoothed", 6).alias("smoothed"))


def _listing(spark, folder):
    """Views as checkpoints, other events as other files of a run's folder."""
    name = F.when(
        F.col("event_type") == "view", F.concat(F.lit("checkpoint-"), F.col("event_id"))
    ).otherwise(F.concat(F.col("event_type"), F.lit(".log")))
    return table(spark, folder, "events").select(
        F.concat(F.lit("run-"), F.col("user_id")).alias("run"),
        F.concat(F.lit("models/run-"), F.col("user_id"), F.lit("/"), name).alias("path"),
    )


LISTING_SQL = """
    SELECT 'run-' || user_id::VARCHAR AS run,
           'models/run-' || user_id::VARCHAR || '/checkpoint-' || event_id::VARCHAR AS path,
           event_id AS step
    FROM events WHERE event_type = 'view'"""


@query(f"""
    SELECT u.run, arg_max(path, step) AS path, max(step) AS step
    FROM (SELECT DISTINCT 'run-' || user_id::VARCHAR AS run FROM events) u
    LEFT JOIN ({LISTING_SQL}) l ON u.run = l.run GROUP BY u.run""")
def latest_checkpoint(spark, folder):
    return metrics.latest_checkpoint(_listing(spark, folder))


@query(f"""
    SELECT * FROM (SELECT run, path, step,
                          row_number() OVER (PARTITION BY run ORDER BY step DESC)::INTEGER AS rank
                   FROM ({LISTING_SQL}) l) r WHERE rank <= 3""")
def retained_checkpoints(spark, folder):
    return metrics.retained_checkpoints(_listing(spark, folder))


# ---- monitoring ----


HEARTBEAT_SQL = f"""
    SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS window_start,
           time_bucket(INTERVAL 5 MINUTE, ts) + INTERVAL 5 MINUTE AS window_end,
           count(*) AS lines, max(ts) AS last_ts, arg_max(line, (ts, seq)) AS last_line,
           count(*) FILTER (WHERE line LIKE 'purchase%' AND NOT line LIKE '%"k": 1%') AS processes,
           max(CASE WHEN log = 'train_fresh.log' AND line LIKE 'models/%' THEN seq END) AS checkpoint
    FROM ({LINES_SQL}) l GROUP BY ALL"""
PARTS = {"include": "^purchase", "exclude": '"k": 1'}


@query(f"""
    SELECT *, CASE WHEN processes = 0 THEN 'no training process' END AS process_note,
           CASE WHEN checkpoint IS NULL THEN 'no checkpoints' END AS checkpoint_note
    FROM ({HEARTBEAT_SQL}) h""")
def heartbeat_5m(spark, folder):
    """Snapshots with their processes and newest checkpoint."""
    beats = monitor.heartbeat(
        _lines(spark, folder), "5 minutes", extra=monitor.snapshot_parts(**PARTS)
    )
    return monitor.snapshot_notes(beats)


@query(f"""
    WITH w AS (
        SELECT run, time_bucket(INTERVAL 15 MINUTE, ts) AS window_start,
               time_bucket(INTERVAL 15 MINUTE, ts) + INTERVAL 15 MINUTE AS window_end,
               count(*) AS lines, max(ts) AS last_ts, arg_max(line, (ts, seq)) AS last_line,
               max(ts) FILTER (WHERE log = 'monitor.log') AS m
        FROM ({LINES_SQL}) l GROUP BY ALL),
    s AS (SELECT * EXCLUDE (m), max(m) OVER (PARTITION BY run ORDER BY window_start) AS monitor_ts
          FROM w)
    SELECT *, (epoch_us(window_end) - epoch_us(monitor_ts)) // 1000000 AS age_seconds,
           CASE WHEN monitor_ts IS NULL THEN 'MISSING'
                WHEN (epoch_us(window_end) - epoch_us(monitor_ts)) // 1000000 <= 1200 THEN 'ACTIVE'
                ELSE 'INACTIVE' END AS status
    FROM s""")
def heartbeat_15m(spark, folder):
    """Snapshots per run, with the status of its monitor at the time."""
    last_update = F.max(F.when(F.col("log") == "monitor.log", F.col("ts")))
    snapshots = monitor.heartbeat(
        _lines(spark, folder), "15 minutes", by=("run",), extra={"monitor_ts": last_update}
    )
    return monitor.monitor_status(snapshots, ["run"])


@query(f"""
    SELECT run, log, seq, ts, line, from_end FROM (
        SELECT *, row_number() OVER (PARTITION BY run ORDER BY ts DESC, seq DESC)::INTEGER AS from_end
        FROM ({LINES_SQL}) l) r WHERE from_end <= 50""")
def tail_log(spark, folder):
    tail = monitor.tail_log(_lines(spark, folder), by="run")
    return tail.select("run", "log", "seq", "ts", "line", "from_end")


@query(f"""
    SELECT l.run, l.log, l.seq, l.line FROM ({LINES_SQL}) l
    JOIN (SELECT run, min(priority) AS priority FROM ({LINES_SQL}) x GROUP BY run) p
      ON l.run = p.run AND l.priority = p.priority""")
def prefer_log(spark, folder):
    return monitor.prefer_log(_lines(spark, folder)).select("run", "log", "seq", "line")


@query(f"""
    WITH l AS (SELECT *, regexp_matches(line, 'error|purchase')
                         AND NOT regexp_matches(line, '"k": [0-8]') AS wanted FROM ({LINES_SQL}) x)
    SELECT run, seq, line FROM l WHERE wanted
    UNION ALL
    SELECT run, NULL, 'no training process' FROM l GROUP BY run HAVING NOT bool_or(wanted)""")
def match_lines(spark, folder):
    matched = monitor.match_lines(
        _lines(spark, folder), "error|purchase", '"k": [0-8]', by="run",
        none_message="no training process",
    )
    return matched.select("run", "seq", "line")


@query("""
    SELECT c_custkey AS user_id, last_ts,
           ((SELECT epoch_us(max(ts)) FROM events) - epoch_us(last_ts)) // 1000000 AS age_seconds,
           CASE WHEN last_ts IS NULL THEN 'MISSING'
                WHEN ((SELECT epoch_us(max(ts)) FROM events) - epoch_us(last_ts)) // 1000000 <= 1200
                THEN 'ACTIVE' ELSE 'INACTIVE' END AS status
    FROM customer LEFT JOIN (SELECT user_id, max(ts) AS last_ts FROM events GROUP BY user_id) e
      ON c_custkey = user_id""")
def liveness_report(spark, folder):
    """Customers are the expected sources."""
    expected = table(spark, folder, "customer").select(F.col("c_custkey").alias("user_id"))
    return monitor.liveness(table(spark, folder, "events"), "user_id", expected=expected)


@query(f"""SELECT seq, "index", name, util, mem_util, mem_total, mem_used, temp FROM ({GPU_SQL}) g""")
def parse_gpu(spark, folder):
    parsed = monitor.parse_gpu(as_gpu_lines(table(spark, folder, "events")))
    return parsed.drop("ts", "line")


@query(f"""
    SELECT "index", time_bucket(INTERVAL 15 MINUTE, ts) AS window_start,
           time_bucket(INTERVAL 15 MINUTE, ts) + INTERVAL 15 MINUTE AS window_end,
           count(*) AS lines, round(avg(util), 9) AS avg_util, max(temp) AS max_temp
    FROM ({GPU_SQL}) g GROUP BY ALL""")
def gpu_heartbeat(spark, folder):
    parsed = monitor.parse_gpu(as_gpu_lines(table(spark, folder, "events")))
    readings = monitor.heartbeat(
        parsed, "15 minutes", by=("index",),
        extra={"avg_util": F.round(F.avg("util"), 9), "max_temp": F.max("temp")},
    )
    return readings.drop("last_ts", "last_line")


#: Of the whole heartbeat: seconds between ticks, and lines of a tail and of the monitor's tail.
EVERY, TAIL, MONITOR_TAIL = 3600, 5, 2


def _tail_sql(kind, n):
    return f"coalesce(array_to_string({kind}.said[greatest({kind}.upto - {n - 1}, 1):{kind}.upto], chr(10)), '')"


def _kind_sql(kind, priority):
    """Every tick's number of lines of a kind up to it, and all lines of the run's log of that kind."""
    return f"""
    {kind} AS (
        SELECT run, tick, said, upto FROM (
            SELECT c.run, c.tick, sum(coalesce(n, 0)) OVER (PARTITION BY c.run ORDER BY c.tick)::BIGINT AS upto
            FROM cal c LEFT JOIN (SELECT run, tick, count(*) AS n FROM l WHERE priority = {priority} GROUP BY run, tick) k USING (run, tick)) t
        JOIN (SELECT run, list(line ORDER BY ts, seq) AS said FROM l WHERE priority = {priority} GROUP BY run) a USING (run) WHERE upto > 0)"""


@query(f"""
    WITH l AS (SELECT *, (epoch_us(ts) + {EVERY}000000 - 1) // {EVERY}000000 AS tick FROM ({LINES_SQL}) x),
    cal AS (SELECT run, unnest(range((SELECT min(tick) FROM l), (SELECT max(tick) FROM l) + 1)) AS tick FROM (SELECT DISTINCT run FROM l) r),
    {_kind_sql('p0', 0)}, {_kind_sql('p1', 1)}, {_kind_sql('p2', 2)},
    seen AS (
        SELECT run, tick, count(*) FILTER (WHERE line LIKE 'purchase%' AND NOT line LIKE '%"k": 1%') AS processes,
               max(CASE WHEN line LIKE 'models/%' THEN seq END) AS checkpoint,
               max(ts) FILTER (WHERE priority = 2) AS monitor_ts
        FROM l GROUP BY run, tick),
    gpu AS (
        SELECT 'run-' || user_id::VARCHAR AS run, (epoch_us(ts) + {EVERY}000000 - 1) // {EVERY}000000 AS tick, arg_max(g, (ts, seq)) AS g
        FROM (SELECT g.seq, g.ts, e.user_id, g FROM ({GPU_SQL}) g JOIN events e ON e.event_id = g.seq) t GROUP BY ALL),
    held AS (
        SELECT run, c.tick, coalesce(processes, 0) AS processes, max(checkpoint) OVER w AS checkpoint,
               max(monitor_ts) OVER w AS monitor_ts, last_value(g IGNORE NULLS) OVER w AS g
        FROM cal c LEFT JOIN seen USING (run, tick) LEFT JOIN gpu USING (run, tick) WINDOW w AS (PARTITION BY run ORDER BY c.tick))
    SELECT run, make_timestamp(tick * {EVERY}000000) AS tick_ts, processes, checkpoint, monitor_ts,
           CASE WHEN p0.upto IS NOT NULL THEN {_tail_sql('p0', TAIL)} WHEN p1.upto IS NOT NULL THEN {_tail_sql('p1', TAIL)} END AS tail,
           CASE WHEN p2.upto IS NOT NULL THEN {_tail_sql('p2', MONITOR_TAIL)} END AS monitor_tail,
           (tick * {EVERY}000000 - epoch_us(monitor_ts)) // 1000000 AS age_seconds,
           g['index'] AS "index", g.name AS name, g.util AS util, g.mem_util AS mem_util, g.mem_total AS mem_total, g.mem_used AS mem_used, g.temp AS temp,
           CASE WHEN monitor_ts IS NULL THEN 'MISSING'
                WHEN (tick * {EVERY}000000 - epoch_us(monitor_ts)) // 1000000 <= 1200 THEN 'ACTIVE' ELSE 'INACTIVE' END AS status,
           CASE WHEN processes = 0 THEN 'no training process' END AS process_note,
           CASE WHEN checkpoint IS NULL THEN 'no checkpoints' END AS checkpoint_note,
           CASE WHEN g IS NULL THEN 'nvidia-smi not available' END AS gpu_note
    FROM held LEFT JOIN p0 USING (run, tick) LEFT JOIN p1 USING (run, tick) LEFT JOIN p2 USING (run, tick)""")
def heartbeat_full(spark, folder):
    """A whole snapshot of every run at every full hour."""
    events = table(spark, folder, "events")
    readings = as_gpu_lines(events, F.concat(F.lit("run-"), F.col("user_id").cast("string")).alias("run"))
    whole = monitor.heartbeat_full(as_lines(events), readings, EVERY, **PARTS, n=TAIL, n_monitor=MONITOR_TAIL)
    return naive(whole, "tick_ts", "monitor_ts")


# ---- streams ----


def _event_stream(spark, folder):
    return files.event_time(files.read_stream(spark, folder, EVENTS, only="events.parquet"))


def _finish(started):
    started.awaitTermination()


@query(f"SELECT * FROM ({HEARTBEAT_SQL}) h")
def stream_heartbeat(spark, folder):
    """All windows of a stream: closed ones as they are appended to a report, the last ones from its state."""
    path, state = fresh_dir(spark, "heartbeat"), fresh_dir(spark, "heartbeat-state")
    snapshots = monitor.heartbeat(
        as_lines(_event_stream(spark, folder)), "5 minutes", watermark="10 minutes",
        extra=monitor.snapshot_parts(**PARTS),
    )
    _finish(files.append_report(snapshots, path, state))
    files.finish_report(spark, path, state, monitor.SNAPSHOT_STATE)
    return naive(files.read_report(spark, path), "window_start", "window_end", "last_ts")


@query(f"SELECT * FROM ({METRICS_SQL}) m")
def stream_sync(spark, folder):
    """Metrics flushed to Parquet, the last flush at the end."""
    path = fresh_dir(spark, "metrics")
    stream = as_metrics(_event_stream(spark, folder))
    _finish(files.sync_metrics(stream, path, fresh_dir(spark, "metrics-state"), final=True))
    return naive(spark.read.parquet(path), "ts")


@query(f"""
    SELECT event_id, event_type FROM (
        SELECT *, row_number() OVER (ORDER BY {sql_draw(42, 'event_id')}, event_id) AS rank FROM events) r
    WHERE rank <= (SELECT count(*) // 16 FROM events) * 8""")
def stream_dataset(spark, folder):
    """A dataset read as a stream, bounded by steps of eight rows: half of it."""
    path = fresh_dir(spark, "bounded")
    steps = table(spark, folder, "events").count() // 16
    stream = files.read_stream(spark, folder, EVENTS, only="events.parquet")
    _finish(
        files.stream_dataset(stream, path, fresh_dir(spark, "bounded-state"), "event_id", steps, 8)
    )
    return spark.read.parquet(path).select("event_id", "event_type")


@query("""
    SELECT c_custkey::VARCHAR AS source, last_ts,
           CASE WHEN last_ts IS NULL THEN 'MISSING'
                WHEN epoch_ms(last_ts) + 1200000 < (SELECT epoch_ms(max(ts)) FROM events)
                THEN 'INACTIVE' ELSE 'ACTIVE' END AS status
    FROM customer LEFT JOIN (SELECT user_id, max(ts) AS last_ts FROM events GROUP BY user_id) e
      ON c_custkey = user_id""")
def stream_liveness(spark, folder):
    """Each customer's status once the stream is read to its end."""
    path = fresh_dir(spark, "liveness")
    expected = table(spark, folder, "customer").select(F.col("c_custkey").alias("user_id"))
    reports = liveness.liveness_stream(_event_stream(spark, folder), "user_id", expected)
    _finish(files.append_report(reports, path, fresh_dir(spark, "liveness-state")))
    return naive(liveness.latest_status(spark.read.parquet(path)), "last_ts")


# ---- batch inference ----


def _requests(spark, folder):
    """Documents as requests; some have no prompt or leave values to their defaults."""
    key = F.col("doc_id")
    return table(spark, folder, "documents").select(
        key.alias("id"),
        F.when(key % 7 == 0, F.lit(None)).when(key % 7 == 1, F.lit("")).otherwise(F.col("text")).alias("prompt"),
        F.when(key % 3 == 0, (key % 100).cast("int")).alias("max_new_tokens"),
        F.when(key % 2 == 0, key / 1000).alias("temperature"),
    )


REQUESTS_SQL = """
    SELECT doc_id AS id,
           CASE doc_id % 7 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE text END AS prompt,
           coalesce(CASE WHEN doc_id % 3 = 0 THEN (doc_id % 100)::INTEGER END, 64) AS max_new_tokens,
           coalesce(CASE WHEN doc_id % 2 = 0 THEN doc_id / 1000 END, 0.0)::DOUBLE AS temperature
    FROM documents"""


@query(f"""
    SELECT *, temperature > 0 AS do_sample,
           CASE WHEN coalesce(prompt, '') = '' THEN 'missing prompt' END AS error
    FROM ({REQUESTS_SQL}) r""")
def prepare_requests(spark, folder):
    return infer.prepare_requests(_requests(spark, folder))


def load_echo():
    return "echo"


def generate_echo(model, prompts, max_new_tokens, temperature, do_sample):
    for prompt in prompts:
        if len(prompt) < 200:
            raise ValueError(f"too short: {len(prompt)}")
    return [f"{model} {max_new_tokens} {do_sample} {prompt}" for prompt in prompts]


@query(f"""
    SELECT id, CASE WHEN length(prompt) >= 200 THEN 'echo ' || max_new_tokens::VARCHAR
                    || CASE WHEN temperature > 0 THEN ' True ' ELSE ' False ' END || prompt END
               AS generated,
           CASE WHEN coalesce(prompt, '') = '' THEN 'missing prompt'
                WHEN length(prompt) < 200 THEN 'generation_failed' END AS error,
           CASE WHEN prompt != '' AND length(prompt) < 200
                THEN 'too short: ' || length(prompt)::VARCHAR END AS detail
    FROM ({REQUESTS_SQL}) r""")
def batch_generate(spark, folder):
    """Requests through a stand-in model that refuses short prompts."""
    requests = infer.prepare_requests(_requests(spark, folder))
    return infer.batch_generate(requests, load_echo, generate_echo)


@query("SELECT doc_id, upper(lang) || ': ' || source AS label FROM documents")
def map_rows(spark, folder):
    return infer.map_rows(
        table(spark, folder, "documents"),
        doc_id=F.col("doc_id"),
        label=F.concat(F.upper("lang"), F.lit(": "), F.col("source")),
    )


def count_words(batch):
    counts = batch["text"].str.count(r"\S+", flags=256)  # 256: ASCII white space only
    return batch[["doc_id"]].assign(words=counts.astype("int64"))


@query("""
    SELECT doc_id, len(regexp_extract_all(text, '\\S+')) AS words FROM documents""")
def map_batches(spark, folder):
    """A column batch at a time through a Python function."""
    texts = table(spark, folder, "documents").select("doc_id", "text")
    return infer.map_batches(texts, count_words, "doc_id BIGINT, words BIGINT")
