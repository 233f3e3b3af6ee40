"""Log lines and telemetry: heartbeats, tails, matching, liveness and GPU readings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tunewright.constants import LIVE_SECONDS, MONITOR_TAIL_LINES, NO_CHECKPOINTS, NO_GPU, NO_PROCESS, TAIL_LINES
from tunewright.operators.metrics import checkpoint_step
from tunewright.operators.position import first_rows
from tunewright.schemas import GPU


def parse_gpu(df: DataFrame, line: str = "line", schema: str = GPU) -> DataFrame:
    """Add the typed fields of a comma-separated telemetry line."""
    spaces = {"ignoreLeadingWhiteSpace": "true", "ignoreTrailingWhiteSpace": "true"}
    reading = F.from_csv(F.col(line), schema, spaces)
    return df.withColumn("_gpu", reading).select(*df.columns, "_gpu.*")


def heartbeat(
    lines: DataFrame,
    every: str = "5 minutes",
    by: tuple[str, ...] = (),
    watermark: str | None = None,
    extra: dict[str, Column] | None = None,
) -> DataFrame:
    """One snapshot per tumbling window: the number of lines, the last one, and `extra` aggregates.

    Works on a table and on a stream; a stream needs `watermark`, and `ts` must be a timestamp.
    """
    if watermark:
        lines = lines.withWatermark("ts", watermark)
    extra = extra or {}
    return (
        lines.groupBy(F.window("ts", every).alias("w"), *by)
        .agg(
            F.count(F.lit(1)).alias("lines"),
            F.max("ts").alias("last_ts"),
            F.max_by("line", F.struct("ts", "seq")).alias("last_line"),
            *[column.alias(name) for name, column in extra.items()],
        )
        .select(
            *by,
            F.col("w.start").alias("window_start"),
            F.col("w.end").alias("window_end"),
            "lines", "last_ts", "last_line",
            *extra,
        )
    )


#: The aggregates of a heartbeat with the parts below, and the form of state of each in a stream.
SNAPSHOT_STATE = {"lines": "last", "last_ts": "last", "last_line": "by", "processes": "last", "checkpoint": "last"}


def snapshot_parts(include: str, exclude: str | None = None, line: str = "line") -> dict[str, Column]:
    """More of a snapshot, for `heartbeat`'s `extra`: matching process lines and the newest checkpoint."""
    return {
        "processes": F.count_if(_matching(line, include, exclude)),
        "checkpoint": F.max(checkpoint_step(F.col(line))),
    }


def snapshot_notes(snapshots: DataFrame) -> DataFrame:
    """Say so where a snapshot has no process or no checkpoint."""
    return snapshots.withColumn(
        "process_note", F.when(F.col("processes") == 0, F.lit(NO_PROCESS))
    ).withColumn("checkpoint_note", F.when(F.col("checkpoint").isNull(), F.lit(NO_CHECKPOINTS)))


def tick(ts: Column, every: int) -> Column:
    """Number of the first tick at or after a time, ticks being `every` seconds apart."""
    micros = every * 1_000_000
    return F.floor((F.unix_micros(ts.cast("timestamp")) + (micros - 1)) / micros).cast("bigint")


def calendar(lines: DataFrame, every: int, by: str = "run", sources: DataFrame | None = None) -> DataFrame:
    """(by, tick): every tick from the first line of all to the last one, for each source.

    Sources are those that have lines, and those of the table `sources`. So a source that is silent has
    rows as well, as many as any other.
    """
    known = lines.select(by)
    if sources is not None:
        known = known.unionByName(sources.select(by))
    first, last = (lines.agg(bound("ts").alias("ts")).select(tick(F.col("ts"), every)).scalar() for bound in (F.min, F.max))
    return known.distinct().select(by, F.explode(F.sequence(first, last)).alias("tick"))


#: Kinds of logs by their priority.
LOGS = {0: "primary", 1: "fallback", 2: "monitor"}


def tails(lines: DataFrame, every: int, sizes: dict[str, int], by: str = "run") -> DataFrame:
    """(by, tick, primary, fallback, monitor): a log's last lines at each tick that brought it a line.

    The last lines of one tick are found piece by piece, so a busy source is cut before it is gathered.
    What is left of a tick has at least one line, so n such ticks hold the last n lines at the
    latest of them, and a row never gathers more.
    """
    kinds = F.create_map(*[F.lit(x) for pair in LOGS.items() for x in pair])
    placed = lines.select(by, tick(F.col("ts"), every).alias("tick"), kinds[F.col("priority")].alias("kind"), "ts", "seq", "line")
    gathered = []
    for kind, n in sizes.items():
        newest = [F.col("ts").desc(), F.col("seq").desc()]
        some = first_rows(placed.where(F.col("kind") == kind), [by, "tick"], newest, n, "_rank", F.col("seq"))
        said = some.groupBy(by, "tick").agg(F.array_sort(F.collect_list(F.struct("ts", "seq", "line"))).alias("said"))
        before = Window.partitionBy(by).orderBy("tick").rowsBetween(1 - n, 0)
        whole = F.flatten(F.collect_list("said").over(before))
        last = F.slice(whole, F.greatest(F.size(whole) - n + 1, F.lit(1)), n)
        gathered.append(said.select(by, "tick", F.lit(kind).alias("kind"), F.transform(last, lambda x: x["line"]).alias("tail")))
    rows = gathered[0]
    for more in gathered[1:]:
        rows = rows.unionByName(more)
    return rows.groupBy(by, "tick").agg(*[F.any_value(F.when(F.col("kind") == kind, F.col("tail")), True).alias(kind) for kind in sizes])


def heartbeat_full(
    lines: DataFrame, readings: DataFrame, every: int, include: str, exclude: str | None = None, by: str = "run",
    n: int = TAIL_LINES, n_monitor: int = MONITOR_TAIL_LINES, sources: DataFrame | None = None, limit: int = LIVE_SECONDS,
) -> DataFrame:
    """A whole snapshot of every source at every tick, silent ticks included.

    lines: (by, log priority, seq, ts, line), readings: telemetry lines (by, seq, ts, line). Per tick:
    matching process lines since the tick before, and as of the tick the last telemetry reading, the
    last `n` lines of the primary log, or of the fallback while there is no primary, the newest
    checkpoint, and the monitor's last update, age, status and last lines. A note says what there is none of.

    Lines are brought to their ticks by partial aggregates before any shuffle. What holds as of a tick is then
    the last value of the ticks up to it, so a sort of a source is over its ticks and never over its
    lines, however many those are. Null sources, times and lines are a source, out of the calendar, and no match.
    """
    lines, readings = lines.where(F.col("ts").isNotNull()), readings.where(F.col("ts").isNotNull())
    at = tick(F.col("ts"), every)
    counted = lines.groupBy(by, at.alias("tick")).agg(
        F.count_if(_matching("line", include, exclude)).alias("processes"),
        F.max(checkpoint_step(F.col("line"))).alias("checkpoint"),
        F.max(F.when(F.col("priority") == 2, F.col("ts"))).alias("monitor_ts"),
    )
    reading = readings.groupBy(by, at.alias("tick")).agg(F.max_by("line", F.struct("ts", "seq")).alias("reading"))
    said = tails(lines, every, {"primary": n, "fallback": n, "monitor": n_monitor}, by)
    rows = calendar(lines, every, by, sources).alias("c")
    for name, part in (("p", counted), ("r", reading), ("t", said)):
        same = F.col(f"c.{by}").eqNullSafe(F.col(f"{name}.{by}")) & (F.col("c.tick") == F.col(f"{name}.tick"))
        rows = rows.join(part.alias(name), same, "left").select("c.*", *[F.col(f"{name}.{c}") for c in part.columns[2:]]).alias("c")
    so_far = Window.partitionBy(by).orderBy("tick").rowsBetween(Window.unboundedPreceding, 0)
    last = lambda name: F.last(name, ignorenulls=True).over(so_far)
    now = F.timestamp_micros(F.col("tick") * (every * 1_000_000))
    placed = rows.select(
        by, now.alias("tick_ts"), F.coalesce("processes", F.lit(0)).alias("processes"),
        last("reading").alias("line"), F.max("checkpoint").over(so_far).alias("checkpoint"),
        F.array_join(F.coalesce(last("primary"), last("fallback")), "\n").alias("tail"),
        last("monitor_ts").alias("monitor_ts"), F.array_join(last("monitor"), "\n").alias("monitor_tail"),
    )
    aged = placed.withColumn("age_seconds", age_seconds(F.col("tick_ts"), F.col("monitor_ts")))
    whole = parse_gpu(aged).withColumn("status", status(F.col("age_seconds"), limit))
    return snapshot_notes(whole).withColumn("gpu_note", F.when(F.col("line").isNull(), F.lit(NO_GPU))).drop("line")


def _matching(line: str, include: str, exclude: str | None) -> Column:
    wanted = F.rlike(F.col(line), F.lit(include))
    return wanted if exclude is None else wanted & ~F.rlike(F.col(line), F.lit(exclude))


def monitor_status(snapshots: DataFrame, by: list[str], limit: int = LIVE_SECONDS) -> DataFrame:
    """Add age and status of the monitor to snapshots that carry `monitor_ts`, its last update.

    A snapshot without an update inherits the one before. Snapshots are one row per window, so a
    source has as many as its time range has windows.
    """
    so_far = (
        Window.partitionBy(*by)
        .orderBy("window_start")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    last = F.last("monitor_ts", ignorenulls=True).over(so_far)
    return (
        snapshots.withColumn("monitor_ts", last)
        .withColumn("age_seconds", age_seconds(F.col("window_end"), F.col("monitor_ts")))
        .withColumn("status", status(F.col("age_seconds"), limit))
    )


def age_seconds(now: Column, last: Column) -> Column:
    """Whole seconds between two times."""
    micros = F.unix_micros(now.cast("timestamp")) - F.unix_micros(last.cast("timestamp"))
    return F.floor(micros / 1_000_000).cast("bigint")


def status(age: Column, limit: int = LIVE_SECONDS) -> Column:
    return (
        F.when(age.isNull(), F.lit("MISSING"))
        .when(age <= limit, F.lit("ACTIVE"))
        .otherwise(F.lit("INACTIVE"))
    )


def liveness(
    df: DataFrame, source: str, asof: Column | None = None, expected: DataFrame | None = None,
    limit: int = LIVE_SECONDS,
) -> DataFrame:
    """Age of each source's last row and its status; expected sources without rows are MISSING.

    `asof` is the time to measure from, by default the newest row of all.
    """
    now = df.agg(F.max("ts")).scalar() if asof is None else asof
    last = df.groupBy(source).agg(F.max("ts").alias("last_ts"))
    if expected is not None:
        last = expected.select(source).distinct().join(last, source, "left")
    return last.withColumn("age_seconds", age_seconds(now, F.col("last_ts"))).withColumn(
        "status", status(F.col("age_seconds"), limit)
    )


def tail_log(df: DataFrame, n: int = TAIL_LINES, by: str = "log") -> DataFrame:
    """The last `n` lines of each log, found piece by piece and then of the pieces' last lines."""
    newest = [F.col("ts").desc(), F.col("seq").desc()]
    return first_rows(df, [by], newest, n, "from_end", F.col("seq"))


def prefer_log(lines: DataFrame, run: str = "run", log: str = "log", priority: str = "priority") -> DataFrame:
    """Lines of each run's log of lowest priority number: the primary if it exists, else the fallback."""
    # a row per log and run first, so that the texts of logs' names are compared for few rows
    logs = lines.groupBy(run, log).agg(F.min(priority).alias("_priority"))
    chosen = logs.groupBy(run).agg(F.min_by(log, F.struct("_priority", log)).alias(log))
    same = lines[run].eqNullSafe(chosen[run]) & lines[log].eqNullSafe(chosen[log])
    return lines.join(chosen, same, "left_semi")


def match_lines(
    df: DataFrame, include: str, exclude: str | None = None, line: str = "line",
    by: str | None = None, none_message: str | None = None,
) -> DataFrame:
    """Lines that match one pattern and not another.

    With `by` and `none_message`, a source without any match gets one row with the message.
    """
    wanted = _matching(line, include, exclude)
    kept = df.where(wanted)
    if by is None or none_message is None:
        return kept
    silent = (
        df.groupBy(by)
        .agg(F.bool_or(wanted).alias("any"))
        .where(~F.col("any"))
        .select(by, F.lit(none_message).alias(line))
    )
    return kept.unionByName(silent, allowMissingColumns=True)
