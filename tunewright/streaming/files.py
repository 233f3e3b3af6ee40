"""Datasets, metrics and reports as file streams."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tunewright.operators.split import mark_smallest
from tunewright.session import ROCKSDB, setting


def read_stream(
    spark: SparkSession, path: str, schema: str, max_files: int = 1000, only: str | None = None
) -> DataFrame:
    """Parquet files of a folder as a stream; `only` is a pattern of file names."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files)
    if only:
        reader = reader.option("pathGlobFilter", only)
    return reader.parquet(path)


def event_time(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Times without a zone read as UTC instants, which a watermark needs."""
    if isinstance(df.schema[ts].dataType, T.TimestampNTZType):
        return df.withColumn(ts, F.col(ts).cast("timestamp"))
    return df


def append_report(stream: DataFrame, path: str, checkpoint: str, every: str | None = None):
    """Append a stream to Parquet: at every interval, or all that is there and then stop."""
    writer = (
        stream.writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    trigger = {"processingTime": every} if every else {"availableNow": True}
    with setting(stream.sparkSession, "spark.sql.streaming.stateStore.providerClass", ROCKSDB):
        return writer.trigger(**trigger).start()


#: Fields of the state that an aggregate keeps, and its value from them.
KEPT = {
    "last": (1, lambda field: field(0)),  # count, sum, min, max and the like: the value itself
    "by": (2, lambda field: field(0)),  # max_by, min_by: the value, and what it is ordered by
    "mean": (2, lambda field: field(0) / field(1)),  # avg: the sum and the count
}


def open_windows(spark: SparkSession, checkpoint: str, aggregates: dict[str, str], window: str = "window") -> DataFrame:
    """The windows that a stopped stream of snapshots holds in its state: the groups that it has not appended yet.

    `aggregates` names the stream's aggregates in their order, each with its form of state, a key of
    `KEPT`. State is read by as many tasks as it has partitions.
    """
    state = spark.read.format("statestore").option("path", checkpoint).load()
    key, value = state.schema["key"].dataType, state.schema["value"].dataType
    kinds = [f.dataType.simpleString() for f in value.fields]
    if len(kinds) != sum(KEPT[kind][0] for kind in aggregates.values()):
        raise ValueError(f"the state holds {len(kinds)} fields, which are not those of {aggregates}")
    # names of the state's fields repeat, so they are told apart by place
    values = F.col("value").cast(f"struct<{', '.join(f'f{i}: {kind}' for i, kind in enumerate(kinds))}>")
    named, at = {}, 0
    for name, kind in aggregates.items():
        width, result = KEPT[kind]
        named[name] = result(lambda i, at=at: F.col(f"_value.f{at + i}")).alias(name)
        at += width
    by = [F.col(f"key.`{f.name}`").alias(f.name) for f in key.fields if f.name != window]
    ends = [F.col(f"key.`{window}`.{end}").alias(f"window_{end}") for end in ("start", "end")]
    return state.withColumn("_value", values).select(*by, *ends, *named.values())


def finish_report(spark: SparkSession, path: str, checkpoint: str, aggregates: dict[str, str]) -> None:
    """Add the windows that are open after the last batch to a report of `append_report`, beside its files.

    They replace those of an earlier finish, so that finishing twice adds nothing. The stream may go on
    from its checkpoint: what it appends later counts before what was open.
    """
    open_windows(spark, checkpoint, aggregates).write.mode("overwrite").parquet(_open_path(path))


def _open_path(path: str) -> str:
    return f"{path.rstrip('/')}-open"


def read_report(spark: SparkSession, path: str, keys: tuple[str, ...] = ("window_start",)) -> DataFrame:
    """All windows of a finished report, each once: appended ones, and those open at the finish and not appended since."""
    closed, still = spark.read.parquet(path), spark.read.parquet(_open_path(path))
    same = [still[key].eqNullSafe(closed[key]) for key in keys]
    return closed.unionByName(still.join(closed.select(*keys), same, "left_anti"))


def sync_metrics(stream: DataFrame, path: str, checkpoint: str, final: bool = False):
    """Flush metrics to Parquet every five minutes; `final=True` flushes what is left and stops.

    Both use one checkpoint, so the final flush goes on where the last interval ended.
    """
    return append_report(stream, path, checkpoint, None if final else "5 minutes")


def stream_dataset(
    stream: DataFrame, path: str, checkpoint: str, key: str, max_steps: int, rows_per_step: int,
    seed: int = 42,
):
    """Take a stream's first `max_steps * rows_per_step` rows, however many there are in all.

    Whole micro-batches are taken until one would pass the bound; of that one the rows of the
    smallest hashed keys are taken, without a sort or a single-task limit. Each batch leaves a
    record of how many rows were taken up to it, beside the output; the next one reads that record
    alone, so a batch costs the same however long the stream has run, and a batch that is run
    again replaces its rows and its record: a restart neither loses nor repeats rows.
    """
    bound = max_steps * rows_per_step

    def take(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = _taken_before(spark, path, batch_id)
        left = bound - before
        if left <= 0:
            return
        if batch.count() > left:
            batch = mark_smallest(batch, key, "_taken", n=left, seed=seed).where("_taken").drop("_taken")
        out = f"{path}/batch={batch_id}"
        batch.write.mode("overwrite").parquet(out)
        taken = before + spark.read.schema(batch.schema).parquet(out).count()  # from the files' footers
        spark.range(1).select(F.lit(taken).alias("taken")).write.mode("overwrite").json(_record(path, batch_id))

    return (
        stream.writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _record(path: str, batch_id: int) -> str:
    return f"{path.rstrip('/')}-taken/{batch_id}"


def _taken_before(spark: SparkSession, path: str, batch_id: int) -> int:
    """Rows that earlier batches took, from the record of the last of them.

    A batch without a record was started after the bound was reached, or before records were kept; then
    the output is counted.
    """
    if batch_id == 0:
        return 0
    try:
        return spark.read.schema("taken BIGINT").json(_record(path, batch_id - 1)).first().taken
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
    try:
        return spark.read.parquet(path).where(F.col("batch") < batch_id).count()
    except AnalysisException as problem:
        if problem.getCondition() == "PATH_NOT_FOUND":
            return 0
        raise
