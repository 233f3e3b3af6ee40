"""Liveness of sources in a stream: silence is noticed by an event-time timer per bucket of sources."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tunewright.constants import LIVE_SECONDS

REPORT = "source STRING, last_us BIGINT, status STRING"
#: Groups that sources are dealt to; each has a timer and its part of the state.
BUCKETS = 4096


def newest_per_source(stream: DataFrame, source: str, ts: str = "ts") -> DataFrame:
    """Each Arrow batch reduced to a row per source (source, last_us, clock), so that a busy source is not shuffled whole.

    `clock` is the batch's newest time on one row more, which moves the watermark; on the others it
    is null. A null time is never behind the watermark, so a source is heard however late its rows come.
    """

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            heard = pa.Table.from_batches([batch]).group_by("source").aggregate([("last_us", "max")])
            heard = heard.select(["source", "last_us_max"]).rename_columns(["source", "last_us"])
            heard = heard.filter(pc.is_valid(heard["last_us"]))
            if heard.num_rows:
                newest = heard.sort_by([("last_us", "descending")]).slice(0, 1)
                rows = pa.concat_tables([heard, newest]).combine_chunks()
                clock = pa.array([None] * heard.num_rows + newest["last_us"].to_pylist(), pa.int64())
                yield from rows.append_column("clock_us", clock).to_batches()

    narrow = stream.select(
        F.col(source).cast("string").alias("source"),
        F.unix_micros(F.col(ts).cast("timestamp")).alias("last_us"),
    )
    reduced = narrow.mapInArrow(reduce, "source STRING, last_us BIGINT, clock_us BIGINT")
    return reduced.select("source", "last_us", F.timestamp_micros("clock_us").alias("clock"))


class Silence(StatefulProcessor):
    """Keeps the newest time of every live source of a bucket, and a timer for the first of them to fall silent.

    An expected source has no time until it is heard; the first timer tells that it is missing. A
    source that fell silent, or was told missing, keeps no state. Sources of a bucket are told apart
    here, as a call of the state store for each of them would cost far more than all else.
    """

    def __init__(self, limit: int):
        self.limit_ms = limit * 1000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.blocks = handle.getListState("sources", "block BINARY")

    def _due(self, last: int) -> int:
        return last // 1000 + self.limit_ms

    def _wakes(self, last: int | None) -> int:
        return 1 if last is None else self._due(last) + 1

    def _known(self) -> dict[str | None, int | None]:
        """Newest time by source; None if it is expected and not heard yet."""
        known = {}
        for (block,) in self.blocks.get():
            with pa.ipc.open_stream(block) as reader:
                rows = reader.read_all()
            known.update(zip(rows["source"].to_pylist(), rows["last_us"].to_pylist()))
        return known

    def _block(self, known: dict[str | None, int | None]) -> tuple[bytes]:
        rows = pa.table([pa.array(known, pa.string()), pa.array(known.values(), pa.int64())], ["source", "last_us"])
        out = pa.BufferOutputStream()
        with pa.ipc.new_stream(out, rows.schema) as writer:
            writer.write_table(rows)
        return (out.getvalue().to_pybytes(),)

    def _keep(self, known: dict[str | None, int | None]) -> None:
        if known:
            self.blocks.put([self._block(known)])
            self.handle.registerTimer(min(map(self._wakes, known.values())))
        else:
            self.blocks.clear()

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        expected = initialState["source"].astype(object)
        if len(expected):  # a block for each part of a large bucket
            self.blocks.appendValue(self._block(dict.fromkeys(expected.where(expected.notna(), None))))
            self.handle.registerTimer(1)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        newest: dict[str | None, int] = {}
        for batch in rows:
            sources = batch["source"].astype(object)
            for source, last in zip(sources.where(sources.notna(), None), batch["last_us"].tolist()):
                newest[source] = max(last, newest.get(source, last))
        watermark = timerValues.getCurrentWatermarkInMs()
        known, reports = self._known(), []
        for source, heard in newest.items():
            last = known.get(source)
            if last is not None and heard <= last:
                continue
            if last is not None and self._due(last) < watermark:
                reports.append((source, last, "INACTIVE"))  # it was silent, and comes back before its timer is looked at
            if self._due(heard) < watermark:
                known.pop(source, None)
                reports.append((source, heard, "INACTIVE"))
            else:
                known[source] = heard
                reports.append((source, heard, "ACTIVE"))
        if reports:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            self._keep(known)
            yield self._rows(reports)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        watermark = timerValues.getCurrentWatermarkInMs()
        known = self._known()
        silent = {source: last for source, last in known.items() if self._wakes(last) <= watermark}
        self._keep({source: last for source, last in known.items() if source not in silent})
        if silent:
            yield self._rows([(source, last, "MISSING" if last is None else "INACTIVE") for source, last in silent.items()])

    def _rows(self, reports: list[tuple[str | None, int | None, str]]) -> pd.DataFrame:
        sources, lasts, statuses = zip(*reports)
        return pd.DataFrame({"source": pd.Series(sources, dtype=object), "last_us": pd.array(lasts, "Int64"), "status": statuses})

    def close(self) -> None:
        pass


def liveness_stream(
    stream: DataFrame, source: str, expected: DataFrame | None = None, limit: int = LIVE_SECONDS, delay: str = "0 seconds",
    buckets: int = BUCKETS,
) -> DataFrame:
    """A row whenever a source is heard from with a newer time (ACTIVE), and when it falls silent (INACTIVE).

    A source is silent once the newest time of all, less `delay`, passes its last row by more than
    `limit` seconds. Rows may come in any order: those of a source that is long silent by then are
    reported INACTIVE at once. `expected` is a table with the column `source`; what it lists and no row has named
    yet is MISSING. State is a name and a number per live source, kept and rewritten by bucket of the hash of
    the source: of more than some hundred million sources take more `buckets`, as many from a stream's
    start to its end. Start the stream with RocksDB as state store.
    """
    bucket = F.pmod(F.xxhash64("source"), F.lit(buckets)).alias("bucket")
    expected_sources = None
    if expected is not None:
        expected_sources = expected.select(F.col(source).cast("string").alias("source")).distinct().select(bucket, "source").groupBy("bucket")
    tracked = (
        newest_per_source(stream, source)
        .select(bucket, "source", "last_us", "clock")
        .withWatermark("clock", delay)
        .groupBy("bucket")
        .transformWithStateInPandas(Silence(limit), REPORT, "Append", "EventTime", expected_sources)
    )
    return tracked.select("source", F.timestamp_micros("last_us").alias("last_ts"), "status")


def latest_status(reports: DataFrame) -> DataFrame:
    """Each source's newest report; silence wins over activity of the same time, any report over MISSING."""
    newest = F.max_by("status", F.struct("last_ts", F.col("status") == "INACTIVE"))
    return reports.groupBy("source").agg(F.max("last_ts").alias("last_ts"), newest.alias("status"))
