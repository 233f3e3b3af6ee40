"""Running results along an order inside groups of any size: sorted by range, with what earlier ranges leave carried on."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tunewright.session import shared_dir

SUMMARY = "range INT, first STRING, last STRING, rows_first BIGINT, rows_last BIGINT, sum_first DOUBLE, sum_last DOUBLE, tail ARRAY<DOUBLE>"


def in_order(df: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """The rows sorted by group and order over all partitions, none of which is one group's alone to fill.

    Rows are dealt to ranges of (by, order, hash of the row, row), so that neither a large group nor many
    rows of one place, nor copies, make a large range. The result is a reliable checkpoint: its
    partitions stay what they are for every reader, and lost executors cost nothing.
    """
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    plain = [c for c, kind in df.dtypes if "map<" not in kind and "variant" not in kind]
    marked = df.withColumn("_tie", F.xxhash64(*[F.col(f"`{c}`") for c in plain])).withColumn("_row", F.monotonically_increasing_id())
    keys = [*[F.col(f"`{c}`") for c in [*by, *order]], F.col("_tie"), F.col("_row")]
    return marked.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_tie", "_row").checkpoint()


def _changes(columns: list[pa.Array], size: int) -> np.ndarray:
    """Whether a row's group differs from the row before; the first row counts as the same."""
    changed = np.zeros(size, bool)
    for column in columns:
        now, before = column.slice(1), column.slice(0, size - 1)
        same = pc.if_else(pc.or_(pc.is_null(now), pc.is_null(before)), pc.and_(pc.is_null(now), pc.is_null(before)), pc.equal(now, before))
        changed[1:] |= ~np.asarray(same.to_numpy(zero_copy_only=False), bool)
    return changed


def _name(columns: list[pa.Array], at: int) -> str:
    return repr([column[at].as_py() for column in columns])


@dataclass
class Carry:
    """What the rows of one group leave to later ones: their number, their sum and the last values."""

    group: str | None = None
    rows: int = 0
    total: float = 0.0
    tail: list = field(default_factory=list)


class Runner:
    """Goes through sorted batches; gives each row its place in its group, the sum before it and the values before it."""

    def __init__(self, carry: Carry, keep: int):
        self.carry, self.keep = carry, keep

    def step(self, groups: list[pa.Array], values: pa.Array | None, size: int):
        """(place from 1, sum of the group's values before, carried values and own ones, own offset in them)."""
        carry = self.carry
        changed = _changes(groups, size)
        if carry.group != _name(groups, 0):
            carry = Carry(_name(groups, 0))
        starts = np.maximum.accumulate(np.where(changed, np.arange(size), 0))
        first_run = ~np.logical_or.accumulate(changed)
        place = np.arange(size) - starts + 1 + np.where(first_run, carry.rows, 0)
        own = values.cast(pa.float64()).to_numpy(zero_copy_only=False) if values is not None else np.zeros(size)
        solid = np.where(np.isnan(own), 0.0, own)
        sums = np.concatenate([[0.0], np.cumsum(solid)])
        before = sums[:-1] - sums[starts] + np.where(first_run, carry.total, 0.0)
        reach = np.concatenate([np.array(carry.tail, float), own])
        left = int(place[-1])
        tail = reach[max(0, len(reach) - min(self.keep, left)) :].tolist() if self.keep else []
        self.carry = Carry(_name(groups, size - 1), left, float(before[-1] + solid[-1]), tail)
        return place, before, reach, len(carry.tail)


def _summarize(width: int, keep: int):
    """Sorted batches (groups, value) to a row of what the range leaves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runner, first, head = Runner(Carry(), keep), None, None
        for batch in batches:
            if batch.num_rows:
                groups = batch.columns[:width]
                if first is None:
                    first = _name(groups, 0)
                changed = np.flatnonzero(_changes(groups, batch.num_rows))
                cut = int(changed[0]) if len(changed) else batch.num_rows
                if head is None and runner.carry.group in (None, _name(groups, 0)):
                    front = batch.slice(0, cut)
                    runner.step(front.columns[:width], front.columns[width], cut)
                    batch, groups = batch.slice(cut), [g.slice(cut) for g in groups]
                if head is None and batch.num_rows:
                    head = runner.carry
                if batch.num_rows:
                    runner.step(groups, batch.columns[width], batch.num_rows)
        last, head = runner.carry, head or runner.carry
        rows = [] if first is None else [(TaskContext.get().partitionId(), first, last.group, head.rows, last.rows, head.total, last.total, last.tail)]
        columns = list(zip(*rows)) or [()] * 8
        kinds = [pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.list_(pa.float64())]
        names = [f.split()[0] for f in SUMMARY.split(", ")]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return run


def carried(ranged: DataFrame, by: list[str], value: str | None, keep: int) -> dict[int, Carry]:
    """What each range inherits of the group that goes on in it. A row per range comes to the driver, with `keep` values."""
    number = F.col(f"`{value}`").cast("double") if value else F.lit(0.0)
    parts = ranged.select(*[F.col(f"`{c}`") for c in by], number.alias("_value")).mapInArrow(_summarize(len(by), keep), SUMMARY)
    now, out = Carry(), {}
    for r in sorted(parts.collect(), key=lambda r: r.range):
        if r.first == now.group:
            out[r.range] = now
        else:
            now = Carry(r.first)
        if r.first == r.last:  # one group fills the range
            tail = [float("nan") if x is None else x for x in r.tail]
            now = Carry(r.last, now.rows + r.rows_last, now.total + r.sum_last, (now.tail + tail)[max(0, len(now.tail) + len(tail) - keep) :])
        else:
            now = Carry(r.last, r.rows_last, r.sum_last, list(r.tail))
    return out


def running(
    df: DataFrame, by: list[str], order: list[str], added: str, made: Callable, kind: pa.DataType, value: str | None = None, keep: int = 0
) -> DataFrame:
    """Add a column that `made(place, sum before, values, offset)` gives for each sorted batch of rows.

    One shuffle, by range. A pass over groups and values tells what each range leaves to the next; the
    last pass starts each range with what it inherits.
    """
    ranged = in_order(df, by, order)
    inherited = carried(ranged, by, value, keep)
    names = df.columns
    at = names.index(value) if value else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runner = Runner(inherited.get(TaskContext.get().partitionId(), Carry()), keep)
        for batch in batches:
            if batch.num_rows:
                groups = [batch.column(names.index(c)) for c in by]
                column = made(*runner.step(groups, batch.column(at) if value else None, batch.num_rows))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(column, kind, from_pandas=True)], [*names, added])

    spark_kind = T.LongType() if kind == pa.int64() else T.DoubleType()
    return ranged.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(added, spark_kind)]))


def with_position(df: DataFrame, by: list[str], order, name: str = "position") -> DataFrame:
    """Add the row's 1-based number in its group by `order`; rows of one place are in order of their hash."""
    order = order if isinstance(order, list) else [order]
    return running(df, by, order, name, lambda place, *_: place, pa.int64())


def trailing_mean(df: DataFrame, by: list[str], order: list[str], value: str, k: int, name: str) -> DataFrame:
    """Add the mean of a row's value and the k - 1 before it in its group; nulls count as absent."""

    def mean(place, _, reach, offset):
        size = len(place)
        totals, counts = np.zeros(size), np.zeros(size)
        at = np.arange(size) + offset
        for back in range(k - 1, -1, -1):
            there = np.where((place > back) & (at >= back), reach[np.maximum(at - back, 0)], np.nan)
            known = ~np.isnan(there)
            totals[known] += there[known]
            counts += known
        with np.errstate(invalid="ignore"):
            return totals / counts

    return running(df, by, order, name, mean, pa.float64(), value, k - 1)
