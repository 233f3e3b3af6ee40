"""JSON array files of any size, cut at the borders of their elements by many tasks."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tunewright.session import fresh_dir

#: More splits than that are met by a shuffle; a split's row is some 200 bytes.
BROADCAST_SPLITS = 100_000
#: Files are read in fragments that end with it, which no file system has to understand.
CLOSE = "}"
#: A backslash takes the next character with it on either side of a quote, so that wherever a reader
#: starts it sees the same quotes.
_TOKEN = re.compile(r'"[^"\\]*(?:\\.[^"\\]*)*("?)|\\.|[\[\]{},]', re.S)
_STRING_END = re.compile(r'[^"\\]*(?:\\.[^"\\]*)*"', re.S)
_ROWS = 5000

SPLIT = (
    "file STRING, start BIGINT, file_size BIGINT, bytes BIGINT, solid INT, opening STRING, flips INT, "
    "depth0 BIGINT, depth1 BIGINT, commas0 MAP<BIGINT, BIGINT>, commas1 MAP<BIGINT, BIGINT>, shut0 ARRAY<BIGINT>, shut1 ARRAY<BIGINT>"
)
CUT = "file STRING, entry BIGINT, start BIGINT, raw STRING, done BOOLEAN, whole BOOLEAN, closed BOOLEAN"


def walk(text: str, inside: bool) -> tuple[list[tuple[int, str]], bool]:
    """Brackets, braces and commas outside strings, by place, and whether the text ends inside a string."""
    at = 0
    if inside:
        end = _STRING_END.match(text)
        if not end:
            return [], True
        at = end.end()
    found, inside = [], False
    for token in _TOKEN.finditer(text, at):
        if token.group(1) is not None:
            inside = token.group(1) == ""
        elif token.group()[0] != "\\":
            found.append((token.start(), token.group()))
    return found, inside


class Summary:
    """What a split does to a reader that comes to it outside (0) or inside (1) a string."""

    def __init__(self, file: str, start: int, file_size: int):
        self.place = (file, start, file_size)
        self.bytes = self.solid = 0
        self.opening = None
        self.inside, self.depth, self.commas = [False, True], [0, 0], [Counter(), Counter()]
        #: depths that something has been closed at; no comma counts there any more, lest it be of a second array
        self.shut: list[set[int]] = [set(), set()]

    def add(self, value: str) -> None:
        text = value + CLOSE
        self.bytes += len(text.encode())
        if self.solid < 3:
            self.solid += len("".join(value.split()))
        for p in (0, 1):
            found, self.inside[p] = walk(text, self.inside[p])
            depth, commas, shut = self.depth[p], self.commas[p], self.shut[p]
            if p == 0 and found and self.opening is None:
                self.opening = found[0][1]
            for _, mark in found:
                if mark == ",":
                    commas[depth] += depth not in shut
                elif mark in "[{":
                    depth += 1
                else:
                    shut.add(depth)
                    depth -= 1
            self.depth[p] = depth

    def row(self) -> tuple:
        # an odd number of quotes turns a reader inside out, whichever side it comes from
        return (*self.place, self.bytes, min(self.solid, 3), self.opening, int(self.inside[0]), *self.depth, *map(dict, self.commas), *map(list, self.shut))


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Fragments in order to a row a split."""
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.int32(), pa.int64(), pa.int64()]
    kinds += [pa.map_(pa.int64(), pa.int64())] * 2 + [pa.list_(pa.int64())] * 2
    names = [field.split()[0] for field in SPLIT.replace("<BIGINT, BIGINT>", "").split(", ")]
    now, done = None, []
    for batch in batches:
        for file, start, size, _, value in zip(*(c.to_pylist() for c in batch.columns)):
            if now is None or now.place[:2] != (file, start):
                done += [now.row()] if now else []
                now = Summary(file, start, size)
            now.add(value)
    done += [now.row()] if now else []
    columns = list(zip(*done)) or [()] * len(kinds)
    mapped = [[list(c.items()) for c in column] if pa.types.is_map(kind) else column for column, kind in zip(columns, kinds)]
    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(mapped, kinds)], names)


class Cutter:
    """Cuts the fragments of a split at the commas between elements, from the state in which the split starts."""

    def __init__(self, file: str, start: int, inside: int, depth: int, over: bool, entry: int, closed: bool):
        self.file, self.start, self.over, self.closed = file, start, over, closed
        self.inside, self.depth, self.entry = bool(inside), depth, entry
        self.parts: list[str] = []
        self.own = depth == 0  # the element began in this split

    def _element(self, done: bool) -> Iterator[tuple]:
        raw = "".join(self.parts)
        if not self.own or not done or raw.strip():
            yield self.file, self.entry, self.start, raw.strip() if self.own and done else raw, done, self.own and done, self.closed
        self.parts, self.own = [], True

    def add(self, value: str) -> Iterator[tuple]:
        if self.over:  # what follows the array
            return
        text, at = value + CLOSE, 0
        found, self.inside = walk(text, self.inside)
        for place, mark in found:
            if mark == ",":
                if self.depth == 1:
                    self.parts.append(text[at:place])
                    at = place + 1
                    yield from self._element(True)
                    self.entry += 1
            elif mark in "[{":
                self.depth += 1
                if self.depth == 1:
                    at = place + 1
            else:
                self.depth -= 1
                if self.depth == 0:
                    self.parts.append(text[at:place])
                    yield from self._element(True)
                    self.over = True
                    return
        if self.depth > 0:
            self.parts.append(text[at:])

    def end(self) -> Iterator[tuple]:
        if not self.over and self.parts:
            yield from self._element(False)


def _elements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Fragments in order, with their split's state, to elements and the parts of those that a split ends in."""
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.bool_(), pa.bool_()]
    names = [field.split()[0] for field in CUT.split(", ")]

    def rows(out):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*out)) or [()] * 7, kinds)], names)

    now, out = None, []
    for batch in batches:
        for file, start, value, inside, depth, over, entry, closed in zip(*(c.to_pylist() for c in batch.columns)):
            if now is None or (now.file, now.start) != (file, start):
                if depth is None:
                    raise RuntimeError(f"{file} is split otherwise than a moment ago; read it again")
                out += now.end() if now else ()
                now = Cutter(file, start, inside, depth, over, entry, closed)
            out += now.add(value)
            if len(out) >= _ROWS:
                yield rows(out)
                out = []
    yield rows([*out, *(now.end() if now else ())])


def _fragments(spark: SparkSession, path: str) -> DataFrame:
    source = F.col("_metadata")
    return spark.read.option("lineSep", CLOSE).text(path).select(
        source["file_path"].alias("file"), source["file_block_start"].alias("start"), source["file_size"].alias("file_size"),
        F.monotonically_increasing_id().alias("at"), "value",
    )


def _states(spark: SparkSession, path: str) -> DataFrame:
    """A row per split: whether it starts in a string, how deep, and in which element. Written, as both passes need one answer."""
    splits = _fragments(spark, path).mapInArrow(_summaries, SPLIT)
    kept = fresh_dir(spark, "splits")
    splits.write.parquet(kept)
    splits = spark.read.schema(SPLIT).parquet(kept)
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("file")
    earlier = lambda column: F.coalesce(F.sum(column).over(before), F.lit(0))
    by_side = lambda name: F.when(F.col("inside") == 0, F.col(f"{name}0")).otherwise(F.col(f"{name}1"))
    return (
        splits.withColumn("inside", earlier("flips") % 2)
        .withColumn("depth", earlier(by_side("depth")))
        .withColumn("top", F.lit(1).cast("bigint") - F.col("depth"))  # the depth of commas between elements, as the split counts
        .withColumn("over", F.coalesce(F.max(F.array_contains(by_side("shut"), F.col("top"))).over(before), F.lit(False)))
        .withColumn("commas", F.when(F.col("over"), 0).otherwise(F.coalesce(F.try_element_at(by_side("commas"), F.col("top")), F.lit(0))))
        .withColumn("entry", earlier("commas") + 1)
        # the last fragment of a file that does not end with a brace was given one more byte than it has
        .withColumn("closed", F.sum("bytes").over(whole) == F.col("file_size"))
        .withColumn("array", F.min_by("opening", F.when(F.col("opening").isNotNull(), F.col("start"))).over(whole) == "[")
        .withColumn("entries", F.when(F.sum("solid").over(whole) > 2, F.sum("commas").over(whole) + 1).otherwise(0))
    )


def read_array(spark: SparkSession, path: str) -> DataFrame:
    """(file, entry, number, raw) of every element of files that hold one JSON array each.

    `entry` counts from 1 within a file, `number` over all files in order of their paths. A file is
    read by as many tasks as it has splits. Three passes read it: the first says what each split
    does to a reader's state (in a string or not, depth, commas by depth), whichever state it starts in; sums
    over the splits before give each its real state; the others cut elements there. Only an element
    that a split ends in is put together by a shuffle. Fragments end at closing braces, so a
    file without any is read by one task.

    A file that ends before its array does has what is left as its last element; what follows the
    array is ignored; a file that does not start with a bracket has no elements.
    """
    states = _states(spark, path).where("array")
    known = states.select("file", "start", "inside", "depth", "over", "entry", "closed")
    earlier = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)  # a row a file
    files = states.select("file", "entries").distinct().select("file", F.coalesce(F.sum("entries").over(earlier), F.lit(0)).alias("_before"))
    few = known.count() <= BROADCAST_SPLITS
    small = F.broadcast if few else lambda df: df
    fragments = _fragments(spark, path).drop("file_size").join(small(files.select("file")), "file", "left_semi")
    met = fragments.join(small(known), ["file", "start"], "left")
    if not few:
        met = met.repartition("file", "start").sortWithinPartitions("file", "start", "at")
    cut = met.select("file", "start", "value", "inside", "depth", "over", "entry", "closed").mapInArrow(_elements, CUT)
    parts = cut.where("NOT whole").groupBy("file", "entry").agg(
        F.array_sort(F.collect_list(F.struct("start", "raw"))).alias("parts"), F.bool_or("done").alias("done"), F.any_value("closed").alias("closed")
    )
    joined = F.array_join(F.transform("parts", lambda part: part["raw"]), "")
    torn = F.when(F.col("done") | F.col("closed"), joined).otherwise(joined.substr(F.lit(1), F.length(joined) - 1))
    trimmed = F.regexp_replace(torn, r"\A\s+|\s+\z", "")
    rows = cut.where("whole").select("file", "entry", "raw").unionByName(parts.select("file", "entry", trimmed.alias("raw")).where("raw <> ''"))
    return rows.join(small(files), "file").select("file", "entry", (F.col("_before") + F.col("entry")).alias("number"), "raw")


def write_array(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write rows as JSON arrays, a file for each task; a missing value leaves its key out."""
    write_array_text(df.select(F.to_json(F.struct(*df.columns)).alias("raw")), "raw", path, mode)


def write_array_text(df: DataFrame, raw: str, path: str, mode: str = "errorifexists") -> None:
    """Write a column of JSON texts as the elements of arrays, in the order of rows, a file for each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mark = "["
        for batch in batches:
            lines = []
            for value in batch.column(0).to_pylist():
                lines.append(mark + value)
                mark = ","
            yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], ["value"])
        yield pa.RecordBatch.from_arrays([pa.array(["[]" if mark == "[" else "]"])], ["value"])

    df.select(raw).mapInArrow(run, "value STRING").write.mode(mode).text(path)
