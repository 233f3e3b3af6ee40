"""BPE encoding and decoding by a table of distinct words."""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tunewright.llm.bpe_count import PATTERN, byte_symbols
from tunewright.llm.common import Memo, bucketed, prepare

#: A chunk of documents shares one list of words; it ends with so many letters or distinct words.
CHUNK_CHARS = 8_000_000
CHUNK_WORDS = 1 << 20
#: Words are dealt to so many slots at most: a chunk's words of a slot are a row, and small ones compress badly.
SLOTS = 512
#: Rows of one output batch.
ROWS = 1000
#: Words of up to so many letters whose ids a task remembers.
KNOWN_WORDS, LONG_WORD = 200_000, 64
#: Ids go in 16 bits, less this.
LOWEST = 1 << 15
_LOADED: dict[str, "Vocabulary"] = {}


class Vocabulary:
    """A byte-level vocabulary file: how texts fall into words, the ids of a word, the bytes of an id.

    The file must split texts by the byte-level pattern, without a normalizer, a leading space or a
    post-processor, and match its special strings as they stand; anything else is an error.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            said = json.load(file)
        split, added = said.get("pre_tokenizer") or {}, said.get("added_tokens") or []
        plain = split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space")
        odd = [t for t in added if t.get("lstrip") or t.get("rstrip") or t.get("single_word") or t.get("normalized")]
        if not plain or odd or said.get("normalizer") or said.get("post_processor") or said["model"].get("type") != "BPE":
            raise ValueError(f"{path} is not a plain byte-level vocabulary")
        self.specials = {t["content"]: t["id"] for t in added}
        found = "|".join(map(regex.escape, sorted(self.specials, key=len, reverse=True)))
        self.special = regex.compile(f"({found})") if found else None
        self.find = regex.compile(PATTERN).findall
        self.model = Tokenizer.from_file(path).model
        self.symbols = dict(enumerate(byte_symbols()))
        self.pieces = said["model"]["vocab"]
        if max([*self.pieces.values(), *self.specials.values()], default=0) >= 1 << 16:
            raise ValueError(f"{path} has ids of more than 16 bits")

    def words(self, text: str) -> list[str]:
        """The words of a text, which together are the text; a special string is a word."""
        if not self.special or not self.special.search(text):
            return self.find(text)
        parts = self.special.split(text)
        return [w for i, part in enumerate(parts) for w in ([part] if i % 2 else self.find(part))]

    def ids(self, word: str) -> list[int]:
        if word in self.specials:
            return [self.specials[word]]
        return [t.id for t in self.model.tokenize(word.encode().decode("latin-1").translate(self.symbols))]

    def piece_rows(self) -> pa.Table:
        """(id, piece) of the whole vocabulary, pieces as the bytes they stand for."""
        byte = {s: b for b, s in self.symbols.items()}
        rows = {i: bytes(map(byte.__getitem__, p)) if all(c in byte for c in p) else p.encode() for p, i in self.pieces.items()}
        rows |= {i: s.encode() for s, i in self.specials.items()}
        return pa.table({"id": pa.array(list(rows), pa.int32()), "piece": pa.array(list(rows.values()), pa.binary())})


def vocabulary(path: str) -> Vocabulary:
    """One per worker process and path."""
    if path not in _LOADED:
        _LOADED[path] = Vocabulary(path)
    return _LOADED[path]


def pieces(spark: SparkSession, tokenizer: str) -> DataFrame:
    """(id, piece) of a vocabulary: as many rows as it has ids."""
    return spark.createDataFrame(vocabulary(tokenizer).piece_rows())


class Numbers(dict):
    """Words by the order in which they first occur."""

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        return number


def _planes(codes: np.ndarray) -> bytes:
    """Numbers as planes of bytes, of which the upper ones compress to little."""
    return np.ascontiguousarray(codes.astype("<u4").view(np.uint8).reshape(-1, 4).T[:3]).tobytes()


def _unplaned(planes: bytes) -> np.ndarray:
    low, middle, high = np.frombuffer(planes, np.uint8).reshape(3, -1).astype(np.int64)
    return low | middle << 8 | high << 16


def _packed(words: list[str]) -> bytes:
    """One word or more as their compressed bytes, with a byte between them that UTF-8 does not have."""
    return zlib.compress(b"\xff".join(w.encode() for w in words), 1)


def _unpacked(words: bytes) -> list[str]:
    return [w.decode() for w in zlib.decompress(words).split(b"\xff")]


def _sizes(each: list) -> bytes:
    """Lengths as planes of bytes, compressed."""
    return zlib.compress(np.fromiter(map(len, each), "<u4", len(each)).view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def _unsized(sizes: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(sizes), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


class Chunk:
    """Documents as the numbers of their words, and the distinct words of all of them."""

    def __init__(self, number: int):
        self.number, self.chars, self.numbers = number, 0, Numbers()
        self.keys: list[pa.Array] = []
        self.codes: list[np.ndarray] = []

    def add(self, key: pa.Array, text: str | None, split) -> None:
        found = split(text or "")
        self.chars += len(text or "")
        self.keys.append(key)
        self.codes.append(np.fromiter(map(self.numbers.__getitem__, found), np.uint32, len(found)))
        if len(self.numbers) > 1 << 24:
            raise ValueError("a text has more than 2^24 distinct words")

    def rows(self, slots: int, fields: pa.Schema) -> Iterator[pa.RecordBatch]:
        """Rows of documents, then a row of words for each slot.

        Words are numbered anew by (power of two of their count, slot, word): frequent ones first, whose
        numbers compress well, and the words of a slot in runs of numbers that are told by their first ones.
        """
        known = list(self.numbers)
        counts = np.bincount(np.concatenate([*self.codes, np.zeros(0, np.uint32)]), minlength=len(known))
        slot = np.fromiter((zlib.crc32(w.encode()) % slots for w in known), np.int64, len(known))
        rare = 64 - np.frexp(counts)[1].astype(np.int64)
        order = np.array(sorted(range(len(known)), key=known.__getitem__), np.int64)
        order = order[np.lexsort((slot[order], rare[order]))]
        final = np.empty(len(known), np.uint32)
        final[order] = np.arange(len(known))
        codes = [_planes(final[c]) for c in self.codes]
        self.codes.clear()
        for at in range(0, len(codes), ROWS):
            some = codes[at : at + ROWS]
            none = [pa.nulls(len(some), fields.field(i).type) for i in range(3, 6)]
            keys = pa.concat_arrays(self.keys[at : at + ROWS])
            yield pa.RecordBatch.from_arrays([pa.array([self.number] * len(some), pa.int64()), keys, pa.array(some, pa.binary()), *none], schema=fields)
        rows = []
        by_slot = np.argsort(slot[order], kind="stable")
        for mine in np.split(by_slot, np.flatnonzero(np.diff(slot[order][by_slot])) + 1):
            if len(mine):
                starts = np.concatenate([[0], np.flatnonzero(np.diff(mine) != 1) + 1])
                runs = np.stack([mine[starts], np.diff([*starts, len(mine)])]).astype("<u4")
                rows.append((self.number, int(slot[order[mine[0]]]), runs.tobytes(), _packed([known[i] for i in order[mine].tolist()])))
        columns = list(zip(*rows)) or [()] * 4
        first, *rest = [pa.array(c, fields.field(i).type) for c, i in zip(columns, (0, 3, 4, 5))]
        none = [pa.nulls(len(rows), fields.field(i).type) for i in (1, 2)]
        yield pa.RecordBatch.from_arrays([first, *none, *rest], schema=fields)


def _coded(tokenizer: str, key_type: pa.DataType, slots: int):
    """Batches of (key, text) to rows of documents (chunk, key, codes) and of words (chunk, slot, runs, words).

    Chunks are numbered within the task, so a task run again writes the same.
    """
    kinds = (pa.int64(), key_type, pa.binary(), pa.int32(), pa.binary(), pa.binary())
    fields = pa.schema(list(zip(["chunk", "key", "codes", "slot", "runs", "words"], kinds)))

    def run(batches):
        split = vocabulary(tokenizer).words
        chunk = Chunk(TaskContext.get().partitionId() << 32)
        for batch in batches:
            for i, text in enumerate(batch.column(1).to_pylist()):
                if chunk.chars >= CHUNK_CHARS or len(chunk.numbers) >= CHUNK_WORDS:
                    yield from chunk.rows(slots, fields)
                    chunk = Chunk(chunk.number + 1)
                    pa.default_memory_pool().release_unused()
                chunk.add(batch.column(0).slice(i, 1), text, split)
        yield from chunk.rows(slots, fields)

    return run


def _encoded(tokenizer: str):
    """Rows (chunk, runs, words) of one slot to (chunk, runs, lengths, ids): ids one after the other, less 32,768.

    All rows that hold a word are in one partition, so it is encoded once; again only where more
    words than a `Memo` holds came since.
    """

    def run(batches):
        known = Memo(vocabulary(tokenizer).ids, KNOWN_WORDS)
        for batch in batches:
            lengths, ids = [], []
            for words in batch.column(2).to_pylist():
                each = [known[w] if len(w) <= LONG_WORD else known.make(w) for w in _unpacked(words)]
                lengths.append(_sizes(each))
                ids.append((np.fromiter(chain.from_iterable(each), np.int64) - LOWEST).astype(np.int16))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(lengths, pa.binary()), pa.array(ids, pa.list_(pa.int16()))], ["chunk", "runs", "lengths", "ids"]
            )

    return run


def _spelled(pieces_in_order: pa.BinaryArray, starts: np.ndarray, ends: np.ndarray) -> list[bytes]:
    """The bytes of each word, whose pieces follow each other."""
    if not len(pieces_in_order):
        return []
    _, offsets, data = pieces_in_order.buffers()
    bounds = np.frombuffer(offsets, np.int32)[: len(pieces_in_order) + 1]
    whole = data.to_pybytes() if data else b""
    return [whole[a:b] for a, b in zip(bounds[starts].tolist(), bounds[ends].tolist())]


def _joined(key: str):
    """Documents of a chunk, and the pieces of the ids in it, to (key, n_tokens, ids, decoded).

    One of the ids brings the chunk's parts: numbers of words, how many tokens each has, their ids.
    """

    def run(documents: pa.Table, used: pa.Table) -> pa.Table:
        parts = used.column("parts").drop_null().combine_chunks().flatten()
        runs, lengths, ids = parts.flatten()
        flat = ids.flatten().to_numpy().astype(np.int32) + LOWEST
        spans = [np.frombuffer(x, "<u4").reshape(2, -1).T.tolist() for x in runs.to_pylist()]
        number = np.concatenate([np.zeros(0, np.int64), *(np.arange(a, a + n) for each in spans for a, n in each)])
        size = np.concatenate([np.zeros(0, "<u4"), *map(_unsized, lengths.to_pylist())]).astype(np.int64)
        ends = np.cumsum(size)
        starts, counts = np.zeros(len(number), np.int64), np.zeros(len(number), np.int64)
        starts[number], counts[number] = ends - size, size
        place = np.zeros(1 << 16, np.int32)
        place[used.column("token").to_numpy()] = np.arange(used.num_rows)
        said = _spelled(used.column("piece").combine_chunks().take(pa.array(place[flat])), starts, starts + counts)
        del used, parts, runs, lengths, ids
        pa.default_memory_pool().release_unused()
        codes = [_unplaned(planes) for planes in documents.column("codes").to_pylist()]
        totals = np.array([counts[c].sum() for c in codes], np.int64)
        ids, at = np.empty(int(totals.sum()), np.int32), 0
        texts = []
        for c, total in zip(codes, totals.tolist()):
            each = counts[c]
            # token t of a word that starts at s is at s + t of the flat ids
            ids[at : at + total] = flat[np.arange(total) + np.repeat(starts[c] - np.cumsum(each) + each, each)]
            texts.append(b"".join(map(said.__getitem__, c.tolist())).decode("utf-8", "replace"))
            at += total
        bounds = pa.array(np.concatenate([[0], np.cumsum(totals)]).astype(np.int32))
        return pa.table(
            {
                key: documents.column("key"),
                "n_tokens": pa.array(totals),
                "ids": pa.ListArray.from_arrays(bounds, pa.array(ids)),
                "decoded": pa.array(texts, pa.string()),
            }
        )

    return run


def round_trip(documents: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_tokens, ids, decoded) of every row: its token ids, and the text that these ids decode to.

    tokenizer: path of a byte-level vocabulary of at most 65,536 ids, which workers open. Texts are
    split into words in one pass, which writes them as numbers within a chunk of documents, and each
    chunk's distinct words. These are dealt by a hash, so that a distinct word is encoded in one place; its
    ids go back to the chunks and meet documents by position; the distinct ids of a chunk, never more than
    the vocabulary has, meet their pieces in a join with it. Documents are neither shuffled nor read twice:
    they are written in files by chunk.

    A null text is like the empty one, which has no tokens and decodes to itself. Repeated rows give
    repeated rows; null keys are like others; an empty table gives an empty one; extra columns are not read.
    """
    spark = prepare(documents.sparkSession)
    kind = documents.schema[key].dataType
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = documents.select(F.col(key).alias("key"), F.col(text).alias("text"))
    coded = rows.mapInArrow(
        _coded(tokenizer, _arrow_type(rows), min(buckets, SLOTS)),
        f"chunk long, key {kind.simpleString()}, codes binary, slot int, runs binary, words binary",
    )
    coded = bucketed(coded, "codes", "chunk", buckets)
    words = coded.where("slot IS NOT NULL").select("slot", "chunk", "runs", "words").repartition("slot").drop("slot")
    ids = words.mapInArrow(_encoded(tokenizer), "chunk long, runs binary, lengths binary, ids array<smallint>").repartition(buckets, "chunk")
    # a chunk is bounded, so are its parts; they come with the first of its ids, and only these few rows are sorted by chunk
    whole = ids.groupBy("chunk").agg(F.collect_list(F.struct("runs", "lengths", "ids")).alias("parts"))
    used = whole.select("chunk", "parts", F.posexplode(F.array_distinct(F.flatten("parts.ids"))).alias("pos", "token")).select(
        "chunk", (F.col("token").cast("int") + LOWEST).alias("token"), F.when(F.col("pos") == 0, F.col("parts")).alias("parts")
    )
    named = used.join(F.broadcast(pieces(spark, tokenizer).withColumnRenamed("id", "token")), "token")
    texts = coded.where("codes IS NOT NULL").select("chunk", "key", "codes")
    return (
        texts.groupBy("chunk").cogroup(named.groupBy("chunk"))
        .applyInArrow(_joined(key), f"`{key}` {kind.simpleString()}, n_tokens long, ids array<int>, decoded string")
    )


def _arrow_type(rows: DataFrame) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(rows.schema["key"].dataType)


def digests(rows: DataFrame, key: str = "doc_id") -> DataFrame:
    """key, n_tokens, ids_sha256 (decimal ids joined by commas) and decoded_sha256 of encoded rows."""
    listed = F.array_join(F.col("ids").cast("array<string>"), ",")
    return rows.select(key, "n_tokens", F.sha2(listed, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def decode(rows: DataFrame, tokenizer: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """Rows with the text that their ids decode to, through a join of each id with its piece.

    Bytes that are no UTF-8 become replacement characters. Null and empty lists decode to the empty
    text; ids that the vocabulary does not have, and null ones, are left out. `into` replaces a column of its name.
    """
    spark = prepare(rows.sparkSession)
    kept = [c for c in rows.columns if c != into]
    marked = rows.select(F.struct(*kept).alias("row"), F.coalesce(ids, F.array()).alias("ids")).withColumn("at", F.monotonically_increasing_id())
    tokens = marked.select("at", "row", F.posexplode_outer("ids").alias("pos", "id"))
    met = tokens.join(F.broadcast(pieces(spark, tokenizer)), "id", "left")
    # the row itself comes with its first token only
    listed = met.groupBy("at").agg(
        F.any_value(F.when(F.coalesce("pos", F.lit(0)) == 0, F.col("row")), True).alias("row"),
        F.array_sort(F.collect_list(F.when(F.col("piece").isNotNull(), F.struct("pos", "piece")))).alias("parts"),
    )
    joined = F.aggregate("parts", F.lit(b""), lambda whole, part: F.concat(whole, part["piece"]))
    return listed.select("row.*", F.try_validate_utf8(joined.cast("string")).alias("_valid"), joined.alias("_bytes")).select(
        *kept, F.coalesce("_valid", F.make_valid_utf8(F.col("_bytes").cast("string"))).alias(into)
    )
