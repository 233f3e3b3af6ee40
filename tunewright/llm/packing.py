"""Hierarchical packing of token sequences into windows of several lengths."""

from __future__ import annotations

import json
import re
import struct
import zlib
from bisect import bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunewright.llm.bpe_count import byte_symbols
from tunewright.llm.common import Memo, kept, prepare, serve

#: Window lengths from short to long; powers of two, so that a full window of any tier needs no padding.
TIERS = (256, 512, 1024, 2048)
#: Tokens of one step group: as many for every tier.
STEP_TOKENS = 32 * 2048
#: Tokens that a task holds before it packs what it has.
BUFFER_TOKENS = 4_000_000
END_ID = 1
#: Runs between spaces that an encoder remembers, twice over, and that it encodes at once.
CACHED_RUNS = 200_000
RUNS_AT_ONCE = 20_000
#: Longer runs are forgotten at once.
LONG_RUN = 64
#: What only Python takes for white space; a text with it is split at blanks and line ends alone.
_ODD = re.compile("[\x1c-\x1f]")
_SPACES = re.compile(r"[ \t\n\r]+")
#: The vocabulary's pattern of what is merged apart, and the same for lower-case ASCII without white space.
_LETTER_PARTS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")
_PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")
#: Runs of printable ASCII and of Latin, Greek and Cyrillic letters that have one lower case and are composed as they stand.
_PLAIN = re.compile(r"[!-~\u00C0-\u012F\u0132-\u017E\u0391-\u03A1\u03A4-\u03A9\u03B1-\u03C1\u03C3-\u03C9\u0400-\u045F]+").fullmatch


def _plain(text: str) -> str:
    """ASCII text in lower case, which the vocabulary makes it anyway, unless special strings may be in it."""
    return text.lower() if text.isascii() and "<|" not in text else text


class Runs(dict):
    """Ids of runs; those of a new one are what `new` gives, or nothing for now if that is None."""

    def __init__(self, new):
        super().__init__()
        self.new = new

    def __missing__(self, run: str) -> bytes:
        ids = self.new(run)
        if ids is None:
            return b""
        self[run] = ids
        return ids


class Encoder:
    """Token ids of texts as little-endian 32-bit bytes, the ids of each run between spaces remembered.

    For a vocabulary of lower-case text whose pre-tokenizer drops white space and never joins what it separates, the ids
    of a text are those of its runs one after the other. A new run of plain letters is taken apart by the
    vocabulary's pattern, and its parts are remembered too; others are encoded many at a time, as one
    text, and told apart by where their tokens start.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            said = json.load(file)
        steps = [s.get("type") for s in (said.get("normalizer") or {}).get("normalizers", [])]
        cuts = (said.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        if steps != ["NFC", "Replace", "Lowercase"] or cuts[0].get("type") != "Split" or cuts[0].get("behavior") != "Removed" or said.get("post_processor"):
            raise ValueError(f"{path} does not lower-case texts and drop white space")
        self.tokenizer = Tokenizer.from_file(path)
        self.runs, self.older = Runs(self._new), {}
        self.parts = Memo(self._part, CACHED_RUNS)
        self.merge, self.symbols = self.tokenizer.model.tokenize, dict(enumerate(byte_symbols()))
        #: runs of the texts at hand: those to encode as one text, and those to forget
        self.odd: list[str] = []
        self.long: list[str] = []

    def _new(self, run: str) -> bytes | None:
        """Ids of a run that is not remembered: those of its parts if it is plain, which the model alone can tell."""
        if len(run) > LONG_RUN:
            self.long.append(run)
        elif (ids := self.older.get(run)) is not None:
            return ids
        if not _PLAIN(run) or "<|" in run:
            self.odd.append(run)
            return None
        run = run.lower()
        if run.isalpha():
            return self.parts[run]
        return b"".join(map(self.parts.__getitem__, (_PARTS if run.isascii() else _LETTER_PARTS).findall(run)))

    def _part(self, part: str) -> bytes:
        letters = part if part.isascii() else part.encode().decode("latin-1").translate(self.symbols)
        ids = [token.id for token in self.merge(letters)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _learn(self, new: list[str]) -> None:
        for at in range(0, len(new), RUNS_AT_ONCE):
            some = new[at : at + RUNS_AT_ONCE]
            said = self.tokenizer.encode(" ".join(some), add_special_tokens=False)
            starts = np.cumsum([0] + [len(run) + 1 for run in some])
            first = np.fromiter((a for a, _ in said.offsets), np.int64, len(said.ids))
            cuts = (4 * np.searchsorted(first, starts)).tolist()
            ids = np.asarray(said.ids, "<u4").tobytes()
            self.runs.update((run, ids[a:b]) for run, a, b in zip(some, cuts, cuts[1:]))

    def __call__(self, texts: list[str | None]) -> list[bytes]:
        split = [list(filter(None, _SPACES.split(t))) if t and _ODD.search(t) else _plain(t or "").split() for t in texts]
        if len(self.runs) > CACHED_RUNS:
            self.older, self.runs = self.runs, Runs(self._new)
        self.odd, self.long = [], []
        ids, unfinished = [], []
        for i, runs in enumerate(split):
            known = len(self.odd)
            ids.append(b"".join(map(self.runs.__getitem__, runs)))
            if len(self.odd) > known:
                unfinished.append(i)
        if unfinished:
            self._learn(list(dict.fromkeys(self.odd)))
            for i in unfinished:
                ids[i] = b"".join(map(self.runs.__getitem__, split[i]))
        for run in self.long:
            self.runs.pop(run, None)
        return ids


_ENCODERS: dict[str, Encoder] = kept({})


def encoder(path: str) -> Encoder:
    """One per worker process and path, so that later tasks know the runs of earlier ones."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


class Packer:
    """Packs documents in the order they come; holds a bounded number of tokens at a time.

    Whole windows of the longest tier are cut from a document first. The rest goes to the shortest
    tier that holds it. Each tier is packed best fit, the longest piece first; gaps of a window are
    filled with whole pieces of its own and then of shorter tiers, and at last with the head of a
    piece whose tail goes back to the tier it fits. Only full windows leave; `finish` lets the last
    tokens leave in windows of smaller powers of two.
    """

    def __init__(self, tiers: tuple[int, ...] = TIERS, step_tokens: int = STEP_TOKENS):
        self.tiers, self.step_tokens = tuple(sorted(tiers)), step_tokens
        #: pieces (length, number of the document, start) in order of length, per tier
        self.waiting: dict[int, list] = {t: [] for t in self.tiers}
        self.docs: dict[int, tuple] = {}
        self.tokens = self.added = self.sequences = 0
        self.steps: dict[int, list[int]] = {}
        self.next_step = 0

    def add(self, doc_id, ids: bytes):
        """Take a document; yields the windows that it fills alone."""
        number, self.added = self.added, self.added + 1
        total, longest = len(ids) // 4, self.tiers[-1]
        self.docs[number] = (doc_id, ids, total)
        start = 0
        while total - start >= longest:
            yield from self._window([(longest, number, start)], longest)
            start += longest
        if start < total:
            self._wait((total - start, number, start))
            self.tokens += total - start
        else:
            del self.docs[number]

    def _wait(self, piece) -> None:
        insort(self.waiting[next(t for t in self.tiers if piece[0] <= t)], piece)

    def _take(self, gap: int, tier: int):
        """The longest whole piece for a gap, from this tier or a shorter one."""
        for t in reversed(self.tiers):
            if t <= tier and self.waiting[t]:
                at = bisect_right(self.waiting[t], (gap, float("inf"), 0))
                if at:
                    return self.waiting[t].pop(at - 1)
        return None

    def _cut(self, gap: int, tier: int):
        """The head of some longer piece that fills a gap; its tail waits again."""
        for t in self.tiers:
            if t <= tier and self.waiting[t]:
                length, number, start = self.waiting[t].pop()
                self._wait((length - gap, number, start + gap))
                return gap, number, start
        return None

    def _window(self, pieces, size: int):
        """Rows of one window: (doc_id, start, length, crc, doc tokens, sequence, offset, window, step)."""
        sequence, self.sequences = self.sequences, self.sequences + 1
        step = self._step(size)
        offset = 0
        for length, number, start in pieces:
            doc_id, ids, total = self.docs[number]
            crc = zlib.crc32(memoryview(ids)[4 * start : 4 * (start + length)])
            yield doc_id, start, length, crc, total, sequence, offset, size, step
            offset += length

    def _step(self, size: int) -> int:
        """Windows of one size fill step groups of the same number of tokens."""
        tier = size if size >= self.tiers[0] else 0
        group = self.steps.get(tier)
        if group is None or group[1] + size > self.step_tokens:
            group = self.steps[tier] = [self.next_step, 0]
            self.next_step += 1
        group[1] += size
        return group[0]

    def pack(self, keep: int = 0):
        """Full windows of what waits, long tiers first, until at most `keep` tokens or no full window is left."""
        for tier in reversed(self.tiers):
            while self.waiting[tier] and self.tokens >= tier and self.tokens > keep:
                if sum_at_least(self.waiting, self.tiers, tier) < tier:
                    break
                piece = self.waiting[tier].pop()
                pieces, gap = [piece], tier - piece[0]
                while gap:
                    piece = self._take(gap, tier) or self._cut(gap, tier)
                    pieces.append(piece)
                    gap -= piece[0]
                yield from self._leave(pieces, tier)

    def finish(self):
        """All that is left: full windows, then what fills none in ever smaller powers of two."""
        yield from self.pack()
        rest = sorted((p for t in self.tiers for p in self.waiting[t]), reverse=True)
        for t in self.tiers:
            self.waiting[t] = []
        size = self.tiers[-1]
        while rest:
            while size > self.tokens:
                size //= 2
            pieces, gap = [], size
            while gap:
                length, number, start = rest.pop(0)
                if length > gap:
                    rest.insert(0, (length - gap, number, start + gap))
                    length = gap
                pieces.append((length, number, start))
                gap -= length
            yield from self._leave(pieces, size)

    def _leave(self, pieces, size: int):
        self.tokens -= size
        yield from self._window(pieces, size)

    def forget(self) -> None:
        """Drop documents of which nothing waits."""
        needed = {p[1] for t in self.tiers for p in self.waiting[t]}
        self.docs = {k: v for k, v in self.docs.items() if k in needed}


def sum_at_least(waiting, tiers, tier: int) -> int:
    """Tokens waiting in this and shorter tiers, counted until they fill a window."""
    total = 0
    for t in tiers:
        if t > tier:
            break
        for piece in reversed(waiting[t]):
            total += piece[0]
            if total >= tier:
                return total
    return total


FIELDS = "{key} {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, window int, step_group long"


def pack_documents(
    documents: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text",
    tiers: tuple[int, ...] = TIERS, end_id: int = END_ID, buffer_tokens: int = BUFFER_TOKENS,
) -> DataFrame:
    """Pieces of all documents in windows of at most the longest tier.

    tokenizer: path of the vocabulary, which workers open. A document is its ids and then `end_id`; a
    null or empty text is `end_id` alone. Columns: key, start, length, ids_crc32, doc_tokens,
    sequence_id, offset, window (length that the window has), step_group. Each id lies in one piece;
    a window is gapless from 0 and full, so nothing is padded. Every task packs its own partition in
    one pass, in bounded memory; ids of sequences and step groups are the task's number and a count,
    so a task run again gives the same rows. A step group holds windows of one length and
    32 * 2048 tokens, but for the last ones of a task. Repeated rows are packed each time; null keys
    like others; extra columns are not read; an empty table gives an empty one.
    """
    prepare(documents.sparkSession)
    kind = documents.schema[key].dataType.simpleString()
    end = np.asarray([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        serve("packing")
        encode, packer = encoder(tokenizer), Packer(tiers)
        first = TaskContext.get().partitionId() << 40

        def table(rows):
            columns = list(zip(*rows)) if rows else [[] for _ in range(9)]
            data = [pa.array(columns[0], schema_type)]
            for i in range(1, 9):
                numbers = np.asarray(columns[i], np.int64) + (first if i in (5, 8) else 0)
                data.append(pa.array(numbers, pa.int32() if i == 7 else pa.int64()))
            return pa.RecordBatch.from_arrays(data, [key, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "window", "step_group"])

        schema_type = None
        for batch in batches:
            schema_type = batch.column(0).type
            rows = []
            for doc_id, ids in zip(batch.column(0).to_pylist(), encode(batch.column(1).to_pylist())):
                rows.extend(packer.add(doc_id, ids + end))
                if packer.tokens >= buffer_tokens:
                    rows.extend(packer.pack(buffer_tokens // 4))
                    packer.forget()
            packer.forget()
            yield table(rows)
        if schema_type is not None:
            yield table(list(packer.finish()))

    return documents.select(key, text).mapInArrow(run, FIELDS.format(key=f"`{key}`", kind=kind))
