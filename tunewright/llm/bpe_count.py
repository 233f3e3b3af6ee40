"""Token counts by heap-and-linked-list byte-pair merging; no identifiers are made."""

from __future__ import annotations

import json
from heapq import heapify, heappop, heappush
from typing import Iterator

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunewright.llm.common import Memo, prepare

LIMIT = 1024
#: Fixed value: the pattern that splits text before the merges of byte-level vocabularies, white space by its property.
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)


def byte_symbols() -> list[str]:
    """The character that stands for each byte: printable Latin-1 for itself, others from 256 on."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(spare)) for b in range(256)]


class Counter:
    """Counts tokens of texts under the merges of a tokenizer file; words met before are remembered."""

    def __init__(self, path: str, cached: int = 300_000):
        with open(path, encoding="utf-8") as file:
            said = json.load(file)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in said["model"]["merges"]]
        symbols = byte_symbols()
        number = {s: i for i, s in enumerate(symbols)}
        self.pairs: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, (left, right) in enumerate(pairs):
            whole = number.setdefault(left + right, len(number))
            self.pairs.setdefault((number[left], number[right]), (rank, whole))
        specials = [t["content"] for t in said.get("added_tokens") or []]
        self.specials = regex.compile("|".join(map(regex.escape, sorted(specials, key=len, reverse=True)))) if specials else None
        self.split = regex.compile(PATTERN).findall
        self.words = Memo(lambda word: self.count_word(word.encode()), cached)

    def count_word(self, word: bytes) -> int:
        """Bytes minus merges: pop the lowest-rank adjacent pair, leftmost first, until none is left."""
        size = len(word)
        pairs = self.pairs
        symbol = list(word)
        after = list(range(1, size + 1))
        before = list(range(-1, size - 1))
        heap = [(found[0], i) for i in range(size - 1) if (found := pairs.get((symbol[i], symbol[i + 1])))]
        heapify(heap)
        merges = 0
        while heap:
            rank, i = heappop(heap)
            j = after[i] if symbol[i] >= 0 else size
            if j >= size:
                continue
            found = pairs.get((symbol[i], symbol[j]))
            if not found or found[0] != rank:
                continue  # one of the two has merged meanwhile
            merges += 1
            symbol[i], symbol[j] = found[1], -1
            k = after[i] = after[j]
            if k < size:
                before[k] = i
                if found := pairs.get((symbol[i], symbol[k])):
                    heappush(heap, (found[0], i))
            h = before[i]
            if h >= 0 and (found := pairs.get((symbol[h], symbol[i]))):
                heappush(heap, (found[0], h))
        return size - merges

    def count(self, text: str | None) -> int:
        """Tokens of a whole text; a special string is one token and ends the text on either side of it."""
        if not text:
            return 0
        total = 0
        if self.specials and self.specials.search(text):
            parts = self.specials.split(text)
            total, parts = len(parts) - 1, parts
        else:
            parts = [text]
        for part in parts:
            total += sum(map(self.words.__getitem__, self.split(part)))
        return total


def count_tokens(documents: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", limit: int = LIMIT) -> DataFrame:
    """key, n_bytes (UTF-8), n_tokens, over_limit of every row.

    tokenizer: path of a byte-level vocabulary, which workers open. Null and empty texts have no
    tokens. Repeated rows give repeated rows; null keys are like others; extra columns are not read.
    """
    prepare(documents.sparkSession)

    @F.pandas_udf("long")
    def tokens(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = Counter(tokenizer)
        for texts in batches:
            yield pd.Series([counter.count(t) for t in texts], dtype="int64")

    counted = documents.select(
        F.col(key), F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"), tokens(F.col(text)).alias("n_tokens")
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
