"""Language of mixed texts: script ranges narrow the candidates, Viterbi labels spans of words."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunewright.llm.common import prepare, serve

UNKNOWN = "und"
#: At most about so many texts of each language fit the model (chosen by hash, all rows alike).
FIT_ROWS = 1_000
#: Log-likelihood that a change of language must gain.
SWITCH = 12.0
#: Share of letters in the predicted language from which a text is kept.
KEEP_SCORE = 0.35
BITS = 17
SIZE = 1 << BITS
CACHED_WORDS = 300_000
#: First code point of each range and its script; code points before a range's successor belong to it.
SCRIPT_STARTS = [
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"),
    (0x0600, "arabic"), (0x0900, "devanagari"), (0x0980, "bengali"), (0x0A00, "indic"), (0x0E00, "thai"),
    (0x0E80, "lao"), (0x0F00, "tibetan"), (0x1000, "myanmar"), (0x10A0, "georgian"), (0x1100, "hangul"),
    (0x1200, "ethiopic"), (0x1380, "other"), (0x1780, "khmer"), (0x1800, "other"), (0x1E00, "latin"),
    (0x1F00, "greek"), (0x2000, "other"), (0x2C60, "latin"), (0x2C80, "other"), (0x3040, "kana"),
    (0x3100, "other"), (0x3400, "han"), (0xA000, "other"), (0xAC00, "hangul"), (0xD7B0, "other"),
    (0xF900, "han"), (0xFB00, "latin"), (0xFB1D, "hebrew"), (0xFB50, "arabic"), (0xFF00, "other"),
    (0x20000, "han"),
]
_STARTS = np.array([start for start, _ in SCRIPT_STARTS])
SCRIPTS = sorted({name for _, name in SCRIPT_STARTS})
_SCRIPT_OF = np.array([SCRIPTS.index(name) for _, name in SCRIPT_STARTS])


def grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed letter n-grams (n = 1 to 4, with word ends) of words, and the word each belongs to."""
    points = np.frombuffer((" " + " ".join(words) + " ").encode("utf-32-le"), np.uint32).astype(np.uint64)
    gap = points == 32
    word = np.cumsum(gap) - 1
    mixed, owners = [], []
    key = np.zeros(len(points), np.uint64)
    crossed = np.zeros(len(points), bool)
    for n in range(1, 5):
        size = len(points) - n + 1
        if size <= 0:
            break
        # an n-gram may start or end with a gap, and has none inside
        key = key[:size] * np.uint64(1_099_511_628_211) + points[n - 1 :] + np.uint64(n)
        crossed = crossed[:size] | (gap[n - 2 : n - 2 + size] if n > 2 else False)
        use = ~crossed & (~gap[:size] if n == 1 else ~(gap[:size] & gap[n - 1 :]))
        mixed.append(key[use])
        owners.append(word[:size][use])
    keys = np.concatenate(mixed)
    keys ^= keys >> np.uint64(31)
    keys *= np.uint64(0x9E3779B97F4A7C15)
    return (keys >> np.uint64(64 - BITS)).astype(np.int64), np.concatenate(owners)


def scripts(words: list[str]) -> np.ndarray:
    """The script of the first letter of each word without other marks."""
    first = np.fromiter((ord(w[0]) for w in words), np.int64, len(words))
    return _SCRIPT_OF[np.searchsorted(_STARTS, first, side="right") - 1]


def bare(word: str) -> str:
    """The letters of a word in lower case; numerals such as a half or a Roman six are none."""
    return (word if word.isalpha() else "".join(filter(str.isalpha, word))).lower()


@dataclass
class Model:
    """log_probs: (SIZE, languages); allowed: (scripts, languages)."""

    langs: list[str]
    log_probs: np.ndarray
    allowed: np.ndarray
    switch: float = SWITCH
    index: dict = field(default_factory=dict, repr=False)
    rows: int = 0
    scores: np.ndarray | None = None
    letters: np.ndarray | None = None

    def _learn(self, words: set[str]) -> None:
        """Scores of words not met before; row 0 is for words without letters."""
        if self.scores is None or len(self.index) > CACHED_WORDS:
            self.index.clear()
            self.rows, self.scores, self.letters = 1, np.zeros((1024, len(self.langs)), np.float32), np.zeros(1024, np.int64)
        new = [w for w in words if w not in self.index]
        bares = [bare(w) for w in new]
        real = [i for i, b in enumerate(bares) if b]
        for i, b in enumerate(bares):
            if not b:
                self.index[new[i]] = 0
        if not real:
            return
        while self.rows + len(real) > len(self.scores):
            self.scores = np.concatenate([self.scores, np.zeros_like(self.scores)])
            self.letters = np.concatenate([self.letters, np.zeros_like(self.letters)])
        clean = [bares[i] for i in real]
        key, owner = grams(clean)
        got = np.zeros((len(clean), len(self.langs)), np.float64)
        for k in range(len(self.langs)):
            got[:, k] = np.bincount(owner, self.log_probs[key, k], len(clean))
        fits = self.allowed[scripts(clean)]
        fits[~fits.any(axis=1)] = True
        got -= got.max(axis=1, initial=-np.inf, where=fits, keepdims=True)
        got[~fits] = -1e3
        span = slice(self.rows, self.rows + len(clean))
        self.scores[span] = np.maximum(got, -1e3)
        self.letters[span] = np.fromiter(map(len, clean), np.int64, len(clean))
        for j, i in enumerate(real):
            self.index[new[i]] = self.rows + j
        self.rows += len(clean)

    def spans(self, texts: list[str | None]) -> list[list[tuple[int, int, str]]]:
        """Per text, spans (first word, words, language) that cover all its words."""
        out = []
        for path, _ in self._paths(texts):
            cuts = np.flatnonzero(np.diff(path)) + 1
            edges = [0, *cuts.tolist(), len(path)]
            out.append([(a, b - a, self.langs[path[a]]) for a, b in zip(edges, edges[1:]) if b > a])
        return out

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """Per text, the language of most letters and its share of the letters."""
        out = []
        for path, letters in self._paths(texts):
            share = np.bincount(path, letters, len(self.langs)) if len(path) else np.zeros(len(self.langs))
            total = share.sum()
            best = int(share.argmax()) if len(share) else 0
            out.append((self.langs[best], float(share[best] / total)) if total > 0 else (UNKNOWN, 0.0))
        return out

    def _paths(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
        """The best language of each word, and the letters of each word."""
        docs = [(t or "").split() for t in texts]
        if not self.langs:
            return [(np.zeros(0, np.int64), np.zeros(0)) for _ in docs]
        paths: list = [None] * len(docs)
        at = 0
        while at < len(docs):  # so many texts at once that the table of words holds them all
            words: set[str] = set()
            start = at
            while at < len(docs) and (at == start or len(words) < 50_000):
                words.update(docs[at])
                at += 1
            if len(self.index) + len(words) > CACHED_WORDS + 50_000:
                self.index.clear()
                self.scores = None
            self._learn(words)
            hard = []
            for i in range(start, at):
                ids = np.fromiter(map(self.index.__getitem__, docs[i]), np.int64, len(docs[i]))
                given = self.scores[ids]
                letters = self.letters[ids]
                steady = _steady(given, self.switch)
                paths[i] = (np.full(len(ids), steady, np.int64), letters)
                if steady < 0:
                    hard.append((i, given))
            for i, path in _viterbi(hard, self.switch):
                paths[i] = (path, paths[i][1])
        return paths


def _steady(given: np.ndarray, switch: float) -> int:
    """The one language of the best path where no change can pay, else -1.

    Leaving language k for some words gains at most the largest sum of a run of max(other) - k and
    costs at least one change; if no run gains that much, staying is best.
    """
    if not len(given):
        return 0
    best = int(given.sum(axis=0, dtype=np.float64).argmax())
    if given.shape[1] == 1:
        return best
    others = np.delete(given, best, axis=1).max(axis=1)
    gain = np.concatenate([[0.0], np.cumsum(others - given[:, best], dtype=np.float64)])
    return best if (gain - np.minimum.accumulate(gain)).max() <= switch else -1


def _viterbi(docs: list[tuple[int, np.ndarray]], switch: float):
    """Best paths, many texts at a time: step t takes word t of all texts that are that long."""
    docs = sorted(docs, key=lambda d: -len(d[1]))
    at = 0
    while at < len(docs):
        longest = len(docs[at][1])
        some = docs[at : at + max(1, 4_000_000 // (longest * docs[at][1].shape[1]))]
        at += len(some)
        lengths = np.array([len(s) for _, s in some])
        states = some[0][1].shape[1]
        grid = np.zeros((longest, len(some), states), np.float32)
        for j, (_, s) in enumerate(some):
            grid[: len(s), j] = s
        back = np.zeros((longest, len(some), states), np.int16)
        stay = np.arange(states, dtype=np.int16)
        now = grid[0].astype(np.float64)
        final = now.copy()
        final[lengths > 1] = 0
        for t in range(1, longest):
            live = int(np.searchsorted(-lengths, -t, side="left"))  # texts with more than t words come first
            top = now[:live].argmax(axis=1)
            moved = now[np.arange(live), top] - switch
            change = moved[:, None] > now[:live]
            back[t, :live] = np.where(change, top[:, None], stay)
            now[:live] = np.where(change, moved[:, None], now[:live]) + grid[t, :live]
            done = lengths[:live] == t + 1
            final[:live][done] = now[:live][done]
        for j, (i, s) in enumerate(some):
            path = np.zeros(len(s), np.int64)
            state = int(final[j].argmax())
            for t in range(len(s) - 1, -1, -1):
                path[t] = state
                state = int(back[t, j, state])
            yield i, path


def fit(counts: dict[str, np.ndarray], used: dict[str, np.ndarray], switch: float = SWITCH) -> Model:
    """counts: n-gram counts of each language; used: letters of each script in each language."""
    langs = sorted(counts)
    if not langs:
        return Model([], np.zeros((SIZE, 0)), np.zeros((len(SCRIPTS), 0), bool), switch)
    table = np.stack([counts[k] + 0.2 for k in langs], axis=1).astype(np.float64)
    share = np.stack([used[k] / max(1, used[k].sum()) for k in langs], axis=1)
    return Model(langs, np.log(table / table.sum(axis=0)).astype(np.float32), share >= 0.01, switch)


def _count(batches):
    """Per language, n-gram counts (keys from 0) and words by script (keys below 0) of some texts."""
    serve("language")
    sums: dict[str, np.ndarray] = {}
    for batch in batches:
        for lang, text in zip(batch["_lang"], batch["_text"]):
            words = [b for b in map(bare, text.split()) if b]
            row = sums.setdefault(lang, np.zeros(SIZE + len(SCRIPTS), np.int64))
            if words:
                row[:SIZE] += np.bincount(grams(words)[0], minlength=SIZE)
                row[SIZE:] += np.bincount(scripts(words), minlength=len(SCRIPTS))
    for lang, row in sums.items():
        at = np.flatnonzero(row)
        yield pd.DataFrame({"lang": lang, "slot": at, "n": row[at]})


def train(documents: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", fit_rows: int = FIT_ROWS) -> Model:
    """Fit on rows with a language whose crc32(key) mod 5 is not 0, at most about `fit_rows` of each language.

    More rows than that are thinned by a hash of the key. Texts of the sample are read whole; null
    keys, languages and texts are left out. The counts come to the driver as one bounded vector of
    2^17 slots a language. A language must be a value of the column; there are few of them.
    """
    prepare(documents.sparkSession)
    learn = documents.select(
        F.col(key).alias("_key"), F.col(lang).alias("_lang"), F.col(text).alias("_text")
    ).where("_lang IS NOT NULL AND _key IS NOT NULL AND crc32(CAST(_key AS STRING)) % 5 <> 0")
    sizes = {r["_lang"]: r["n"] for r in learn.groupBy("_lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return fit({}, {})
    limits = F.create_map(
        *[F.lit(x) for k, n in sizes.items() for x in (k, int(min(1.0, fit_rows / n) * 1_000_000))]
    )
    sample = learn.where(F.pmod(F.xxhash64("_key", F.lit(13)), F.lit(1_000_000)) < limits[F.col("_lang")])
    found = (
        sample.where("_text IS NOT NULL")
        .select("_lang", "_text")
        .mapInPandas(_count, "lang string, slot long, n long")
        .groupBy("lang", "slot")
        .agg(F.sum("n").alias("n"))
        .toPandas()
    )
    rows = {k: np.zeros(SIZE + len(SCRIPTS)) for k in sizes}
    for k, part in found.groupby("lang"):
        rows[k][part["slot"].to_numpy()] = part["n"].to_numpy()
    return fit({k: v[:SIZE] for k, v in rows.items()}, {k: v[SIZE:] for k, v in rows.items()})


def language_column(model: Model, text: str = "text"):
    """struct(lang, score) of each whole text."""
    parts = (model.langs, model.log_probs, model.allowed, model.switch)

    @F.pandas_udf("lang string, score double")
    def label(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        serve("language")
        use = Model(*parts)
        for texts in batches:
            yield pd.DataFrame(use.predict(texts.tolist()), columns=["lang", "score"])

    return label(F.col(text))


def label_spans(documents: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, spans): spans of words (start, n_words, lang) of every whole text, in order; none without words."""
    prepare(documents.sparkSession)
    parts = (model.langs, model.log_probs, model.allowed, model.switch)

    @F.pandas_udf("array<struct<start:int,n_words:int,lang:string>>")
    def spans(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        serve("language")
        use = Model(*parts)
        for texts in batches:
            yield pd.Series(
                [[{"start": a, "n_words": n, "lang": k} for a, n, k in row] for row in use.spans(texts.tolist())]
            )

    return documents.select(F.col(key), spans(F.col(text)).alias("spans"))


def identify(documents: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row.

    `und` with score 0 where the text is null or has no letter, or where nothing was learnt. Words of
    a script that no learnt language uses count for all languages alike. Repeated rows give repeated
    rows; a null key is not held out; extra columns are not read.
    """
    prepare(documents.sparkSession)
    labelled = documents.select(F.col(key), language_column(model, text).alias("_found"))
    return labelled.select(
        key,
        F.coalesce(F.crc32(F.col(key).cast("string")) % 5 == 0, F.lit(False)).alias("held_out"),
        F.col("_found.lang").alias("lang_pred"),
        F.col("_found.score").alias("score"),
    )


def keep_identified(documents: DataFrame, model: Model, text: str = "text", keep_score: float = KEEP_SCORE) -> DataFrame:
    """The rows of which one language holds at least `keep_score` of the letters, all their columns."""
    prepare(documents.sparkSession)
    found = language_column(model, text)
    return documents.where(found["lang"] != UNKNOWN).where(found["score"] >= keep_score)
