"""Quality classifier: linear support vectors over n-grams scaled by Naive Bayes log-count ratios."""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunewright.llm.common import Memo, kept, prepare, serve

BITS = 18
SIZE = 1 << BITS
#: At most about so many labelled rows fit the classifier (chosen by hash, all labelled rows alike).
FIT_ROWS = 6_000
#: Score from which a text counts as good.
THRESHOLD = 0.3
REPEAT = 1
_LETTERS = re.compile(r"[^\W\d_]+")
_DIGITS = re.compile(r"\d+")


def _shape(word: str) -> str:
    """Runs of letters become A (upper), Aa (capitalised) or a; runs of digits 0; the rest stays."""

    def case(match):
        run = match.group()
        return "A" if run.isupper() and len(run) > 1 else "Aa" if run[0].isupper() else "a"

    return _DIGITS.sub("0", _LETTERS.sub(case, word))[:24]


def _ids(word: str) -> int:
    shape = zlib.crc32(_shape(word).encode()) % (1 << 20)
    return zlib.crc32(word.lower().encode()) << 20 | max(shape, REPEAT + 1)


WORDS = kept(Memo(_ids))


def features(text: str | None) -> np.ndarray:
    """Hashed n-grams that occur in the whole text: words (n = 1, 2) and word shapes (n = 1 to 3).

    In the shapes a word equal to the one before it is a token of its own, so that repetition
    shows whatever the word. Null and empty texts have one feature, the empty n-gram.
    """
    words = (text or "").split()
    if not words:
        return np.zeros(1, np.int64)
    both = np.fromiter(map(WORDS.__getitem__, words), np.int64, len(words))
    word, shape = both >> 20, both & 0xFFFFF
    shape[1:][both[1:] == both[:-1]] = REPEAT
    pair = shape[:-1] * 1_000_003 + shape[1:]
    grams = np.concatenate(
        [
            word * 31 + 1,
            (word[:-1] * 2_654_435 + word[1:]) * 31 + 2,
            shape * 31 + 3,
            pair * 31 + 4,
            (pair[:-1] * 999_983 + shape[2:]) * 31 + 5,
        ]
    ).astype(np.uint64)
    grams ^= grams >> np.uint64(29)
    grams *= np.uint64(0x9E3779B97F4A7C15)
    return np.unique((grams >> np.uint64(64 - BITS)).astype(np.int64))


@dataclass
class Model:
    weights: np.ndarray
    slope: float
    offset: float

    def margin(self, feats: np.ndarray) -> float:
        return float(self.weights[feats].sum() / np.sqrt(len(feats)))

    def score(self, text: str | None) -> float:
        value = self.slope * self.margin(features(text)) + self.offset
        return float(1 / (1 + np.exp(-np.clip(value, -30, 30))))


def log_count_ratios(rows: list[np.ndarray], labels: np.ndarray, alpha: float = 1.0) -> np.ndarray:
    good, bad = np.full(SIZE, alpha), np.full(SIZE, alpha)
    for feats, label in zip(rows, labels):
        (good if label == 1 else bad)[feats] += 1
    return np.log(good / good.sum()) - np.log(bad / bad.sum())


def dual_coordinate_descent(
    rows: list[np.ndarray], ratios: np.ndarray, labels: np.ndarray, cost: float = 0.1, rounds: int = 8, seed: int = 7
) -> np.ndarray:
    """Hinge-loss weights: one dual variable a row, boxed in [0, cost of its class], updated in turn.

    A row has the value ratio / sqrt(length) in each of its features; values are made when they are needed.
    """
    weights = np.zeros(SIZE)
    signs = np.where(labels == 1, 1.0, -1.0)
    share = max(np.mean(signs > 0), 1e-9)
    costs = np.where(signs > 0, cost * 0.5 / share, cost * 0.5 / max(1 - share, 1e-9))
    alphas = np.zeros(len(rows))
    draw = np.random.default_rng(seed)
    for _ in range(rounds):
        for i in draw.permutation(len(rows)):
            values = ratios[rows[i]] / np.sqrt(len(rows[i]))
            slack = signs[i] * (weights[rows[i]] @ values) - 1
            new = min(max(alphas[i] - slack / max(float(values @ values), 1e-12), 0.0), costs[i])
            if new != alphas[i]:
                weights[rows[i]] += (new - alphas[i]) * signs[i] * values
                alphas[i] = new
    return weights


def _calibrate(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve, by a few damped Newton steps; classes count as they occur."""
    a, b = 1.0, 0.0
    goal = np.where(labels == 1, 1 - 1 / (sum(labels == 1) + 2), 1 / (sum(labels != 1) + 2))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margins + b, -30, 30)))
        w = p * (1 - p) + 1e-6
        grad = np.array([((p - goal) * margins).sum() + 1e-3 * a, (p - goal).sum()])
        hess = np.array([[(w * margins**2).sum() + 1e-3, (w * margins).sum()], [(w * margins).sum(), w.sum()]])
        step = np.linalg.solve(hess + 1e-6 * np.eye(2), grad)
        a, b = a - np.clip(step[0], -2, 2), b - np.clip(step[1], -2, 2)
    return float(a), float(b)


def fit(rows: list[np.ndarray], labels: list[int]) -> Model:
    """The classifier of the features of some labelled texts; with one class only, a constant score."""
    labels = np.asarray(labels)
    if len(set(labels.tolist())) < 2:
        return Model(np.zeros(SIZE), 0.0, 4.0 if len(labels) == 0 or labels[0] == 1 else -4.0)
    fold = np.arange(len(rows)) % 5 == 4
    if len(set(labels[fold].tolist())) < 2:
        fold[:] = False
    inner = [i for i in range(len(rows)) if not fold[i]]
    kept = [rows[i] for i in inner]
    ratios = log_count_ratios(kept, labels[inner])
    weights = dual_coordinate_descent(kept, ratios, labels[inner]) * ratios
    model = Model(weights, 1.0, 0.0)
    held = np.flatnonzero(fold) if fold.any() else np.arange(len(rows))
    model.slope, model.offset = _calibrate(np.array([model.margin(rows[i]) for i in held]), labels[held])
    return model


def train(
    documents: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", fit_rows: int = FIT_ROWS
) -> Model:
    """Fit on labelled rows whose crc32(key) mod 5 is not 0, at most about `fit_rows` of them.

    More labelled rows than that are thinned by a hash of the key. The sample is joined as the small
    side (its size has that bound), its texts are read whole by the executors; the driver gets the
    features of each, 2^18 numbers of 32 bits at most. Null labels and null keys are left out; repeated
    labels count as often as they occur.
    """
    learn = labels.where(
        f"{label} IS NOT NULL AND {key} IS NOT NULL AND crc32(CAST({key} AS STRING)) % 5 <> 0"
    ).select(F.col(key).alias("_key"), F.col(label).cast("int").alias("_label"))
    share = min(1.0, fit_rows / max(1, learn.count()))
    sample = learn.where(F.pmod(F.xxhash64("_key", F.lit(11)), F.lit(1_000_000)) < int(share * 1_000_000))
    rows = documents.select(F.col(key).alias("_key"), F.col(text).alias("_text")).join(F.broadcast(sample), "_key")
    kind = rows.schema["_key"].dataType.simpleString()
    found = rows.select("_key", "_label", "_text").mapInArrow(_feature_rows, f"key {kind}, label int, found array<int>").toArrow()
    found = found.sort_by([("key", "ascending"), ("label", "ascending")]).combine_chunks()
    return fit([row.values.to_numpy() for row in found.column("found")], found.column("label").to_pylist())


def _feature_rows(batches):
    serve("quality")
    for batch in batches:
        found = [features(text).astype(np.int32) for text in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.int32()))], ["key", "label", "found"])


def score_column(model: Model, text: str = "text"):
    """A column with the score of each whole text."""
    weights, slope, offset = model.weights.astype(np.float32), model.slope, model.offset

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        serve("quality")
        use = Model(weights, slope, offset)
        return pd.Series([use.score(t) for t in texts], dtype="float64")

    return score(F.col(text))


def classify(documents: DataFrame, model: Model, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted of every row; null and empty texts are scored as empty ones.

    Repeated rows give repeated rows; a null key is held out of nothing (held_out false). Extra
    columns are not read.
    """
    prepare(documents.sparkSession)
    scored = documents.select(F.col(key), score_column(model, text).alias("score"))
    return scored.select(
        key,
        F.coalesce(F.crc32(F.col(key).cast("string")) % 5 == 0, F.lit(False)).alias("held_out"),
        "score",
        F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"),
    )


def keep_good(documents: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows whose text is not rejected, all their columns."""
    prepare(documents.sparkSession)
    return documents.where(score_column(model, text) >= threshold)
