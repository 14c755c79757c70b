"""Quality classifier: logistic regression on hashed word n-grams, trained with follow-the-regularised-leader updates."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import packed, stored, text_or_empty

BITS = 18
#: Labelled documents that training reads at most, and passes over them.
TRAINING_ROWS = 12_000
EPOCHS = 2
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.05
THRESHOLD = 0.3
FOLDS = 5
#: Characters of a text that are split into words at a time.
BLOCK = 1 << 20
#: Distances at which a word that comes again makes an n-gram of its own, whatever the word.
REPEAT_LAGS = (1, 2, 3, 4)
_WORDS = re.compile(r"\w+|[^\w\s]+")


def _shape(word: str) -> str:
    """A word as it is hashed: digits alike, capital words apart from others by a mark."""
    if word.isupper() and len(word) > 1:
        return "^" + word.lower()
    return "0" if word.isdigit() else word.lower()


class Features:
    """Hashed unigrams and bigrams of words and runs of signs, of their kinds, and of repeats; a vector of unit length."""

    def __init__(self) -> None:
        self.known: dict[str, int] = {}

    def _hash(self, word: str) -> int:
        found = self.known.get(word)
        if found is None:
            if len(self.known) > 200_000:
                self.known.clear()
            shape = _shape(word)
            kind = "^" if shape[0] == "^" else "w" if shape[0].isalpha() else shape
            found = self.known[word] = zlib.crc32(shape.encode()) | zlib.crc32(kind.encode(), 7) << 32
        return found

    def __call__(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        places, counts = np.zeros(0, np.int64), np.zeros(0)
        before = None
        for at in range(0, len(text), BLOCK):
            part = np.array([self._hash(w) for w in _WORDS.findall(text[at : at + BLOCK])], np.uint64)
            if not len(part):
                continue
            words, kinds = part & np.uint64(0xFFFFFFFF), part >> np.uint64(32)
            if before is not None:
                words, kinds = np.append(before[0], words), np.append(before[1], kinds)
            pairs = words[:-1] * np.uint64(0x9E3779B1) + words[1:]
            shapes = kinds[:-1] * np.uint64(0x85EBCA77) + kinds[1:] + np.uint64(1)
            first = 0 if before is None else 1
            again = [np.full(int((words[lag:] == words[:-lag]).sum()), lag, np.uint64) for lag in REPEAT_LAGS if lag < len(words)]
            mixed = np.concatenate([words[first:], pairs, shapes, kinds[first:], *again]) * np.uint64(0xFF51AFD7ED558CCD)
            hashed = (mixed >> np.uint64(64 - BITS)).astype(np.int64)
            places, back = np.unique(np.concatenate([places, hashed]), return_inverse=True)
            counts = np.bincount(back, np.concatenate([counts, np.ones(len(hashed))]), len(places))
            before = words[-1], kinds[-1]
        values = np.sqrt(counts)
        return places, values / (np.linalg.norm(values) or 1.0)


class Ftrl:
    """Follow-the-regularised-leader with per-coordinate rates; the last weight is the bias."""

    def __init__(self) -> None:
        self.z = np.zeros((1 << BITS) + 1)
        self.n = np.zeros((1 << BITS) + 1)

    def weights(self, places: np.ndarray) -> np.ndarray:
        z, n = self.z[places], self.n[places]
        l1 = np.where(places == 1 << BITS, 0.0, L1)
        return np.where(np.abs(z) <= l1, 0.0, (np.sign(z) * l1 - z) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    def learn(self, places: np.ndarray, values: np.ndarray, label: int, weight: float) -> None:
        places, values = np.append(places, 1 << BITS), np.append(values, 1.0)
        w = self.weights(places)
        gradient = weight * (_probability(float(w @ values)) - label) * values
        rate = (np.sqrt(self.n[places] + gradient**2) - np.sqrt(self.n[places])) / ALPHA
        self.z[places] += gradient - rate * w
        self.n[places] += gradient**2


def _probability(score: float) -> float:
    return 1 / (1 + np.exp(-np.clip(score, -35, 35)))


_FEATURES = Features()


def train(docs: DataFrame, labels: DataFrame, label: str, doc_id: str = "doc_id", text: str = "text", rows: int = TRAINING_ROWS) -> np.ndarray:
    """Weights learned from at most ``rows`` labelled documents, the first in the order of a hash of their id.

    Both classes weigh the same in total. Rows without a label or id are not used; a repeated label row counts as often
    as it comes. Without any rows all weights are zero. One task learns, as every update needs the one before; its
    input is bounded by ``rows``. What comes to the driver is one weight for each of ``2 ** BITS`` places.
    """
    chosen = (
        labels.filter(F.col(label).isNotNull() & F.col(doc_id).isNotNull())
        .select(F.col(doc_id).alias("doc_id"), (F.col(label) > 0).cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id", "label")
        .limit(rows)
    )
    chosen = stored(chosen, "chosen")
    n, good = chosen.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).head()
    weight = {1: n / (2 * max(good, 1)), 0: n / (2 * max(n - good, 1))}
    texts = docs.select(F.col(doc_id).alias("doc_id"), text_or_empty(text).alias("text")).join(F.broadcast(chosen), "doc_id")

    def learn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model, examples = Ftrl(), []
        for batch in batches:
            for content, kind in zip(batch["text"], batch["label"], strict=True):
                places, values = _FEATURES(content)
                examples.append((places.astype(np.int32), values.astype(np.float32), int(kind)))
                model.learn(places, values, int(kind), weight[int(kind)])
        for _ in range(EPOCHS - 1):
            for places, values, kind in examples:
                model.learn(places.astype(np.int64), values.astype(np.float64), kind, weight[kind])
        learned = model.weights(np.arange((1 << BITS) + 1))
        used = np.flatnonzero(learned)
        yield pd.DataFrame({"place": used, "weight": learned[used]})

    ordered = texts.repartition(1).sortWithinPartitions(F.xxhash64("doc_id"), "doc_id", "label", "text")
    learned = ordered.select("text", "label").mapInPandas(learn, "place long, weight double")
    weights = np.zeros((1 << BITS) + 1)
    for row in learned.collect():
        weights[row["place"]] = row["weight"]
    return weights


def score(docs: DataFrame, weights: np.ndarray, text: str = "text", into: str = "score") -> DataFrame:
    """Every row of ``docs``, all columns kept, with ``into``: the probability of label 1 from the whole text.

    The weights, of fixed number, are broadcast; a score is a sparse dot product. Null texts count as empty, and an
    empty text is scored by the bias alone.
    """
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def probability(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        learned = shared.value
        for batch in batches:
            yield pd.Series([_score(content, learned) for content in batch], dtype="float64")

    return docs.withColumn(into, F.pandas_udf(probability, "double")(text_or_empty(text)))


def _score(content: str, weights: np.ndarray) -> float:
    places, values = _FEATURES(content)
    return float(_probability(float(weights[places] @ values) + weights[-1]))


def held_out(doc_id: str = "doc_id") -> Column:
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS == 0


def keep_good(docs: DataFrame, labels: DataFrame, label: str = "quality", doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents scored at least ``THRESHOLD`` by a model of the labels outside the held-out fold, with all their columns.

    Null texts count as empty and get the score of a text without features. Every row is scored by itself, so repeated rows
    and rows with a null id are kept or go by their text alone. Columns of any name are kept; an empty table stays empty.
    """
    weights = train(docs, labels.filter(~held_out(doc_id)), label, doc_id)
    scored = score(packed(docs).select("row", F.col(f"row.`{text}`").alias("text")), weights)
    return scored.filter(F.col("score") >= THRESHOLD).select("row.*")
