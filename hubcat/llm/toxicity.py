"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams."""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from hubcat.llm.memo import memo
from hubcat.session import stored

#: Coordinates of the model, a power of two.
COORDINATES = 1 << 20
#: Most labelled rows that the fit sees, those with the smallest hash of their id.
TRAINING_ROWS = 24_000
#: Parts that are fitted side by side; their models are averaged after each pass.
PARTS = 6
PASSES = 4
#: Coordinates whose average one task takes.
SLICE = 1 << 16
#: Letters of a word's stems: inflected and compound words share them.
STEMS = (4, 6)
#: FTRL-proximal: the rate of a coordinate is ALPHA / (BETA + root of its squared gradients).
ALPHA, BETA, L1, L2 = 2.0, 1.0, 2.0, 0.0
#: Scores from here on count as toxic.
THRESHOLD = 0.7

_WORD = re.compile(r"\w+")


class Model(NamedTuple):
    """The coordinates that are not zero, ascending, their weights, and the bias."""

    coordinates: np.ndarray
    weights: np.ndarray
    bias: float

    def score(self, features: np.ndarray) -> float:
        """Probability of label 1 for a text's coordinates; each counts once."""
        if not len(self.coordinates):
            return _sigmoid(self.bias)
        at = np.searchsorted(self.coordinates, features)
        at[at == len(self.coordinates)] = 0
        held = np.unique(at[self.coordinates[at] == features])
        return _sigmoid(self.bias + float(self.weights[held].sum()))


def _sigmoid(x: float) -> float:
    return float(1 / (1 + np.exp(-np.clip(x, -35, 35))))


# Features

def _word_hashes(part: str) -> bytes:
    """For each word of a blank-delimited part 8 bytes of its hash, then 8 of each stem's."""
    return b"".join(xxhash.xxh64_digest(w) + b"".join(xxhash.xxh64_digest(w[:n], seed=n) for n in STEMS)
                    for w in _WORD.findall(part.lower()))


def _mixed(*hashes: np.ndarray, kind: int) -> np.ndarray:
    h = np.full(len(hashes[0]), kind * 0x9E3779B97F4A7C15 & (1 << 64) - 1, "u8")
    for one in hashes:
        h = (h ^ one) * np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
    return (h % np.uint64(COORDINATES)).astype("i4")


def _features(hashes: bytes) -> np.ndarray:
    """Coordinates of words, stems, word pairs, and pairs that skip one or two words."""
    word, *stems = np.frombuffer(hashes, ">u8").astype("u8").reshape(-1, 1 + len(STEMS)).T
    kinds = [_mixed(word, kind=0), *[_mixed(stem, kind=n) for n, stem in zip(STEMS, stems)]]
    kinds += [_mixed(word[:-gap], word[gap:], kind=100 + gap) for gap in (1, 2, 3) if len(word) > gap]
    return np.concatenate(kinds)


def features_of(texts: list[str]) -> Iterator[np.ndarray]:
    hashes = memo("toxicity words", lambda: _word_hashes)
    for text in texts:
        yield _features(b"".join(map(hashes.__getitem__, text.replace("\n", " ").split(" "))))


# Fitting

class Ftrl:
    """The sums z and n of every coordinate; that at COORDINATES is the bias, which L1 leaves alone."""

    def __init__(self, z: np.ndarray, n: np.ndarray):
        self.z, self.n = z, n

    def weights(self, at: np.ndarray) -> np.ndarray:
        z = self.z[at]
        l1 = np.where(at == COORDINATES, 0.0, L1)
        return -np.sign(z) * np.maximum(np.abs(z) - l1, 0) / ((BETA + np.sqrt(self.n[at])) / ALPHA + L2)

    def learn(self, at: np.ndarray, label: int) -> None:
        """One step; ``at`` holds distinct coordinates and the bias."""
        w = self.weights(at)
        error = _sigmoid(w.sum()) - label
        n = self.n[at]
        self.z[at] += error - (np.sqrt(n + error * error) - np.sqrt(n)) / ALPHA * w
        self.n[at] = n + error * error


def held_out(doc_id: Column) -> Column:
    """The fold whose labels are never learnt: crc32 of the id as text has remainder 1 by 3."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, text: str, doc_id: str, label: str, bound: int = TRAINING_ROWS) -> DataFrame:
    """part, order, label and text of at most ``bound`` labelled rows outside the held-out fold.

    The chosen labels are bounded in number, so they are broadcast to the texts. A document
    that is labelled twice takes its larger label; null labels are passed over.
    """
    one = labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull() & ~held_out(F.col(doc_id))).groupBy(F.col(doc_id).alias("id")).agg(F.max(label).alias("label"))
    drawn = one.select("id", "label", F.xxhash64("id").alias("order")).orderBy("order", "id").limit(bound)
    return docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").alias("text")).join(F.broadcast(drawn), "id").select(
        F.pmod("order", F.lit(PARTS)).cast("int").alias("part"), "order", "label", "text")


def fit(rows: DataFrame) -> Model:
    """Parallel FTRL-proximal over ``training_rows``: parts learn side by side, then their states are averaged.

    Every pass starts all parts from the average, and finds the features anew: texts are smaller. What comes to the driver is the
    average, bounded by the number of coordinates. Rows of a part are learnt in the order of a hash, so the
    model doesn't depend on how they were stored. No rows, or one label only: a model that
    gives the bias alone.
    """
    spark = rows.sparkSession
    rows = stored(rows, "training")
    z = n = np.zeros(COORDINATES + SLICE, "f4")
    for _ in range(PASSES):
        shared = spark.sparkContext.broadcast((z, n))

        def learn(batches: pd.DataFrame) -> pd.DataFrame:
            model = Ftrl(*(x.astype("f8") for x in shared.value))
            batches = batches.sort_values("order")
            texts = ["" if t is None else t for t in batches["text"]]
            for found, label in zip(features_of(texts), batches["label"]):
                model.learn(np.append(np.unique(found), np.int32(COORDINATES)), int(label))
            at = range(0, len(model.z), SLICE)
            return pd.DataFrame({"slice": [i // SLICE for i in at], "rows": len(batches), "z": [model.z[i:i + SLICE].astype("<f4").tobytes() for i in at],
                                 "n": [model.n[i:i + SLICE].astype("<f4").tobytes() for i in at]})

        def average(parts: pd.DataFrame) -> pd.DataFrame:
            parts = parts.sort_values("z")
            mean = {c: np.average([np.frombuffer(x, "<f4") for x in parts[c]], axis=0, weights=parts["rows"]).astype("<f4").tobytes() for c in ("z", "n")}
            return pd.DataFrame({"slice": parts["slice"][:1], **{c: [x] for c, x in mean.items()}})

        learnt = rows.groupBy("part").applyInPandas(learn, "slice int, rows long, z binary, n binary")
        slices = sorted(learnt.groupBy("slice").applyInPandas(average, "slice int, z binary, n binary").collect())
        if slices:
            z, n = (np.frombuffer(b"".join(r[c] for r in slices), "<f4") for c in ("z", "n"))
        shared.destroy()
    model = Ftrl(z.astype("f8"), n.astype("f8"))
    every = np.arange(COORDINATES + 1)
    weights = model.weights(every)
    held = np.flatnonzero(weights[:-1])
    return Model(held.astype("i4"), weights[held], float(weights[-1]))


# Scoring

def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """All columns of ``docs`` as the struct ``row``, and ``score``: 0 to 1, higher for likelier toxic.

    Whole texts are scored; null counts as empty, whose score is the bias's. The model holds
    at most COORDINATES weights, so it is broadcast.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        found = features_of(["" if t is None else t for t in texts])
        return pd.Series([shared.value.score(f) for f in found], dtype="float64")

    return docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), scored(F.col(f"`{text}`")).alias("score"))


def score_toxicity(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", label: str = "toxic") -> DataFrame:
    """Fit on the labels outside the held-out fold, then score every document."""
    return score(docs, fit(training_rows(docs, labels, text, doc_id, label)), text)
