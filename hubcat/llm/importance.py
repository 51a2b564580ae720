"""Target-distribution importance resampling: hashed n-grams of pre-tokenised words, weighed against a target's."""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from hubcat.llm.memo import whole_texts
from hubcat.operators.ordering import dense_index
from hubcat.session import stored

#: What a word is: no ASCII character but digits and small letters, after A to Z were lower-cased.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Buckets of the hashed features, at most 65,536 (a bucket is kept in two bytes).
BUCKETS = 10_000
#: Words of the longest feature.
LONGEST_RUN = 2
#: Fewer words than this: a document is scored, but not drawn.
LEAST_WORDS = 20
#: Percent of the documents with words enough that are drawn, and the seed of the draw.
SHARE, SEED = 25, 7


# Features

@lru_cache(maxsize=1)
def _splitter():
    """An untrained pre-tokeniser: a Regex Split that keeps what matches."""
    from tokenizers import Regex, pre_tokenizers

    return pre_tokenizers.Split(Regex(WORD), behavior="removed", invert=True)


def words_with_offsets(text: str) -> list[tuple[str, tuple[int, int]]]:
    """Words of a text, A to Z lower-cased, each with its start and end in the text."""
    return _splitter().pre_tokenize_str(text.encode().lower().decode())


def buckets_of(text: str, buckets: int = BUCKETS, longest: int = LONGEST_RUN) -> tuple[int, np.ndarray]:
    """Number of words, and the buckets of all runs of 1 to ``longest`` words, repeats included.

    Runs are windows between a word's start and a later word's end, in the words joined by one
    blank; a window's bytes are hashed as they stand there.
    """
    found = words_with_offsets(text)
    if not found:
        return 0, np.zeros(0, "<u2")
    words = [w.encode() for w, _ in found]
    joined = memoryview(b" ".join(words))
    ends = np.cumsum(np.fromiter(map(len, words), "i8", len(words)) + 1) - 1
    starts = np.r_[0, ends[:-1] + 1].tolist()
    ends, crc = ends.tolist(), zlib.crc32
    hashes = [crc(w) for w in words]
    for run in range(2, min(longest, len(words)) + 1):
        hashes += [crc(joined[a:b]) for a, b in zip(starts, ends[run - 1:])]
    return len(words), (np.fromiter(hashes, "u4", len(hashes)) % np.uint32(buckets)).astype("<u2")


def bucketed(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", buckets: int = BUCKETS, longest: int = LONGEST_RUN) -> DataFrame:
    """doc_id, n_words, and ``buckets``: two little-endian bytes for each feature. Null counts as empty."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [buckets_of(t, buckets, longest) for t in whole_texts(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([n for n, _ in made], pa.int64()), pa.array([b.tobytes() for _, b in made], pa.binary())],
                                             names=["doc_id", "n_words", "buckets"])
    return docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text")).mapInArrow(
        run, f"doc_id {dict(docs.dtypes)[doc_id]}, n_words long, buckets binary")


def histogram(rows: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Features by bucket of all rows of ``bucketed``: a task adds up its own, and a row per bucket comes to the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, "i8")
        for batch in batches:
            for held in batch.column(0):
                counts += np.bincount(np.frombuffer(held.as_buffer(), "<u2"), minlength=buckets)
        held = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), pa.array(counts[held], pa.int64())], names=["bucket", "n"])

    total = np.zeros(buckets, "i8")
    for row in rows.select("buckets").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        total[row["bucket"]] = row["n"]
    return total


# Weights and the draw

def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of a bucket's shares in target and source, each bucket with one feature more; floored."""
    size, all_s, all_t = len(source), float(source.sum()), float(target.sum())
    return np.asarray([math.floor(1000 * math.log((t + 1.0) * (all_s + size) / ((s + 1.0) * (all_t + size))))
                       for s, t in zip(source.tolist(), target.tolist())], "i8")


def noise(doc_id: object, seed: int = SEED) -> int:
    """A document's Gumbel draw in thousandths, floored: a function of its id alone."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def weighed(rows: DataFrame, gain: np.ndarray, seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight (floored mean of the features' gains) and score of the rows of ``bucketed``.

    The gains are a number per bucket, so they are broadcast.
    """
    shared = rows.sparkSession.sparkContext.broadcast(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = [np.frombuffer(b.as_buffer(), "<u2") for b in batch.column(2)]
            weight = [int(shared.value[b].sum()) // len(b) if len(b) else 0 for b in held]
            score = [w + noise(i, seed) for w, i in zip(weight, batch.column(0).to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *(pa.array(c, pa.int64()) for c in (map(len, held), weight, score))],
                                             names=["doc_id", "n_words", "n_features", "weight", "score"])
    return rows.select("doc_id", "n_words", "buckets").mapInArrow(
        run, f"doc_id {dict(rows.dtypes)['doc_id']}, n_words long, n_features long, weight long, score long")


def resample(docs: DataFrame, target: DataFrame, text: str = "text", doc_id: str = "doc_id", target_text: str = "text",
             share: int = SHARE, least_words: int = LEAST_WORDS, seed: int = SEED, buckets: int = BUCKETS, longest: int = LONGEST_RUN) -> DataFrame:
    """One row per document: doc_id, n_features, weight, score, rank (from 1 for the drawn, else null).

    Texts are pre-tokenised once; the buckets of their features rest in a written table, which
    the histogram and the weights are taken from. ``share`` percent (floored) of the documents with
    at least ``least_words`` words are drawn, the highest scores first, ties to the smaller id; a
    row without an id comes last among them. Scores are ranked by a global sort of narrow rows, in
    which equal ids can part. Rows that repeat an id come back each; they share the noise, not the weight. Null and
    empty texts have no features and weight 0. Other columns play no part, whatever their names.
    An empty target or an empty table does no harm.
    """
    source = stored(bucketed(docs, text, doc_id, buckets, longest), "features")
    wanted = histogram(bucketed(target.select(F.col(f"`{target_text}`").alias("text"), F.lit(0).alias("id")), "text", "id", buckets, longest), buckets)
    scored = stored(weighed(source, gains(histogram(source, buckets), wanted), seed), "scores")
    enough = F.col("n_words") >= least_words
    able = scored.where(enough)
    drawn = share * able.count() // 100
    ranked = dense_index(able, [F.desc("score"), F.asc_nulls_last("doc_id"), F.desc("weight"), F.desc("n_features")], "place")
    columns = ["doc_id", "n_features", "weight", "score"]
    return ranked.select(*columns, F.when(F.col("place") < drawn, F.col("place") + 1).alias("rank")).union(
        scored.where(~enough).select(*columns, F.lit(None).cast("long").alias("rank")))
