"""Token counts: huge documents in overlapping chunks, spliced where both tokenisations provably agree."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from hubcat.llm.memo import Memo, memo, tokenizer, whole_texts
from hubcat.session import stored

#: Characters of a chunk, and of the overlap with the next one.
CHUNK, OVERLAP = 65_536, 512
#: By how much both grow when a pair of chunks has no common boundary.
WIDER = 8
#: A boundary this near to a chunk's end may depend on what follows: contractions, runs, special strings.
UNSURE = 32

# A blank between two other characters always starts a pre-token, and nothing before it matters to what follows.
UNEVEN = re.compile(r" (?!\S)|(?<!\S) ")
_SAFE = re.compile(r"(?<=\S)(?= \S)")


def _unit_counts(path: str) -> Memo:
    encode = tokenizer(path).encode
    return memo(f"unit counts {path}", lambda: lambda unit: len(encode(unit, add_special_tokens=False)))


def units(text: str) -> list[str]:
    """Parts of a text whose tokens together are the text's."""
    if UNEVEN.search(text):
        return _SAFE.split(text)
    first, *rest = text.split(" ")
    return [first, *[" " + part for part in rest]]


def _counted(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counted = _unit_counts(path)
        for batch in batches:
            counts = [sum(map(counted.__getitem__, units(text))) for text in whole_texts(batch.column(2))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(counts, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])
    return run


def _chunks(chunk: int, overlap: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for key, text in zip(batch["key"], batch["text"]):
                starts = range(0, max(1, len(text) - overlap), chunk)
                for first in range(0, len(starts), 16):
                    some = starts[first:first + 16]
                    yield pd.DataFrame({"key": key, "chunk": [s // chunk for s in some], "start": list(some),
                                        "last": [s == starts[-1] for s in some],
                                        "text": [text[s:] if s == starts[-1] else text[s:s + chunk + overlap] for s in some]})
    return run


def _marked(path: str, chunk: int, overlap: int):
    """Tokens of each chunk, and the pre-token starts in its two overlaps with the tokens before them."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                found = tokenizer(path).encode(row.text, add_special_tokens=False)
                words = np.asarray([-1 - i if w is None else w for i, w in enumerate(found.word_ids)], "i8")
                at = np.flatnonzero(np.r_[True, words[1:] != words[:-1]]) if len(words) else np.zeros(0, "i8")
                offsets = found.offsets  # made anew at each access
                begin = np.asarray([offsets[i][0] for i in at], "i8")
                left = begin <= overlap
                right = (begin >= chunk) & (begin <= len(row.text) - UNSURE) & (not row.last)
                yield pd.DataFrame({"key": [row.key], "chunk": [row.chunk], "total": [len(words)],
                                    "left_at": [begin[left] + row.start], "left_before": [at[left]],
                                    "right_at": [begin[right] + row.start], "right_before": [at[right]]})
    return run


def _spliced(huge: DataFrame, path: str, chunk: int, overlap: int) -> DataFrame:
    """key, n_tokens; n_tokens is null when two neighbours have no common boundary."""
    spark = huge.sparkSession
    chunks = huge.select("key", "text").mapInPandas(_chunks(chunk, overlap), "key long, chunk int, start long, last boolean, text string")
    marked = chunks.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "key", "chunk").mapInPandas(
        _marked(path, chunk, overlap),
        "key long, chunk int, total long, left_at array<long>, left_before array<long>, right_at array<long>, right_before array<long>")
    order = Window.partitionBy("key").orderBy("chunk")
    cut = F.array_min(F.array_intersect("right_at", F.lead("left_at").over(order)))
    cuts = marked.select("*", cut.alias("cut"), (F.lead("chunk").over(order)).isNull().alias("last"))
    cuts = cuts.select("*", F.lag("cut").over(order).alias("from"))
    before = lambda at, n, cut: F.element_at(F.col(n), F.array_position(F.col(at), F.col(cut)).cast("int"))
    upto = F.when(F.col("last"), F.col("total")).when(F.col("cut").isNotNull(), before("right_at", "right_before", "cut"))
    since = F.when(F.col("chunk") == 0, F.lit(0)).when(F.col("from").isNotNull(), before("left_at", "left_before", "from"))
    parts = cuts.select("key", (upto - since).alias("n"))
    return parts.groupBy("key").agg(F.when(F.count("n") == F.count(F.lit(1)), F.sum("n")).alias("n_tokens"))


def count_tokens(docs: DataFrame, path: str, text: str = "text", doc_id: str = "doc_id", chunk: int = CHUNK,
                 overlap: int = OVERLAP) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens as the tokenizers library counts the whole text.

    A text of at most a chunk is counted by parts between blanks, each handed to the library once
    for each memo. A longer one is cut into overlapping chunks that may run on any executor. A cut is
    proven when a pre-token starts there in both chunks, far enough from the first one's end:
    scanning looks only ahead, so from there both tokenisations are those of the whole text.
    Where a pair has no such place, its document is cut anew with wider chunks and overlaps, at
    last as one. Null counts as empty (0 bytes, 0 tokens); rows that repeat an id come back each.
    """
    whole = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    whole = whole.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "text")
    long = F.length("text") > chunk
    result_type = f"doc_id {dict(whole.dtypes)['doc_id']}, n_bytes long, n_tokens long"
    counted = whole.where(~long).mapInArrow(_counted(path), result_type)
    pending = stored(whole.where(long).select(F.monotonically_increasing_id().alias("key"), "doc_id", "n_bytes", "text"), "huge")
    while not pending.isEmpty():
        spliced = stored(_spliced(pending, path, chunk, overlap), "spliced")
        done = pending.drop("text").join(spliced.where("n_tokens is not null"), "key")
        counted = counted.union(done.select("doc_id", "n_bytes", "n_tokens"))
        pending = pending.join(spliced.where("n_tokens is null").select("key"), "key")
        chunk, overlap = chunk * WIDER, overlap * WIDER * WIDER
        overlap = min(overlap, chunk)
    return counted
