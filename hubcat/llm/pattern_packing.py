"""Packing by patterns: few-document length patterns fitted to the length histogram, residuals by best fit."""

from __future__ import annotations

import string
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from hubcat.llm.memo import Memo, memo, tokenizer, whole_texts
from hubcat.session import stored

#: Tokens of a sequence.
CAPACITY = 2048
#: Length classes that patterns are made of; a class holds CAPACITY / CLASSES lengths.
CLASSES = 256
#: Most documents of a fitted pattern.
FEW = 3
#: What a missed document of a class below a third of the capacity counts in the fit; best fit places it easily.
SHORT_WEIGHT = 0.1
#: Bytes that the memo of words may hold in a process; encoding a word costs this step more than any other.
WORD_BYTES = 160 << 20
#: The id that ends a document.
END_ID = 0


# Pieces of documents

def _word_encoder(path: str) -> Callable[[str], bytes]:
    """Ids of a word as little-endian unsigned 32-bit bytes. White space never takes part in a token here.

    Where the tokenizer parts letters from signs, a word of ASCII letters and the signs behind it are two entries.
    """
    whole, signs = tokenizer(path), {}
    split = whole.pre_tokenizer
    apart = split is not None and [piece for piece, _ in split.pre_tokenize_str("ab!?")] == ["ab", "!?"]

    def encoded(word: str) -> bytes:
        return np.asarray(whole.encode(word, add_special_tokens=False).ids, "<u4").tobytes()

    def make(word: str) -> bytes:
        base = word.rstrip(string.punctuation) if apart else word
        if base == word or not base.isalpha() or not base.isascii():
            return encoded(word)
        end = word[len(base):]
        if end not in signs:
            if len(signs) > 4096:
                signs.clear()
            signs[end] = encoded(end)
        return _word_ids(path)[base] + signs[end]
    return make


def _word_ids(path: str) -> Memo:
    return memo(f"packed words {path}", lambda: _word_encoder(path), WORD_BYTES)


def document_pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, text: str = "text", doc_id: str = "doc_id",
                    with_ids: bool = False) -> DataFrame:
    """Token pieces of every document: doc_id, piece, start, length, ids_crc32, and with_ids the ids.

    The tokenizer's file must split at blanks and line feeds, as word vocabularies that drop white
    space do; then a text's ids are those of its words. A null or empty text is the end id
    alone. Also returned: ``task`` and ``rank``, the number of earlier pieces of this length in the task.
    """
    end = np.asarray([END_ID], "<u4").tobytes()
    columns = {"piece": pa.int32(), "start": pa.int64(), "length": pa.int64(), "ids_crc32": pa.int64(), "task": pa.int32(), "rank": pa.int64()}
    if with_ids:
        columns["ids"] = pa.list_(pa.int64())

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, seen, task = _word_ids(path), Counter(), TaskContext.get().partitionId()
        for batch in batches:
            rows, owner = [], []
            for document, text in enumerate(whole_texts(batch.column(1))):
                tokens = b"".join(map(ids_of.__getitem__, text.replace("\n", " ").split(" "))) + end
                for piece, at in enumerate(range(0, len(tokens), 4 * capacity)):
                    part = tokens[at:at + 4 * capacity]
                    n = len(part) // 4
                    row = (piece, at // 4, n, zlib.crc32(part), task, seen[n])
                    rows.append((*row, np.frombuffer(part, "<u4").tolist()) if with_ids else row)
                    owner.append(document)
                    seen[n] += 1
            made = [pa.array(c, t) for c, t in zip(zip(*rows), columns.values())] if rows else [pa.array([], t) for t in columns.values()]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(owner, pa.int64())), *made], names=["doc_id", *columns])

    return docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text")).mapInArrow(
        cut, f"doc_id {dict(docs.dtypes)[doc_id]}, piece int, start long, length long, ids_crc32 long, task int, rank long"
        + ", ids array<long>" * with_ids)


# The plan: made on the driver from the histogram alone, whose size is the capacity

def _patterns(classes: int, few: int) -> list[tuple[int, ...]]:
    """All descending class tuples of at most ``few`` members that sum to the number of classes."""
    def parts(total: int, most: int, left: int) -> Iterator[tuple[int, ...]]:
        if total <= most and total:
            yield (total,)
        if left > 1:
            for first in range(min(most, total - 1), 0, -1):
                if first * left < total:
                    break
                for rest in parts(total - first, first, left - 1):
                    yield (first, *rest)
    return list(parts(classes, classes, few))


def nonnegative_least_squares(a: np.ndarray, b: np.ndarray, tolerance: float = 1e-9) -> np.ndarray:
    """x >= 0 with least |a x - b|, by active sets over the normal equations."""
    n = a.shape[1]
    x, active, gram_rhs = np.zeros(n), np.zeros(n, bool), a.T @ b
    scale = tolerance * max(1.0, np.abs(gram_rhs).max(initial=0.0))
    for _ in range(3 * a.shape[0]):
        gradient = gram_rhs - a.T @ (a[:, active] @ x[active])
        gradient[active] = -np.inf
        best = int(np.argmax(gradient)) if n else 0
        if not n or gradient[best] <= scale:
            break
        active[best] = True
        while True:
            columns = np.flatnonzero(active)
            part = a[:, columns]
            try:
                tried = np.linalg.solve(part.T @ part, gram_rhs[columns])
            except np.linalg.LinAlgError:
                tried = np.linalg.lstsq(part, b, rcond=None)[0]
            low = tried <= 0
            if not low.any():
                x[:] = 0
                x[columns] = tried
                break
            now = x[columns]
            step = np.min(now[low] / np.maximum(now[low] - tried[low], 1e-300))
            x[columns] = now + step * (tried - now)
            out = columns[x[columns] <= 1e-12 * max(1.0, x.max())]
            out = out if len(out) else columns[low][:1]
            x[out] = 0
            active[out] = False
            if not active.any():
                break
    return x


class Plan:
    """Patterns of exact lengths, each with its number of repeats, and where a length's k-th piece goes."""

    def __init__(self, bins: list[tuple[Counter, int]]):
        where: dict[int, list[tuple[int, int, int, int]]] = {}
        taken, base = Counter(), 0
        for lengths, repeats in bins:
            at = 0
            for length in sorted(lengths, reverse=True):
                copies = lengths[length]
                where.setdefault(length, []).append((taken[length], copies, base, at))
                taken[length] += copies * repeats
                at += copies * length
            base += repeats
        self.sequences = base
        self.where = {length: np.asarray(rows, "i8").T for length, rows in where.items()}

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of the pieces, by length and rank among all pieces of that length."""
        sequence, offset = np.zeros(len(length), "i8"), np.zeros(len(length), "i8")
        for one in np.unique(length):
            rows = np.flatnonzero(length == one)
            start, copies, base, at = self.where[int(one)]
            k = np.searchsorted(start, rank[rows], side="right") - 1
            inside = rank[rows] - start[k]
            sequence[rows] = base[k] + inside // copies[k]
            offset[rows] = at[k] + inside % copies[k] * one
        return sequence, offset


def make_plan(histogram: dict[int, int], capacity: int = CAPACITY, classes: int = CLASSES, few: int = FEW) -> Plan:
    """Fit pattern repeats to the histogram, round them down, and pack what is left by best fit.

    A pattern holds lengths by class; drawn from a class are its longest pieces first. What
    rounding leaves over, and pieces too short for a fitted pattern, go by decreasing length
    into the fullest sequence with room, those of the patterns included.
    """
    classes = min(classes, capacity)
    width = -(-capacity // classes)
    left = Counter({n: k for n, k in histogram.items() if k > 0})
    per_class = np.zeros(classes)
    for n, k in left.items():
        per_class[-(-n // width) - 1] += k
    patterns = [p for p in _patterns(classes, few) if all(per_class[c - 1] for c in p)]
    bins: list[tuple[Counter, int]] = []
    if patterns:
        a = np.zeros((classes, len(patterns)))
        for j, p in enumerate(patterns):
            for c in p:
                a[c - 1, j] += 1
        weight = np.where(np.arange(1, classes + 1) * few < classes, SHORT_WEIGHT, 1.0)
        repeats = nonnegative_least_squares(a * weight[:, None], per_class * weight)
        for j in np.argsort(-repeats, kind="stable"):
            bins += _drawn(patterns[j], int(repeats[j] + 1e-6), left, width)
    return Plan(_best_fit(left, bins, capacity))


def _drawn(pattern: tuple[int, ...], repeats: int, left: Counter, width: int) -> Iterator[tuple[Counter, int]]:
    """Take the pieces of a class pattern out of ``left``, as patterns of exact lengths."""
    while repeats > 0:
        used: Counter = Counter()
        for c in pattern:
            found = next((n for n in range(c * width, (c - 1) * width, -1) if left[n] > used[n]), None)
            if found is None:
                return
            used[found] += 1
        times = min(repeats, *(left[n] // k for n, k in used.items()))
        for n, k in used.items():
            left[n] -= k * times
        repeats -= times
        yield used, times


def _best_fit(left: Counter, bins: list[tuple[Counter, int]], capacity: int) -> list[tuple[Counter, int]]:
    """Best-fit decreasing over counts: sequences with equal contents are one entry."""
    room: list[list[tuple[Counter, int]]] = [[] for _ in range(capacity + 1)]
    for lengths, repeats in bins:
        room[capacity - sum(n * k for n, k in lengths.items())].append((lengths, repeats))
    for n in sorted((n for n, k in left.items() if k > 0), reverse=True):
        todo, space = left[n], n
        while todo:
            while space <= capacity and not room[space]:
                space += 1
            if space > capacity:
                each = capacity // n
                for copies, times in ((each, todo // each), (todo % each, 1)):
                    if copies and times:
                        room[capacity - copies * n].append((Counter({n: copies}), times))
                todo = 0
                continue
            lengths, repeats = room[space].pop()
            copies = min(space // n, todo) if repeats >= 1 else 0
            full = min(repeats, todo // (space // n))
            if full:
                copies, times = space // n, full
            else:
                copies, times = todo, 1
            if repeats > times:
                room[space].append((lengths, repeats - times))
            room[space - copies * n].append((lengths + Counter({n: copies}), times))
            todo -= copies * times
    return [one for entries in room for one in entries]


# Packing of any table of pieces

def pack(pieces: DataFrame, capacity: int = CAPACITY, classes: int = CLASSES) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``: every piece in a sequence of at most ``capacity`` tokens.

    Needed: ``length`` (1 to capacity), ``task`` and ``rank`` as of ``document_pieces``, in a written
    table. The k-th piece of a length goes where the plan has the k-th place of that length; k is
    the task's start, a running sum over tasks, and the rank inside. So no length, however
    frequent, meets in one task. The driver sees one count per length. An empty table stays empty.
    """
    counts = pieces.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n"))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = pieces.sparkSession.sparkContext.broadcast(make_plan(histogram, capacity, classes))

    @F.pandas_udf("struct<sequence_id:long,offset:long>")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        sequence, offset = plan.value.place(length.to_numpy(), rank.to_numpy())
        return pd.DataFrame({"sequence_id": sequence, "offset": offset})

    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    kept = [c for c in pieces.columns if c not in ("task", "rank")]
    return (
        pieces.join(starts, ["task", "length"])
        .withColumn("at", place("length", F.col("before") + F.col("rank")))
        .select(*(f"`{c}`" for c in kept), "at.sequence_id", "at.offset")
    )


def pack_documents(docs: DataFrame, path: str, capacity: int = CAPACITY, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Pieces of all documents with their places. Rows that repeat an id are packed each for itself."""
    return pack(stored(document_pieces(docs, path, capacity, text, doc_id), "pieces"), capacity)
