"""Byte-level BPE in two tiers: a minimal perfect hash for whole pre-tokens, a heap over linked bytes for the rest."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame, functions as F

from hubcat.llm.memo import Memo, memo, whole_texts

_MASK = (1 << 64) - 1


class PerfectHash:
    """Keys to 0..n-1 without gaps: hash to a bucket, then by the bucket's displacement to a slot.

    Large buckets look for a displacement that is free for all their keys; single keys take the
    slots that are left. A stranger gets some slot too, so the caller compares the key.
    """

    def __init__(self, keys: list[bytes]):
        self.n = len(keys)
        self.buckets = max(1, self.n // 3)
        self.shift = [0] * self.buckets
        members: list[list[tuple[int, int]]] = [[] for _ in range(self.buckets)]
        for key in keys:
            high, low = divmod(xxhash.xxh3_128_intdigest(key), 1 << 64)
            members[low % self.buckets].append((high, low))
        taken, single = np.zeros(self.n, bool), []
        for b in sorted(range(self.buckets), key=lambda b: -len(members[b])):
            if len(members[b]) == 1:
                single.append(b)
            elif members[b]:
                shift = 0
                while True:
                    slots = [self._slot(high, low, shift) for high, low in members[b]]
                    if len(set(slots)) == len(slots) and not taken[slots].any():
                        break
                    shift += 1
                taken[slots] = True
                self.shift[b] = shift
        for b, slot in zip(single, np.flatnonzero(~taken).tolist()):
            self.shift[b] = -1 - slot

    def _slot(self, high: int, low: int, shift: int) -> int:
        mixed = (high ^ shift * 0x9E3779B97F4A7C15 & _MASK) * (low | 1) & _MASK
        return (mixed >> 20) % self.n

    def slot(self, key: bytes) -> int:
        high, low = divmod(xxhash.xxh3_128_intdigest(key), 1 << 64)
        shift = self.shift[low % self.buckets]
        return -1 - shift if shift < 0 else self._slot(high, low, shift)


class ByteBpe:
    """Encodes pre-tokens by a rank file, and decodes ids."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.token = {i: t for t, i in ranks.items()}
        self.hash = PerfectHash(list(ranks))
        self.slots: list[tuple[bytes, int]] = [(b"", 0)] * len(ranks)
        for key, rank in ranks.items():
            self.slots[self.hash.slot(key)] = (key, rank)

    def encode(self, word: bytes) -> list[int]:
        """Ids of one pre-token."""
        key, rank = self.slots[self.hash.slot(word)]
        return [rank] if key == word else self.merged(word)

    def merged(self, word: bytes) -> list[int]:
        """Merge the pair of lowest rank, the leftmost of equals, until none is left.

        Parts are linked by the start of the next and of the previous part. A heap holds pairs as
        (rank, start, end); an entry whose part or neighbour has changed since is passed over.
        """
        n, get = len(word), self.ranks.get
        after, before = list(range(1, n + 2)), list(range(-1, n))
        heap = [(rank, i, i + 2) for i in range(n - 1) if (rank := get(word[i:i + 2])) is not None]
        heapify(heap)
        while heap:
            _, i, end = heappop(heap)
            middle = after[i]
            if middle <= i or middle >= n or after[middle] != end:
                continue
            after[i], after[middle] = end, -1
            if end < n:
                before[end] = i
                if (rank := get(word[i:after[end]])) is not None:
                    heappush(heap, (rank, i, after[end]))
            if (left := before[i]) >= 0 and (rank := get(word[left:end])) is not None:
                heappush(heap, (rank, left, end))
        ids, i = [], 0
        while i < n:
            ids.append(self.ranks[word[i:after[i]]])
            i = after[i]
        return ids


@lru_cache(maxsize=2)
def load(path: str) -> ByteBpe:
    """The encoder of a rank file, built once in each process."""
    with open(path, "rb") as lines:
        return ByteBpe({base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)})


def _word_ids(path: str) -> Memo:
    bpe = load(path)
    return memo(f"pre-token ids {path}", lambda: lambda word: np.asarray(bpe.encode(word.encode()), "<u4").tobytes())


def encode_texts(texts: list[str], path: str, pattern: str) -> Iterator[bytes]:
    """Ids of each text as little-endian unsigned 32-bit bytes."""
    ids_of, split = _word_ids(path), _compiled(pattern).findall
    for text in texts:
        yield b"".join(map(ids_of.__getitem__, split(text)))


@lru_cache(maxsize=4)
def _compiled(pattern: str):
    return regex.compile(pattern)


def decode_ids(ids: bytes, path: str) -> bytes:
    return b"".join(map(load(path).token.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id and ids of every whole text, as an array; null counts as empty and has no ids."""
    def ids(text: pa.Array) -> list[pa.Array]:
        return [pa.array([np.frombuffer(i, "<u4").astype("i8") for i in encode_texts(whole_texts(text), path, pattern)], pa.list_(pa.int64()))]
    return _mapped(docs, doc_id, text, ids, "ids array<long>")


def decode(rows: DataFrame, path: str, ids: str = "ids", doc_id: str = "doc_id") -> DataFrame:
    """doc_id and the bytes that the ids stand for; null ids give no bytes."""
    def decoded(column: pa.Array) -> list[pa.Array]:
        return [pa.array([decode_ids(np.asarray(i or [], "<u4").tobytes(), path) for i in column.to_pylist()], pa.binary())]
    return _mapped(rows, doc_id, ids, decoded, "decoded binary")


def round_trip(docs: DataFrame, path: str, pattern: str, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: doc_id, n_tokens, and SHA-256 of the ids and of the bytes decoded from them.

    Null and empty texts have no ids. Rows that repeat an id come back each. Ids never leave the
    task, so that a text costs no more than its own length in memory.
    """
    def digests(text: pa.Array) -> list[pa.Array]:
        counts, ids, decoded = [], [], []
        for found in encode_texts(whole_texts(text), path, pattern):
            counts.append(len(found) // 4)
            ids.append(hashlib.sha256(found).hexdigest())
            decoded.append(hashlib.sha256(decode_ids(found, path)).hexdigest())
        return [pa.array(counts, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())]
    return _mapped(docs, doc_id, text, digests, "n_tokens long, ids_sha256 string, decoded_sha256 string")


def _mapped(rows: DataFrame, doc_id: str, column: str, make: Callable[[pa.Array], list[pa.Array]], made: str) -> DataFrame:
    """doc_id as it is, and the columns that ``make`` finds for the other one."""
    names = ["doc_id", *(part.split()[0] for part in made.split(", "))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), *make(batch.column(1))], names=names)
    return rows.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{column}`")).mapInArrow(
        run, f"doc_id {dict(rows.dtypes)[doc_id]}, {made}")
