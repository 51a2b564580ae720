"""N-gram Jaccard join: a blocked sparse product of the document by n-gram matrix, with size-derived bounds."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain, pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from hubcat.llm.components import components, joined as _joined
from hubcat.llm.memo import let_go
from hubcat.operators.skew import join_unique
from hubcat.session import stored

#: Entries (documents times n-grams) of a row block; a task multiplies two of them.
BLOCK_ENTRIES = 2_000_000
#: Column-block signatures that a task gathers before it hands them on.
GATHERED = 1_000_000
#: Texts whose shingles are found at a time.
TEXTS_AT_ONCE = 128
#: Bytes of text whose signatures one bucket takes at most, about.
BUCKET_BYTES = 32_000_000
#: Buckets of signatures in all, at least, about: schemes share them by their weight.
LEAST_BUCKETS = 64
#: Bits of the map that keeps most texts without candidates out of the exchange.
FILTER_BITS = 1 << 25
#: Bytes of a signature that travel; its bucket stands for the others. Equal ones are candidates only.
_KEPT = 6
#: Counters of documents by shingle hash: about one for so many bytes of text, as a power of two between these bits.
SLOT_BYTES, SLOT_BITS = 96, (20, 24)
#: Bytes of text that a task counts, at least, where there are tasks enough for all cores.
COUNTED_BYTES = 512_000_000
#: Parts that the counters are added up in, and how many tasks' parts one step adds.
_SLICES, _ADDED = 64, 32
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xBF58476D1CE4E5B9)]


# Rows of the matrix

def _scrambled(h: np.ndarray) -> np.ndarray:
    h = (h ^ h >> np.uint64(32)) * _ODD[1]
    h = (h ^ h >> np.uint64(29)) * _ODD[2]
    return h ^ h >> np.uint64(32)


def shingles(text: str | None, words: int) -> np.ndarray:
    """Ascending 64-bit hashes of a text's distinct shingles of so many words.

    A to Z are lower-cased; words are what the blanks 9 to 13 and 32 leave. A text of fewer words is one shingle,
    one without words has none.
    """
    return shingle_sets([text], words)[0]


def shingle_sets(texts: list[str | None], words: int) -> list[np.ndarray]:
    """The shingles of each text; all are hashed and sorted at once."""
    parts = [(text or "").encode().lower().split() for text in texts]
    size = np.fromiter(map(len, parts), "i8", len(parts))
    h = np.frombuffer(b"".join(map(xxhash.xxh64_digest, chain.from_iterable(parts))), "<u8")
    end = np.cumsum(size)
    width = np.minimum(size, words)
    owner = np.repeat(np.arange(len(parts)), size)
    left = end[owner] - np.arange(len(h))
    # A shingle starts at each word that has enough behind it; a short text's at its first.
    first = np.flatnonzero(left >= width[owner])
    owner = owner[first]
    mixed = width[owner].astype("u8")
    for i in range(words):
        more = np.flatnonzero(i < width[owner]) if (width < words).any() else slice(None)
        mixed[more] = _scrambled(mixed[more] * _ODD[0] + h[first[more] + i])
    bounds = np.searchsorted(owner, np.arange(len(parts) + 1)).tolist()
    for a, b in pairwise(bounds):
        mixed[a:b].sort()
    new = np.flatnonzero(np.r_[True, (mixed[1:] != mixed[:-1]) | (owner[1:] != owner[:-1])][:len(mixed)])
    return np.split(mixed[new], np.searchsorted(owner[new], np.arange(1, len(parts))))


def _sets_of(texts: list[str | None], words: int) -> Iterator[np.ndarray]:
    """The same, for as many texts at a time as memory may hold."""
    for at in range(0, len(texts), TEXTS_AT_ONCE):
        yield from shingle_sets(texts[at:at + TEXTS_AT_ONCE], words)


# Column blocks. Two sets that are near enough agree wholly on one of the blocks.

class Scheme:
    """How the n-gram columns are cut into blocks for sets of a size class.

    A pair whose similarity is at least part / whole, and whose smaller set lies in class c, has its
    larger set in c or c + 1, and differs in at most ``apart`` columns. So of ``apart`` + 1
    blocks that are not empty one is equal. Sets of class c take part in schemes c and c - 1.
    """

    def __init__(self, part: int, whole: int):
        self.part, self.whole = part, whole
        self.starts = [1]
        while self.starts[-1] < 1 << 40:
            self.starts.append(self.starts[-1] * whole // part + 1)
        spare = 1 + 2 * (whole - part) / part
        self.apart = [(b - 1) * (whole - part) // part for b in self.starts[1:]]
        self.blocks = [int((d + 1) * spare) + 1 for d in self.apart]
        self._starts = np.asarray(self.starts)

    def signatures(self, held: np.ndarray, frequent: np.ndarray | None = None) -> np.ndarray:
        """One hash per scheme and block of a set of ascending hashes, for blocks that are not empty."""
        return self.signatures_by_scheme(held, frequent)[0]

    def signatures_by_scheme(self, held: np.ndarray, frequent: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The same, and the scheme that each belongs to.

        Frequent columns take no part, so that a shared passage alone makes no candidates. A set that is left
        with too few blocks gives all blocks of all its columns too, the empty ones with them. If its
        partner has blocks enough, they agree on one of those; if not, the partner gives all as well.
        """
        size_class = int(np.searchsorted(self._starts, len(held), side="right")) - 1
        rare = held if frequent is None else held[~frequent]
        found, schemes = [], []
        for c in {size_class, max(0, size_class - 1)}:
            block, total = self._blocks_of(rare, c)
            found.append(_scrambled(total + block * _ODD[0] + np.full(1, 2 * c, "u8") * _ODD[1]))
            if len(block) <= self.apart[c]:
                block, total = self._blocks_of(held, c)
                every = np.zeros(self.blocks[c], "u8")
                every[block.astype("i8")] = total
                found.append(_scrambled(every + np.arange(len(every), dtype="u8") * _ODD[0] + np.full(1, 2 * c + 1, "u8") * _ODD[1]))
            schemes.append(np.full(sum(map(len, found)) - sum(map(len, schemes)), c, "u2"))
        return np.concatenate(found), np.concatenate(schemes)

    def parts(self, sizes: dict[float, int], buckets: int) -> np.ndarray:
        """Into how many buckets each scheme's signatures go, ``buckets`` in all and up to one more for each, from the number of sets by their size, about."""
        weight = np.zeros(len(self.blocks))
        for size, sets in sizes.items():
            size_class = int(np.searchsorted(self._starts, max(1.0, size), side="right")) - 1
            for c in {size_class, max(0, size_class - 1)}:
                weight[c] += sets * self.blocks[c] * -np.expm1(-size / self.blocks[c])
        return np.maximum(1, np.ceil(weight / max(1.0, weight.sum()) * buckets)).astype("i8")

    def _blocks_of(self, held: np.ndarray, c: int) -> tuple[np.ndarray, np.ndarray]:
        """The blocks that are not empty, and a hash of what each holds."""
        if not len(held):
            return np.zeros(0, "u8"), np.zeros(0, "u8")
        block = (held >> np.uint64(32)) * np.uint64(self.blocks[c]) >> np.uint64(32)
        first = np.flatnonzero(np.r_[True, block[1:] != block[:-1]])
        return block[first], np.add.reduceat(_scrambled(held ^ _ODD[0]), first)


# Which columns are frequent: only a hint, kept in counters whose number follows the corpus

def _slots(held: np.ndarray, bits: int) -> np.ndarray:
    return (held >> np.uint64(64 - bits)).astype("i8")


def _slot_bits(text_bytes: int) -> int:
    return min(max(SLOT_BITS[0], (text_bytes // SLOT_BYTES).bit_length()), SLOT_BITS[1])


def _counted(words: int, bits: int):
    """A task's documents by slot of the shingle hash, in slices."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        counts = np.zeros(1 << bits, "u4")
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for at in range(0, len(texts), TEXTS_AT_ONCE):
                np.add.at(counts, _slots(np.concatenate(shingle_sets(texts[at:at + TEXTS_AT_ONCE], words)), bits), 1)
        task = TaskContext.get().partitionId()
        for at, part in enumerate(counts.reshape(_SLICES, -1)):
            # A byte tells enough: the usual count of a task is below 20, and a slot that is full stands out all the same.
            yield pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([task], pa.int32()),
                                              pa.array([np.minimum(part, 255).astype("u1").tobytes()], pa.binary())], names=["slice", "part", "counts"])
    return run


def _frequent_slots(docs: DataFrame, words: int, bits: int, parts: int) -> np.ndarray:
    """A bit for every slot that holds far more documents than a slot does at random; all documents count.

    ``parts`` tasks count, few against the bytes that each reads. A step adds a bounded number of tasks' counters, so
    there are as many steps as the tasks ask for. The driver gets a bit per slot. A slice is a random part of the columns, so its own median tells the usual number.
    """
    def summed(parts: pd.DataFrame, kind: str) -> np.ndarray:
        total = np.zeros((1 << bits) // _SLICES, "u8")
        for counts in parts["counts"]:
            total += np.frombuffer(counts, kind)
        return total

    def adder(kind: str):
        def add(parts: pd.DataFrame) -> pd.DataFrame:
            total = np.minimum(summed(parts, kind), 0xFFFFFFFF).astype("<u4")
            return pd.DataFrame({"slice": parts["slice"][:1], "part": parts["part"][:1] // _ADDED, "counts": [total.tobytes()]})
        return add

    def judge(parts: pd.DataFrame) -> pd.DataFrame:
        counts = summed(parts, kind)
        usual = float(np.median(counts))
        return pd.DataFrame({"slice": parts["slice"][:1], "bits": [np.packbits(counts > usual + 5 * usual ** 0.5 + 8).tobytes()]})

    schema, kind = "slice int, part int, counts binary", "u1"
    texts = docs.select("text").coalesce(parts)
    counted, parts = texts.mapInArrow(_counted(words, bits), schema), min(parts, texts.rdd.getNumPartitions())
    while parts > _ADDED:
        counted = counted.groupBy("slice", F.floor(F.col("part") / _ADDED).alias("step")).applyInPandas(adder(kind), schema)
        parts, kind = -(-parts // _ADDED), "<u4"
    found = sorted(counted.groupBy("slice").applyInPandas(judge, "slice int, bits binary").collect())
    if not found:
        return np.zeros(1 << bits >> 3, "u1")
    return np.frombuffer(b"".join(r["bits"] for r in found), "u1")


def _marked(packed: np.ndarray, slots: np.ndarray) -> np.ndarray:
    """Which of the slots have their bit set."""
    return (packed[slots >> 3] << (slots & 7).astype("u1") & 128).astype(bool)


def _sizes(docs: DataFrame, words: int) -> dict[float, int]:
    """Documents by their number of shingles, about, repeats counted: steps of 2.5 %, so that the driver sees some hundred rows."""
    starts = F.greatest(F.lit(1), F.size(F.split("text", r"[\x20\x09-\x0D]+")) - (words - 1))
    counts = docs.groupBy(F.floor(F.log(starts) * 40).alias("step")).agg(F.count(F.lit(1)).alias("docs")).collect()
    return {float(np.exp((r["step"] + 0.5) / 40)): r["docs"] for r in counts}


def _rows(words: int, scheme: Scheme, buckets: int, id_type: pa.DataType, frequent, bits: int, sizes: dict[float, int]):
    """Kind 0: a document and its set's size and fingerprint. Kind 1: a task's signatures in a bucket.

    A scheme has buckets of its own. So sets of one size meet in few buckets, and near copies, which share many
    signatures, in as few: a bucket's task makes one link of all that two sets share there.
    """
    parts = scheme.parts(sizes, buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        task, count, known = TaskContext.get().partitionId(), 0, {}
        signatures, schemes, owners, held = [], [], [], 0
        for batch in batches:
            uid, size, prints = [], [], []
            for found in _sets_of(batch.column(1).to_pylist(), words):
                own = xxhash.xxh3_128_digest(found.tobytes())
                uid.append(task << 32 | count)
                size.append(len(found))
                prints.append(own)
                if len(found) and own not in known:
                    known[own] = count
                    for kind, values in zip((signatures, schemes), scheme.signatures_by_scheme(found, _marked(frequent.value, _slots(found, bits)))):
                        kind.append(values)
                    owners.append(np.full(len(signatures[-1]), count, "u4"))
                    held += len(owners[-1])
                count += 1
            n = len(uid)
            yield pa.RecordBatch.from_arrays(
                [pa.array([0] * n, pa.int32()), pa.array(uid, pa.int64()), batch.column(0), batch.column(2), pa.array(size, pa.int64()),
                 pa.array(prints, pa.binary()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary()), pa.nulls(n, pa.binary())], names=_NAMES)
            if held >= GATHERED:
                yield _dealt(task, signatures, schemes, owners, parts, id_type)
                signatures, schemes, owners, held = [], [], [], 0
        if held:
            yield _dealt(task, signatures, schemes, owners, parts, id_type)
    return run


_NAMES = ["kind", "uid", "doc_id", "text_hash", "size", "print", "bucket", "signatures", "owners"]


def _dealt(task: int, signatures: list, schemes: list, owners: list, parts: np.ndarray, id_type: pa.DataType) -> pa.RecordBatch:
    """Signatures by bucket, and their owners as steps from one to the next, which compress well."""
    signature, scheme, owner = np.concatenate(signatures), np.concatenate(schemes), np.concatenate(owners)
    inside = (signature >> np.uint64(32)) * parts.astype("u8")[scheme] >> np.uint64(32)
    bucket = ((np.cumsum(parts) - parts)[scheme] + inside.astype("i8")).astype("i4")
    order = np.argsort(bucket, kind="stable")
    signature, owner, bucket = signature[order], owner[order], bucket[order]
    first = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
    last = np.r_[first[1:], len(bucket)]
    n = len(first)
    return pa.RecordBatch.from_arrays(
        [pa.array([1] * n, pa.int32()), pa.array([task << 32] * n, pa.int64()), pa.nulls(n, id_type), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()),
         pa.nulls(n, pa.binary()), pa.array(bucket[first], pa.int32()),
         pa.array([signature[a:b].view("u1").reshape(-1, 8)[:, :_KEPT].tobytes() for a, b in zip(first, last)], pa.binary()),
         pa.array([np.diff(owner[a:b], prepend=np.uint32(0)).tobytes() for a, b in zip(first, last)], pa.binary())], names=_NAMES)


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's candidate links: sets that share signatures, directly or by others, hang on the first of them.

    Each bucket's links are joined to those of the task's buckets before, so that a set comes out once in a task,
    however many signatures it shares and with however many others.
    """
    node, root = np.zeros(0, "i8"), np.zeros(0, "i8")
    for bucket in _runs(batches, 1):
        kept = np.frombuffer(b"".join(bucket.column(1).to_pylist()), "u1").reshape(-1, _KEPT)
        signature = np.pad(kept, ((0, 0), (0, 8 - _KEPT))).view("u8").ravel()
        uid = np.concatenate([np.cumsum(np.frombuffer(o, "u4"), dtype="i8") | base for base, o in zip(bucket.column(0).to_pylist(), bucket.column(2).to_pylist())])
        order = np.lexsort((uid, signature))
        signature, uid = signature[order], uid[order]
        new = np.r_[True, signature[1:] != signature[:-1]]
        head = uid[np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))]
        links = np.unique(np.stack([uid[~new], head[~new]], axis=1), axis=0)
        links = links[links[:, 0] != links[:, 1]]
        node, root = _joined(np.r_[node, links[:, 0]], np.r_[root, links[:, 1]])
    apart = node != root
    yield pa.RecordBatch.from_arrays([pa.array(node[apart]), pa.array(root[apart])], names=["a", "b"])


def _runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Tables of the neighbouring rows that agree on the last ``keys`` columns; the rows come sorted by them."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        marks = list(zip(*(batch.column(batch.num_columns - keys + i).to_pylist() for i in range(keys))))
        at = 0
        while at < len(marks):
            stop = at
            if held and marks[at] != last:
                yield pa.Table.from_batches(held)
                held = []
            last = marks[at]
            while stop < len(marks) and marks[stop] == last:
                stop += 1
            held.append(batch.slice(at, stop - at))
            at = stop
    if held:
        yield pa.Table.from_batches(held)


# The product

def linked_pairs(sets: list[np.ndarray], label: np.ndarray, left: np.ndarray, part: int, whole: int) -> list[tuple[int, int]]:
    """Links between sets of different labels, one end in ``left``: enough to join all that the similarity joins.

    Rows are taken one by one against the block. Columns are ordered by their number of entries;
    a row reaches others by its rarest columns only, as many as it may miss, plus one. Whole overlap counts are
    accumulated for partners whose size allows the similarity and that are not joined yet.
    """
    size = np.asarray([len(s) for s in sets])
    start = np.r_[0, np.cumsum(size)]
    _, column = np.unique(np.concatenate(sets), return_inverse=True)
    entries = np.bincount(column)
    row = np.repeat(np.arange(len(sets)), size)
    order = np.lexsort((column, entries[column], row))
    rank = np.arange(len(order)) - start[row[order]]
    reach = size - -(-size * part // whole) + 1
    rare = order[(rank < reach[row[order]]) & (entries[column[order]] > 1)]
    by_column = rare[np.argsort(column[rare], kind="stable")]
    post_start = np.searchsorted(column[by_column], np.arange(len(entries) + 1))
    posted = row[by_column]
    own_start = np.searchsorted(row[rare], np.arange(len(sets) + 1))
    label, found = label.copy(), []
    marked = np.zeros(len(entries), bool)
    for i in np.flatnonzero(left):
        probes = column[rare[own_start[i]:own_start[i + 1]]]
        if not len(probes):
            continue
        near = np.concatenate([posted[post_start[c]:post_start[c + 1]] for c in probes])
        near = near[(label[near] != label[i]) & ~(left[near] & (near < i))]
        near = near[(size[near] * whole >= size[i] * part) & (size[i] * whole >= size[near] * part)]
        if not len(near):
            continue
        near = np.unique(near)
        marked[column[start[i]:start[i + 1]]] = True
        begin = np.r_[0, np.cumsum(size[near])]
        inside = np.concatenate([column[start[j]:start[j + 1]] for j in near])
        both = np.add.reduceat(marked[inside].astype("i8"), begin[:-1])
        marked[column[start[i]:start[i + 1]]] = False
        joined = near[whole * both >= part * (size[i] + size[near] - both)]
        if len(joined):
            found += [(int(i), int(j)) for j in joined]
            label[np.isin(label, np.unique(label[joined]))] = label[i]
    return found


def _multiplied(words: int, part: int, whole: int):
    """Links of each row-block pair: columns text, uid, label, left, then the block's keys."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for block in _runs(batches, 3):
            uid = np.asarray(block.column(1).to_pylist(), "i8")
            uid, first = np.unique(uid, return_index=True)
            label = np.asarray(block.column(2).to_pylist(), "i8")[first]
            left = np.asarray(block.column(3).to_pylist(), bool)[first]
            texts = block.column(0).to_pylist()
            sets = list(_sets_of([texts[k] for k in first], words))
            links = linked_pairs(sets, label, left, part, whole)
            yield pa.RecordBatch.from_arrays([pa.array([int(uid[i]) for i, _ in links], pa.int64()),
                                              pa.array([int(uid[j]) for _, j in links], pa.int64())], names=["a", "b"])
    return run


def in_bitmap(work: DataFrame, key: str) -> Column | None:
    """Whether a row's ``key``, a hash, may be one of ``work``: a bitmap of FILTER_BITS is broadcast, whatever the size. None: there are none."""
    slot = F.pmod(key, F.lit(FILTER_BITS)) + 1
    maps = work.select(slot.alias("slot")).groupBy(F.bitmap_bucket_number("slot").alias("at")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits")).collect()
    if not maps:
        return None
    bitmap = bytearray(FILTER_BITS // 8)
    for row in maps:
        bitmap[(row["at"] - 1) * len(row["bits"]):row["at"] * len(row["bits"])] = row["bits"]
    shared = work.sparkSession.sparkContext.broadcast(bytes(bitmap))

    @F.pandas_udf("boolean")
    def held(slot: pd.Series) -> pd.Series:
        at = slot.to_numpy() - 1
        return pd.Series((np.frombuffer(shared.value, "u1")[at >> 3] >> (at & 7) & 1).astype(bool))

    return held(slot)


def _possible(docs: DataFrame, work: DataFrame) -> DataFrame:
    """``docs`` without most texts that ``work`` doesn't need."""
    held = in_bitmap(work, "text_hash")
    return docs.where(F.lit(False) if held is None else held)


def bytes_of(docs: DataFrame, text: str) -> int:
    """UTF-8 bytes of all texts."""
    return docs.agg(F.sum(F.octet_length(F.col(f"`{text}`").cast("binary")).cast("long"))).first()[0] or 0


def blocks_of(docs: DataFrame, text: str, block_bytes: int) -> int:
    """Blocks that hold about ``block_bytes`` of the texts each, or fewer: two for each shuffle partition at least."""
    return max(2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-bytes_of(docs, text) // block_bytes))


def _product(docs: DataFrame, work: DataFrame, words: int, part: int, whole: int) -> DataFrame:
    """Links found by ``work``: rows of (doc_id, text_hash, uid, label, left, component, row_block, column_block)."""
    keys = ["component", "row_block", "column_block"]
    texts = _possible(docs, work).select("doc_id", "text", "text_hash").join(
        work, docs["doc_id"].eqNullSafe(work["doc_id"]) & (docs["text_hash"] == work["text_hash"])).select("text", "uid", "label", "left", *keys)
    return texts.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(_multiplied(words, part, whole), "a long, b long")


def jaccard_groups(docs: DataFrame, words: int = 5, part: int = 80, whole: int = 100, text: str = "text", doc_id: str = "doc_id",
                   block_entries: int = BLOCK_ENTRIES) -> DataFrame:
    """One row per document: doc_id, text_hash, n_shingles, component_id (the smallest id of all that links reach), label.

    Two documents link when whole * intersection >= part * union of their shingle sets. Equal sets are one row of the matrix.
    Candidates agree wholly on a column block (see ``Scheme``), which every linked pair does. A first pass counts
    documents by shingle hash, so that frequent shingles make no candidates.
    They are joined to candidate components; a component's rows are cut into blocks of bounded size and multiplied
    block by block, larger ones first each block by itself, then what is still apart against all.
    Only links that join something are kept, so that no group gives all its pairs. ``label`` is one long for each
    component, in no fixed order. Texts that are null or have no
    words link with nothing. Rows that repeat an id come back each; rows without an id have the
    smallest id of their component, if it has any.
    """
    spark, scheme = docs.sparkSession, Scheme(part, whole)
    docs = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    docs = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    total = bytes_of(docs, "text")
    buckets, bits = max(LEAST_BUCKETS, -(-total // BUCKET_BYTES)), _slot_bits(total)
    parts = max(2 * spark.sparkContext.defaultParallelism, total // COUNTED_BYTES)
    # Buckets bound what a task holds at a time; their number and place do not depend on the tasks, nor does the number of links.
    tasks = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    id_field = docs.schema["doc_id"].dataType
    rows = stored(docs.mapInArrow(
        _rows(words, scheme, buckets, to_arrow_type(id_field), spark.sparkContext.broadcast(_frequent_slots(docs, words, bits, parts)), bits, _sizes(docs, words)),
        f"kind int, uid long, doc_id {id_field.simpleString()}, text_hash long, size long, print binary, bucket int, signatures binary, owners binary"), "matrix")
    matrix = rows.where("kind = 0").select("uid", "doc_id", "text_hash", "size", "print")
    first = matrix.groupBy("print").agg(F.min("uid").alias("row"), F.count(F.lit(1)).alias("copies"))
    named = stored(join_unique(matrix, first, "print", "inner").select(
        "uid", "doc_id", "text_hash", "size", F.when(F.col("size") > 0, F.col("row")).otherwise(F.col("uid")).alias("row")), "rows")
    stars = rows.where("kind = 1").select("uid", "signatures", "owners", "bucket").repartitionById(tasks, "bucket").sortWithinPartitions("bucket").mapInArrow(
        _stars, "a long, b long").distinct()
    one = named.select(F.col("uid").alias("a"), F.col("row").alias("row_a"))
    two = named.select(F.col("uid").alias("b"), F.col("row").alias("row_b"))
    near = components(stars.join(one, "a").join(two, "b").select(F.col("row_a").alias("a"), F.col("row_b").alias("b")))
    held = named.where("uid = row").join(near.select(F.col("node").alias("uid"), F.col("label").alias("component")), "uid")
    blocks = held.groupBy("component").agg(F.ceil(F.sum("size") / block_entries).cast("int").alias("blocks"))
    held = stored(held.join(blocks, "component").select("*", F.pmod(F.xxhash64("uid"), "blocks").cast("int").alias("block")), "candidates")
    alone = held.select("doc_id", "text_hash", "uid", F.col("uid").alias("label"), F.lit(True).alias("left"), "component",
                        F.col("block").alias("row_block"), F.col("block").alias("column_block"))
    links = stored(_product(docs, alone, words, part, whole), "links")
    many = held.where("blocks > 1")
    if not many.isEmpty():
        links = links.union(_between_blocks(docs, many, links, words, part, whole, block_entries))
    joined = components(links)
    final = named.join(joined.select(F.col("node").alias("row"), "label"), "row", "left").select(
        "doc_id", "text_hash", F.col("size").alias("n_shingles"), F.coalesce("label", "row").alias("label"))
    final = stored(final, "joined")
    least = final.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    return join_unique(final, least, "label", "inner").select("doc_id", "text_hash", "n_shingles", "component_id", "label")


def drop_near_copies(docs: DataFrame, words: int = 5, part: int = 80, whole: int = 100, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The documents that stay, with all their columns: of each group the one with the smallest id, a null id last.

    Of rows that share this id the one with the smallest text hash stays; rows that also share the text stay together.
    """
    groups = jaccard_groups(docs, words, part, whole, text, doc_id)
    chosen = groups.groupBy("label").agg(F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "text_hash")).alias("best"))
    chosen = chosen.select(F.col("best.doc_id").alias("id"), F.col("best.text_hash").alias("hash")).distinct()
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col(f"`{doc_id}`").alias("own"),
                       F.xxhash64(F.coalesce(F.col(f"`{text}`"), F.lit(""))).alias("own_hash"))
    same = F.col("own_hash") == F.col("hash")
    return rows.join(chosen, same & F.col("own").eqNullSafe(F.col("id")), "left_semi").select("row.*")


def _between_blocks(docs: DataFrame, many: DataFrame, links: DataFrame, words: int, part: int, whole: int, block_entries: int) -> DataFrame:
    """Links between blocks: rows outside a component's largest joined part meet all its rows, block by block."""
    now = components(links).select(F.col("node").alias("uid"), F.col("label").alias("now"))
    rows = many.join(now, "uid", "left").withColumn("now", F.coalesce("now", "uid"))
    largest = rows.groupBy("component", "now").agg(F.sum("size").alias("weight")).groupBy("component").agg(
        F.max(F.struct("weight", "now")).alias("most"), F.sum("weight").alias("all"))
    rows = rows.join(largest, "component").select(
        "*", (F.col("now") != F.col("most.now")).alias("outside"),
        F.greatest(F.lit(1), F.ceil((F.col("all") - F.col("most.weight")) / block_entries)).cast("int").alias("outer"))
    rows = stored(rows.select("doc_id", "text_hash", "uid", "component", "block", "blocks", "outside", "outer", F.col("now").alias("label"),
                              F.pmod(F.xxhash64("uid", F.lit(1)), "outer").cast("int").alias("own")), "blocks")
    left = rows.where("outside").select("doc_id", "text_hash", "uid", "label", F.lit(True).alias("left"), "component", F.col("own").alias("row_block"),
                                        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("column_block"))
    right = rows.select("doc_id", "text_hash", "uid", "label", F.lit(False).alias("left"), "component",
                        F.explode(F.sequence(F.lit(0), F.col("outer") - 1)).alias("row_block"), F.col("block").alias("column_block"))
    # A row outside is in its own tile as left: there its right copy goes.
    right = right.join(left.select("uid", "row_block", "column_block"), ["uid", "row_block", "column_block"], "left_anti").select(left.columns)
    return stored(_product(docs, left.union(right), words, part, whole), "links")
