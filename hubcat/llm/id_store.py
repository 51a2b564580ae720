"""Token-id files: raw id payloads, and in each file a minimal perfect hash from document keys to their places."""

from __future__ import annotations

import json
import string
import struct
import zlib
from collections.abc import Callable, Iterator
from itertools import accumulate
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from hubcat.llm.memo import Memo, let_go, memo, tokenizer
from hubcat.llm.token_counts import units
from hubcat.session import stored

# The file: each document's ids and the end id, all little-endian unsigned, of 16 bits where the vocabulary allows it, else of
# 32; then the directory, the hash, a trailer of fixed length, and once more the end id, which ends every record of the file.
#: The id that ends a document.
END_ID = 2
#: Bytes of text that a file takes, about.
FILE_BYTES = 16_000_000
_TRAILER = struct.Struct("<8s7Q")
_MAGIC = b"ids+mph1"
#: Slots per key of a level of the hash.
_ROOM = 1.5


# The index

def key_hash(key: object) -> bytes:
    """128 bits of a document key, whatever its type; null is a key of its own."""
    return xxhash.xxh3_128_digest(b"null" if key is None else b"key " + str(key).encode())


def _mixed(h: np.ndarray, level: int) -> np.ndarray:
    """Another 64-bit hash for each level, from the two halves of the keys' hashes (rows by 2)."""
    x = h[:, 0] + h[:, 1] * np.uint64(2 * level + 1)
    x = (x ^ x >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ x >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ x >> np.uint64(32)


class PerfectIndex:
    """A minimal perfect hash by levels of bit maps.

    A key's bit on a level is set when no other key that is left falls there; its slot is the number of
    set bits before it. Keys that meet go to the next level. Each slot holds a 32-bit fingerprint of its key. Look-up
    takes about two levels on average, however many keys there are.
    """

    def __init__(self, sizes: np.ndarray, bits: np.ndarray, prints: np.ndarray):
        self.sizes, self.bits, self.prints = sizes, bits, prints
        self._first = np.r_[0, np.cumsum(sizes)]
        words = bits.view("<u8")
        self._before = np.r_[0, np.cumsum(np.bitwise_count(words), dtype="i8")]
        self._words = words

    @classmethod
    def build(cls, hashes: np.ndarray) -> PerfectIndex:
        """Of distinct key hashes, rows by 2 unsigned longs."""
        left, sizes, maps = hashes, [], []
        while len(left):
            size = -(-int(len(left) * _ROOM + 1) // 64) * 64
            at = (_mixed(left, len(sizes)) % np.uint64(size)).astype("i8")
            alone = np.bincount(at, minlength=size) == 1
            sizes.append(size)
            maps.append(np.packbits(alone, bitorder="little"))
            left = left[~alone[at]]
        bits = np.concatenate(maps) if maps else np.zeros(0, "u1")
        made = cls(np.asarray(sizes, "<u8"), bits, np.zeros(len(hashes), "<u4"))
        slots = made._slots(hashes)
        made.prints[slots] = (hashes[:, 1] >> np.uint64(32)).astype("<u4")
        return made

    def _slots(self, hashes: np.ndarray) -> np.ndarray:
        slots, open_ = np.full(len(hashes), -1, "i8"), np.arange(len(hashes))
        for level, size in enumerate(self.sizes.tolist()):
            if not len(open_):
                break
            at = (_mixed(hashes[open_], level) % np.uint64(size)).astype("i8") + int(self._first[level])
            word, bit = at >> 6, (at & 63).astype("u8")
            held = (self._words[word] >> bit & np.uint64(1)).astype(bool)
            below = self._words[word[held]] & ((np.uint64(1) << bit[held]) - np.uint64(1))
            slots[open_[held]] = self._before[word[held]] + np.bitwise_count(below)
            open_ = open_[~held]
        return slots

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Slots of the keys; -1 where no level or the fingerprint knows the key."""
        slots = self._slots(hashes)
        known = slots >= 0
        known[known] = self.prints[slots[known]] == (hashes[known, 1] >> np.uint64(32)).astype("<u4")
        return np.where(known, slots, -1)


def _hashes(keys: list) -> np.ndarray:
    return np.frombuffer(b"".join(map(key_hash, keys)), "<u8").reshape(-1, 2)


class Place(NamedTuple):
    """Where a key's documents lie in a file: the first one's number, how many follow each other."""

    document: int
    copies: int


class IdFile:
    """A file's bytes, opened by its trailer; the payload is looked into, not copied."""

    def __init__(self, content: bytes):
        for self.width in (2, 4):
            end = len(content) - self.width - _TRAILER.size
            found = _TRAILER.unpack_from(content, end) if end >= 0 else (b"", 0)
            if found[:2] == (_MAGIC, self.width):
                break
        else:
            raise ValueError("not a token-id file")
        payload, documents, keys, levels, bits, key_bytes = found[2:]
        self._content, at = memoryview(content), payload

        def taken(dtype: str, n: int) -> np.ndarray:
            nonlocal at
            found = np.frombuffer(content, dtype, n, at)
            at += found.nbytes
            return found

        #: First id of each document in the file, and the end of the last one.
        self.starts = taken("<u8", documents + 1).astype("i8")
        self._document, self._copies = taken("<u8", keys), taken("<u8", keys)
        sizes, prints = taken("<u8", levels), taken("<u4", keys)
        # The bit maps are read as words of eight bytes, wherever they lie in the file.
        self.index = PerfectIndex(sizes, taken("u1", bits).copy(), prints)
        self.keys = pa.ipc.open_stream(pa.py_buffer(content[at:at + key_bytes])).read_all().column(0)

    def __len__(self) -> int:
        return len(self.starts) - 1

    def ids(self, document: int) -> np.ndarray:
        """Ids of the file's n-th document, its end id included, as unsigned longs of 32 bits."""
        first, last = self.starts[document:document + 2].tolist()
        return np.frombuffer(self._content[self.width * first:self.width * last], f"<u{self.width}").astype("<u4")

    def places(self, keys: list) -> list[Place | None]:
        """Where the keys lie: one look-up each, None for a key that the fingerprints do not know."""
        if not keys:
            return []
        return [None if slot < 0 else Place(int(self._document[slot]), int(self._copies[slot])) for slot in self.index.find(_hashes(keys)).tolist()]


def _footer(keys: pa.Array, counts: list[int], width: int) -> bytes:
    """Directory, hash and trailer of a file whose documents, in order, have these keys and numbers of ids of so many bytes."""
    starts = np.r_[0, np.cumsum(np.asarray(counts, "i8"))].astype("<u8")
    hashes = _hashes(keys.to_pylist())
    # Equal keys follow each other.
    first = np.flatnonzero(np.r_[True, (hashes[1:] != hashes[:-1]).any(axis=1)]) if len(hashes) else np.zeros(0, "i8")
    copies = np.diff(np.r_[first, len(hashes)])
    index = PerfectIndex.build(hashes[first])
    slots = index.find(hashes[first])
    document, repeated = np.zeros(len(first), "<u8"), np.zeros(len(first), "<u8")
    document[slots], repeated[slots] = first, copies
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, pa.schema([("key", keys.type)])) as stream:
        stream.write_batch(pa.RecordBatch.from_arrays([keys], names=["key"]))
    names = sink.getvalue().to_pybytes()
    parts = [starts, document, repeated, index.sizes, index.prints, index.bits]
    trailer = _TRAILER.pack(_MAGIC, width, width * int(starts[-1]), len(counts), len(first), len(index.sizes), len(index.bits), len(names))
    return b"".join([*(p.tobytes() for p in parts), names, trailer])


# Encoding

def id_width(path: str) -> int:
    """Bytes of an id in the files: 2 where all ids of the vocabulary fit, else 4."""
    return 2 if max(tokenizer(path).get_vocab().values(), default=0) < 1 << 16 else 4


def _byte_letters() -> dict[int, str]:
    """How byte-level vocabularies write a byte, by its Latin-1 character: printable ones as they are, the others from 256 on in order."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return {b: chr(b) if b in printable else chr(next(others)) for b in range(256)}


class _Uneven(Exception):
    """A text whose white space is not single blanks and line feeds between other characters."""


def _whole_encoder(path: str) -> Callable[[str], bytes]:
    """Ids of any text by the library, as raw bytes."""
    encode, code = tokenizer(path).encode, "H" if id_width(path) == 2 else "I"

    def encoded(text: str) -> bytes:
        ids = encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}{code}", *ids)
    return encoded


def _part_encoder(path: str) -> Callable[[str], bytes]:
    """Ids of a part that follows a blank, that blank included; of one that begins with a line feed, as it stands.

    Where the file's tokenizer is byte-level BPE by its usual pattern and nothing else, a blank and letters are one
    pre-token, which the library's model takes as it is; a line feed before other characters is one too, and so are the signs
    of punctuation that end a part. Only letters up to U+024F are told apart here; all else goes to the library whole.
    """
    whole, encoded = tokenizer(path), _whole_encoder(path)
    settings = json.loads(whole.to_str())
    before, model = settings["pre_tokenizer"] or {}, settings["model"]
    plain = (before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space") and settings["normalizer"] is None
             and model["type"] == "BPE" and not any(model.get(c) for c in ("dropout", "continuing_subword_prefix", "end_of_word_suffix")))
    letters, code, tokens = _byte_letters(), "H" if id_width(path) == 2 else "I", whole.model.tokenize
    signs: dict[str, bytes] = {}

    feed, blank, pack = encoded("\n"), letters[32], [struct.Struct(f"<{n}{code}").pack for n in range(64)]

    def word(before: str, text: str) -> bytes:
        ids = [t.id for t in tokens(before + (text if text.isascii() else text.encode().decode("latin-1").translate(letters)))]
        return pack[len(ids)](*ids) if len(ids) < 64 else struct.pack(f"<{len(ids)}{code}", *ids)

    def make(part: str) -> bytes:
        line = part[:1] == "\n"
        body = part[1:] if line else part
        if not plain or body.split() != [body]:
            raise _Uneven
        base = body.rstrip(string.punctuation)
        if not base.isalpha() or not base.isascii() and max(base) > "\u024f":
            return feed + encoded(body) if line else encoded(" " + part)
        end = body[len(base):]
        if end and end not in signs:
            if len(signs) > 4096:
                signs.clear()
            signs[end] = encoded(end)
        if line:
            return feed + word("", base) + signs.get(end, b"")
        return _part_ids(path)[base] + signs[end] if end else word(blank, base)
    return make


def _part_ids(path: str) -> Memo:
    return memo(f"part ids {path}", lambda: _part_encoder(path))


def encode_texts(texts: list[str], path: str) -> Iterator[bytes]:
    """Ids of whole texts as the library gives them, as raw little-endian bytes of ``id_width``.

    A text whose white space is single blanks and line feeds between other characters is encoded by the parts between them, each
    once for the memo; another by parts that end before a blank of that kind.
    """
    known, encoded = _part_ids(path), _whole_encoder(path)
    for text in texts:
        first, *rest = text.replace("\n", " \n").split(" ")
        try:
            if first.split() != [first] and text:
                raise _Uneven
            yield encoded(first) + b"".join(map(known.__getitem__, rest))
        except _Uneven:
            yield b"".join(map(encoded, units(text)))


# Writing and reading

def write_ids(docs: DataFrame, path: str, tokenizer_path: str, text: str = "text", doc_id: str = "doc_id", end_id: int = END_ID,
              file_bytes: int = FILE_BYTES) -> None:
    """Write the ids of all documents below ``path``, in ascending order of their ids, files in the order of their names.

    The rows are dealt to files by key range, once; a file is written as it is encoded, so that a task holds a
    directory entry per document and no payload. Rows that repeat an id lie side by side, ordered by a hash of their
    text; a frequent id may go on in the next files. Null ids come first. The text writer of Spark
    is what writes: it puts bytes as they are and the end id after each record.
    """
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    width = id_width(tokenizer_path)
    separator = end_id.to_bytes(width, "little")
    if not separator.isascii():
        raise ValueError(f"the end id {end_id} has a byte beyond ASCII, which no record separator can hold")
    total = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    files = max(2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // file_bytes))
    keyed = rows.withColumn("hash", F.xxhash64("text")).withColumn("source", F.spark_partition_id())
    order = [F.asc_nulls_first("doc_id"), F.asc("hash"), F.asc("source")]
    dealt = keyed.repartitionByRange(files, *order).sortWithinPartitions(*order).select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts = [], []
        for batch in batches:
            keys.append(batch.column(0))
            # A few records at a time: the ids of a batch may be far larger than its texts.
            for at in range(0, batch.num_rows, 256):
                made = list(encode_texts(batch.column(1).slice(at, 256).to_pylist(), tokenizer_path))
                counts += [len(m) // width + 1 for m in made]
                yield pa.RecordBatch.from_arrays([pa.array(made, pa.binary())], names=["value"])
        if keys:
            yield pa.RecordBatch.from_arrays([pa.array([_footer(pa.concat_arrays(keys), counts, width)], pa.binary())], names=["value"])

    dealt.mapInArrow(run, "value binary").select(F.col("value").cast("string").alias("value")).write.option(
        "lineSep", separator.decode()).option("compression", "none").option("maxRecordsPerFile", 0).text(path)


def _contents(spark: SparkSession, path: str) -> DataFrame:
    """file (its number) and content of all files."""
    number = F.regexp_extract("path", r"part-(\d+)[^/]*$", 1).cast("int")
    return spark.read.format("binaryFile").load(path).where("length > 0").select(number.alias("file"), "content")


def scan_ids(spark: SparkSession, path: str, key_type: str = "long") -> DataFrame:
    """Every document that the files hold: doc_id, file, place (ids before it in the file), n_tokens, ids_crc32.

    A file's keys are looked up one by one in its hash, and the ids are read from where that points; a frequent
    key's documents follow each other.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in batches:
            for number, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                file = IdFile(content.as_buffer())
                unique = file.keys.unique()
                keys, document = [], []
                for key, place in zip(unique.to_pylist(), file.places(unique.to_pylist())):
                    keys += [key] * place.copies
                    document += range(place.document, place.document + place.copies)
                crc = [zlib.crc32(file.ids(d)) for d in document]
                at = np.asarray(document, "i8")
                yield pa.RecordBatch.from_arrays([
                    pa.array(keys, file.keys.type), pa.array([number] * len(keys), pa.int32()), pa.array(file.starts[at]),
                    pa.array(np.diff(file.starts)[at]), pa.array(crc, pa.int64())], names=["doc_id", "file", "place", "n_tokens", "ids_crc32"])
    return _contents(spark, path).mapInArrow(run, f"doc_id {key_type}, file int, place long, n_tokens long, ids_crc32 long")


def fetch_ids(spark: SparkSession, path: str, keys: list, key_type: str = "long") -> DataFrame:
    """doc_id and ids (an array, with the end id) of the documents with the given keys, few enough for one list.

    Each file answers by its hash, whatever it holds; an unknown key, whose fingerprint may
    agree by chance, is told by the key itself.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(1):
                file = IdFile(content.as_buffer())
                found, ids = [], []
                for key, place in zip(keys, file.places(keys)):
                    if place and file.keys[place.document].as_py() == key:
                        found += [key] * place.copies
                        ids += [file.ids(place.document + i).astype("i8") for i in range(place.copies)]
                yield pa.RecordBatch.from_arrays([pa.array(found, file.keys.type), pa.array(ids, pa.list_(pa.int64()))], names=["doc_id", "ids"])
    return _contents(spark, path).mapInArrow(run, f"doc_id {key_type}, ids array<long>")


def document_ids(docs: DataFrame, path: str, tokenizer_path: str, text: str = "text", doc_id: str = "doc_id", end_id: int = END_ID) -> DataFrame:
    """Write the files of all documents to ``path`` and read them back: doc_id, start, n_tokens, ids_crc32.

    ``start`` is the number of ids of all documents before it, over all files. The driver takes one number per
    file. Null and empty texts are the end id alone; rows that repeat an id come back each, side by side. Other
    columns play no part, whatever their names. An empty table gives no row.
    """
    spark, key_type = docs.sparkSession, dict(docs.dtypes)[doc_id]
    write_ids(docs, path, tokenizer_path, text, doc_id, end_id)
    held = stored(scan_ids(spark, path, key_type), "read")
    sizes = sorted(tuple(r) for r in held.groupBy("file").agg(F.sum("n_tokens").alias("n")).collect())
    before = zip((f for f, _ in sizes), accumulate((n for _, n in sizes), initial=0))
    offsets = spark.createDataFrame(list(before), "file int, before long")
    return held.join(F.broadcast(offsets), "file").select("doc_id", (F.col("before") + F.col("place")).alias("start"), "n_tokens", "ids_crc32")
