"""Repeated passages: sparse suffixes sorted in runs, exchanged front-coded, and merged without comparing known prefixes again."""

from __future__ import annotations

import struct
from array import array
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from hubcat.llm.jaccard_join import blocks_of, in_bitmap
from hubcat.operators.ordering import range_sorted

#: Bytes of a passage that counts as repeated.
LENGTH = 100
#: Bytes of the gram that anchors a passage; a passage is found by the least gram in it.
GRAM = 32
#: A gram with more places than this is exchanged passage by passage, so that no task gets all of them.
HEAVY = 50_000
#: Bytes of text in a block at most, about; a block and its suffixes are one group of a task.
BLOCK_BYTES = 24_000_000
#: Windows of a text that are hashed at a time.
STRETCH = 1 << 19
#: In groups of at most so many different places every two are compared.
FEW = 8

#: A place: id, occurrence, anchor, block.
_PLACE = ">QQQI"
_PLACE_BYTES = struct.calcsize(_PLACE)
_HEAD = 2
_TABLE = np.random.default_rng(20).integers(1 << 63, size=256, dtype="u8") * np.uint64(2) + np.uint64(1)
_MULTIPLIER = 0x9E3779B97F4A7C15
_SPAN = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
_POSITION = np.uint64((1 << 20) - 1)


# Anchors: equal passages choose the same gram, so passages can only be equal where their grams are

def _segments(text: bytes, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """(first, last, anchor, hash) of the runs of windows that share their least gram.

    A window is the passage of ``length`` bytes at a start; its least gram is chosen by hash, the leftmost of equals.
    """
    parts = [_stretch(text[at:at + STRETCH + length - 1], at, length, gram) for at in range(0, len(text) - length + 1, STRETCH)]
    if not parts:
        return tuple(np.zeros(0, t) for t in ("i8", "i8", "i8", "u8"))
    return tuple(np.concatenate(column) for column in zip(*parts))


def _stretch(text: bytes, offset: int, length: int, gram: int) -> tuple[np.ndarray, ...]:
    h, width, power = _TABLE[np.frombuffer(text, "u1")], 1, _MULTIPLIER
    while width < gram:
        step = min(width, gram - width)
        if step == width:
            h = h[:-width] * np.uint64(power) + h[width:]
            power = power * power & (1 << 64) - 1
        else:
            h = h[:-step] + h[step:] * np.uint64(power)
        width += step
    h = (h ^ h >> np.uint64(31)) * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    least = (h & ~_POSITION) | np.arange(len(h), dtype="u8")
    window, width = length - gram + 1, 1
    while width < window:
        step = min(width, window - width)
        least = np.minimum(least[:-step], least[step:])
        width += step
    anchor = (least & _POSITION).astype("i8")
    new = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
    last = np.r_[new[1:], len(anchor)] - 1
    return new + offset, last + offset, anchor[new] + offset, h[anchor[new]]


def _bodies(table: pa.Table, name: str) -> list[bytes]:
    """The texts in the rows of a block, null as empty."""
    return [t or b"" for chunk in table.column("row").chunks for t in chunk.field(name).cast(pa.binary()).to_pylist()]


def _documents(table: pa.Table, name: str) -> list[tuple[int, int, int, bytes]]:
    """(row, id, occurrence, text) of a block in the order of ids; rows without an id come first."""
    places = [-(1 << 63) if i is None else i for i in table.column("id").to_pylist()]
    occurrences, bodies = table.column("occurrence").to_pylist(), _bodies(table, name)
    return [(row, places[row] + (1 << 63), occurrences[row], bodies[row]) for row in sorted(range(len(places)), key=lambda r: (places[r], occurrences[r]))]


def _split(values: np.ndarray, parts: int) -> np.ndarray:
    """Parts of gram hashes. Those are least ones, so they are hashed again to fill all parts alike."""
    mixed = (values ^ values >> np.uint64(33)) * np.uint64(0xBF58476D1CE4E5B9)
    mixed = (mixed ^ mixed >> np.uint64(29)) * np.uint64(_MULTIPLIER)
    return ((mixed >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype("i8")


def _grams(name: str, length: int, gram: int, parts: int):
    """A block's distinct grams and their numbers of places, dealt out by hash."""
    def run(table: pa.Table) -> pa.Table:
        block = table.column("block")[0].as_py()
        held = [_segments(body, length, gram)[3] for body in _bodies(table, name)]
        grams, places = np.unique(np.concatenate(held), return_counts=True)
        part = _split(grams, parts)
        order = np.argsort(part, kind="stable")
        grams, places, part = grams[order], places[order], part[order]
        cut = np.searchsorted(part, np.arange(parts + 1))
        rows = []
        for p in range(parts):
            some, times = grams[cut[p]:cut[p + 1]], places[cut[p]:cut[p + 1]]
            if len(some):
                often = times > 1
                rows.append((p, block, some[~often].tobytes(), some[often].tobytes(), times[often].astype("u4").tobytes()))
        return _as_table(rows, _GRAMS)
    return run


_GRAMS = [("part", pa.int32()), ("block", pa.int32()), ("once", pa.binary()), ("often", pa.binary()), ("times", pa.binary())]
_REPEATED = [("block", pa.int32()), ("grams", pa.binary()), ("heavy", pa.binary())]
_RUNS = [("part", pa.int32()), ("block", pa.int32()), ("known", pa.binary()), ("sizes", pa.binary()), ("rest", pa.binary())]
_SPANS = [("block", pa.int32()), ("spans", pa.binary())]


def _as_table(rows: list[tuple], columns: list[tuple[str, pa.DataType]]) -> pa.Table:
    parts = zip(*rows) if rows else [()] * len(columns)
    return pa.table([pa.array(list(c), t) for c, (_, t) in zip(parts, columns)], names=[n for n, _ in columns])


def _ddl(columns: list[tuple[str, pa.DataType]]) -> str:
    return ", ".join(f"{n} {'int' if t == pa.int32() else 'binary'}" for n, t in columns)


def _repeated(heavy: int):
    """To each block, which of its grams have more than one place, and which of them very many."""
    def run(table: pa.Table) -> pa.Table:
        grams, times, owner = [], [], []
        blocks = table.column("block").to_pylist()
        for k, (once, often, n) in enumerate(zip(*(table.column(c).to_pylist() for c in ("once", "often", "times")))):
            grams += [np.frombuffer(once, "u8"), np.frombuffer(often, "u8")]
            times += [np.ones(len(once) // 8, "i8"), np.frombuffer(n, "u4").astype("i8")]
            owner.append(np.full((len(once) + len(often)) // 8, k))
        gram, owned = np.concatenate(grams), np.concatenate(owner)
        _, back = np.unique(gram, return_inverse=True)
        total = np.bincount(back, np.concatenate(times))[back]
        rows = []
        for k, block in enumerate(blocks):
            low, high = np.searchsorted(owned, [k, k + 1])
            mine = low + np.flatnonzero(total[low:high] > 1)
            if len(mine):
                rows.append((block, gram[mine].tobytes(), gram[mine[total[mine] > heavy]].tobytes()))
        return _as_table(rows, _REPEATED)
    return run


# Runs: each block sorts its suffixes and sends them front-coded

def _key(text: bytes, first: int, last: int, anchor: int, length: int, gram: int) -> bytes:
    """The suffix at an anchor as far as the segment reaches, then what the segment has before it."""
    end = last + length
    return b"".join((text[anchor:anchor + gram], bytes((end - anchor, anchor - first)), text[anchor + gram:end], text[first:anchor]))


def common_prefix(a: bytes, b: bytes, known: int) -> int:
    """Length of the common prefix of two different strings that are known to share ``known`` bytes."""
    i = known
    while a[i:i + 16] == b[i:i + 16] and i < len(a):
        i += 16
    most = min(len(a), len(b))
    while i < most and a[i] == b[i]:
        i += 1
    return min(i, most)


def front_coded(items: list[bytes]) -> tuple[bytes, bytes, bytes]:
    """Sorted different strings as shared lengths with the one before, lengths of the rest, and the rests."""
    known, rests, before = bytearray(), [], b""
    for item in items:
        shared = common_prefix(before, item, 0) if before else 0
        known.append(shared)
        rests.append(item[shared:])
        before = item
    return bytes(known), bytes(map(len, rests)), b"".join(rests)


def decoded(known: bytes, sizes: bytes, rest: bytes) -> Iterator[tuple[bytes, int]]:
    """The strings of a run, each with the length it shares with the one before."""
    at, item = 0, b""
    for shared, size in zip(known, sizes):
        item = item[:shared] + rest[at:at + size]
        at += size
        yield item, shared


def _sorted_runs(name: str, length: int, gram: int, parts: int):
    """A block's suffixes in sorted runs by part; of equal segments the first place goes on, the others are spans."""
    def run(texts: pa.Table, repeated: pa.Table) -> pa.Table:
        if not texts.num_rows or not repeated.num_rows:
            return _as_table([], _RUNS)
        block = texts.column("block")[0].as_py()
        wanted = np.sort(np.frombuffer(b"".join(repeated.column("grams").to_pylist()), "u8"))
        heavy = np.sort(np.frombuffer(b"".join(repeated.column("heavy").to_pylist()), "u8"))
        items: dict[int, list[bytes]] = defaultdict(list)
        for _, document, occurrence, text in _documents(texts, name):
            first, last, anchor, h = _segments(text, length, gram)
            keep = _among(h, wanted)
            part, each = _split(h, parts), _among(h, heavy)
            for a, b, c, p, alone in zip(first[keep].tolist(), last[keep].tolist(), anchor[keep].tolist(), part[keep].tolist(), each[keep].tolist()):
                place = struct.pack(_PLACE, document, occurrence, c, block)
                if not alone:
                    items[p].append(_key(text, a, b, c, length, gram) + place)
                    continue
                for start in range(a, b + 1):
                    key = _key(text, start, start, c, length, gram)
                    items[parts + xxhash.xxh3_64_intdigest(key) % parts].append(key + place)
        rows, spans = [], Spans()
        for part in list(items):
            some = items.pop(part)
            some.sort()
            kept, before = [], None
            for item in some:
                key = item[:-_PLACE_BYTES]
                if key == before:
                    spans.whole(item, gram)
                else:
                    kept.append(item)
                before = key
            rows.append((part, block, *front_coded(kept)))
        # Spans travel with the runs, marked by a part below zero.
        rows += [(-1 - block, block, b"", b"", data) for block, data in spans.rows()]
        return _as_table(rows, _RUNS)
    return run


def _among(values: np.ndarray, sorted_: np.ndarray) -> np.ndarray:
    if not len(sorted_):
        return np.zeros(len(values), bool)
    return sorted_[np.minimum(np.searchsorted(sorted_, values), len(sorted_) - 1)] == values


class Spans:
    """Removed spans by block: id, occurrence, start and end."""

    def __init__(self):
        self._held: dict[int, array] = defaultdict(lambda: array("Q"))

    def whole(self, item: bytes, gram: int) -> None:
        right, left = item[gram], item[gram + 1]
        self.part(item, left, right)

    def part(self, item: bytes, left: int, right: int) -> None:
        """``left`` bytes before and ``right`` bytes from the item's anchor on."""
        name, occurrence, anchor, block = struct.unpack(_PLACE, item[-_PLACE_BYTES:])
        self._held[block].extend((name, occurrence, anchor - left, anchor + right))

    def rows(self) -> list[tuple[int, bytes]]:
        return [(block, spans.tobytes()) for block, spans in self._held.items()]


# Merging

def merged(runs: list[Iterator[tuple[bytes, int]]]) -> Iterator[tuple[bytes, int]]:
    """All strings of sorted runs in order, each with the length that it shares with the one before.

    A tree of losers: every inner node keeps the string that lost there and what it shares with the
    winner that passed. On a winner's way its successor meets strings whose shared length with that winner is
    known: the longer one wins unseen, and only equals are compared, from there on.
    """
    k = 1
    while k < len(runs):
        k *= 2
    runs = runs + [iter(())] * (k - len(runs))
    done = (None, 0)
    head = [next(run, done) for run in runs]
    loser = [0] * k
    shares = [0] * k

    def play(node: int) -> int:
        if node >= k:
            return node - k
        a, b = play(2 * node), play(2 * node + 1)
        if head[b][0] is None or head[a][0] is not None and head[a][0] <= head[b][0]:
            win, lose = a, b
        else:
            win, lose = b, a
        loser[node] = lose
        if head[lose][0] is not None:
            shares[node] = common_prefix(head[win][0], head[lose][0], 0)
        return win

    winner = play(1) if k > 1 else 0
    shared = 0
    while head[winner][0] is not None:
        yield head[winner][0], shared
        head[winner] = next(runs[winner], done)
        item, shared = head[winner]
        node = (winner + k) >> 1
        while node:
            other = loser[node]
            rival = head[other][0]
            if rival is not None:
                if item is None or shares[node] > shared:
                    loser[node], winner = winner, other
                    item, shared, shares[node] = rival, shares[node], shared
                elif shares[node] == shared:
                    both = common_prefix(item, rival, shared)
                    if item[both:both + 1] > rival[both:both + 1]:
                        loser[node], winner = winner, other
                        item = rival
                    shares[node] = both
            node >>= 1


def _merge(length: int, gram: int, parts: int):
    """Spans of everything that an earlier place repeats, by block."""
    def run(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        if part < 0:
            return _as_table(list(zip(table.column("block").to_pylist(), table.column("rest").to_pylist())), _SPANS)
        runs = [decoded(*row) for row in zip(*(table.column(c).to_pylist() for c in ("known", "sizes", "rest")))]
        spans, group = Spans(), []
        size = 0
        for item, shared in merged(runs):
            if shared < gram or part >= parts:
                _resolve(group, spans, length, gram)
                group = []
            if group and shared >= size or part >= parts and shared >= length + _HEAD:
                spans.whole(item, gram)
                continue
            size = len(item) - _PLACE_BYTES
            group.append(item)
        _resolve(group, spans, length, gram)
        return _as_table(spans.rows(), _SPANS)
    return run


def _resolve(group: list[bytes], spans: Spans, length: int, gram: int) -> None:
    """Different segments around one gram: what each shares with an earlier one on both sides of it."""
    if len(group) < 2:
        return
    placed = sorted(group, key=lambda item: item[-_PLACE_BYTES:])
    sides = []
    for item in placed:
        right, left = item[gram], item[gram + 1]
        body = item[:gram] + item[gram + _HEAD:-_PLACE_BYTES]
        sides.append((body[:right], body[right:right + left]))
    if len(placed) <= FEW:
        for i in range(1, len(placed)):
            right, left = sides[i]
            for other_right, other_left in sides[:i]:
                after = len(right) if right == other_right else _shared(right, other_right, gram)
                ahead = _shared(left[::-1], other_left[::-1], 0)
                if after + ahead >= length:
                    spans.part(placed[i], ahead, after)
        return
    for ahead in range(length - gram + 1):
        seen = set()
        for item, (right, left) in zip(placed, sides):
            if len(left) >= ahead and len(right) >= length - ahead:
                window = left[len(left) - ahead:] + right[:length - ahead]
                if window in seen:
                    spans.part(item, ahead, length - ahead)
                else:
                    seen.add(window)


def _shared(a: bytes, b: bytes, known: int) -> int:
    most = min(len(a), len(b))
    if a[:most] == b[:most]:
        return most
    return common_prefix(a, b, known)


# Texts without what is repeated

def _cleaned(name: str, fields: pa.Schema):
    as_text = pa.types.is_string(fields.field("kept").type)

    def run(texts: pa.Table, removed: pa.Table) -> pa.Table:
        if not texts.num_rows:
            return fields.empty_table()
        spans = np.frombuffer(b"".join(removed.column("spans").to_pylist()), "u8").reshape(-1, 4)
        spans = spans[np.lexsort((spans[:, 2], spans[:, 1], spans[:, 0]))]
        where = defaultdict(list)
        for document, occurrence, start, end in spans.tolist():
            runs = where[document, occurrence]
            if runs and start <= runs[-1][1]:
                runs[-1][1] = max(runs[-1][1], end)
            else:
                runs.append([start, end])
        rows, kept, cut = [], [], []
        for row, document, occurrence, text in _documents(texts, name):
            runs = where.get((document, occurrence), [])
            ends = [0, *(e for _, e in runs)]
            rows.append(row)
            stays = b"".join(text[a:b] for a, b in zip(ends, [*(s for s, _ in runs), len(text)]))
            kept.append(stays.decode("utf-8", "ignore") if as_text else stays)
            cut.append([{"start": s, "end": e} for s, e in runs])
        return pa.Table.from_arrays([texts.column("row").combine_chunks().take(pa.array(rows)), pa.array(kept, fields.field("kept").type),
                                     pa.array(cut, fields.field("spans").type)], schema=fields)
    return run


def dealt(docs: DataFrame, text: str, doc_id: str, blocks: int) -> DataFrame:
    """block, id, occurrence (the order among rows of one id) and row of each document.

    An id that is surely not repeated needs no order. All others are sorted by id and text over all tasks, and
    dealt out by their place, so that neither a repeated id nor copies of one text meet in a block.
    """
    given = F.col(f"`{doc_id}`").cast("long")
    rows = docs.select(given.alias("id"), F.xxhash64(given).alias("id_hash"), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    # The smallest long shares its place with rows that lack an id.
    several = F.col("id").isNull() | (F.col("id") == F.lit(-(1 << 63)))
    repeated = in_bitmap(rows.where(~several).groupBy("id_hash").count().where("count > 1"), "id_hash")
    if repeated is not None:
        several = several | repeated
    single = rows.where(~several).select(F.pmod("id_hash", F.lit(blocks)).cast("int").alias("block"), "id", F.lit(0).cast("long").alias("occurrence"), "row")
    if repeated is None and rows.where(several).isEmpty():
        return single
    body = F.coalesce(F.col("row").getField(text).cast("binary"), F.lit(b""))
    ordered = range_sorted(rows.where(several).select("id", "row"), [F.col("id").asc_nulls_first(), body.asc()])
    return single.unionByName(ordered.select(
        F.pmod(F.xxhash64("id", "__id"), F.lit(blocks)).cast("int").alias("block"), "id", F.col("__id").alias("occurrence"), "row"))


def remove_repeats(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", length: int = LENGTH, gram: int = GRAM,
                   heavy: int = HEAVY, as_text: bool = False) -> DataFrame:
    """row (all columns of ``docs``), kept (bytes that stay), spans (start and end of each maximal removed run).

    With ``as_text`` kept is a string, without the characters that a cut went through.

    A byte goes when it lies in a string of ``length`` bytes that also starts earlier: in a document with a smaller
    id, or earlier in its own. Null counts as empty; texts shorter than ``length`` stay. Rows without an id come
    before all others; rows that repeat an id follow the order of their texts. Ids are whole numbers.

    1. Texts are dealt to blocks of bounded size by id, once: the three passes over them share that exchange.
       Rows whose id is missing or may be repeated are put in order first, and dealt out by their place in it.
    2. A passage is anchored at its least gram. Blocks report their grams' hashes, and learn which
       have another place anywhere; all other passages are unique.
    3. Blocks sort the suffixes at such anchors, with the bytes before them as far as passages reach,
       drop repeats, and send front-coded runs by gram. Runs are merged by a tree of losers. Equal segments are
       neighbours there: all but the first place are repeated whole. Different segments around one gram
       are compared on both its sides.
    4. A gram with more than ``heavy`` places is sent passage by passage, dealt out by content.
    """
    blocks = parts = blocks_of(docs, text, BLOCK_BYTES)
    texts = dealt(docs, text, doc_id, blocks)
    grams = texts.groupBy("block").applyInArrow(_grams(text, length, gram, parts), _ddl(_GRAMS))
    repeated = grams.groupBy("part").applyInArrow(_repeated(heavy), _ddl(_REPEATED))
    runs = texts.groupBy("block").cogroup(repeated.groupBy("block")).applyInArrow(_sorted_runs(text, length, gram, parts), _ddl(_RUNS))
    spans = runs.groupBy("part").applyInArrow(_merge(length, gram, parts), _ddl(_SPANS))
    made = T.StructType([texts.schema["row"], T.StructField("kept", T.StringType() if as_text else T.BinaryType()), T.StructField("spans", T.ArrayType(_SPAN))])
    return texts.groupBy("block").cogroup(spans.groupBy("block")).applyInArrow(_cleaned(text, to_arrow_schema(made)), made)
