"""Sharding by histogram sort: exact weights below probes, refined until the splitters fit, then one exchange."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from hubcat.session import stored

#: New probes in each open interval and round.
PROBES = 16
#: A shard's boundary may miss its aim by this share of a shard's weight.
TOLERANCE = 0.001
#: Rows in one sort range; a shard is made of as many ranges as it needs.
RANGE_ROWS = 500_000
_SCHEMA = "bucket int, slot int, weight long, rows long, mixed long, key binary"


class Cut(NamedTuple):
    """A key, and the rows and weight of all keys below it."""

    key: bytes
    rows: int
    weight: int


START = Cut(b"", 0, 0)
#: A sort key's two longs, and the row's own number, by which rows with equal ones can part.
KEY_BYTES = 24


def sort_key(first: Column, second: Column) -> Column:
    """16 bytes that sort as the two longs do, null as the smallest long; ``second`` breaks the ties of ``first``."""
    return F.concat(_eight_bytes(first), _eight_bytes(second))


def _eight_bytes(c: Column) -> Column:
    low = F.lit(-(2 ** 63))
    return F.unhex(F.lpad(F.hex(F.coalesce(c.cast("long"), low).bitwiseXOR(low)), 16, "0"))


def _keys(keys: list[bytes] | pd.Series) -> np.ndarray:
    """Keys of one length, which compare byte by byte."""
    return np.frombuffer(b"".join(keys), f"S{KEY_BYTES}")


def _bucket(keys: np.ndarray, probes: np.ndarray) -> np.ndarray:
    """Number of probes at or below each key."""
    return np.searchsorted(probes, keys, side="right")


def _histogram(probes: list[bytes], wanted: set[int]) -> Callable:
    """A task's weight and rows by bucket (slot -1), and candidate keys out of the wanted buckets.

    A candidate is the key with the smallest hash of its slot: an even sample of the bucket,
    whatever the shape of the keys. The bucket's own lower probe is no candidate.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        marks, parts = _keys(probes), []
        for batch in batches:
            if batch.empty:
                continue
            keys = _keys(batch["key"])
            bucket = _bucket(keys, marks)
            sums = pd.DataFrame({"bucket": bucket, "weight": batch["weight"].to_numpy(), "rows": 1}).groupby("bucket", as_index=False).sum()
            parts.append(sums.assign(slot=-1, mixed=-1, key=b""))
            inner = np.isin(bucket, list(wanted))
            if len(marks):
                inner &= ~((bucket > 0) & (marks[bucket - 1] == keys))
            part = keys.view(">u8").reshape(-1, 3).astype("u8")
            mixed = ((part[:, 0] * np.uint64(0x9E3779B97F4A7C15) ^ part[:, 1]) * np.uint64(0xBF58476D1CE4E5B9) ^ part[:, 2]) * np.uint64(0xD6E8FEB86659FD93)
            mixed = (mixed ^ mixed >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(1)
            rows = np.flatnonzero(inner)
            drawn = pd.DataFrame({"bucket": bucket[rows], "slot": (mixed[rows] % np.uint64(PROBES)).astype("i8"),
                                  "mixed": mixed[rows].astype("i8"), "key": batch["key"].to_numpy()[rows]})
            drawn = drawn.sort_values("mixed").drop_duplicates(["bucket", "slot"])
            parts.append(drawn.assign(weight=0, rows=0))
            if len(parts) > 64:
                parts = [_folded(parts)]
        if parts:
            yield _folded(parts)[["bucket", "slot", "weight", "rows", "mixed", "key"]]
    return run


def _folded(parts: list[pd.DataFrame]) -> pd.DataFrame:
    both = pd.concat(parts).sort_values("mixed")
    return both.groupby(["bucket", "slot"], as_index=False).agg(
        {"weight": "sum", "rows": "sum", "mixed": "first", "key": "first"})


def _measure(keys: DataFrame, probes: list[bytes], wanted: set[int] = frozenset()) -> tuple[list[Cut], dict[int, set[bytes]], Cut]:
    """The cuts at the probes, candidate keys by wanted bucket, and the end of the table.

    The driver gets rows by probe and wanted bucket, whatever the size of the table.
    """
    got = (
        keys.mapInPandas(_histogram(probes, wanted), _SCHEMA).groupBy("bucket", "slot")
        .agg(F.sum("weight").alias("weight"), F.sum("rows").alias("rows"), F.min(F.struct("mixed", "key")).alias("best"))
        .collect()
    )
    inside = {r["bucket"]: r for r in got if r["slot"] < 0}
    found: dict[int, set[bytes]] = {}
    for r in got:
        if r["slot"] >= 0:
            found.setdefault(r["bucket"], set()).add(bytes(r["best"]["key"]))
    cuts, rows, weight = [], 0, 0
    for i in range(len(probes) + 1):
        if i in inside:
            rows, weight = rows + inside[i]["rows"], weight + inside[i]["weight"]
        cuts.append(Cut(probes[i] if i < len(probes) else b"\xff" * (KEY_BYTES + 1), rows, weight))
    return cuts[:-1], found, cuts[-1]


def splitters(keys: DataFrame, shards: int, tolerance: float = TOLERANCE) -> tuple[list[Cut], Cut]:
    """The cuts between the shards, and the end of the table.

    Each round puts new probes between the two cuts around an aim and counts the exact weight
    below each, until a cut is near enough or no other key lies between them.
    """
    cuts, _, end = _measure(keys, [])
    aims = [end.weight * i / shards for i in range(1, shards)]
    near = tolerance * end.weight / shards
    while True:
        edges = [START, *cuts, end]
        around = [max(i for i, c in enumerate(edges) if c.weight <= aim) for aim in aims]
        best = [min(edges[i:i + 2], key=lambda c: abs(c.weight - aim)) for i, aim in zip(around, aims)]
        open_ = {i for i, c, aim in zip(around, best, aims) if abs(c.weight - aim) > near and i < len(cuts) + 1}
        if not open_:
            return best, end
        _, found, _ = _measure(keys, [c.key for c in cuts], open_)
        new = set().union(*found.values())
        if not new:
            return best, end
        held = {c.key for i in around for c in edges[i:i + 2]} - {START.key, end.key}
        cuts, _, _ = _measure(keys, sorted(held | new))


def _ranges(keys: DataFrame, cuts: list[Cut], end: Cut, most: int) -> list[Cut]:
    """Starts of the sort ranges: the shards' cuts, and keys between them where a range is longer than ``most`` rows."""
    starts = sorted({START, *(c for c in cuts if c.rows < end.rows)})
    while True:
        stops = [*starts[1:], end]
        long = {i for i, (a, b) in enumerate(zip(starts, stops)) if b.rows - a.rows > most}
        if not long:
            return starts
        _, found, _ = _measure(keys, [c.key for c in starts[1:]], long)
        marks = {c.key for c in starts[1:]}.union(*found.values())
        counted, _, _ = _measure(keys, sorted(marks))
        starts = sorted({START, *(c for c in counted if c.rows < end.rows)})


def histogram_shards(rows: DataFrame, key: Column, weight: Column, shards: int, tolerance: float = TOLERANCE,
                     range_rows: int = RANGE_ROWS) -> DataFrame:
    """All columns of ``rows``, then ``shard`` (from 0) and ``slot`` (gapless from 0 in each shard).

    ``key`` is a ``sort_key``, ``weight`` a long of 0 or more. Shards are runs of the key order with
    near equal weights: a cut misses its aim by the tolerance, or by half the weight of the row it
    falls on. The rows are written once, which gives each a number of its own: rows with equal keys follow each other by it,
    so that a cut may part them, however many they are. Fewer rows
    than shards leave shards empty, an empty table gives no row. Columns of ``rows`` that are called ``shard`` or
    ``slot`` give way to the new ones. Keys and weights alone are read again and again; the rows move once, in
    ranges of bounded length: of ``range_rows``, or, of large tables, of a quarter of a partition's even share, so that what
    the driver sees in a round grows with the shards and partitions, not with the rows.
    """
    kept = [c for c in rows.columns if c not in ("shard", "slot")]
    written = stored(rows.select(F.struct(*(F.col(f"`{c}`") for c in kept)).alias("row"), key.alias("key"), weight.cast("long").alias("weight"),
                                 F.monotonically_increasing_id().alias("number")), "rows")
    whole = F.concat("key", _eight_bytes(F.col("number")))
    keys = written.select(whole.alias("key"), "weight")
    cuts, end = splitters(keys, shards, tolerance)
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    starts = _ranges(keys, cuts, end, max(range_rows, end.rows // (4 * parts)))
    marks = [c.key for c in starts[1:]]
    first = [START, *cuts]
    owner = [sum(c <= start for c in cuts) for start in starts]
    ahead = [start.rows - first[shard].rows for start, shard in zip(starts, owner)]

    @F.pandas_udf("struct<range:int,shard:int,ahead:long>")
    def place(key: pd.Series) -> pd.DataFrame:
        found = _bucket(_keys(key), _keys(marks))
        return pd.DataFrame({"range": found, "shard": np.take(owner, found), "ahead": np.take(ahead, found)})

    placed = written.select("row", whole.alias("key")).select("row", "key", place("key").alias("at"))
    inside = Window.partitionBy("at.range").orderBy("key")
    return placed.select("row.*", F.col("at.shard").alias("shard"),
                         (F.col("at.ahead") + F.row_number().over(inside) - 1).alias("slot"))
