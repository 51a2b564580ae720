"""Nearest neighbours by shifted space-filling curves: several Hilbert orders, windows of neighbouring keys, exact rerank."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from hubcat.operators.skew import join_unique
from hubcat.session import stored

#: Curves, coordinates of a projected vector, and bits of a coordinate on the curve's grid.
CURVES, COORDINATES, BITS = 24, 8, 6
#: A curve is cut into this many key ranges; a query sees its own and the two beside it.
RANGES = 56
#: No range is aimed to be shorter than this.
LEAST_ROWS = 256
#: Rows of a range that one task takes; a longer range is dealt out.
PIECE_ROWS = 20_000
#: Vectors that the projections' scale and the cuts between ranges are fitted on.
SAMPLE = 8_192
_TIE_BITS = 14


class Index(NamedTuple):
    """One curve per leading entry: projection, the grid's edges by coordinate, and the cuts between its ranges."""

    longest: float
    projection: np.ndarray
    edges: np.ndarray
    cuts: np.ndarray


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Positions on the Hilbert curve of grid cells (rows by coordinates), as longs.

    The axes are undone from the highest bit down: where a coordinate's bit is set, the first
    coordinate's lower bits turn over, else they trade places; then Gray code.
    """
    x = cells.astype("u4").copy()
    n, dims = x.shape
    for b in range(bits - 1, 0, -1):
        lower = np.uint32((1 << b) - 1)
        for i in range(dims):
            turned = (x[:, i] >> np.uint32(b) & 1).astype(bool)
            traded = np.where(turned, 0, (x[:, 0] ^ x[:, i]) & lower).astype("u4")
            x[:, 0] ^= np.where(turned, lower, traded).astype("u4")
            x[:, i] ^= traded
    for i in range(1, dims):
        x[:, i] ^= x[:, i - 1]
    flips = np.zeros(n, "u4")
    for b in range(bits - 1, 0, -1):
        flips ^= np.where(x[:, -1] >> np.uint32(b) & 1, np.uint32((1 << b) - 1), np.uint32(0)).astype("u4")
    x ^= flips[:, None]
    key = np.zeros(n, "i8")
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            key = key << 1 | (x[:, i] >> np.uint32(b) & 1)
    return key


def _raised(vectors: np.ndarray, longest: float, query: bool) -> np.ndarray:
    """One more coordinate, so that the nearest row on the sphere has the largest inner product."""
    length = np.linalg.norm(vectors, axis=1)
    if query:
        return np.hstack([vectors * (longest / length)[:, None], np.zeros((len(vectors), 1))])
    return np.hstack([vectors, np.sqrt(np.maximum(longest ** 2 - length ** 2, 0))[:, None]])


def _keys(index: Index, curve: int, raised: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """Keys on a curve; the low bits come from the vector's mark and the curve, so that each curve parts a dense cell another way."""
    seen = raised @ index.projection[curve]
    cells = np.stack([np.searchsorted(edges, x, side="right") for edges, x in zip(index.edges[curve], seen.T)], axis=1)
    mixed = marks ^ np.uint64((curve + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    mixed = (mixed ^ mixed >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    mixed = (mixed ^ mixed >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return hilbert_keys(cells, BITS) << _TIE_BITS | (mixed >> np.uint64(64 - _TIE_BITS)).astype("i8")


def _numbers(marks: pd.Series) -> np.ndarray:
    """The first half of each mark as a number."""
    return np.frombuffer(b"".join(marks), "<u8")[::2]


def _distinct(rows: DataFrame, is_query: Column, most: int) -> DataFrame:
    """One row per vector: its bytes, a 128-bit mark, its length, its ``most`` smallest ids, and whether any of its ids asks.

    Each batch lets at most ``most`` ids of a vector through, so that no task meets all copies of one.
    """
    def thinned(batches):
        for batch in batches:
            if batch.empty:
                continue
            x = _unpacked(batch["vector"])
            made = pd.DataFrame({"vector": [v.tobytes() for v in x], "length": np.linalg.norm(x, axis=1), "id": batch["id"], "asked": batch["asked"]})
            made["asked"] = made.groupby("vector", sort=False)["asked"].transform("any")
            yield made.drop_duplicates(["vector", "id"]).sort_values("id").groupby("vector", sort=False).head(most)

    asked = rows.select("id", "vector", F.coalesce(is_query, F.lit(False)).alias("asked"))
    return asked.mapInPandas(thinned, "vector binary, length double, id long, asked boolean").groupBy("vector").agg(
        F.max("length").alias("length"), F.slice(F.array_sort(F.collect_set("id")), 1, most).alias("ids"), F.max("asked").alias("asked")).withColumn(
        "mark", _mark())


def _mark() -> Column:
    return F.unhex(F.md5("vector"))


def _unpacked(vectors: pd.Series) -> np.ndarray:
    """Rows of doubles; a negative zero becomes a zero, so that equal vectors have equal bytes."""
    return np.stack(vectors.to_numpy()).astype("f8") + 0.0


def fit(distinct: DataFrame, seed: int = 7) -> tuple[Index, int] | None:
    """Projections, shifts and cuts from at most SAMPLE distinct vectors; length and count are those of all of them."""
    facts = distinct.agg(F.count(F.lit(1)).alias("n"), F.max("length").alias("longest")).first()
    if not facts["n"]:
        return None
    drawn = distinct.select("mark", "vector").orderBy("mark").limit(SAMPLE).toPandas().sort_values("mark")
    vectors, marks = np.frombuffer(b"".join(drawn["vector"]), "f8").reshape(len(drawn), -1), _numbers(drawn["mark"])
    raised = _raised(vectors, facts["longest"], False)
    rng, dims = np.random.default_rng(seed), raised.shape[1]
    turns, width = [], min(COORDINATES, dims)
    while len(turns) < CURVES:
        turn = np.linalg.qr(rng.normal(size=(dims, dims)))[0]
        turns += [turn[:, i:i + width] for i in range(0, dims - width + 1, width)]
    projection = np.stack(turns[:CURVES])
    seen = np.sort(np.einsum("nd,cdk->ckn", raised, projection), axis=2)
    # Edges are quantiles, so that clusters get cells by their share of the vectors and not by their width. The
    # grid is half as wide again as the data, and every curve's grid is shifted another way.
    share = 1.5 * np.arange(1, 1 << BITS) / (1 << BITS) - rng.uniform(0, 0.5, seen.shape[:2])[:, :, None]
    edges = np.take_along_axis(seen, np.clip(share * len(drawn), 0, len(drawn) - 1).astype(int), axis=2)
    edges = np.where(share <= 0, -np.inf, np.where(share >= 1, np.inf, edges))
    index = Index(facts["longest"], projection, edges, np.zeros((CURVES, 0), "i8"))
    ranges = int(max(1, min(RANGES, facts["n"] // LEAST_ROWS)))
    cuts = []
    for curve in range(CURVES):
        keys = np.sort(_keys(index, curve, raised, marks))
        cuts.append(keys[np.arange(1, ranges) * len(keys) // ranges])
    return index._replace(cuts=np.stack(cuts)), facts["n"]


def _usable(vectors: DataFrame, vector: str, vec_id: str) -> DataFrame:
    """id and vector of the rows that take part, all of the most frequent number of coordinates."""
    v = F.col("vector")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = vectors.select(F.col(f"`{vec_id}`").cast("long").alias("id"), F.col(f"`{vector}`").cast("array<double>").alias("vector")).where(
        F.col("id").isNotNull() & v.isNotNull() & (F.size(v) > 0) & finite & F.exists(v, lambda x: x != 0))
    usual = rows.groupBy(F.size("vector").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "d").first()
    return rows if usual is None else rows.where(F.size("vector") == usual["d"])


def search(vectors: DataFrame, is_query: Column, k: int, vector: str = "embedding", vec_id: str = "vec_id") -> DataFrame:
    """query_id, rank, vec_id, score: each query's ``k`` best rows found by inner product, its own left out.

    ``is_query`` is a condition on the column ``id``. Equal vectors are searched as one and come apart into
    ids after the rerank: each keeps its ``k`` + 1 smallest ids, as no query can have more of them among its
    best, and always meets itself. On every curve a distinct vector that asks meets all of its
    key range and of the two beside it; the best of all curves are merged. A range is a
    fixed share of the distinct vectors (see RANGES), since vectors without any structure need it for the
    recall; more ranges make the search cheaper where vectors form clusters. Ranges are
    dealt out in pieces of bounded size. Vectors that are null, zero, of an unusual length, or hold null or
    non-finite values take no part, nor do rows without an id. Ties go to the smaller id; rows
    that repeat an id count once, with their best score. No usable row: no result.
    """
    spark = vectors.sparkSession
    rows = _usable(vectors, vector, vec_id)
    distinct = stored(_distinct(rows, is_query, k + 1), "vectors")
    empty = "query_id long, rank int, vec_id long, score double"
    fitted = fit(distinct)
    if fitted is None:
        return spark.createDataFrame([], empty)
    index = spark.sparkContext.broadcast(fitted[0])
    ranges = fitted[0].cuts.shape[1] + 1
    pieces = -(-fitted[1] // (ranges * PIECE_ROWS))

    def placed(query: bool):
        def run(batches):
            for batch in batches:
                if batch.empty:
                    continue
                x, marks = np.frombuffer(b"".join(batch["vector"]), "f8").reshape(len(batch), -1), _numbers(batch["mark"])
                raised = _raised(x, index.value.longest, query)
                made = batch.assign(ids=[np.asarray(i, "i8").tobytes() for i in batch["ids"]])
                for curve in range(CURVES):
                    own = np.searchsorted(index.value.cuts[curve], _keys(index.value, curve, raised, marks), side="right")
                    if not query:
                        yield made.drop(columns="mark").assign(curve=curve, range=own, piece=(marks % np.uint64(pieces)).astype("i4"))
                        continue
                    for beside in (-1, 0, 1):
                        inside = (own + beside >= 0) & (own + beside < ranges)
                        for piece in range(pieces):
                            yield made.assign(curve=curve, range=own + beside, piece=piece)[inside]
        return run

    schema = "curve int, range int, piece int, ids binary, vector binary"
    candidates = distinct.select("mark", "ids", "vector").mapInPandas(placed(False), schema).groupBy("curve", "range", "piece")
    queries = distinct.where("asked").select("mark", "ids", "vector").mapInPandas(placed(True), schema + ", mark binary").groupBy("curve", "range", "piece")

    def best(asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        return _best(asked, held, k + 1)

    found = queries.cogroup(candidates).applyInPandas(best, "mark binary, vec_id long, score double")
    once = found.groupBy("mark", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("mark").orderBy(F.desc("score"), "vec_id")
    near = once.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k + 1).groupBy("mark").agg(
        F.collect_list(F.struct("vec_id", "score")).alias("near"))

    def packed(batches):
        for batch in batches:
            if not batch.empty:
                yield pd.DataFrame({"query_id": batch["id"], "vector": [v.tobytes() for v in _unpacked(batch["vector"])]})

    asking = rows.where(is_query).mapInPandas(packed, "query_id long, vector binary").select("query_id", _mark().alias("mark"))
    each = join_unique(asking, near, "mark", "inner").select("query_id", F.inline("near")).where("vec_id != query_id")
    each = each.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return each.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _best(asked: pd.DataFrame, held: pd.DataFrame, most: int) -> pd.DataFrame:
    """The best ``most`` ids of a piece for each asking vector, its own among the candidates.

    A fast product chooses vectors, one sum per pair gives the score.
    """
    if asked.empty:
        return pd.DataFrame({"mark": [], "vec_id": [], "score": []})
    q = np.frombuffer(b"".join(asked["vector"]), "f8").reshape(len(asked), -1)
    x = np.frombuffer(b"".join(held["vector"]), "f8").reshape(len(held), q.shape[1])
    ids, own_ids, marks, out = held["ids"].to_numpy(), asked["ids"].to_numpy(), asked["mark"].to_numpy(), []
    for first in range(0, len(q), 256):
        some = q[first:first + 256]
        for at, (row, query) in enumerate(zip(some @ x.T, some), first):
            wanted = most
            while True:
                chosen = np.arange(len(row))
                if len(row) > wanted:
                    least = np.partition(row, -wanted)[-wanted]
                    chosen = np.flatnonzero(row >= least - 1e-9 * max(1.0, abs(least)))
                score = (np.vstack([x[chosen], query]) * query).sum(axis=1)
                groups = [*ids[chosen], own_ids[at]]
                vec_id, score = np.frombuffer(b"".join(groups), "i8"), np.repeat(score, [len(g) // 8 for g in groups])
                order = np.lexsort((vec_id, -score))
                top = order[np.sort(np.unique(vec_id[order], return_index=True)[1])[:most]]
                # Vectors that repeat ids may hold too few different ones.
                if len(top) == most or len(chosen) == len(row):
                    break
                wanted *= 2
            out.append(pd.DataFrame({"mark": marks[at], "vec_id": vec_id[top], "score": score[top]}))
    return pd.concat(out)
