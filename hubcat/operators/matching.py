"""Term vectors and the best taxonomy node per term."""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from hubcat import spec
from hubcat.operators.skew import join_unique
from hubcat.operators.taxonomy import NODE_FIELDS
from hubcat.session import stored

# The node matrix goes to every executor only up to these sizes (64 MB of doubles).
BROADCAST_NODES = 20_000
BROADCAST_VALUES = 8_000_000
# Words whose vectors may go to every executor, up to the values above, and their longest name.
FREQUENT_WORDS, WORD_BYTES = 200_000, 100
# Similarities computed at a time in a task, and the block sizes beyond the broadcast.
TASK_VALUES = 2_000_000
BLOCK_NODES = 4096
BLOCK_TERMS = 20_000
# From so many nodes on they are searched by clusters; terms are taken by so many at a time then.
CLUSTERED_NODES = 2048
CLUSTER_TERMS = 4096
# Decimals kept of a similarity, so that ties do not depend on summation order.
SIMILARITY_DECIMALS = 12

# Workers get the small kernels below with the task; they need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_KEY, _BREAK = "__term", r"[^\p{L}\p{N}]+"
_BEST = "term string, ordinal long, score double"


def tokens(terms: DataFrame, lowercase: bool = False) -> DataFrame:
    """(term, token) rows: runs of letters and digits."""
    text = F.lower("term") if lowercase else F.col("term")
    return terms.select("term", F.explode_outer(F.split(text, _BREAK)).alias("token")).where(
        F.col("token") != "")


def term_vectors(terms: DataFrame, word_vectors: DataFrame, lowercase: bool = False) -> DataFrame:
    """Mean word vector of each distinct term; terms without a known word drop out.

    ``word_vectors(token, vector)`` has one row per token, all of one length. Unknown words only rescale the
    mean, which leaves every cosine as it is. The most frequent words, as many as may be broadcast, are added up where a
    term lies, and move nothing. Rare words carry a 128-bit key of their term, not its text. Their weighted vectors are
    added up as Arrow matrices, whatever their width: each batch first for itself, then by key behind one exchange, in
    which the term's text meets its sums. Where frequent words are few of all, as in a list of words, all go that way.
    """
    named = terms.where(F.col("term").isNotNull()).select("term").distinct().select(F.unhex(F.md5("term")).alias(_KEY), "term")
    text = F.lower("term") if lowercase else F.col("term")
    vectors = word_vectors.select("token", F.col("vector").cast("array<double>").alias("v")).where(F.col("v").isNotNull())
    head, every = _frequent(terms, vectors, lowercase)
    shared = terms.sparkSession.sparkContext.broadcast(head)
    sums = f"{_KEY} binary, term string, n double, v array<double>"
    if head is not None:
        rows = named.select(_KEY, "term", F.split(text, _BREAK).alias("words")).mapInArrow(_frequent_sums(shared), sums)
        if every:
            return rows.mapInArrow(_means, "term string, vector array<double>")
    else:
        rows = named.select(_KEY, "term", F.lit(None).cast("double").alias("n"), F.lit(None).cast("array<double>").alias("v"))
    counted = named.select(_KEY, F.split(text, _BREAK).alias("words")).mapInArrow(_rare_words(shared), f"{_KEY} binary, token string, n double")
    found = join_unique(counted, vectors, "token", "inner").select(_KEY, "n", "v")
    partial = found.mapInArrow(_partial_sums, f"{_KEY} binary, n double, v array<double>")
    rows = rows.unionByName(partial.withColumn("term", F.lit(None).cast("string")))
    return rows.repartition(_KEY).sortWithinPartitions(_KEY, F.col("term").isNull()).mapInArrow(_means, "term string, vector array<double>")


def _frequent(terms: DataFrame, vectors: DataFrame, lowercase: bool) -> tuple[tuple[pa.Array, np.ndarray, np.ndarray] | None, bool]:
    """The most frequent words with their vectors and numbers of rows, none if they are under half of all; and whether no other word occurs."""
    words = stored(tokens(terms, lowercase).groupBy("token").agg(F.count(F.lit(1)).alias("n")), "words")
    usable = F.octet_length("token") <= WORD_BYTES
    counts = words.groupBy(F.when(usable, F.col("n")).otherwise(F.lit(0)).alias("least")).agg(F.count(F.lit(1)).alias("words"), F.sum("n").alias("uses")).collect()
    counts = sorted(counts, reverse=True)

    def bound(most: int) -> tuple[int, float, bool]:
        """The least number of uses of at most so many words, their share of all uses, whether they are all words."""
        least, held, uses = sys.maxsize, 0, 0
        for row in counts:
            if not row["least"] or held + row["words"] > most:
                break
            least, held, uses = row["least"], held + row["words"], uses + row["uses"]
        return least, uses / max(1, sum(r["uses"] for r in counts)), held == sum(r["words"] for r in counts)

    least, share, every = bound(FREQUENT_WORDS)
    if share < 0.5:
        return None, False
    chosen = words.where(usable & (F.col("n") >= least)).select("token", "n")
    found = stored(vectors.join(F.broadcast(chosen), "token"), "frequent")
    size = found.agg(F.coalesce(F.max(F.size("v")), F.lit(0)).alias("width"), F.coalesce(F.sum(F.size("v")), F.lit(0)).alias("values")).first()
    if size["values"] > BROADCAST_VALUES:
        least, share, every = bound(BROADCAST_VALUES // size["width"])
        if share < 0.25:
            return None, False
    held = found.where(F.col("n") >= least).select("token", "v").toArrow()
    if not held.num_rows:
        return (pa.array([], pa.string()), np.zeros((0, 1)), np.zeros(0)), every
    names = held.column("token").combine_chunks().cast(pa.string()).dictionary_encode()
    at, width = names.indices.to_numpy(), len(held.column("v")[0])
    matrix, weight = np.zeros((len(names.dictionary), width)), np.bincount(at).astype(np.float64)
    np.add.at(matrix, at, _rows_to_matrix(held.column("v").combine_chunks(), width))
    return (names.dictionary, matrix, weight), every


def _frequent_sums(shared):
    """Weights and vectors of a term's frequent words, added up; null where it has none."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, matrix, weight = shared.value
        step = max(1, TASK_VALUES // matrix.shape[1])
        for batch in batches:
            words = batch.column(2)
            row = np.repeat(np.arange(len(words)), pc.list_value_length(words).to_numpy())
            at = pc.fill_null(pc.index_in(words.flatten(), value_set=names), -1).to_numpy()
            row, at = row[at >= 0], at[at >= 0]
            sums, n = np.zeros((len(words), matrix.shape[1])), np.bincount(row, weight[at], len(words))
            for lo in range(0, len(at), step):
                some = row[lo:lo + step]
                first = np.flatnonzero(np.r_[True, some[1:] != some[:-1]])
                sums[some[first]] += np.add.reduceat(matrix[at[lo:lo + step]], first, axis=0)
            none = n == 0
            offsets = np.r_[0, np.cumsum(np.where(none, 0, sums.shape[1]))].astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(sums[~none].ravel()), mask=pa.array(none))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, mask=none), lists], names=[_KEY, "term", "n", "v"])
    return run


def _rare_words(shared):
    """(key, token, n): the words of each term that are not frequent ones."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = pa.array([""] if shared.value is None else ["", *shared.value[0].to_pylist()], pa.string())
        for batch in batches:
            words = batch.column(1)
            row = np.repeat(np.arange(len(words)), pc.list_value_length(words).to_numpy())
            rare = pc.is_null(pc.index_in(words.flatten(), value_set=names)).to_numpy(zero_copy_only=False)
            coded = words.flatten().filter(pa.array(rare)).dictionary_encode()
            pair, n = np.unique(row[rare] * max(1, len(coded.dictionary)) + coded.indices.to_numpy(), return_counts=True)
            row, code = np.divmod(pair, max(1, len(coded.dictionary)))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row)), coded.dictionary.take(pa.array(code)), pa.array(n.astype(np.float64))],
                                             names=[_KEY, "token", "n"])
    return run


def _groups(keys: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """128-bit keys as two numbers each, and where a key differs from the one before it."""
    pair = np.frombuffer(b"".join(keys.to_pylist()), "<u8").reshape(-1, 2)
    return pair, np.flatnonzero(np.r_[True, (pair[1:] != pair[:-1]).any(axis=1)])


def _partial_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A batch's weights and weighted vectors, added up by key."""
    for batch in batches:
        if not batch.num_rows:
            continue
        weight = batch.column(1).to_numpy()
        matrix = _rows_to_matrix(batch.column(2), len(batch.column(2)[0])) * weight[:, None]
        pair = np.frombuffer(b"".join(batch.column(0).to_pylist()), "<u8").reshape(-1, 2)
        order = np.lexsort((pair[:, 1], pair[:, 0]))
        first = np.flatnonzero(np.r_[True, (pair[order[1:]] != pair[order[:-1]]).any(axis=1)])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(pa.array(order[first])), pa.array(np.add.reduceat(weight[order], first)),
             _matrix_to_rows(np.add.reduceat(matrix[order], first, axis=0))], names=[_KEY, "n", "v"])


def _means(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term, vector) from rows sorted by key, a term's text ahead of its sums; a group may go on in the next batch."""
    key, term, n, total = None, None, 0.0, None
    for batch in batches:
        if not batch.num_rows:
            continue
        pair, first = _groups(batch.column(0))
        texts = batch.column(1).take(pa.array(first)).to_pylist()
        held = np.flatnonzero(batch.column(2).is_valid().to_numpy(zero_copy_only=False))
        weights, sums = np.zeros(len(first)), None
        if len(held):
            group = np.searchsorted(first, held, side="right") - 1
            start = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
            rows = batch.column(3).take(pa.array(held))
            added = np.add.reduceat(_rows_to_matrix(rows, len(rows[0])), start, axis=0)
            sums = np.zeros((len(first), added.shape[1]))
            sums[group[start]] = added
            weights[group[start]] = np.add.reduceat(batch.column(2).take(pa.array(held)).to_numpy(), start)
        if key is not None and key == pair[0].tobytes():
            texts[0] = term
            weights[0] += n
            if total is not None:
                sums = np.zeros((len(first), len(total))) if sums is None else sums
                sums[0] += total
        elif n:
            yield _named_means([term], np.asarray([n]), total[None, :])
        done = np.flatnonzero(weights[:-1] > 0)
        if len(done):
            yield _named_means([texts[i] for i in done], weights[done], sums[done])
        key, term, n, total = pair[-1].tobytes(), texts[-1], weights[-1], None if sums is None else sums[-1]
    if n:
        yield _named_means([term], np.asarray([n]), total[None, :])


def _named_means(terms: list[str], n: np.ndarray, sums: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(terms, pa.string()), _matrix_to_rows(sums / n[:, None])], names=["term", "vector"])


def _matrix_to_rows(matrix: np.ndarray) -> pa.Array:
    offsets = np.arange(len(matrix) + 1, dtype=np.int32) * matrix.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(matrix.ravel()))


def node_vectors(nodes: DataFrame, word_vectors: DataFrame, lowercase: bool = False) -> DataFrame:
    """Taxonomy nodes with the vector of their label; unknown labels drop out."""
    vectors = term_vectors(nodes.select(F.col("label").alias("term")), word_vectors, lowercase)
    return nodes.join(vectors.withColumnRenamed("term", "label"), "label")


def _unit_rows(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows scaled to length one, and which rows have a length at all."""
    length = np.sqrt(np.einsum("ij,ij->i", matrix, matrix))
    usable = np.isfinite(length) & (length > 0)
    return matrix / np.where(usable, length, 1.0)[:, None], usable


def _node_matrix(ordinals: np.ndarray, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors in ordinal order, without zero rows and repeated vectors.

    Of equal vectors only the first node can win, so the others need not be compared.
    """
    order = np.argsort(ordinals, kind="stable")
    ordinals, vectors = ordinals[order], vectors[order]
    _, first = np.unique(vectors, axis=0, return_index=True)
    first.sort()
    unit, usable = _unit_rows(vectors[first])
    return ordinals[first][usable], unit[usable]


class NodeClusters:
    """Unit vectors in clusters around some of them, each with the widest angle from its centre.

    No vector of a cluster is nearer to a term than the term's angle to the centre less that
    width, so a cluster that cannot reach the best so far, or the threshold, is passed over. Centres
    are taken one by one, each the vector farthest from those before.
    """

    def __init__(self, unit: np.ndarray):
        self.unit, self.products = unit, 0
        wanted = int(math.ceil(math.sqrt(len(unit))))
        near, owner, centres, at = np.full(len(unit), -np.inf), np.zeros(len(unit), np.int64), [], 0
        while len(centres) < wanted:
            sims = unit @ unit[at]
            closer = sims > near
            near[closer], owner[closer] = sims[closer], len(centres)
            centres.append(at)
            at = int(near.argmin())
            if near[at] >= 1 - 1e-12:
                break
        self.centres = unit[centres]
        order = np.argsort(owner, kind="stable")
        self.members = np.split(order, np.searchsorted(owner[order], np.arange(1, len(centres))))
        self.width = np.asarray([np.arccos(np.clip(near[m].min(), -1, 1)) for m in self.members])

    def best(self, rows: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
        """Index and similarity of each unit row's nearest vector, the first of equals; -inf where none is above the threshold."""
        index, score = np.zeros(len(rows), np.int64), np.full(len(rows), -np.inf)
        for lo in range(0, len(rows), CLUSTER_TERMS):
            some = rows[lo:lo + CLUSTER_TERMS]
            sims = np.clip(some @ self.centres.T, -1, 1)
            self.products += sims.size
            # A hair more than the angle allows, so that rounding hides no equal one.
            reach = np.cos(np.maximum(np.arccos(sims) - self.width, 0)) + 1e-9
            at, top = np.zeros(len(some), np.int64), np.full(len(some), -np.inf)
            first = reach.argmax(axis=1)
            for turn in (True, False):
                for j, members in enumerate(self.members):
                    # The most promising cluster of each term goes first, and sets what the others must reach.
                    asked = (first == j) if turn else (first != j) & (reach[:, j] >= top)
                    asked = np.flatnonzero(asked & (reach[:, j] > threshold))
                    if not len(asked):
                        continue
                    self.products += len(asked) * len(members)
                    for part in np.array_split(asked, max(1, len(asked) * len(members) // TASK_VALUES)):
                        found = np.round(some[part] @ self.unit[members].T, SIMILARITY_DECIMALS)
                        place = found.argmax(axis=1)
                        value, node = found[np.arange(len(part)), place], members[place]
                        better = (value > top[part]) | (value == top[part]) & (node < at[part])
                        top[part[better]], at[part[better]] = value[better], node[better]
            index[lo:lo + len(some)], score[lo:lo + len(some)] = at, top
        return index, score


def _best(matrix: np.ndarray, ordinals: np.ndarray, unit: np.ndarray, threshold: float,
          clusters: NodeClusters | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, ordinal, score) of rows whose best similarity is above the threshold."""
    rows, usable = _unit_rows(matrix)
    best = np.zeros(len(rows), dtype=np.int64)
    score = np.full(len(rows), -np.inf)
    if clusters is not None:
        best, score = clusters.best(np.where(usable[:, None], rows, 0.0), threshold)
    elif len(unit):
        step = max(1, TASK_VALUES // len(unit))
        for lo in range(0, len(rows), step):
            sims = np.round(rows[lo:lo + step] @ unit.T, SIMILARITY_DECIMALS)
            top = sims.argmax(axis=1)
            best[lo:lo + step] = top
            score[lo:lo + step] = sims[np.arange(len(top)), top]
    hit = np.flatnonzero(usable & (score > threshold))
    return hit, ordinals[best[hit]], score[hit]


def _rows_to_matrix(column: pa.Array, width: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    if len(flat) != len(column) * width:
        raise ValueError(f"vectors must all have {width} values")
    return flat.reshape(len(column), width)


def _match_broadcast(terms: DataFrame, ordinals: np.ndarray, unit: np.ndarray,
                     threshold: float) -> DataFrame:
    clusters = NodeClusters(unit) if len(unit) >= CLUSTERED_NODES else None
    shared = terms.sparkSession.sparkContext.broadcast((ordinals, unit, clusters))
    width = unit.shape[1]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, unit, clusters = shared.value
        for batch in batches:
            matrix = _rows_to_matrix(batch.column("vector"), width)
            hit, ordinal, value = _best(matrix, ids, unit, threshold, clusters)
            yield pa.RecordBatch.from_arrays(
                [batch.column("term").take(pa.array(hit)), pa.array(ordinal, pa.int64()),
                 pa.array(value, pa.float64())], names=["term", "ordinal", "score"])

    return terms.mapInArrow(score, _BEST)


def _match_blocked(terms: DataFrame, nodes: DataFrame, threshold: float,
                   block_nodes: int = BLOCK_NODES, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """Same result for a taxonomy too large to broadcast.

    Terms and nodes are cut into hashed blocks of bounded size; one group holds one block
    of each and returns one best node per term, and the blocks are folded by a max.
    """
    node_blocks = max(1, math.ceil(nodes.count() / block_nodes))
    term_blocks = max(1, math.ceil(terms.count() / block_terms))

    def blocks(df: DataFrame, key: str, own: int, other: int, own_name: str, other_name: str):
        return df.withColumn(own_name, F.pmod(F.xxhash64(key), F.lit(own)).cast("int")).withColumn(
            other_name, F.explode(F.sequence(F.lit(0), F.lit(other - 1))))

    left = blocks(terms, "term", term_blocks, node_blocks, "tb", "nb")
    right = blocks(nodes.select("ordinal", "vector"), "ordinal", node_blocks, term_blocks,
                   "nb", "tb")

    def score(part: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"term": [], "ordinal": [], "score": []})
        if part.empty or block.empty:
            return empty
        ids, unit = _node_matrix(block["ordinal"].to_numpy(), np.stack(block["vector"].to_numpy()))
        hit, ordinal, value = _best(
            np.stack(part["vector"].to_numpy()).astype(np.float64), ids, unit, threshold,
            NodeClusters(unit) if len(unit) >= CLUSTERED_NODES else None)
        return pd.DataFrame({"term": part["term"].to_numpy()[hit], "ordinal": ordinal,
                             "score": value})

    found = left.groupBy("tb", "nb").cogroup(right.groupBy("tb", "nb")).applyInPandas(score, _BEST)
    best = F.max(F.struct(F.col("score"), (-F.col("ordinal")).alias("back")))
    return found.groupBy("term").agg(best.alias("b")).select(
        "term", (-F.col("b.back")).alias("ordinal"), F.col("b.score").alias("score"))


def best_matches(terms: DataFrame, nodes: DataFrame, threshold: float = spec.SIMILARITY_THRESHOLD,
                 broadcast_nodes: int = BROADCAST_NODES,
                 broadcast_values: int = BROADCAST_VALUES) -> DataFrame:
    """Best node above the threshold for each ``(term, vector)`` row; first node wins ties.

    ``nodes`` are taxonomy nodes with a ``vector``. Every distinct term is scored once; no
    term x node pair leaves a task. The nodes are written once; a count of their rows and
    values decides, before any row moves, whether their matrix is broadcast or they are
    matched block by block. Both ways give the same rows. Many nodes are searched by
    clusters that a bound on the angle lets a term pass over. The write and the count run at once.
    """
    terms = terms.where(F.col("vector").isNotNull()).select(
        "term", F.col("vector").cast("array<double>").alias("vector"))
    nodes = stored(nodes.where(F.col("vector").isNotNull()).select(
        *NODE_FIELDS, F.col("vector").cast("array<double>").alias("vector")), "nodes")
    size = nodes.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(F.size("vector")), F.lit(0)).alias("values")).first()
    if size["rows"] > broadcast_nodes or size["values"] > broadcast_values:
        found = _match_blocked(stored(terms, "terms"), nodes, threshold)
        fields = nodes.select(*NODE_FIELDS)
    else:
        sample = nodes.collect()
        # Only nodes left in the matrix can be matched, so only those are looked up.
        ordinals, unit = _node_matrix(
            np.array([r["ordinal"] for r in sample], dtype=np.int64),
            np.array([r["vector"] for r in sample], dtype=np.float64).reshape(len(sample), -1)
            if sample else np.empty((0, 0)))
        kept = set(ordinals.tolist())
        schema = nodes.select(*NODE_FIELDS).schema
        fields = F.broadcast(terms.sparkSession.createDataFrame(
            [r[:len(NODE_FIELDS)] for r in sample if r["ordinal"] in kept], schema))
        if len(kept):
            found = _match_broadcast(terms, ordinals, unit, threshold)
        else:
            found = terms.sparkSession.createDataFrame([], _BEST)
    return found.join(fields, "ordinal").select("term", *NODE_FIELDS, "score")
