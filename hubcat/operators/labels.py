"""From keyword matches to taxonomy labels on papers."""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

from hubcat import spec
from hubcat.functions.ranking import label_names, label_scores
from hubcat.functions.text import first_or_null, quoted, strip
from hubcat.operators.matching import best_matches, term_vectors
from hubcat.operators.skew import join_unique
from hubcat.session import stored

#: Rows of the map that keeps most keywords without a match out of the exchange, and the bits a term sets in one of them.
FILTER_PLACES, FILTER_MARKS = 1 << 21, 4
#: Matched terms that may go to every task, and the bytes of their names.
SHARED_TERMS, SHARED_BYTES = 200_000, 32_000_000

# Workers get the kernel below with the task; they need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_LIST, _OWN, _HITS, _FOUND = "__list", "__own", "__hits", "__found"
_NAMED = ("label", "category", "subcategory", "topic", "level")
_ENTRY = ("keyword", "label", "score", *_NAMED[1:])
LEVELS = ("category", "subcategory", "topic")
_PLURAL = {"category": "categories", "subcategory": "subcategories", "topic": "topics"}
_DETAIL = (
    "array<struct<keyword:string,matched_to:string,score:double,category:string,"
    "subcategory:string,topic:string,match_level:string>>"
)
_OTHERS = (
    "array<struct<pos:int,keyword:string,label:string,score:double,category:string,"
    "subcategory:string,topic:string,level:string>>"
)


def _list_key(column: str):
    """128-bit key of a keyword list; null for a null or empty list."""
    c = quoted(column)
    return F.when(F.size(c) > 0, F.unhex(F.md5(F.to_json(c))))


def keyword_lists(papers: DataFrame, column: str = "paper_ai_keywords") -> DataFrame:
    """One row per distinct keyword list: copies of a paper are labelled once.

    Labels depend on the list alone, so the list is the key they are joined back by. Paper
    ids may repeat, and generated row ids would not survive a recomputed partition.
    """
    lists = papers.select(quoted(column).alias("keywords"))
    # Lists travel as JSON, which takes half the bytes of an array.
    texts = lists.select(F.to_json("keywords").alias("json")).distinct()
    # Never null, or a null check of the key would be pushed into the scan.
    key = F.coalesce(F.when(F.col("json") != "[]", F.unhex(F.md5("json"))), F.unhex(F.lit("")))
    kind = lists.schema["keywords"].dataType
    return texts.select(key.alias(_LIST), F.from_json("json", kind, {"mode": "FAILFAST", "maxStringLen": str(2**31 - 1)}).alias("keywords"))


def keyword_rows(lists: DataFrame) -> DataFrame:
    """(list, pos, term) rows; null keywords, null lists and empty lists drop out.

    A term keeps its outer white space here: that does not change its words, and only the
    few matched ones are stripped.
    """
    return lists.select(_LIST, F.posexplode_outer("keywords").alias("pos", "term")).where(
        F.col("term").isNotNull())


def matchable_rows(lists: DataFrame, matches: DataFrame) -> DataFrame:
    """``keyword_rows`` without most of those whose term has no match: these need not be shuffled.

    A bitmap of the matched terms' hashes, 64 bits a row, is broadcast; its size is bounded, whatever the number of terms. A
    term sets several bits of its row, all of which a keyword must meet: with one bit, the keywords that pass without a
    match would grow with the keywords times the terms.
    """
    hashed, place = F.xxhash64("term").alias("hash"), F.pmod(F.col("hash"), F.lit(FILTER_PLACES)).alias("place")
    marks = F.expr(" | ".join(f"shiftleft(1L, cast(shiftrightunsigned(hash, {58 - 6 * i}) & 63 as int))" for i in range(FILTER_MARKS)))
    bitmap = matches.select(hashed).groupBy(place).agg(F.bit_or(marks).alias("bits"))
    rows = keyword_rows(lists).select("*", hashed).select("*", place)
    return rows.join(F.broadcast(bitmap), "place").where(F.col("bits").bitwiseAND(marks) == marks).select(_LIST, "pos", "term")


def _keyed(papers: DataFrame, column: str) -> DataFrame:
    return papers.select(_list_key(column).alias(_LIST), quoted(column).alias("keywords"))


def matched_rows(rows: DataFrame, matches: DataFrame) -> DataFrame:
    """Give every keyword occurrence the match of its term; unmatched ones drop out."""
    return join_unique(rows, matches, "term", "inner")


def shared_matches(papers: DataFrame, matches: DataFrame, column: str = "paper_ai_keywords") -> tuple[pa.Table, DataFrame | None]:
    """The matches that may go to every task, and the others; None if there are none.

    All of them, where they are few enough. Else the most used ones, up to SHARED_TERMS and SHARED_BYTES; terms that repeat are others.
    """
    size = sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in ("term", *_NAMED)), F.lit(16))
    named = matches.groupBy("term").agg(F.count(F.lit(1)).alias("rows"), F.sum(size).alias("bytes"))
    every = named.agg(F.count_if(F.col("rows") > 1).alias("repeated"), F.count(F.lit(1)).alias("terms"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes")).first()
    if not every["repeated"] and every["terms"] <= SHARED_TERMS and every["bytes"] <= SHARED_BYTES:
        return matches.toArrow(), None
    uses = matchable_rows(_keyed(papers, column), named).groupBy("term").agg(F.count(F.lit(1)).alias("uses"))
    used = stored(join_unique(named.where("rows = 1"), uses, "term", "inner").select("term", "uses", "bytes"), "uses")
    least, terms, held = None, 0, 0
    for row in sorted(used.groupBy("uses").agg(F.count(F.lit(1)).alias("terms"), F.sum("bytes").alias("bytes")).collect(), reverse=True):
        terms, held = terms + row["terms"], held + row["bytes"]
        if terms > SHARED_TERMS or held > SHARED_BYTES:
            break
        least = row["uses"]
    chosen = F.broadcast(used.where(F.lit(False) if least is None else F.col("uses") >= least).select("term"))
    return matches.join(chosen, "term", "left_semi").toArrow(), matches.join(chosen, "term", "left_anti")


def other_hits(papers: DataFrame, matches: DataFrame, column: str = "paper_ai_keywords") -> DataFrame:
    """The matches of each distinct keyword list by a shuffle, in keyword order. Only keywords that may match move, not the lists."""
    matched = matched_rows(matchable_rows(_keyed(papers, column), matches).distinct(), matches)
    return matched.groupBy(_LIST).agg(F.array_sort(F.collect_list(F.struct("pos", *_ENTRY))).alias(_HITS))


def _sizes(lists: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.list_value_length(lists), 0).to_numpy()


def _offsets(row: np.ndarray, rows: int) -> np.ndarray:
    return np.r_[0, np.cumsum(np.bincount(row, minlength=rows))].astype("i4")


def _lists(row: np.ndarray, rows: int, values: list, names: list[str]) -> pa.ListArray:
    """Lists of structs, one per row; the values come in row order."""
    return pa.ListArray.from_arrays(pa.array(_offsets(row, rows)), pa.StructArray.from_arrays(values, names=names))


def shared_hits(keywords: Column, shared: Broadcast) -> Column:
    """Places of the keywords that have a shared match, and its numbers: two plain lists, a quarter of a list of pairs."""
    @F.arrow_udf("struct<pos: array<int>, match: array<int>>")
    def found(words: pa.Array) -> pa.Array:
        size = _sizes(words)
        start = np.cumsum(size) - size
        at = pc.fill_null(pc.index_in(words.flatten(), value_set=shared.value[0].cast(words.type.value_type)), -1).to_numpy()
        held, row = np.flatnonzero(at >= 0), np.repeat(np.arange(len(words)), size)
        row = row[held]
        offsets = pa.array(_offsets(row, len(words)))
        return pa.StructArray.from_arrays([pa.ListArray.from_arrays(offsets, pa.array(x.astype("i4"))) for x in (held - start[row], at[held])], names=["pos", "match"])

    # Not to be worked out twice, by a filter on a label and for the label itself.
    return found.asNondeterministic()(keywords)


def _in_order(own: pa.StructArray, others: pa.Array, entries: pa.StructArray) -> tuple[np.ndarray, np.ndarray, pa.StructArray]:
    """(row, pos, match) of every keyword that has a match, in that order."""
    at, match = own.field("pos"), own.field("match")
    row = np.repeat(np.arange(len(own)), _sizes(at))
    pos, found = at.flatten().to_numpy(), entries.take(match.flatten())
    more = others.flatten()
    if not len(more):
        return row, pos, found
    row, pos = np.r_[row, np.repeat(np.arange(len(others)), _sizes(others))], np.r_[pos, more.field("pos").to_numpy()]
    order = np.lexsort((pos, row))
    found = pa.concat_arrays([found, pa.StructArray.from_arrays([more.field(f.name).cast(f.type) for f in found.type], names=list(_ENTRY))])
    return row[order], pos[order], found.take(pa.array(order))


def _ranked(row: np.ndarray, pos: np.ndarray, label: pa.Array, score: np.ndarray, rows: int, share: float, most: int, multi: bool) -> pa.ListArray:
    """Each row's labels as ``functions.ranking.ranked_labels`` orders and keeps them: a label has its best score and its first position."""
    held = np.flatnonzero(label.is_valid().to_numpy(zero_copy_only=False))
    coded = label.take(pa.array(held)).dictionary_encode()
    names, code = coded.dictionary, coded.indices.to_numpy()
    row, pos, score = row[held], pos[held], score[held]
    order = np.lexsort((code, row))
    row, code, pos, score = row[order], code[order], pos[order], score[order]
    first = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (code[1:] != code[:-1])][:len(row)])
    if len(first):
        row, code, pos, score = row[first], code[first], np.minimum.reduceat(pos, first), np.maximum.reduceat(score, first)
    by_name = np.empty(len(names), "i8")
    by_name[pc.sort_indices(names).to_numpy()] = np.arange(len(names))
    order = np.lexsort((by_name[code], pos, -score, row))
    if multi:
        top = np.full(rows, -np.inf)
        np.maximum.at(top, row, score)
        order = order[score[order] >= top[row[order]] * share]
        start = np.searchsorted(row[order], row[order])
        order = order[np.arange(len(order)) - start < most]
    return _lists(row[order], rows, [names.take(pa.array(code[order])), pa.array(score[order])], ["label", "score"])


def labels_of(own: Column, others: Column, shared: Broadcast, share: float = spec.LABEL_SCORE_SHARE, most: int = spec.MAX_LABELS, multi: bool = True) -> Column:
    """Ranked labels of a keyword list, one field per level, and the match details, from its shared hits and its others.

    Labels count by their bare name: equal names in two branches are one label. Details come in keyword order with repeats kept.
    """
    @F.arrow_udf(f"struct<{', '.join(f'{x}: array<struct<label: string, score: double>>' for x in LEVELS)}, details: {_DETAIL}>")
    def found(own: pa.Array, others: pa.Array) -> pa.Array:
        row, pos, match = _in_order(own, others, shared.value[1])
        score = match.field("score").to_numpy(zero_copy_only=False)
        levels = [_ranked(row, pos, match.field(x), score, len(own), share, most, multi) for x in LEVELS]
        held = np.flatnonzero(match.field("category").is_valid().to_numpy(zero_copy_only=False))
        kept = match.take(pa.array(held))
        details = _lists(row[held], len(own), [kept.field(x) for x in _ENTRY], ["keyword", "matched_to", "score", "category", "subcategory", "topic", "match_level"])
        return pa.StructArray.from_arrays([*levels, details], names=[*LEVELS, "details"])

    return found.asNondeterministic()(own, others)


def with_taxonomy(papers: DataFrame, matches: DataFrame, column: str = "paper_ai_keywords",
                  share: float = spec.LABEL_SCORE_SHARE, most: int = spec.MAX_LABELS,
                  multi: bool = True) -> DataFrame:
    """The ten taxonomy columns on every paper; unmatched papers get empty ones.

    ``matches`` has one row per matched term, written as the keyword stands in the lists. They are written first. Those that may
    go to every task are looked up where a paper lies. If there are others, these are shuffled to the lists, and papers are
    joined with them: keywords themselves move only where the output is asked for them.
    """
    matches = stored(matches.where(F.col("term").isNotNull()).select("term", strip(F.col("term")).alias("keyword"), *_NAMED, "score"), "matches")
    few, others = shared_matches(papers, matches, column)
    entries = pa.StructArray.from_arrays([few.column(c).combine_chunks().cast(pa.float64() if c == "score" else pa.string()) for c in _ENTRY], names=list(_ENTRY))
    shared = papers.sparkSession.sparkContext.broadcast((few.column("term").combine_chunks().cast(pa.string()), entries))
    rows, hits = papers.withColumn(_OWN, shared_hits(quoted(column), shared)), F.lit(None).cast(_OTHERS)
    if others is not None:
        rows, hits = join_unique(rows.withColumn(_LIST, _list_key(column)), other_hits(papers, others, column), _LIST), F.col(_HITS)
    labelled = rows.withColumn(_FOUND, labels_of(F.col(_OWN), hits, shared, share, most, multi))
    names = {level: label_names(F.col(f"{_FOUND}.{level}")) for level in LEVELS}
    return labelled.select(
        *(quoted(c) for c in papers.columns),
        *(names[level].alias(f"taxonomy_{_PLURAL[level]}") for level in LEVELS),
        *(first_or_null(names[level]).alias(f"primary_{level}") for level in LEVELS),
        F.col(f"{_FOUND}.details").alias("matched_keywords_details"),
        *(label_scores(F.col(f"{_FOUND}.{level}")).alias(f"{level}_scores") for level in LEVELS),
    )


def keyword_terms(papers: DataFrame, column: str = "paper_ai_keywords") -> DataFrame:
    """Distinct keywords, each to be scored once however many papers repeat it."""
    return papers.select(F.explode_outer(quoted(column)).alias("term")).where(F.col("term").isNotNull()).distinct()


def keyword_matches(papers: DataFrame, nodes: DataFrame, word_vectors: DataFrame,
                    column: str = "paper_ai_keywords",
                    threshold: float = spec.SIMILARITY_THRESHOLD,
                    lowercase: bool = False) -> DataFrame:
    """Best node of every distinct keyword; ``nodes`` carry a vector already."""
    vectors = term_vectors(keyword_terms(papers, column), word_vectors, lowercase)
    return best_matches(vectors, nodes, threshold)
