"""Citation lookups and the incremental merge of new and previous results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from hubcat import spec
from hubcat.functions.text import is_present, is_fresh, quoted, strip
from hubcat.operators.skew import join_unique
from hubcat.operators.title_search import nearest_titles, search_title
from hubcat.sources.history import join_history

COUNT, EXT_ID, FETCHED = "citation_count", "semantic_scholar_id", "citation_fetch_date"
CACHE_COLUMNS = ("paper_id", COUNT, EXT_ID, FETCHED)


def _triples(df: DataFrame) -> DataFrame:
    """The four cache columns in fixed types; absent ones are null."""
    types = {"paper_id": "string", COUNT: "double", EXT_ID: "string", FETCHED: "date"}
    return df.select(*(
        (F.col(c) if c in df.columns else F.lit(None)).cast(t).alias(c)
        for c, t in types.items()
    ))


def _latest(when: Column) -> Column:
    """Most recent (date, count, id) among rows that satisfy ``when``; dateless ones last."""
    return F.max(F.when(when, F.struct(F.col(FETCHED), F.col(COUNT), F.col(EXT_ID))))


def disabled_citations(papers: DataFrame) -> DataFrame:
    """Enrichment switched off: null columns, all rows kept."""
    return papers.withColumns({
        COUNT: F.lit(None).cast("double"), EXT_ID: F.lit(None).cast("string"),
        FETCHED: F.lit(None).cast("date"),
    })


def previous_cache(previous: DataFrame) -> DataFrame:
    """One row per paper from the last run: latest dated result, and the known id."""
    dated = F.col(FETCHED).isNotNull() & F.col(COUNT).isNotNull()
    has_id = F.col(EXT_ID).isNotNull()
    return (
        _triples(previous).where(F.col("paper_id").isNotNull())
        .groupBy("paper_id")
        .agg(_latest(dated).alias("hit"), _latest(has_id).alias("known"))
        .select("paper_id", F.col(f"hit.{COUNT}").alias("cached_count"),
                F.col(f"hit.{EXT_ID}").alias("cached_id"),
                F.col(f"hit.{FETCHED}").alias("cached_date"),
                F.coalesce(f"hit.{EXT_ID}", f"known.{EXT_ID}").alias("known_id"))
    )


def split_by_freshness(papers: DataFrame, previous: DataFrame, as_of,
                       title: str = "paper_title", stored: bool = False) -> DataFrame:
    """Mark each paper ``cached``, ``skipped`` (no title) or ``resolve``.

    Cached rows carry the previous triple; the others are null, with the known external
    id kept for the lookup. With ``stored``, ``previous`` comes from ``read_history`` and does not move.
    """
    known = previous_cache(previous)
    joined = join_history(papers, "paper_id", known) if stored else join_unique(papers, known, "paper_id")
    fresh = is_fresh(F.col("cached_date"), as_of)
    source = F.when(fresh, "cached").when(~is_present(quoted(title)), "skipped").otherwise("resolve")
    return joined.select(
        *(quoted(c) for c in papers.columns),
        source.alias("source"),
        F.when(fresh, F.col("cached_count")).alias(COUNT),
        F.when(fresh, F.col("cached_id")).alias(EXT_ID),
        F.when(fresh, F.col("cached_date")).alias(FETCHED),
        "known_id",
    )


def resolve(marked: DataFrame, reference: DataFrame, as_of,
            title: str = "paper_title", near: int | None = None) -> DataFrame:
    """Look ``resolve`` rows up in ``reference(ext_id, title, citation_count)``.

    First by known external id, then by title; a hit is stamped with ``as_of``. With ``near``, titles that
    equal none take the first hit of a title search that scores so many percent at least.
    """
    found = F.struct(F.col("ext_id").cast("string").alias("id"),
                     F.col(COUNT).cast("double").alias("count"))
    by_id = (
        reference.where(is_present(F.col("ext_id").cast("string")))
        .groupBy(F.col("ext_id").cast("string").alias("__id"))
        .agg(F.max(found).alias("by_id"))
    )
    by_title = (
        reference.where(is_present(F.col("title")))
        .groupBy(F.lower(strip(F.col("title"))).alias("__title"))
        .agg(F.min(found).alias("by_title"))
    )
    todo = F.col("source") == "resolve"
    with_id = join_unique(
        marked.withColumn("__id", F.when(todo & is_present(F.col("known_id")), F.col("known_id"))),
        by_id, "__id",
    )
    both = join_unique(
        with_id.withColumn("__title", F.when(todo & F.col("by_id").isNull(),
                                             F.lower(strip(quoted(title))))),
        by_title, "__title",
    )
    hits = ["by_id", "by_title"]
    if near is not None:
        open_ = todo & F.col("by_id").isNull() & F.col("by_title").isNull()
        both = both.withColumn("__near", F.when(open_ & is_present(quoted(title)), search_title(quoted(title))))
        best = nearest_titles(both.select(F.col("__near").alias("title")), reference, near)
        both = join_unique(both, best.select(F.col("search_title").alias("__near"), F.col("found").alias("by_near")), "__near")
        hits.append("by_near")
    hit = F.coalesce(*hits)
    kept = [c for c in marked.columns if c not in (COUNT, EXT_ID, FETCHED, "known_id")]
    return both.select(
        *(quoted(c) for c in kept),
        F.coalesce(F.col(COUNT), hit["count"]).alias(COUNT),
        F.coalesce(F.col(EXT_ID), hit["id"]).alias(EXT_ID),
        F.coalesce(F.col(FETCHED), F.when(hit.isNotNull(), F.lit(as_of).cast("date"))).alias(FETCHED),
    )


def union_batches(frames: list[DataFrame]) -> DataFrame:
    """All rows of all batches, columns aligned by name, absent ones null."""
    if not frames:
        raise ValueError("no citation batches to merge")
    merged = frames[0]
    for frame in frames[1:]:
        merged = merged.unionByName(frame, allowMissingColumns=True)
    return merged


def _citation_state(citations: DataFrame, previous: DataFrame | None) -> DataFrame:
    """One narrow row per paper id: the new result and the last known one."""
    rows = _triples(citations).withColumn("__new", F.lit(True))
    if previous is not None:
        rows = rows.unionByName(_triples(previous).withColumn("__new", F.lit(False)))
    new = F.col("__new")
    counted = F.col(COUNT).isNotNull()
    return (
        rows.where(F.col("paper_id").isNotNull())
        .groupBy("paper_id")
        .agg(_latest(new & counted).alias("__hit"), _latest(new).alias("__miss"),
             _latest(~new & counted).alias("__old"))
    )


def merge_citations(papers: DataFrame, citations: DataFrame, previous: DataFrame | None = None,
                    distinct: bool = False, stored: bool = False) -> DataFrame:
    """Papers with the new citation triple, or the previous one where the new count is null.

    Every new row is joined: a paper whose id repeats in ``citations`` comes out once for
    each. With ``distinct`` new and previous results are first reduced to one row per id, so each
    paper row comes out once and the wide table is joined once. With ``stored`` the same holds, ``previous`` comes
    from ``read_history``, and papers and new results move to where its rows lie.
    """
    base = papers.drop(COUNT, EXT_ID, FETCHED)
    if stored:
        counted = F.col(COUNT).isNotNull()
        old = _triples(previous).groupBy("paper_id").agg(_latest(counted).alias("__old"))
        new = _triples(citations).where(F.col("paper_id").isNotNull()).groupBy("paper_id").agg(
            _latest(counted).alias("__hit"), _latest(F.lit(True)).alias("__miss"))
        joined = join_history(base, "paper_id", old, new).withColumn("__new", F.coalesce("__hit", "__miss"))
    elif not distinct:
        new = _triples(citations).where(F.col("paper_id").isNotNull()).select(
            "paper_id",
            F.struct(F.col(FETCHED), F.col(COUNT), F.col(EXT_ID)).alias("__new"),
        )
        empty = F.lit(None).cast(new.schema["__new"].dataType)
        state = new.withColumn("__old", empty)
        if previous is not None:
            old = _triples(previous).where(F.col("paper_id").isNotNull()).groupBy("paper_id").agg(
                _latest(F.col(COUNT).isNotNull()).alias("__old"))
            only_old = old.join(new.select("paper_id").distinct(), "paper_id", "left_anti")
            state = join_unique(new, old, "paper_id").unionByName(only_old.withColumn("__new", empty))
        joined = join_unique(base, state, "paper_id")
    else:
        state = _citation_state(citations, previous).select(
            "paper_id", "__old", F.coalesce("__hit", "__miss").alias("__new"))
        joined = join_unique(base, state, "paper_id")
    fallback = F.col(f"__new.{COUNT}").isNull() & F.col("__old").isNotNull()
    chosen = F.when(fallback, F.col("__old")).otherwise(F.col("__new"))
    return joined.select(
        *(quoted(c) for c in base.columns),
        chosen[COUNT].alias(COUNT), chosen[EXT_ID].alias(EXT_ID), chosen[FETCHED].alias(FETCHED),
        F.when(fallback, "previous").when(F.col(f"__new.{COUNT}").isNotNull(), "new")
        .otherwise("none").alias("citation_source"),
    )


def merge_stats(merged: DataFrame, as_of) -> DataFrame:
    """Papers, with citations, new, preserved and fresh, in one row."""
    cited = F.col(COUNT).isNotNull()
    return merged.agg(
        F.count(F.lit(1)).alias("papers"),
        F.count_if(cited).alias("with_citations"),
        F.count_if(F.col("citation_source") == "new").alias("new_citations"),
        F.count_if(F.col("citation_source") == "previous").alias("preserved_citations"),
        F.count_if(is_fresh(F.col(FETCHED), as_of)).alias("fresh_citations"),
    )


def outcome_counts(marked: DataFrame) -> DataFrame:
    """Rows and found citations per source."""
    return marked.groupBy("source").agg(
        F.count(F.lit(1)).alias("papers"), F.count(COUNT).alias("with_citations")
    )


def fresh_rows(previous: DataFrame, as_of, days: int = spec.FRESH_DAYS) -> DataFrame:
    """How many previous rows are still fresh."""
    return previous.agg(F.count_if(is_fresh(F.col(FETCHED), as_of, days)).alias("fresh_rows"))


def batch_totals(batches: DataFrame, value: str = COUNT, file: str = "batch_file") -> DataFrame:
    """Rows and rows with a value per file, and a total row with a null file."""
    return batches.rollup(file).agg(
        F.count(F.lit(1)).alias("papers"), F.count(value).alias("with_citations")
    )
