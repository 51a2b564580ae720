"""Quality checks, distributions and coverage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from hubcat.functions.text import list_length, quoted, strip
from hubcat.operators.ordering import exact_median
from hubcat.session import stored


def percent(part: Column, whole: Column) -> Column:
    return part * F.lit(100.0) / F.nullif(whole, F.lit(0))


def _rows() -> Column:
    return F.count(F.lit(1))


def duplicate_count(df: DataFrame, key: str) -> DataFrame:
    """Rows beyond the first of each key; null is one key."""
    c = quoted(key)
    distinct = F.count_distinct(c) + F.coalesce(F.max(c.isNull().cast("int")), F.lit(0))
    return df.agg((_rows() - distinct).alias("duplicates"))


def value_coverage(df: DataFrame, column: str) -> DataFrame:
    """Non-null values and their share."""
    n = F.count(quoted(column))
    return df.agg(_rows().alias("rows"), n.alias("present"), percent(n, _rows()).alias("percent"))


def flag_counts(df: DataFrame, flags=None) -> DataFrame:
    """(flag, rows, percent), one row per flag, from a single aggregate."""
    flags = list(flags or [c for c in df.columns if c.startswith(("has_", "is_"))])
    totals = df.agg(_rows().alias("__rows"), *(F.count_if(quoted(f)).alias(f) for f in flags))
    return totals.unpivot("__rows", flags, "flag", "rows").select(
        "flag", "rows", percent(F.col("rows"), F.col("__rows")).alias("percent"))


def organization_count(df: DataFrame, column: str, approximate: bool = False) -> DataFrame:
    c = quoted(column)
    n = F.approx_count_distinct(c) if approximate else F.count_distinct(c)
    return df.agg(n.alias("organizations"))


def tag_length_stats(df: DataFrame, tags: str = "tags") -> DataFrame:
    n = F.col("n")
    return df.select(list_length(quoted(tags)).alias("n")).agg(
        F.count_if(n == 0).alias("without_tags"), F.avg(n).alias("mean_tags"),
        F.max(n).alias("max_tags"), F.count_if(n >= 10).alias("ten_or_more"))


def tag_counts(df: DataFrame, tags: str = "tags") -> DataFrame:
    """(tag, rows) over lower-case, trimmed tags.

    The outer explode keeps Spark from putting a size check of the tags below it, which
    would normalise them a second time.
    """
    return (
        df.select(F.explode_outer(quoted(tags)).alias("t")).where(F.col("t").isNotNull())
        .groupBy(F.lower(strip(F.col("t"))).alias("tag")).agg(_rows().alias("rows"))
    )


def top_values(counts: DataFrame, value: str, k: int) -> DataFrame:
    """The k most frequent values; equal counts by value."""
    return counts.orderBy(F.col("rows").desc(), F.col(value).asc()).limit(k)


def top_tags(df: DataFrame, tags: str = "tags", k: int = 10) -> DataFrame:
    return top_values(tag_counts(df, tags), "tag", k)


def unique_tags(df: DataFrame, tags: str = "tags") -> DataFrame:
    return tag_counts(df, tags).agg(_rows().alias("unique_tags"))


def value_stats(df: DataFrame, column: str) -> DataFrame:
    """Count, mean, exact median, maximum and sum of the non-null values."""
    c = quoted(column)
    return df.agg(
        F.count(c).alias("values"), F.avg(c).alias("mean"),
        F.lit(exact_median(df, column)).cast("double").alias("median"),
        F.max(c).alias("max"), F.sum(c).alias("total"))


def label_distribution(df: DataFrame, column: str, k: int) -> DataFrame:
    """(label, rows, percent of all rows) of the k most frequent labels."""
    counts = df.groupBy(quoted(column).alias("label")).agg(_rows().alias("rows"))
    total = counts.agg(F.sum("rows")).scalar()
    return top_values(
        counts.where(F.col("label").isNotNull())
        .withColumn("percent", percent(F.col("rows"), total)), "label", k)


def coverage(df: DataFrame) -> DataFrame:
    """Classified papers, papers with several categories, mean categories per paper."""
    n = list_length(F.col("taxonomy_categories"))
    classified, several = F.count("primary_category"), F.count_if(n > 1)
    return df.agg(
        _rows().alias("total_papers"), classified.alias("classified"),
        (_rows() - classified).alias("unclassified"),
        F.coalesce(percent(classified, _rows()), F.lit(0.0)).alias("coverage_percent"),
        several.alias("multi_category"),
        F.coalesce(percent(several, _rows()), F.lit(0.0)).alias("multi_category_percent"),
        F.avg(n).alias("mean_categories"))


def _matches(df: DataFrame) -> DataFrame:
    return df.select(F.explode("matched_keywords_details").alias("m")).select("m.*")


def match_stats(df: DataFrame) -> DataFrame:
    """Matches and mean score per match level, and over all levels (level null)."""
    return _matches(df).rollup("match_level").agg(
        _rows().alias("matches"), F.avg("score").alias("mean_score"))


def known_sizes(df: DataFrame, column: str = "params") -> DataFrame:
    return df.agg(F.count_if(quoted(column) > 0).alias("known_sizes"))


def classified_sample(df: DataFrame, k: int = 3, key: str = "paper_id") -> DataFrame:
    """First k classified papers by key."""
    return df.where(F.col("primary_category").isNotNull()).orderBy(quoted(key)).limit(k)


def distribution_summary(df: DataFrame) -> DataFrame:
    """The whole distribution report as one row of nested values, from two passes over the papers.

    One grouping gives the totals and, per label column, the most frequent labels; one over the
    matches gives their totals and levels. ``df`` is written first: its plan runs once.
    """
    # The field names below are those of the published report.
    tops = {"primary_category": ("category_distribution", 20), "primary_subcategory": ("subcategory_distribution", 30),
            "primary_topic": ("topic_distribution", 50)}
    # Of the matches, what is counted: names and keywords need not be written.
    details = F.transform("matched_keywords_details", lambda d: F.struct(d["match_level"].alias("match_level"), d["score"].alias("score")))
    df = stored(df.select(*tops, "taxonomy_categories", details.alias("matched_keywords_details"), "citation_count"), "papers")
    n, whole = list_length(F.col("taxonomy_categories")), F.col("kind") == ""
    labels = F.explode(F.array(F.struct(F.lit("").alias("kind"), F.lit(None).cast("string").alias("label")),
                               *(F.struct(F.lit(c).alias("kind"), F.col(c).alias("label")) for c in tops)))
    counts = (
        df.select(labels.alias("l"), "primary_category", "citation_count", n.alias("n")).select("l.*", "primary_category", "citation_count", "n")
        .where(whole | F.col("label").isNotNull()).groupBy("kind", "label")
        .agg(_rows().alias("rows"), F.count("primary_category").alias("classified"), F.count_if(F.col("n") > 1).alias("several"),
             F.avg("n").alias("mean"), F.count("citation_count").alias("cited"), F.sum("citation_count").alias("citations"))
        .withColumn("place", F.row_number().over(Window.partitionBy("kind").orderBy(F.desc("rows"), "label")))
    )
    most = {"": 1, **{c: k for c, (_, k) in tops.items()}}
    # The plain bound lets a task drop labels before the window; the finer one follows.
    kept = counts.where(F.col("place") <= max(most.values())).where(F.coalesce(*(F.when(F.col("kind") == c, F.col("place") <= k) for c, k in most.items())))

    def total(name: str) -> Column:
        return F.max(F.when(whole, F.col(name)))

    def top(column: str) -> Column:
        entries = F.array_sort(F.collect_list(F.when(F.col("kind") == column, F.struct("place", "label", "rows"))))
        return F.map_from_entries(F.transform(entries, lambda x: F.struct(x["label"], x["rows"])))

    found = kept.agg(*(total(c).alias(c) for c in ("rows", "classified", "several", "mean", "cited", "citations")),
                     *(top(c).alias(name) for c, (name, _) in tops.items()))
    levels = match_stats(df)
    every = F.col("match_level").isNull()
    matches = levels.agg(F.struct(
        F.coalesce(F.max(F.when(every, F.col("matches"))), F.lit(0)).alias("total_matches"),
        F.coalesce(F.max(F.when(every, F.col("mean_score"))), F.lit(0.0)).alias("average_score"),
        F.map_from_entries(F.array_sort(F.collect_list(F.when(~every, F.struct("match_level", "matches"))))).alias("matches_by_level")))
    rows = F.coalesce("rows", F.lit(0))
    return found.select(
        rows.alias("total_papers"), F.coalesce("classified", F.lit(0)).alias("classified_papers"),
        F.coalesce(percent(F.col("classified"), rows), F.lit(0.0)).alias("coverage_percentage"),
        F.struct(F.coalesce("several", F.lit(0)).alias("multi_category_papers"),
                 F.coalesce(percent(F.col("several"), rows), F.lit(0.0)).alias("multi_category_percentage"),
                 F.col("mean").alias("average_categories_per_paper")).alias("multi_classification"),
        F.struct(F.coalesce("cited", F.lit(0)).alias("papers_with_citations"),
                 F.coalesce("citations", F.lit(0.0)).cast("long").alias("total_citations"),
                 F.coalesce(F.col("citations") / F.nullif(F.col("cited"), F.lit(0)), F.lit(0.0)).alias("average_citations")
                 ).alias("citation_statistics"),
        *(name for name, _ in tops.values()),
        matches.scalar().alias("match_statistics"))
