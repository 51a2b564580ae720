"""Figures over many weeks from one small row a week: sketches that merge, with bounds on their error."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from hubcat.functions.text import quoted, strip

#: The distinct count's sketch has 2 ** LG_K registers: a standard error of 0.8 percent, next to none below 1,000 values.
LG_K = 14
#: Most frequent tags that a week's row keeps.
KEPT_TAGS = 10_000


def weekly_sketches(df: DataFrame, week: Column, organization: str = "organization", tags: str = "tags", kept: int = KEPT_TAGS) -> DataFrame:
    """week, rows, organizations (a HyperLogLog sketch), tags (array of tag and rows, at most ``kept``), dropped_most.

    ``dropped_most`` is the largest number of rows of a tag that was left out, 0 if none was: no such tag can have more.
    Weeks of any size come down to one row, which later runs merge without the week's own rows.
    """
    rows = df.select(week.alias("week"), quoted(organization).cast("string").alias("organization"), quoted(tags).alias("tags"))
    plain = rows.groupBy("week").agg(F.count(F.lit(1)).alias("rows"), F.hll_sketch_agg("organization", LG_K).alias("organizations"))
    counts = rows.select("week", F.explode_outer("tags").alias("tag")).where(F.col("tag").isNotNull()).groupBy(
        "week", F.lower(strip(F.col("tag"))).alias("tag")).agg(F.count(F.lit(1)).alias("rows"))
    place = F.row_number().over(Window.partitionBy("week").orderBy(F.desc("rows"), "tag"))
    most = counts.withColumn("place", place).where(F.col("place") <= kept + 1).groupBy("week").agg(
        F.array_sort(F.collect_list(F.when(F.col("place") <= kept, F.struct("tag", "rows")))).alias("tags"),
        F.coalesce(F.max(F.when(F.col("place") == kept + 1, F.col("rows"))), F.lit(0)).alias("dropped_most"))
    joined = plain.join(most.withColumnRenamed("week", "of"), F.col("week").eqNullSafe(F.col("of")), "left")
    return joined.select("week", "rows", "organizations", F.coalesce("tags", F.array().cast("array<struct<tag:string,rows:bigint>>")).alias("tags"),
                         F.coalesce("dropped_most", F.lit(0)).alias("dropped_most"))


def merged_organizations(sketches: DataFrame) -> DataFrame:
    """rows and organizations (estimated distinct ones) over all weeks of the sketches."""
    return sketches.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
                        F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("organizations")), F.lit(0)).alias("organizations"))


def merged_tags(sketches: DataFrame) -> DataFrame:
    """tag, at_least, at_most: what the tag's number of rows over all weeks lies between; both are the number itself where nothing was dropped."""
    every = sketches.agg(F.sum("dropped_most")).scalar()
    held = sketches.select("dropped_most", F.explode("tags").alias("t")).groupBy(F.col("t.tag").alias("tag")).agg(
        F.sum("t.rows").alias("at_least"), F.sum("dropped_most").alias("seen"))
    return held.select("tag", "at_least", (F.col("at_least") + every - F.col("seen")).alias("at_most"))
