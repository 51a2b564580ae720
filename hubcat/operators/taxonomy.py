"""Taxonomy nodes from a nested document or from a table of paths."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from hubcat.operators.ordering import dense_index

NESTED = "map<string,map<string,array<string>>>"
NODE_FIELDS = ("ordinal", "category", "subcategory", "topic", "label", "level")


def _described(nodes: DataFrame) -> DataFrame:
    """Add label, level and path to (ordinal, category, subcategory, topic) rows."""
    c, s, t = F.col("category"), F.col("subcategory"), F.col("topic")
    return nodes.select(
        "ordinal", "category", "subcategory", "topic",
        F.coalesce(t, s, c).alias("label"),
        F.when(t.isNotNull(), "topic").when(s.isNotNull(), "subcategory")
        .otherwise("category").alias("level"),
        F.array_compact(F.array(c, s, t)).alias("path"),
    )


def read_taxonomy(spark: SparkSession, path: str) -> DataFrame:
    """Nodes of a JSON file ``{category: {subcategory: [topic, ...]}}``."""
    nested = spark.read.text(path, wholetext=True).select(
        F.from_json("value", NESTED).alias("tree"))
    return flatten_taxonomy(nested, "tree")


def flatten_taxonomy(nested: DataFrame, column: str) -> DataFrame:
    """Nodes in pre-order: a category, then each subcategory followed by its topics.

    ``ordinal`` packs the three positions into one long, so it grows in pre-order
    without any sort.
    """
    def ordinal(si: Column | int, ti: Column | int) -> Column:
        return (F.shiftleft(F.col("ci").cast("long"), 42)
                + F.shiftleft(F.lit(si).cast("long"), 21) + F.lit(ti).cast("long"))

    categories = nested.select(F.posexplode(column).alias("ci", "category", "subs"))
    subs = categories.select("ci", "category",
                             F.posexplode("subs").alias("si", "subcategory", "topics"))
    topics = subs.select("ci", "si", "category", "subcategory",
                         F.posexplode("topics").alias("ti", "topic"))
    none = F.lit(None).cast("string")
    nodes = (
        categories.select(ordinal(0, 0).alias("ordinal"), "category",
                          none.alias("subcategory"), none.alias("topic"))
        .unionByName(subs.select(ordinal(F.col("si") + 1, 0).alias("ordinal"), "category",
                                 "subcategory", none.alias("topic")))
        .unionByName(topics.select(ordinal(F.col("si") + 1, F.col("ti") + 1).alias("ordinal"),
                                   "category", "subcategory", "topic"))
    )
    return _described(nodes)


def taxonomy_from_paths(paths: DataFrame) -> DataFrame:
    """Nodes of a ``(category, subcategory, topic)`` table, ordered by name."""
    none = F.lit(None).cast("string")
    nodes = (
        paths.select("category", none.alias("subcategory"), none.alias("topic"))
        .unionByName(paths.where("subcategory is not null")
                     .select("category", "subcategory", none.alias("topic")))
        .unionByName(paths.where("subcategory is not null and topic is not null")
                     .select("category", "subcategory", "topic"))
        .where("category is not null").distinct()
    )
    order = [F.col(c).asc_nulls_first() for c in ("category", "subcategory", "topic")]
    return _described(dense_index(nodes, order, "ordinal"))


def level_counts(nodes: DataFrame) -> DataFrame:
    return nodes.groupBy("level").agg(F.count(F.lit(1)).alias("nodes"))
