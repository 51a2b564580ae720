"""Plans the library is meant to get, on tables too large to broadcast."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from hubcat import spec
from hubcat.operators import citations as cit
from hubcat.operators import labels as lab
from hubcat.operators import reports
from hubcat.operators.weekly import weekly_revisions
from hubcat.plans.models import models_table
from hubcat.sources.scans import scan_catalog, spread


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def parquet(spark, tmp_path):
    def write(df, name="t"):
        path = str(tmp_path / name)
        df.write.parquet(path)
        return path
    return write


def test_models_scan_is_pruned_and_narrow(spark, parquet):
    raw = spark.range(10).select(
        F.concat(F.lit("o/"), "id").alias("id"), F.lit("a,b").alias("tags"), F.lit("x").alias("card"),
        F.lit(None).cast("string").alias("safetensors"), F.lit("y").alias("sha"))
    out = models_table(scan_catalog(spark, parquet(raw), spec.MODELS), dt.datetime(2025, 1, 1))
    text = plan(out)
    assert "card" not in text and "sha" not in text
    assert "Exchange" not in text and "Python" not in text


def test_filter_reaches_the_scan(spark, parquet):
    path = parquet(spark.range(10).select(F.col("id").cast("string").alias("id"), F.lit("a").alias("tags")))
    df = spark.read.parquet(path)
    assert "EqualTo(id,7)" in plan(df.where(F.col("id") == "7").limit(1).select("id"))


def test_merge_joins_the_wide_table_once(spark):
    papers = spark.range(5).selectExpr("string(id) paper_id", "id as wide")
    rows = spark.range(5).selectExpr("string(id) paper_id", "double(id) citation_count",
                                     "'s' semantic_scholar_id", "date'2025-01-01' citation_fetch_date")
    text = plan(cit.merge_citations(papers, rows, rows, distinct=True))
    assert text.count("Join") == 1 and "CartesianProduct" not in text


def test_labels_do_not_cross_join(spark):
    papers = spark.createDataFrame([("p", ["a"])], "paper_id string, paper_ai_keywords array<string>")
    matches = spark.createDataFrame(
        [("a", 1, "A", None, None, "A", "category", .9)],
        "term string, ordinal long, category string, subcategory string, topic string, label string, "
        "level string, score double")
    text = plan(lab.with_taxonomy(papers, matches))
    assert "NestedLoop" not in text and "Cartesian" not in text and "Python" not in text


def test_weekly_orders_days_not_commits(spark):
    """The window runs over one row per item and day; commits are reduced before the shuffle."""
    revisions = spark.range(100).selectExpr(
        "'models' item", "concat('r', id) revision", "timestamp'2025-01-01' + make_dt_interval(0, id) committed_at")
    text = plan(weekly_revisions(revisions, "2025-02-01"))
    window = text.index("Window")
    assert "partial_max" in text[window:]


def test_top_tags_sorts_only_the_top(spark):
    df = spark.createDataFrame([(["a", "b"],)], "tags array<string>")
    assert "TakeOrderedAndProject" in plan(reports.top_tags(df))


def test_spread_leaves_wide_scans_alone(spark):
    wide = spark.range(0, 100, 1, 16)
    assert spread(wide) is wide
    assert spread(spark.range(0, 100, 1, 1)).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
