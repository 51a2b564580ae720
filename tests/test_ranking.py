import statistics

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
import pytest

from hubcat.operators import batches as b
from hubcat.operators.ordering import dense_index, exact_median
from hubcat.operators.skew import join_unique


def test_dense_index_equals_row_number(spark):
    df = spark.range(5000).repartition(7).select(
        F.col("id").cast("string").alias("paper_id"),
        F.when(F.col("id") % 5 > 0, F.col("id") % 13).cast("double").alias("paper_upvotes"))
    got = b.ranked(df).orderBy("position").collect()
    expected = sorted(df.collect(), key=lambda r: (r["paper_upvotes"] is None,
                                                   -(r["paper_upvotes"] or 0), r["paper_id"]))
    assert [r["position"] for r in got] == list(range(5000))
    assert [r["paper_id"] for r in got] == [r["paper_id"] for r in expected]


def test_dense_index_of_nothing(spark):
    empty = spark.range(0).select(F.lit("a").alias("paper_id"), F.lit(1.0).alias("paper_upvotes"))
    assert b.ranked(empty).count() == 0


def test_dense_index_splits_copies(spark):
    """A group of equal rows is spread over tasks and still numbered without gaps."""
    df = spark.range(4000).repartition(8).select(F.lit("same").alias("k"))
    # Small partitions would be put together again here.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        indexed = dense_index(df, [F.col("k").asc()])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sorted(r[0] for r in indexed.select("position").collect()) == list(range(4000))
    parts = indexed.select(F.spark_partition_id().alias("p")).distinct().count()
    assert parts > 1


def test_no_single_partition_in_index(spark):
    df = b.ranked(spark.range(100).selectExpr("string(id) paper_id", "double(id) paper_upvotes"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


@settings(max_examples=10, deadline=None)
@given(st.lists(st.one_of(st.none(), st.floats(-5, 5).map(lambda x: round(x, 1))), max_size=40))
def test_exact_median(spark, numbers):
    df = spark.createDataFrame([(x,) for x in numbers], "v double")
    known = [x for x in numbers if x is not None]
    expected = statistics.median(known) if known else None
    got = exact_median(df, "v")
    assert got == (pytest.approx(expected) if known else None)


def test_batch_sizes(spark):
    cases = {16985: (85, 200), 25000: (125, 200), 40000: (200, 200), 100000: (200, 500),
             200000: (200, 1000)}
    for total, (jobs, size) in cases.items():
        assert b.batch_size(total) == size
        table = b.batch_table(spark, total)
        covered = table.agg(F.count("*"), F.sum(F.col("end_idx") - F.col("start_idx"))).first()
        assert tuple(covered) == (jobs, total)
    assert b.batch_table(spark, 400000).first()["oversized"]
    with pytest.raises(ValueError):
        b.batch_table(spark, 0)


@settings(max_examples=15, deadline=None)
@given(st.integers(1, 5000), st.integers(1, 700))
def test_batches_cover_every_row_once(spark, total, size):
    rows = b.batch_table(spark, total, size).orderBy("job_id").collect()
    assert rows[0]["start_idx"] == 0 and rows[-1]["end_idx"] == total
    assert all(x["end_idx"] == y["start_idx"] for x, y in zip(rows, rows[1:]))
    assert all(r["wave"] == r["job_id"] // 15 and r["wave_job_id"] == r["job_id"] % 15 for r in rows)


def test_capped_jobs(spark):
    assert b.capped_jobs(0) == (0, 0) and b.capped_job_table(spark, 0).count() == 0
    assert b.capped_jobs(1000) == (5, 200) and b.capped_jobs(10000) == (20, 500)
    rows = b.capped_job_table(spark, 10000).collect()
    assert sum(r["rows"] for r in rows) == 10000 and rows[0]["minutes_per_job"] == 25.0


def test_top_and_slice(spark):
    df = b.ranked(spark.createDataFrame([("a", 1.0, 5.0), ("b", None, 6.0), ("c", 9.0, 7.0)],
                                        "paper_id string, paper_upvotes double, v double"))
    kept = {r["paper_id"]: r["v"] for r in b.keep_top(df, 2, ["v"]).collect()}
    assert kept == {"c": 7.0, "a": 5.0, "b": None}
    assert [r["paper_id"] for r in b.position_slice(df, 1, 3).orderBy("position").collect()] == ["a", "b"]
    assert b.keep_top(df, None, ["v"]) is df
    rows = b.with_batches(df, 2).orderBy("position").collect()
    assert [r["batch_id"] for r in rows] == [0, 0, 1]


SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture
def small_skew(spark):
    """Thresholds at which a few thousand rows count as a hot key."""
    before = {k: spark.conf.get(k, None) for k in SKEW}
    for k, v in SKEW.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("how", ["left", "inner"])
def test_join_unique_with_hot_and_null_keys(spark, small_skew, how):
    """A hot key is split and nulls are spread; the rows are those of a plain join."""
    left = spark.range(60000).repartition(12).select(
        "id", F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 3 == 1, F.lit(None))
        .otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("key"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"))
    # Already grouped by the key, as the right sides of the library are.
    right = spark.range(600).select(
        F.when(F.col("id") % 10 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 50))
        .alias("key"), F.col("id").alias("v")).groupBy("key").agg(F.max("v").alias("v"))
    got = join_unique(left, right, "key", how)
    rows = got.select(F.count("*"), F.sum("id"), F.sum("v"), F.count("v"))
    rows.collect()
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "skew=true" in plan
    plain = left.join(right, "key", how)
    assert got.select("id", "key", "v").exceptAll(plain.select("id", "key", "v")).isEmpty()
    assert got.count() == plain.count()
