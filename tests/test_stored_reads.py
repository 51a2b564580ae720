import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from hubcat.operators.flags import inspect_row
from hubcat.plans.weekly import resume_weeks, weekly_snapshots
from hubcat.sources.publish import read_published
from hubcat.sources.sinks import write_keyed
from hubcat.sources.snapshots import read_log, write_log

LOG = "item string, revision string, committed_at timestamp"


def rows_scanned(df):
    """Rows that the scan of a plan without a shuffle handed on."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().get("numOutputRows").get().value() for i in range(leaves.size()))


def test_a_lookup_reads_one_row_group_of_many(spark, tmp_path):
    path = str(tmp_path / "keyed")
    rows = spark.range(60_000).select(F.sha2(F.col("id").cast("string"), 256).alias("id"), F.array(F.md5(F.col("id").cast("string"))).alias("tags"))
    write_keyed(rows, path, "id", group_bytes=64 << 10)
    key = rows.where("tags[0] = md5('777')").first()["id"]
    found = inspect_row(spark.read.parquet(path), key)
    assert found.count() == 1
    scan = spark.read.parquet(path).where(F.col("id") == key)
    assert 0 < rows_scanned(scan) < 60_000 / 20
    # Inside a group's range, but in none of them: the filter tells.
    assert rows_scanned(spark.read.parquet(path).where(F.col("id") == key[:-1] + ("0" if key[-1] != "0" else "1"))) <= 60_000 / 20


def commits(spark, days, items=("a", "b/c"), seed=2):
    rng = random.Random(seed)
    start = dt.datetime(2024, 1, 3, tzinfo=dt.timezone.utc)
    rows = [(i, f"{i}{n}", start + dt.timedelta(days=rng.randrange(days), seconds=rng.randrange(86_400))) for i in items for n in range(days)]
    return spark.createDataFrame(rows, LOG)


@pytest.mark.parametrize("zone", ["UTC", "America/Los_Angeles"])
def test_resumed_weeks_are_those_of_the_whole_log(spark, tmp_path, zone):
    log, path, before = str(tmp_path / "log"), str(tmp_path / "weeks"), spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        every = commits(spark, 90)
        write_log(every, log)
        write_log(every.where("item = 'a'").limit(40).union(every.where("item = 'a'")).distinct(), log)  # days that were fetched twice
        got = lambda df: sorted((r["item"], str(r["week"]), r["revision"]) for r in df.collect())
        assert resume_weeks(spark, log, LOG, path, "2024-02-01") == 1
        write_log(commits(spark, 50, ("new",), 5), log)
        assert resume_weeks(spark, log, LOG, path, "2024-03-20") == 2
        whole = every.union(commits(spark, 50, ("new",), 5))
        assert got(read_published(spark, path)) == got(weekly_snapshots(whole, "2024-03-20"))
        assert resume_weeks(spark, log, LOG, path, "2024-03-20") == 0
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_the_second_run_scans_the_later_days_alone(spark, tmp_path):
    log = str(tmp_path / "log")
    every = commits(spark, 90)
    write_log(every, log)
    seen = spark.createDataFrame([("a", dt.date(2024, 3, 25)), ("b/c", dt.date(2024, 3, 28))], "item string, day date")
    late = every.where("(item = 'a' and committed_at >= timestamp'2024-03-25 00:00:00Z') or (item = 'b/c' and committed_at >= timestamp'2024-03-28 00:00:00Z')").count()
    assert 0 < late < 30 and rows_scanned(read_log(spark, log, LOG, seen)) == late
    assert rows_scanned(read_log(spark, log, LOG, seen.where("item = 'a'"))) == every.where("item = 'b/c' or committed_at >= timestamp'2024-03-25 00:00:00Z'").count()
