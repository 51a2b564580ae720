import datetime as dt

import pytest

from hubcat.operators.weekly import calendar, latest_snapshots, start_days, daily_revisions
from hubcat.plans.weekly import weekly_snapshots


def revisions(spark):
    rows = [("models", "r1", "2025-01-01 05:00:00"), ("models", "r2", "2025-01-08 00:00:00"),
            ("models", "r3", "2025-01-15 00:00:01"), ("spaces", "s1", "2025-01-20 00:00:00")]
    return spark.createDataFrame(rows, "item string, revision string, t string").selectExpr(
        "item", "revision", "cast(t as timestamp) as committed_at")


def found(df, item="models"):
    return [(str(r["week"]), r["revision"]) for r in df.orderBy("week").collect() if r["item"] == item]


def test_backfill(spark):
    out = weekly_snapshots(revisions(spark), None, backfill_start="2024-12-18", backfill_end="2025-01-29")
    assert found(out) == [("2025-01-01", "r1"), ("2025-01-08", "r2"), ("2025-01-15", "r3"),
                          ("2025-01-22", "r3"), ("2025-01-29", "r3")]
    assert found(out, "spaces") == [("2025-01-15", "s1"), ("2025-01-22", "s1"), ("2025-01-29", "s1")]
    with pytest.raises(ValueError):
        weekly_snapshots(revisions(spark), None, backfill_start="2024-12-18")


def test_incremental(spark):
    out = weekly_snapshots(revisions(spark), "2025-01-21")
    assert found(out) == [("2025-01-01", "r1"), ("2025-01-08", "r2"), ("2025-01-15", "r3")]
    assert found(out, "spaces") == [("2025-01-20", "s1")]
    paths = spark.createDataFrame(
        [("models", "models/2025-01-01/models.parquet"), ("models", "models/2025-01-08/models.parquet"),
         ("spaces", "models/2025-01-08/x")], "item string, path string")
    assert [tuple(r) for r in latest_snapshots(paths).collect()] == [("models", dt.date(2025, 1, 8))]
    out = weekly_snapshots(revisions(spark), "2025-01-21", paths)
    assert found(out) == [("2025-01-15", "r3")] and found(out, "spaces") == [("2025-01-20", "s1")]
    # Everything is saved already.
    assert found(weekly_snapshots(revisions(spark), "2025-01-10", paths)) == []


def test_calendar_is_inclusive(spark):
    starts = start_days(daily_revisions(revisions(spark)))
    weeks = [str(r["week"]) for r in calendar(starts, "2025-01-15").orderBy("week").collect()]
    assert weeks == ["2025-01-01", "2025-01-08", "2025-01-15"]


@pytest.mark.parametrize("zone", ["UTC", "Asia/Tokyo", "America/Los_Angeles"])
def test_weeks_are_utc_in_any_session_zone(spark, zone):
    seconds = [("a", "r1", 1704067199), ("a", "r2", 1704067200), ("a", "r3", 1704672000)]
    epoch = spark.createDataFrame(seconds, "item string, revision string, committed_at long")
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", zone)
        instants = epoch.selectExpr("item", "revision", "timestamp_seconds(committed_at) as committed_at")
        naive = epoch.selectExpr("item", "revision", "timestamp_ntz'1970-01-01' + make_dt_interval(0, 0, 0, committed_at) as committed_at")
        for log in (epoch, instants, naive):
            out = weekly_snapshots(log, "2024-01-15")
            assert found(out, "a") == [("2023-12-31", "r2"), ("2024-01-07", "r3"), ("2024-01-14", "r3")]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
