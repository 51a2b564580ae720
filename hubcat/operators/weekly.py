"""Weekly as-of selection of revisions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql import types as T

from hubcat.functions.text import snapshot_date


def latest_snapshots(paths: DataFrame, item: str = "item", path: str = "path") -> DataFrame:
    """Latest saved week per item, from ``item/date/...`` paths."""
    return (
        paths.select(F.col(item).alias("item"),
                     snapshot_date(F.col(path), F.col(item)).alias("saved"))
        .where(F.col("saved").isNotNull())
        .groupBy("item").agg(F.max("saved").alias("latest_saved"))
    )


def utc_day(when: Column, dtype: T.DataType) -> Column:
    """Calendar day in UTC, whatever the session's time zone: of instants, of epoch seconds, of zoneless times as they stand."""
    if isinstance(dtype, T.TimestampType):
        days = F.floor(F.unix_micros(when) / F.lit(86_400_000_000))
    elif isinstance(dtype, T.NumericType):
        days = F.floor(when / F.lit(86_400))
    else:
        return F.to_date(when)
    return F.date_add(F.lit("1970-01-01").cast("date"), days.cast("int"))


def midnight(day: Column, dtype: T.DataType) -> Column:
    """The start of a UTC day in the type that a log's times have."""
    if isinstance(dtype, T.TimestampType):
        return F.timestamp_micros(F.unix_date(day).cast("long") * 86_400_000_000)
    return (F.unix_date(day).cast("long") * 86_400 if isinstance(dtype, T.NumericType) else day).cast(dtype)


def daily_revisions(revisions: DataFrame) -> DataFrame:
    """Last revision per item and UTC day of ``(item, revision, committed_at)``.

    ``committed_at`` is a timestamp with or without zone, or epoch seconds. Week bounds fall on midnight, so a day is as fine as the as-of needs. This shrinks
    the log before anything is ordered: an item never holds more rows than days.
    """
    return (
        revisions.groupBy("item", utc_day(F.col("committed_at"), revisions.schema["committed_at"].dataType).alias("day"))
        .agg(F.max(F.struct("committed_at", "revision")).alias("last"))
        .select("item", "day", F.col("last.revision").alias("revision"))
    )


def start_days(daily: DataFrame, latest: DataFrame | None = None) -> DataFrame:
    """First week per item: a week after the latest saved one, else the first commit day."""
    first = daily.groupBy("item").agg(F.min("day").alias("first_day"))
    if latest is None:
        return first.select("item", F.col("first_day").alias("start"))
    return first.join(latest, "item", "left").select(
        "item", F.coalesce(F.date_add("latest_saved", 7), "first_day").alias("start"))


def calendar(starts: DataFrame, end) -> DataFrame:
    """Weeks from each start to ``end`` inclusive, in steps of seven days."""
    last = F.lit(end).cast("date")
    return starts.where(F.col("start") <= last).select(
        "item", F.explode(F.sequence("start", last, F.expr("interval 7 days"))).alias("week"))


def weekly_revisions(revisions: DataFrame, end, latest: DataFrame | None = None,
                     backfill_start=None) -> DataFrame:
    """Latest revision committed before the end of each week, as ``(item, week, revision)``.

    Empty weeks repeat the last revision; weeks before the first commit give no row. With
    ``backfill_start`` all items use the same explicit range.
    """
    daily = daily_revisions(revisions)
    if backfill_start is None:
        starts = start_days(daily, latest)
    else:
        starts = daily.select("item").distinct().withColumn(
            "start", F.lit(backfill_start).cast("date"))
    weeks = calendar(starts, end)
    # A week sees commits up to its seventh day, so it is ordered after that day.
    marks = daily.select("item", "day", "revision", F.lit(0).alias("kind"),
                         F.lit(None).cast("date").alias("week")).unionByName(
        weeks.select("item", F.date_add("week", 6).alias("day"),
                     F.lit(None).cast("string").alias("revision"),
                     F.lit(1).alias("kind"), "week"))
    upto = Window.partitionBy("item").orderBy("day", "kind").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    return (
        marks.withColumn("revision", F.last("revision", ignorenulls=True).over(upto))
        .where((F.col("kind") == 1) & F.col("revision").isNotNull())
        .select("item", "week", "revision")
    )
