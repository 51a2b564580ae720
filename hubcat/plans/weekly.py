"""Weekly snapshots of all items in one job."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from hubcat.operators.weekly import latest_snapshots, midnight, weekly_revisions
from hubcat.sources.publish import publish, read_published
from hubcat.sources.snapshots import read_log


def weekly_snapshots(revisions: DataFrame, today, saved_paths: DataFrame | None = None,
                     backfill_start=None, backfill_end=None) -> DataFrame:
    """Incremental selection up to ``today``, or an explicit backfill range.

    A backfill needs both ends.
    """
    if (backfill_start is None) != (backfill_end is None):
        raise ValueError("a backfill needs both a start and an end date")
    if backfill_start is not None:
        return weekly_revisions(revisions, backfill_end, backfill_start=backfill_start)
    latest = latest_snapshots(saved_paths) if saved_paths is not None else None
    return weekly_revisions(revisions, today, latest)


def resume_weeks(spark: SparkSession, log_path: str, schema: str, path: str, today) -> int:
    """Publish the weeks that are missing at ``path`` up to ``today``; the number of the manifest.

    Each item's last published week says where its part of the log is to be read on: from the day after that week, as the
    week already has the last revision before. That revision stands in for all earlier ones. Weeks are the same as from the
    whole log, as long as it only grows at its end. A run that finds nothing new publishes nothing, and gives 0.
    """
    try:
        done = read_published(spark, path).groupBy("item").agg(F.max(F.struct("week", "revision")).alias("last")).select("item", "last.week", "last.revision")
    except ValueError:
        done = None
    if done is None:
        weeks = weekly_revisions(read_log(spark, log_path, schema), today)
    else:
        seen = done.select("item", F.date_add("week", 7).alias("day"))
        fresh = read_log(spark, log_path, schema, seen).select("item", "revision", "committed_at")
        kind = fresh.schema["committed_at"].dataType
        # The last known revision, as if committed on the last day of its week.
        known = done.select("item", "revision", midnight(F.date_add("week", 6), kind).alias("committed_at"))
        latest = done.select("item", F.col("week").alias("latest_saved"))
        weeks = weekly_revisions(fresh.unionByName(known), today, latest)
    return 0 if weeks.isEmpty() else publish(weeks, path, ("item", "week"))
