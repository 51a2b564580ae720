"""Shared snapshots of a fetched dump, and the weekly snapshot layout."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from hubcat.functions.times import instant
from hubcat.operators.weekly import utc_day


def write_snapshot(df: DataFrame, path: str, downloaded_at) -> DataFrame:
    """Write the rows to ``path/data`` and one metadata row to ``path/meta``; a time without a zone is UTC."""
    df.write.mode("overwrite").parquet(f"{path}/data")
    spark = df.sparkSession
    spark.read.parquet(f"{path}/data").agg(F.count(F.lit(1)).alias("total_rows")).select(
        instant(downloaded_at).alias("data_download_timestamp"), "total_rows"
    ).write.mode("overwrite").parquet(f"{path}/meta")
    return spark.read.parquet(f"{path}/meta")


def read_snapshot(spark: SparkSession, path: str,
                  limit: int | None = None) -> tuple[DataFrame, Column]:
    """Rows of a snapshot and its recorded download time, else the current time."""
    df = spark.read.parquet(f"{path}/data")
    if df.isEmpty():
        raise ValueError(f"snapshot {path} is empty")
    stamp = F.current_timestamp()
    try:
        row = spark.read.parquet(f"{path}/meta").select(F.unix_micros("data_download_timestamp")).first()
        if row is not None and row[0] is not None:
            stamp = F.timestamp_micros(F.lit(row[0]).cast("long"))
    except AnalysisException:
        pass
    return (df if limit is None else df.limit(limit)), stamp


def write_weekly(df: DataFrame, path: str) -> None:
    """Store rows with ``item`` and ``week`` as ``item=.../week=...`` folders.

    The weeks that the rows hold are replaced, all other folders stay: a run that is repeated or
    tried again leaves no repeats. ``publish`` in ``sources/publish.py`` replaces all of them in one switch.
    """
    df.write.partitionBy("item", "week").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)


def write_log(revisions: DataFrame, path: str) -> None:
    """Add revisions to a commit log kept by item and UTC day; the days that they bring are written anew, all others stay.

    So a day is always written whole, and reading a day that was fetched twice gives each commit once.
    """
    day = utc_day(F.col("committed_at"), revisions.schema["committed_at"].dataType)
    revisions.withColumn("day", day).write.partitionBy("item", "day").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)


def read_log(spark: SparkSession, path: str, schema: str, seen: DataFrame | None = None) -> DataFrame:
    """Revisions of a log, from where an earlier run stopped.

    ``schema`` names item, revision and committed_at with their types. ``seen(item, day)`` holds for each item the first day
    that is still to be read; only the folders from there on are scanned, of other items all. One row per item comes to the
    driver: items are the files that a repository keeps, a handful.
    """
    log = spark.read.schema(f"{schema}, day date").parquet(path)
    if seen is not None:
        since = [(r["item"], r["day"]) for r in seen.select("item", "day").collect()]
        if since:
            late = F.lit(False)
            for item, day in since:
                late = late | ((F.col("item") == item) & (F.col("day") >= F.lit(day)))
            log = log.where(late | ~F.col("item").isin([item for item, _ in since]))
    return log.drop("day")


def weekly_paths(spark: SparkSession, path: str) -> DataFrame:
    """(item, path) of every stored week, in the form ``item=.../week=...``."""
    stored = spark.read.parquet(path).select("item", "week").distinct()
    return stored.select(
        F.col("item").cast("string").alias("item"),
        F.concat(F.lit("item="), F.col("item"), F.lit("/week="),
                 F.col("week").cast("string")).alias("path"))
