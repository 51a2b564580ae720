"""Work assignment over a ranked table: batches, waves and a top-N limit."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from hubcat import spec
from hubcat.operators.ordering import dense_index, popularity_order


def batch_size(total: int, most: int = spec.MAX_BATCHES, least: int = spec.MIN_BATCH_ROWS) -> int:
    """Smallest useful batch until ``most`` batches would not cover all rows."""
    return max(least, math.ceil(total / most))


def capped_jobs(total: int, jobs: int = spec.MAX_CAPPED_JOBS,
                rows: int = spec.MIN_BATCH_ROWS) -> tuple[int, int]:
    """(number of jobs, rows per job) with a ceiling on the jobs."""
    count = min(jobs, math.ceil(total / rows))
    return count, (math.ceil(total / count) if count else 0)


def batch_table(spark: SparkSession, total: int, size: int | None = None,
                per_wave: int = spec.JOBS_PER_WAVE) -> DataFrame:
    """One row per batch: its half-open row range, its wave, and its place in the wave."""
    if total < 1:
        raise ValueError(f"nothing to batch: {total} rows")
    size = size or batch_size(total)
    job = F.col("job_id")
    start = job * size
    return spark.range(math.ceil(total / size)).withColumnRenamed("id", "job_id").select(
        "job_id",
        start.alias("start_idx"),
        F.least(start + size, F.lit(total)).alias("end_idx"),
        *wave_columns(job, per_wave),
        F.lit(size > spec.MAX_BATCH_ROWS).alias("oversized"),
    )


def capped_job_table(spark: SparkSession, total: int, jobs: int = spec.MAX_CAPPED_JOBS,
                     rows: int = spec.MIN_BATCH_ROWS) -> DataFrame:
    """Batches for a fixed number of jobs, with a time estimate per job."""
    count, size = capped_jobs(total, jobs, rows)
    start = F.col("job_id") * size
    end = F.least(start + size, F.lit(total))
    return spark.range(count).withColumnRenamed("id", "job_id").select(
        "job_id", start.alias("start_idx"), end.alias("end_idx"), (end - start).alias("rows"),
        F.lit(size * spec.SECONDS_PER_ROW / 60).alias("minutes_per_job"),
    )


def wave_columns(job: Column, per_wave: int = spec.JOBS_PER_WAVE) -> tuple[Column, Column]:
    return (F.floor(job / per_wave).cast("long").alias("wave"),
            F.pmod(job, F.lit(per_wave)).cast("long").alias("wave_job_id"))


def ranked(df: DataFrame, score: str = "paper_upvotes", key: str = "paper_id") -> DataFrame:
    """Rows with their 0-based ``position`` in popularity order."""
    return dense_index(df, popularity_order(score, key))


def position_slice(indexed: DataFrame, start: int, end: int) -> DataFrame:
    """Rows of one batch: positions in [start, end)."""
    return indexed.where((F.col("position") >= start) & (F.col("position") < end))


def with_batches(indexed: DataFrame, size: int, per_wave: int = spec.JOBS_PER_WAVE) -> DataFrame:
    """Batch and wave of every row; each row falls into exactly one batch."""
    batch = F.floor(F.col("position") / size).cast("long")
    return indexed.withColumn("batch_id", batch).select(
        "*", *wave_columns(F.col("batch_id"), per_wave)
    )


def keep_top(indexed: DataFrame, n: int | None, columns) -> DataFrame:
    """Null the given columns beyond the first ``n`` positions; all rows stay."""
    if n is None:
        return indexed
    return indexed.withColumns(
        {c: F.when(F.col("position") < n, F.col(c)) for c in columns}
    )
