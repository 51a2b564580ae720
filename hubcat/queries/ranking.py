"""Popularity order, batches, waves and limits over orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from hubcat.operators import batches as b
from hubcat.queries.mapping import table

TOP = 1000


def _ranked(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return b.ranked(orders, "o_totalprice", "o_orderkey")


def r2_slice(spark, sf):
    return b.position_slice(_ranked(spark, sf), 200, 400).select("o_orderkey", "position")


def r3_batches(spark, sf):
    indexed = _ranked(spark, sf)
    size = b.batch_size(indexed.count())
    return b.with_batches(indexed, size).select("o_orderkey", "position", "batch_id")


def r4_batch_table(spark, sf):
    return b.batch_table(spark, table(spark, sf, "lineitem").count())


def r5_capped_jobs(spark, sf):
    return b.capped_job_table(spark, table(spark, sf, "lineitem").count())


def r6_waves(spark, sf):
    return b.with_batches(_ranked(spark, sf), 200).groupBy("wave").agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("batch_id").alias("batches"),
        F.max("wave_job_id").alias("last_job"))


def r7_top_limit(spark, sf):
    return b.keep_top(_ranked(spark, sf), TOP, ["o_custkey"]).select("o_orderkey", "o_custkey")


QUERIES = {f.__name__: f for f in (
    r2_slice, r3_batches, r4_batch_table, r5_capped_jobs, r6_waves, r7_top_limit)}

_RANKED = """ranked as (select o_orderkey, o_custkey, row_number() over (
  order by o_totalprice desc nulls last, o_orderkey) - 1 as position from orders)"""
_SIZE = "greatest(200, cast(ceil((select count(*) from {t}) / 200.0) as bigint))"

ORACLE = {
    "r2_slice": f"""with {_RANKED} select o_orderkey, position from ranked
        where position >= 200 and position < 400""",
    "r3_batches": f"""with {_RANKED} select o_orderkey, position,
        position // {_SIZE.format(t='orders')} as batch_id from ranked""",
    "r4_batch_table": f"""with n as (select count(*) as total, {_SIZE.format(t='lineitem')} as size
          from lineitem),
        jobs as (select unnest(generate_series(0, cast(ceil(total * 1.0 / size) as bigint) - 1))
          as job_id, total, size from n)
        select job_id, job_id * size as start_idx, least(job_id * size + size, total) as end_idx,
          job_id // 15 as wave, job_id % 15 as wave_job_id, size > 1000 as oversized from jobs""",
    "r5_capped_jobs": """with n as (select count(*) as total,
          least(20, cast(ceil(count(*) / 200.0) as bigint)) as jobs from lineitem),
        s as (select *, cast(ceil(total * 1.0 / jobs) as bigint) as size from n),
        j as (select unnest(generate_series(0, jobs - 1)) as job_id, * from s)
        select job_id, job_id * size as start_idx, least(job_id * size + size, total) as end_idx,
          least(job_id * size + size, total) - job_id * size as rows,
          size * 3 / 60.0::double as minutes_per_job from j""",
    "r6_waves": f"""with {_RANKED}, b as (select *, position // 200 as batch_id from ranked)
        select batch_id // 15 as wave, count(*) as rows, count(distinct batch_id) as batches,
          max(batch_id % 15) as last_job from b group by 1""",
    "r7_top_limit": f"""with {_RANKED} select o_orderkey,
        case when position < {TOP} then o_custkey end as o_custkey from ranked""",
}
