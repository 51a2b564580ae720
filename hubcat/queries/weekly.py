"""Weekly as-of selection: event types as items, events as revisions."""

from __future__ import annotations

from pyspark.sql import functions as F

from hubcat.operators.sketches import merged_organizations, merged_tags, weekly_sketches
from hubcat.operators.weekly import latest_snapshots
from hubcat.plans.weekly import resume_weeks, weekly_snapshots
from hubcat.queries.mapping import table
from hubcat.session import scratch_path
from hubcat.sources.publish import publish, read_published
from hubcat.sources.snapshots import write_log

TODAY, START, END = "2024-02-20", "2023-12-18", "2024-02-12"


def _revisions(spark, sf):
    return table(spark, sf, "events").select(
        F.col("event_type").alias("item"), F.concat(F.lit("r"), "event_id").alias("revision"),
        F.col("ts").alias("committed_at"))


def _saved(spark, sf):
    """Paths of earlier snapshots: big events saved their week, other folders are noise."""
    return table(spark, sf, "events").selectExpr(
        "event_type as item",
        "case when value > 100 then event_type else 'other' end || '/' || "
        "cast(cast(ts as date) as string) || '/' || event_type || '.parquet' as path")


def _text(df):
    return df.select("item", F.col("week").cast("string").alias("week"), "revision")


def j5_weekly_asof(spark, sf):
    return _text(weekly_snapshots(_revisions(spark, sf), TODAY))


def j5_zoned_weeks(spark, sf):
    """The same commits as instants: UTC days, whatever the session's time zone."""
    since = ("datediff(ts, date '1970-01-01') * 86400000000L + hour(ts) * 3600000000L + minute(ts) * 60000000L"
             " + cast(extract(second from ts) * 1000000 as bigint)")
    zoned = table(spark, sf, "events").selectExpr(
        "event_type as item", "'r' || event_id as revision", f"timestamp_micros({since}) as committed_at")
    return _text(weekly_snapshots(zoned, TODAY))


def t2_incremental(spark, sf):
    return _text(weekly_snapshots(_revisions(spark, sf), TODAY, _saved(spark, sf)))


def t2_resumed_log(spark, sf):
    """Weeks published up to a day, then the missing ones from the later part of the log alone."""
    log, path = scratch_path(spark, "log"), scratch_path(spark, "weeks")
    write_log(_revisions(spark, sf), log)
    for today in ("2024-01-10", TODAY, TODAY):
        resume_weeks(spark, log, "item string, revision string, committed_at timestamp_ntz", path, today)
    return _text(read_published(spark, path))


def t3_backfill(spark, sf):
    return _text(weekly_snapshots(_revisions(spark, sf), None, backfill_start=START,
                                  backfill_end=END))


def _week_sketches(spark, sf):
    """Weeks of events, published week by week as a run would, with users as organisations."""
    path = scratch_path(spark, "sketches")
    rows = table(spark, sf, "events").selectExpr("cast(date_trunc('week', ts) as date) as week", "user_id", "array(event_type, props, ' ' || upper(event_type)) as tags")
    publish(weekly_sketches(rows, F.col("week"), "user_id"), path, ("week",))
    return read_published(spark, path)


def a4_merged_weeks(spark, sf):
    return merged_organizations(_week_sketches(spark, sf))


def a6_merged_weeks(spark, sf):
    return merged_tags(_week_sketches(spark, sf))


def a18_latest_snapshot(spark, sf):
    return latest_snapshots(_saved(spark, sf)).select(
        "item", F.col("latest_saved").cast("string").alias("latest_saved"))


QUERIES = {f.__name__: f for f in (
    j5_weekly_asof, j5_zoned_weeks, t2_incremental, t2_resumed_log, a4_merged_weeks, a6_merged_weeks, t3_backfill, a18_latest_snapshot)}

_LATEST = """latest as (select event_type as item, max(cast(ts as date)) as latest_saved
  from events where value > 100 group by 1)"""


def _asof(weeks: str, extra: str = "") -> str:
    return f"""with {extra} weeks as ({weeks})
      select w.item, cast(cast(w.week as date) as varchar) as week, 'r' || cast(
        arg_max(e.event_id, (e.ts, 'r' || cast(e.event_id as varchar))) as varchar) as revision
      from weeks w join events e on e.event_type = w.item and e.ts < w.week + interval 7 day
      group by w.item, w.week"""


ORACLE = {
    "j5_weekly_asof": _asof(f"""select event_type as item, unnest(generate_series(
        cast(min(cast(ts as date)) as timestamp), timestamp '{TODAY}', interval 7 day)) as week
        from events group by 1"""),
    "t2_incremental": _asof(f"""select f.item, unnest(generate_series(
        cast(coalesce(latest_saved + 7, first_day) as timestamp), timestamp '{TODAY}',
        interval 7 day)) as week
        from (select event_type as item, min(cast(ts as date)) as first_day from events group by 1) f
        left join latest l on l.item = f.item""", _LATEST + ","),
    "t3_backfill": _asof(f"""select event_type as item, unnest(generate_series(
        timestamp '{START}', timestamp '{END}', interval 7 day)) as week from events group by 1"""),
    "a18_latest_snapshot": f"""with {_LATEST} select item,
        cast(latest_saved as varchar) as latest_saved from latest""",
}

ORACLE["j5_zoned_weeks"] = ORACLE["t2_resumed_log"] = ORACLE["j5_weekly_asof"]
ORACLE["a4_merged_weeks"] = "select count(*) as rows, count(distinct user_id) as organizations from events"
ORACLE["a6_merged_weeks"] = """select tag, count(*) as at_least, count(*) as at_most from (
    select lower(event_type) as tag from events union all select lower(event_type) from events union all select lower(trim(props)) from events) group by tag"""
