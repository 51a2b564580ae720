"""Sources and sinks: what is written to the shared folder reads back the same."""

from __future__ import annotations

from pyspark.sql import functions as F

from hubcat import spec
from hubcat.operators.citations import batch_totals
from hubcat.operators.taxonomy import read_taxonomy
from hubcat.queries.mapping import table
from hubcat.queries.models import STAMP, DAY, models, text_tags
from hubcat.queries.weekly import END, START, _revisions
from hubcat.plans.weekly import weekly_snapshots
from hubcat.functions.times import utc_text
from hubcat.session import scratch_path
from hubcat.sources.publish import publish, read_published
from hubcat.sources.scans import previous_citations, read_batches
from hubcat.sources.sinks import read_csv, verify, write_counted, write_csv, write_parquet
from hubcat.sources.snapshots import read_snapshot, weekly_paths, write_snapshot, write_weekly


def s5_snapshot_meta(spark, sf):
    path = scratch_path(spark, "snapshot")
    meta = write_snapshot(table(spark, sf, "documents").select("doc_id", "lang", "source"), path, STAMP)
    return meta.select(utc_text(F.col("data_download_timestamp")).alias("downloaded"),
                       "total_rows")


def s6_snapshot_read(spark, sf):
    path = scratch_path(spark, "snapshot")
    write_snapshot(table(spark, sf, "documents").select("doc_id", "lang", "source"), path, STAMP)
    df, stamp = read_snapshot(spark, path)
    return df.select("*", utc_text(stamp).alias("downloaded"))


def s7_previous_cache(spark, sf):
    run = table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("paper_id"),
        F.col("o_totalprice").alias("citation_count"), "o_orderstatus")
    return previous_citations(run, spark)


def s8_batch_files(spark, sf):
    """Two batch folders with unequal columns, read back by pattern."""
    return _batches(spark, sf).select("paper_id", "citation_count", "nation", "batch_file")


def a11_batch_totals(spark, sf):
    """Rows and values of the batches read back; only customers bring a value."""
    return batch_totals(_batches(spark, sf))


def _batches(spark, sf):
    path = scratch_path(spark, "batches")
    table(spark, sf, "customer").select(
        F.col("c_name").alias("paper_id"), F.col("c_acctbal").alias("citation_count")
    ).write.parquet(f"{path}/citations_batch_0")
    table(spark, sf, "supplier").select(
        F.col("s_name").alias("paper_id"), F.col("s_nationkey").alias("nation")
    ).write.parquet(f"{path}/citations_batch_1")
    return read_batches(spark, f"{path}/citations_batch_*")


def s9_taxonomy_file(spark, sf):
    """Region, nation and segment as a JSON tree; at most 5 x 25 x segments leaves."""
    leaves = (
        table(spark, sf, "customer").select("c_nationkey", "c_mktsegment").distinct()
        .join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    subs = leaves.groupBy("r_name", "n_name").agg(
        F.array_sort(F.collect_set("c_mktsegment")).alias("topics"))
    entry = F.struct(F.col("key"), F.col("value"))
    cats = subs.select("r_name", F.col("n_name").alias("key"), F.col("topics").alias("value")).groupBy(
        "r_name").agg(F.array_sort(F.collect_list(entry)).alias("value")).withColumnRenamed("r_name", "key")
    tree = cats.agg(F.array_sort(F.collect_list(entry)).alias("cats")).select(F.map_from_entries(
        F.transform("cats", lambda c: F.struct(c["key"], F.map_from_entries(c["value"])))).alias("t"))
    path = scratch_path(spark, "taxonomy")
    tree.select(F.to_json("t").alias("value")).coalesce(1).write.text(path)
    return read_taxonomy(spark, path).select("ordinal", "category", "subcategory", "topic", "label", "level")


def s10_parquet(spark, sf):
    path = scratch_path(spark, "models")
    write_parquet(models(spark, sf), path)
    return spark.read.parquet(path).select("id", "organization", "size_category", F.size("tags").alias("n_tags"))


def s11_csv(spark, sf):
    """Whole texts, nested values, outer white space, line ends, quotes, empty and null survive the CSV."""
    path = scratch_path(spark, "csv")
    odd = F.expr("""case doc_id % 4 when 0 then ' ' || lang || chr(9) when 1 then lang || '"' || chr(13) || chr(10) || 'x,'
        when 2 then '' end as odd""")
    write_csv(text_tags(spark, sf).join(table(spark, sf, "documents").select("doc_id", "text", odd), "doc_id"), path)
    back = read_csv(spark, path, "doc_id long, lang string, tags string, text string, odd string")
    return back.select("doc_id", "lang", F.size(F.from_json("tags", "array<string>")).alias("n_tags"),
                       F.md5("text").alias("text_md5"), F.md5("odd").alias("odd_md5"))


def s13_verify(spark, sf):
    path = scratch_path(spark, "models")
    write_parquet(models(spark, sf), path)
    return verify(spark, path)


def m1_counted_write(spark, sf):
    """The models table written in one pass, with its flag counts, known sizes and empty columns."""
    flags = [c for c in spec.MODELS.final if c.startswith(("has_", "is_"))]
    numbers = {**{c: F.count_if(F.col(c)) for c in flags}, "known_sizes": F.count_if(F.col("params") > 0), "created": F.count("createdAt"),
               "without_tags": F.count_if(F.size("tags") == 0), "likes": F.sum("likes")}
    found = write_counted(models(spark, sf), scratch_path(spark, "models"), numbers)
    return spark.createDataFrame([tuple(found[c] for c in ("rows", *numbers))], ", ".join(f"{c} {'double' if c == 'likes' else 'long'}" for c in ("rows", *numbers)))


def s14_weekly_layout(spark, sf):
    """Weekly selection stored by item and week, its last weeks replaced by a backfill."""
    path = scratch_path(spark, "weekly")
    weeks = weekly_snapshots(_revisions(spark, sf), None, backfill_start=START, backfill_end=END)
    for _ in range(2):  # the same weeks again: they are replaced
        write_weekly(weeks.withColumn("run", F.lit("first")), path)
    write_weekly(weeks.where("week >= date '2024-01-20'").withColumn("run", F.lit("backfill")), path)
    stored = spark.read.parquet(path).groupBy("item", F.col("week").cast("string").alias("week"), "run").agg(
        F.count(F.lit(1)).alias("rows"))
    paths = weekly_paths(spark, path).groupBy("item").agg(F.count(F.lit(1)).alias("weeks"))
    return stored.join(paths, "item")


def s14_published_weeks(spark, sf):
    """Weeks published, published again, one run stopped before its switch, and the last weeks replaced: what readers see."""
    path = scratch_path(spark, "weekly")
    weeks = weekly_snapshots(_revisions(spark, sf), None, backfill_start=START, backfill_end=END)
    late = weeks.where("week >= date '2024-01-20'")

    def stopped(rows, count):
        raise InterruptedError

    for name, part, check in (("first", weeks, None), ("second", weeks, None), ("stopped", weeks, stopped), ("third", late, None)):
        try:
            publish(part.withColumn("by", F.lit(name)), path, ("item", "week"), check)
        except InterruptedError:
            pass
    return read_published(spark, path).select("item", F.col("week").cast("string").alias("week"), "revision", "by")


def s10_published_models(spark, sf):
    """The models table published twice; readers see one of them, and the earlier one by its number."""
    path, made = scratch_path(spark, "models"), models(spark, sf)
    publish(made.where(F.col("likes") > 10), path)
    publish(made, path)
    return read_published(spark, path).select("id", "organization", F.lit("now").alias("state")).union(
        read_published(spark, path, 1).select("id", "organization", F.lit("before").alias("state")))


QUERIES = {f.__name__: f for f in (
    s5_snapshot_meta, s6_snapshot_read, s7_previous_cache, s8_batch_files, a11_batch_totals, s9_taxonomy_file,
    s10_parquet, s10_published_models, s11_csv, s13_verify, m1_counted_write, s14_weekly_layout, s14_published_weeks)}


def _oracle():
    from hubcat.queries.models import _MODELS, _TEXT_TAGS
    from hubcat.queries.weekly import ORACLE as weekly
    return {
        "s5_snapshot_meta": f"select '{DAY}' as downloaded, count(*) as total_rows from documents",
        "s6_snapshot_read": f"select doc_id, lang, source, '{DAY}' as downloaded from documents",
        "s7_previous_cache": """select cast(o_orderkey as varchar) as paper_id,
            o_totalprice as citation_count from orders""",
        "s8_batch_files": """select c_name as paper_id, c_acctbal as citation_count,
            cast(null as integer) as nation, 'citations_batch_0' as batch_file from customer
            union all select s_name, null, s_nationkey, 'citations_batch_1' from supplier""",
        "a11_batch_totals": """with b as (select 'citations_batch_0' as batch_file, c_acctbal as v from customer
            union all select 'citations_batch_1', null from supplier)
            select batch_file, count(*) as papers, count(v) as with_citations from b
            group by rollup (batch_file)""",
        "s9_taxonomy_file": """with leaves as (select distinct r_name, n_name, c_mktsegment from customer
              join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey),
            p as (select *, dense_rank() over (order by r_name) - 1 as ci,
              dense_rank() over (partition by r_name order by n_name) as si,
              row_number() over (partition by r_name, n_name order by c_mktsegment) as ti from leaves),
            n as (select distinct ci, 0 as si, 0 as ti, r_name as category, null::varchar as subcategory,
              null::varchar as topic from p
              union select ci, si, 0, r_name, n_name, null from p
              union select ci, si, ti, r_name, n_name, c_mktsegment from p)
            select (ci * 4398046511104 + si * 2097152 + ti)::bigint as ordinal, category, subcategory, topic,
              coalesce(topic, subcategory, category) as label,
              case when ti > 0 then 'topic' when si > 0 then 'subcategory' else 'category' end as level
            from n""",
        "s10_parquet": f"""with {_MODELS} select id, organization, size_category,
            len(tags)::integer as n_tags from models""",
        "s10_published_models": f"""with {_MODELS} select id, organization, 'now' as state from models
            union all select id, organization, 'before' from models where likes > 10""",
        "m1_counted_write": f"""with {_MODELS} select count(*) as rows, {", ".join(
            f"count(*) filter ({c}) as {c}" for c in spec.MODELS.final if c.startswith(("has_", "is_")))},
            count(*) filter (params > 0) as known_sizes, 0::bigint as created, count(*) filter (len(tags) = 0) as without_tags, sum(likes) as likes from models""",
        "s14_published_weeks": f"""select item, week, revision,
            case when week >= '2024-01-20' then 'third' else 'second' end as by from ({weekly['t3_backfill']})""",
        "s11_csv": f"""with {_TEXT_TAGS} select doc_id, t.lang, len(tags)::integer as n_tags,
            md5(text) as text_md5, md5(case doc_id % 4 when 0 then ' ' || t.lang || chr(9)
              when 1 then t.lang || '"' || chr(13) || chr(10) || 'x,' when 2 then '' end) as odd_md5
            from tagged t join documents using (doc_id)""",
        "s13_verify": f"""with {_MODELS} select count(*) as rows, {len(spec.MODELS.final)}::integer as columns,
            count(*) filter (has_robot) as flagged, count(distinct organization) as organizations
            from models""",
        "s14_weekly_layout": f"""with w as (select event_type as item, unnest(generate_series(
              timestamp '{START}', timestamp '{END}', interval 7 day)) as week from events group by 1),
            s as (select distinct item, week from w join events e on e.event_type = w.item
              and e.ts < w.week + interval 7 day)
            select item, cast(cast(week as date) as varchar) as week,
              case when week >= timestamp '2024-01-20' then 'backfill' else 'first' end as run,
              1::bigint as rows, count(*) over (partition by item) as weeks from s""",
    }


ORACLE = _oracle()
