"""Models and datasets: conform, scalars, tags, flags, quality reports."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from hubcat import spec
from hubcat.functions.sizes import size_bucket, size_of
from hubcat.functions.tags import joined_tags
from hubcat.functions.text import organization_name, organization_of_id
from hubcat.functions.times import utc_text
from hubcat.operators import reports
from hubcat.operators.conform import column_status, conform, require_key_values
from hubcat.operators.flags import inspect_row, with_flags, with_normal_tags
from hubcat.plans.models import datasets_table, models_table
from hubcat.queries.mapping import (BUCKET_SQL, MODEL_ROWS, MODEL_TRUTH, PART_FLAGS, flag_sql,
                                    mapped, mapped_sql, strip_sql, table, dealt)
from hubcat.session import scratch_path
from hubcat.sources.scans import scan, scan_catalog
from hubcat.sources.sinks import write_keyed

STAMP = dt.datetime(2025, 1, 8, 12, 0, 0)
DAY = "2025-01-08 12:00:00"
FLAGS = [*PART_FLAGS, "has_science", "is_audio_speech", "is_biomed"]


def raw_models(spark: SparkSession, sf: str) -> DataFrame:
    columns = ("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice")
    return mapped(dealt(spark, sf, "part", *columns), MODEL_ROWS)


def models(spark: SparkSession, sf: str) -> DataFrame:
    return models_table(raw_models(spark, sf), STAMP, keyword_map=PART_FLAGS)


def text_tags(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with the words of their whole text as tags."""
    words = dealt(spark, sf, "documents", "doc_id", "lang", "text").select(
        "doc_id", "lang", F.split("text", " ", -1).alias("tags"))
    return with_normal_tags(words)


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


def s1_pruned_scan(spark, sf):
    return scan(spark, f"{sf}/documents.parquet", ("doc_id", "lang", "source")).withColumn(
        "downloaded", F.lit(DAY))


def s4_limit(spark, sf):
    return scan(spark, f"{sf}/documents.parquet", ("doc_id",), limit=100).agg(
        F.count(F.lit(1)).alias("rows"))


def p1_conform(spark, sf):
    raw = raw_models(spark, sf).drop("tags", "safetensors")
    out = conform(raw, spec.MODELS, STAMP)
    return out.select(
        "id", "downloads", "downloadsAllTime", "likes", "pipeline_tag",
        F.size("tags").alias("n_tags"), F.col("safetensors").isNull().alias("no_size"),
        utc_text(F.col("data_download_timestamp")).alias("downloaded"))


def p2_conform_datasets(spark, sf):
    raw = raw_models(spark, sf).select("id", "downloads", "likes")
    return conform(raw, spec.DATASETS, STAMP).select("id", "downloads", "downloadsAllTime", "likes")


def p3_conform_papers(spark, sf):
    raw = table(spark, sf, "documents").selectExpr(
        "cast(doc_id as string) as paper_id", "source as title",
        "case when lang = 'en' then cast(n_chars as string) when lang = 'fr' then 'many' end "
        "as paper_upvotes")
    return conform(raw, spec.PAPERS, STAMP).select(
        "paper_id", "title", "paper_upvotes", "numComments",
        F.col("`paper_organization.name`").alias("organization"))


def p7_key_values(spark, sf):
    """The key check passes for orders, so their rows are counted."""
    raw = table(spark, sf, "orders").selectExpr("cast(o_orderkey as string) as paper_id")
    checked = require_key_values(conform(raw, spec.PAPERS, STAMP), "paper_id")
    return checked.agg(F.count("paper_id").alias("papers"))


def p11_lookup(spark, sf):
    words = table(spark, sf, "documents").select("doc_id", F.split("text", " ", -1).alias("tags"))
    flagged = with_flags(with_normal_tags(words))
    return inspect_row(flagged, 7, key="doc_id").select(
        "doc_id", F.size("tags").alias("n_tags"), F.md5("tag_text").alias("text_md5"),
        *spec.MODEL_FLAGS, "has_science", "is_biomed")


def p11_stored_lookup(spark, sf):
    """The same row of the written table, found by its row group's range and bloom filter."""
    path = scratch_path(spark, "keyed")
    words = table(spark, sf, "documents").select("doc_id", F.split("text", " ", -1).alias("tags"))
    write_keyed(with_flags(with_normal_tags(words)), path, "doc_id", group_bytes=1 << 20)
    return inspect_row(spark.read.parquet(path), 7, key="doc_id").select(
        "doc_id", F.size("tags").alias("n_tags"), F.md5("tag_text").alias("text_md5"),
        *spec.MODEL_FLAGS, "has_science", "is_biomed")


def f1_organization(spark, sf):
    df = raw_models(spark, sf)
    return df.select("id", organization_of_id(F.col("id")).alias("organization"))


def f1_page_hosts(spark, sf):
    ids = table(spark, sf, "pages").select(
        "page_id", F.regexp_replace("url", "^https?://", "").alias("id"))
    return ids.select("page_id", organization_of_id(F.col("id")).alias("organization"))


def f2_size_parse(spark, sf):
    df = raw_models(spark, sf)
    size = size_of(F.col("safetensors"), df.schema["safetensors"].dataType)
    return df.select("id", F.round(size, 6).alias("params"))


def f2_event_props(spark, sf):
    df = table(spark, sf, "events")
    size = size_of(F.col("props"), df.schema["props"].dataType, field="k", divisor=10.0)
    return df.select("event_id", size.alias("size"))


def f3_size_bucket(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", size_bucket(F.col("value") / 10 - 1).alias("size_category"))


def f5_org_name(spark, sf):
    df = table(spark, sf, "customer").selectExpr(
        "c_custkey", "named_struct('name', case when c_nationkey < 10 then c_mktsegment "
        "when c_nationkey < 15 then '' end, 'fullname', case when c_acctbal > 5000 then c_name "
        "else '' end, '_id', case when c_acctbal > 0 then cast(c_custkey as string) end) as org")
    return df.select("c_custkey", organization_name(F.col("org"), df.schema["org"].dataType)
                     .alias("organization_name"))


def f6_tags(spark, sf):
    df = with_normal_tags(raw_models(spark, sf).select("id", "tags"))
    return df.select("id", F.array_join("tags", "|").alias("tags"), F.size("tags").alias("n_tags"))


def f7_joined_tags(spark, sf):
    return text_tags(spark, sf).select("doc_id", F.md5(joined_tags(F.col("tags"))).alias("joined_md5"))


def f8_flags(spark, sf):
    return models(spark, sf).select("id", *FLAGS)


def f8_text_flags(spark, sf):
    flags = [*spec.MODEL_FLAGS, "has_science", "is_biomed"]
    return with_flags(text_tags(spark, sf)).select("doc_id", *flags)


def m1_models_table(spark, sf):
    return _rounded(models(spark, sf), "params").select(
        *(F.array_join("tags", "|").alias("tags") if c == "tags" else
          utc_text(F.col(c)).alias(c) if c in ("data_download_timestamp", "createdAt") else c
          for c in spec.MODELS.final), F.typeof("createdAt").alias("created_type"))


def s2_dataset_scan(spark, sf):
    """Raw datasets read back pruned: columns that the specification doesn't name are not read."""
    path = scratch_path(spark, "datasets")
    raw_models(spark, sf).withColumn("card", F.lit("x")).write.parquet(path)
    return _with_names(scan_catalog(spark, path, spec.DATASETS).select("*", F.size(F.split("tags", ",")).alias("n_tags")).drop("tags"))


def s3_paper_scan(spark, sf):
    """Raw papers read back; dots belong to the names."""
    path = scratch_path(spark, "papers")
    table(spark, sf, "documents").selectExpr(
        "cast(doc_id as string) as paper_id", "lang as `paper_organization.name`", "source as `paper_organization._id`",
        "n_chars as paper_upvotes", "text as body").write.parquet(path)
    found = scan_catalog(spark, path, spec.PAPERS)
    return _with_names(found.select("paper_id", "paper_upvotes", F.col("`paper_organization.name`").alias("name"), F.col("`paper_organization._id`").alias("org")))


def _with_names(df: DataFrame) -> DataFrame:
    return df.withColumn("names", F.lit(",".join(df.columns)))


def p10_column_status(spark, sf):
    return column_status(table(spark, sf, "documents"), ("doc_id", "text", "summary", "n_chars"))


def m2_datasets_table(spark, sf):
    out = datasets_table(raw_models(spark, sf), STAMP, keyword_map=PART_FLAGS)
    return out.select(
        *(F.array_join("tags", "|").alias("tags") if c == "tags" else
          utc_text(F.col(c)).alias(c) if c == "data_download_timestamp" else c
          for c in spec.DATASETS.final))


def a1_duplicates(spark, sf):
    return reports.duplicate_count(table(spark, sf, "orders"), "o_custkey")


def a2_coverage(spark, sf):
    df = table(spark, sf, "events").selectExpr("case when value > 20 then value end as value")
    return _rounded(reports.value_coverage(df, "value"), "percent")


def a3_flag_counts(spark, sf):
    return _rounded(reports.flag_counts(models(spark, sf), FLAGS), "percent")


def a4_organizations(spark, sf):
    return reports.organization_count(models(spark, sf), "organization")


def a5_tag_stats(spark, sf):
    return _rounded(reports.tag_length_stats(text_tags(spark, sf)), "mean_tags")


def a6_top_tags(spark, sf):
    return reports.top_tags(text_tags(spark, sf))


def a6_unique_tags(spark, sf):
    return reports.unique_tags(text_tags(spark, sf))


def a7_value_stats(spark, sf):
    return _rounded(reports.value_stats(table(spark, sf, "lineitem"), "l_extendedprice"),
                    "mean", "median", "max").withColumn("total", F.round("total", 2))


def a8_value_counts(spark, sf):
    df = models(spark, sf).withColumn("size", F.nullif("size_category", F.lit("Unknown")))
    return _rounded(reports.label_distribution(df, "size", 10), "percent")


def a14_known_sizes(spark, sf):
    return reports.known_sizes(models(spark, sf))


QUERIES = {f.__name__: f for f in (
    s1_pruned_scan, s4_limit, p1_conform, p2_conform_datasets, p3_conform_papers, p7_key_values, p11_lookup, p11_stored_lookup,
    f1_organization, f1_page_hosts, f2_size_parse, f2_event_props, f3_size_bucket, f5_org_name,
    f6_tags, f7_joined_tags, f8_flags, f8_text_flags, m1_models_table, m2_datasets_table,
    s2_dataset_scan, s3_paper_scan, p10_column_status,
    a1_duplicates, a2_coverage, a3_flag_counts, a4_organizations, a5_tag_stats, a6_top_tags,
    a6_unique_tags, a7_value_stats, a8_value_counts, a14_known_sizes,
)}

# ---------------------------------------------------------------- DuckDB side

_TEXT_TAGS = f"""
tagged as (select doc_id, lang, list_filter(
    list_transform(string_split(text, ' '), lambda x: {strip_sql('x')}), lambda x: x <> '') as tags
  from documents),
joined as (select *, lower(array_to_string(tags, '~~~')) as joined from tagged)
"""
_MODELS = f"""
truth as ({MODEL_TRUTH}),
j as (select *, lower(array_to_string(tags, '~~~')) as joined from truth),
f as (select *, {BUCKET_SQL} as size_category, {flag_sql(PART_FLAGS)} from j),
models as (select *, has_audio or has_speech or regexp_matches(pipeline_tag, 'audio|speech', 'i')
  as is_audio_speech, has_bio or has_med as is_biomed from f)
"""
_FLAG_LIST = ", ".join(FLAGS)

ORACLE = {
    "s1_pruned_scan": f"select doc_id, lang, source, '{DAY}' as downloaded from documents",
    "s4_limit": "select least(count(*), 100) as rows from documents",
    "p1_conform": f"""with {_MODELS} select id, downloads, 0.0::double as "downloadsAllTime", likes,
        pipeline_tag, 0::integer as n_tags, true as no_size, '{DAY}' as downloaded from models""",
    "p2_conform_datasets": f"""with {_MODELS} select id, downloads,
        0.0::double as "downloadsAllTime", likes from models""",
    "p3_conform_papers": """select cast(doc_id as varchar) as paper_id, source as title,
        case when lang = 'en' then n_chars::double else 0.0::double end as paper_upvotes,
        0.0::double as "numComments", cast(null as varchar) as organization from documents""",
    "p7_key_values": "select count(o_orderkey) as papers from orders",
    "p11_lookup": f"""with {_TEXT_TAGS} select doc_id, len(tags)::integer as n_tags,
        md5(joined) as text_md5, {flag_sql(spec.MODEL_FLAGS)},
        regexp_matches(joined, 'bio|medic|medical', 'i') as is_biomed
        from joined where doc_id = 7""",
    "f1_organization": f"with {_MODELS} select id, organization from models",
    "f1_page_hosts": """with ids as (select page_id, regexp_replace(url, '^https?://', '') as id
        from pages) select page_id, case when contains(id, '/') then split_part(id, '/', 1)
        else 'unaffiliated' end as organization from ids""",
    "f2_size_parse": f"with {_MODELS} select id, round(params, 6) as params from models",
    "f2_event_props": """select event_id, coalesce(try_cast(json_extract_string(props, '$.k')
        as double) / 10.0::double, -1.0::double) as size from events""",
    "f3_size_bucket": f"""with e as (select event_id, value / 10 - 1 as params from events)
        select event_id, {BUCKET_SQL} as size_category from e""",
    "f5_org_name": """select c_custkey, coalesce(
        nullif(case when c_nationkey < 10 then c_mktsegment when c_nationkey < 15 then '' end, ''),
        nullif(case when c_acctbal > 5000 then c_name else '' end, ''),
        nullif(case when c_acctbal > 0 then cast(c_custkey as varchar) end, ''),
        'unaffiliated') as organization_name from customer""",
    "f6_tags": f"""with {_MODELS} select id, array_to_string(tags, '|') as tags,
        len(tags)::integer as n_tags from models""",
    "f7_joined_tags": f"with {_TEXT_TAGS} select doc_id, md5(joined) as joined_md5 from joined",
    "f8_flags": f"with {_MODELS} select id, {_FLAG_LIST} from models",
    "f8_text_flags": f"""with {_TEXT_TAGS} select doc_id, {flag_sql(spec.MODEL_FLAGS)},
        regexp_matches(joined, 'bio|medic|medical', 'i') as is_biomed from joined""",
    "m1_models_table": f"""with {_MODELS} select id, downloads,
        0.0::double as "downloadsAllTime", likes, pipeline_tag, array_to_string(tags, '|') as tags,
        round(params, 6) as params, size_category, organization, {_FLAG_LIST},
        '{DAY}' as data_download_timestamp, cast(null as varchar) as "createdAt", 'timestamp' as created_type from models""",
    "s2_dataset_scan": f"""with m as ({mapped_sql("part", {k: MODEL_ROWS[k] for k in ("id", "downloads", "likes", "tags")})})
        select id, downloads, likes, len(string_split(tags, ','))::integer as n_tags, 'id,downloads,likes,n_tags' as names from m""",
    "s3_paper_scan": """select cast(doc_id as varchar) as paper_id, n_chars as paper_upvotes, lang as name, source as org,
        'paper_id,paper_upvotes,name,org' as names from documents""",
    "p10_column_status": """select unnest(['doc_id', 'text', 'summary', 'n_chars']) as "column",
        unnest(['present', 'present', 'missing', 'present']) as status from (select count(*) from documents)""",
    "m2_datasets_table": f"""with {_MODELS} select id, downloads,
        0.0::double as "downloadsAllTime", likes, array_to_string(tags, '|') as tags, organization,
        {', '.join(f for f in FLAGS if f != 'is_audio_speech')},
        '{DAY}' as data_download_timestamp from models""",
    "a1_duplicates": """select count(*) - (count(distinct o_custkey)
        + max((o_custkey is null)::integer)) as duplicates from orders""",
    "a2_coverage": """select count(*) as rows, count(*) filter (value > 20) as present,
        round(count(*) filter (value > 20) * 100.0::double / count(*), 6) as percent from events""",
    "a3_flag_counts": f"with {_MODELS} " + " union all ".join(
        f"""select '{f}' as flag, count(*) filter ({f}) as rows,
        round(count(*) filter ({f}) * 100.0::double / count(*), 6) as percent from models"""
        for f in FLAGS),
    "a4_organizations": f"with {_MODELS} select count(distinct organization) as organizations from models",
    "a5_tag_stats": f"""with {_TEXT_TAGS} select count(*) filter (len(tags) = 0) as without_tags,
        round(avg(len(tags)), 6) as mean_tags, max(len(tags))::integer as max_tags,
        count(*) filter (len(tags) >= 10) as ten_or_more from tagged""",
    "a6_top_tags": f"""with {_TEXT_TAGS}, t as (select lower(unnest(tags)) as tag from tagged)
        select tag, count(*) as rows from t group by tag order by rows desc, tag limit 10""",
    "a6_unique_tags": f"""with {_TEXT_TAGS}, t as (select lower(unnest(tags)) as tag from tagged)
        select count(distinct tag) as unique_tags from t""",
    "a7_value_stats": """select count(l_extendedprice) as "values",
        round(avg(l_extendedprice), 6) as mean, round(median(l_extendedprice), 6) as median,
        round(max(l_extendedprice), 6) as max, round(sum(l_extendedprice), 2) as total
        from lineitem""",
    "a8_value_counts": f"""with {_MODELS} select size_category as label, count(*) as rows,
        round(count(*) * 100.0::double / (select count(*) from models), 6) as percent from models
        where size_category <> 'Unknown' group by 1 order by rows desc, label limit 10""",
    "a14_known_sizes": f"with {_MODELS} select count(*) filter (params > 0) as known_sizes from models",
}
ORACLE["p11_stored_lookup"] = ORACLE["p11_lookup"]
