"""Catalogue-shaped inputs over the test tables.

An input is a list of SQL expressions that Spark and DuckDB read alike, so that both
sides of a check start from the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hubcat.functions.text import WHITESPACE
from hubcat.sources.scans import spread

QUOTE = "chr(39)"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def dealt(spark: SparkSession, sf: str, name: str, *columns: str) -> DataFrame:
    """Columns of a table with much work per row, dealt out over the cores where the table
    is one small file."""
    return spread(table(spark, sf, name).select(*columns))


def mapped(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.selectExpr(*(f"{e} as {c}" for c, e in columns.items()))


def mapped_sql(name: str, columns: dict[str, str]) -> str:
    return "select " + ", ".join(f"{e} as {c}" for c, e in columns.items()) + f" from {name}"


def strip_sql(expression: str) -> str:
    """DuckDB twin of the white-space trim."""
    return f"trim({expression}, '{WHITESPACE}')"


# Parts as models: every tag, size and counter encoding occurs, chosen by part type.
MODEL_ROWS = {
    "id": "case when p_size <= 10 then p_name "
          "else p_brand || '/' || p_name || '-' || cast(p_partkey as string) end",
    "downloads": "case p_type when 'ECONOMY' then cast(p_size as string) || 'd' "
                 "when 'SMALL' then 'n/a' when 'PROMO' then null "
                 "else ' ' || cast(p_retailprice as string) || ' ' end",
    "likes": "p_size",
    "pipeline_tag": "case p_type when 'LARGE' then 'Automatic-Speech-Recognition' "
                    "when 'MEDIUM' then null else lower(p_type) end",
    "tags": "case p_type "
            "when 'STANDARD' then replace(p_name, ' ', ', ') || "
            "case when p_size > 40 then ', science' when p_size > 30 then ',,bigscience' "
            "else '' end "
            "when 'LARGE' then '[\"' || replace(p_name, ' ', '\", \" ') || '\", null]' "
            f"when 'ECONOMY' then '[' || {QUOTE} || replace(p_name, ' ', "
            f"{QUOTE} || ', None, ' || {QUOTE}) || {QUOTE} || ']' "
            f"when 'PROMO' then '(' || {QUOTE} || replace(p_name, ' ', "
            f"{QUOTE} || ', ' || {QUOTE}) || {QUOTE} || ')' "
            "when 'SMALL' then cast(p_size as string) else null end",
    "safetensors": "case p_type "
                   "when 'STANDARD' then '{\"total\": ' || "
                   "cast(cast(p_size as bigint) * 1200000000 as string) || '}' "
                   f"when 'LARGE' then '{{' || {QUOTE} || 'total' || {QUOTE} || ': ' || "
                   "cast(p_size * 20000000 as string) || '}' "
                   "when 'ECONOMY' then '{\"total\": \"' || cast(p_size as string) || '\"}' "
                   "when 'PROMO' then '{\"parameters\": 5}' when 'SMALL' then 'x' else null end",
}

# What those encodings mean, written straight from the columns they were made of.
MODEL_TRUTH = """
select p_partkey, p_size, p_type,
  case when p_size <= 10 then p_name
    else p_brand || '/' || p_name || '-' || cast(p_partkey as string) end as id,
  case when p_size <= 10 then 'unaffiliated' else p_brand end as organization,
  case when p_type in ('ECONOMY', 'SMALL', 'PROMO') then 0.0 else p_retailprice end as downloads,
  cast(p_size as double) as likes,
  case p_type when 'LARGE' then 'Automatic-Speech-Recognition' when 'MEDIUM' then ''
    else lower(p_type) end as pipeline_tag,
  case when p_type in ('SMALL', 'MEDIUM') then cast([] as varchar[])
    when p_type = 'STANDARD' and p_size > 40 then list_append(string_split(p_name, ' '), 'science')
    when p_type = 'STANDARD' and p_size > 30 then list_append(string_split(p_name, ' '), 'bigscience')
    else string_split(p_name, ' ') end as tags,
  case p_type when 'STANDARD' then p_size * 1200000000.0::double / 1073741824
    when 'LARGE' then p_size * 20000000.0::double / 1073741824
    when 'ECONOMY' then p_size::double / 1073741824 else -1.0 end as params
from part
"""

# Words of part names stand in for the topics of the flag names.
PART_FLAGS = {
    "has_audio": ("ring",), "has_speech": ("gizmo",), "has_music": ("rod",),
    "has_robot": ("widget", "gear"), "has_bio": ("old",), "has_med": ("hot", "cold"),
    "has_series": ("new",), "has_video": ("red",), "has_image": ("blue", "plate"),
    "has_text": ("small", "LARGE", "anvil"),
}


def flag_sql(flags: dict, joined: str = "joined") -> str:
    return ", ".join(
        f"regexp_matches({joined}, '{'|'.join(words)}', 'i') as {name}"
        for name, words in flags.items()
    ) + (f", contains({joined}, 'science') and not contains({joined}, 'bigscience') "
         "as has_science")


BUCKET_SQL = """case when params is null or isnan(params) or params < 0 then 'Unknown'
  when params < 1 then 'Small (<1GB)' when params < 5 then 'Medium (1-5GB)'
  when params < 20 then 'Large (5-20GB)' when params < 50 then 'X-Large (20-50GB)'
  when params < 'inf'::double then 'XX-Large (>50GB)' else 'Unknown' end"""

# Documents as papers: the whole text is the keyword list, word by word.
PAPER_ROWS = {
    "paper_id": "cast(doc_id as string)",
    "paper_title": "lang || ' ' || source",
    "paper_upvotes": "cast(n_chars as double)",
    "lang": "lang",
    "source": "source",
    "text": "text",
}

# Letters counted in a word make its vector.
ALPHABET = "abcdefghijklmnopqrstuvwxyz"
SIMILARITY = 0.8
