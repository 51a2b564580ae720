"""Output files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql import types as T

from hubcat.functions.text import quoted

_CSV = {"escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "lineSep": "\n",
        "nullValue": "\\N"}
_NESTED = (T.ArrayType, T.MapType, T.StructType)


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_counted(df: DataFrame, path: str, numbers: dict[str, Column]) -> dict[str, object]:
    """Write a table and give numbers about it, taken while it is written: one pass, where each report would be one.

    ``numbers`` are aggregates by name, none of them distinct. ``rows`` comes with them, and must agree with
    the files' own counts, which are read from their footers.
    """
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows"), *(c.alias(name) for name, c in numbers.items())).write.mode("overwrite").parquet(path)
    found = seen.get
    held = df.sparkSession.read.schema(df.schema).parquet(path).count()
    if held != found["rows"]:
        raise ValueError(f"{path}: {held} rows read back of {found['rows']}")
    return found


def write_keyed(df: DataFrame, path: str, key: str, group_bytes: int = 32 << 20, keys_per_file: int = 1_000_000) -> None:
    """Parquet laid out for look-ups by ``key``: sorted over all files, with a bloom filter on it in every row group.

    The order gives each row group a narrow range, which rules most of them out; the filter rules out the others that
    do not hold the value. ``keys_per_file`` sizes the filter, about a byte and a half for each key of a row group.
    """
    column = quoted(key)
    options = {f"parquet.bloom.filter.enabled#{key}": "true", f"parquet.bloom.filter.expected.ndv#{key}": str(keys_per_file), "parquet.block.size": str(group_bytes)}
    df.repartitionByRange(column).sortWithinPartitions(column).write.mode("overwrite").options(**options).parquet(path)


def flat_columns(df: DataFrame) -> DataFrame:
    """Nested columns as JSON text, for formats that hold plain values only."""
    return df.select(*(
        (F.to_json(quoted(f.name)) if isinstance(f.dataType, _NESTED) else quoted(f.name))
        .alias(f.name) for f in df.schema.fields))


def write_csv(df: DataFrame, path: str) -> None:
    r"""CSV with a header; quotes double, lines may break inside a value, outer white space stays.

    Null is written as \N, so that ``read_csv`` tells it from empty text.
    """
    flat_columns(df).write.mode("overwrite").options(**_CSV).csv(path, header=True)


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """What ``write_csv`` wrote, whole values of any length; nested values are JSON text."""
    return spark.read.schema(schema).options(**_CSV, multiLine=True, maxCharsPerColumn=-1).csv(path, header=True)


def write_report(report: DataFrame, path: str) -> None:
    """A one-row nested report as JSON."""
    report.write.mode("overwrite").json(path)


def verify(spark: SparkSession, path: str, flag: str = "has_robot",
           organization: str = "organization") -> DataFrame:
    """Read a written table back: rows, columns, flagged rows, organisations."""
    df = spark.read.parquet(path)
    none = F.lit(None).cast("long")
    return df.agg(
        F.count(F.lit(1)).alias("rows"), F.lit(len(df.columns)).alias("columns"),
        (F.count_if(quoted(flag)) if flag in df.columns else none).alias("flagged"),
        (F.count_distinct(quoted(organization)) if organization in df.columns else none)
        .alias("organizations"))
