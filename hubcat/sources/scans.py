"""Pruned reads of catalogue dumps and batch results."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from hubcat.functions.text import quoted
from hubcat.operators.citations import CACHE_COLUMNS
from hubcat.spec import CatalogSpec


def spread(df: DataFrame) -> DataFrame:
    """Deal the rows of a scan with fewer splits than cores out over all cores.

    A small file of one row group is read by one task, and everything up to the first
    shuffle would run there. A scan with enough splits is left as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def scan(spark: SparkSession, path: str, columns, limit: int | None = None) -> DataFrame:
    """Parquet scan pruned to the named columns that exist; dots in names are literal."""
    df = spark.read.parquet(path)
    df = df.select(*(quoted(c) for c in columns if c in df.columns))
    return df if limit is None else df.limit(limit)


def scan_catalog(spark: SparkSession, path: str, spec: CatalogSpec,
                 limit: int | None = None) -> DataFrame:
    """Raw rows of one catalogue; an empty dump or one without its key column fails."""
    raw = scan(spark, path, spec.source, limit)
    if spec.key not in raw.columns:
        raise ValueError(f"{spec.name}: column '{spec.key}' is missing from {path}")
    if raw.isEmpty():
        raise ValueError(f"{spec.name}: {path} holds no rows")
    return raw


def read_batches(spark: SparkSession, pattern: str | list[str]) -> DataFrame:
    """All batch files of a pattern as one table, columns merged by name.

    ``batch_file`` names the file or folder that the last part of the pattern stands for; the
    part files that Spark writes inside a folder are one batch. No file at all is an error,
    raised by the reader.
    """
    patterns = [pattern] if isinstance(pattern, str) else list(pattern)
    named = "|".join(_name_pattern(p.rstrip("/").rsplit("/", 1)[-1]) for p in patterns)
    name = F.regexp_extract(F.url_decode(F.replace(F.input_file_name(), F.lit("+"), F.lit("%2B"))), f"^.*/({named})(?:/.*)?$", 1)
    return spark.read.option("mergeSchema", True).parquet(*patterns).withColumn("batch_file", name)


def _name_pattern(glob: str) -> str:
    """A file name's glob as a regular expression."""
    marks = {"*": "[^/]*", "?": "[^/]", "{": "(?:", "}": ")", ",": "|", "[": "[", "]": "]"}
    return "".join(marks.get(c, re.escape(c)) for c in glob)


def previous_citations(previous: DataFrame | None, spark: SparkSession) -> DataFrame:
    """The cache columns a previous run has; an empty typed table without one."""
    if previous is None:
        schema = T.StructType([
            T.StructField("paper_id", T.StringType()),
            T.StructField("citation_count", T.DoubleType()),
            T.StructField("semantic_scholar_id", T.StringType()),
            T.StructField("citation_fetch_date", T.DateType()),
        ])
        return spark.createDataFrame([], schema)
    return previous.select(*(c for c in CACHE_COLUMNS if c in previous.columns))
