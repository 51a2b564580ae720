"""Keyword flags over normalised tags."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from hubcat import spec
from hubcat.functions.tags import joined_tags, mentions, normalize_tags
from hubcat.functions.text import quoted

_TEXT = "__tag_text"


def with_normal_tags(df: DataFrame, column: str = "tags") -> DataFrame:
    return df.withColumn(column, normalize_tags(quoted(column), df.schema[column].dataType))


def with_flags(df: DataFrame, keyword_map=None, task_column: str | None = None,
               tags: str = "tags") -> DataFrame:
    """Boolean flag per keyword set, the science flag, and the composites.

    The joined text is built in a projection of its own, so that it is made once per
    row and not once per flag.
    """
    keyword_map = spec.MODEL_FLAGS if keyword_map is None else keyword_map
    text = F.col(_TEXT)
    flagged = df.withColumn(_TEXT, joined_tags(quoted(tags))).select(
        *(quoted(c) for c in df.columns),
        *(mentions(text, words, lowered=True).alias(name) for name, words in keyword_map.items()),
        (text.contains("science") & ~text.contains("bigscience")).alias("has_science"),
    )
    composites = {}
    if task_column is not None:
        composites["is_audio_speech"] = (
            F.col("has_audio") | F.col("has_speech")
            | mentions(quoted(task_column), ("audio", "speech"))
        )
    if "has_bio" in keyword_map and "has_med" in keyword_map:
        composites["is_biomed"] = F.col("has_bio") | F.col("has_med")
    return flagged.withColumns(composites) if composites else flagged


def inspect_row(df: DataFrame, value, key: str = "id", tags: str = "tags") -> DataFrame:
    """One row by key: its tags, the searched text and every flag."""
    flags = [c for c in df.columns if c.startswith(("has_", "is_"))]
    return (
        df.where(quoted(key) == F.lit(value))
        .limit(1)
        .select(quoted(key), quoted(tags), joined_tags(quoted(tags)).alias("tag_text"),
                *(quoted(c) for c in flags))
    )
