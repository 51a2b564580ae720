"""Fit a loosely typed dump to a fixed schema, check it, and finish a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from hubcat.functions.text import number_or_zero, quoted, text_or_empty
from hubcat.functions.times import instant, utc_instant
from hubcat.spec import COLUMN_TYPES, CatalogSpec


def typed(name: str, df: DataFrame) -> Column:
    """A column in its declared type: null when absent, and where text can't be read as that type. Times without a zone are UTC."""
    declared = COLUMN_TYPES.get(name, "string")
    if name not in df.columns:
        return F.lit(None).cast(declared)
    given = df.schema[name].dataType
    if name not in COLUMN_TYPES or isinstance(given, (T.ArrayType, T.MapType, T.StructType)):
        return quoted(name)
    if "<" in declared:
        return F.from_json(quoted(name), declared) if isinstance(given, T.StringType) else F.lit(None).cast(declared)
    if given.simpleString() == declared:
        return quoted(name)
    return utc_instant(quoted(name), given) if declared == "timestamp" else quoted(name).try_cast(declared)


def conform(raw: DataFrame, spec: CatalogSpec, downloaded_at) -> DataFrame:
    """One projection: coerce the columns that exist, default those that do not.

    Types are those of the specification, whether a dump brings a column or not. ``downloaded_at`` without a zone is UTC.
    """
    if spec.key not in raw.columns:
        raise ValueError(f"{spec.name}: key column '{spec.key}' is missing")

    def column(name: str) -> Column:
        if name in raw.columns:
            dtype = raw.schema[name].dataType
            if name in spec.numeric:
                return number_or_zero(quoted(name), dtype)
            if name in spec.text:
                return text_or_empty(quoted(name))
            return quoted(name) if name in spec.arrays else typed(name, raw)
        if name in spec.numeric:
            return F.lit(0.0)
        if name in spec.text:
            return F.lit("")
        if name in spec.arrays:
            return F.array().cast("array<string>")
        return typed(name, raw)

    return raw.select(
        *(column(c).alias(c) for c in spec.conformed),
        instant(downloaded_at).alias("data_download_timestamp"),
    )


def require_key_values(df: DataFrame, key: str) -> DataFrame:
    """Fail when the key column is absent or holds no value at all; this reads rows at once, up to the first value."""
    if key not in df.columns or df.where(quoted(key).isNotNull()).isEmpty():
        raise ValueError(f"'{key}' is required but missing or empty")
    return df


def finalise(df: DataFrame, spec: CatalogSpec) -> DataFrame:
    """Ordered output columns; absent flags become false, other absent columns null of their type."""
    def column(name: str) -> Column:
        if name not in df.columns and spec.flag_defaults and ("has_" in name or "is_" in name):
            return F.lit(False)
        return typed(name, df)

    return df.select(*(column(c).alias(c) for c in spec.final))


def column_status(df: DataFrame, expected) -> DataFrame:
    """Which expected columns the frame has: ``(column, status)``."""
    rows = [(c, "present" if c in df.columns else "missing") for c in expected]
    schema = T.StructType([T.StructField("column", T.StringType()),
                           T.StructField("status", T.StringType())])
    return df.sparkSession.createDataFrame(rows, schema)
