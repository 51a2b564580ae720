"""Model size expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql import types as T

from hubcat import spec
from hubcat.functions.text import number_or_zero, parsed_double, quoted


def size_of(c: Column, dtype: T.DataType, field: str = "total",
            divisor: float = spec.SIZE_DIVISOR) -> Column:
    """Size in units of ``divisor`` from a struct, map or JSON text; -1.0 when unknown."""
    if isinstance(dtype, T.StructType):
        total = c.getField(field) if field in dtype.fieldNames() else F.lit(None)
    elif isinstance(dtype, T.MapType):
        total = F.try_element_at(c, F.lit(field).cast(dtype.keyType))
    elif isinstance(dtype, T.StringType):
        text = F.when(c.rlike(r"(?s)^\s*\{.*\}\s*$"), c)
        total = F.from_json(text, f"`{field}` string").getField(field)
    else:
        total = F.lit(None)
    return F.coalesce(parsed_double(total) / F.lit(divisor), F.lit(-1.0))


def size_bucket(c: Column, ranges=spec.SIZE_RANGES) -> Column:
    """Name of the half-open range; null, NaN, negative and infinite are unknown."""
    bucket = F.when(c.isNull() | F.isnan(c) | (c < 0), spec.UNKNOWN_SIZE)
    for name, low, high in ranges:
        bucket = bucket.when((c >= low) & (c < high), name)
    return bucket.otherwise(spec.UNKNOWN_SIZE)


def size_expression(schema: T.StructType, field: str = "total") -> Column:
    """Pick the size source: numeric params, else safetensors, else zero."""
    if "params" in schema.fieldNames() and isinstance(schema["params"].dataType, T.NumericType):
        return number_or_zero(quoted("params"), schema["params"].dataType)
    if "safetensors" in schema.fieldNames():
        return size_of(quoted("safetensors"), schema["safetensors"].dataType, field)
    return F.lit(0.0)
