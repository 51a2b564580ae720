"""Text, number and organisation expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql import types as T

from hubcat import spec

# Every character Unicode calls white space; Spark's own trim removes spaces only.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def quoted(name: str) -> Column:
    """Column by literal name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def strip(c: Column) -> Column:
    """Remove all white space at both ends.

    Text that begins and ends with a visible ASCII character stays as it is; looking at
    two characters is much cheaper than trimming by a list of thirty.
    """
    def visible(code: Column) -> Column:
        return (code > 32) & (code < 128)

    clean = visible(F.ascii(c)) & visible(F.ascii(F.substring(c, -1, 1)))
    return F.when(clean, c).otherwise(F.btrim(c, F.lit(WHITESPACE)))


def is_present(c: Column) -> Column:
    """True for non-null text with a visible character."""
    return F.coalesce(strip(c) != "", F.lit(False))


def parsed_double(c: Column) -> Column:
    """Double, or null for unparseable text. A Java type suffix ("1d") is not a number."""
    text = c.cast("string")
    return F.when(~text.rlike(r"[0-9.][dDfF]\s*$"), text.try_cast("double"))


def number_or_zero(c: Column, dtype: T.DataType) -> Column:
    """Numeric coercion: null, NaN and junk become 0.0."""
    value = parsed_double(c) if isinstance(dtype, T.StringType) else c.try_cast("double")
    return F.coalesce(F.nanvl(value, F.lit(0.0)), F.lit(0.0))


def text_or_empty(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def organization_of_id(c: Column) -> Column:
    """Part of an id before its first slash."""
    return F.when(F.contains(c, F.lit("/")), F.substring_index(c, "/", 1)).otherwise(
        spec.NO_ORGANIZATION
    )


def organization_name(c: Column, dtype: T.DataType) -> Column:
    """First non-empty of name, fullname and _id of a struct, or the text itself."""
    if isinstance(dtype, T.StructType):
        parts = [
            F.nullif(c.getField(f).cast("string"), F.lit(""))
            for f in ("name", "fullname", "_id") if f in dtype.fieldNames()
        ]
    elif isinstance(dtype, T.MapType):
        parts = [F.nullif(F.try_element_at(c, F.lit(f)).cast("string"), F.lit(""))
                 for f in ("name", "fullname", "_id")]
    elif isinstance(dtype, T.StringType):
        parts = [F.nullif(c, F.lit(""))]
    else:
        parts = []
    return F.coalesce(*parts, F.lit(spec.NO_ORGANIZATION))


def list_length(c: Column) -> Column:
    """Array size with null as zero."""
    return F.coalesce(F.size(c), F.lit(0))


def first_or_null(c: Column) -> Column:
    return F.try_element_at(c, F.lit(1))


def is_fresh(fetched: Column, as_of, days: int = spec.FRESH_DAYS) -> Column:
    """Fetched no more than ``days`` before ``as_of`` (inclusive); null is not fresh."""
    return F.coalesce(
        fetched.cast("date") >= F.date_sub(F.lit(as_of).cast("date"), days), F.lit(False)
    )


def snapshot_date(path: Column, item: Column) -> Column:
    """Week of an ``item/date/...`` path, plain or in partition-folder form."""
    parts = F.split(path, "/")
    head = F.regexp_replace(parts.getItem(0), "^item=", "")
    day = F.regexp_replace(F.get(parts, F.lit(1)), "^week=", "")
    return F.when(head == item, day.try_cast("date"))
