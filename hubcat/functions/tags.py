"""Ragged tag fields to one clean array, and the text searched by flags."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, functions as F
from pyspark.sql import types as T

from hubcat import spec
from hubcat.functions.text import strip

_STRICT = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "true"}

# A whole text that is one JSON value but not a list. Anchored, because the JSON
# reader ignores what follows the first value.
_JSON_SCALAR = (
    r"^\s*(-?(0|[1-9][0-9]*)(\.[0-9]+)?([eE][+-]?[0-9]+)?"
    r"|true|false|null|NaN|-?Infinity"
    r'|"([^"\\]|\\.)*")\s*$'
)
_JSON_OBJECT = r"(?s)^\s*\{.*\}\s*$"


def _clean(items: Column) -> Column:
    """Trim items; null and blank ones drop out."""
    return F.filter(F.transform(items, strip), lambda x: x != "")


def _no_tags() -> Column:
    return F.array().cast("array<string>")


def _unless_empty(items: Column) -> Column:
    """The array, or null when it is empty; names the array once, so it is parsed once."""
    return F.get(F.filter(F.array(items), lambda x: F.size(x) > 0), F.lit(0))


def _strict_list(c: Column) -> Column:
    return F.from_json(F.when(c.rlike(r"(?s)^\s*\[.*\]\s*$"), c), "array<string>", _STRICT)


def _literal_list(c: Column) -> Column:
    """List or tuple written with either quote style, None for null, or a last comma."""
    is_list = c.startswith("[") & c.endswith("]")
    is_tuple = c.startswith("(") & c.endswith(")")
    body = F.when(is_list, c).when(
        is_tuple, F.concat(F.lit("["), F.substring(c, F.lit(2), F.length(c) - 2), F.lit("]"))
    )
    plain = F.regexp_replace(body, r",\s*\]$", "]")
    plain = F.regexp_replace(plain, r"(?<=[\[,\s])None(?=\s*[,\]])", "null")
    plain = F.regexp_replace(plain, r"(?<=[\[,\s])(True|False)(?=\s*[,\]])", '"$1"')
    items = F.coalesce(
        F.from_json(body, "array<string>"), F.from_json(plain, "array<string>")
    )
    # One item in parentheses without a comma is not a tuple.
    one_item = is_tuple & (F.size(items) < 2) & ~c.rlike(r",\s*\)$")
    return F.when(~one_item, items)


def tags_from_text(c: Column) -> Column:
    """Tags of one text: literal list, JSON list, or comma list, in that order."""
    literal = _clean(_literal_list(c))
    strict = _clean(_strict_list(c))
    not_a_list = c.rlike(_JSON_SCALAR) | (
        c.rlike(_JSON_OBJECT)
        & F.from_json(F.when(c.rlike(_JSON_OBJECT), c), "map<string,string>", _STRICT).isNotNull()
    )
    by_comma = _clean(F.split(c, ",", -1))
    return (
        F.when(c.isNull(), _no_tags())
        # Most fields open like a plain word: decide that before any JSON is read.
        .when(~c.rlike(r'^\s*[\[({"0-9tfnNI-]'), by_comma)
        .otherwise(F.coalesce(
            _unless_empty(literal), strict, F.when(not_a_list, _no_tags()), by_comma
        ))
    )


def normalize_tags(c: Column, dtype: T.DataType) -> Column:
    """Trimmed, non-empty ``array<string>``; order, case and repeats are kept."""
    if isinstance(dtype, T.ArrayType):
        return F.coalesce(_clean(c.cast("array<string>")), _no_tags())
    if isinstance(dtype, T.StringType):
        return tags_from_text(c)
    if isinstance(dtype, T.NullType):
        return _no_tags()
    return F.coalesce(_clean(F.array(c.cast("string"))), _no_tags())


def joined_tags(tags: Column) -> Column:
    """All tags as one lower-case text."""
    return F.coalesce(
        F.lower(F.array_join(F.transform(tags, strip), spec.TAG_SEPARATOR)), F.lit("")
    )


def mentions(text: Column, words, lowered: bool = False) -> Column:
    """True when any of the words occurs anywhere in the text, in any case.

    Words may be patterns. Plain ones are looked for as they are, without a pattern match,
    and one that contains another cannot add a hit. ``lowered`` says that the text is in
    lower case already.
    """
    plain = [w.lower() for w in words if re.fullmatch(r"[A-Za-z0-9 _-]+", w)]
    shortest = [w for w in dict.fromkeys(plain) if not any(o != w and o in w for o in plain)]
    patterns = [w for w in words if w.lower() not in plain]
    searched = text if lowered else F.lower(text)
    tests = [searched.contains(w) for w in shortest]
    if patterns:
        tests.append(text.rlike("(?i)" + "|".join(patterns)))
    return F.coalesce(reduce(lambda a, b: a | b, tests), F.lit(False))
