import math

import pytest
from pyspark.sql import functions as F, types as T

from hubcat.functions.ranking import label_names, label_scores, ranked_labels
from hubcat.functions.sizes import size_bucket, size_of
from hubcat.functions.tags import joined_tags, normalize_tags
from hubcat.functions.text import (first_or_null, is_fresh, is_present, list_length,
                                   number_or_zero, organization_name, organization_of_id,
                                   snapshot_date, strip)
from hubcat.functions.vectors import cosine


def values(spark, rows, dtype, expr):
    """Apply ``expr(column, dtype)`` to rows and return the results in order."""
    schema = T.StructType([T.StructField("i", T.IntegerType()), T.StructField("v", dtype)])
    df = spark.createDataFrame(list(enumerate(rows)), schema)
    out = df.select("i", expr(F.col("v"), dtype).alias("r")).orderBy("i").collect()
    return [r["r"] for r in out]


def test_organization_of_id(spark):
    got = values(spark, ["org1/modelA", "unaffiliated_modelC", None, "a/b/c", "/x", ""],
                 T.StringType(), lambda c, _: organization_of_id(c))
    assert got == ["org1", "unaffiliated", "unaffiliated", "a", "", "unaffiliated"]


def test_numbers(spark):
    got = values(spark, ["12", "x", None, "1d", "2.5f", " 7 ", "NaN", "1e3", "inf"],
                 T.StringType(), number_or_zero)
    assert got == [12.0, 0.0, 0.0, 0.0, 0.0, 7.0, 0.0, 1000.0, math.inf]
    assert values(spark, [1.5, None, math.nan], T.DoubleType(), number_or_zero) == [1.5, 0.0, 0.0]


def test_size_from_text(spark):
    rows = ['{"total": 500000000}', '{"total": 2000000000}', '{"total": 60000000000}', None, "x",
            "[1]", '{"a":1}', '{"total":"abc"}', "{'total': 7}", '{"total": "8"}',
            '{"total": true, "a": null}', '{"total": null}', '{"total": 5} x']
    got = values(spark, rows, T.StringType(), size_of)
    gb = 2.0 ** 30
    assert got == [5e8 / gb, 2e9 / gb, 6e10 / gb, -1.0, -1.0, -1.0, -1.0, -1.0, 7 / gb, 8 / gb,
                   -1.0, -1.0, -1.0]
    buckets = values(spark, got[:4], T.DoubleType(), lambda c, _: size_bucket(c))
    assert buckets == ["Small (<1GB)", "Medium (1-5GB)", "XX-Large (>50GB)", "Unknown"]


def test_size_from_struct_and_map(spark):
    struct = T.StructType([T.StructField("total", T.LongType())])
    assert values(spark, [(2 ** 31,), None, (None,)], struct, size_of) == [2.0, -1.0, -1.0]
    assert values(spark, [{"total": 2 ** 30}, {}], T.MapType(T.StringType(), T.LongType()),
                  size_of) == [1.0, -1.0]


def test_size_bucket_edges(spark):
    got = values(spark, [0.0, 1.0, 5.0, 20.0, 50.0, -0.1, math.nan, None, math.inf],
                 T.DoubleType(), lambda c, _: size_bucket(c))
    assert got == ["Small (<1GB)", "Medium (1-5GB)", "Large (5-20GB)", "X-Large (20-50GB)",
                   "XX-Large (>50GB)", "Unknown", "Unknown", "Unknown", "Unknown"]


def test_organization_name(spark):
    struct = T.StructType([T.StructField(f, T.StringType()) for f in ("name", "fullname", "_id")])
    got = values(spark, [("org1", "O", "1"), None, ("", "F", "x"), ("", None, ""), (None, "", "i")],
                 struct, organization_name)
    assert got == ["org1", "unaffiliated", "F", "unaffiliated", "i"]
    assert values(spark, ["T", "", None], T.StringType(), organization_name) == [
        "T", "unaffiliated", "unaffiliated"]


TAG_CASES = [
    (None, []), ('["a"," b "]', ["a", "b"]), ("['a','b']", ["a", "b"]), ('["a", null]', ["a"]),
    ('["a", None]', ["a"]), ("[1,2.5]", ["1", "2.5"]), ("[]", []), ("[a, b]", ["[a", "b]"]),
    ("123", []), ('"abc"', []), ("null", []), ("NaN", []), ('{"a":1}', []), ("", []),
    ("a, b,,c", ["a", "b", "c"]), ("('a','b')", ["a", "b"]), ("('a',)", ["a"]),
    ("('a')", ["('a')"]), ('["a"] x', ['["a"] x']), ("2024, news", ["2024", "news"]),
    ("True", ["True"]), ("[True]", ["True"]), ("  ", []), ("robotics", ["robotics"]),
    ("(x, y)", ["(x", "y)"]), ('["it\'s"]', ["it's"]), ('["None of it", "x"]', ["None of it", "x"]),
    ('"a", "b"', ['"a"', '"b"']), ("['a',]", ["a"]), (" [\"a\"] ", ["a"]), ("-1", []),
    ("[None]", ["[None]"]), ("{a}", ["{a}"]), ("true, x", ["true", "x"]), ("1.", ["1."]),
    ("\ta\n,\xa0b", ["a", "b"]), ("audio,speech", ["audio", "speech"]),
]


def test_tag_texts(spark):
    got = values(spark, [c for c, _ in TAG_CASES], T.StringType(), normalize_tags)
    wrong = [(c, g, e) for (c, e), g in zip(TAG_CASES, got) if g != e]
    assert not wrong


def test_tag_arrays_and_scalars(spark):
    arrays = T.ArrayType(T.StringType())
    assert values(spark, [[" a ", None, "", "B", "B", "\tc\n"], None, []], arrays,
                  normalize_tags) == [["a", "B", "B", "c"], [], []]
    assert values(spark, [5, None], T.IntegerType(), normalize_tags) == [["5"], []]
    # Normal tags stay as they are.
    twice = values(spark, [["a", "B"]], arrays,
                   lambda c, d: normalize_tags(normalize_tags(c, d), d))
    assert twice == [["a", "B"]]


def test_joined_tags(spark):
    got = values(spark, [["A", None, "b "], [], None], T.ArrayType(T.StringType()),
                 lambda c, _: joined_tags(c))
    assert got == ["a~~~b", "", ""]


def test_small_helpers(spark):
    arrays = T.ArrayType(T.StringType())
    assert values(spark, [["x", "y"], [], None], arrays, lambda c, _: list_length(c)) == [2, 0, 0]
    assert values(spark, [["x", "y"], [], None], arrays, lambda c, _: first_or_null(c)) == [
        "x", None, None]
    assert values(spark, [" a ", "\t\n", "", None], T.StringType(), lambda c, _: is_present(c)) == [
        True, False, False, False]
    assert values(spark, ["  x "], T.StringType(), lambda c, _: strip(c)) == ["x"]
    days = ["2025-01-01", "2024-12-31", "2025-01-08", None]
    assert values(spark, days, T.StringType(), lambda c, _: is_fresh(c, "2025-01-08")) == [
        True, False, True, False]


def test_snapshot_date(spark):
    paths = ["models/2025-01-01/models.parquet", "item=models/week=2025-01-08/p", "other/2025-01-01/x",
             "models", "models/readme"]
    got = values(spark, paths, T.StringType(), lambda c, _: snapshot_date(c, F.lit("models")))
    assert [str(d) if d else None for d in got] == ["2025-01-01", "2025-01-08", None, None, None]


def test_cosine_null_on_zero_vector(spark):
    df = spark.createDataFrame([([1.0, 0.0], [1.0, 1.0]), ([0.0, 0.0], [1.0, 1.0])],
                               "a array<double>, b array<double>")
    got = [r[0] for r in df.select(cosine(F.col("a"), F.col("b"))).collect()]
    assert got[0] == pytest.approx(1 / math.sqrt(2)) and got[1] is None


def _ranked(spark, scores, **kw):
    rows = [(name, score, pos) for pos, (name, score) in enumerate(scores)]
    df = spark.createDataFrame([(rows,)], "l array<struct<label:string,score:double,pos:int>>")
    r = ranked_labels(F.col("l"), **kw)
    return df.select(label_names(r).alias("n"), label_scores(r).alias("s")).first()


def test_ranked_labels(spark):
    got = _ranked(spark, [("a", .75), ("b", .80), ("c", .72), ("d", .73), ("e", .71)])
    assert got["n"] == ["b", "a", "d"]        # .9 * .8 is a little above .72 in binary
    assert got["s"] == {"b": .80, "a": .75, "d": .73}
    assert _ranked(spark, [(c, .6) for c in "fedcba"])["n"] == list("fedcb")
    assert _ranked(spark, [("a", .9), ("b", .1)], multi=False)["n"] == ["a", "b"]
    assert _ranked(spark, [])["n"] == []
