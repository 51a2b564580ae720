import datetime as dt

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
import pytest

from hubcat.operators import citations as cit
from hubcat.plans.papers import citation_run, resolved_citations

AS_OF = "2025-01-08"
TRIPLE = "paper_id string, citation_count double, semantic_scholar_id string, citation_fetch_date string"


def day(text):
    return dt.date.fromisoformat(text)


def triples(spark, rows):
    return spark.createDataFrame(rows, TRIPLE)


def papers(spark, ids):
    return spark.createDataFrame([(i, f"Title {i}") for i in ids], "paper_id string, paper_title string")


def by_id(df):
    return {r["paper_id"]: (r["citation_count"], r["semantic_scholar_id"], r["citation_fetch_date"])
            for r in df.collect()}


def test_merge_cases(spark):
    new = triples(spark, [("a", 5.0, "na", "2025-01-08"), ("b", None, "nb", None), ("c", None, "x", None),
                          ("e", 1.0, "ne", "2025-01-08")])
    old = triples(spark, [("a", 4.0, "oa", "2025-01-01"), ("b", 4.0, "ob", "2025-01-01"),
                          ("b", 3.0, "older", "2024-12-01"), ("d", 2.0, "od", None), ("c", None, "oc", None)])
    merged = cit.merge_citations(papers(spark, "abcdef"), new, old)
    assert by_id(merged) == {
        "a": (5.0, "na", day("2025-01-08")), "b": (4.0, "ob", day("2025-01-01")),
        "c": (None, "x", None), "d": (2.0, "od", None), "e": (1.0, "ne", day("2025-01-08")),
        "f": (None, None, None),
    }
    stats = cit.merge_stats(merged, AS_OF).first()
    assert tuple(stats) == (6, 4, 2, 2, 3)


def test_merge_without_dates_or_previous(spark):
    new = spark.createDataFrame([("a", 5, "s")], "paper_id string, citation_count long, semantic_scholar_id string")
    assert by_id(cit.merge_citations(papers(spark, "ab"), new)) == {
        "a": (5.0, "s", None), "b": (None, None, None)}


def test_merge_duplicates(spark):
    base = papers(spark, ["a", "a", "b"])
    new = triples(spark, [("a", 5.0, "s", None), ("a", None, "t", None), ("b", None, None, None)])
    old = triples(spark, [("b", 7.0, "o", "2025-01-01")])
    assert cit.merge_citations(base, new, old, distinct=True).count() == 3
    every = cit.merge_citations(base, new, old)
    assert every.count() == 5
    assert by_id(every)["b"] == (7.0, "o", day("2025-01-01"))
    assert cit.merge_citations(base, new).count() == 5


counts = st.one_of(st.none(), st.integers(0, 9).map(float))


@settings(max_examples=8, deadline=None)
@given(st.dictionaries(st.sampled_from("abcd"), counts), st.dictionaries(st.sampled_from("abcd"), counts))
def test_merge_never_loses_a_known_count(spark, new, old):
    got = by_id(cit.merge_citations(
        papers(spark, "abcd"), triples(spark, [(k, v, None, None) for k, v in new.items()]),
        triples(spark, [(k, v, None, None) for k, v in old.items()])))
    for key in "abcd":
        expected = new.get(key) if new.get(key) is not None else old.get(key)
        assert got[key][0] == expected


def test_freshness_split_and_lookup(spark):
    rows = [("fresh", "T1"), ("stale", "T2"), ("blank", "  "), ("none", None), ("id", "wrong"),
            ("title", "  The Paper "), ("miss", "unknown"), ("nocount", "T9")]
    base = spark.createDataFrame(rows, "paper_id string, paper_title string")
    prev = triples(spark, [("fresh", 1.0, "s1", "2025-01-01"), ("stale", 2.0, "s2", "2024-12-31"),
                           ("id", None, "s5", None), ("nocount", 3.0, "gone", "2024-01-01")])
    marked = cit.split_by_freshness(base, prev, AS_OF)
    source = {r["paper_id"]: r["source"] for r in marked.collect()}
    assert source == {"fresh": "cached", "stale": "resolve", "blank": "skipped", "none": "skipped",
                      "id": "resolve", "title": "resolve", "miss": "resolve", "nocount": "resolve"}
    ref = spark.createDataFrame(
        [("s2", "zzz", 20), ("s5", "yyy", 50), ("s6", "the paper", 60), ("s7", "THE PAPER", 70),
         ("s9", "T9", None)], "ext_id string, title string, citation_count long")
    got = by_id(cit.resolve(marked, ref, AS_OF))
    today = day(AS_OF)
    assert got == {
        "fresh": (1.0, "s1", day("2025-01-01")), "stale": (20.0, "s2", today),
        "blank": (None, None, None), "none": (None, None, None), "id": (50.0, "s5", today),
        "title": (60.0, "s6", today), "miss": (None, None, None), "nocount": (None, "s9", today),
    }
    outcome = {r["source"]: (r["papers"], r["with_citations"])
               for r in cit.outcome_counts(cit.resolve(marked, ref, AS_OF)).collect()}
    assert outcome == {"cached": (1, 1), "resolve": (5, 3), "skipped": (2, 0)}
    assert cit.fresh_rows(prev, AS_OF).first()[0] == 1


def test_previous_without_dates_is_never_fresh(spark):
    prev = spark.createDataFrame([("a", 3.0, "s")], "paper_id string, citation_count double, semantic_scholar_id string")
    row = cit.split_by_freshness(papers(spark, "a"), prev, AS_OF).first()
    assert row["source"] == "resolve" and row["known_id"] == "s"


def test_disabled(spark):
    df = spark.createDataFrame([("a", 10), ("b", 20), ("c", 30)], "paper_id string, paper_upvotes int")
    out = resolved_citations(df, None, None, AS_OF)
    assert out.count() == 3 and set(by_id(out).values()) == {(None, None, None)}


def test_union_and_totals(spark):
    a = spark.createDataFrame([("a", 1.0, "f1"), ("b", None, "f1")], "paper_id string, citation_count double, batch_file string")
    b = spark.createDataFrame([("c", "x", "f2")], "paper_id string, semantic_scholar_id string, batch_file string")
    merged = cit.union_batches([a, b])
    assert merged.columns == ["paper_id", "citation_count", "batch_file", "semantic_scholar_id"]
    got = {r["batch_file"]: (r["papers"], r["with_citations"]) for r in cit.batch_totals(merged).collect()}
    assert got == {"f1": (2, 1), "f2": (1, 0), None: (3, 1)}
    with pytest.raises(ValueError):
        cit.union_batches([])


def test_citation_run(spark):
    base = spark.range(450).select(
        F.concat(F.lit("p"), F.col("id")).alias("paper_id"), F.concat(F.lit("t"), F.col("id")).alias("paper_title"),
        F.col("id").cast("double").alias("paper_upvotes"))
    prev = base.where("paper_upvotes < 100").select(
        "paper_id", F.lit(1.0).alias("citation_count"), F.lit("old").alias("semantic_scholar_id"),
        F.lit("2025-01-05").alias("citation_fetch_date"))
    ref = base.select(F.col("paper_id").alias("ext_id"), F.col("paper_title").alias("title"),
                      F.lit(9).alias("citation_count"))
    out = citation_run(base, prev, ref, AS_OF, top=400)
    got = out.groupBy("citation_source", "citation_count").count().collect()
    # The 50 least popular are beyond the limit and fall back to the previous run.
    assert {(r[0], r[1]): r[2] for r in got} == {("new", 9.0): 350, ("new", 1.0): 50, ("previous", 1.0): 50}
