import datetime as dt
import json

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from hubcat import spec
from hubcat.operators import labels as lab
from hubcat.operators import matching as m
from hubcat.operators import reports
from hubcat.operators.taxonomy import (flatten_taxonomy, level_counts, read_taxonomy,
                                       taxonomy_from_paths)
from hubcat.plans.papers import papers_table

TREE = {
    "Animals": {"Cats": ["Lion", "Tiger"], "Dogs": ["Wolf"]},
    "Plants": {"Trees": ["Oak", "Lion"], "Herbs": []},
    "Aliens": {},
}


def nodes_of(spark, tree=TREE):
    df = spark.createDataFrame([(json.dumps(tree),)], "j string")
    return flatten_taxonomy(
        df.select(F.from_json("j", "map<string,map<string,array<string>>>").alias("t")), "t")


def with_vectors(spark, vectors):
    rows = [(i, "c", None, None, f"n{i}", "category", [float(x) for x in v])
            for i, v in enumerate(vectors)]
    return spark.createDataFrame(
        rows, "ordinal long, category string, subcategory string, topic string, label string, "
              "level string, vector array<double>")


def terms_of(spark, vectors):
    return spark.createDataFrame([(f"t{i}", [float(x) for x in v]) for i, v in enumerate(vectors)],
                                 "term string, vector array<double>")


def test_preorder_from_file(spark, tmp_path):
    path = tmp_path / "tree.json"
    path.write_text(json.dumps(TREE, indent=2))
    nodes = read_taxonomy(spark, str(path)).orderBy("ordinal")
    assert [r["path"] for r in nodes.collect()] == [
        ["Animals"], ["Animals", "Cats"], ["Animals", "Cats", "Lion"], ["Animals", "Cats", "Tiger"],
        ["Animals", "Dogs"], ["Animals", "Dogs", "Wolf"], ["Plants"], ["Plants", "Trees"],
        ["Plants", "Trees", "Oak"], ["Plants", "Trees", "Lion"], ["Plants", "Herbs"], ["Aliens"]]
    assert {r["level"]: r["nodes"] for r in level_counts(nodes).collect()} == {
        "category": 3, "subcategory": 4, "topic": 5}


def test_taxonomy_from_paths(spark):
    paths = spark.createDataFrame(
        [("b", "s", "t"), ("b", "s", "t"), ("b", "s", "a"), ("a", "z", None), ("c", None, None)],
        "category string, subcategory string, topic string")
    rows = taxonomy_from_paths(paths).orderBy("ordinal").collect()
    assert [(r["ordinal"], r["path"]) for r in rows] == list(enumerate(
        [["a"], ["a", "z"], ["b"], ["b", "s"], ["b", "s", "a"], ["b", "s", "t"], ["c"]]))


def brute(terms, nodes, threshold):
    out = {}
    for i, t in enumerate(terms):
        best, score = None, threshold
        for j, n in enumerate(nodes):
            size = np.linalg.norm(t) * np.linalg.norm(n)
            sim = round(float(np.dot(t, n) / size), 12) if size else float("nan")
            if sim > score:
                best, score = j, sim
        if best is not None:
            out[f"t{i}"] = best
    return out


@pytest.mark.parametrize("limit", [10 ** 6, 1])
def test_best_match_against_brute_force(spark, monkeypatch, limit):
    """Broadcast and blocked matching both equal the pairwise definition."""
    monkeypatch.setattr(m, "BLOCK_NODES", 7)
    rng = np.random.default_rng(5)
    terms, nodes = rng.normal(size=(60, 6)), rng.normal(size=(30, 6))
    nodes[11], nodes[12], terms[3], nodes[4] = nodes[2], 2 * nodes[2], nodes[2], 0
    terms[8] = 0
    found = m.best_matches(terms_of(spark, terms), with_vectors(spark, nodes), 0.5, broadcast_values=limit)
    usual = m.best_matches(terms_of(spark, terms), with_vectors(spark, nodes), 0.5)
    assert sorted(map(str, found.collect())) == sorted(map(str, usual.collect()))
    got = {r["term"]: r["ordinal"] for r in found.collect()}
    assert got == brute(terms, nodes, 0.5)
    assert got["t3"] == 2 and "t8" not in got


def test_threshold_is_exclusive(spark):
    nodes = with_vectors(spark, [[0.55, np.sqrt(1 - 0.55 ** 2)]])
    assert m.best_matches(terms_of(spark, [[1, 0]]), nodes, 0.55).count() == 0
    assert m.best_matches(terms_of(spark, [[1, 0.001]]), nodes, 0.55).count() == 1


def test_no_nodes(spark):
    assert m.best_matches(terms_of(spark, [[1, 0]]), with_vectors(spark, [[1, 0]]).limit(0)).count() == 0


def word_vectors(spark, words):
    eye = np.eye(len(words))
    return spark.createDataFrame([(w, [float(x) for x in eye[i]]) for i, w in enumerate(words)],
                                 "token string, vector array<double>")


def test_term_vectors(spark):
    words = word_vectors(spark, ["big", "cat", "dog"])
    terms = spark.createDataFrame([("big cat",), ("big-big, dog!",), ("unknown",), ("",), ("Big",)], "term string")
    got = {r["term"]: r["vector"] for r in m.term_vectors(terms, words).collect()}
    assert got["big cat"] == [0.5, 0.5, 0.0]
    assert got["big-big, dog!"] == pytest.approx([2 / 3, 0, 1 / 3])
    assert set(got) == {"big cat", "big-big, dog!"}
    assert "Big" in {r["term"] for r in m.term_vectors(terms, words, lowercase=True).collect()}


def test_equal_names_match_the_first_branch(spark):
    words = word_vectors(spark, ["lion", "oak", "wolf", "tiger", "cats"])
    vectors = m.node_vectors(nodes_of(spark), words, lowercase=True)
    found = m.best_matches(m.term_vectors(spark.createDataFrame([("lion",), ("oak",)], "term string"), words),
                           vectors).collect()
    got = {r["term"]: (r["category"], r["subcategory"], r["topic"]) for r in found}
    assert got == {"lion": ("Animals", "Cats", "Lion"), "oak": ("Plants", "Trees", "Oak")}


def matches(spark):
    rows = [  # term, ordinal, category, subcategory, topic, label, level, score
        ("k1", 1, "A", "s1", "t1", "t1", "topic", .80), (" k1 ", 1, "A", "s1", "t1", "t1", "topic", .80),
        ("k2", 2, "A", "s2", None, "s2", "subcategory", .75),
        ("k3", 3, "B", None, None, "B", "category", .73), ("k4", 4, "C", "s1", "t1", "t1", "topic", .60),
        ("k5", 5, "D", None, None, "D", "category", .71)]
    return spark.createDataFrame(rows, "term string, ordinal long, category string, subcategory string, "
                                       "topic string, label string, level string, score double")


def test_labels_on_papers(spark):
    papers = spark.createDataFrame(
        [("p1", ["k5", "k4", " k1 ", "k2", "k3", "k1", "zzz", None]), ("p1", ["k3"]), ("p2", []), ("p3", None),
         ("p4", ["zzz"]), ("p5", ["k3"])], "paper_id string, paper_ai_keywords array<string>")
    out = lab.with_taxonomy(papers, matches(spark))
    assert out.columns == [*papers.columns, *spec.TAXONOMY_COLUMNS] and out.count() == 6
    rows = out.orderBy("paper_id", F.size("taxonomy_categories").desc()).collect()
    full = rows[0]
    assert full["taxonomy_categories"] == ["A", "B"] and full["primary_category"] == "A"
    assert full["category_scores"] == {"A": .80, "B": .73}
    assert full["taxonomy_subcategories"] == ["s1", "s2"]
    assert full["taxonomy_topics"] == ["t1"] and full["topic_scores"] == {"t1": .80}
    details = full["matched_keywords_details"]
    assert [d["keyword"] for d in details] == ["k5", "k4", "k1", "k2", "k3", "k1"]
    assert details[3].asDict() == {"keyword": "k2", "matched_to": "s2", "score": .75, "category": "A",
                                   "subcategory": "s2", "topic": None, "match_level": "subcategory"}
    assert rows[1]["paper_id"] == "p1" and rows[1]["taxonomy_categories"] == ["B"]
    for row in rows[2:5]:
        assert row["taxonomy_categories"] == [] and row["primary_category"] is None
        assert row["category_scores"] == {} and row["matched_keywords_details"] == []
    assert rows[5]["primary_category"] == "B"
    every = lab.with_taxonomy(papers, matches(spark), multi=False).orderBy(
        F.size("taxonomy_categories").desc()).first()
    assert every["taxonomy_categories"] == ["A", "B", "D", "C"]


def test_only_keywords_that_may_match_are_looked_up(spark):
    """Lists keep their values and places on the way, and most keywords without a match stay where they are."""
    odd = 'q"\\\u0001\n日'
    lists = [["a", "b", None, "a"], None, [], [odd, "", "x"], ["a", "b", None, "a"], [None], [" a"]]
    papers = spark.createDataFrame([(x,) for x in lists], "paper_ai_keywords array<string>")
    matches = spark.createDataFrame([("a",), (odd,), ("",)], "term string")
    kept = lab.keyword_lists(papers)
    assert sorted((r["keywords"] for r in kept.collect() if r["keywords"]), key=str) == sorted([lists[0], lists[3], [None], [" a"]], key=str)
    assert {r["term"] for r in lab.keyword_terms(papers).collect()} == {"a", "b", odd, "", "x", " a"}
    rows = sorted((r["pos"], r["term"]) for r in lab.matchable_rows(kept, matches).collect())
    assert rows == [(0, "a"), (0, odd), (1, ""), (3, "a")]
    assert lab.matchable_rows(kept, matches.limit(0)).count() == 0


def test_keywords_without_a_match_stay_with_many_terms(spark):
    """What passes the map by chance must not grow with the keywords times the matched terms."""
    terms = spark.range(1_500_000).select(F.concat(F.lit("m"), "id").alias("term"))
    lists = spark.range(400).select(F.unhex(F.md5(F.col("id").cast("string"))).alias("__list"), F.transform(
        F.sequence(F.lit(0), F.lit(999)), lambda x: F.concat(F.when(x < 10, "m").otherwise("w"), F.col("id") * 1000 + x)).alias("keywords"))
    kept = lab.matchable_rows(lists, terms).select(F.count_if(F.col("pos") < 10), F.count_if(F.col("pos") >= 10)).first()
    assert kept[0] == 4000 and kept[1] < 2000, kept


def test_shared_hits_travel_as_plain_lists(spark):
    """A paper that is shuffled takes eight bytes a hit with it, not a row for each."""
    words = spark.createDataFrame([(["b", None, "x", "a"],), (None,), ([],), (["x"],)], "keywords array<string>")
    shared = spark.sparkContext.broadcast((pa.array(["a", "b"]), None))
    found = words.select(lab.shared_hits(F.col("keywords"), shared).alias("h")).select("h.*")
    assert found.dtypes == [("pos", "array<int>"), ("match", "array<int>")]
    assert [tuple(r) for r in found.collect()] == [([0, 3], [1, 0]), ([], []), ([], []), ([], [])]


def test_labels_without_room_for_all_matches(spark, monkeypatch):
    """Labels and details are the same wherever the matches are looked up; with room for all, papers are not shuffled."""
    papers = spark.createDataFrame(
        [(i, ["k5", "k4", " k1 ", "k2", "k3", "k1", "zzz", None][i % 5:] + ["k4"] * i) for i in range(9)] + [(9, []), (10, None), (10, ["k2", "k2"]), (11, ["k2", "k2"])],
        "paper_id int, paper_ai_keywords array<string>")
    found = matches(spark).union(matches(spark).where("term = 'k5'").withColumn("label", F.lit("E")))
    for given in (matches(spark), found, matches(spark).limit(0)):
        seen = []
        for most in (200_000, 3, 0):
            monkeypatch.setattr(lab, "SHARED_TERMS", most)
            out = lab.with_taxonomy(papers, given)
            seen.append(sorted(map(str, out.collect())))
            plan = out._jdf.queryExecution().optimizedPlan().toString()
            if given is not found and (most or given.isEmpty()):
                assert ("Join" in plan) == (most < given.count())
        assert seen[0] == seen[1] == seen[2] and len(seen[0]) == 13
    details = lab.with_taxonomy(papers, found).where("paper_id = 0").first()["matched_keywords_details"]
    assert [(d["keyword"], d["matched_to"]) for d in details][:3] == [("k5", "D"), ("k5", "E"), ("k4", "t1")]


def test_reports(spark):
    papers = spark.createDataFrame(
        [("p1", ["k1", "k2", "k3"], 4.0), ("p2", ["k3"], None), ("p3", None, 6.0)],
        "paper_id string, paper_ai_keywords array<string>, citation_count double")
    out = lab.with_taxonomy(papers, matches(spark)).cache()
    cover = reports.coverage(out).first()
    assert cover["classified"] == 2 and cover["unclassified"] == 1 and cover["multi_category"] == 1
    assert cover["mean_categories"] == 1.0
    stats = {r["match_level"]: (r["matches"], r["mean_score"]) for r in reports.match_stats(out).collect()}
    assert stats["category"] == (2, pytest.approx(.73)) and stats[None][0] == 4
    assert [r["paper_id"] for r in reports.classified_sample(out).collect()] == ["p1", "p2"]
    row = reports.distribution_summary(out).first()
    assert row["total_papers"] == 3 and row["category_distribution"] == {"A": 1, "B": 1}
    assert row["citation_statistics"].asDict() == {
        "papers_with_citations": 2, "total_citations": 10, "average_citations": 5.0}
    assert row["match_statistics"]["matches_by_level"] == {"category": 2, "subcategory": 1, "topic": 1}
    empty = reports.distribution_summary(out.limit(0)).first()
    assert empty["coverage_percentage"] == 0.0 and empty["match_statistics"]["total_matches"] == 0


def test_papers_table(spark):
    raw = spark.createDataFrame(
        [("p1", "Lions", ["lion", "oak"], 100, ("org1", "Organisation 1", None)),
         ("p2", "Wolves", ["wolf"], 200, ("", "Organisation 2", None)), ("p3", "None", None, 300, None)],
        "paper_id string, paper_title string, paper_ai_keywords array<string>, paper_upvotes int, "
        "organization struct<name:string,fullname:string,_id:string>")
    words = word_vectors(spark, ["lion", "oak", "wolf", "tiger", "cats"])
    reference = spark.createDataFrame([("s1", "lions", 7)], "ext_id string, title string, citation_count long")
    out = papers_table(raw, dt.datetime(2025, 1, 8), nodes_of(spark), words, reference=reference,
                       as_of="2025-01-08", lowercase=True)
    assert tuple(out.columns) == spec.PAPERS.final and len(out.columns) == 48
    rows = {r["paper_id"]: r for r in out.collect()}
    assert rows["p1"]["organization_name"] == "org1" and rows["p3"]["organization_name"] == "unaffiliated"
    assert rows["p2"]["organization_name"] == "Organisation 2"
    assert rows["p1"]["taxonomy_topics"] == ["Lion", "Oak"] and rows["p1"]["citation_count"] == 7.0
    assert rows["p2"]["primary_topic"] == "Wolf" and rows["p2"]["citation_count"] is None
    assert rows["p3"]["taxonomy_categories"] == []
    bare = papers_table(raw.drop("paper_ai_keywords"), dt.datetime(2025, 1, 8), nodes_of(spark), words)
    assert bare.count() == 3 and bare.first()["taxonomy_topics"] == []
