import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from hubcat.operators import matching
from hubcat.operators.matching import term_vectors

WIDTH = 300


def plain(terms, vectors):
    out = {}
    for term in set(terms) - {None}:
        known = [vectors[w] for w in term.replace(",", " ").split() if w in vectors]
        if known:
            out[term] = np.mean(known, axis=0)
    return out


def check(found, expected):
    rows = found.collect()
    assert len(rows) == len(expected)
    assert all(np.allclose(r["vector"], expected[r["term"]], rtol=1e-12) for r in rows)


@pytest.mark.parametrize("batch", [10000, 3])
def test_means_at_the_width_of_real_vectors(spark, batch):
    rng = random.Random(6)
    vectors = {f"w{i}": [rng.random() for _ in range(WIDTH)] for i in range(60)}
    words = [*vectors, "unknown", "other"]
    terms = [" ".join(rng.choice(words) for _ in range(rng.randrange(1, 9))) for _ in range(300)]
    terms += [None, "", "unknown", "w1, w1, w1 unknown w2", " ".join(rng.choice(words) for _ in range(20000))] + terms[:50]
    table = spark.createDataFrame(list(vectors.items()), "token string, vector array<float>")
    exact = {w: np.asarray(v, "f4").astype("f8") for w, v in vectors.items()}
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        check(term_vectors(spark.createDataFrame([(t,) for t in terms], "term string").repartition(3), table), plain(terms, exact))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_empty_inputs_and_one_frequent_word(spark):
    none = spark.createDataFrame([], "term string")
    table = spark.createDataFrame([("a", [1.0, 2.0]), ("b", None)], "token string, vector array<double>")
    assert term_vectors(none, table).collect() == []
    assert term_vectors(spark.createDataFrame([("x",)], "term string"), table.limit(0)).collect() == []
    many = spark.range(500).select(F.concat(F.lit("a b "), "id").alias("term"))
    assert {tuple(r["vector"]) for r in term_vectors(many, table).collect()} == {(1.0, 2.0)}


def test_plan_does_not_widen_with_the_vectors(spark, tmp_path):
    spark.range(100).select(F.concat(F.lit("w"), F.col("id") % 7, F.lit(" w1")).alias("term")).write.parquet(str(tmp_path / "terms"))
    spark.range(7).select(F.concat(F.lit("w"), "id").alias("token"), F.array_repeat(F.col("id").cast("float"), WIDTH).alias("vector")).write.parquet(str(tmp_path / "vectors"))
    made = term_vectors(spark.read.parquet(str(tmp_path / "terms")), spark.read.parquet(str(tmp_path / "vectors")))
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan
    assert len(plan) < 20_000 and plan.count("MapInArrow") == 2 and "Cartesian" not in plan and "BroadcastNestedLoop" not in plan
    assert made.count() == 7


@pytest.mark.parametrize("most", [0, 3, 20, 1000])
def test_frequent_words_do_not_move(spark, monkeypatch, most):
    """Any number of words may be taken as frequent: the means stay, and only rare words go to their vectors."""
    rng = random.Random(4)
    vectors = {f"w{i}": [rng.random() for _ in range(5)] for i in range(60)}
    terms = [" ".join(f"w{min(int(rng.expovariate(0.3)), 70)}" for _ in range(rng.randrange(1, 30))) for _ in range(200)] + ["w59", "none", ""]
    monkeypatch.setattr(matching, "FREQUENT_WORDS", most)
    made = term_vectors(spark.createDataFrame([(t,) for t in terms], "term string"), spark.createDataFrame(list(vectors.items()), "token string, vector array<double>"))
    check(made, plain(terms, vectors))
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert ("_rare_words" in plan or "Join" in plan) == (most < 1000)
