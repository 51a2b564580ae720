import datetime as dt

import pytest
from pyspark.sql import functions as F

from hubcat import spec
from hubcat.operators.conform import column_status, conform, finalise, require_key_values
from hubcat.operators.flags import inspect_row, with_flags, with_normal_tags
from hubcat.operators import reports
from hubcat.plans.models import datasets_table, models_table
from hubcat.sources.scans import previous_citations, read_batches, scan, scan_catalog
from hubcat.sources.sinks import verify, write_csv, write_parquet, write_report
from hubcat.sources.snapshots import (read_snapshot, weekly_paths, write_snapshot, write_weekly)

NOW = dt.datetime(2025, 1, 8, 12, 0)


def raw_models(spark):
    return spark.createDataFrame(
        [
            ("org1/modelA", "100", "x", '{"total": 500000000}', ["robotics", "vision"], ""),
            ("org2/modelB", "1d", "5", '{"total": 2000000000}', ["audio", "speech"], None),
            ("unaffiliated_modelC", None, None, '{"total": 60000000000}', ["text", "nlp"], "x"),
            (None, "7", "1", None, None, "automatic-speech-recognition"),
        ],
        "id string, downloads string, likes string, safetensors string, tags array<string>, "
        "pipeline_tag string",
    )


def test_models_table(spark):
    out = models_table(raw_models(spark), NOW)
    assert tuple(out.columns) == spec.MODELS.final and len(out.columns) == 24
    rows = {r["id"]: r for r in out.collect()}
    a, b, c, d = rows["org1/modelA"], rows["org2/modelB"], rows["unaffiliated_modelC"], rows[""]
    assert (a["organization"], a["size_category"], a["downloads"]) == ("org1", "Small (<1GB)", 100.0)
    assert a["likes"] == 0.0 and a["downloadsAllTime"] == 0.0 and a["createdAt"] is None
    assert a["has_robot"] and a["has_image"] and not a["has_text"]
    assert b["downloads"] == 0.0 and b["size_category"] == "Medium (1-5GB)"
    assert b["has_audio"] and b["has_speech"] and b["is_audio_speech"] and b["pipeline_tag"] == ""
    assert c["organization"] == "unaffiliated" and c["size_category"] == "XX-Large (>50GB)"
    assert c["has_text"]
    assert d["tags"] == [] and d["params"] == -1.0 and d["size_category"] == "Unknown"
    assert d["is_audio_speech"] and not d["has_audio"]


def test_models_plan_has_no_shuffle_and_one_joined_text(spark):
    plan = models_table(raw_models(spark), NOW)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
    assert plan.count("array_join") == 1


def test_existing_params_win(spark):
    raw = spark.createDataFrame([("a/b", 3.0), ("a/c", None)], "id string, params double")
    got = {r["id"]: r["params"] for r in models_table(raw, NOW).collect()}
    assert got == {"a/b": 3.0, "a/c": 0.0}


def test_datasets_table(spark):
    raw = spark.createDataFrame([("o/d", ["openvla", "image"])], "id string, tags array<string>")
    out = datasets_table(raw, NOW)
    assert "size_category" not in out.columns and "organization" in out.columns
    assert len(out.columns) == 19
    row = out.first()
    assert row["has_image"] and not row["has_robot"]
    assert models_table(raw, NOW).first()["has_robot"]


def test_flags(spark):
    rows = [(1, ["biography"]), (2, ["context"]), (3, ["science"]), (4, ["bigscience"]),
            (5, ["bigscience", "science"]), (6, ["Medical"]), (7, None)]
    df = with_flags(with_normal_tags(spark.createDataFrame(rows, "id int, tags array<string>")))
    got = {r["id"]: r for r in df.collect()}
    assert got[1]["has_bio"] and got[1]["is_biomed"] and got[2]["has_text"]
    assert got[3]["has_science"] and not got[4]["has_science"] and not got[5]["has_science"]
    assert got[6]["has_med"] and got[6]["is_biomed"]
    assert not any(got[7][f] for f in (*spec.MODEL_FLAGS, "has_science", "is_biomed"))
    counts = {r["flag"]: (r["rows"], r["percent"]) for r in reports.flag_counts(df).collect()}
    assert counts["is_biomed"] == (2, pytest.approx(200 / 7))
    row = inspect_row(df, 5).first()
    assert row["tag_text"] == "bigscience~~~science" and row["has_science"] is False


def test_conform_and_finalise(spark):
    with pytest.raises(ValueError):
        conform(spark.range(1).withColumnRenamed("id", "x"), spec.MODELS, NOW)
    papers = conform(spark.createDataFrame([("p1", "3")], "paper_id string, paper_upvotes string"),
                     spec.PAPERS, NOW)
    assert len(papers.columns) == 35
    row = papers.first()
    assert row["paper_upvotes"] == 3.0 and row["numComments"] == 0.0 and row["title"] is None
    out = finalise(papers, spec.PAPERS)
    assert len(out.columns) == 48 and "paper_organization.name" in out.columns
    done = finalise(spark.createDataFrame([("a",)], "id string"), spec.DATASETS).first()
    assert done["has_text"] is False and done["organization"] is None
    status = {r["column"]: r["status"] for r in column_status(papers, ["paper_id", "zz"]).collect()}
    assert status == {"paper_id": "present", "zz": "missing"}
    with pytest.raises(ValueError):
        require_key_values(spark.createDataFrame([(None,)], "paper_id string"), "paper_id")


def test_quality_reports(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), (None, None), (None, 4.0), ("b", 10.0)],
                               "k string, v double")
    assert reports.duplicate_count(df, "k").first()[0] == 2
    assert tuple(reports.value_coverage(df, "v").first()) == (5, 4, 80.0)
    assert reports.organization_count(df, "k").first()[0] == 2
    assert tuple(reports.value_stats(df, "v").first()) == (4, 4.25, 3.0, 10.0, 17.0)
    empty = reports.value_stats(df.where("v > 99"), "v").first()
    assert empty["values"] == 0 and empty["median"] is None
    dist = reports.label_distribution(df, "k", 1).collect()
    assert [tuple(r) for r in dist] == [("a", 2, 40.0)]
    assert reports.known_sizes(df, "v").first()[0] == 4


def test_tag_reports(spark):
    df = spark.createDataFrame([(["A", "b "],), (["a"],), ([],), (None,), (list("abcdefghij"),)],
                               "tags array<string>")
    assert tuple(reports.tag_length_stats(df).first()) == (2, 2.6, 10, 1)
    top = [tuple(r) for r in reports.top_tags(df, k=3).collect()]
    assert top == [("a", 3), ("b", 2), ("c", 1)]
    assert reports.unique_tags(df).first()[0] == 10


def test_scans_and_sinks(spark, tmp_path):
    raw = raw_models(spark)
    path = str(tmp_path / "raw")
    write_parquet(raw.withColumn("extra", F.lit(1)), path)
    assert scan_catalog(spark, path, spec.MODELS).columns == [
        "id", "downloads", "likes", "pipeline_tag", "tags", "safetensors"]
    assert scan(spark, path, ["id"], limit=2).count() == 2
    empty = str(tmp_path / "empty")
    write_parquet(raw.limit(0), empty)
    with pytest.raises(ValueError):
        scan_catalog(spark, empty, spec.MODELS)
    out = str(tmp_path / "out")
    write_parquet(models_table(raw, NOW), out)
    assert tuple(verify(spark, out).first()) == (4, 24, 1, 3)
    csv = str(tmp_path / "csv")
    nested = spark.createDataFrame([("a,\"b\"\nc", ["x", "y"], {"k": 1.5})],
                                   "s string, l array<string>, m map<string,double>")
    write_csv(nested, csv)
    back = spark.read.option("escape", '"').option("multiLine", True).csv(csv, header=True).first()
    assert tuple(back) == ('a,"b"\nc', '["x","y"]', '{"k":1.5}')
    report = str(tmp_path / "report")
    write_report(nested.select(F.struct("l", "m").alias("r")), report)
    assert spark.read.json(report).first()["r"]["l"] == ["x", "y"]


def test_dotted_columns_survive(spark, tmp_path):
    path = str(tmp_path / "dots")
    spark.createDataFrame([("p", "n")], "`paper_id` string, `paper_organization.name` string"
                          ).write.parquet(path)
    raw = scan_catalog(spark, path, spec.PAPERS)
    assert finalise(conform(raw, spec.PAPERS, NOW), spec.PAPERS).first()[
        "paper_organization.name"] == "n"


def test_snapshots(spark, tmp_path):
    path = str(tmp_path / "snap")
    meta = write_snapshot(spark.range(5), path, NOW).first()
    assert meta["total_rows"] == 5
    df, stamp = read_snapshot(spark, path, limit=3)
    assert df.count() == 3 and df.select(stamp.alias("t")).first()["t"] == NOW
    bare = str(tmp_path / "bare")
    spark.range(1).write.parquet(f"{bare}/data")
    df, stamp = read_snapshot(spark, bare)
    assert df.select(stamp.alias("t")).first()["t"] is not None


def test_batch_files_and_previous_cache(spark, tmp_path):
    spark.createDataFrame([("a", 1.0)], "paper_id string, citation_count double").write.parquet(
        str(tmp_path / "citations_batch_0"))
    spark.createDataFrame([("b", "s")], "paper_id string, semantic_scholar_id string"
                          ).write.parquet(str(tmp_path / "citations_batch_1"))
    merged = read_batches(spark, str(tmp_path / "citations_batch_*"))
    assert merged.count() == 2
    assert {"paper_id", "citation_count", "semantic_scholar_id", "batch_file"} == set(merged.columns)
    with pytest.raises(Exception):
        read_batches(spark, str(tmp_path / "nothing_*"))
    assert previous_citations(None, spark).count() == 0
    assert previous_citations(merged, spark).columns == [
        "paper_id", "citation_count", "semantic_scholar_id"]


def test_weekly_layout(spark, tmp_path):
    path = str(tmp_path / "weekly")
    rows = spark.createDataFrame([("models", "2025-01-01", 1), ("models", "2025-01-08", 2)],
                                 "item string, week string, v int")
    write_weekly(rows, path)
    write_weekly(rows.where("v = 2").withColumn("v", F.lit(9)), path)
    got = {(str(r["week"]), r["v"]) for r in spark.read.parquet(path).collect()}
    assert got == {("2025-01-01", 1), ("2025-01-08", 9)}
    assert weekly_paths(spark, path).count() == 2


def test_types_are_those_of_the_specification(spark):
    full = spark.createDataFrame([("p", "2025-01-02T00:00:00Z", "true", '["a"]', "junk")],
                                 "paper_id string, publishedAt string, isAuthorParticipating string, paper_ai_keywords string, paper_withdrawnAt string")
    bare = spark.createDataFrame([("p",)], "paper_id string")
    done = [finalise(conform(raw, spec.PAPERS, NOW), spec.PAPERS) for raw in (full, bare)]
    assert done[0].dtypes == done[1].dtypes and dict(done[0].dtypes)["publishedAt"] == "timestamp"
    row = done[0].first()
    assert row["isAuthorParticipating"] is True and row["paper_ai_keywords"] == ["a"] and row["paper_withdrawnAt"] is None


def test_batches_are_named_by_the_pattern(spark, tmp_path):
    from hubcat.sources.scans import read_batches
    for k in (0, 1):
        spark.range(4).repartition(2).write.parquet(str(tmp_path / f"run 1/citations_batch_{k}"))
    rows = read_batches(spark, str(tmp_path / "run 1/citations_batch_*")).groupBy("batch_file").count().collect()
    assert {r["batch_file"]: r["count"] for r in rows} == {"citations_batch_0": 4, "citations_batch_1": 4}


def test_csv_keeps_values(spark, tmp_path):
    from hubcat.sources.sinks import read_csv, write_csv
    rows = [(i, v) for i, v in enumerate([" x ", "", None, 'a"b', "l\r\nm", "\t", "c,d", "\\"])]
    path = str(tmp_path / "csv")
    write_csv(spark.createDataFrame(rows, "i long, v string"), path)
    assert sorted(tuple(r) for r in read_csv(spark, path, "i long, v string").collect()) == rows
