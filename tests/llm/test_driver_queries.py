import os

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from hubcat.llm import queries as llm
from hubcat.session import stored
from oracle import compare, connect

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")
ROWS = {"op5_space_curves": None, "op9_html_layout": "pages"}


def test_entry_has_all_of_them():
    assert {int(name[2:].split("_")[0]) for name in llm.QUERIES} == set(range(1, 14))
    assert {*llm.QUERIES, "pipeline"} <= set(entry.queries()) and set(llm.ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(llm.ORACLE))
def test_against_sql(spark, name):
    assert compare(spark, connect(SF), llm.QUERIES[name], llm.ORACLE[name], SF) == []


@pytest.mark.parametrize("name", sorted(set(llm.QUERIES) - set(llm.ORACLE) - {"op5_space_curves", "op1_pattern_packing", "op11_chebyshev_whitening"}))
def test_one_row_for_each_input_row(spark, name):
    table = ROWS.get(name, "documents")
    rows = llm.QUERIES[name](spark, SF)
    key = rows.columns[0]
    assert rows.select(key).exceptAll(spark.read.parquet(f"{SF}/{table}.parquet").select(key)).count() == 0
    assert rows.count() == spark.read.parquet(f"{SF}/{table}.parquet").count()


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    counts = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stored(stage(spark, docs, SF), name.replace(" ", "_"))
        assert after.columns == docs.columns and after.dtypes == docs.dtypes
        assert after.select("doc_id").exceptAll(docs.select("doc_id")).count() == 0
        counts.append(after.count())
        docs = after
    assert counts == sorted(counts, reverse=True) and counts[-1] >= 0.7 * counts[0]
    packed = corpus_pipeline.packing(spark, docs, SF)
    assert packed.select("doc_id").distinct().count() == counts[-1]
