"""Registered queries against their SQL and against plain Python, and the pipeline's stages."""

import os

import compare
import pytest

import __spark_entry__ as entry_module
import corpus_pipeline
from tidemark.llm.queries import ORACLE, QUERIES

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF_DIR)


def test_all_operators_and_the_pipeline_are_registered():
    names = list(entry_module.queries())
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)] == [1] * 13
    assert "pipeline" in names and set(QUERIES) <= set(names)


@pytest.mark.parametrize("name", list(ORACLE))
def test_query_equals_sql(spark, con, name):
    assert compare.differences(QUERIES[name](spark, SF_DIR), con, ORACLE[name]) == ""


@pytest.mark.parametrize("name", ["op3_url_filter", "op7_source_mixing", "op12_fingerprints"])
def test_native_plans_have_no_python(spark, name):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE) - {"op11_whitening"}))
def test_one_row_for_each_document(spark, name):
    found = QUERIES[name](spark, SF_DIR)
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    assert sorted(r[0] for r in found.select("doc_id").collect()) == sorted(r[0] for r in documents.select("doc_id").collect())


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, seen = docs.columns, [docs.count()]
    ids = {r[0] for r in docs.select("doc_id").collect()}
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, SF_DIR)
        docs = corpus_pipeline.kept(docs, f"test-stage-{k}")
        seen.append(docs.count())
        assert {r[0] for r in docs.select("doc_id").collect()} <= ids
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns
    assert seen[0] >= seen[1] > seen[2] > seen[3] > 0 and seen[5] == seen[4]
    assert docs.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def test_pipeline_of_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_DIR)
    assert docs.count() == 0


def test_pipeline_keeps_columns_with_any_name(spark):
    extra = "*", "1 AS score", "2 AS accepted", "3 AS predicted", "4 AS size", "5 AS copies", "6 AS kept", "named_struct('a', 7) AS `x y`"
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").selectExpr(*extra)
    columns = docs.columns
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES[:4]):
        docs = corpus_pipeline.kept(stage(spark, docs, SF_DIR), f"wide-stage-{k}")
        assert docs.columns == columns
    assert {tuple(r) for r in docs.select("score", "accepted", "predicted", "size", "copies", "kept", "`x y`.a").collect()} == {
        (1, 2, 3, 4, 5, 6, 7)
    }
