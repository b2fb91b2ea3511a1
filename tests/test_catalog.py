"""Every registered query against its SQL, and the shape of its plan."""

import os
import re

import compare
import pytest

import __spark_entry__ as entry_module
from tidemark.plans.catalog import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
NAMES = list(QUERIES)
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF_DIR)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, con, name):
    df = entry_module.queries()[name](spark, SF_DIR)
    # Steps that were written to files while the query was built, such as a
    # vocabulary, are not part of this plan.
    plan = plan_of(df)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert compare.differences(df, con, entry_module.oracle_sql()[name]) == ""


def test_every_query_has_sql():
    assert set(NAMES) <= set(entry_module.oracle_sql()) <= set(entry_module.queries())


def test_entry(spark):
    df = entry_module.entry(spark)
    assert df.columns == ["product", "total_orders", "total_quantity", "total_revenue"]
    assert df.count() > 0


def test_gold_reads_only_the_columns_it_needs(spark):
    plan = plan_of(entry_module.queries()["gold_product_sales"](spark, SF_DIR))
    scans = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    read = {f.split(":")[0] for s in scans for f in s.split(",")}
    assert not read & {"l_tax", "l_discount", "l_shipdate", "o_totalprice", "p_name", "p_brand"}
    assert len(scans) == 3


def test_dedupe_keeps_one_row_per_key_before_the_shuffle(spark):
    plan = plan_of(entry_module.queries()["silver_orders"](spark, SF_DIR))
    partial = plan.index("Partial", plan.index("WindowGroupLimit"))
    assert plan.index("WindowGroupLimit") < plan.index("Exchange hashpartitioning(order_id") < partial


def test_search_sends_keys_and_scores_only(spark):
    """Chunks go from the scan into the scoring task without a shuffle and without
    their text, which is joined to the final rows."""
    plan = plan_of(entry_module.queries()["bm25_topk"](spark, SF_DIR))
    below = plan[plan.index("MapInArrow") :]
    read = re.findall(r"ReadSchema: struct<(.*?)>\n", below)
    assert "Exchange" not in below.split("FileScan")[0]
    assert any("tokens" in r and "text:" not in r for r in read)


def test_no_plan_deals_rows_out_in_turn(spark):
    for name in ("contract_valid", "chunk_words", "bm25_topk", "dense_topk_dot"):
        assert "RoundRobinPartitioning" not in plan_of(entry_module.queries()[name](spark, SF_DIR)), name


def test_the_rows_of_one_check_are_limited_twice(spark):
    plan = plan_of(entry_module.queries()["dq_failing_rows"](spark, SF_DIR))
    assert "hashpartitioning(check_name#" in plan and re.search(r"hashpartitioning\(check_name#\d+, _salt#", plan)
