"""Every registered query against its SQL, on the smallest tables."""

import os

import pytest

import __spark_entry__ as contract
import compare
from trackloom.plans.catalogue import QUERIES

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    return compare.connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_agrees_with_sql(spark, duck, name):
    assert name in contract.oracle_sql()
    assert compare.compare(spark, duck, SF_DIR, name) is None


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["track_id", "prompts_total", "prompts_ok", "total_processing_time_sec", "status"]
    assert df.count() > 0


def test_plans_have_no_products_and_read_few_columns(spark):
    from conftest import plan_of

    for name in ("track_rollup", "pending_pairs", "fan_out", "manifest_remaining", "summary_pivot", "key_consensus"):
        plan = plan_of(contract.queries()[name](spark, SF_DIR))
        assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan, name
        if name != "fan_out":
            assert "text:string" not in plan, name
