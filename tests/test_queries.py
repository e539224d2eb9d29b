"""Every registered query against its SQL at the smallest scale, and plan checks."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check import compare, oracle_connection
from ledgerloom.plans.registry import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")


@pytest.fixture(scope="module")
def con():
    return oracle_connection(SF_DIR)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, con, name):
    verdict, _ = compare(spark, con, SF_DIR, name)
    assert verdict.startswith(("ok", "rows only")), verdict


def test_every_query_has_sql():
    assert set(QUERIES) <= set(oracle_sql())


def test_entry(spark):
    assert entry(spark).count() > 0


PLAN_CHECKED = [
    "star_join", "effective_lookup", "range_lookup_const", "range_join", "band_join", "join_or_keys", "override_lookup",
    "temporal_join", "row_filter", "dq_quarantine", "benford_fraud", "contract_profit", "contract_period_merge", "contract_enrichment",
    "merge_upsert", "order_generator", "finance_runoff",
]


@pytest.mark.parametrize("name", PLAN_CHECKED)
def test_no_nested_loop_or_product(spark, name):
    plan = queries()[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_scan_reads_two_columns_and_pushes_the_filter(spark):
    plan = queries()["filter_in"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderpriority:string>" in plan
    assert "PushedFilters: [In(o_orderpriority" in plan
