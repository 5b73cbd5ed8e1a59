"""Spark results against the DuckDB oracle on the smallest driver tables (the driver checks sf0.01)."""

import pytest

import __spark_entry__ as E
from ordercraft.checks.compare import compare, duck_connect

SMOKE = "/root/testdata/sf0.001"
NAMES = ["order_details", "order_details_legacy", "staged_orders", "order_quarantine", "refill_candidates_cn",
         "top_rules", "run_staged_refill", "run_staged_opportunities", "run_backfill_refill",
         "run_backfill_opportunities", "brand_affinity_cn", "error_rows", "error_rows_cn",
         "refill_candidates_paired", "run_staged_opportunities_view", "refill_upsert_per_row", "refill_quarantine"]


@pytest.fixture(scope="module")
def con():
    return duck_connect(SMOKE)


@pytest.mark.parametrize("name", NAMES)
def test_matches_oracle(spark, con, name):
    res = compare(E.queries()[name](spark, SMOKE), con, E.oracle_sql()[name])
    assert res["columns_match"], (res["spark_columns"], res["oracle_columns"])
    assert res["rows_spark"] == res["rows_oracle"] and res["hash_match"]


def test_every_query_has_an_oracle():
    assert set(E._QUERIES) <= set(E.oracle_sql())
    assert set(E.oracle_sql()) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert len(df.columns) == 31 and df.count() > 0
