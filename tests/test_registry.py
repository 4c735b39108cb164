"""The registry covers the inventory, and a cross-section agrees with its SQL at sf0.001."""

import re

import duckdb
import pytest

import __spark_entry__ as entry
from check import NAMES, table
from tests.conftest import SF

COUNTS = {"s": 19, "p": 17, "j": 19, "a": 26, "w": 20, "o": 8, "u": 4, "f": 24, "t": 16, "l": 12, "q": 16, "m": 9, "b": 143}
NO_QUERY = {"s15"}        # needs a database

SAMPLE = ["s04_json_corrupt_rows", "s11_union_of_paths", "p13_quantified_subqueries", "j14_salted_join", "j15_table_difference", "a14_median", "w02_rank", "w14_lagged_frame",
          "w18_reset_running_total", "o07_top_percent", "f12_business_days", "t06_tumbling_window", "l03_change_data", "l04_versioned_dimension", "q04_imputation", "b03_top_n_per_category",
          "b06_org_hierarchy", "b25_converted_within", "b31_basket_pairs", "b72_max_concurrency", "b76_budget_fill", "b88_adherence", "b101_portfolio", "b114_rate_in_force", "m07_item_similarity"]


def test_every_inventory_id_has_a_query():
    have = {m.group() for name in entry.queries() if (m := re.match(r"[a-z]\d+", name))}
    want = {f"{k}{i:02d}" for k, n in COUNTS.items() for i in range(1, n + 1)} - NO_QUERY
    assert want - have == set()


def test_oracles_belong_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for n in NAMES:
        c.execute(f"create view {n} as select * from '{SF}/{n}.parquet'")
    return c


@pytest.mark.parametrize("name", SAMPLE)
def test_query_agrees_with_sql(spark, con, name):
    df = entry.queries()[name](spark, SF)
    cur = con.execute(entry.oracle_sql()[name])
    assert table([tuple(r) for r in df.collect()], df.columns) == table(cur.fetchall(), [d[0] for d in cur.description])


def test_flagship_runs(spark):
    assert entry.entry(spark).count() > 0


def test_scan_pushes_filter_and_prunes_columns(spark):
    plan = entry.queries()["s01_parquet_scan"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(l_quantity)" in plan and "l_shipdate" not in plan
