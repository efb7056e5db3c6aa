"""Registered queries against their oracle SQL on the smallest data, and plan checks."""

from __future__ import annotations

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from retail_rows import SMALL_DATA
from tallyline.queries import base

pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL_DATA), reason="test tables are not there")

CHECKED = [
    "g1_dim_date", "g2_dim_customer", "g5_fact_transactions", "g5_fact_hash_keys", "g6_mart_rfm", "g7_mart_kpi_monthly",
    "g8_mart_features", "g8_mart_features_all_invoices", "g10_feature_matrix_train", "q6_quality_summary", "q8_bronze_silver_delta",
    "q22_key_coverage", "q30_quarantine", "t1_bronze_stg_reconciliation_seeded", "t17_kpi_revenue_reconcile_seeded",
    "t27_stg_no_duplicate_grain_seeded", "b3_top_products", "b9_cohort_activity", "b12_customers_for_share", "b27_rolling_churn",
    "b23_customer_percentiles", "m7_area_under_roc", "m9_best_threshold", "c5_cluster_profiles", "k2_model_drift",
    "s1_raw_file_scan", "s6_ingest_all_months", "x1_stream_ingest", "x2_stream_kpi",
]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
                 "conversations").split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL_DATA}/{name}.parquet'")
    return con


def normal(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return ""
    return repr(float(value)) if isinstance(value, (int, float)) and not isinstance(value, bool) else str(value)


def test_registry_is_consistent():
    queries, oracles = entry.queries(), entry.oracle_sql()
    assert set(oracles) <= set(queries) and len(queries) > 250
    assert len(queries) - len(oracles) < 45


def compare(spark, duck, name, folder):
    df = entry.queries()[name](spark, folder)
    columns = sorted(df.columns)
    result = duck.execute(entry.oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    expected = sorted(tuple(normal(row[i]) for i in order) for row in result.fetchall())
    assert sorted(tuple(normal(r[c]) for c in columns) for r in df.collect()) == expected


@pytest.mark.parametrize("name", CHECKED)
def test_equals_oracle(spark, duck, name):
    compare(spark, duck, name, SMALL_DATA)


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0


def test_layers_are_written_once(spark):
    r = base.retail(spark, SMALL_DATA)
    assert r.silver is r.silver and base.retail(spark, SMALL_DATA + "/") is r


@pytest.mark.parametrize("name", ["g7_mart_kpi_monthly", "g8_mart_features", "g5_fact_hash_keys", "b9_cohort_activity",
                                  "b27_rolling_churn", "w4_order_gaps"])
def test_no_wide_rows_through_one_task(spark, name):
    plan = entry.queries()[name](spark, SMALL_DATA)._jdf.queryExecution().executedPlan().toString()
    assert "WindowExec" not in plan or "SinglePartition" not in plan
    for line in plan.splitlines():
        assert not ("Window" in line and "SinglePartition" in line)
    assert "ArrowEvalPython" not in plan and "BatchEvalPython" not in plan and "CartesianProduct" not in plan


def test_largest_lines_do_not_read_the_fact_again(spark):
    plan = entry.queries()["j13_largest_lines"](spark, SMALL_DATA)._jdf.queryExecution().optimizedPlan().toString()
    assert "Sort" not in plan and "Limit" not in plan  # the lines were found and staged before


def test_month_filter_reaches_the_partitions(spark):
    plan = entry.queries()["s11_pruned_glob_scan"](spark, SMALL_DATA)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year_month" in plan


@pytest.fixture(scope="module")
def hot_data(tmp_path_factory):
    """The small tables with a third of all lines on one product, a third on two orders and a third of orders on one customer."""
    folder = str(tmp_path_factory.mktemp("hot"))
    con = duckdb.connect()
    changes = {
        "lineitem": "REPLACE (CASE WHEN l_linenumber % 3 = 0 THEN 7 ELSE l_partkey END AS l_partkey, "
                    "CASE WHEN l_suppkey % 6 = 0 THEN 11 WHEN l_suppkey % 6 = 1 THEN 13 ELSE l_orderkey END AS l_orderkey)",
        "orders": "REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN 3 ELSE o_custkey END AS o_custkey)"}
    for name in ("lineitem", "orders", "customer", "nation", "part"):
        con.execute(f"COPY (SELECT * {changes.get(name, '')} FROM '{SMALL_DATA}/{name}.parquet') TO '{folder}/{name}.parquet' (FORMAT parquet)")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return folder, con


@pytest.mark.parametrize("name", ["g5_fact_transactions", "g6_mart_rfm", "g8_mart_features", "w4_order_gaps", "b9_cohort_activity",
                                  "b12_pareto_products"])
def test_hot_keys_equal_oracle(spark, hot_data, name):
    folder, con = hot_data
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        compare(spark, con, name, folder)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
