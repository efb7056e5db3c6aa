"""Time the headline queries and print one JSON line.

Layers are built first and timed on their own; each query then runs once over whole tables into a no-op sink.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tallyline.queries import base, catalog  # noqa: E402
from tallyline.session import build_session  # noqa: E402

LAYERS = ["bronze", "silver", "invoice_rollup", "mart_rfm", "dim_date", "dim_product", "dim_country", "dim_customer",
          "fact_transactions", "mart_kpi_monthly", "mart_features", "train_features"]
HEADLINE = [
    "g7_mart_kpi_monthly", "g6_mart_rfm", "g5_fact_transactions", "g5_fact_hash_keys", "g8_mart_features", "g9_churn_labels",
    "g10_feature_matrix_train", "a5_full_row_distinct", "a12_quantiles", "q6_quality_summary", "q8_bronze_silver_delta",
    "q20_validation_report", "q22_key_coverage", "declared_column_checks", "b1_segment_summary", "b2_monthly_revenue_trend",
    "b3_top_products", "b6_segment_revenue_by_quarter", "b9_cohort_activity", "b12_customers_for_share", "b23_customer_percentiles",
    "b24_business_measures", "b27_rolling_churn", "j13_largest_lines", "l5_top_percent_share", "w3_quintiles", "w4_order_gaps",
    "m7_area_under_roc", "m9_best_threshold", "c5_cluster_profiles", "k1_data_drift", "k2_model_drift", "s1_raw_file_scan",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session("bench", f"local[{cpus}]", cpus, **{
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"), "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    queries, seconds = catalog.queries(), {}
    spark.range(1000).selectExpr("sum(id)").collect()
    retail = base.retail(spark, folder)
    for name in LAYERS:
        start = time.perf_counter()
        retail.lake.table(name)
        seconds[f"layer_{name}"] = round(time.perf_counter() - start, 3)
    for name in HEADLINE:
        start = time.perf_counter()
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({"metric": "headline queries, layers included", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
