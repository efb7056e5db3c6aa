"""Marts, features, labels, scoring acceptance, monitoring and exports on hand-made rows."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tallyline import schemas
from tallyline.plans import analytics, churn, export, features, marts, monitoring, quality, scoring


@pytest.fixture(scope="module")
def lines(make_lines):
    return make_lines(
        ("1", "P1", 10, 5.0, "C1", "United Kingdom", "2024-01-01 10:00:00"),
        ("2", "P2", 2, 12.0, "C1", "United Kingdom", "2024-01-31 23:59:59"),
        ("C3", "P1", -1, 5.0, "C1", "United Kingdom", "2024-02-01 00:00:00"),
        ("4", "P1", 4, 2.5, "C2", "France", "2024-01-06 09:00:00"),
        ("5", "P1", 7, 1.0, "", "France", "2024-04-30 09:00:00"),
        ("C6", "P2", -2, 3.0, "C3", "Spain", "2024-01-07 09:00:00"),
    )


def test_rfm_excludes_cancellations_and_guests(lines, scratch):
    rows = {r["customer_id"]: r for r in marts.mart_rfm(marts.invoice_rollup(lines), scratch).collect()}
    assert set(rows) == {"C1", "C2"}
    assert (rows["C1"]["frequency"], rows["C1"]["monetary"], rows["C1"]["recency_days"]) == (2, 74.0, 0)
    assert rows["C2"]["recency_days"] == 25 and {rows["C1"]["r_score"], rows["C2"]["r_score"]} == {1, 2}


def test_kpi(lines):
    rows = {r["year_month"]: r for r in marts.kpi_monthly(marts.invoice_rollup(lines)).collect()}
    jan = rows["2024-01"]
    assert (jan["revenue"], jan["orders"], jan["active_customers"], jan["cancelled_orders"], jan["line_count"]) == (84.0, 3, 2, 1, 4)
    assert jan["net_revenue"] == 78.0 and jan["aov"] == 28.0 and jan["cancellation_order_rate"] == 0.25
    assert rows["2024-04"]["aov"] is None and rows["2024-04"]["orders"] == 0


def test_features(lines):
    got = {r["customer_id"]: r for r in features.mart_features(lines).collect()}
    assert set(got) == {"C1", "C2"} and got["C1"].__fields__[1:] == schemas.FEATURE_COLUMNS
    one = got["C1"]
    assert one["recency_days"] == 90 and one["frequency"] == 2 and one["tenure_days"] == 30
    assert one["avg_days_between_orders"] == pytest.approx(30 + 50399 / 86400) and one["std_days_between_orders"] == 0
    assert one["cancellation_rate"] == pytest.approx(1 / 3) and one["return_quantity_rate"] == pytest.approx(1 / 12)
    assert one["frequency_last_90d"] == 1 and one["is_uk"] == 1 and one["monetary_trend"] == 0
    two = got["C2"]
    assert two["is_one_time_buyer"] == 1 and two["avg_days_between_orders"] == two["recency_days"] == 115
    assert two["overdue_ratio"] == 1.0 and two["weekend_purchase_ratio"] == 1.0
    everything = {r["customer_id"]: r for r in features.mart_features(lines, gap_scope="all").collect()}
    assert everything["C1"]["avg_days_between_orders"] == pytest.approx((30 + 50400 / 86400) / 2)
    assert quality.feature_matrix_report(features.mart_features(lines))["passed"]


def test_as_of_hides_later_lines(lines):
    got = {r["customer_id"]: r for r in features.mart_features(lines, datetime(2024, 1, 15)).collect()}
    assert got["C1"]["frequency"] == 1 and got["C1"]["monetary"] == 50.0 and got["C1"]["recency_days"] == 14
    with pytest.raises(ValueError):
        features.mart_features(lines, datetime(2020, 1, 1))


def test_labels(lines):
    got = {r["customer_id"]: r["churn"] for r in features.churn_labels(lines, datetime(2024, 1, 15)).collect()}
    assert got == {"C1": 0, "C2": 1, "C3": 1}
    assert set(r["customer_id"] for r in features.feature_matrix(lines, "train").collect()) == {"C1", "C2"}


def test_hot_customer_features_equal_without_hot_one(make_lines):
    rows = [(f"h{i}", f"P{i % 5}", 1 + i % 3, 2.0, "H", "France", f"2024-0{1 + i % 6}-{1 + i % 27:02d} 10:00:00") for i in range(300)]
    rows += [("z1", "P1", 3, 4.0, "Z", "Spain", "2024-03-03 12:00:00")]
    got = {r["customer_id"]: r for r in features.mart_features(make_lines(*rows)).collect()}
    assert got["H"]["frequency"] == 300 and got["Z"]["frequency"] == 1 and got["H"]["unique_products"] == 5


def test_feature_schema_faults(lines):
    good = features.mart_features(lines)
    assert quality.feature_schema_issues(good) == []
    assert any("missing" in i for i in quality.feature_schema_issues(good.drop("monetary")))
    assert any("unexpected" in i for i in quality.feature_schema_issues(good.withColumn("x", F.lit(1))))
    assert any("order" in i for i in quality.feature_schema_issues(good.select("customer_id", *schemas.FEATURE_COLUMNS[::-1])))
    assert any("NULL" in i for i in quality.feature_schema_issues(good.withColumn("monetary", F.lit(None).cast("double"))))
    assert any("not a number" in i for i in quality.feature_schema_issues(good.withColumn("monetary", F.lit("x"))))
    assert not quality.feature_matrix_report(good.withColumn("cancellation_rate", F.lit(3.0)))["passed"]


@pytest.fixture(scope="module")
def base(spark):
    rows = [("1", 0.1, "Champions", 5000.0), ("2", 0.35, "At Risk", 800.0), ("3", 0.55, "Loyal Customers", 1200.0),
            ("4", 0.75, "At Risk", 600.0), ("5", 0.9, "Lost", 50.0)]
    df = spark.createDataFrame(rows, "customer_id string, churn_probability double, segment string, monetary double")
    return df.withColumns({"recency_days": F.lit(5), "frequency": F.lit(2).cast("bigint")})


def test_flags_and_tiers(base):
    got = scoring.score(base, 0.31).orderBy("customer_id").collect()
    assert [r["churn_flag"] for r in got] == [0, 1, 1, 1, 1]
    assert [r["risk_tier"] for r in got] == ["Low", "Low", "Medium", "High", "High"]


def test_retention_list_and_round_trip(base, spark, tmp_path):
    assert [r["customer_id"] for r in analytics.retention_list(base, 0.31).collect()] == ["5", "4"]
    chosen = analytics.retention_list(base, 0.31, ["High", "Low"], ["At Risk"], 700.0)
    assert [r["customer_id"] for r in chosen.collect()] == ["2"]
    report = export.retention_acceptance(base, str(tmp_path / "list"), 0.31)
    assert report["passed"] and report["metrics"] == {"retention_list_size": 2.0, "revenue_at_stake": 650.0}
    back = export.read_retention_list(spark, str(tmp_path / "list"))
    assert back.columns == schemas.RETENTION_COLUMNS and back.count() == 2
    assert not export.retention_acceptance(base.drop("monetary"), str(tmp_path / "x"), 0.31)["passed"]
    with pytest.raises(ValueError):
        export.export_retention_list(base.drop("segment"), str(tmp_path / "y"))


def test_scoring_acceptance(base, spark):
    scores = scoring.score(base, 0.31)
    labels = spark.createDataFrame([(str(i), y) for i, y in ((1, 0), (2, 1), (3, 1), (4, 1), (5, 0))], "customer_id string, churn int")
    good = scoring.scoring_acceptance(scores, 0.31, labels, expected_rows=5, min_accuracy=0.8)
    assert good["passed"] and good["metrics"]["accuracy"] == 0.8 and good["metrics"]["true_positives"] == 3
    assert not scoring.scoring_acceptance(scores, 0.31, labels, min_accuracy=0.95)["passed"]
    assert not scoring.scoring_acceptance(scores, 0.31, expected_rows=6)["passed"]
    assert not scoring.scoring_acceptance(scores, 0.31, labels.filter("customer_id <> '1'"))["passed"]
    assert not scoring.scoring_acceptance(scores.unionByName(scores), 0.31)["passed"]
    assert not scoring.scoring_acceptance(scores.withColumn("churn_probability", F.lit(1.2)), 0.31)["passed"]
    assert scoring.scoring_acceptance(scores.drop("risk_tier"), 0.31)["issues"] == ["missing column risk_tier: 1"]


def test_retention_order_is_checked(base):
    chosen = analytics.scored(base, 0.31).withColumn("position", F.col("customer_id").cast("bigint"))
    found = {r["rule"]: r["rows"] for r in scoring.retention_issues(chosen, base.limit(4), "position").collect()}
    assert found["not sorted by probability"] == 4 and found["customer not in source"] == 1


def test_gate():
    assert scoring.enforce_gate(0.8) and not scoring.enforce_gate(0.7, enforce=False)
    with pytest.raises(scoring.GateFailed):
        scoring.enforce_gate(0.7)


def test_search_candidates_are_different_and_repeatable():
    first = churn.search_candidates(50)
    assert len({tuple(sorted(c.items())) for c in first}) == 50 and first == churn.search_candidates(50)
    assert all(set(c) == set(churn.SEARCH_SPACE) for c in first)


def test_model_choice(spark):
    schema = "model string, simplicity int, auc_roc double, f1_churn double"
    rows = [("Logistic Regression", 0, 0.812, 0.70), ("Random Forest", 1, 0.818, 0.75), ("Boosted Trees", 2, 0.82, 0.75)]
    assert churn.select_model(spark.createDataFrame(rows, schema)).first()["model"] == "Random Forest"
    low = [("Logistic Regression", 0, 0.70, 0.9), ("Random Forest", 1, 0.75, 0.2)]
    assert churn.select_model(spark.createDataFrame(low, schema)).first()["model"] == "Random Forest"


def test_monitoring(base, spark, scratch, tmp_path):
    scores = scoring.score(base, 0.31)
    baseline = scoring.score_baseline(base)
    moved = {r["metric_name"]: r["metric_value"] for r in monitoring.model_drift_metrics(scores, baseline, scratch).collect()}
    assert moved["score_distribution_z"] == 0 and moved["n_high_risk"] == 2 and moved["score_p50"] == 0.55
    same = monitoring.population_stability(base, base, scratch).first()
    assert same["psi"] == 0 and not same["alert"]
    far = monitoring.population_stability(base, base.withColumn("churn_probability", F.lit(0.99)), scratch).first()
    assert far["alert"]
    path = str(tmp_path / "history")
    for day, mean in ((date(2026, 1, 1), 0.1), (date(2026, 1, 2), 0.2)):
        drift = spark.createDataFrame([("n_features_drifted", 0.0)], "metric_name string, metric_value double")
        model = spark.createDataFrame([("score_mean", mean)], "metric_name string, metric_value double")
        monitoring.append_metrics(monitoring.run_metrics(day, str(day), drift, model), path)
    history = spark.read.parquet(path)
    assert history.count() == 4 and monitoring.latest_run(history).count() == 2
    newest = {r["metric_name"]: r["metric_value"] for r in monitoring.latest_value(history).collect()}
    assert newest["score_mean"] == 0.2
    stored = str(tmp_path / "baseline")
    assert monitoring.refresh_baseline(spark, baseline, stored, stable=False)
    assert not monitoring.refresh_baseline(spark, baseline, stored, stable=False)
    assert monitoring.refresh_baseline(spark, baseline, stored, stable=True)


def test_feature_drift_ignores_constant_baseline(lines):
    now = features.mart_features(lines)
    flat = scoring.feature_baseline(now).withColumn("std", F.lit(0.0))
    assert monitoring.feature_drift(now, flat).filter("z <> 0 OR drifted").count() == 0


def test_quality_counts(spark):
    df = spark.createDataFrame([("1",), ("",), (None,), ("4",)], "customer_id string")
    row = quality.completeness(df).first()
    assert row["null_count"] == 1 and row["empty_string_rate"] == 0.5


def test_bi_export_skips_missing(spark, tmp_path):
    gold = str(tmp_path / "gold")
    export.publish(spark.range(3), f"{gold}/dim_date")
    export.publish(spark.range(2), f"{gold}/mart_features")
    got = {r["table_name"]: (r["status"], r["rows"]) for r in export.export_for_bi(spark, gold, str(tmp_path / "csv"), "csv").collect()}
    assert got["dim_date"] == ("exported", 3) and got["mart_features"][0] == "excluded" and got["mart_rfm"][0] == "missing"
    parquet = {r["table_name"]: r["rows"] for r in export.export_for_bi(spark, gold, str(tmp_path / "pq")).collect()}
    assert parquet["mart_features"] == 2


def test_features_of_many_dates_equal_one_by_one(lines):
    dates = [datetime(2024, 1, 15), datetime(2024, 2, 20), datetime(2030, 1, 1), datetime(1990, 1, 1)]
    many = features.features_at(lines, dates)
    for day in dates[:3]:
        one = {r["customer_id"]: r for r in features.mart_features(lines, day).collect()}
        got = {r["customer_id"]: r for r in many.filter(F.col("as_of") == F.lit(day)).drop("as_of").collect()}
        assert one and got == one
    assert many.select("as_of").distinct().count() == 3


def test_runs_over_time_equal_single_runs(lines, spark, scratch):
    dates = [datetime(2024, 1, 15), datetime(2024, 2, 20), datetime(2030, 1, 1)]
    rows = features.features_at(lines, dates).withColumn("churn_probability", F.col("recency_days") / (F.col("recency_days") + 30.0))
    rows = scratch.write(rows.withColumn("risk_tier", F.when(F.col("churn_probability") > 0.7, "High").otherwise("Low")))
    base = rows.filter(F.col("as_of") == F.lit(dates[0]))
    means, spread = scoring.feature_baseline(base), scoring.score_baseline(base)
    runs = monitoring.runs_over_time(rows, means, spread, scratch)
    for day in dates:
        one = rows.filter(F.col("as_of") == F.lit(day)).drop("as_of")
        expected = monitoring.run_metrics(day.date(), f"run-{day.date()}", monitoring.data_drift_metrics(monitoring.feature_drift(one, means)),
                                          monitoring.model_drift_metrics(one, spread, scratch))
        key = lambda r: (r["category"], r["metric_name"])
        assert sorted(runs.filter(F.col("run_date") == F.lit(day.date())).collect(), key=key) == sorted(expected.collect(), key=key)
    assert monitoring.run_dates(lines, 3, 10)[-1] == lines.agg(F.max("invoice_date")).first()[0]


def test_features_at_several_dates_group_by_hashing(make_lines, scratch):
    """Every date's table is the one made for it alone, and nothing is sorted to be grouped."""
    lines = scratch.write(make_lines(
        ("1", "P1", 10, 5.0, "C1", "United Kingdom", "2024-01-01 10:00:00"),
        ("1", "P3", 1, 4.0, "C1", "Zealand", "2024-01-02 10:00:00"),
        ("2", "P2", 2, 12.0, "C1", "United Kingdom", "2024-02-20 23:59:59"),
        ("C3", "P1", -1, 5.0, "C1", "United Kingdom", "2024-03-01 00:00:00"),
        ("4", "P1", 4, 2.5, "C2", "United Kingdom", "2024-01-06 09:00:00"),
        ("5", "P1", 4, 2.5, "C2", "France", "2024-02-06 09:00:00"),
        ("6", "P1", 4, 2.5, "C2", None, "2024-05-06 09:00:00"),
        ("7", "P9", 3, 2.0, "C4", None, "2024-04-08 09:00:00"),
        ("8", "P1", 7, 1.0, "", "France", "2024-04-30 09:00:00")))
    dates = [datetime(2024, 1, 15), datetime(2024, 3, 15), datetime(2024, 6, 1)]
    rollup = scratch.write(marts.invoice_rollup(lines))
    got = features.features_at(lines, dates, rollup=rollup)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan
    rows = {(r["as_of"], r["customer_id"]): r.asDict() for r in got.collect()}
    want = {(d, r["customer_id"]): {"as_of": d, **r.asDict()} for d in dates for r in features.mart_features(lines, d).collect()}
    assert rows == want and len(rows) == 7
    assert [rows[d, "C2"]["is_uk"] for d in dates] == [1, 0, 0] and rows[dates[2], "C1"]["is_uk"] == 1 and rows[dates[2], "C4"]["is_uk"] == 0
    assert [rows[d, "C1"]["unique_products"] for d in dates] == [2, 3, 3]
