"""Acceptance reports and publishing steps as rows: what is wrong, what was measured, what was written."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from tallyline import schemas
from tallyline.plans import clustering as K
from tallyline.plans import export as E
from tallyline.plans import features as P
from tallyline.plans import monitoring as D
from tallyline.plans import quality as Q
from tallyline.plans import scoring as S
from tallyline.plans import silver
from tallyline.queries.analytics import THRESHOLD, customers
from tallyline.queries.base import query, s_count, s_units
from tallyline.queries.operators import BUSINESS_SQL, _fresh, n
from tallyline.queries.quality import _FEATURE_RULES, _SHIFTED, _rule_condition
from tallyline.queries.scoring import _CONFUSION, assigned
from tallyline.sources import lake as L


def issue_rows(r, issues):
    return r.spark.createDataFrame([(i,) for i in issues], "issue string")


@query("q23_feature_schema_issues", f"""SELECT 'missing features: monetary' AS issue UNION ALL SELECT 'unexpected features: extra'
    UNION ALL SELECT 'features are not in model order'
    UNION ALL SELECT 'frequency has ' || CAST({s_count("is_one_time_buyer = 1 OR frequency = 7")} AS VARCHAR) || ' NULLs' FROM fx""")
def feature_schema_issues(r):
    """A matrix with a missing, an additional and a NULL-holding column."""
    bad = r.mart_features.drop("monetary").withColumns({
        "extra": F.lit(1), "frequency": F.when((F.col("is_one_time_buyer") == 1) | (F.col("frequency") == 7), None).otherwise(
            F.col("frequency"))})
    return issue_rows(r, Q.feature_schema_issues(bad))


query("q25_feature_matrix_report", f"WITH shifted AS ({_SHIFTED}) SELECT issue FROM (" + " UNION ALL ".join(
    f"SELECT '{rule} on ' || CAST({s_count(_rule_condition(rule))} AS VARCHAR) || ' rows' AS issue, {s_count(_rule_condition(rule))} AS bad FROM shifted"
    for rule in _FEATURE_RULES) + ") t WHERE bad > 0")(
    lambda r: issue_rows(r, Q.feature_matrix_report(r.mart_features.withColumns({
        "recency_days": F.col("recency_days") - 30, "cancellation_rate": F.col("cancellation_rate") * 3}))["issues"]))

_MEASURES = ["accuracy", "precision_churn", "recall_churn", "f1_churn", "true_positives", "false_positives", "true_negatives",
             "false_negatives"]


@query("q28_scoring_acceptance", " UNION ALL ".join(
    f"SELECT '{m}' AS metric, CAST({m} AS DOUBLE) AS value FROM ({_CONFUSION}) t" for m in _MEASURES))
def scoring_acceptance(r):
    scores = S.score(r.scores, THRESHOLD)
    labels = P.churn_labels(r.lines, P.training_cutoff(r.lines))
    report = S.scoring_acceptance(scores.join(labels.select("customer_id"), "customer_id", "left_semi"), THRESHOLD, labels)
    if report["issues"]:
        raise AssertionError(report["issues"])
    return r.spark.createDataFrame([(m, float(report["metrics"][m])) for m in _MEASURES], "metric string, value double")


@query("q29_retention_acceptance", f"""SELECT 'retention_list_size' AS metric, CAST({s_count()} AS DOUBLE) AS value FROM scored
    WHERE risk_tier = 'High' AND monetary >= 1000 UNION ALL
    SELECT 'revenue_at_stake', {s_units("monetary")} FROM scored WHERE risk_tier = 'High' AND monetary >= 1000""")
def retention_acceptance(r):
    report = E.retention_acceptance(customers(r), _fresh(r, "retention_check"), THRESHOLD, min_monetary=1000.0)
    if report["issues"]:
        raise AssertionError(report["issues"])
    return r.spark.createDataFrame(list(report["metrics"].items()), "metric string, value double")


@query("k4_baseline_refresh", """SELECT 'score' AS feature, FLOOR(AVG(churn_probability) * 1e6 + 0.5e0) / 1e6 AS mean FROM scores""")
def baseline_refresh(r):
    """An unstable run leaves the stored baseline as it is."""
    path = _fresh(r, "baseline")
    D.refresh_baseline(r.spark, S.score_baseline(r.scores), path, stable=True)
    D.refresh_baseline(r.spark, S.score_baseline(r.scores.filter("frequency > 12")), path, stable=False)
    return r.spark.read.parquet(path).select("feature", (F.floor(F.col("mean") * 1e6 + 0.5) / 1e6).alias("mean"))


@query("s12_write_silver_months", f"SELECT {BUSINESS_SQL}, line_amount, year_month FROM silver WHERE year_month IN ('1998-01', '1998-02')")
def write_silver(r):
    path = _fresh(r, "silver_months")
    L.write_months(schemas.conform(r.silver.filter("year_month IN ('1998-01', '1998-02')"), schemas.SILVER), path)
    return silver.read_silver(r.spark, path).select(*schemas.BUSINESS_COLUMNS, "line_amount", "year_month")


@query("s21_publish_clusters", """SELECT customer_id, a.cluster_id, cluster_name FROM assigned a JOIN cluster_names n ON a.cluster_id = n.cluster_id""")
def publish_clusters(r):
    path = _fresh(r, "clusters")
    E.publish(K.assignments(assigned(r), K.name_clusters(K.profiles(assigned(r)))), path)
    return r.spark.read.parquet(path)


@query("s22_append_metrics", f"""SELECT CAST(d AS DATE) AS run_date, 'customers' AS metric_name, CAST({s_count()} AS DOUBLE) AS metric_value
    FROM scores, (VALUES ('2026-06-10'), ('2026-06-11')) AS v(d) GROUP BY d""")
def append_metrics(r):
    path = _fresh(r, "metrics")
    none = r.spark.createDataFrame([], "metric_name string, metric_value double")
    for day in (date(2026, 6, 10), date(2026, 6, 11)):
        one = r.scores.agg(n("value")).select(F.lit("customers").alias("metric_name"), F.col("value").cast("double").alias("metric_value"))
        D.append_metrics(D.run_metrics(day, str(day), none, one), path)
    return r.spark.read.parquet(path).select("run_date", "metric_name", "metric_value")
