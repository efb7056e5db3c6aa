"""Drift of features and scores against the training baseline, and the long metric history."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.functions import exprs as X
from tallyline.operators import checks as C
from tallyline.operators.quantiles import exact_quantiles
from tallyline.plans.scoring import feature_baseline
from tallyline.schemas import FEATURE_COLUMNS, MONITORING, conform
from tallyline.sources.lake import Scratch, path_exists

DRIFT_Z, SCORE_Z, PSI_ALERT = 3.0, 2.0, 0.20


def _n() -> Column:
    return F.count(F.lit(1))


def feature_drift(features: DataFrame, baseline: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    """(groups, feature, current_mean, z, drifted): distance of the current mean from the baseline in baseline deviations."""
    columns = [c for c in FEATURE_COLUMNS if c in features.columns]
    current = feature_baseline(features, columns, groups).select(*groups, "feature", F.col("mean").alias("current_mean"))
    joined = current.join(F.broadcast(baseline.select("feature", F.col("mean").alias("b_mean"), F.col("std").alias("b_std"))),
                          "feature")
    z = F.when(F.col("b_std") > 0, F.abs(F.col("current_mean") - F.col("b_mean")) / F.col("b_std")).otherwise(F.lit(0.0))
    return joined.select(*groups, "feature", X.round_to("current_mean", 4).alias("current_mean"), X.round_to(z, 4).alias("z"),
                         (z > DRIFT_Z).alias("drifted"))


def data_drift_metrics(drift: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    """(groups, metric_name, metric_value) rows: per feature z and mean, and the totals."""
    per = drift.select(*groups, F.inline(F.array(
        F.struct(F.concat(F.lit("drift_z_"), "feature").alias("metric_name"), F.col("z").alias("metric_value")),
        F.struct(F.concat(F.lit("current_mean_"), "feature").alias("metric_name"), F.col("current_mean").alias("metric_value")))))
    one = drift.groupBy(*groups).agg(_n().cast("double").alias("n_features_checked"),
                                     X.count_if(F.col("drifted")).cast("double").alias("n_features_drifted"))
    one = one.withColumn("drift_rate", X.round_to(X.safe_divide("n_features_drifted", "n_features_checked"), 4))
    totals = one.unpivot(list(groups), [c for c in one.columns if c not in groups], "metric_name", "metric_value")
    return per.unionByName(totals)


def model_drift_metrics(scores: DataFrame, baseline: DataFrame | None, scratch: Scratch, groups: Sequence[str] = ()) -> DataFrame:
    """(groups, metric_name, metric_value) rows of the score distribution. ``baseline`` has the row feature='score'."""
    p = F.col("churn_probability")
    groups = list(groups)
    quantiles = exact_quantiles(scores, groups, "churn_probability",
                                {"score_p25": 0.25, "score_p50": 0.5, "score_p75": 0.75, "score_p90": 0.9}, scratch).drop("n")
    quantiles = quantiles.select(*groups, *[X.round_to(c, 4).alias(c) for c in quantiles.columns if c not in groups])
    one = scores.groupBy(*groups).agg(
        X.round_to(F.avg(p), 4).alias("score_mean"), X.round_to(F.stddev_samp(p), 4).alias("score_std"),
        *[X.count_if(F.col("risk_tier") == t).cast("double").alias(f"n_{t.lower()}_risk") for t in X.RISK_TIERS],
        X.round_to(X.ratio(X.count_if(F.col("risk_tier") == "High"), _n()), 4).alias("pct_high_risk"),
        _n().cast("double").alias("total_customers_scored"))
    one = one.join(F.broadcast(quantiles), groups) if groups else one.crossJoin(F.broadcast(quantiles))
    if baseline is not None:
        base = baseline.filter("feature = 'score'").select(F.col("mean").alias("_m"), F.col("std").alias("_s"))
        z = F.when(F.col("_s") > 0, F.abs(F.col("score_mean") - F.col("_m")) / F.col("_s")).otherwise(F.lit(0.0))
        one = one.crossJoin(F.broadcast(base)).withColumn("score_distribution_z", X.round_to(z, 4)).drop("_m", "_s")
    return one.unpivot(groups, [c for c in one.columns if c not in groups], "metric_name", "metric_value")


def run_dates(lines: DataFrame, runs: int = 3, apart: int = 30) -> list[datetime]:
    """The ends of the newest monitoring windows, ``apart`` days from each other, the newest line last."""
    newest = lines.agg(F.max("invoice_date")).first()[0]
    return [newest - timedelta(days=apart * k) for k in range(runs)][::-1]


def runs_over_time(scores: DataFrame, features_base: DataFrame, scores_base: DataFrame, scratch: Scratch) -> DataFrame:
    """The metric history of the runs in ``scores``: one run for each ``as_of``, all of them in the same jobs.

    ``scores`` has as_of, the features, churn_probability and risk_tier of every customer known at that time; the baselines
    have feature, mean and std. A run's date is the day of its ``as_of``, its id is made from it.
    """
    drift = data_drift_metrics(feature_drift(scores, features_base, ["as_of"]), ["as_of"]).withColumn("category", F.lit("data_drift"))
    moved = model_drift_metrics(scores, scores_base, scratch, ["as_of"]).withColumn("category", F.lit("model_drift"))
    day = F.to_date("as_of")
    return conform(drift.unionByName(moved).withColumns({"run_date": day, "run_id": F.concat(F.lit("run-"), day.cast("string"))}).drop("as_of"), MONITORING)


def score_deciles(scores: DataFrame, scratch: Scratch) -> DataFrame:
    """The nine inner decile bounds of a score column, as one row d1..d9."""
    return exact_quantiles(scores, [], "churn_probability", {f"d{i}": i / 10 for i in range(1, 10)}, scratch).drop("n")


def population_stability(baseline: DataFrame, current: DataFrame, scratch: Scratch, floor: float = 1e-4) -> DataFrame:
    """(psi, alert) between two score columns, over the baseline's deciles."""
    bounds = F.broadcast(score_deciles(baseline, scratch))

    def shares(df: DataFrame, name: str) -> DataFrame:
        place = F.lit(0)
        for i in range(1, 10):
            place = place + X.as_int(F.col("churn_probability") > F.col(f"d{i}"))
        counts = df.crossJoin(bounds).groupBy(place.alias("bucket")).agg(_n().alias("rows"))
        total = df.agg(_n().alias("all_rows"))
        return counts.crossJoin(F.broadcast(total)).select("bucket", X.ratio("rows", "all_rows").alias(name))

    both = shares(baseline, "a").join(shares(current, "b"), "bucket", "full_outer").select(
        F.greatest(F.coalesce("a", F.lit(0.0)), F.lit(floor)).alias("a"),
        F.greatest(F.coalesce("b", F.lit(0.0)), F.lit(floor)).alias("b"))
    psi = F.sum((F.col("b") - F.col("a")) * F.ln(F.col("b") / F.col("a")))
    return both.agg(X.round_to(psi, 6).alias("psi")).withColumn("alert", F.col("psi") > PSI_ALERT)


def run_metrics(run_date: date, run_id: str, data_drift: DataFrame, model_drift: DataFrame) -> DataFrame:
    """One monitoring run in the history's schema."""
    both = data_drift.withColumn("category", F.lit("data_drift")).unionByName(
        model_drift.withColumn("category", F.lit("model_drift")))
    return conform(both.withColumns({"run_date": F.lit(run_date), "run_id": F.lit(run_id)}), MONITORING)


def append_metrics(metrics: DataFrame, path: str) -> None:
    """Append only: earlier runs are neither read nor rewritten."""
    metrics.coalesce(1).write.mode("append").parquet(path)


def latest_run(history: DataFrame) -> DataFrame:
    """All metrics of the newest run (newest date, then newest run id)."""
    newest = history.agg(F.max(F.struct("run_date", "run_id")).alias("newest"))
    return history.join(F.broadcast(newest), F.struct("run_date", "run_id") == F.col("newest"), "left_semi")


def latest_value(history: DataFrame) -> DataFrame:
    """(category, metric_name, metric_value): the newest value of each metric, whenever it was logged."""
    return history.groupBy("category", "metric_name").agg(
        F.max_by("metric_value", F.struct("run_date", "run_id")).alias("metric_value"))


def sorted_log(history: DataFrame) -> DataFrame:
    return history.orderBy(F.desc("run_date"), "category", "metric_name", "run_id")


def is_stable(data_drift: DataFrame, model_drift: DataFrame) -> bool:
    """No feature drifted and the score mean is within its bound."""
    drifted = data_drift.filter("metric_name = 'n_features_drifted' AND metric_value > 0").limit(1).count()
    moved = model_drift.filter((F.col("metric_name") == "score_distribution_z") & (F.col("metric_value") > SCORE_Z)).limit(1).count()
    return not drifted and not moved


def refresh_baseline(spark: SparkSession, baseline: DataFrame, path: str, stable: bool) -> bool:
    """Replace the stored baseline after a stable run, or write the first one."""
    if stable or not path_exists(spark, path):
        baseline.coalesce(1).write.mode("overwrite").parquet(path)
        return True
    return False


def long_metrics(one_row: DataFrame, category: str) -> DataFrame:
    return C.as_metrics(one_row, category)
