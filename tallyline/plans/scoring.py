"""Measures of a score column against labels, score summaries, and acceptance checks of scoring outputs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyline import schemas
from tallyline.functions import exprs as X
from tallyline.operators import checks as C
from tallyline.operators.ordering import global_running_sum
from tallyline.operators.quantiles import exact_quantiles, long_values
from tallyline.operators.skew import broadcast_if_small
from tallyline.sources.lake import Scratch


def _n() -> Column:
    return F.count(F.lit(1))


def score(customers: DataFrame, threshold: float) -> DataFrame:
    """The published scoring table from stored probabilities."""
    return customers.select("customer_id", "churn_probability", X.churn_flag("churn_probability", threshold).alias(
        "churn_flag"), X.risk_tier("churn_probability").alias("risk_tier"))


def confusion(df: DataFrame, label: str = "churn", flag: str = "churn_flag") -> DataFrame:
    y, p = F.col(label) == 1, F.col(flag) == 1
    counts = df.agg(X.count_if(y & p).alias("true_positives"), X.count_if(~y & p).alias("false_positives"),
                    X.count_if(~y & ~p).alias("true_negatives"), X.count_if(y & ~p).alias("false_negatives"))
    tp, fp, fn = (F.col(f"{c}_{d}") for c, d in (("true", "positives"), ("false", "positives"), ("false", "negatives")))
    total = tp + fp + fn + F.col("true_negatives")
    return counts.select(
        "*", X.safe_divide(tp + F.col("true_negatives"), total).alias("accuracy"),
        X.safe_divide(tp, tp + fp).alias("precision_churn"), X.safe_divide(tp, tp + fn).alias("recall_churn"),
        X.safe_divide(2 * tp, 2 * tp + fp + fn).alias("f1_churn"))


def _ranked_scores(df: DataFrame, label: str, score_column: str, scratch: Scratch, groups: list[str],
                   descending: bool) -> DataFrame:
    """Per distinct score: positives, negatives and their running counts inside the group."""
    y = F.col(label) == 1
    per = df.groupBy(*groups, score_column).agg(X.count_if(y).alias("pos"), X.count_if(~y).alias("neg"))
    order = [*groups, F.desc(score_column) if descending else F.asc(score_column)]
    run = global_running_sum(per, order, {"run_pos": "pos", "run_neg": "neg"}, scratch)
    totals = run.groupBy(*groups).agg(F.sum("pos").alias("all_pos"), F.sum("neg").alias("all_neg"),
                                      F.min(F.col("run_pos") - F.col("pos")).alias("pos_before"),
                                      F.min(F.col("run_neg") - F.col("neg")).alias("neg_before"))
    joined = run.join(broadcast_if_small(totals), groups) if groups else run.crossJoin(F.broadcast(totals))
    return joined.withColumns({"run_pos": F.col("run_pos") - F.col("pos_before"),
                               "run_neg": F.col("run_neg") - F.col("neg_before")}).drop("pos_before", "neg_before")


def area_under_roc(df: DataFrame, scratch: Scratch, label: str = "churn", score_column: str = "churn_probability",
                   groups: list[str] | None = None) -> DataFrame:
    """Rank-sum AUC with tied scores counted half, per group if groups are given. Scores are grouped before ranking."""
    groups = groups or []
    ranked = _ranked_scores(df, label, score_column, scratch, groups, descending=False)
    beaten = F.col("pos").cast("decimal(19,0)") * (2 * (F.col("run_neg") - F.col("neg")) + F.col("neg")).cast("decimal(18,0)")
    return ranked.groupBy(*groups).agg(F.sum(beaten).alias("twice"), F.max("all_pos").alias("p"), F.max("all_neg").alias("q")).select(
        *groups, X.ratio("twice", 2.0 * F.col("p") * F.col("q")).alias("auc_roc"))


def evaluate(df: DataFrame, scratch: Scratch) -> DataFrame:
    return confusion(df).crossJoin(F.broadcast(area_under_roc(df, scratch)))


def roc_points(df: DataFrame, scratch: Scratch, label: str = "churn", score_column: str = "churn_probability") -> DataFrame:
    """(threshold, false positive rate, true positive rate) per distinct score."""
    ranked = _ranked_scores(df, label, score_column, scratch, [], descending=True)
    return ranked.select(F.col(score_column).alias("threshold"), X.safe_divide("run_neg", "all_neg").alias("fpr"),
                         X.safe_divide("run_pos", "all_pos").alias("tpr"))


def precision_recall(df: DataFrame, scratch: Scratch, label: str = "churn",
                     score_column: str = "churn_probability") -> DataFrame:
    """(threshold, precision, recall, F1) per distinct score when every score at or above it is flagged."""
    ranked = _ranked_scores(df, label, score_column, scratch, [], descending=True)
    flagged = F.col("run_pos") + F.col("run_neg")
    return ranked.select(
        F.col(score_column).alias("threshold"), X.safe_divide("run_pos", flagged).alias("precision"),
        X.safe_divide("run_pos", "all_pos").alias("recall"),
        X.safe_divide(2 * F.col("run_pos"), flagged + F.col("all_pos")).alias("f1"))


def best_threshold(df: DataFrame, scratch: Scratch, **columns) -> DataFrame:
    """The F1-optimal threshold, the lowest one among equals; 0.5 if there is nothing to choose from."""
    curve = precision_recall(df, scratch, **columns)
    best = F.max_by(F.struct("threshold", "precision", "recall", "f1"), F.struct("f1", -F.col("threshold")))
    return curve.agg(best.alias("b")).select(
        F.coalesce("b.threshold", F.lit(0.5)).alias("threshold"), F.coalesce("b.precision", F.lit(0.0)).alias("precision_churn"),
        F.coalesce("b.recall", F.lit(0.0)).alias("recall_churn"), F.coalesce("b.f1", F.lit(0.0)).alias("f1_churn"))


def quality_gate(metrics: DataFrame, gate: float = 0.80) -> DataFrame:
    return metrics.select(F.lit("auc_roc").alias("metric"), F.col("auc_roc").alias("value"), F.lit(gate).alias("gate"),
                          (F.col("auc_roc") >= gate).alias("passed"))


class GateFailed(RuntimeError):
    """The model does not reach the required AUC and must not be published."""


def enforce_gate(auc: float, gate: float = 0.80, enforce: bool = True) -> bool:
    if auc >= gate:
        return True
    if enforce:
        raise GateFailed(f"AUC {auc:.4f} is below {gate:.2f}")
    return False


# ---- summaries and baselines -------------------------------------------------------------------------------

def score_summary(df: DataFrame, threshold: float, scratch: Scratch, column: str = "churn_probability") -> DataFrame:
    p = F.col(column)
    one = df.agg(F.min(p).alias("min"), F.max(p).alias("max"), F.avg(p).alias("mean"),
                 X.ratio(X.count_if(p >= X.HIGH_RISK), _n()).alias("pct_high_risk"),
                 X.ratio(X.count_if(p >= threshold), _n()).alias("pct_churn_flag"))
    middle = exact_quantiles(df, [], column, {"p25": 0.25, "median": 0.5, "p75": 0.75}, scratch).drop("n")
    return one.crossJoin(F.broadcast(middle)).select("min", "p25", "median", "p75", "max", "mean", "pct_high_risk", "pct_churn_flag")


def feature_baseline(features: DataFrame, columns: list[str] | None = None, groups: Sequence[str] = ()) -> DataFrame:
    """(groups, feature, mean, std) in one pass; sample standard deviation."""
    columns = columns or schemas.FEATURE_COLUMNS
    wide = features.groupBy(*groups).agg(*[agg for c in columns for agg in (
        F.avg(c).alias(f"{c}|mean"), F.stddev_samp(c).alias(f"{c}|std"))])
    rows = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"`{c}|mean`").alias("mean"), F.col(f"`{c}|std`").alias("std"))
                     for c in columns])
    return wide.select(*groups, F.inline(rows))


def score_baseline(df: DataFrame, column: str = "churn_probability") -> DataFrame:
    """Mean and population standard deviation of the training scores."""
    return df.agg(F.avg(column).alias("mean"), F.stddev_pop(column).alias("std")).select(
        F.lit("score").alias("feature"), "mean", "std")


def medians_and_bounds(features: DataFrame, columns: list[str], scratch: Scratch) -> DataFrame:
    """(feature, median, p01, p99): the base row and lever limits of what-if scenarios."""
    return exact_quantiles(long_values(features, columns), ["feature"], "value",
                           {"median": 0.5, "p01": 0.01, "p99": 0.99}, scratch).drop("n")


# ---- acceptance --------------------------------------------------------------------------------------------

def scoring_issues(df: DataFrame, threshold: float, expected_rows: int | None = None) -> DataFrame:
    """(rule, rows) over the scoring table; a missing column is reported alone."""
    missing = [c for c in schemas.SCORING_COLUMNS if c not in df.columns]
    if missing:
        return df.sparkSession.createDataFrame([(f"missing column {c}", 1) for c in missing], "rule string, rows bigint")
    p, flag, tier = F.col("churn_probability"), F.col("churn_flag"), F.col("risk_tier")
    rules = {
        "customer_id is NULL": F.col("customer_id").isNull(),
        "churn_probability is NULL": p.isNull(),
        "churn_probability outside 0..1": (p < 0) | (p > 1),
        "churn_flag not 0 or 1": ~flag.isin(0, 1),
        "churn_flag against threshold": flag != X.churn_flag("churn_probability", threshold),
        "risk_tier unknown": ~tier.isin(X.RISK_TIERS),
        "risk_tier against probability": tier != X.risk_tier("churn_probability"),
    }
    counts = _count_rules(df, rules)
    repeats = C.unique(df, "customer_id").agg(F.coalesce(F.sum(F.col("rows") - 1), F.lit(0)).cast("bigint").alias("rows")).select(
        F.lit("customer_id repeated").alias("rule"), "rows")
    out = counts.unionByName(repeats)
    if expected_rows is not None:
        out = out.unionByName(df.agg(F.abs(_n() - expected_rows).cast("bigint").alias("rows")).select(
            F.lit("row count differs").alias("rule"), "rows"))
    return out


def _count_rules(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    wide = df.agg(*[X.count_if(bad).alias(f"r{i}") for i, bad in enumerate(rules.values())])
    return wide.select(F.inline(F.array(*[F.struct(F.lit(name).alias("rule"), F.col(f"r{i}").alias("rows"))
                                          for i, name in enumerate(rules)])))


def retention_issues(df: DataFrame, source: DataFrame | None = None, position: str | None = None) -> DataFrame:
    """(rule, rows) over a retention list. With ``position`` (1..n as presented) the descending order is checked too."""
    missing = [c for c in schemas.RETENTION_COLUMNS if c not in df.columns]
    if missing:
        return df.sparkSession.createDataFrame([(f"missing column {c}", 1) for c in missing], "rule string, rows bigint")
    p = F.col("churn_probability")
    out = _count_rules(df, {"customer_id is NULL": F.col("customer_id").isNull(),
                            "churn_probability outside 0..1": (p < 0) | (p > 1),
                            "risk_tier unknown": ~F.col("risk_tier").isin(X.RISK_TIERS)})
    repeats = C.unique(df, "customer_id").agg(F.count(F.lit(1)).alias("rows"))
    out = out.unionByName(repeats.select(F.lit("customer_id repeated").alias("rule"), "rows"))
    if source is not None:
        extra = df.join(source.select("customer_id"), "customer_id", "left_anti").agg(_n().alias("rows"))
        out = out.unionByName(extra.select(F.lit("customer not in source").alias("rule"), "rows"))
    if position is not None:
        # Neighbours meet through an equi-join on the position, so a long list is not moved to one task.
        after = df.select((F.col(position) - 1).alias(position), p.alias("_next"))
        rising = df.join(after, position).agg(X.count_if(F.col("_next") > p).alias("rows"))
        out = out.unionByName(rising.select(F.lit("not sorted by probability").alias("rule"), "rows"))
    return out


def aligned_with_labels(scores: DataFrame, labels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(scores with their label, one row saying how many scores have none)."""
    joined = scores.join(labels, "customer_id")
    lost = scores.join(labels, "customer_id", "left_anti").agg(_n().alias("dropped"))
    return joined, lost


def scoring_acceptance(scores: DataFrame, threshold: float, labels: DataFrame | None = None,
                       expected_rows: int | None = None, min_accuracy: float | None = None) -> dict:
    issues = [f"{r['rule']}: {r['rows']}" for r in
              scoring_issues(scores, threshold, expected_rows).filter("rows > 0").orderBy("rule").collect()]
    metrics: dict[str, float] = {}
    if labels is not None and not any(i.startswith("missing") for i in issues):
        joined, lost = aligned_with_labels(scores, labels)
        dropped = lost.first()["dropped"]
        if dropped:
            issues.append(f"label join drops {dropped} scores")
        metrics = confusion(joined).first().asDict()
        if min_accuracy is not None and metrics["accuracy"] < min_accuracy:
            issues.append(f"accuracy {metrics['accuracy']:.4f} below {min_accuracy:.4f}")
    return {"issues": issues, "metrics": metrics, "passed": not issues}


def top_by(df: DataFrame, column: str, n: int) -> DataFrame:
    return df.orderBy(F.desc(column), *[c for c in df.columns if c != column][:1]).limit(n)


def first_rows(df: DataFrame, group: str, order: list[Column], n: int) -> DataFrame:
    """The n best rows per group; the limit is applied before the shuffle as well."""
    rank = F.row_number().over(Window.partitionBy(group).orderBy(*order))
    return df.withColumn("rank", rank).filter(F.col("rank") <= n)
