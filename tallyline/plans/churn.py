"""Churn model: split, training, comparison, scoring, attribution, what-if scenarios."""

from __future__ import annotations

import random
from collections.abc import Sequence
from dataclasses import replace

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import Imputer, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.functions import exprs as X
from tallyline.operators.ordering import global_row_number
from tallyline.operators.quantiles import exact_quantiles, long_values
from tallyline.plans import boosting
from tallyline.plans import scoring as S
from tallyline.plans.boosting import BoostedModel
from tallyline.schemas import FEATURE_COLUMNS, SKEWED_FEATURES
from tallyline.sources.lake import Scratch

SEED = 42
LABEL, WEIGHT, FOLD, HOLD_OUT = "churn", "class_weight", "fold", "hold_out"

# The searched hyper-parameters of the boosted trees.
SEARCH_SPACE = {
    "max_depth": [3, 5, 7],
    "n_trees": [100, 200, 300],
    "learning_rate": [0.01, 0.05, 0.1],
    "min_gain": [0.0, 0.1, 0.5],
    "min_child_weight": [1, 3, 5],
    "row_share": [0.7, 0.8, 1.0],
    "column_share": [0.7, 0.8, 1.0],
}


def _bucket(salt: int, size: int, *more: str) -> Column:
    """A repeatable bucket of the customer: 28 digest bits, which every engine can compute, on any number of partitions."""
    text = F.concat_ws("|", F.col("customer_id").cast("string"), *[F.col(c).cast("string") for c in more], F.lit(str(salt)))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 7), 16, 10).cast("bigint") % size


def split(df: DataFrame, test_share: float = 0.20, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """(train, test) by a hash within each class, so both classes are cut in the same proportion."""
    is_test = _bucket(seed, 10_000, LABEL) < int(test_share * 10_000)
    return df.filter(~is_test), df.filter(is_test)


def class_weight(train: DataFrame) -> float:
    """Negatives per positive."""
    row = train.agg(X.count_if(F.col(LABEL) == 1).alias("pos"), X.count_if(F.col(LABEL) == 0).alias("neg")).first()
    return row["neg"] / row["pos"] if row["pos"] else 1.0


def weighted(train: DataFrame, folds: int = 5, seed: int = SEED) -> DataFrame:
    """Training rows with class weight, cross-validation fold and early-stopping flag."""
    positive = class_weight(train)
    return train.withColumns({
        WEIGHT: F.when(F.col(LABEL) == 1, F.lit(positive)).otherwise(F.lit(1.0)),
        FOLD: _bucket(seed + 1, folds).cast("int"),
        HOLD_OUT: _bucket(seed + 2, 5) == 0,
        "label": F.col(LABEL).cast("double"),
    })


def _numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


def imputed_vector(columns: Sequence[str] = FEATURE_COLUMNS) -> list:
    """Median imputation, then one vector."""
    filled = [f"{c}_filled" for c in columns]
    return [Imputer(strategy="median", inputCols=list(columns), outputCols=filled),
            VectorAssembler(inputCols=filled, outputCol="features")]


def search_candidates(n: int, seed: int = SEED, space: dict[str, list] | None = None) -> list[dict]:
    """n different random draws from the search space."""
    space = space or SEARCH_SPACE
    size = 1
    for values in space.values():
        size *= len(values)
    picks = random.Random(seed).sample(range(size), min(n, size))
    out = []
    for pick in picks:
        candidate = {}
        for name, values in space.items():
            pick, at = divmod(pick, len(values))
            candidate[name] = values[at]
        out.append(candidate)
    return out


def median_filled(df: DataFrame, columns: Sequence[str], scratch: Scratch) -> DataFrame:
    """``df`` with the missing values of numeric columns set to the column's exact median; 0 if it has no value."""
    medians = exact_quantiles(long_values(df, list(columns)), ["feature"], "value", {"median": 0.5}, scratch)
    one = medians.groupBy().pivot("feature", list(columns)).agg(F.first("median")).toDF(*[f"_median_{c}" for c in columns])
    filled = {c: F.coalesce(F.col(c).cast("double"), F.col(f"_median_{c}"), F.lit(0.0)) for c in columns}
    return df.crossJoin(F.broadcast(one)).select(*[filled[c].alias(c) if c in filled else F.col(c) for c in df.columns])


def train_boosted(train: DataFrame, candidates: list[dict], folds: int = 5, seed: int = SEED) -> BoostedModel:
    """Random search by cross-validated AUC over all rows, then a final fit; every fit stops early on the held-out fifth.

    ``figures`` of the model have the cross-validated AUC, ``params`` the chosen candidate.
    """
    rows = _numeric(weighted(train, folds, seed), FEATURE_COLUMNS)
    return boosting.search(rows, "customer_id", FEATURE_COLUMNS, candidates, folds, seed, "label", WEIGHT, FOLD, HOLD_OUT)


def baseline_models(train: DataFrame, boosted: BoostedModel, seed: int = SEED, forest_trees: int = 200, forest_depth: int = 10) -> dict:
    """Logistic regression and random forest on the training rows beside the boosted trees, simplest first."""
    from pyspark.ml.feature import SQLTransformer

    rows = _numeric(weighted(train, seed=seed), FEATURE_COLUMNS)
    filled = [f"{c}_filled" for c in FEATURE_COLUMNS]
    imputer = Imputer(strategy="median", inputCols=list(FEATURE_COLUMNS), outputCols=filled)
    logs = SQLTransformer(statement="SELECT *, " + ", ".join(
        f"ln(1 + greatest({c}_filled, 0)) AS {c}_log" for c in SKEWED_FEATURES) + " FROM __THIS__")
    shaped = [f"{c}_log" if c in SKEWED_FEATURES else f"{c}_filled" for c in FEATURE_COLUMNS]
    linear = [imputer, logs, VectorAssembler(inputCols=shaped, outputCol="raw_features"),
              StandardScaler(inputCol="raw_features", outputCol="features", withMean=True),
              LogisticRegression(labelCol="label", weightCol=WEIGHT, maxIter=1000, regParam=0.01)]
    forest = RandomForestClassifier(labelCol="label", weightCol=WEIGHT, numTrees=forest_trees, maxDepth=forest_depth, seed=seed)
    return {"Logistic Regression": Pipeline(stages=linear).fit(rows),
            "Random Forest": Pipeline(stages=[*imputed_vector(), forest]).fit(rows),
            "Boosted Trees": boosted}


def probabilities(model: PipelineModel | BoostedModel, features: DataFrame) -> DataFrame:
    """The input rows with ``churn_probability``."""
    if isinstance(model, BoostedModel):
        return model.probabilities(features)
    scored = model.transform(_numeric(features, FEATURE_COLUMNS))
    return scored.select(*features.columns, vector_to_array("probability")[1].alias("churn_probability"))


def compare_models(models: dict[str, PipelineModel | BoostedModel], test: DataFrame, scratch: Scratch, cutoff: float = 0.5) -> DataFrame:
    """(model, simplicity, metrics) per model on the test rows."""
    out = None
    for rank, (name, model) in enumerate(models.items()):
        scored = probabilities(model, test).withColumn("churn_flag", X.churn_flag("churn_probability", cutoff))
        part = S.evaluate(scored, scratch).select(F.lit(name).alias("model"), F.lit(rank).alias("simplicity"), "*")
        out = part if out is None else out.unionByName(part)
    return out


def select_model(comparison: DataFrame, gate: float = 0.80, slack: float = 0.01) -> DataFrame:
    """Models at the AUC gate (all, if none is), within ``slack`` of the best; then F1, simplicity, AUC."""
    gated = comparison.withColumn("at_gate", F.col("auc_roc") >= gate)
    any_at_gate = gated.agg(F.max("at_gate").alias("any_at_gate"))
    pool = gated.crossJoin(F.broadcast(any_at_gate)).filter(F.col("at_gate") | ~F.col("any_at_gate"))
    best = pool.agg(F.max("auc_roc").alias("best_auc"))
    close = pool.crossJoin(F.broadcast(best)).filter(F.col("auc_roc") >= F.col("best_auc") - slack)
    return close.orderBy(F.desc("f1_churn"), "simplicity", F.desc("auc_roc")).limit(1).select(comparison.columns)


def batch_score(model: BoostedModel, features: DataFrame, threshold: float) -> DataFrame:
    return S.score(probabilities(model, features), threshold)


# ---- attribution -------------------------------------------------------------------------------------------

def gain_importance(model: BoostedModel, df: DataFrame) -> DataFrame:
    """(feature, importance) from the trees' split gains; 32 rows of model metadata."""
    return df.sparkSession.createDataFrame(list(zip(FEATURE_COLUMNS, model.importances().tolist())), "feature string, importance double")


def shapley(model: BoostedModel, features: DataFrame) -> DataFrame:
    """(customer_id, feature, contribution, expected_value, margin): exact Shapley values of the margin, with covers as the background."""
    return model.contributions(features, "customer_id")


def shapley_importance(contributions: DataFrame) -> DataFrame:
    """(feature, mean_abs_shap) over all explained customers."""
    return contributions.groupBy("feature").agg(F.avg(F.abs("contribution")).alias("mean_abs_shap"))


def shapley_drivers(contributions: DataFrame, n: int = 8) -> DataFrame:
    """The n features that move each customer's margin most, with their sign."""
    rows = contributions.select("customer_id", "feature", "contribution")
    return S.first_rows(rows, "customer_id", [F.desc(F.abs("contribution")), F.asc("feature")], n)


def _one_changed(df: DataFrame, replacements: dict[str, Column], keep: Sequence[str]) -> DataFrame:
    """For every row and feature, a copy with just that feature replaced. The copies are made inside each task."""
    copies = df.withColumn("changed_feature", F.explode(F.array(*[F.lit(c) for c in FEATURE_COLUMNS])))
    values = [F.when(F.col("changed_feature") == c, replacements[c]).otherwise(F.col(c)).cast("double").alias(c)
              for c in FEATURE_COLUMNS]
    return copies.select(*keep, "changed_feature", *values)


def median_ablation(model: BoostedModel, features: DataFrame, scratch: Scratch) -> DataFrame:
    """(customer_id, feature, score_change): how the score moves when one feature is set to its median.

    This is not a Shapley value; it answers a similar question with one distributed scoring pass.
    """
    medians = S.medians_and_bounds(features, FEATURE_COLUMNS, scratch).groupBy().pivot("feature", FEATURE_COLUMNS).agg(
        F.first("median"))
    wide = features.crossJoin(F.broadcast(medians.toDF(*[f"_median_{c}" for c in FEATURE_COLUMNS])))
    scored = probabilities(model, wide).withColumnRenamed("churn_probability", "base_score")
    varied = _one_changed(scored, {c: F.col(f"_median_{c}") for c in FEATURE_COLUMNS}, ["customer_id", "base_score"])
    return probabilities(model, varied).select(
        "customer_id", F.col("changed_feature").alias("feature"),
        (F.col("base_score") - F.col("churn_probability")).alias("score_change"))


def global_ablation_importance(ablation: DataFrame) -> DataFrame:
    return ablation.groupBy("feature").agg(F.avg(F.abs("score_change")).alias("mean_abs_change"))


def top_drivers(ablation: DataFrame, n: int = 8) -> DataFrame:
    """The n features that move each customer's score most."""
    return S.first_rows(ablation, "customer_id", [F.desc(F.abs("score_change")), F.asc("feature")], n)


def permutation_importance(model: BoostedModel, labelled: DataFrame, scratch: Scratch, seed: int = SEED) -> DataFrame:
    """(feature, auc_drop) when a feature's values are taken from another, randomly placed customer."""
    shuffled = global_row_number(labelled.withColumn("_h", F.xxhash64("customer_id", F.lit(seed))), ["_h", "customer_id"],
                                 scratch, "_rn")
    n = labelled.count()
    donors = shuffled.select((F.col("_rn") % n + 1).alias("_rn"), *[F.col(c).alias(f"_donor_{c}") for c in FEATURE_COLUMNS])
    paired = shuffled.join(donors, "_rn")
    varied = _one_changed(paired, {c: F.col(f"_donor_{c}") for c in FEATURE_COLUMNS}, ["customer_id", LABEL])
    auc = S.area_under_roc(probabilities(model, varied), scratch, groups=["changed_feature"])
    base = S.area_under_roc(probabilities(model, labelled), scratch).withColumnRenamed("auc_roc", "base_auc")
    return auc.crossJoin(F.broadcast(base)).select(
        F.col("changed_feature").alias("feature"), (F.col("base_auc") - F.col("auc_roc")).alias("auc_drop"))


# ---- what-if -----------------------------------------------------------------------------------------------

LEVERS = ["recency_days", "frequency", "monetary", "frequency_last_90d", "avg_order_value", "tenure_days"]


def what_if(model: BoostedModel, features: DataFrame, scenarios: DataFrame, threshold: float, scratch: Scratch) -> DataFrame:
    """Score scenarios: the median customer with some levers set, each held between its 1st and 99th percentile.

    ``scenarios`` has ``scenario`` and any of the lever columns; a NULL lever stays at the median.
    """
    limits = S.medians_and_bounds(features, FEATURE_COLUMNS, scratch)
    base = limits.groupBy().pivot("feature", FEATURE_COLUMNS).agg(
        F.first("median").alias("median"), F.first("p01").alias("p01"), F.first("p99").alias("p99"))
    both = scenarios.withColumnsRenamed({c: f"_set_{c}" for c in scenarios.columns if c != "scenario"}).crossJoin(
        F.broadcast(base))
    values = []
    for c in FEATURE_COLUMNS:
        median = F.col(f"{c}_median")
        if c in scenarios.columns:
            held = F.least(F.greatest(F.col(f"_set_{c}").cast("double"), F.col(f"{c}_p01")), F.col(f"{c}_p99"))
            values.append(F.when(F.col(f"_set_{c}").isNotNull(), held).otherwise(median).alias(c))
        else:
            values.append(median.alias(c))
    scored = probabilities(model, both.select("scenario", *values))
    return scored.withColumns({"churn_flag": X.churn_flag("churn_probability", threshold),
                               "risk_tier": X.risk_tier("churn_probability")})


# ---- end to end --------------------------------------------------------------------------------------------

def run_training(labelled: DataFrame, scratch: Scratch, n_candidates: int = 50, folds: int = 5, gate: float = 0.80,
                 enforce: bool = True, threshold_on: str = "validation", space: dict[str, list] | None = None) -> dict:
    """Split, search, evaluate, choose the threshold, check the gate and take the drift baselines.

    The threshold is chosen on the early-stopping fifth of the training rows, or on the test rows with
    ``threshold_on='test'``. A model below the gate is reported but not released, unless ``enforce`` is off: it comes without
    drift baselines and ``publish_model`` refuses it. All figures are in ``model.figures``.
    """
    train, test = split(labelled)
    model = train_boosted(train, search_candidates(n_candidates, space=space), folds)
    scored_test = probabilities(model, test).withColumn("churn_flag", X.churn_flag("churn_probability", 0.5))
    metrics = S.evaluate(scored_test, scratch).first().asDict()
    passed = S.enforce_gate(metrics["auc_roc"], gate, enforce=False)
    released = passed or not enforce
    chosen_on = test if threshold_on == "test" else weighted(train).filter(HOLD_OUT).select(train.columns)
    threshold = S.best_threshold(probabilities(model, chosen_on), scratch).first()["threshold"]
    model = replace(model, figures={**model.figures, **metrics, "threshold": float(threshold), "gate": gate, "gate_passed": passed, "released": released})
    baseline = None
    if released:
        baseline = S.feature_baseline(train).unionByName(S.score_baseline(probabilities(model, train)))
    return {"model": model, "metrics": metrics, "gate_passed": passed, "released": released, "threshold": threshold, "baseline": baseline}


def publish_model(run: dict, spark, path: str) -> None:
    """Store a released model with its baselines where scoring and monitoring read them."""
    if not run["released"]:
        raise S.GateFailed(f"AUC {run['metrics']['auc_roc']:.4f} is below the gate")
    run["model"].save(spark, path)
    run["baseline"].coalesce(1).write.mode("overwrite").parquet(f"{path}/baseline")
