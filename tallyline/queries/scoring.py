"""Model measures on a fixed score column (checked by SQL), and the trained models themselves (rows only)."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from tallyline.functions import exprs as X
from tallyline.operators.quantiles import exact_quantiles, long_values
from tallyline.plans import analytics as A
from tallyline.plans import churn as M
from tallyline.plans import export as E
from tallyline.plans import clustering as K
from tallyline.plans import features as P
from tallyline.plans import monitoring as D
from tallyline.plans import scoring as S
from tallyline.plans.boosting import BoostedModel
from tallyline.queries.analytics import THRESHOLD, customers
from tallyline.queries.base import LAYERS, features_sql, query, s_count, s_ratio, s_round, s_units
from tallyline.schemas import FEATURE_COLUMNS
from tallyline.sources.lake import is_complete

LAYERS["labelled"] = f"""SELECT s.customer_id, s.churn_probability, l.churn,
    CASE WHEN s.churn_probability >= {THRESHOLD} THEN 1 ELSE 0 END AS churn_flag
    FROM scores s JOIN labels_train l ON s.customer_id = l.customer_id"""


def labelled_scores(r):
    labels = P.churn_labels(r.lines, P.training_cutoff(r.lines))
    return r.scores.select("customer_id", "churn_probability").join(labels, "customer_id").withColumn(
        "churn_flag", X.churn_flag("churn_probability", THRESHOLD))


_TP, _FP = s_count("churn = 1 AND churn_flag = 1"), s_count("churn = 0 AND churn_flag = 1")
_TN, _FN = s_count("churn = 0 AND churn_flag = 0"), s_count("churn = 1 AND churn_flag = 0")


def s_div(a: str, b: str) -> str:
    return f"COALESCE({s_ratio(a, b)}, CAST(0 AS DOUBLE))"


_CONFUSION = f"""SELECT tp AS true_positives, fp AS false_positives, tn AS true_negatives, fn AS false_negatives,
    {s_div("tp + tn", "tp + fp + tn + fn")} AS accuracy, {s_div("tp", "tp + fp")} AS precision_churn,
    {s_div("tp", "tp + fn")} AS recall_churn, {s_div("2 * tp", "2 * tp + fp + fn")} AS f1_churn
    FROM (SELECT {_TP} AS tp, {_FP} AS fp, {_TN} AS tn, {_FN} AS fn FROM labelled) t"""
query("m7_confusion", _CONFUSION)(lambda r: S.confusion(labelled_scores(r)))
_AUC = f"""SELECT {s_ratio("SUM(CASE WHEN a.churn_probability > b.churn_probability THEN 2 WHEN a.churn_probability = b.churn_probability THEN 1 ELSE 0 END)",
    "2 * COUNT(*)")} AS auc_roc FROM labelled a JOIN labelled b ON a.churn = 1 AND b.churn = 0"""
query("m7_area_under_roc", _AUC)(lambda r: S.area_under_roc(labelled_scores(r), r.scratch))
query("m14_quality_gate", f"SELECT 'auc_roc' AS metric, auc_roc AS value, CAST(0.8 AS DOUBLE) AS gate, auc_roc >= 0.8 AS passed FROM ({_AUC}) t")(
    lambda r: S.quality_gate(S.area_under_roc(labelled_scores(r), r.scratch)))
LAYERS["curve"] = """SELECT t.threshold, SUM(CASE WHEN l.churn = 1 THEN 1 ELSE 0 END) AS tp, SUM(CASE WHEN l.churn = 0 THEN 1 ELSE 0 END) AS fp,
    (SELECT COUNT(*) FROM labelled WHERE churn = 1) AS p, (SELECT COUNT(*) FROM labelled WHERE churn = 0) AS q
    FROM (SELECT DISTINCT churn_probability AS threshold FROM labelled) t JOIN labelled l ON l.churn_probability >= t.threshold
    GROUP BY t.threshold"""
_PR = f"""SELECT threshold, {s_div("tp", "tp + fp")} AS precision, {s_div("tp", "p")} AS recall,
    {s_div("2 * tp", "tp + fp + p")} AS f1 FROM curve"""
query("m9_precision_recall", _PR)(lambda r: S.precision_recall(labelled_scores(r), r.scratch))
query("m9_best_threshold", f"""SELECT threshold, precision AS precision_churn, recall AS recall_churn, f1 AS f1_churn
    FROM ({_PR}) t ORDER BY f1 DESC, threshold LIMIT 1""")(lambda r: S.best_threshold(labelled_scores(r), r.scratch))
query("m10_roc_points", f"SELECT threshold, {s_div('fp', 'q')} AS fpr, {s_div('tp', 'p')} AS tpr FROM curve")(
    lambda r: S.roc_points(labelled_scores(r), r.scratch))
_P = "churn_probability"
_MEAN = f"AVG({_P})"
query("m12_score_summary", f"""SELECT MIN({_P}) AS min, {s_round(f"quantile_cont({_P}, 0.25)", 6)} AS p25,
    {s_round(f"quantile_cont({_P}, 0.5)", 6)} AS median, {s_round(f"quantile_cont({_P}, 0.75)", 6)} AS p75, MAX({_P}) AS max,
    {s_round(_MEAN, 6)} AS mean, {s_ratio(s_count(f"{_P} >= 0.7"), "COUNT(*)")} AS pct_high_risk,
    {s_ratio(s_count(f"{_P} >= {THRESHOLD}"), "COUNT(*)")} AS pct_churn_flag FROM scores""")(
    lambda r: S.score_summary(r.scores, THRESHOLD, r.scratch).withColumns(
        {c: X.round_to(c, 6) for c in ("p25", "median", "p75", "mean")}))


def _baseline_sql(source: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {s_round(f'AVG(CAST({c} AS DOUBLE))', 4)} AS mean, "
        f"{s_round(f'STDDEV_SAMP(CAST({c} AS DOUBLE))', 4)} AS std FROM {source}" for c in FEATURE_COLUMNS)


query("m13_training_baseline", _baseline_sql("fx") + f" UNION ALL SELECT 'score', {s_round(_MEAN, 4)}, "
      f"{s_round(f'STDDEV_POP({_P})', 4)} FROM scores")(
    lambda r: S.feature_baseline(r.mart_features).unionByName(S.score_baseline(r.scores)).withColumns(
        {"mean": X.round_to("mean", 4), "std": X.round_to("std", 4)}))
query("m16_medians_and_bounds", " UNION ALL ".join(
    f"SELECT '{c}' AS feature, {s_round(f'quantile_cont(CAST({c} AS DOUBLE), 0.5)', 6)} AS median, "
    f"{s_round(f'quantile_cont(CAST({c} AS DOUBLE), 0.01)', 6)} AS p01, "
    f"{s_round(f'quantile_cont(CAST({c} AS DOUBLE), 0.99)', 6)} AS p99 FROM fx" for c in M.LEVERS))(
    lambda r: S.medians_and_bounds(r.mart_features, M.LEVERS, r.scratch).select(
        "feature", *[X.round_to(c, 6).alias(c) for c in ("median", "p01", "p99")]))
_LABELLED_OUT = "customer_id, churn_probability, churn_flag, churn"
query("j17_scores_with_labels", f"SELECT {_LABELLED_OUT} FROM labelled")(
    lambda r: S.aligned_with_labels(S.score(r.scores, THRESHOLD), P.churn_labels(r.lines, P.training_cutoff(r.lines)))[0].select(
        _LABELLED_OUT.split(", ")))
query("j17_dropped_scores", f"""SELECT {s_count()} AS dropped FROM scores s
    WHERE NOT EXISTS (SELECT 1 FROM labels_train l WHERE l.customer_id = s.customer_id)""")(
    lambda r: S.aligned_with_labels(S.score(r.scores, THRESHOLD), P.churn_labels(r.lines, P.training_cutoff(r.lines)))[1])

_TIER = "CASE WHEN churn_probability >= 0.7 THEN 'High' WHEN churn_probability >= 0.4 THEN 'Medium' ELSE 'Low' END"
_FLAG = f"CASE WHEN churn_probability >= {THRESHOLD} THEN 1 ELSE 0 END"
query("p16_churn_flag", f"SELECT customer_id, {_FLAG} AS churn_flag FROM scores")(
    lambda r: r.scores.select("customer_id", X.churn_flag("churn_probability", THRESHOLD).alias("churn_flag")))
query("p17_risk_tier", f"""SELECT customer_id, {_TIER} AS risk_tier,
    CASE WHEN churn_probability >= 0.9 THEN 'High' WHEN churn_probability >= 0.2 THEN 'Medium' ELSE 'Low' END AS strict_tier FROM scores""")(
    lambda r: r.scores.select("customer_id", X.risk_tier("churn_probability").alias("risk_tier"),
                              X.risk_tier("churn_probability", 0.9, 0.2).alias("strict_tier")))
_ISSUES = {
    "customer_id is NULL": "customer_id IS NULL", "churn_probability is NULL": f"{_P} IS NULL",
    "churn_probability outside 0..1": f"{_P} < 0 OR {_P} > 1", "churn_flag not 0 or 1": "churn_flag NOT IN (0, 1)",
    "churn_flag against threshold": f"churn_flag <> {_FLAG}", "risk_tier unknown": "risk_tier NOT IN ('High', 'Medium', 'Low')",
    "risk_tier against probability": f"risk_tier <> {_TIER}"}
query("q26_scoring_issues_seeded", f"""WITH faulty AS (SELECT customer_id, CASE WHEN is_uk = 1 THEN 1.5 ELSE {_P} END AS {_P},
        CASE WHEN frequency = 7 THEN 2 ELSE {_FLAG} END AS churn_flag,
        CASE WHEN frequency = 8 THEN 'None' ELSE {_TIER} END AS risk_tier FROM scores)
    """ + " UNION ALL ".join(f"SELECT '{n}' AS rule, {s_count(c)} AS rows FROM faulty" for n, c in _ISSUES.items())
      + " UNION ALL SELECT 'customer_id repeated', CAST(COUNT(*) - COUNT(DISTINCT customer_id) AS BIGINT) FROM faulty")(
    lambda r: S.scoring_issues(r.scores.select(
        "customer_id", F.when(F.col("is_uk") == 1, 1.5).otherwise(F.col(_P)).alias(_P),
        F.when(F.col("frequency") == 7, 2).otherwise(X.churn_flag(_P, THRESHOLD)).alias("churn_flag"),
        F.when(F.col("frequency") == 8, "None").otherwise(X.risk_tier(_P)).alias("risk_tier")), THRESHOLD))
query("q26_scoring_issues", " UNION ALL ".join(
    f"SELECT '{n}' AS rule, CAST(0 AS BIGINT) AS rows" for n in [*_ISSUES, "customer_id repeated"]))(
    lambda r: S.scoring_issues(S.score(r.scores, THRESHOLD), THRESHOLD))


_SEEDED = f"""WITH listed AS (SELECT customer_id, {_P}, ROW_NUMBER() OVER (ORDER BY customer_id) AS position FROM scores),
    foreign_rows AS (SELECT customer_id || 'x' AS customer_id, {_P}, CAST(0 AS BIGINT) AS position FROM scores WHERE is_uk = 1),
    repeated AS (SELECT customer_id, {_P}, CAST(-1 AS BIGINT) AS position FROM scores WHERE frequency = 7),
    every_row AS (SELECT * FROM listed UNION ALL SELECT * FROM foreign_rows UNION ALL SELECT * FROM repeated)
    SELECT 'customer_id is NULL' AS rule, CAST(0 AS BIGINT) AS rows
    UNION ALL SELECT 'churn_probability outside 0..1', {s_count(f"{_P} < 0 OR {_P} > 1")} FROM every_row
    UNION ALL SELECT 'risk_tier unknown', {s_count()} FROM every_row WHERE {_P} < 0.2
    UNION ALL SELECT 'customer_id repeated', CAST(COUNT(*) - COUNT(DISTINCT customer_id) AS BIGINT) FROM every_row
    UNION ALL SELECT 'customer not in source', {s_count()} FROM foreign_rows
    UNION ALL SELECT 'not sorted by probability', {s_count()} FROM listed a JOIN listed b ON b.position = a.position + 1 AND b.{_P} > a.{_P}"""


@query("q27_retention_issues_seeded", _SEEDED)
def retention_issues_seeded(r):
    """A list in customer order with foreign and repeated customers and an unknown tier."""
    from tallyline.operators.ordering import global_row_number
    placed = global_row_number(r.scores.select("customer_id", _P), [F.asc("customer_id")], r.scratch, "position")
    rows = placed.unionByName(r.scores.filter("is_uk = 1").select(
        F.concat("customer_id", F.lit("x")).alias("customer_id"), _P, F.lit(0).cast("bigint").alias("position")))
    rows = rows.unionByName(r.scores.filter("frequency = 7").select("customer_id", _P, F.lit(-1).cast("bigint").alias("position")))
    tiers = rows.withColumn("risk_tier", F.when(F.col(_P) < 0.2, "None").otherwise(X.risk_tier(_P)))
    from tallyline.schemas import RETENTION_COLUMNS
    for c in RETENTION_COLUMNS:
        if c not in tiers.columns:
            tiers = tiers.withColumn(c, F.lit(None).cast("string"))
    out = S.retention_issues(tiers, r.scores)
    order = S.retention_issues(tiers.filter("position > 0"), None, "position").filter("rule = 'not sorted by probability'")
    return out.unionByName(order)


@query("q27_retention_issues", " UNION ALL ".join(
    f"SELECT '{n}' AS rule, CAST(0 AS BIGINT) AS rows" for n in
    ("customer_id is NULL", "churn_probability outside 0..1", "risk_tier unknown", "customer_id repeated",
     "customer not in source", "not sorted by probability")))
def retention_issues(r):
    from tallyline.operators.ordering import global_row_number
    from tallyline.schemas import RETENTION_COLUMNS
    chosen = A.retention_list(customers(r), THRESHOLD, tiers=["High", "Medium"]).select(RETENTION_COLUMNS)
    placed = global_row_number(chosen, [F.desc(_P), F.asc("customer_id")], r.scratch, "position")
    return S.retention_issues(placed, r.scores, "position")


# ---- trained models ----------------------------------------------------------------------------------------

_MODELS: dict[int, tuple] = {}


def trained(r):
    """(model, training rows, test rows): one full search per lake, stored with its figures and read back."""
    if id(r) not in _MODELS:
        path = f"{r.lake.root}/churn_model"
        if not is_complete(r.spark, f"{path}/about"):
            M.run_training(r.train_features, r.scratch)["model"].save(r.spark, path)
        _MODELS[id(r)] = (r, BoostedModel.load(r.spark, path), *M.split(r.train_features))
    return _MODELS[id(r)][1:]


def s_hole(column: str) -> str:
    return f"CAST('0x' || SUBSTR(md5(customer_id || '{column}'), 1, 7) AS BIGINT) % 11 = 0"


LAYERS["holed"] = "SELECT customer_id, " + ", ".join(f"CASE WHEN {s_hole(c)} THEN NULL ELSE CAST({c} AS DOUBLE) END AS {c}" for c in FEATURE_COLUMNS) + " FROM fx"


@query("m1_median_imputation", "SELECT customer_id, " + ", ".join(
    f"{s_round(f'COALESCE({c}, (SELECT quantile_cont({c}, 0.5) FROM holed))', 6)} AS {c}" for c in FEATURE_COLUMNS) + " FROM holed")
def median_imputation(r):
    """All features, each made unknown for some customers so that there is something to fill."""
    holes = [F.when(F.conv(F.substring(F.md5(F.concat("customer_id", F.lit(c)).cast("binary")), 1, 7), 16, 10).cast("bigint") % 11 != 0,
                    F.col(c).cast("double")).alias(c) for c in FEATURE_COLUMNS]
    filled = M.median_filled(r.mart_features.select("customer_id", *holes), FEATURE_COLUMNS, r.scratch)
    return filled.select("customer_id", *[X.round_to(c, 6).alias(c) for c in FEATURE_COLUMNS])


def s_bucket(salt: int, size: int, more: str = "") -> str:
    text = f"customer_id || '|' {more} || '{salt}'"
    return f"(CAST('0x' || SUBSTR(md5({text}), 1, 7) AS BIGINT) % {size})"


_TRAIN = "(SELECT customer_id, CAST(churn AS INTEGER) AS churn FROM labels_train JOIN fx USING (customer_id))"
_PART = s_bucket(M.SEED, 10_000, "|| CAST(churn AS VARCHAR) || '|'")


@query("m2_stratified_split", f"""SELECT CASE WHEN {_PART} < 2000 THEN 'test' ELSE 'train' END AS part, churn,
    {s_count()} AS customers FROM {_TRAIN} t GROUP BY 1, 2""")
def stratified_split(r):
    train, test = M.split(r.train_features)
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test"))).groupBy(
        "part", "churn").agg(F.count(F.lit(1)).alias("customers"))


query("m3_class_weights", f"""SELECT churn, CASE WHEN churn = 1 THEN {s_ratio(f"(SELECT COUNT(*) FROM {_TRAIN} n WHERE churn = 0)", f"(SELECT COUNT(*) FROM {_TRAIN} p WHERE churn = 1)")}
    ELSE 1.0 END AS weight, {s_count()} AS customers FROM {_TRAIN} t GROUP BY churn""")(lambda r: M.weighted(r.train_features).groupBy("churn").agg(
    F.max(M.WEIGHT).alias("weight"), F.count(F.lit(1)).alias("customers")))
query("m5_hold_out_flags", f"""SELECT {s_bucket(M.SEED + 2, 5)} = 0 AS {M.HOLD_OUT}, CAST({s_bucket(M.SEED + 1, 5)} AS INTEGER) AS {M.FOLD},
    {s_count()} AS customers FROM {_TRAIN} t GROUP BY 1, 2""")(lambda r: M.weighted(r.train_features).groupBy(M.HOLD_OUT, M.FOLD).agg(
    F.count(F.lit(1)).alias("customers")))


@query("m4_boosted_training")
def boosted_training(r):
    model, _, test = trained(r)
    scored = M.probabilities(model, test).withColumn("churn_flag", X.churn_flag(_P, 0.5))
    return S.evaluate(scored, r.scratch).withColumns({k: F.lit(model.figures[k]) for k in ("cv_auc", "hold_out_auc", "fits", "trees")})


@query("m6_model_comparison")
def model_comparison(r):
    model, train, test = trained(r)
    compared = r.scratch.write(M.compare_models(M.baseline_models(train, model), test, r.scratch))
    winner = M.select_model(compared).select("model", F.lit(True).alias("selected"))
    return compared.join(F.broadcast(winner), "model", "left").withColumn("selected", F.coalesce("selected", F.lit(False)))


query("m8_batch_score")(lambda r: M.batch_score(trained(r)[0], r.mart_features, THRESHOLD))
query("g11_mart_churn_scores")(lambda r: M.batch_score(trained(r)[0], r.mart_features, THRESHOLD))
query("m11_gain_importance")(lambda r: M.gain_importance(trained(r)[0], r.mart_features))
query("l3_top_importances")(lambda r: S.top_by(M.gain_importance(trained(r)[0], r.mart_features), "importance", 8))
query("m11_median_ablation")(lambda r: M.median_ablation(trained(r)[0], r.mart_features, r.scratch))
query("m11_global_ablation")(lambda r: M.global_ablation_importance(M.median_ablation(trained(r)[0], r.mart_features, r.scratch)))
query("m11_top_drivers")(lambda r: M.top_drivers(M.median_ablation(trained(r)[0], r.mart_features, r.scratch)))
query("m11_shapley_values")(lambda r: M.shapley(trained(r)[0], r.mart_features))
query("m11_shapley_importance")(lambda r: M.shapley_importance(M.shapley(trained(r)[0], trained(r)[2])))
query("m11_shapley_drivers")(lambda r: M.shapley_drivers(M.shapley(trained(r)[0], r.mart_features)))
query("m11_permutation_importance")(lambda r: M.permutation_importance(trained(r)[0], trained(r)[2], r.scratch))


@query("m15_what_if")
def what_if(r):
    """Scenarios are levels of two levers taken from the customers themselves."""
    levels = exact_quantiles(long_values(r.mart_features, ["recency_days", "frequency"]), ["feature"], "value",
                             {"low": 0.1, "high": 0.9}, r.scratch)
    rows = levels.unpivot(["feature"], ["low", "high"], "level", "value")
    scenarios = rows.select(F.concat_ws(" ", "feature", "level").alias("scenario"), *[
        F.when(F.col("feature") == c, F.col("value")).alias(c) for c in ("recency_days", "frequency")])
    return M.what_if(trained(r)[0], r.mart_features, scenarios, THRESHOLD, r.scratch).select(
        "scenario", "recency_days", "frequency", "churn_probability", "churn_flag", "risk_tier")


@query("m17_training_run")
def training_run(r):
    """The figures of the whole run, gate outcome included, and the drift baselines if the gate lets the model go out."""
    model, train, _ = trained(r)
    rows = [("training", k, float(v)) for k, v in {**model.figures, **model.params}.items()]
    out = r.spark.createDataFrame(rows, "part string, name string, value double").withColumn("std", F.lit(None).cast("double"))
    if model.figures["released"]:
        baseline = S.feature_baseline(train).unionByName(S.score_baseline(M.probabilities(model, train)))
        out = out.unionByName(baseline.select(F.lit("baseline").alias("part"), F.col("feature").alias("name"), F.col("mean").alias("value"), "std"))
    return out


# ---- clusters ----------------------------------------------------------------------------------------------

LAYERS["assigned"] = """SELECT *, CAST(CASE WHEN recency_days > 300 THEN 0 WHEN frequency >= 11 THEN 1 WHEN tenure_days < 1200 THEN 2 ELSE 3 END AS INTEGER)
    AS cluster_id FROM fx"""


def assigned(r):
    """A fixed assignment, for the measures that work on any assignment."""
    return r.mart_features.withColumn("cluster_id", F.when(F.col("recency_days") > 300, 0).when(
        F.col("frequency") >= 11, 1).when(F.col("tenure_days") < 1200, 2).otherwise(3))


def _cluster_mean(c: str) -> str:
    return f"AVG(CAST({c} AS DOUBLE))"


LAYERS["overall_means"] = "SELECT " + ", ".join(f"{_cluster_mean(c)} AS o_{c}" for c in FEATURE_COLUMNS) + ", COUNT(*) AS n FROM assigned"
LAYERS["cluster_means"] = "SELECT cluster_id, " + ", ".join(f"{_cluster_mean(c)} AS {c}" for c in FEATURE_COLUMNS) + \
    ", CAST(COUNT(*) AS BIGINT) AS cluster_size FROM assigned GROUP BY cluster_id"
LAYERS["cluster_profile"] = "SELECT m.*, " + ", ".join(
    s_ratio(f"(({c} - o_{c}) * 100)", f"o_{c}") + f" AS {c}_rel_pct" for c in FEATURE_COLUMNS) + \
    f", {s_ratio('cluster_size * 100', 'n')} AS cluster_pct FROM cluster_means m, overall_means o"
_ROUNDED = [*FEATURE_COLUMNS, *[f"{c}_rel_pct" for c in FEATURE_COLUMNS], "cluster_pct"]
query("c5_cluster_profiles", "SELECT cluster_id, cluster_size, " + ", ".join(f"{s_round(c, 4)} AS {c}" for c in _ROUNDED) + " FROM cluster_profile")(
    lambda r: K.profiles(assigned(r)).select("cluster_id", "cluster_size", *[X.round_to(c, 4).alias(c) for c in _ROUNDED]))


def _naming_sql() -> str:
    whens = []
    for label, bounds, mode in K.NAMING_RULES:
        tests = [f"COALESCE({f}_rel_pct, 0) {sign} {bound}" for f, sign, bound in bounds]
        whens.append("WHEN " + (" AND " if mode == "all" else " OR ").join(tests) + f" THEN '{label}'")
    return "CASE " + " ".join(whens) + f" ELSE '{K.DEFAULT_NAME}' END"


query("p22_cluster_base_names", f"SELECT cluster_id, {_naming_sql()} AS base_name FROM cluster_profile")(
    lambda r: K.profiles(assigned(r)).select("cluster_id", K.cluster_name().alias("base_name")))
LAYERS["cluster_names"] = f"""SELECT cluster_id, CASE WHEN twins > 1 THEN base_name || ' ' || chr(CAST(64 + nth AS INTEGER)) ELSE base_name END AS cluster_name
    FROM (SELECT cluster_id, base_name, COUNT(*) OVER (PARTITION BY base_name) AS twins,
        ROW_NUMBER() OVER (PARTITION BY base_name ORDER BY cluster_id) AS nth
        FROM (SELECT cluster_id, {_naming_sql()} AS base_name FROM cluster_profile) b) t"""
query("p23_cluster_names", "SELECT * FROM cluster_names")(lambda r: K.name_clusters(K.profiles(assigned(r))))
query("c6_cluster_labels", "SELECT * FROM cluster_names")(lambda r: K.name_clusters(K.profiles(assigned(r))))
query("s26_named_profiles", f"""SELECT p.cluster_id, cluster_name, cluster_size, {s_round("monetary", 4)} AS monetary FROM cluster_profile p
    LEFT JOIN cluster_names n ON p.cluster_id = n.cluster_id""")(
    lambda r: E.named_profiles(K.profiles(assigned(r)), K.name_clusters(K.profiles(assigned(r)))).select(
        "cluster_id", "cluster_name", "cluster_size", X.round_to("monetary", 4).alias("monetary")))
query("c7_fixed_assignments", "SELECT customer_id, a.cluster_id, cluster_name FROM assigned a JOIN cluster_names n ON a.cluster_id = n.cluster_id")(
    lambda r: K.assignments(assigned(r), K.name_clusters(K.profiles(assigned(r)))))
query("b26_customers_of_cluster", f"""SELECT s.customer_id, n.cluster_name, s.churn_probability, s.monetary FROM scores s
    JOIN assigned a ON s.customer_id = a.customer_id JOIN cluster_names n ON a.cluster_id = n.cluster_id WHERE a.cluster_id = 1""")(
    lambda r: r.scores.select("customer_id", "churn_probability", "monetary").join(
        K.assignments(assigned(r), K.name_clusters(K.profiles(assigned(r)))).filter("cluster_id = 1"), "customer_id").select(
        "customer_id", "cluster_name", "churn_probability", "monetary").orderBy(F.desc("churn_probability"), "customer_id"))
query("b21_churn_by_cluster", f"""SELECT n.cluster_name, {s_count()} AS customers,
    {s_round(s_ratio(f"SUM({_FLAG})", "COUNT(*)"), 6)} AS churn_rate, {s_round(s_ratio(s_units("s.monetary"), "COUNT(s.monetary)"), 2)} AS avg_monetary
    FROM scores s JOIN assigned a ON s.customer_id = a.customer_id JOIN cluster_names n ON a.cluster_id = n.cluster_id GROUP BY n.cluster_name""")(
    lambda r: A.churn_by_group(r.scores.join(K.assignments(assigned(r), K.name_clusters(K.profiles(assigned(r)))), "customer_id"),
                               THRESHOLD, "cluster_name"))
_CL = FEATURE_COLUMNS
LAYERS["centres"] = "SELECT cluster_id, COUNT(*) AS n, " + ", ".join(f"AVG({c}) AS c_{c}" for c in _CL) + " FROM assigned GROUP BY cluster_id"
LAYERS["middle"] = "SELECT " + ", ".join(f"AVG({c}) AS o_{c}" for c in _CL) + " FROM assigned"
LAYERS["spread"] = "SELECT a.cluster_id, SUM({0}) AS ss, AVG(SQRT({0})) AS scatter FROM assigned a JOIN centres c ON a.cluster_id = c.cluster_id GROUP BY a.cluster_id".format(
    " + ".join(f"POWER({c} - c_{c}, 2)" for c in _CL))
LAYERS["cluster_pairs"] = "SELECT a.cluster_id, MAX((x.scatter + y.scatter) / SQRT({0})) AS r FROM centres a JOIN spread x ON a.cluster_id = x.cluster_id JOIN centres b ON a.cluster_id <> b.cluster_id JOIN spread y ON b.cluster_id = y.cluster_id GROUP BY a.cluster_id".format(
    " + ".join(f"POWER(a.c_{c} - b.c_{c}, 2)" for c in _CL))
query("c4_separation", "SELECT {0} AS calinski_harabasz, {1} AS davies_bouldin FROM (SELECT (SELECT SUM(ss) FROM spread) AS w, (SELECT AVG(r) FROM cluster_pairs) AS db, SUM(n * ({2})) AS b, SUM(n) AS n, COUNT(*) AS k FROM centres, middle) t".format(
    s_round("b * (n - k) / (w * (k - 1))", 4), s_round("db", 4), " + ".join(f"POWER(c_{c} - o_{c}, 2)" for c in _CL)))(
    lambda r: K.separation(assigned(r), _CL).select(*[X.round_to(c, 4).alias(c) for c in ("calinski_harabasz", "davies_bouldin")]))
_CLUSTERED: dict[int, tuple] = {}


def clustered(r):
    if id(r) not in _CLUSTERED:
        _CLUSTERED[id(r)] = (r, K.run_clustering(r.mart_features))
    return _CLUSTERED[id(r)][1]


query("c1_cluster_preparation")(lambda r: K.prepare(K.fit_preparation(r.mart_features), r.mart_features).select(
    "customer_id", F.expr("CAST(scaled AS STRING)").alias("scaled")))
query("c2_k_search")(lambda r: r.spark.createDataFrame(clustered(r)["k_search"], "k int, cost double, silhouette double"))
query("c3_final_kmeans")(lambda r: clustered(r)["assigned"].groupBy("cluster_id").agg(F.count(F.lit(1)).alias("customers")))
query("c7_cluster_assignments")(lambda r: clustered(r)["assignments"])
query("g12_mart_customer_clusters")(lambda r: clustered(r)["assignments"])
query("c8_assign_stored_model")(lambda r: K.assign_stored(
    clustered(r)["model"], r.train_features.drop("churn"), clustered(r)["names"].filter("cluster_id > 0")))
query("s23_serving_base")(lambda r: E.serving_base(
    r.mart_features, r.mart_rfm, trained(r)[0], clustered(r)["model"], clustered(r)["names"]))


# ---- monitoring --------------------------------------------------------------------------------------------
# Baseline and runs are the same customers' features at different times: 90 days before the newest line (the training cutoff),
# and 60, 30 and 0 days before it.

_BASE, _RUNS = 90, (60, 30, 0)
_TIER_COUNTS = {f"n_{t.lower()}_risk": f"CAST({s_count(f'''risk_tier = '{t}' ''')} AS DOUBLE)" for t in X.RISK_TIERS}
for _back in (_BASE, *_RUNS):
    LAYERS[f"obs_m{_back}"] = f"SELECT MAX(invoice_date) - INTERVAL {_back} DAY AS obs_end FROM lines"
    LAYERS |= {re.sub(r"^fx", f"m{_back}", k): re.sub(r"\bfx(?=_|\b)", f"m{_back}", v) for k, v in features_sql("lines", f"obs_m{_back}").items()}
    LAYERS[f"scored_m{_back}"] = f"""SELECT *, {_TIER} AS risk_tier FROM (SELECT f.*, CAST(obs_end AS DATE) AS run_date,
        {s_round("CAST(recency_days AS DOUBLE) / (recency_days + avg_days_between_orders + 1)", 4)} AS {_P} FROM m{_back} f, obs_m{_back}) x"""


def baseline_rows(r):
    return r.monitored.filter(F.col("as_of") == F.lit(P.training_cutoff(r.lines)))


def run_rows(r):
    """Scores of all runs, the newest included."""
    return r.monitored.filter(F.col("as_of") != F.lit(P.training_cutoff(r.lines))).withColumn("risk_tier", X.risk_tier(_P))


def newest_rows(r):
    return run_rows(r).filter(F.col("as_of") == F.lit(D.run_dates(r.lines)[-1]))


LAYERS["drift_base"] = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, {_cluster_mean(c)} AS m, STDDEV_SAMP(CAST({c} AS DOUBLE)) AS s FROM scored_m{_BASE}" for c in FEATURE_COLUMNS)
for _back in _RUNS:
    LAYERS[f"drift_m{_back}"] = f"""SELECT p.run_date, p.feature, {s_round("p.m", 4)} AS current_mean,
        {s_round("CASE WHEN b.s > 0 THEN ABS(p.m - b.m) / b.s ELSE 0 END", 4)} AS z,
        CASE WHEN b.s > 0 THEN ABS(p.m - b.m) / b.s ELSE 0 END > 3 AS drifted FROM (""" + " UNION ALL ".join(
        f"SELECT MAX(run_date) AS run_date, '{c}' AS feature, {_cluster_mean(c)} AS m FROM scored_m{_back}" for c in FEATURE_COLUMNS) + \
        ") p JOIN drift_base b ON p.feature = b.feature"
    LAYERS[f"data_metrics_m{_back}"] = f"""SELECT run_date, 'drift_z_' || feature AS metric_name, z AS metric_value FROM drift_m{_back}
        UNION ALL SELECT run_date, 'current_mean_' || feature, current_mean FROM drift_m{_back}
        UNION ALL SELECT MAX(run_date), 'n_features_checked', CAST(COUNT(*) AS DOUBLE) FROM drift_m{_back}
        UNION ALL SELECT MAX(run_date), 'n_features_drifted', CAST(COUNT(CASE WHEN drifted THEN 1 END) AS DOUBLE) FROM drift_m{_back}
        UNION ALL SELECT MAX(run_date), 'drift_rate', {s_round(s_ratio("COUNT(CASE WHEN drifted THEN 1 END)", "COUNT(*)"), 4)} FROM drift_m{_back}"""
    _scores = {
        "score_mean": s_round(_MEAN, 4), "score_std": s_round(f"STDDEV_SAMP({_P})", 4),
        **{f"score_p{q}": s_round(f"quantile_cont({_P}, {q / 100})", 4) for q in (25, 50, 75, 90)}, **_TIER_COUNTS,
        "pct_high_risk": s_round(s_ratio(s_count("risk_tier = 'High'"), "COUNT(*)"), 4),
        "total_customers_scored": "CAST(COUNT(*) AS DOUBLE)",
        "score_distribution_z": s_round(f"ABS({s_round(_MEAN, 4)} - (SELECT {_MEAN} FROM scored_m{_BASE})) / (SELECT STDDEV_POP({_P}) FROM scored_m{_BASE})", 4),
    }
    LAYERS[f"model_metrics_m{_back}"] = " UNION ALL ".join(
        f"SELECT MAX(run_date) AS run_date, '{n}' AS metric_name, {e} AS metric_value FROM scored_m{_back}" for n, e in _scores.items())
    LAYERS[f"run_m{_back}"] = f"""SELECT run_date, 'run-' || CAST(run_date AS VARCHAR) AS run_id, metric_name, metric_value, category FROM (
        SELECT *, 'data_drift' AS category FROM data_metrics_m{_back} UNION ALL SELECT *, 'model_drift' FROM model_metrics_m{_back}) x"""

query("k1_data_drift", "SELECT feature, current_mean, z, drifted FROM drift_m0")(
    lambda r: D.feature_drift(newest_rows(r), S.feature_baseline(baseline_rows(r))))
query("k1_data_drift_metrics", "SELECT metric_name, metric_value FROM data_metrics_m0")(
    lambda r: D.data_drift_metrics(D.feature_drift(newest_rows(r), S.feature_baseline(baseline_rows(r)))))
query("k2_model_drift", "SELECT metric_name, metric_value FROM model_metrics_m0")(
    lambda r: D.model_drift_metrics(newest_rows(r), S.score_baseline(baseline_rows(r)), r.scratch))
_BUCKET = " + ".join(f"CASE WHEN {_P} > d{i} THEN 1 ELSE 0 END" for i in range(1, 10))
query("k3_population_stability", f"""WITH deciles AS (SELECT {", ".join(f"quantile_cont({_P}, {i / 10}) AS d{i}" for i in range(1, 10))} FROM scored_m{_BASE}),
    before AS (SELECT {_BUCKET} AS bucket, CAST(COUNT(*) AS DOUBLE) / (SELECT COUNT(*) FROM scored_m{_BASE}) AS a FROM scored_m{_BASE}, deciles GROUP BY 1),
    after AS (SELECT {_BUCKET} AS bucket, CAST(COUNT(*) AS DOUBLE) / (SELECT COUNT(*) FROM scored_m0) AS b FROM scored_m0, deciles GROUP BY 1),
    both_sides AS (SELECT GREATEST(COALESCE(a, 0), 0.0001e0) AS a, GREATEST(COALESCE(b, 0), 0.0001e0) AS b
        FROM before FULL OUTER JOIN after ON before.bucket = after.bucket)
    SELECT {s_round("SUM((b - a) * LN(b / a))", 6)} AS psi, SUM((b - a) * LN(b / a)) > 0.2 AS alert FROM both_sides""")(
    lambda r: D.population_stability(baseline_rows(r), newest_rows(r), r.scratch))


def runs(r):
    return D.runs_over_time(run_rows(r), S.feature_baseline(baseline_rows(r)), S.score_baseline(baseline_rows(r)), r.scratch)


def history(r):
    """The stored metric history: each run is appended on its own, oldest first, as a scheduler would do it."""
    path = f"{r.lake.root}/monitoring"
    if not is_complete(r.spark, path):
        made = r.scratch.write(runs(r))
        for day in sorted(row[0] for row in made.select("run_date").distinct().collect()):
            D.append_metrics(made.filter(F.col("run_date") == F.lit(day)), path)
    return r.spark.read.parquet(path)


_HISTORY = " UNION ALL ".join(f"SELECT * FROM run_m{b}" for b in _RUNS)
query("k5_metric_history", _HISTORY)(history)
query("g13_mart_monitoring", _HISTORY)(runs)
query("k6_latest_run", "SELECT * FROM run_m0")(lambda r: D.latest_run(history(r)))
query("k6_latest_value", "SELECT category, metric_name, metric_value FROM run_m0")(lambda r: D.latest_value(history(r)))
query("k6_sorted_log", _HISTORY)(lambda r: D.sorted_log(history(r)))
