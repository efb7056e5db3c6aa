"""Ordering, skew, gap and quantile operators against brute force, with hot keys; and the shape of their plans."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyline.functions import exprs as X
from tallyline.operators import checks as C
from tallyline.operators import gaps, ordering, quantiles, skew
from tallyline.plans import analytics, clustering, scoring


@pytest.fixture(scope="module")
def hot(spark):
    """3,000 rows; one key and one value hold 40 % of them."""
    rng = random.Random(3)
    rows = [(i, "hot" if rng.random() < 0.4 else f"k{rng.randrange(60)}", 1 if rng.random() < 0.4 else rng.randrange(500),
             rng.randrange(90)) for i in range(3000)]
    return spark.createDataFrame(rows, "id bigint, key string, v bigint, day int").repartition(5).persist()


def as_dict(df, key, value):
    return {r[key]: r[value] for r in df.collect()}


def test_row_number_and_running_sum_equal_the_window(hot, scratch):
    w = Window.orderBy(F.desc("v"), "id")
    expected = hot.withColumn("rn", F.row_number().over(w)).withColumn("rs", F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    got = ordering.global_running_sum(hot, [F.desc("v"), F.asc("id")], {"rs": "v"}, scratch, "rn")
    assert as_dict(got, "id", "rn") == as_dict(expected, "id", "rn")
    assert as_dict(got, "id", "rs") == as_dict(expected, "id", "rs")
    numbered = ordering.global_row_number(hot, [F.desc("v"), F.asc("id")], scratch, "rn")
    assert as_dict(numbered, "id", "rn") == as_dict(expected, "id", "rn")


@pytest.mark.parametrize("n", [1, 3, 4, 7, 23, 1000])
def test_ntile_equals_the_window(spark, scratch, n):
    df = spark.range(n).withColumn("v", F.xxhash64("id"))
    expected = df.withColumn("b", F.ntile(5).over(Window.orderBy("v", "id")))
    assert as_dict(ordering.global_ntile(df, ["v", "id"], 5, scratch, "b"), "id", "b") == as_dict(expected, "id", "b")


def test_cume_dist_equals_the_window(hot, scratch):
    expected = hot.withColumn("c", F.cume_dist().over(Window.orderBy("v")))
    assert as_dict(ordering.global_cume_dist(hot, "v", scratch, "c"), "id", "c") == as_dict(expected, "id", "c")


def test_global_order_plan_has_no_single_task_exchange(hot, scratch):
    placed = ordering.ordered(hot, ["v", "id"], scratch)
    plan = ordering.number_rows(placed)[0]._jdf.queryExecution().toString()
    assert "SinglePartition" not in plan
    sizes = [r["count"] for r in placed.groupBy("_pid").count().collect()]
    assert len(sizes) > 1 and max(sizes) < 0.6 * sum(sizes)


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("hot_list", [[], ["hot"], ["hot", "absent", "k1"]])
def test_spread_join_equals_the_plain_join(hot, spark, how, hot_list):
    keys = ["hot"] + [f"k{i}" for i in range(0, 60, 2)]
    dim = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "key string, sk int")
    expected = {(r["id"], r["sk"]) for r in hot.join(dim, "key", how).collect()}
    got = skew.spread_join(hot, dim, "key", how, hot_list)
    assert got.columns == ["key", "id", "v", "day", "sk"]
    assert {(r["id"], r["sk"]) for r in got.collect()} == expected


def test_spread_join_keeps_null_keys(spark):
    left = spark.createDataFrame([(1, None), (2, "a"), (3, "b")], "id int, key string")
    dim = spark.createDataFrame([("a", 10)], "key string, sk int")
    assert as_dict(skew.spread_join(left, dim, "key", "left", ["a"]), "id", "sk") == {1: None, 2: 10, 3: None}


def test_hot_values_finds_only_the_hot_one(spark):
    df = spark.range(20_000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("key"))
    assert skew.hot_values(df, "key")["key"] == ["hot"]


def test_hot_rows_spread_over_the_shuffle(spark):
    left = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("key"), "id")
    dim = left.select("key").distinct().withColumn("sk", F.xxhash64("key"))
    joined = skew.spread_join(left, dim.hint("shuffle_merge"), "key")
    sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    assert joined.count() == 30_000 and joined.filter("sk IS NULL").count() == 0
    assert max(sizes) < 0.5 * sum(sizes)


def test_scratch_clears_only_itself(spark):
    from tallyline.sources.lake import Scratch, path_exists
    other = Scratch(spark)
    other.write(spark.range(3))
    with Scratch(spark) as mine:
        assert mine.write(spark.range(5)).count() == 5
    assert not path_exists(spark, mine.root) and path_exists(spark, other.root)


def test_broadcast_only_when_small(spark):
    assert "broadcast" in skew.broadcast_if_small(spark.range(10), 10)._jdf.queryExecution().toString().lower()
    assert "broadcast" not in skew.broadcast_if_small(spark.range(11), 10)._jdf.queryExecution().toString().lower()


def test_event_gaps_equal_lag(hot, spark):
    events = hot.withColumn("at", (F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(
        F.col("day"), (F.col("v") % 24).cast("int"))).cast("timestamp_ntz"))
    w = Window.partitionBy("key").orderBy("at", "id")
    expected = events.select("key", (X.micros("at") - F.lag(X.micros("at")).over(w)).alias("g")).filter("g IS NOT NULL")
    got = gaps.event_gaps(events, "key", "at", "id")
    assert sorted((r["key"], r["gap_us"]) for r in got.collect()) == sorted((r["key"], r["g"]) for r in expected.collect())


def test_exact_quantiles_equal_numpy(hot, scratch):
    got = {r["key"]: r for r in quantiles.exact_quantiles(hot, ["key"], "v", {"a": 0.01, "b": 0.5, "c": 0.9}, scratch).collect()}
    by_key: dict[str, list[int]] = {}
    for r in hot.collect():
        by_key.setdefault(r["key"], []).append(r["v"])
    for key, values in by_key.items():
        assert got[key]["n"] == len(values)
        assert [got[key][q] for q in "abc"] == pytest.approx(list(np.quantile(values, [0.01, 0.5, 0.9])))
    whole = quantiles.exact_quantiles(hot, [], "v", {"m": 0.5}, scratch).first()
    assert whole["m"] == pytest.approx(float(np.median([v for vs in by_key.values() for v in vs])))


def test_top_percent_share_equals_sorting(spark, scratch):
    values = [100.0] * 7 + [50.0] * 30 + [1.0] * 163
    lines = spark.createDataFrame([(v, False) for v in values] + [(-900.0, True)], "line_amount double, is_cancellation boolean")
    got = {r["percent"]: (r["lines"], r["revenue_share"]) for r in analytics.top_percent_share(lines, scratch).collect()}
    for p in (1, 5, 10):
        n = len(values) * p // 100
        assert got[p] == (n, pytest.approx(sum(values[:n]) / sum(values), abs=1e-6))


def test_auc_and_threshold_against_brute_force(spark, scratch):
    rng = random.Random(5)
    rows = [(f"c{i}", round(rng.random(), 2), int(rng.random() < 0.4)) for i in range(400)]
    df = spark.createDataFrame(rows, "customer_id string, churn_probability double, churn int")
    pos, neg = [s for _, s, y in rows if y], [s for _, s, y in rows if not y]
    auc = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))
    assert scoring.area_under_roc(df, scratch).first()["auc_roc"] == pytest.approx(auc)

    def f1(t):
        tp = sum(s >= t for s in pos)
        return 2 * tp / (sum(s >= t for _, s, _ in rows) + len(pos))
    best = max(sorted({s for _, s, _ in rows}), key=f1)
    got = scoring.best_threshold(df, scratch).first()
    assert (got["threshold"], got["f1_churn"]) == (best, pytest.approx(f1(best)))
    halves = df.withColumn("half", F.when(F.col("customer_id").endswith("1"), "a").otherwise("b"))
    per = as_dict(scoring.area_under_roc(halves, scratch, groups=["half"]), "half", "auc_roc")
    for name in "ab":
        part = [(s, y) for c, s, y in rows if (c.endswith("1")) == (name == "a")]
        p2, n2 = [s for s, y in part if y], [s for s, y in part if not y]
        assert per[name] == pytest.approx(sum((p > q) + 0.5 * (p == q) for p in p2 for q in n2) / (len(p2) * len(n2)))
    empty = df.filter("false")
    assert scoring.best_threshold(empty, scratch).first()["threshold"] == 0.5


def test_generic_checks(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c")], "k int, v string")
    assert C.not_null(df, "k").count() == 1
    assert [tuple(r) for r in C.unique(df, "k").collect()] == [(1, 2)]
    assert [r["v"] for r in C.accepted_values(df, "v", ["a", "b"]).collect()] == ["c"]
    assert C.relationships(df, "k", spark.createDataFrame([(2,)], "id int"), "id").count() == 1


def test_segment_label_of_all_pairs(spark):
    pairs = spark.createDataFrame([(r, f) for r in range(1, 6) for f in range(1, 6)], "r int, f int")
    labels = {(r["r"], r["f"]): r["s"] for r in pairs.withColumn("s", X.segment_label("r", "f")).collect()}
    assert labels[(5, 5)] == "Champions" and labels[(1, 1)] == "Lost" and labels[(2, 2)] == "At Risk"
    assert {p for p, s in labels.items() if s == "Need Attention"} == {(5, 3), (4, 2), (3, 2)}
    assert len(set(labels.values())) == 11


def test_cluster_names_get_letters(spark):
    wanted = ("recency_days", "frequency", "monetary", "monetary_trend", "tenure_days", "cancellation_rate", "return_quantity_rate")
    rows = [(i, *[0.0] * len(wanted)) for i in range(3)] + [(3, 60.0, -30.0, 0.0, 0.0, 0.0, 0.0, 0.0), (4, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 80.0)]
    profile = spark.createDataFrame(rows, "cluster_id int, " + ", ".join(f"{c}_rel_pct double" for c in wanted))
    assert as_dict(clustering.name_clusters(profile), "cluster_id", "cluster_name") == {
        0: "Average Regulars A", 1: "Average Regulars B", 2: "Average Regulars C", 3: "Dormant", 4: "High-Return / Problematic"}


def test_safe_divide(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 0.0), (None, 1.0), (float("nan"), 1.0)], "a double, b double")
    assert [r[0] for r in df.select(X.safe_divide("a", "b", -1.0)).collect()] == [0.5, -1.0, -1.0, -1.0]


def test_ntiles_by_value_equal_window(spark, scratch):
    rows = [(f"k{i:04}", (i * 7) % 5, float(i % 90), i // 100) for i in range(403)]
    df = scratch.write(spark.createDataFrame(rows, "id string, few int, many double, blocks int"))
    wanted = {"a": ("few", True), "b": ("many", False), "c": ("blocks", False)}
    for buckets in (5, 7, 1, 1000):
        got = {r["id"]: (r["a"], r["b"], r["c"]) for r in ordering.ntiles_by_value(df, "id", wanted, buckets, scratch).collect()}
        tiles = [F.ntile(buckets).over(Window.orderBy(F.desc(c) if down else F.asc(c), "id")).alias(n) for n, (c, down) in wanted.items()]
        assert got == {r["id"]: (r["a"], r["b"], r["c"]) for r in df.select("id", *tiles).collect()}


def test_distinct_counts_without_expand(spark):
    from tallyline.operators.distinct import with_distinct_counts
    rows = [("g", 1, "x", True), ("g", 1, "y", False), ("g", 2, None, True), (None, 3, "x", None), (None, None, "x", True), ("h", None, None, None)]
    df = spark.createDataFrame(rows, "k string, a int, b string, f boolean")
    counts = {"n_a": ("a", None), "n_af": ("a", F.col("f")), "n_b": ("b", None), "n_bf": ("b", F.col("f"))}
    out = with_distinct_counts(df, ["k"], [F.count(F.lit(1)).alias("n")], counts)
    exact = df.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("a").alias("n_a"), F.count_distinct(F.when(F.col("f"), F.col("a"))).alias("n_af"),
                                F.count_distinct("b").alias("n_b"), F.count_distinct(F.when(F.col("f"), F.col("b"))).alias("n_bf"))
    key = lambda r: str(r["k"])
    assert sorted(out.collect(), key=key) == sorted(exact.select(out.columns).collect(), key=key)
    assert "Expand" not in out._jdf.queryExecution().executedPlan().toString()
    none = with_distinct_counts(df.filter("a > 9"), [], [F.count(F.lit(1)).alias("n")], counts).first()
    assert tuple(none) == (0, 0, 0, 0, 0)


def test_range_parts_follow_bytes(spark, monkeypatch):
    df = spark.range(1000)
    assert ordering.range_parts(df) == 4
    monkeypatch.setattr(ordering, "PART_BYTES", 500)
    assert ordering.range_parts(df) == 16 and ordering.range_parts(df.crossJoin(df.crossJoin(df.crossJoin(df.crossJoin(df))))) in (4, ordering.MAX_PARTS)


def test_range_parts_of_a_join_follow_the_tables_read(spark, scratch, monkeypatch):
    left = scratch.write(spark.range(20_000).select("id", F.xxhash64("id").alias("a")).coalesce(1))
    right = scratch.write(spark.range(20_000).select("id", F.xxhash64("id").alias("b")).coalesce(1))
    monkeypatch.setattr(ordering, "PART_BYTES", 50_000)
    joined = left.join(right, "id", "left")
    assert max(ordering.range_parts(left), 4) <= ordering.range_parts(joined) <= 2 * max(ordering.range_parts(left), ordering.range_parts(right))
    numbered = ordering.global_row_number(joined, [F.asc("a"), F.asc("id")], scratch, "rn")
    assert [r[0] for r in numbered.orderBy("a", "id").select("rn").collect()] == list(range(1, 20_001))


def test_kmeans_fits_each_run_once_on_rows_it_keeps_itself(spark, monkeypatch):
    from pyspark.ml.linalg import Vectors
    rng = random.Random(5)
    rows = [(f"c{i}", Vectors.dense([10.0 * (i % 3) + rng.random(), 10.0 * (i % 3 == 1) + rng.random()])) for i in range(90)]
    scaled = spark.createDataFrame(rows, ["customer_id", "scaled"]).repartition(3, "customer_id").persist()
    fitted = []

    def kmeans(k, seed, max_iter, made=clustering._kmeans):
        estimator = made(k, seed, max_iter)
        monkeypatch.setattr(estimator, "fit", lambda df, fit=estimator.fit: fitted.append((k, seed, df.storageLevel.useMemory)) or fit(df))
        return estimator

    expected = {k: min((clustering._kmeans(k, clustering.SEED + i, 20).fit(scaled).summary.trainingCost for i in range(2))) for k in (3, 4)}
    monkeypatch.setattr(clustering, "_kmeans", kmeans)
    results = clustering.search_k(scaled, range(3, 5), 2, 20)
    assert sorted(fitted) == [(k, clustering.SEED + i, False) for k in (3, 4) for i in range(2)]
    assert {k: cost for k, cost, _ in results} == pytest.approx(expected, rel=1e-9) and clustering.best_k(results) == 3
    scaled.unpersist()
