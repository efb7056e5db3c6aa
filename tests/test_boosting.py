"""Boosted trees: growing, search, storage, gate, and attribution against enumeration."""

from __future__ import annotations

from itertools import combinations
from math import factorial

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallyline.plans import boosting as B
from tallyline.plans import churn as M
from tallyline.plans import scoring as S
from tallyline.schemas import FEATURE_COLUMNS

PARAMS = {"max_depth": 4, "n_trees": 40, "learning_rate": 0.1, "min_gain": 0.0, "min_child_weight": 1, "row_share": 0.8, "column_share": 1.0}


def small_model(n=400, width=6, seed=1, params=PARAMS):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, width)), 1)
    y = ((x[:, 0] + x[:, 1] * x[:, 2] + 0.3 * rng.normal(size=n)) > 0).astype(float)
    cuts = [B.quantile_cuts(c) for c in x.T]
    codes = np.stack([np.searchsorted(c, x[:, k], "left") for k, c in enumerate(cuts)], 1).astype(np.uint8)
    trees, auc = B.grow(codes[:300], y[:300], np.ones(300), (codes[300:], y[300:]), params, 3)
    return x, y, B._joined(trees, cuts), auc, sum(B._apply(t, codes) for t in trees)


def test_trees_learn_and_bins_equal_thresholds():
    x, y, trees, auc, by_bins = small_model()
    assert auc > 0.9 and np.allclose(trees.margins(x), by_bins)
    assert B.area_under_curve(y[300:], trees.margins(x[300:])) == pytest.approx(auc)


def test_area_under_curve_equals_pairs():
    rng = np.random.default_rng(4)
    y, s = rng.integers(0, 2, 60), rng.integers(0, 8, 60)
    pairs = [(s[i] > s[j]) + 0.5 * (s[i] == s[j]) for i in range(60) for j in range(60) if y[i] == 1 and y[j] == 0]
    assert B.area_under_curve(y, s) == pytest.approx(np.mean(pairs)) and B.area_under_curve(np.ones(3), np.arange(3)) == 0.5


def test_first_split_is_the_best_of_all():
    x, y, trees, *_ = small_model(params=PARAMS | {"n_trees": 1, "row_share": 1.0, "max_depth": 1})
    g, h = 0.5 - y[:300], np.full(300, 0.25)
    def score(side):
        return g[side].sum() ** 2 / (h[side].sum() + 1)
    gains = {(k, c): score(x[:300, k] <= c) + score(x[:300, k] > c) - score(np.ones(300, bool)) for k in range(6) for c in np.unique(x[:, k])[:-1]
             if min(h[x[:300, k] <= c].sum(), h[x[:300, k] > c].sum()) >= 1}
    root = trees.roots[0]
    best = max(gains.values())
    assert trees.gain[root] >= 0.95 * best and trees.gain[root] == pytest.approx(gains[trees.feature[root], trees.threshold[root]])


def known_value(trees, row, known):
    """The margin when only the features in ``known`` are known: other splits are followed by cover."""
    def down(node):
        f = trees.feature[node]
        if f < 0:
            return trees.value[node]
        left, right = trees.left[node], trees.right[node]
        if f in known:
            return down(left if row[f] <= trees.threshold[node] else right)
        return (trees.cover[left] * down(left) + trees.cover[right] * down(right)) / trees.cover[node]
    return sum(down(root) for root in trees.roots)


def test_shapley_values_equal_enumeration():
    x, _, trees, *_ = small_model(params=PARAMS | {"n_trees": 8, "max_depth": 5})
    got = B.shapley_values(B.leaf_tables(trees), x[:12])
    assert B.expected_margin(trees) == pytest.approx(known_value(trees, x[0], set()))
    for row, values in zip(x[:12], got, strict=True):
        for k in range(6):
            others = [f for f in range(6) if f != k]
            exact = sum(factorial(n) * factorial(5 - n) / factorial(6) * (known_value(trees, row, {*s, k}) - known_value(trees, row, set(s)))
                        for n in range(6) for s in combinations(others, n))
            assert values[k] == pytest.approx(exact, abs=1e-9)


@pytest.fixture(scope="module")
def labelled(spark):
    """Customers whose label follows two features, with missing values."""
    rng = np.random.default_rng(9)
    data = pd.DataFrame({c: rng.normal(size=500).round(2) for c in FEATURE_COLUMNS})
    data["churn"] = ((data["recency_days"] - data["frequency"] + 0.5 * rng.normal(size=500)) > 0).astype(int)
    data.loc[::7, "monetary"] = None
    data.insert(0, "customer_id", [f"c{k}" for k in range(500)])
    return spark.createDataFrame(data)


@pytest.fixture(scope="module")
def model(labelled):
    return M.train_boosted(labelled, M.search_candidates(4), folds=3)


def test_search_measures_every_candidate_and_fold(spark, labelled, model, tmp_path):
    assert model.figures["fits"] == 12 and model.figures["cv_auc"] > 0.85 and set(model.params) == set(M.SEARCH_SPACE)
    again = M.train_boosted(labelled.repartition(7), M.search_candidates(4), folds=3)
    assert again.figures == model.figures and np.array_equal(again.trees.value, model.trees.value)
    model.save(spark, str(tmp_path / "m"))
    back = B.BoostedModel.load(spark, str(tmp_path / "m"))
    assert back.params == model.params and back.figures == model.figures and back.medians == model.medians
    assert all(np.array_equal(getattr(back.trees, n), getattr(model.trees, n)) for n in B.Trees.__dataclass_fields__)


def test_scores_and_contributions_of_all_customers(labelled, model, scratch):
    scored = M.probabilities(model, labelled)
    assert S.area_under_roc(scored, scratch).first()["auc_roc"] > 0.9
    each = M.shapley(model, labelled)
    sums = each.groupBy("customer_id").agg((F.sum("contribution") + F.first("expected_value")).alias("total"), F.first("margin").alias("margin"))
    both = sums.join(scored, "customer_id").select(F.abs(F.col("total") - F.col("margin")).alias("d"),
                                                   F.abs(1 / (1 + F.exp(-F.col("margin"))) - F.col("churn_probability")).alias("p"))
    worst = both.agg(F.max("d"), F.max("p"), F.count("*")).first()
    assert worst[0] < 1e-9 and worst[1] < 1e-12 and worst[2] == 500
    top = M.shapley_importance(each).orderBy(F.desc("mean_abs_shap")).limit(2).collect()
    assert {r["feature"] for r in top} == {"recency_days", "frequency"}
    assert M.shapley_drivers(each, 3).count() == 1500


def test_training_matrix_is_bounded(labelled):
    drawn = B.training_matrix(labelled, "customer_id", most=100)
    assert 50 < len(drawn) <= 100
    pd.testing.assert_frame_equal(drawn, B.training_matrix(labelled.repartition(5), "customer_id", most=100))


def test_gate_holds_a_model_back(spark, labelled, scratch, tmp_path):
    small = {k: v[:1] for k, v in M.SEARCH_SPACE.items()}
    good = M.run_training(labelled, scratch, n_candidates=1, folds=2, space=small)
    assert good["gate_passed"] and good["released"] and good["baseline"].count() == 33
    M.publish_model(good, spark, str(tmp_path / "good"))
    assert spark.read.parquet(str(tmp_path / "good" / "baseline")).count() == 33
    noise = labelled.withColumn("churn", (F.crc32(F.col("customer_id").cast("binary")) % 2).cast("int"))
    bad = M.run_training(noise, scratch, n_candidates=1, folds=2, space=small)
    assert not bad["gate_passed"] and not bad["released"] and bad["baseline"] is None
    with pytest.raises(S.GateFailed):
        M.publish_model(bad, spark, str(tmp_path / "bad"))
    assert M.run_training(noise, scratch, n_candidates=1, folds=2, space=small, enforce=False)["baseline"].count() == 33


def test_medians_fill_exactly(spark, scratch):
    df = spark.createDataFrame([(1, 1.0, None), (2, None, None), (3, 4.0, None), (4, 3.0, None), (5, 2.0, None)], "k int, a double, b double")
    assert sorted(tuple(r) for r in M.median_filled(df, ["a", "b"], scratch).collect()) == [(1, 1.0, 0.0), (2, 2.5, 0.0), (3, 4.0, 0.0), (4, 3.0, 0.0), (5, 2.0, 0.0)]


def test_a_tree_holds_no_wide_table_of_whole_rows():
    import tracemalloc
    rng = np.random.default_rng(2)
    codes = rng.integers(0, B.BINS, (20_000, 32)).astype(np.uint8)
    g, h = rng.normal(size=20_000), np.full(20_000, 0.25)
    tracemalloc.start()
    nodes = B._tree(codes, g, h, PARAMS | {"row_share": 1.0}, rng)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 8 * codes.size and len(nodes) > 1
    left = codes[:, nodes[0][0]] <= nodes[0][1]
    assert nodes[nodes[0][2]][5] == pytest.approx(h[left].sum()) and nodes[nodes[0][3]][5] == pytest.approx(h[~left].sum())


def test_explained_rows_of_one_file_are_spread(spark):
    x, _, trees, *_ = small_model()
    names = tuple(f"f{k}" for k in range(6))
    model = B.BoostedModel(names, (0.0,) * 6, trees, {}, {})
    df = spark.createDataFrame([(f"c{i}", *map(float, row)) for i, row in enumerate(x)], ["customer_id", *names]).coalesce(1)
    found = model.contributions(df, "customer_id")
    assert found.rdd.getNumPartitions() > 1
    sums = found.groupBy("customer_id").agg(F.sum("contribution").alias("c"), F.first("expected_value").alias("e"), F.first("margin").alias("m")).collect()
    assert len(sums) == len(x) and np.allclose([r["c"] + r["e"] for r in sums], [r["m"] for r in sums])


def test_models_are_trained_on_all_rows(spark):
    n = 200_400
    rows = spark.range(n).select(F.format_string("c%07d", "id").alias("customer_id"), F.when(F.col("id") % 11 != 0, (F.col("id") * 7919 % n).cast("double")).alias("a"),
                                 (F.col("id") % 5).cast("double").alias("b"), (F.col("id") * 7919 % n >= n // 2).cast("double").alias("label"),
                                 F.lit(1.0).alias("class_weight"), (F.col("id") % 2).cast("int").alias("fold"), (F.col("id") % 10 == 0).alias("hold_out"))
    stump = PARAMS | {"n_trees": 1, "max_depth": 1, "row_share": 1.0}
    model = B.search(rows, "customer_id", ["a", "b"], [stump], 2, 1)
    assert model.figures["rows"] == n and model.trees.cover[0] == pytest.approx(0.25 * n * 0.9) and model.figures["hold_out_auc"] > 0.9


def test_cuts_of_a_table_are_those_of_its_columns(spark, scratch):
    rng = np.random.default_rng(3)
    data = pd.DataFrame({"a": rng.normal(size=777), "b": rng.integers(0, 64, 777) * 1.0, "c": rng.integers(0, 70, 777) * 1.0,
                         "d": np.where(rng.random(777) < 0.9, 0.0, rng.normal(size=777)), "e": 2.5})
    for n in (777, 65, 2, 1):
        got = B.table_cuts(scratch.write(spark.createDataFrame(data.head(n))), list(data.columns), scratch)
        assert all(np.array_equal(x, B.quantile_cuts(data[c].head(n).to_numpy())) for c, x in zip(data.columns, got, strict=True))


def test_rows_read_in_blocks_give_the_same_trees(monkeypatch):
    whole = small_model()[2]
    monkeypatch.setattr(B, "BLOCK", 64)
    blocks = small_model()[2]
    assert np.array_equal(whole.feature, blocks.feature) and np.allclose(whole.value, blocks.value)
