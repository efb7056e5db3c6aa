"""Runs of K-means that share their passes, against MLlib's own."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors

from tallyline.plans import clustering as K


@pytest.fixture(scope="module")
def scaled(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(300, 4)) + 3.0 * rng.integers(0, 4, (300, 1))
    return spark.createDataFrame([(f"c{i}", Vectors.dense(row)) for i, row in enumerate(x)], ["customer_id", "scaled"]).repartition(3, "customer_id")


def test_runs_end_where_mllib_ends(scaled):
    for limit in (2, 300):
        got = K.fit_all(scaled, [3, 4], 2, limit)
        for k in (3, 4):
            own = min((K._kmeans(k, K.SEED + i, limit).fit(K.fitting_rows(scaled)) for i in range(2)), key=lambda m: m.summary.trainingCost)
            cost, model = got[k]
            assert cost == pytest.approx(own.summary.trainingCost, rel=1e-9) and np.allclose(model.clusterCenters(), own.clusterCenters())
            both = [{r["customer_id"]: r["cluster_id"] for r in m.transform(scaled).collect()} for m in (own, model)]
            assert both[0] == both[1]


def test_all_runs_share_a_pass(scaled, monkeypatch):
    passes = []
    real = K.lloyd
    monkeypatch.setattr(K, "lloyd", lambda blocks, centres, *more: passes.append(len(centres)) or real(blocks, centres, *more))
    K.search_k(scaled, range(3, 6), 2, 5)
    assert passes == [6]


def test_a_centre_without_rows_stays(spark):
    x = np.array([[0.0, 0.0], [0.0, 2.0]])
    blocks = spark.sparkContext.parallelize([x.tobytes(), x.tobytes()], 2)
    (centres, cost), = K.lloyd(blocks, [np.array([[0.0, 0.0], [9.0, 9.0]])], 5, 1e-4)
    assert centres.tolist() == [[0.0, 1.0], [9.0, 9.0]] and cost == 4.0
