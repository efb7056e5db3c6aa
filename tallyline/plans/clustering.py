"""Customer segmentation by K-means: preparation, choice of k, quality measures, profiles and names."""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
from pyspark import RDD, SparkContext, StorageLevel, cloudpickle, inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import Imputer, SQLTransformer, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.mllib.common import _py2java
from pyspark.mllib.linalg import Vectors as OldVectors
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyline.functions import exprs as X
from tallyline.schemas import FEATURE_COLUMNS, SKEWED_FEATURES

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SEED = 42
K_RANGE = range(3, 9)


def _numeric(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in FEATURE_COLUMNS})


def fit_preparation(features: DataFrame) -> PipelineModel:
    """Median imputation, log1p of the skewed features, standardised vector ``scaled``."""
    filled = [f"{c}_filled" for c in FEATURE_COLUMNS]
    logs = SQLTransformer(statement="SELECT *, " + ", ".join(
        f"ln(1 + greatest({c}_filled, 0)) AS {c}_log" for c in SKEWED_FEATURES) + " FROM __THIS__")
    shaped = [f"{c}_log" if c in SKEWED_FEATURES else f"{c}_filled" for c in FEATURE_COLUMNS]
    return Pipeline(stages=[
        Imputer(strategy="median", inputCols=list(FEATURE_COLUMNS), outputCols=filled), logs,
        VectorAssembler(inputCols=shaped, outputCol="shaped"),
        StandardScaler(inputCol="shaped", outputCol="scaled", withMean=True, withStd=True)]).fit(_numeric(features))


def prepare(preparation: PipelineModel, features: DataFrame) -> DataFrame:
    return preparation.transform(_numeric(features)).select(*features.columns, "scaled")


def _kmeans(k: int, seed: int, max_iter: int) -> KMeans:
    return KMeans(featuresCol="scaled", predictionCol="cluster_id", k=k, seed=seed, maxIter=max_iter, initMode="k-means||")


def fitting_rows(scaled: DataFrame) -> DataFrame:
    """The vectors of a kept table that has other columns too, as a table that is not itself marked as kept.

    MLlib then holds the vectors of a fit as objects. On a table marked as kept it decodes every row anew in each iteration.
    """
    return scaled.select("scaled")


BLOCK = 2048  # vectors of a block: its distances to the centres of all runs lie in a processor's caches


def vector_blocks(rows: DataFrame) -> RDD:
    """The vectors as kept blocks of ``BLOCK`` rows of doubles, so that one pass over them serves many runs."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                blocks = [x[s:s + BLOCK].tobytes() for s in range(0, len(x), BLOCK)]
                yield pa.RecordBatch.from_arrays([pa.array(blocks, pa.binary())], ["block"])
    return rows.select(vector_to_array("scaled")).mapInArrow(pack, "block binary").rdd.map(lambda r: bytes(r[0])).persist(StorageLevel.MEMORY_AND_DISK)


def lloyd_sums(blocks: Iterable[bytes], centres: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(summed vectors and number of rows by centre, cost by run) of one pass over the rows, for all runs at once."""
    stacked = np.concatenate(centres)
    ends = np.cumsum([len(c) for c in centres])
    starts, half = ends - [len(c) for c in centres], (stacked ** 2).sum(1) / 2
    sums, counts, costs = np.zeros(stacked.shape), np.zeros(len(stacked)), np.zeros(len(centres))
    for block in blocks:
        x = np.frombuffer(block).reshape(-1, stacked.shape[1])
        far = half[:, None] - stacked @ x.T  # half the squared distance, less half the squared length of the row
        own = np.empty(far.shape)
        lengths = (x ** 2).sum()
        for run, (s, e) in enumerate(zip(starts, ends, strict=True)):
            least = far[s:e].min(0)
            np.equal(far[s:e], least, out=own[s:e], casting="unsafe")
            if own[s:e].sum() != len(x):  # the first of equally near centres has the row
                own[s:e] = 0.0
                own[far[s:e].argmin(0) + s, np.arange(len(x))] = 1.0
            costs[run] += max(2 * least.sum() + lengths, 0.0)
        sums += own @ x
        counts += own.sum(1)
    return sums, counts, costs


def lloyd(blocks: RDD, centres: list[np.ndarray], max_iter: int, tolerance: float) -> list[tuple[np.ndarray, float]]:
    """(centres, cost) of each run from its first centres, as MLlib's iterations give them but for rounding.

    All runs share the passes over the rows; a run whose centres have all moved by at most ``tolerance`` leaves them. A centre
    without rows stays. The cost is that of the last pass, to the centres before they moved.
    """
    out = [(c, 0.0) for c in centres]
    going = list(range(len(centres)))
    for _ in range(max_iter):
        if not going:
            break
        now = [out[i][0] for i in going]
        sent = blocks.context.broadcast(now)
        parts = blocks.mapPartitions(lambda part, sent=sent: [lloyd_sums(part, sent.value)]).collect()
        sent.destroy()
        sums, counts, costs = (sum(p[j] for p in parts) for j in range(3))
        still, at = [], 0
        for i, old, cost in zip(going, now, costs, strict=True):
            n = counts[at:at + len(old), None]
            new = np.where(n > 0, sums[at:at + len(old)] / np.maximum(n, 1), old)
            at += len(old)
            out[i] = (new, float(cost))
            if (((new - old) ** 2).sum(1) > tolerance ** 2).any():
                still.append(i)
        going = still
    return out


def with_centres(first: KMeansModel, centres: np.ndarray) -> KMeansModel:
    """A model like ``first`` with other centres."""
    context = SparkContext._active_spark_context
    jvm, vectors = context._jvm, context._jvm.java.util.ArrayList()
    for c in centres:
        vectors.add(_py2java(context, OldVectors.dense(c)))
    java = jvm.org.apache.spark.ml.clustering.KMeansModel(first.uid, jvm.org.apache.spark.mllib.clustering.KMeansModel(vectors))
    return first._copyValues(KMeansModel(java))


def fit_all(scaled: DataFrame, ks: Iterable[int], runs: int = 10, max_iter: int = 300, parallelism: int = 5) -> dict[int, tuple[float, KMeansModel]]:
    """Per k (cost, model) of the cheapest of several seeded runs, the first among equals.

    MLlib chooses the first centres of each run, runs side by side; the iterations of all runs are one pass over the rows each.
    """
    rows = fitting_rows(scaled)
    todo = [(k, i) for k in ks for i in range(runs)]
    fit = inheritable_thread_target(scaled.sparkSession)(lambda run: _kmeans(run[0], SEED + run[1], 0).fit(rows))
    with ThreadPool(min(parallelism, len(todo))) as pool:
        first = pool.map(fit, todo, chunksize=1)
    blocks = vector_blocks(rows)
    fitted = lloyd(blocks, [np.array(m.clusterCenters()) for m in first], max_iter, first[0].getTol())
    blocks.unpersist()
    best: dict[int, tuple[float, int]] = {}
    for at, ((k, _), (_, cost)) in enumerate(zip(todo, fitted, strict=True)):
        if k not in best or cost < best[k][0]:
            best[k] = (cost, at)
    return {k: (cost, with_centres(first[at], fitted[at][0])) for k, (cost, at) in best.items()}


def fit_kmeans(scaled: DataFrame, k: int, runs: int = 10, max_iter: int = 300, parallelism: int = 5) -> KMeansModel:
    return fit_all(scaled, [k], runs, max_iter, parallelism)[k][1]


def judged(scaled: DataFrame, models: dict[int, tuple[float, KMeansModel]]) -> list[tuple[int, float, float]]:
    """(k, cost, silhouette) per k. MLlib's silhouette uses squared distances and is linear in the rows."""
    judge = ClusteringEvaluator(featuresCol="scaled", predictionCol="cluster_id", metricName="silhouette")
    return [(k, cost, float(judge.evaluate(m.transform(scaled)))) for k, (cost, m) in models.items()]


def search_k(scaled: DataFrame, ks: range = K_RANGE, runs: int = 10, max_iter: int = 300) -> list[tuple[int, float, float]]:
    return judged(scaled, fit_all(scaled, ks, runs, max_iter))


def best_k(results: list[tuple[int, float, float]]) -> int:
    return max(results, key=lambda r: r[2])[0]


def separation(assigned: DataFrame, columns: list[str]) -> DataFrame:
    """Calinski-Harabasz and Davies-Bouldin of a cluster assignment over numeric columns.

    Two passes over the rows: centroids, then distances to them. Only k centroids are ever brought together.
    """
    k_rows = assigned.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(f"_c_{c}") for c in columns])
    overall = assigned.agg(*[F.avg(c).alias(f"_o_{c}") for c in columns])
    centroids = F.broadcast(k_rows)

    def squared(left: str, right: str) -> Column:
        total = F.lit(0.0)
        for c in columns:
            total = total + (F.col(f"{left}{c}") - F.col(f"{right}{c}")) ** 2
        return total

    within = assigned.join(centroids, "cluster_id").groupBy("cluster_id").agg(
        F.sum(squared("", "_c_")).alias("ss"), F.avg(F.sqrt(squared("", "_c_"))).alias("scatter"))
    spread = within.agg(F.sum("ss").alias("within"))
    between = k_rows.crossJoin(F.broadcast(overall)).agg(
        F.sum(F.col("n") * squared("_c_", "_o_")).alias("between"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("k"))
    ch = spread.crossJoin(F.broadcast(between)).select(
        X.ratio(F.col("between") * (F.col("n") - F.col("k")), F.col("within") * (F.col("k") - 1)).alias("calinski_harabasz"))
    mine = k_rows.join(F.broadcast(within), "cluster_id").select("cluster_id", "scatter", *[f"_c_{c}" for c in columns])
    theirs = mine.select(F.col("cluster_id").alias("_id"), F.col("scatter").alias("_scatter"),
                         *[F.col(f"_c_{c}").alias(f"_d_{c}") for c in columns])
    pairs = mine.join(F.broadcast(theirs), F.col("cluster_id") != F.col("_id"))
    worst = pairs.groupBy("cluster_id").agg(F.max(
        X.ratio(F.col("scatter") + F.col("_scatter"), F.sqrt(squared("_c_", "_d_")))).alias("r"))
    return ch.crossJoin(F.broadcast(worst.agg(F.avg("r").alias("davies_bouldin"))))


def vector_columns(df: DataFrame, vector: str, size: int) -> tuple[DataFrame, list[str]]:
    """A vector column as plain double columns."""
    names = [f"v{i}" for i in range(size)]
    values = vector_to_array(vector)
    return df.withColumns({name: values[i] for i, name in enumerate(names)}), names


def profiles(assigned: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Per cluster: feature means, deviation from the overall mean in percent (NULL if that is 0), size and share."""
    columns = columns or FEATURE_COLUMNS
    per = assigned.groupBy("cluster_id").agg(
        *[F.avg(c).alias(c) for c in columns], F.count(F.lit(1)).alias("cluster_size"))
    overall = assigned.agg(*[F.avg(c).alias(f"_o_{c}") for c in columns],
                           F.count(F.lit(1)).alias("_n"))
    relative = [X.ratio((F.col(c) - F.col(f"_o_{c}")) * 100, f"_o_{c}").alias(f"{c}_rel_pct") for c in columns]
    return per.crossJoin(F.broadcast(overall)).select(
        "cluster_id", *columns, *relative, "cluster_size", X.ratio(F.col("cluster_size") * 100, "_n").alias("cluster_pct"))


# Naming rules in order of precedence. A rule compares relative deviations with bounds.
NAMING_RULES = [
    ("High-Value Active", [("monetary", ">", 50), ("frequency", ">", 30), ("recency_days", "<", -20)], "all"),
    ("Declining Premium", [("monetary", ">", 30), ("monetary_trend", "<", -30)], "all"),
    ("Dormant", [("recency_days", ">", 50), ("frequency", "<", -20)], "all"),
    ("New / One-Time Buyers", [("tenure_days", "<", -30), ("frequency", "<", -20)], "all"),
    ("Frequent Budget Shoppers", [("frequency", ">", 20), ("monetary", "<", -20)], "all"),
    ("High-Return / Problematic", [("cancellation_rate", ">", 50), ("return_quantity_rate", ">", 50)], "any"),
    ("Low-Engagement", [("monetary", "<", -30), ("frequency", "<", -30)], "all"),
]
DEFAULT_NAME = "Average Regulars"


def cluster_name() -> Column:
    """Name of a profile row by the first rule that fits; a missing deviation counts as none."""
    name = None
    for label, bounds, mode in NAMING_RULES:
        hit = F.lit(mode == "all")
        for feature, sign, bound in bounds:
            value = F.coalesce(F.col(f"{feature}_rel_pct"), F.lit(0.0))
            test = value > bound if sign == ">" else value < bound
            hit = (hit & test) if mode == "all" else (hit | test)
        name = F.when(hit, F.lit(label)) if name is None else name.when(hit, F.lit(label))
    return name.otherwise(F.lit(DEFAULT_NAME))


def name_clusters(profile: DataFrame) -> DataFrame:
    """(cluster_id, cluster_name): equal names get the letters A, B, C … by cluster id."""
    named = profile.select("cluster_id", cluster_name().alias("base_name"))
    same = Window.partitionBy("base_name")
    letter = F.chr((F.row_number().over(same.orderBy("cluster_id")) + 64).cast("bigint"))
    return named.withColumns({"twins": F.count(F.lit(1)).over(same), "letter": letter}).select(
        "cluster_id", F.when(F.col("twins") > 1, F.concat_ws(" ", "base_name", "letter")).otherwise(
            F.col("base_name")).alias("cluster_name"))


def assignments(assigned: DataFrame, names: DataFrame) -> DataFrame:
    """(customer_id, cluster_id, cluster_name); a cluster without a name is called by its number."""
    return assigned.select("customer_id", "cluster_id").join(F.broadcast(names), "cluster_id", "left").select(
        "customer_id", "cluster_id", F.coalesce("cluster_name", F.concat(F.lit("Cluster "), F.col("cluster_id").cast(
            "string"))).alias("cluster_name"))


def run_clustering(features: DataFrame, ks: range = K_RANGE, runs: int = 10, max_iter: int = 300) -> dict:
    """Prepare, fit every k, choose one by silhouette, profile, name and assign."""
    preparation = fit_preparation(features)
    prepared = prepare(preparation, features)
    scaled = prepared.select("customer_id", "scaled").persist()
    models = fit_all(scaled, ks, runs, max_iter)
    results = judged(scaled, models)
    scaled.unpersist()
    model = models[best_k(results)][1]
    assigned = model.transform(prepared)
    profile = profiles(assigned)
    names = name_clusters(profile)
    return {"model": PipelineModel(stages=[*preparation.stages, model]), "k_search": results, "profiles": profile,
            "names": names, "assigned": assigned, "assignments": assignments(assigned, names)}


def assign_stored(model: PipelineModel, features: DataFrame, names: DataFrame) -> DataFrame:
    """Clusters of new customers from a stored model."""
    return assignments(model.transform(_numeric(features)), names)
