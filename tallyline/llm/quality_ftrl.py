"""Quality classifier: hashed word n-grams, logistic regression with follow-the-regularised-leader updates.

Words are runs of letters and digits or of symbols, as written. A text's features are its words, its word pairs, and pairs of
word shapes (case, symbol, same as before), hashed into ``DIMENSION`` places; counts are scaled to length one. The model
learns from a bounded sample of labelled rows in a fixed number of shards, whose weights are averaged. Every text is then
scored in its task as a sparse dot product.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import ArrowUDFType

from tallyline.llm import blocks

DIMENSION = 1 << 18
SAMPLE = 12_000   # labelled rows learned from, at most, about half of each label where there are as many
SHARDS = 4
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 1e-4, 1e-4


def _vectors(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, values) of each text's features; none for a text without words."""
    for _, data, offsets in blocks.text_slices(column):
        n = len(offsets) - 1
        start, end, rows, hashes = blocks.words(data, offsets, fold=False, symbols=True)
        if not len(start):
            yield from ((np.zeros(0, np.int64), np.zeros(0)) for _ in range(n))
            continue
        upper = np.add.reduceat((data >= 65) & (data <= 90), start, dtype=np.int64)
        lower = np.add.reduceat((data >= 97) & (data <= 122), start, dtype=np.int64)
        shape = (upper > 0) * 1 + (lower > 0) * 2 + (upper > 1) * 4
        shape[1:] += 8 * (hashes[1:] == hashes[:-1])
        shape = blocks.mix(shape.astype(np.uint64) + np.uint64(1000))
        pair_at, pair = blocks.windows(hashes, rows, 2)
        shape_at, shapes = blocks.windows(shape, rows, 2)
        row = np.concatenate([rows, rows[pair_at], rows[shape_at]])
        place = (blocks.mix(np.concatenate([hashes, pair + np.uint64(1), shapes + np.uint64(2)])) >> np.uint64(20)).astype(np.int64) % DIMENSION
        keys, counts = np.unique(row * DIMENSION + place, return_counts=True)
        at = np.searchsorted(keys, np.arange(n + 1) * DIMENSION)
        for r in range(n):
            some = counts[at[r]:at[r + 1]].astype(float)
            yield keys[at[r]:at[r + 1]] % DIMENSION, some / max(np.sqrt((some * some).sum()), 1e-12)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int = SAMPLE) -> DataFrame:
    """(text, label) of at most about ``rows`` labelled rows, half of each label if there are enough, chosen by a hash of doc_id.

    The sample of ``labels(doc_id, label)`` is drawn first, so its broadcast is bounded by ``rows`` whatever the table's size.
    Labels other than 0 and 1, and rows without doc_id, teach nothing.
    """
    known = labels.filter(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull()).select("doc_id", F.col(label).cast("int").alias("_label"))
    each = {r["_label"]: r["count"] for r in known.groupBy("_label").count().collect()}
    share = {k: min(1.0, rows / 2 / n) for k, n in each.items()}
    cut = F.when(F.col("_label") == 1, share.get(1, 0.0)).otherwise(share.get(0, 0.0))
    chosen = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < cut * 1_000_000)
    return docs.join(F.broadcast(chosen), "doc_id").select("text", F.col("_label").alias("label"))


def fit(sample: DataFrame, shards: int = SHARDS, epochs: int = EPOCHS) -> tuple[np.ndarray, float]:
    """Weights and bias from ``sample(text, label)``; zeros where nothing teaches. Each shard holds a bounded share of the sample."""
    def learn(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["order", "label"])
        examples = list(_vectors(pa.array(frame["text"], pa.string())))
        targets = frame["label"].to_numpy()
        z, n = np.zeros(DIMENSION + 1), np.zeros(DIMENSION + 1)
        for _ in range(epochs):
            for (places, values), target in zip(examples, targets, strict=True):
                at, x = np.append(places, DIMENSION), np.append(values, 1.0)
                w = _weights(z[at], n[at])
                g = (1 / (1 + np.exp(-np.clip(w @ x, -35, 35))) - target) * x
                step = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
                z[at] += g - step * w
                n[at] += g * g
        return pd.DataFrame({"rows": [len(frame)], "weights": [_weights(z, n).tobytes()]})

    order = F.xxhash64("text", "label")
    parts = sample.select("text", "label", order.alias("order")).withColumn("shard", F.pmod("order", F.lit(shards)))
    found = parts.groupBy("shard").applyInPandas(learn, "rows long, weights binary").collect()
    total = sum(r["rows"] for r in found)
    if not total:
        return np.zeros(DIMENSION), 0.0
    mean = sum(np.frombuffer(r["weights"]) * (r["rows"] / total) for r in found)
    return mean[:-1], float(mean[-1])


def _weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    return np.where(np.abs(z) <= L1, 0.0, (np.sign(z) * L1 - z) / ((BETA + np.sqrt(n)) / ALPHA + L2))


def classify(docs: DataFrame, model: tuple[np.ndarray, float]) -> DataFrame:
    """``docs`` with ``score`` (0 to 1, higher: better) and ``predicted`` (1 if score >= 0.5); columns so named are replaced.

    A null or empty text has no features: its score is the bias's.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        weights, bias = held.value
        for column in columns:
            total = np.array([weights[places] @ values for places, values in _vectors(column)], float) + bias
            yield pa.array(1 / (1 + np.exp(-np.clip(total, -35, 35))))

    once = F.arrow_udf(run, "double", ArrowUDFType.SCALAR_ITER).asNondeterministic()
    rows = docs.drop("score", "predicted")
    made = rows.select(F.struct("*").alias("_row"), once("text").alias("score"))
    return made.select("_row.*", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
