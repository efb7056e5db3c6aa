"""Quality rules with a calibrated classifier: counted base rules, then hashed word and character n-grams.

The classifier is a logistic regression on relative frequencies of hashed words, word pairs and character 3- and 4-grams
(bytes, case kept), trained on a bounded sample of labelled rows and calibrated by a logistic curve on rows it has not
learned from. Texts are scored in Arrow batches: a text's score is the mean weight of its n-grams. ``kept`` follows fixed
thresholds: of the base rules, and of the calibrated probability.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import ArrowUDFType

from tallyline.llm import blocks

DIMENSION = 1 << 18
SAMPLE = 12_000       # labelled rows learned from, at most (see quality_ftrl.labelled_sample)
SHARDS = 4
EPOCHS = 4
RATE, SHRINK, SCALE = 0.5, 1e-6, 30.0
KEEP = 0.5            # smallest calibrated probability of good quality that is kept
LEAST_WORDS = 50
REPEATED_PERCENT = 50
_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#*$%&|<>")] = True
_KINDS = 4


class Model(NamedTuple):
    weights: np.ndarray  # word, word pair, 3 bytes, 4 bytes share one table
    bias: float
    slope: float         # calibration: probability = logistic(slope * raw + shift)
    shift: float


def _grams(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text, place) of the n-grams of each kind, texts in order."""
    _, _, rows, hashes = blocks.words(data, offsets, fold=False)
    pair_at, pair = blocks.windows(hashes, rows, 2)
    yield rows, _place(hashes, 1)
    yield rows[pair_at], _place(pair, 2)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    for size in (3, 4):
        n = max(len(data) - size + 1, 0)
        at = np.flatnonzero(text[:n] == text[size - 1:]) if n else np.zeros(0, np.int64)
        code = np.zeros(len(at), np.uint64)
        for k in range(size):
            code = code << np.uint64(8) | data[at + k]
        yield text[at], _place(code, size)


def _place(values: np.ndarray, kind: int) -> np.ndarray:
    return (blocks.mix(values * np.uint64(8) + np.uint64(kind)) >> np.uint64(30)).astype(np.int64) % DIMENSION


def _raw(column: pa.Array, model: Model) -> np.ndarray:
    out = []
    for _, data, offsets in blocks.text_slices(column):
        n = len(offsets) - 1
        total = np.full(n, model.bias)
        for rows, places in _grams(data, offsets):
            count = np.bincount(rows, minlength=n)
            total += SCALE * np.bincount(rows, weights=model.weights[places], minlength=n) / np.maximum(count, 1)
        out.append(total)
    return np.concatenate(out) if out else np.zeros(0)


def fit(sample: DataFrame, shards: int = SHARDS, epochs: int = EPOCHS) -> Model:
    """From ``sample(text, label)``. A quarter of the sample calibrates; with nothing to learn every probability is one half."""
    def learn(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["order", "label"])
        w, g2, bias, b2 = np.zeros(DIMENSION), np.full(DIMENSION, 1e-8), 0.0, 1e-8
        targets, examples = frame["label"].to_numpy(), []
        for _, data, offsets in blocks.text_slices(pa.array(frame["text"], pa.string())):
            n = len(offsets) - 1
            rows, places, values = [], [], []
            for r, p in _grams(data, offsets):
                rows.append(r)
                places.append(p)
                values.append(SCALE / np.maximum(np.bincount(r, minlength=n), 1)[r])
            row = np.concatenate(rows)
            keys, inverse = np.unique(row * DIMENSION + np.concatenate(places), return_inverse=True)
            value = np.bincount(inverse, weights=np.concatenate(values), minlength=len(keys))
            at = np.searchsorted(keys, np.arange(n + 1) * DIMENSION)
            examples += [((keys[a:b] % DIMENSION).astype(np.int32), value[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]
        for _ in range(epochs):
            for (at, x), target in zip(examples, targets, strict=True):
                lost = 1 / (1 + np.exp(-np.clip(w[at] @ x + bias, -35, 35))) - target
                g = lost * x + SHRINK * w[at]
                g2[at] += g * g
                w[at] -= RATE * g / np.sqrt(g2[at])
                b2 += lost * lost
                bias -= RATE * lost / np.sqrt(b2)
        return pd.DataFrame({"rows": [len(frame)], "weights": [w.tobytes()], "bias": [bias]})

    parts = sample.select("text", "label", F.xxhash64("text", "label").alias("order"))
    taught = parts.filter("pmod(order, 4) <> 0").withColumn("shard", F.pmod(F.shiftright("order", 8), F.lit(shards)))
    found = taught.groupBy("shard").applyInPandas(learn, "rows long, weights binary, bias double").collect()
    total = sum(r["rows"] for r in found)
    if not total:
        return Model(np.zeros(DIMENSION), 0.0, 1.0, 0.0)
    model = Model(sum(np.frombuffer(r["weights"]) * (r["rows"] / total) for r in found), sum(r["bias"] * r["rows"] / total for r in found), 1.0, 0.0)
    rest = _scored(parts.filter("pmod(order, 4) = 0").select("label", "text"), model).select("label", "_found.raw").collect()
    return model._replace(**_calibrated(np.array([r["raw"] for r in rest]), np.array([r["label"] for r in rest], float)))


def _calibrated(raw: np.ndarray, labels: np.ndarray) -> dict[str, float]:
    """Slope and shift of Platt's logistic curve by Newton steps, with his smoothed targets; identity without both labels."""
    good = labels.sum()
    if not 0 < good < len(labels):
        return {"slope": 1.0, "shift": 0.0}
    goal = np.where(labels == 1, (good + 1) / (good + 2), 1 / (len(labels) - good + 2))
    x, at = np.stack([raw, np.ones_like(raw)], 1), np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ at, -35, 35)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2), x.T @ (p - goal) + 1e-6 * at)
        at = at - np.clip(step, -1, 1)
        if np.abs(step).max() < 1e-9:
            break
    return {"slope": float(max(at[0], 1e-6)), "shift": float(at[1])}


def _counts(column: pa.Array) -> list[np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of each text."""
    found: list[list[np.ndarray]] = [[] for _ in range(5)]
    for first, data, offsets in blocks.text_slices(column):
        n = len(offsets) - 1
        start, end, rows, hashes = blocks.words(data, offsets, fold=False)
        heads = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        symbols = np.concatenate([[0], np.cumsum(_SYMBOLS[data])])
        at, window = blocks.windows(hashes, rows, 3)
        key = blocks.mix(window + blocks.mix(rows[at].astype(np.uint64) + np.uint64(9)))
        _, inverse, times = np.unique(key, return_inverse=True, return_counts=True)
        covered = np.zeros(len(rows) + 2, bool)
        repeated = at[times[inverse] > 1] if len(at) else at
        for k in range(3):
            covered[repeated + k] = True
        found[0].append(np.bincount(rows, minlength=n))
        found[1].append(np.bincount(rows, weights=heads[end] - heads[start], minlength=n).astype(np.int64))
        found[2].append(symbols[offsets[1:]] - symbols[offsets[:-1]])
        found[3].append(np.array([_repeated_lines(data[a:b].tobytes()) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]))
        found[4].append(np.bincount(rows[covered[:-2]], minlength=n))
    return [np.concatenate(f).astype(np.int64) if f else np.zeros(0, np.int64) for f in found]


def _repeated_lines(text: bytes) -> int:
    lines = [line for line in text.split(b"\n") if line.strip(b" \t\n\v\f\r")]
    return len(lines) - len(set(lines))


def _scored(docs: DataFrame, model: Model) -> DataFrame:
    held = docs.sparkSession.sparkContext.broadcast(tuple(model))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = Model(*held.value)
        for column in columns:
            raw = _raw(column, own)
            p = 1 / (1 + np.exp(-np.clip(own.slope * raw + own.shift, -35, 35)))
            yield pa.StructArray.from_arrays([*map(pa.array, _counts(column)), pa.array(raw), pa.array(p)], [*names, "raw", "probability"])

    kind = ", ".join(f"{n} long" for n in names) + ", raw double, probability double"
    once = F.arrow_udf(run, kind, ArrowUDFType.SCALAR_ITER).asNondeterministic()
    return docs.select(F.struct("*").alias("_row"), once("text").alias("_found")).select("_row.*", "_found")


def judge(docs: DataFrame, model: Model, keep: float = KEEP) -> DataFrame:
    """``docs`` with the five counts, ``probability``, ``base_failed`` and ``kept``; columns so named are replaced.

    Null and empty texts count 0 and fail the base rules, as they have fewer than ``LEAST_WORDS`` words. Lines and windows are
    compared exactly as written. Repeated rows get the same verdict.
    """
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "probability"]
    rows = _scored(docs.drop(*names, "base_failed", "kept"), model)
    failed = (F.col("_found.n_words") < LEAST_WORDS) | (100 * F.col("_found.n_repeat_words") > REPEATED_PERCENT * F.col("_found.n_words"))
    return rows.select("*", *[F.col(f"_found.{n}") for n in names], failed.alias("base_failed"),
                       (~failed & (F.col("_found.probability") >= keep)).alias("kept")).drop("_found")
