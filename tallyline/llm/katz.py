"""Katz back-off bigram model: Good-Turing discounted counts with exactly normalised back-off weights.

Texts are read in blocks of consecutive rows. A block asks for the counts of its distinct words and word pairs, grouped by
hash bucket, so a word in every document is one entry per block; a bucket sums them and answers each block in the order of
its question. The number of buckets follows the input, so a bucket stays small. What a block cannot know alone, the sums over
all words seen after a context, goes the same way. Texts meet their block's answers by one shuffle and are scored there:
P(w | h) is the discounted pair where it is kept, else the back-off weight of h times P(w), else times P(unknown).

The model is written once below ``path``, as lists by bucket: ``raw/what=table`` holds the keys and counts of kept words and
pairs (``ngrams`` reads them as rows), ``contexts`` the discounted mass and lower-order mass of each context, from which its
back-off weight follows.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.llm import blocks, graph
from tallyline.sources.lake import Scratch

DISCOUNTED = 5            # counts up to this are discounted
BASE = 0.1                # added to every count of the base score
BLOCK_BYTES = 20 << 20    # text of a block
BUCKET_BYTES = 8 << 20    # text for each bucket
SLICE = 512 << 10         # bytes of text turned into words at a time
STEP = 1 << 18            # tokens or pairs looked at together, where a step needs more arrays of them
END = np.uint64(0x0E4D0E4D0E4D0E4D)
BEGIN = np.uint64(0x0B460B460B460B46)


class Stats(NamedTuple):
    """What scoring needs of the corpus besides counts: a few numbers, whatever its size."""

    tokens: int
    types: int
    words: tuple[float, ...]   # discount of count r at place r; what is larger is not discounted
    pairs: tuple[float, ...]


def discounts(times: dict[int, int], k: int = DISCOUNTED) -> tuple[float, ...]:
    """Katz's discount d(r) for r = 0..k from counts of counts; d(0) is 0.

    Where Good-Turing gives no number in (0, 1], r loses Ney's constant n1 / (n1 + 2 n2), at most 0.9.
    """
    n = [times.get(r, 0) for r in range(k + 2)]
    lost = min(n[1] / (n[1] + 2 * n[2]), 0.9) if n[1] else 0.0
    rest = (k + 1) * n[k + 1] / n[1] if n[1] else 1.0
    out = [0.0]
    for r in range(1, k + 1):
        turing = ((r + 1) * n[r + 1] / n[r] / r - rest) / (1 - rest) if n[r] and rest < 1 else 0.0
        out.append(turing if 0 < turing <= 1 else (r - lost) / r)
    return tuple(out)


def _discounted(counts: np.ndarray, table: tuple[float, ...]) -> np.ndarray:
    return counts * np.where(counts < len(table), np.array(table)[np.minimum(counts, len(table) - 1)], 1.0)


def unigram(counts: np.ndarray, stats: Stats, unknown_mass: float) -> np.ndarray:
    """P(w) of words with these training counts; 0 stands for the unknown word, which has what the discounts leave."""
    whole = stats.tokens + (0 if unknown_mass > 0 else 1)
    return np.where(counts > 0, _discounted(counts, stats.words) / max(whole, 1), unknown_mass if unknown_mass > 0 else 1 / whole)


def _distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct values, the place of each value in them, and where each distinct one comes first.

    Ranges of hashes are sorted one by one, so what sorting needs besides these arrays stays a small part of them.
    """
    if not len(values):
        return values, np.zeros(0, np.int32), np.zeros(0, np.int32)
    least = values.min()
    shift = np.uint64(max(0, int(values.max() - least).bit_length() - 6))
    part = np.empty(len(values), np.uint8)
    for a in range(0, len(values), STEP):
        part[a:a + STEP] = (values[a:a + STEP] - least) >> shift
    place = np.empty(len(values), np.int32)
    keys, firsts, n = [], [], 0
    for k in range(64):
        at = np.flatnonzero(part == k).astype(np.int32)
        if len(at):
            found, inverse = np.unique(values[at], return_inverse=True)
            first = np.empty(len(found), np.int32)
            first[inverse[::-1]] = at[::-1]  # of equal values the last one written stays
            place[at] = inverse + n
            keys.append(found)
            firsts.append(first)
            n += len(found)
    return np.concatenate(keys), place, np.concatenate(firsts)


class Block(NamedTuple):
    """Tokens of consecutive texts: each text's words and one end."""

    words: np.ndarray       # distinct hashes, sorted, with the begin mark
    word: np.ndarray        # place of each token in them
    pairs: np.ndarray       # distinct pair hashes, sorted
    pair: np.ndarray        # place of each token's pair in them
    pair_context: np.ndarray
    pair_word: np.ndarray
    first: np.ndarray       # first token of each text, and the end

    @classmethod
    def read(cls, texts: pa.Array) -> Block:
        parts, counts = [], []
        for _, data, offsets in blocks.text_slices(texts, SLICE):
            _, _, rows, hashes = blocks.words(data, offsets)
            own = np.full(len(hashes) + len(offsets) - 1, END)
            own[np.arange(len(hashes)) + rows] = hashes  # each text before has its end
            parts.append(own)
            counts.append(np.bincount(rows, minlength=len(offsets) - 1))
        count = np.concatenate(counts) if counts else np.zeros(0, np.int64)
        first = np.concatenate([[0], np.cumsum(count + 1)])
        token = np.concatenate([*parts, [BEGIN]]).astype(np.uint64, copy=False)
        del parts
        words, word, _ = _distinct(token)
        del token
        begin, word = word[-1], word[:-1]
        context = np.empty_like(word)
        context[1:] = word[:-1]
        context[first[:-1]] = begin
        after = blocks.mix(words + np.uint64(5)) * np.uint64(3)
        both = np.empty(len(word), np.uint64)
        for a in range(0, len(both), STEP):
            both[a:a + STEP] = blocks.mix(after[context[a:a + STEP]] + words[word[a:a + STEP]])
        pairs, pair, at = _distinct(both)
        return cls(words, word, pairs, pair, context[at], word[at], first)

    def counts(self, held: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of words and pairs in texts that are not held out; the begin mark counts those texts."""
        taught = np.repeat(~held, np.diff(self.first))
        words = np.bincount(self.word[taught], minlength=len(self.words)).astype(np.uint32)
        words[np.searchsorted(self.words, BEGIN)] = int((~held).sum())
        return words, np.bincount(self.pair[taught], minlength=len(self.pairs)).astype(np.uint32)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.Table]]:
    """(block, rows) of a task's rows in order, cut by text size; the same rows give the same blocks, however batched."""
    task, number, held, size = TaskContext.get().partitionId(), 0, [], 0

    def taken() -> pa.Table:
        table = pa.Table.from_batches(held)
        held.clear()  # the rows stay with the caller only
        return table

    for batch in batches:
        at = 0
        lengths = np.cumsum(pa.compute.fill_null(pa.compute.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        while at < batch.num_rows:
            before = int(lengths[at - 1]) if at else 0
            stop = max(at if held else at + 1, int(np.searchsorted(lengths, before + BLOCK_BYTES - size, "right")))
            if stop > at:
                held.append(batch.slice(at, stop - at))
                size += int(lengths[stop - 1]) - before
                at = stop
            if at < batch.num_rows:
                yield task << 24 | number, taken()
                number, size = number + 1, 0
    if held:
        yield task << 24 | number, taken()


def _flat(column: pa.ChunkedArray) -> pa.Array:
    return pa.concat_arrays([c.cast(pa.large_string()) for c in column.chunks])


def _ranges(keys: np.ndarray, buckets: int) -> Iterator[tuple[int, slice]]:
    bucket = ((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    at = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(keys) else np.zeros(0, int)
    for a, b in zip(at, [*at[1:], len(keys)], strict=True):
        yield int(bucket[a]), slice(int(a), int(b))


_COUNTED = "kind int, bucket long, block long, answer binary, n long, total long, key array<long>, count array<long>"
_SUMMED = "kind int, bucket long, block long, answer binary, key array<long>, mass array<double>, lower array<double>"
_ASKED = "kind int, bucket long, block long, keys binary, numbers binary"


def _ask(docs: DataFrame, buckets: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, rows in _blocks(batches):
            held = rows.column("held_out").to_numpy()
            own = Block.read(_flat(rows.column("text")))
            del rows
            for kind, keys, counts in zip((1, 2), (own.words, own.pairs), own.counts(held), strict=True):
                for bucket, part in _ranges(keys, buckets):
                    yield pa.RecordBatch.from_pydict({
                        "kind": pa.array([kind], pa.int32()), "bucket": [bucket], "block": [block],
                        "keys": [keys[part].tobytes()], "numbers": [counts[part].tobytes()]})

    return docs.mapInArrow(blocks.returning(run), _ASKED)


def _merged(table: pa.Table, kind: type) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[slice], list[np.ndarray]]:
    keys = [np.frombuffer(x.as_buffer(), np.uint64) for x in table.column("keys")]
    ends = np.cumsum([len(k) for k in keys])
    distinct, place, first = _distinct(np.concatenate(keys))
    numbers = [np.frombuffer(x.as_buffer(), kind) for x in table.column("numbers")]
    return distinct, place, first, [slice(b - len(k), b) for k, b in zip(keys, ends, strict=True)], numbers


def _count(asked: DataFrame) -> DataFrame:
    """Sums each bucket: its answers to the blocks, its part of the table, and how often each count occurs.

    An answer is the training count of each key asked for, doubled, plus 1 for the one block that stands for a pair.
    """
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        kind, bucket = key[0].as_py(), key[1].as_py()
        distinct, place, first, parts, numbers = _merged(table, np.uint32)
        total = np.bincount(place, weights=np.concatenate(numbers), minlength=len(distinct)).astype(np.int64)
        width = np.uint64 if int(total.max(initial=0)) * 2 + 1 >> 32 else np.uint32
        answer = (total * 2).astype(width)[place]
        answer[first] += 1
        del place, first
        out = [("answer", b.as_py(), answer[p].tobytes(), None, None) for b, p in zip(table.column("block"), parts, strict=True)]
        counted = total[(total > 0) & (distinct != BEGIN)]
        for r, n in zip(*np.unique(np.minimum(counted, DISCOUNTED + 2), return_counts=True), strict=True):
            out.append(("times", int(r), None, int(n), int(counted[counted >= r].sum()) if r == DISCOUNTED + 2 else int(r * n)))
        kept = total > 0
        blocks.give_back()
        lists = [None] * len(out) + [distinct[kept].view(np.int64)]
        out.append(("table", None, None, None, None))
        counts = [None] * (len(out) - 1) + [total[kept]]
        return pa.table({
            "what": [o[0] for o in out], "kind": pa.array([kind] * len(out), pa.int32()), "bucket": pa.array([bucket] * len(out), pa.int64()),
            "block": pa.array([o[1] for o in out], pa.int64()), "answer": pa.array([o[2] for o in out], pa.binary()),
            "n": pa.array([o[3] for o in out], pa.int64()), "total": pa.array([o[4] for o in out], pa.int64()),
            "key": pa.array(lists, pa.list_(pa.int64())), "count": pa.array(counts, pa.list_(pa.int64()))})

    return asked.groupBy("kind", "bucket").applyInArrow(run, f"what string, {_COUNTED}")


def _meet(docs: DataFrame, answers: DataFrame, handle, schema: str) -> DataFrame:
    """``handle(number, block, rows, answers by kind)`` for every block, where its texts and its answers meet; the rows have
    ``doc_id`` and ``held_out``. ``docs`` are read in the same order as when the blocks asked."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    shape = f"block long, kind int, part long, doc_id {kind}, held_out boolean, text string, answer binary"

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, rows in _blocks(batches):
            for at in range(0, rows.num_rows, 2000):
                part = rows.slice(at, 2000).combine_chunks()
                n = part.num_rows
                yield pa.RecordBatch.from_pydict({
                    "block": pa.array([block] * n, pa.int64()), "kind": pa.array([9] * n, pa.int32()), "part": pa.array(range(at, at + n), pa.int64()),
                    **{c: part.column(c).combine_chunks() for c in ("doc_id", "held_out", "text")}, "answer": pa.array([None] * n, pa.binary())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held = None, []
        for batch in batches:
            names = batch.column("block").to_numpy()
            cuts = np.concatenate([[0], np.flatnonzero(names[1:] != names[:-1]) + 1, [len(names)]])
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if a == b:
                    continue
                if block is not None and names[a] != block:
                    yield from done(block, held)
                    held = []
                block = names[a]
                held.append(batch.slice(a, b - a))
        if held:
            yield from done(block, held)

    def done(block: int, held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(held)
        held.clear()  # texts and answers of a block are held once
        kinds = table.column("kind").to_numpy()
        got = {int(k): [x.as_buffer() for x in table.column("answer").filter(pa.array(kinds == k))] for k in np.unique(kinds) if k != 9}
        rows = table.select(["doc_id", "held_out", "text"]).filter(pa.array(kinds == 9))
        del table, kinds
        texts, rows = _flat(rows.column("text")), rows.drop_columns(["text"])
        own = Block.read(texts)
        del texts
        blocks.give_back()
        yield from handle(int(block), own, rows, got)

    rows = docs.mapInArrow(blocks.returning(number), shape)
    asked = answers.select("block", "kind", F.col("bucket").alias("part"), F.lit(None).cast(kind).alias("doc_id"),
                           F.lit(None).cast("boolean").alias("held_out"), F.lit(None).cast("string").alias("text"), "answer")
    return rows.unionByName(asked).repartition("block").sortWithinPartitions("block", "kind", "part").mapInArrow(blocks.returning(run), schema)


def _numbers(parts: list, n: int) -> np.ndarray:
    """Answers of all buckets in order; a block that asked for other keys than it has now must not go on."""
    found = [np.frombuffer(p, np.uint32) for p in parts]
    if sum(len(x) for x in found) != n:
        raise RuntimeError("texts were not read in the same order again; write them to a table first")
    return np.concatenate(found) if found else np.zeros(0, np.uint32)


def _of_texts(values: np.ndarray, place: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The sum of each text's values, which its tokens point to; some texts at a time."""
    out = np.empty(len(first) - 1, values.dtype)
    a = 0
    while a < len(out):
        b = max(a + 1, int(np.searchsorted(first, first[a] + STEP, "right")) - 1)
        out[a:b] = np.add.reduceat(values[place[first[a]:first[b]]], first[a:b] - first[a])
        a = b
    return out


def ngrams(spark: SparkSession, path: str) -> DataFrame:
    """(order, bucket, key, count) of every kept word and pair of the model below ``path``."""
    raw = spark.read.schema(f"{_COUNTED}, what string").parquet(f"{path}/raw").filter("what = 'table'")
    return raw.select(F.col("kind").alias("order"), "bucket", F.explode(F.arrays_zip("key", "count")).alias("e")).select("order", "bucket", "e.key", "e.count")


def score(docs: DataFrame, scratch: Scratch, path: str | None = None) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row of ``docs(doc_id, text, held_out)``.

    Rows that are not held out teach the model. ``docs`` must be a written table, read in the same order each time. A null or
    empty text is one end token. Repeated rows count and are scored each. ``score`` is the log10 probability of the whole
    text; if nothing teaches, every token is unknown and has probability 1. Null ``held_out`` counts as false; other columns
    are ignored. Every word and pair seen in training is kept with its discounted count.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text", F.coalesce("held_out", F.lit(False)).alias("held_out"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, -(-size // BUCKET_BYTES))
    path = path or f"{scratch.root}/katz-{uuid.uuid4().hex}"
    with graph.small_batches(spark):
        _count(_ask(docs, buckets)).write.partitionBy("what").parquet(f"{path}/raw")
    raw = spark.read.schema(f"{_COUNTED}, what string").parquet(f"{path}/raw")
    times: dict[int, dict[int, tuple[int, int]]] = {1: {}, 2: {}}
    for r in raw.filter("what = 'times'").groupBy("kind", "block").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect():
        times[r["kind"]][r["block"]] = (r["n"], r["total"])
    graph.release(spark)
    stats = Stats(sum(t for _, t in times[1].values()), sum(n for n, _ in times[1].values()),
                  *(discounts({r: n for r, (n, _) in times[k].items() if r <= DISCOUNTED + 1}) for k in (1, 2)))
    kept = sum(n * r * stats.words[r] if r <= DISCOUNTED else t for r, (n, t) in times[1].items())
    unknown = (stats.tokens - kept) / stats.tokens if stats.tokens else 1.0
    unknown = unknown if unknown > 1e-12 else 0.0
    counted = raw.filter("what = 'answer'").select("block", "kind", "bucket", "answer")

    def sums(block: int, own: Block, rows: pa.Table, got: dict[int, list]) -> Iterator[pa.RecordBatch]:
        words, pairs = _numbers(got[1], len(own.words)) >> 1, _numbers(got[2], len(own.pairs))
        got.clear()
        mine = np.flatnonzero((pairs > 1) & (pairs & 1 == 1))
        context = own.pair_context[mine]
        mass = np.bincount(context, weights=_discounted(pairs[mine] >> 1, stats.pairs), minlength=len(own.words))
        lower = np.bincount(context, weights=unigram(words, stats, unknown)[own.pair_word[mine]], minlength=len(own.words))
        for bucket, part in _ranges(own.words, buckets):
            yield pa.RecordBatch.from_pydict({
                "kind": pa.array([3], pa.int32()), "bucket": [bucket], "block": [block],
                "keys": [own.words[part].tobytes()], "numbers": [np.stack([mass[part], lower[part]], 1).tobytes()]})

    def total(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        distinct, place, _, parts, numbers = _merged(table, np.float64)
        both = np.concatenate(numbers).reshape(-1, 2)
        mass, lower = (np.bincount(place, weights=both[:, k], minlength=len(distinct)) for k in (0, 1))
        answer = np.stack([mass[place], lower[place]], 1)
        some = mass > 0
        del place
        blocks.give_back()
        n = table.num_rows
        return pa.table({
            "what": ["answer"] * n + ["table"], "kind": pa.array([3] * (n + 1), pa.int32()), "bucket": pa.array([key[0].as_py()] * (n + 1), pa.int64()),
            "block": pa.array([*table.column("block").to_pylist(), None], pa.int64()),
            "answer": pa.array([answer[p].tobytes() for p in parts] + [None], pa.binary()),
            "key": pa.array([None] * n + [distinct[some].view(np.int64)], pa.list_(pa.int64())),
            "mass": pa.array([None] * n + [mass[some]], pa.list_(pa.float64())), "lower": pa.array([None] * n + [lower[some]], pa.list_(pa.float64()))})

    partial = _meet(docs, counted, sums, _ASKED).groupBy("bucket").applyInArrow(total, f"what string, {_SUMMED}")
    with graph.small_batches(spark):
        partial.write.partitionBy("what").parquet(f"{path}/contexts")
    del partial
    weights = spark.read.schema(f"{_SUMMED}, what string").parquet(f"{path}/contexts").filter("what = 'answer'").select("block", "kind", "bucket", "answer")
    weights.count()  # the write's plan is let go only by a later job
    graph.release(spark)

    def evaluate(block: int, own: Block, rows: pa.Table, got: dict[int, list]) -> Iterator[pa.RecordBatch]:
        words, pairs = _numbers(got[1], len(own.words)) >> 1, _numbers(got[2], len(own.pairs)) >> 1
        sums_of = np.concatenate([np.frombuffer(p, np.float64) for p in got[3]]).reshape(-1, 2)
        got.clear()
        lower = unigram(words, stats, unknown)
        seen = np.maximum(words, 1)
        left = 1 - sums_of[:, 0] / seen
        scarce = (sums_of[:, 0] > 0) & (left < 1e-12)  # no discount in this context: one more event is reserved
        left = np.where(scarce, 1 / (seen + 1.0), np.where(sums_of[:, 0] > 0, left, 1.0))
        back = np.log10(left) - np.log10(np.where(sums_of[:, 0] > 0, 1 - sums_of[:, 1], 1.0))
        whole, lower = seen + scarce.astype(np.int64), np.log10(lower)
        log = np.empty(len(pairs))
        for a in range(0, len(pairs), STEP):
            c, w, n = own.pair_context[a:a + STEP], own.pair_word[a:a + STEP], pairs[a:a + STEP]
            own_log = np.log10(np.maximum(_discounted(n, stats.pairs), 1e-300) / whole[c])
            log[a:a + STEP] = np.where(n > 0, own_log, back[c] + lower[w])
        base = np.log10((words + BASE) / (stats.tokens + BASE * (stats.types + 1)))
        yield pa.RecordBatch.from_pydict({
            "doc_id": rows.column("doc_id").combine_chunks(), "held_out": rows.column("held_out").combine_chunks(), "n_tokens": np.diff(own.first),
            "n_known": _of_texts((words > 0).astype(np.int64), own.word, own.first), "train_tokens": np.full(rows.num_rows, stats.tokens, np.int64),
            "base_score": _of_texts(base, own.word, own.first), "score": _of_texts(log, own.pair, own.first)})

    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = _meet(docs, counted.unionByName(weights), evaluate,
                   f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
    with graph.small_batches(spark):
        return scratch.write(scored)
