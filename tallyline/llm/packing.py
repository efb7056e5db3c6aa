"""Best-fit decreasing packing of tokenised documents into sequences of fixed size.

Texts are tokenised inside tasks. Documents longer than a sequence are cut; pieces travel as lengths and checksums. Pieces of
equal length are interchangeable, so best-fit decreasing runs over counts: for each length, longest first, the tightest
open remaining capacity is found in a segment tree over capacities, and as many pieces move there as both sides allow. The
state has at most ``size`` lengths and ``size`` capacities whatever the input, so the driver computes the same layout that
best-fit decreasing gives piece by piece. It returns runs (length, ranks, sequences, offset); pieces are ranked within their
length in parallel and find their run by a join.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator
from functools import cached_property
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.llm import blocks, graph
from tallyline.sources.lake import Scratch

SIZE = 1024
END = 2
CACHED_UNITS = 400_000  # token sequences of text units a task remembers before it starts over

# A unit is a run of white space with the word after it: the tokenizer's own split never joins units. Other Unicode white
# space and the special token's text are rare and leave the text whole.
_UNITS = re.compile(r"[ \t-\r]*[^ \t-\r]+|[ \t-\r]+")
_WHOLE = re.compile(r"[\x1c-\x1f\x85\xa0  -     　]|<\|endoftext\|>")


class Vocabulary(NamedTuple):
    """The contents of the tokenizer's JSON file and of the same vocabulary as ranks, read once on the driver."""

    tokenizer: str
    ranks: bytes
    pattern: str

    @classmethod
    def read(cls, tokenizer_path: str, ranks_path: str, pattern: str) -> Vocabulary:
        with open(tokenizer_path, encoding="utf-8") as one, open(ranks_path, "rb") as two:
            return cls(one.read(), two.read(), pattern)


class Encoder:
    """Text to ids as little-endian 32-bit bytes, equal to the tokenizer's own ids without special tokens."""

    def __init__(self, vocabulary: Vocabulary):
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.ranks.splitlines())}
        self.fast = tiktoken.Encoding("ranks", pat_str=vocabulary.pattern, mergeable_ranks=ranks, special_tokens={})
        self.vocabulary = vocabulary
        self.known: dict[str, bytes] = {}

    @cached_property
    def exact(self):
        """The tokenizer itself, made for the first text that needs it."""
        from tokenizers import Tokenizer

        return Tokenizer.from_str(self.vocabulary.tokenizer)

    def _unit(self, unit: str) -> bytes:
        if len(self.known) >= CACHED_UNITS:
            self.known.clear()
        ids = self.known[unit] = np.array(self.fast.encode_ordinary(unit), "<u4").tobytes()
        return ids

    def __call__(self, text: str) -> bytes:
        if _WHOLE.search(text):
            return np.array(self.exact.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        get, unit = self.known.get, self._unit
        return b"".join([get(u) or unit(u) for u in _UNITS.findall(text)])


def pieces(docs: DataFrame, vocabulary: Vocabulary, size: int = SIZE, end: int = END, with_ids: bool = False) -> DataFrame:
    """(row, doc_id, piece, start, length, ids_crc32[, ids]) of every row of ``docs(doc_id, text)``; other columns are ignored.

    A document's ids are its text's and then ``end``; a null or empty text is ``end`` alone. One longer than ``size`` is cut
    so that all pieces but the first are full. ``row`` tells repeated rows and null doc_ids apart within one evaluation.
    """
    held = docs.sparkSession.sparkContext.broadcast(tuple(vocabulary))
    tail = np.array([end], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Encoder(Vocabulary(*held.value))
        for batch in batches:
            ids_column, texts = batch.column("doc_id"), batch.column("text")
            source, piece, start, length, crc, kept = [], [], [], [], [], []
            for at, text in enumerate(texts):
                ids = encode(text.as_py() or "") + tail
                total = len(ids) // 4
                begin = 0
                for k in range(-(-total // size)):
                    stop = begin + (size if k else (total - 1) % size + 1)
                    part = ids[4 * begin:4 * stop]
                    source.append(at)
                    piece.append(k)
                    start.append(begin)
                    length.append(stop - begin)
                    crc.append(zlib.crc32(part))
                    if with_ids:
                        kept.append(np.frombuffer(part, "<u4").astype(np.int32))
                    begin = stop
            columns = [ids_column.take(pa.array(source, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                       pa.array(length, pa.int64()), pa.array(crc, pa.int64()), pa.array(source, pa.int64())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "_at"]
            if with_ids:
                columns.append(pa.array(kept, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, _at long" + ", ids array<int>" * with_ids
    made = docs.select("doc_id", "text").mapInArrow(blocks.returning(run), schema)
    return made.select(F.monotonically_increasing_id().alias("row"), *[c for c in made.columns if c != "_at"])


class _Tightest:
    """Segment tree over remaining capacities: the smallest open one of at least a given length."""

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.open = [False] * (2 * self.leaves)

    def set(self, capacity: int, is_open: bool) -> None:
        at = capacity + self.leaves
        self.open[at] = is_open
        while at > 1:
            at >>= 1
            self.open[at] = self.open[2 * at] or self.open[2 * at + 1]

    def find(self, least: int) -> int | None:
        at = least + self.leaves
        if self.open[at]:
            return least
        while at > 1:
            if not at & 1 and self.open[at + 1]:
                at += 1
                while at < self.leaves:
                    at = 2 * at if self.open[2 * at] else 2 * at + 1
                return at - self.leaves
            at >>= 1
        return None


def layout(counts: dict[int, int], size: int = SIZE) -> list[tuple[int, int, int, int, int]]:
    """Runs (length, first rank, pieces, first sequence, offset) of best-fit decreasing over ``counts`` of pieces by length.

    Ranks first.. of that length go one each to sequences first.., all at ``offset``. Work and result are bounded by the
    number of lengths and capacities, not by the number of pieces.
    """
    tree, spans, out, made = _Tightest(size), {}, [], 0
    for length in sorted((n for n in counts if counts[n]), reverse=True):
        rank, left = 0, counts[length]
        while left:
            capacity = tree.find(length)
            if capacity is None:
                capacity, first, free = size, made, -(-left // (size // length))
                made += free
            else:
                first, free = spans[capacity].pop()
            fit = capacity // length  # a sequence just filled stays the tightest, so it takes what fits before the next one
            full, odd = min(left // fit, free), 0
            if full < free and left - full * fit < fit:
                odd = left - full * fit
            for sequences, each in ((full, fit), (1 if odd else 0, odd)):
                for k in range(each if sequences else 0):
                    out.append((length, rank, sequences, first, size - capacity + k * length))
                    rank += sequences
                _open(tree, spans, capacity - each * length, first, sequences)
                first, free = first + sequences, free - sequences
            left -= full * fit + odd
            _open(tree, spans, capacity, first, free)
            if not spans.get(capacity):
                tree.set(capacity, False)
    return out


def _open(tree: _Tightest, spans: dict, capacity: int, first: int, sequences: int) -> None:
    if capacity and sequences:
        spans.setdefault(capacity, []).append((first, sequences))
        tree.set(capacity, True)


def pack(parts: DataFrame, size: int = SIZE) -> DataFrame:
    """``parts`` (a written table with ``row``, ``piece`` and ``length``) with ``sequence_id`` and ``offset``.

    Lengths must be 1 to ``size``. Offsets of a sequence are gapless from 0. An empty table gives an empty result.
    """
    spark: SparkSession = parts.sparkSession
    counts = {r["length"]: r["n"] for r in parts.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    runs = layout(counts, size)
    table = spark.createDataFrame(
        [(*run, k) for k, run in enumerate(runs)],
        "length long, first_rank long, pieces long, first_sequence long, offset long, run int")
    ranked = graph.rank_in_group(parts, ["length"], [F.col("row"), F.col("piece")], F.xxhash64("row", "piece"), "_rank")
    steps = (table.groupBy("length")
                  .agg(F.array_sort(F.collect_list(F.struct("first_rank", "first_sequence", "offset"))).alias("_runs")))
    placed = ranked.join(F.broadcast(steps), "length", "left")  # one row for each length, at most ``size`` of them
    starts = F.transform("_runs", lambda r: r["first_rank"])
    own = F.element_at("_runs", F.size(F.filter(starts, lambda s: s <= F.col("_rank"))))
    return (placed.withColumn("_own", own)
                  .select(*parts.columns, (F.col("_own.first_sequence") + F.col("_rank") - F.col("_own.first_rank")).alias("sequence_id"),
                          F.col("_own.offset").alias("offset")))


def pack_documents(docs: DataFrame, vocabulary: Vocabulary, scratch: Scratch, size: int = SIZE, end: int = END,
                   with_ids: bool = False) -> DataFrame:
    """Tokenise, cut and place all rows of ``docs``; the pieces are written once, so ranks and rows cannot move apart."""
    with graph.small_batches(docs.sparkSession):
        parts = scratch.write(pieces(docs, vocabulary, size, end, with_ids))
    return pack(parts, size).drop("row")
