"""Exact Jaccard self-join of documents on word shingles, as components, by pivots and recursive regions.

Jaccard distance over sparse shingle sets is a metric in which unrelated documents are all exactly 1 apart, so documents as
top-level pivots would tell nothing apart and every window would hold everything. Top-level pivots are therefore single
shingles: a document is nearest to those it holds, and the windows follow from the reach. A set of n shingles that links at
similarity t shares one of its first n - ceil(t n) + 1 shingles in any fixed order with its partner, so it is replicated to
exactly those regions. Inside a region documents are the pivots (see ``regions``) and the triangle inequality decides.

The fixed order puts shingles seen often in a sample of documents last. The sample changes which regions exist, and so how
large they get, never which pairs link. Equal sets are one node, so exact copies meet no one twice.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.llm import blocks, graph, regions
from tallyline.sources.lake import Scratch

WORDS = 5
PERCENT = 75
SLICE = 512 << 10   # bytes of text read at a time; workers keep much of what a slice takes until the next stage
ROWS = 1000         # texts whose sets are held at a time
SAMPLE_OF = 16      # one document in so many is read for frequent shingles
SLOTS = 1 << 19     # hash slots of doc_ids whose texts are read again; their list goes to all tasks
FREQUENT = 200_000  # shingles at most in that list, which tasks receive; the order stays fixed whatever it holds


ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
s AS (SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
  ELSE list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))) END AS sh FROM w),
n AS (SELECT doc_id, CAST(len(sh) AS BIGINT) AS n FROM s),
e AS (SELECT doc_id, unnest(sh) AS x FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM e a JOIN e b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM p JOIN n k ON k.doc_id = a JOIN n m ON m.doc_id = b WHERE 100 * c >= 75 * (k.n + m.n - c)),
ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id AS f, doc_id AS t FROM n UNION SELECT reach.f, ways.b FROM reach JOIN ways ON reach.t = ways.a)
SELECT n.doc_id, n.n AS n_shingles, r.component_id FROM n JOIN (SELECT f, min(t) AS component_id FROM reach GROUP BY f) r ON r.f = n.doc_id
"""


def clusters(docs: DataFrame, scratch: Scratch, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs(doc_id, text)``; other columns are ignored.

    Rows link if their sets of ``words``-word shingles have ``100 * shared >= percent * union``. A text of fewer words is one
    shingle; a null text or one without words is an empty set, linked with nothing, and its component is its own doc_id.
    Repeated rows each come back. ``component_id`` is the smallest non-null doc_id among all rows reachable by links, null if
    there is none. An empty table gives an empty result.
    """
    with graph.small_batches(docs.sparkSession):
        rows, labelled = _labelled(docs, scratch, words, percent)
    linked = (rows.filter("n > 0").select("doc_id", "n", "d1", "d2").join(labelled, ["d1", "d2"])
                  .select("doc_id", F.col("n").alias("n_shingles"), "component_id"))
    empty = rows.filter("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return linked.unionByName(empty)


def _labelled(docs: DataFrame, scratch: Scratch, words: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """The rows with their sets' digests, and (d1, d2, component, component_id) of every set that is not empty."""
    docs = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    frequent = docs.sparkSession.sparkContext.broadcast(_frequent(docs, words))
    rows = scratch.write(_prefixes(docs, words, percent, frequent))
    docs = docs.drop("text_hash")
    nodes = (rows.filter("n > 0").groupBy("d1", "d2")
                 .agg(F.min("row").alias("node"), F.min("doc_id").alias("least"), F.any_value("n").alias("n")))
    nodes = scratch.write(nodes)
    first = rows.join(nodes.select(F.col("node").alias("row")), "row", "left_semi")
    members = first.select(F.posexplode("prefix").alias("place", "region"), F.col("row").alias("id"), "n")
    named = first.select(F.col("row").alias("node"), "doc_id", "d1", "d2")

    heads = first.select(F.col("row").alias("node"), "n", "prefix")

    def compare(pairs: DataFrame) -> DataFrame:
        possible = scratch.write(possible_pairs(pairs, heads, percent))
        measured = _distances(scratch, docs, named, possible.filter("possible").select("a", "b"), words)
        return measured.unionByName(possible.filter("NOT possible").select("a", "b", F.lit(None).cast("double").alias("distance")))

    found, _ = regions.connect([members], compare, may_link(percent), percent, scratch)
    known = nodes.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    label = known.groupBy("component").agg(F.min("least").alias("component_id"))
    return rows, known.join(label, "component").select("d1", "d2", "component", "component_id")


def keep_one(docs: DataFrame, scratch: Scratch, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """Rows of ``docs`` without near copies: one row of each component, all columns as they were.

    It is the row with the smallest doc_id (null last), then the smallest hash of its text; of rows that repeat both, one stays.
    Texts without words are in no component and stay, repeated ones too.
    """
    with graph.small_batches(docs.sparkSession):
        rows, labelled = _labelled(docs, scratch, words, percent)
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    first = (rows.filter("n > 0").select("doc_id", "text_hash", "d1", "d2").join(labelled, ["d1", "d2"])
                 .groupBy("component").agg(F.min(place).alias("p")).select("p.doc_id", "p.text_hash"))
    times = rows.groupBy("doc_id", "text_hash").agg(F.count(F.lit(1)).alias("_rows"), F.max("n").alias("_n"))
    same_key = F.col("t.doc_id").eqNullSafe(F.col("f.doc_id")) & F.col("t.text_hash").eqNullSafe(F.col("f.text_hash"))
    chosen = times.alias("t").join(first.withColumn("_chosen", F.lit(True)).alias("f"), same_key, "left").select("t.*", "f._chosen")
    chosen = scratch.write(chosen.filter("_chosen OR _n = 0").select("doc_id", "text_hash", F.expr("_rows > 1 AND _n > 0").alias("_repeated")))
    on = F.expr("d.doc_id <=> f.doc_id AND xxhash64(d.text) = f.text_hash")
    stays = lambda part: docs.alias("d").join(part.alias("f"), on, "left_semi")
    once, repeated = stays(chosen.filter("NOT _repeated")), chosen.filter("_repeated")
    return once if repeated.isEmpty() else once.unionByName(stays(repeated).dropDuplicates(["doc_id", "text"]))


def may_link(percent: int):
    """Sizes close enough, and enough left after the first shared shingle to reach the overlap both sizes need."""
    def rule(n_a: Column, place_a: Column, n_b: Column, place_b: Column) -> Column:
        needed = F.lit(percent) * (n_a + n_b)  # (100 + percent) * overlap >= percent * (n_a + n_b)
        left = F.least(n_a - place_a, n_b - place_b)
        return ((F.lit(100) * F.least(n_a, n_b) >= F.lit(percent) * F.greatest(n_a, n_b))
                & (F.lit(100 + percent) * left >= needed))
    return rule


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of ``ROWS`` rows at most."""
    for whole in batches:
        for begin in range(0, whole.num_rows, ROWS):
            yield whole.slice(begin, ROWS)


def _frequent(docs: DataFrame, words: int) -> np.ndarray:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _pieces(batches):
            sets = list(blocks.shingle_sets(batch.column("text"), words, SLICE))
            values, times = np.unique(np.concatenate(sets), return_counts=True) if sets else (np.zeros(0, np.uint64), np.zeros(0, int))
            yield pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(times)], ["s", "c"])

    part = docs.filter(F.pmod(F.xxhash64("doc_id"), F.lit(SAMPLE_OF)) == 0).select("text")
    return most_frequent(part.mapInArrow(blocks.returning(count), "s long, c long"))


def first_part(found: np.ndarray, last: np.ndarray, percent: int) -> np.ndarray:
    """Of a sorted set the hashes of which a linked partner holds at least one; those in ``last`` (sorted) come last."""
    if not len(found):
        return found.view(np.int64)
    if len(last):
        late = last[np.minimum(np.searchsorted(last, found), len(last) - 1)] == found
        found = np.concatenate([found[~late], found[late]])
    return found[:len(found) - (-(-percent * len(found) // 100)) + 1].view(np.int64)


def most_frequent(counted: DataFrame) -> np.ndarray:
    """The ``FREQUENT`` hashes seen most often, three times or more, of ``counted(s, c)``."""
    seen = counted.groupBy("s").agg(F.sum("c").alias("c")).filter("c >= 3")
    top = seen.orderBy(F.desc("c"), "s").limit(FREQUENT).select("s").toPandas()["s"].to_numpy(np.int64)
    return np.sort(top.view(np.uint64))


def _prefixes(docs: DataFrame, words: int, percent: int, frequent) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = frequent.value
        for batch in _pieces(batches):
            n, d1, d2, heads = [], [], [], []
            for found in blocks.shingle_sets(batch.column("text"), words, SLICE):
                n.append(len(found))
                a, b = blocks.digest(found)
                d1.append(a)
                d2.append(b)
                heads.append(first_part(found, last, percent))
            ends = np.concatenate([[0], np.cumsum([len(h) for h in heads])]).astype(np.int32)
            flat = np.concatenate(heads) if heads else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array(n, pa.int64()), pa.array(d1, pa.int64()), pa.array(d2, pa.int64()),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], ["doc_id", "text_hash", "n", "d1", "d2", "prefix"])

    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, text_hash long, n long, d1 long, d2 long, prefix array<long>"
    return docs.mapInArrow(blocks.returning(run), schema).select(F.monotonically_increasing_id().alias("row"), "*")


def possible_pairs(pairs: DataFrame, heads: DataFrame, percent: int) -> DataFrame:
    """``pairs(a, b)`` with whether what their first shingles share can still reach the overlap that a link needs.

    A shared shingle outside the shared first ones lies behind the first ones of one side, so there are at most as many.
    """
    behind = lambda n: F.ceil(F.lit(percent) * n / 100) - 1
    both = (pairs.join(heads.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("prefix").alias("p_a")), "a")
                 .join(heads.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("prefix").alias("p_b")), "b"))
    shared = F.size(F.array_intersect("p_a", "p_b")) + F.greatest(behind(F.col("n_a")), behind(F.col("n_b")))
    return both.select("a", "b", ((100 + percent) * shared >= percent * (F.col("n_a") + F.col("n_b"))).alias("possible"))


def _distances(scratch: Scratch, docs: DataFrame, named: DataFrame, pairs: DataFrame, words: int) -> DataFrame:
    """``pairs(a, b)`` with the exact Jaccard distance of the two sets, which are read again from the texts of those nodes.

    The texts are not shuffled to find them: the doc_ids' slots, ``SLOTS`` at most, go to all tasks; the few other texts
    that pass are dropped by doc_id and digest.
    """
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _pieces(batches):
            sets = list(blocks.shingle_sets(batch.column("text"), words, SLICE))
            keys = [blocks.digest(s) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([k[0] for k in keys], pa.int64()), pa.array([k[1] for k in keys], pa.int64()),
                 pa.array([s.tobytes() for s in sets], pa.binary())], ["doc_id", "d1", "d2", "shingles"])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = np.sort(np.concatenate([x, y]), kind="stable")
                shared = int((both[1:] == both[:-1]).sum())
                out.append((len(x) + len(y) - 2 * shared) / (len(x) + len(y) - shared))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(out, pa.float64())], ["a", "b", "distance"])

    pairs = scratch.write(pairs)
    wanted = scratch.write(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct().join(named, "node"))
    slot = F.pmod(F.xxhash64("doc_id"), F.lit(SLOTS)).alias("slot")
    slots = F.broadcast(wanted.select(slot).distinct())
    texts = docs.select("*", slot).join(slots, "slot", "left_semi").select("doc_id", "text")
    sets = texts.mapInArrow(blocks.returning(read), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, d1 long, d2 long, shingles binary")
    sets = scratch.write(sets.alias("s").join(wanted.alias("w"), F.expr("s.d1 = w.d1 AND s.d2 = w.d2 AND s.doc_id <=> w.doc_id"))
                             .select("w.node", F.col("s.shingles").alias("s")))
    both = (pairs.join(sets.select(F.col("node").alias("a"), F.col("s").alias("x")), "a")
                 .join(sets.select(F.col("node").alias("b"), F.col("s").alias("y")), "b"))
    return both.select("a", "b", "x", "y").mapInArrow(blocks.returning(measure), "a long, b long, distance double").distinct()
