"""Nearest neighbours by an inverted multi-index: two vector halves quantised apart, centroid pairs visited by summed distance.

Both codebooks come from a bounded sample; every vector is indexed. A query walks the centroid pairs in order of summed
distance with a heap until the visited cells hold enough vectors, and these are ranked by exact distance. How many are enough is
measured: a bounded set of probe vectors is compared with all rows, and the budget is the share of rows within which the
wanted part of their true neighbours lies. Equal vectors are one entry with the few smallest ids that any answer can name, so
a vector that a third of the rows repeat costs no more than one.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyline.sources.lake import Scratch

CENTROIDS = 64        # of each half, at most
SAMPLE = 20_000       # vectors the codebooks are trained on, at most about
PROBES = 96           # vectors compared with all rows to set the budget
RECALL = 0.97         # share of the probes' true neighbours that the budget must reach
ENTRIES = 4096        # vectors of a centroid of the first half in one task, about
QUERIES = 2048        # queries in one task, about


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, v) of rows that take part: not null, not zero, all components finite, of the most frequent length.

    Of rows that repeat a vec_id the smallest vector counts.
    """
    v = F.col("embedding").cast("array<double>")
    rows = vectors.select("vec_id", v.alias("v")).filter("vec_id IS NOT NULL AND v IS NOT NULL")
    rows = rows.filter(~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))).filter(F.exists("v", lambda x: x != 0))
    length = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.filter(F.size("v") == (length["n"] if length else 0)).groupBy("vec_id").agg(F.min("v").alias("v"))


def codebooks(rows: DataFrame, total: int, dimension: int, centroids: int, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """Centres of both halves, from about ``SAMPLE`` vectors; as many as keep a few vectors in a cell."""
    share = min(1.0, SAMPLE / total)
    sample = rows.filter(F.pmod(F.xxhash64("vec_id"), F.lit(1_000_000)) < share * 1_000_000)
    k = max(1, min(centroids, int((min(total, SAMPLE) / 2) ** 0.5)))
    half = max(1, dimension // 2)
    found = []
    for start, length in ((1, half), (half + 1, dimension - half)):
        if not length or k == 1:
            found.append(np.zeros((1, length)))
            continue
        points = sample.select(array_to_vector(F.slice("v", start, length)).alias("features"))
        found.append(np.array(KMeans(k=k, maxIter=10, seed=seed).fit(points).clusterCenters()))
    return found[0], found[1]


def _squares(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((points * points).sum(1)[:, None] - 2 * points @ centres.T + (centres * centres).sum(1)).clip(0)


def _walk(one: np.ndarray, two: np.ndarray) -> Iterator[tuple[int, int]]:
    """Centroid pairs by increasing summed distance (the multi-sequence algorithm)."""
    a, b = np.argsort(one, kind="stable"), np.argsort(two, kind="stable")
    heap, seen = [(one[a[0]] + two[b[0]], 0, 0)], {(0, 0)}
    while heap:
        _, i, j = heapq.heappop(heap)
        yield int(a[i]), int(b[j])
        for x, y in ((i + 1, j), (i, j + 1)):
            if x < len(a) and y < len(b) and (x, y) not in seen:
                seen.add((x, y))
                heapq.heappush(heap, (one[a[x]] + two[b[y]], x, y))


def search(vectors: DataFrame, is_query: Column, scratch: Scratch, neighbours: int = 10, centroids: int = CENTROIDS,
           recall: float = RECALL) -> DataFrame:
    """(query_id, rank, vec_id, score): the nearest found of each query of ``vectors(vec_id, embedding)``, ``is_query`` on vec_id.

    ``score`` is the Euclidean distance of the vectors in double precision, ties go to the smaller vec_id, a query never
    finds its own vec_id. Rows that ``usable`` leaves out are neither queries nor candidates. Fewer candidates than
    ``neighbours`` give fewer rows, an empty table none. Other columns are ignored.
    """
    spark = vectors.sparkSession
    rows = scratch.write(usable(vectors))
    first = Window.partitionBy("v").orderBy("vec_id")
    distinct = rows.withColumn("_n", F.row_number().over(first)).filter(F.col("_n") <= neighbours + 1)
    distinct = distinct.groupBy("v").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    some = rows.select(F.size("v").alias("n")).first()
    if some is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dimension, total = some["n"], rows.count()
    books = codebooks(rows, total, dimension, centroids)
    half = max(1, dimension // 2)
    held = spark.sparkContext.broadcast(books)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = _matrix(batch.column("v"), dimension)
            i, j = (_squares(p, c).argmin(1) for p, c in zip((points[:, :half], points[:, half:]), held.value, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), *batch.columns], ["i", "j", *batch.schema.names])

    entries = scratch.write(distinct.mapInArrow(index, "i int, j int, v array<double>, ids array<long>"))
    sizes = np.zeros((len(books[0]), len(books[1])), np.int64)
    for r in entries.groupBy("i", "j").count().collect():  # one row for each centroid pair at most
        sizes[r["i"], r["j"]] = r["count"]
    budget = _budget(entries, rows, sizes, books, half, dimension, neighbours, recall)
    cuts = [max(1, -(-int(n) // ENTRIES)) for n in sizes.sum(1)]

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points, out = _matrix(batch.column("v"), dimension), ([], [], [], [])
            for at, (one, two) in enumerate(zip(_squares(points[:, :half], held.value[0]), _squares(points[:, half:], held.value[1]), strict=True)):
                seen, cells = 0, {}
                for i, j in _walk(one, two):
                    if sizes[i, j]:
                        cells.setdefault(i, []).append(j)
                        seen += int(sizes[i, j])
                        if seen >= budget:
                            break
                for i, js in cells.items():
                    for cut in range(cuts[i]):
                        for column, value in zip(out, (at, i, cut, js), strict=True):
                            column.append(value)
            take = pa.array(out[0], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("query_id").take(take), batch.column("q").take(take), batch.column("v").take(take), pa.array(out[1], pa.int32()),
                 pa.array(out[2], pa.int32()), pa.array(out[3], pa.list_(pa.int32()))], ["query_id", "q", "v", "i", "cut", "js"])

    asked = rows.filter(is_query).withColumnRenamed("vec_id", "query_id")
    turns = max(1, -(-asked.count() // QUERIES))
    asked = asked.withColumn("q", F.pmod(F.xxhash64("query_id"), F.lit(turns)).cast("int")).select("query_id", "q", "v")
    routed = asked.repartition(max(1, min(turns * 8, 10_000))).mapInArrow(route, "query_id long, q int, v array<double>, i int, cut int, js array<int>")
    pieces = F.element_at(F.array(*map(F.lit, cuts)), F.col("i") + 1)
    spread = (entries.withColumn("cut", F.pmod(F.xxhash64(F.col("ids")[0]), pieces).cast("int"))
                     .withColumn("q", F.explode(F.sequence(F.lit(0), F.lit(turns - 1)))))

    def rank(left: pa.Table, right: pa.Table) -> pa.Table:
        out: tuple[list, ...] = ([], [], [])
        if left.num_rows and right.num_rows:
            points, js = _matrix(right.column("v").combine_chunks(), dimension), right.column("j").to_numpy()
            ids = right.column("ids").to_pylist()
            for query, v, cells in zip(left.column("query_id").to_pylist(), _matrix(left.column("v").combine_chunks(), dimension), left.column("js").to_pylist(), strict=True):
                wanted = np.zeros(sizes.shape[1], bool)
                wanted[cells] = True
                at = np.flatnonzero(wanted[js])
                distance = np.sqrt(((points[at] - v) ** 2).sum(1))
                if len(at) > neighbours + 1:
                    limit = np.partition(distance, neighbours)[neighbours]
                    near = distance <= limit
                    at, distance = at[near], distance[near]
                best = sorted((d, x) for d, p in zip(distance.tolist(), at, strict=True) for x in ids[p] if x != query)[:neighbours]
                for d, x in best:
                    for column, value in zip(out, (query, x, d), strict=True):
                        column.append(value)
        return pa.table({"query_id": pa.array(out[0], pa.int64()), "vec_id": pa.array(out[1], pa.int64()), "score": pa.array(out[2], pa.float64())})

    keys = ["i", "cut", "q"]
    near = routed.groupBy(*keys).cogroup(spread.groupBy(*keys)).applyInArrow(rank, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (near.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= neighbours)
                .select("query_id", "rank", "vec_id", "score"))


def _matrix(column: pa.Array, dimension: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimension)


def _budget(entries: DataFrame, rows: DataFrame, sizes: np.ndarray, books, half: int, dimension: int, neighbours: int, recall: float) -> int:
    """Vectors a query must visit so that ``recall`` of the probes' true neighbours are among them.

    ``PROBES`` vectors are compared with every entry in its task; each task returns the few nearest of each probe.
    """
    probes = rows.orderBy(F.xxhash64("vec_id", F.lit(3)), "vec_id").limit(PROBES).select("v").collect()
    points = np.array([p["v"] for p in probes])

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list[tuple[float, int, int]]] = [[] for _ in points]
        for batch in batches:
            own, i, j = _matrix(batch.column("v"), dimension), batch.column("i").to_numpy(), batch.column("j").to_numpy()
            for p, distance in enumerate(_squares(points, own)):
                close = np.argpartition(distance, neighbours)[:neighbours + 1] if len(distance) > neighbours + 1 else np.arange(len(distance))
                best[p] = sorted(best[p] + [(float(distance[c]), int(i[c]), int(j[c])) for c in close])[:neighbours + 1]
        flat = [(p, *b) for p, some in enumerate(best) for b in some]
        yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in flat], t) for k, t in enumerate((pa.int32(), pa.float64(), pa.int32(), pa.int32()))],
                                         ["p", "d", "i", "j"])

    found = entries.select("i", "j", "v").mapInArrow(nearest, "p int, d double, i int, j int")
    place = F.row_number().over(Window.partitionBy("p").orderBy("d", "i", "j"))
    needed = []
    one, two = _squares(points[:, :half], books[0]), _squares(points[:, half:], books[1])
    wanted: dict[int, list[tuple[int, int]]] = {}
    for r in found.withColumn("_n", place).filter(F.col("_n") <= neighbours + 1).collect():
        if r["_n"] > 1:  # the first is the probe itself
            wanted.setdefault(r["p"], []).append((r["i"], r["j"]))
    for p, cells in wanted.items():
        seen, upto = 0, {}
        for i, j in _walk(one[p], two[p]):
            seen += int(sizes[i, j])
            upto[i, j] = seen
        needed += [upto[c] for c in cells]
    if not needed:
        return int(sizes.sum())
    return int(np.sort(needed)[min(len(needed) - 1, int(np.ceil(recall * len(needed))))])
