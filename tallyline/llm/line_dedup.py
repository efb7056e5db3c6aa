"""Fuzzy line de-duplication: MinHash signatures of character shingles, banding, exact check, components, one line kept.

Lines are compared with A-Z as a-z and other white space as spaces. Equal lines are one node, found by 128 hash bits, so a
line in every document costs no more than one. Distinct lines get a one-permutation MinHash signature of ``BANDS * ROWS``
bins (an empty bin takes the next filled one), and each band of it is a region. Texts of the lines that share a region are
compared inside a task on their whole shingle sets, and a distributed union-find over the links gives components. At
similarity 0.75 a pair meets in at least one band with probability 0.998.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import ArrowUDFType

from tallyline.llm import blocks, graph, regions
from tallyline.sources.lake import Scratch

CHARS = 8           # characters of a shingle
BANDS, ROWS = 16, 4
PERCENT = 75
TURNS = 4           # the bands are shuffled in so many turns, so that fewer of their rows are on disk at a time
ENTRIES = 1 << 18   # keys of a band, about, that a task sorts at a time
BUCKETS = 64        # buckets that the keys of a band are packed in; they are cut finer before the shuffle where ``ENTRIES`` asks for it
PACKED = 1 << 16    # lines whose keys are packed together
BATCH = graph.BATCH
_small_batches = graph.small_batches
BITS = 8            # bits of the map of wanted lines for each of them
MAP_BITS = 1 << 27  # bits of that map at most
CELL = 512          # lines of a region that one task compares at a time
FEW = 8             # cells up to this size are compared together, pair by pair, larger ones as a matrix
LONG = 2000         # distinct shingles of a line, above which its text does not travel with its regions
CODE = 48           # bits of a shingle's hash that a comparison looks at, beside 16 for the line
SLICE = 128 << 10   # bytes of text read at a time; the arrays of one slice stay in the caches of a core that shares its memory


_FOLD = bytes.maketrans(bytes([*range(65, 91), 9, 11, 12, 13]), bytes([*range(97, 123), 32, 32, 32, 32]))


def _lines(data: np.ndarray, offsets: np.ndarray):
    """(folded code points, start, end, text, number) of the lines of a slice that are not blank."""
    raw = data.tobytes().translate(_FOLD)
    folded = np.frombuffer(raw.decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    bounds = offsets
    if len(data) and data.max() > 127:
        some, heads = offsets[1:] > offsets[:-1], np.zeros(len(offsets), np.int64)
        heads[1:][some] = np.add.reduceat((data & 0xC0) != 0x80, offsets[:-1][some], dtype=np.int64)
        bounds = np.cumsum(heads)
        if bounds[-1] != len(folded):  # not UTF-8: bytes stand for characters
            folded, bounds = np.frombuffer(raw, np.uint8).astype(np.uint32), offsets
    breaks = np.flatnonzero(folded == 10)
    start = np.unique(np.concatenate([bounds[:-1], breaks + 1]))
    start = start[start < len(folded)]
    text = np.searchsorted(bounds, start, "right") - 1
    after = np.searchsorted(breaks, start)
    end = np.minimum(np.append(breaks, len(folded))[after], bounds[text + 1])
    number = after - np.searchsorted(breaks, bounds[text])
    full = start < end
    for k in np.flatnonzero(full & (folded[start] == 32)):
        full[k] = (folded[start[k]:end[k]] != 32).any()
    return folded, start[full], end[full], text[full], number[full]


_VALUES = blocks.mix(np.arange(1, (1 << 16) + 1, dtype=np.uint64))


def _values(folded: np.ndarray) -> np.ndarray:
    if not len(folded) or folded.max() < len(_VALUES):
        return _VALUES[folded]
    return blocks.mix(folded.astype(np.uint64) + np.uint64(1))


def _shingles(value: np.ndarray, start: np.ndarray, end: np.ndarray, chars: int) -> tuple[np.ndarray, np.ndarray]:
    """(line, hash) of every shingle of lines, lines in order; a line shorter than a shingle is one itself.

    The hash of 2 m characters comes from those of m: h(i) + p**m h(i + m).
    """
    spans = end - start
    count = np.maximum(spans - chars + 1, 1)
    line = np.repeat(np.arange(len(start)), count)
    rolled, product, done = value.copy(), np.empty_like(value), 1
    while done < chars:
        step = min(done, chars - done)  # the last step may overlap, which is still a function of the window alone
        if step < len(rolled):
            np.multiply(rolled[step:], blocks.powers(done + 1)[done], out=product[step:])
            rolled[:-step] += product[step:]
        done += step
    marks = np.zeros(len(value) + 1, np.int8)
    marks[start] += 1
    marks[start + count] -= 1
    hashes = rolled[np.cumsum(marks[:-1], dtype=np.int8).view(bool)]
    first = np.cumsum(count) - count
    for k in np.flatnonzero(spans < chars):
        own = value[start[k]:end[k]]
        hashes[first[k]] = (own * blocks.powers(chars + 1)[1:len(own) + 1]).sum() + np.uint64(len(own))
    return line, blocks.mix(hashes)


def _digests(folded: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits for each line, from its characters in order."""
    raw, size = memoryview(folded).cast("B"), folded.itemsize
    found = [blake2b(raw[a:b], digest_size=16).digest() for a, b in zip((start * size).tolist(), (end * size).tolist(), strict=True)]
    both = np.frombuffer(b"".join(found), np.int64).reshape(-1, 2)
    return both[:, 0].copy(), both[:, 1].copy()


def _signatures(line: np.ndarray, hashes: np.ndarray, n: int, bands: int, rows: int) -> np.ndarray:
    """A region key for each line and band."""
    bins = bands * rows
    least = np.full(n * bins, np.uint64(2**64 - 1))
    at = hashes >> np.uint64(32)
    at *= np.uint64(bins)
    at >>= np.uint64(32)
    at += np.repeat(np.arange(n, dtype=np.uint64) * np.uint64(bins), np.bincount(line, minlength=n))
    np.minimum.at(least, at.view(np.int64), hashes.view(np.uint64))  # types of arrays sent with a function are copies, which ufunc.at takes 20 times as long for
    filled = least < np.uint64(2**64 - 1)
    empty, filled = np.flatnonzero(~filled), np.flatnonzero(filled)
    row, place = empty // bins, np.searchsorted(filled, empty)
    following = filled[np.minimum(place, len(filled) - 1)]  # an empty bin takes the next filled one, the last ones the first
    around = (following < empty) | (following >= (row + 1) * bins)
    following[around] = filled[np.searchsorted(filled, row[around] * bins)]
    gap = (following - empty + bins * around).astype(np.uint64)
    least[empty] = least[following] + gap * np.uint64(0x9E3779B97F4A7C15)
    least = least.reshape(n, bins)
    keys = np.repeat(np.arange(1, bands + 1, dtype=np.uint64)[None, :], n, axis=0)
    for r in range(rows):
        keys = blocks.mix(keys * np.uint64(31) + least[:, r::rows][:, :bands])
    return keys.view(np.int64)


def _turns(bands: int) -> list[range]:
    """The bands of each turn."""
    turn = -(-bands // TURNS)
    return [range(first, min(first + turn, bands)) for first in range(0, bands, turn)]


def _read_lines(docs: DataFrame, kind: str, percent: int, chars: int, bands: int, rows: int) -> DataFrame:
    """(doc_id, row, line, h1, h2, n, first, bucket, entries_0, ...) of every line that is not blank, ``first`` of its text or not.

    Other rows have only ``bucket`` and, in the column of the band's turn, the packed keys that ``_packs`` gives.
    """
    turns = _turns(bands)
    names = ["doc_id", "row", "line", "h1", "h2", "n", "first", "bucket", *[f"entries_{i}" for i in range(len(turns))]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            ids, texts = batch.column("doc_id"), batch.column("row")
            found = []
            for first, data, offsets in blocks.text_slices(batch.column("text"), SLICE):
                folded, start, end, text, number = _lines(data, offsets)
                if not len(start):
                    continue
                line, hashes = _shingles(_values(folded), start, end, chars)
                h1, h2 = _digests(folded, start, end)
                count = np.maximum(end - start - chars + 1, 1)
                for k in np.flatnonzero(count > LONG * percent // 100):  # exact where ``n`` may decide
                    own = np.sort(hashes[slice(*np.searchsorted(line, [k, k + 1]))])
                    count[k] = 1 + np.count_nonzero(own[1:] != own[:-1])
                found.append((text + first, number.astype(np.int64), h1, h2, count, np.append(True, text[1:] != text[:-1])))
                held.append((h1, _signatures(line, hashes, len(start), bands, rows)))
                size += len(start)
                if size >= PACKED:
                    yield from packs(held, ids.type)
                    held, size = [], 0
            if found:
                at, *columns = (np.concatenate(x) for x in zip(*found, strict=True))
                at = pa.array(at)
                yield pa.RecordBatch.from_arrays(
                    [ids.take(at), texts.take(at), *map(pa.array, columns), pa.nulls(len(at), pa.int64()),
                     *[pa.nulls(len(at), pa.binary())] * len(turns)], names)
        if held:
            yield from packs(held, ids.type)

    def packs(held: list[tuple[np.ndarray, np.ndarray]], kind: pa.DataType) -> Iterator[pa.RecordBatch]:
        for band, bucket, entries in _packs(*(np.concatenate(x) for x in zip(*held, strict=True))):
            none = [pa.nulls(len(bucket), t) for t in (kind, *[pa.int64()] * 5, pa.bool_())]
            yield pa.RecordBatch.from_arrays(
                [*none, bucket, *[entries if band in t else pa.nulls(len(bucket), pa.binary()) for t in turns]], names)

    packed = "".join(f", entries_{i} binary" for i in range(len(turns)))
    return docs.mapInArrow(blocks.returning(run), f"doc_id {kind}, row long, line long, h1 long, h2 long, n long, first boolean, bucket long{packed}")


def _blobs(entries: np.ndarray, count: np.ndarray) -> pa.Array:
    """Rows of a matrix one after another as binary values of ``count`` rows each."""
    ends = np.concatenate([[0], np.cumsum(count)]) * (entries.shape[1] * entries.itemsize)
    return pa.Array.from_buffers(pa.binary(), len(count), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(entries))])


def _packs(h1: np.ndarray, keys: np.ndarray) -> Iterator[tuple[int, pa.Array, pa.Array]]:
    """(band, buckets, entries): for each band the (key, h1) of lines, equal lines once, by the first bits of the key."""
    order = np.argsort(h1, kind="stable")
    fresh = np.ones(len(h1), bool)
    fresh[1:] = (h1[order[1:]] != h1[order[:-1]]) | (keys[order[1:], 0] != keys[order[:-1], 0])
    use = order[fresh]
    for band in range(keys.shape[1]):
        key = keys[use, band]
        bucket = (key.view(np.uint64) >> np.uint64(32)) * np.uint64(BUCKETS) >> np.uint64(32)
        order = np.argsort(bucket.astype(np.uint16), kind="stable")
        count = np.bincount(bucket.astype(np.int64), minlength=BUCKETS)
        live = np.flatnonzero(count)
        yield band, pa.array(live + band * BUCKETS), _blobs(np.stack([key[order], h1[use[order]]], axis=1), count[live])


def duplicates(docs: DataFrame, scratch: Scratch, percent: int = PERCENT, chars: int = CHARS, bands: int = BANDS,
               rows: int = ROWS, cell: int = CELL) -> DataFrame:
    """Every line of ``docs(doc_id, text)`` that is not blank: (doc_id, row, line, n_copies, keeper_doc_id, keeper_line, kept).

    ``line`` counts from 0 at each ``\\n``; ``row`` is a hash of the text. Lines whose character-shingle sets have
    a Jaccard similarity of ``percent`` hundredths or more, directly or through others, form a component of ``n_copies`` lines. Of each
    the line with the smallest (doc_id, line, row) is kept, lines without doc_id last. Lines shorter than ``chars`` match equal ones only. Null
    and empty texts have no lines. Rows that repeat doc_id and text are one row and come back once. Other columns are ignored.
    ``cell`` bounds the lines that a task compares at a time; it never changes the result.
    """
    spark, kind = docs.sparkSession, docs.schema["doc_id"].dataType.simpleString()
    docs = docs.select("doc_id", "text", F.xxhash64("text").alias("row"))
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "line", "row")
    with Scratch(spark) as wide, _small_batches(spark):  # the keys of all lines, needed until regions are known
        keyed = wide.write(_read_lines(docs, kind, percent, chars, bands, rows).select(F.monotonically_increasing_id().alias("id"), "*"))
        lines = keyed.filter("bucket IS NULL").select("id", "doc_id", "row", "line", "h1", "h2", "n", "first")
        repeated = scratch.write(lines.filter("first").groupBy("doc_id", "row").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"))
        if not repeated.isEmpty():
            lines, docs = (scratch.write(_once(df, repeated, keys)) for df, keys in ((lines, ["doc_id", "row", "line"]), (docs, ["doc_id", "row"])))
        nodes = scratch.write(lines.groupBy("h1", "h2").agg(
            F.min("id").alias("node"), F.min("n").alias("n"), F.count(F.lit(1)).alias("copies"),
            *[F.first(c).alias(c) for c in ("doc_id", "row", "line")]))  # the place of a line without copies, else any of its places
        graph.release(spark)
        shared = nodes.filter("copies > 1")
        copies = scratch.write(_Marks(shared, ["h1"], scratch).of(lines.select("h1", "h2", "doc_id", "row", "line")))
        members = scratch.write(_regions(keyed, nodes, bands, wide))
    graph.release(spark)
    with _small_batches(spark):
        found = scratch.write(_connect(docs, members, percent, chars, bands, cell, scratch))
    alone = nodes.filter("copies = 1")
    linked = _Marks(found, ["node"], scratch)
    least = copies.groupBy("h1", "h2").agg(F.min(place).alias("least"))
    held = linked.of(alone).select("h1", "h2", "node", "copies", place.alias("least")).unionByName(
        shared.select("h1", "h2", "node", "copies").join(least, ["h1", "h2"]))  # lines that have copies or may have links
    held = held.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    keeper = held.groupBy("component").agg(F.min("least").alias("keeper"), F.sum("copies").alias("n_copies"))
    known = scratch.write(held.join(keeper, "component").select("h1", "h2", "copies", "least", "keeper", "n_copies"))
    out = ["doc_id", "row", "line", "n_copies", F.col("keeper.doc_id").alias("keeper_doc_id"), F.col("keeper.line").alias("keeper_line"),
           (place == F.col("keeper")).alias("kept")]
    return (linked.of(alone, False).withColumns({"keeper": place, "n_copies": F.col("copies")}).select(*out)
            .unionByName(known.filter("copies = 1").select("least.*", "keeper", "n_copies").select(*out))
            .unionByName(copies.join(known.filter("copies > 1").select("h1", "h2", "keeper", "n_copies"), ["h1", "h2"]).select(*out)))


def _once(df: DataFrame, repeated: DataFrame, keys: list[str]) -> DataFrame:
    """``df`` with one row for each ``keys`` of the ``repeated(doc_id, row)``; its other rows stay."""
    again = F.col("d.doc_id").eqNullSafe(F.col("r.doc_id")) & F.col("d.row").eqNullSafe(F.col("r.row"))
    apart = lambda how: df.alias("d").join(repeated.alias("r"), again, how)
    return apart("left_anti").unionByName(apart("left_semi").dropDuplicates(keys))


def _regions(keyed: DataFrame, nodes: DataFrame, bands: int, scratch: Scratch) -> DataFrame:
    """(node, doc_id, row, line, n, region, band, size): the regions that hold different lines, with these lines.

    A region counts as such if its smallest and largest digest differ. Keys travel packed in buckets, with equal lines of a
    pack joined beforehand, and a task sorts one bucket at a time. Of regions that hold the same lines one is enough.
    """
    total, parts = nodes.agg(F.sum("copies")).first()[0] or 0, []
    finer = max(1, -(-total // (ENTRIES * BUCKETS)))
    for i, _ in enumerate(_turns(bands)):
        packed = keyed.select("bucket", F.col(f"entries_{i}").alias("entries")).filter("entries IS NOT NULL")
        if finer > 1:
            packed = packed.mapInArrow(blocks.returning(_cut(finer)), "bucket long, entries binary")
        ordered = packed.repartition("bucket").sortWithinPartitions("bucket")
        parts.append(scratch.write(ordered.mapInArrow(blocks.returning(_meet), "bucket long, region long, h1 long").select(
            F.floor(F.col("bucket") / (BUCKETS * finer)).cast("int").alias("band"), "region", "h1")))
        graph.release(keyed.sparkSession)
    met = reduce(DataFrame.unionByName, parts)
    sizes = met.groupBy("region").agg(
        F.count(F.lit(1)).alias("size"), F.bit_xor(F.xxhash64("h1")).alias("x"), F.bit_xor(F.xxhash64(F.lit(1), "h1")).alias("y"))
    sizes = scratch.write(sizes.groupBy("size", "x", "y").agg(F.min("region").alias("region")).select("region", "size"))
    return met.join(sizes, "region").join(nodes.select("h1", "node", "n", "doc_id", "row", "line"), "h1").drop("h1")


def _cut(finer: int):
    """Rows (bucket, entries) to ``finer`` buckets for each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, blob in zip(batch.column("bucket").to_pylist(), batch.column("entries"), strict=True):
                entries = np.frombuffer(blob.as_buffer(), np.int64).reshape(-1, 2)
                high = (entries[:, 0].view(np.uint64) >> np.uint64(32)) * np.uint64(BUCKETS)  # the first bits are the bucket's own
                part = ((high & np.uint64(2**32 - 1)) * np.uint64(finer) >> np.uint64(32)).astype(np.int64)
                count = np.bincount(part, minlength=finer)
                live = np.flatnonzero(count)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(live + name * finer), _blobs(entries[np.argsort(part, kind="stable")], count[live])], ["bucket", "entries"])

    return run


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (bucket, entries), ordered by bucket, to the (bucket, region, h1) of regions with different lines."""
    def settle(bucket: int, blobs: list[bytes]) -> pa.RecordBatch:
        key, h1 = np.frombuffer(b"".join(blobs), np.int64).reshape(-1, 2).T
        order = np.argsort(key)
        key, h1 = key[order], h1[order]
        starts = np.concatenate([[0], np.flatnonzero(key[1:] != key[:-1]) + 1])
        live = np.repeat(np.minimum.reduceat(h1, starts) != np.maximum.reduceat(h1, starts), np.diff(np.append(starts, len(key))))
        key, h1 = key[live], h1[live]
        order = np.lexsort((h1, key))
        key, h1 = key[order], h1[order]
        fresh = np.ones(len(key), bool)
        fresh[1:] = (key[1:] != key[:-1]) | (h1[1:] != h1[:-1])
        return pa.RecordBatch.from_arrays([pa.array(np.full(int(fresh.sum()), bucket)), pa.array(key[fresh]), pa.array(h1[fresh])], ["bucket", "region", "h1"])

    last, held = None, []
    for batch in batches:
        names, blobs = batch.column("bucket").to_pylist(), batch.column("entries")
        for i, name in enumerate(names):
            if held and name != last:
                yield settle(last, held)
                held = []
            last = name
            held.append(blobs[i].as_py())
    if held:
        yield settle(last, held)


def _connect(docs: DataFrame, members: DataFrame, percent: int, chars: int, bands: int, cell: int, scratch: Scratch) -> DataFrame:
    """(node, component) of the lines that share regions, by exact comparison inside each region and union-find over its links.

    A task reads the texts of a region and links them by a forest, so no pair is written that does not link. A region
    above ``cell`` lines is first cut into parts; then lines outside the region's largest component, which are few once near
    copies are joined, meet all lines of the region in cells of bounded size. Lines of more than ``LONG`` shingles
    go to ``regions.connect``, which moves places of lines instead of their texts.
    """
    own = F.collect_list(F.struct("band", "region", "size")).alias("all")
    with Scratch(docs.sparkSession) as narrow:
        wanted = narrow.write(members.groupBy("node").agg(F.first(F.struct("n", "doc_id", "row", "line")).alias("at"), own).select("node", "at.*", "all"))
        held = scratch.write(_texts(narrow, docs, wanted))
    graph.release(docs.sparkSession)
    short = held.filter(F.col("n") <= LONG)
    dealt = short.select("node", "words", "all", F.explode("all").alias("m")).select("node", "words", "all", "m.*")
    parts = F.ceil(F.col("size") / cell)
    links = scratch.write(_linked(dealt.withColumn("cell", F.pmod(F.xxhash64("node"), parts)), percent, chars, bands, True))
    graph.release(docs.sparkSession)
    large = scratch.write(dealt.filter(F.col("size") > cell).select("node", "region", "band"))
    if not large.isEmpty():
        found = scratch.write(graph.components(links, scratch))
        crossed = _crossed(large, found, cell).join(short, "node")
        links = scratch.write(links.unionByName(_linked(crossed, percent, chars, bands, False)))
    long = members.filter(F.col("n") > LONG * percent // 100)
    if not long.filter(F.col("n") > LONG).isEmpty():
        texts = scratch.write(held.filter(F.col("n") > LONG * percent // 100).select("node", "words"))
        found, _ = regions.connect(
            [long.select("region", F.col("node").alias("id"), "n", F.lit(0).alias("place"))],
            lambda pairs: _distances(texts, pairs, chars), lambda *_: F.lit(True), percent, scratch)
        links = links.unionByName(found.select(F.col("node").alias("a"), F.col("component").alias("b")))
    return graph.components(links, scratch)


def _crossed(large: DataFrame, found: DataFrame, cell: int) -> DataFrame:
    """(node, region, band, cell) of large regions with several components: each line outside the largest meets every line once."""
    known = large.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    counts = known.groupBy("region", "component").agg(F.count(F.lit(1)).alias("n"))
    main = counts.groupBy("region").agg(
        F.max_by("component", F.struct("n", "component")).alias("main"), F.max("n").alias("top"), F.sum("n").alias("size")).filter("top < size")
    half = max(1, cell // 2)
    rows = (known.join(main, "region").withColumn("across", F.ceil((F.col("size") - F.col("top")) / half))
                 .withColumn("along", F.ceil(F.col("size") / half)))
    at = lambda seed, parts: F.pmod(F.xxhash64("node", F.lit(seed)), F.col(parts))
    column = F.transform(F.sequence(F.lit(0).cast("bigint"), F.col("across") - 1), lambda i: i * F.col("along") + at(1, "along"))
    line = F.transform(F.sequence(F.lit(0).cast("bigint"), F.col("along") - 1), lambda j: at(2, "across") * F.col("along") + j)
    cells = F.when(F.col("component") == F.col("main"), column).otherwise(F.array_union(column, line))
    return rows.select("node", "region", "band", F.explode(cells).alias("cell"))


def _linked(rows: DataFrame, percent: int, chars: int, bands: int, once: bool) -> DataFrame:
    """(a, b) joining the lines of each (region, cell) into components; ``rows(node, words, all, region, band, cell)``.

    With ``once`` a pair of small regions is left to the first region that both lines share.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _whole_cells(batches):
            a, b = _forest(group, percent, chars, bands, once)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    ordered = rows.select("region", "cell", "band", "node", "all", "words").repartition("region", "cell").sortWithinPartitions("region", "cell")
    return ordered.mapInArrow(blocks.returning(run), "a long, b long").distinct()


def _whole_cells(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.Table]:
    """Tables of about ``rows`` rows that end where a cell ends."""
    held: list[pa.RecordBatch] = []
    for whole in batches:
        for begin in range(0, whole.num_rows, rows):
            held.append(whole.slice(begin, rows))
            table = pa.Table.from_batches(held).combine_chunks()
            region, cell = table.column("region").to_numpy(), table.column("cell").to_numpy()
            ends = np.flatnonzero((region[1:] != region[:-1]) | (cell[1:] != cell[:-1])) + 1
            if len(ends):
                yield table.slice(0, ends[-1])
                held = table.slice(ends[-1]).to_batches()
            else:
                held = table.to_batches()
    if held:
        yield pa.Table.from_batches(held)


def _forest(table: pa.Table, percent: int, chars: int, bands: int, once: bool) -> tuple[np.ndarray, np.ndarray]:
    """Links that join the lines of each cell of ``table`` into the components of their similarity graph."""
    table = table.combine_chunks()
    region, cell, band, node = (table.column(c).to_numpy() for c in ("region", "cell", "band", "node"))
    if not len(node):
        return node, node
    starts = np.concatenate([[0], np.flatnonzero((region[1:] != region[:-1]) | (cell[1:] != cell[:-1])) + 1])
    sizes = np.diff(np.append(starts, len(node)))
    left, right, out_a, out_b = [], [], [], []
    for size in np.unique(sizes[(sizes > 1) & (sizes <= FEW)]):  # small cells of one size at a time
        i, j = np.triu_indices(size, 1)
        first = starts[sizes == size][:, None]
        left.append((first + i).ravel())
        right.append((first + j).ravel())
    x, y = (np.concatenate([np.zeros(0, np.int64), *z]) for z in (left, right))
    if once and len(x):
        own = table.column("all").chunk(0)
        at = np.repeat(np.arange(len(node)), np.diff(own.offsets.to_numpy()))
        keys = np.zeros((len(node), bands), np.int64)
        live = np.zeros((len(node), bands), bool)
        flat = own.flatten()
        keys[at, flat.field("band").to_numpy()] = flat.field("region").to_numpy()
        live[at, flat.field("band").to_numpy()] = True
        shared = (keys[x] == keys[y]) & live[x] & live[y]
        mine = shared.argmax(axis=1) == band[x]
        x, y = x[mine], y[mine]
    use = np.repeat(sizes > FEW, sizes)  # lines that are compared here
    use[x] = use[y] = True
    if not use.any():
        return node[:0], node[:0]
    codes, begin = _coded(table.column("words").chunk(0).filter(pa.array(use)), chars)
    begin = begin[np.concatenate([[0], np.cumsum(use)])]
    n = np.diff(begin)
    if len(x):
        near = 100 * np.minimum(n[x], n[y]) >= percent * np.maximum(n[x], n[y])
        x, y = x[near], y[near]
        for k in range(0, len(x), 20_000):
            p, q = x[k:k + 20_000], y[k:k + 20_000]
            both = _common(codes, begin, n, p, q)
            linked = 100 * both >= percent * (n[p] + n[q] - both)
            out_a.append(node[p[linked]])
            out_b.append(node[q[linked]])
    for first, size in zip(starts[sizes > FEW], sizes[sizes > FEW], strict=True):
        label = _labels(codes[begin[first]:begin[first + size]], n[first:first + size], percent)
        out_a.append(node[first:first + size])
        out_b.append(node[first + label])
    a, b = (np.concatenate([np.zeros(0, np.int64), *z]) for z in (out_a, out_b))
    return a[a != b], b[a != b]


def _common(codes: np.ndarray, begin: np.ndarray, n: np.ndarray, p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """The number of codes that sets p[k] and q[k] have in common, for each k below 2**(64 - CODE)."""
    rows = np.concatenate([p, q])
    count = n[rows]
    at = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count) + np.repeat(begin[rows], count)
    pair = np.repeat(np.tile(np.arange(len(p), dtype=np.uint64), 2), count)
    held = np.sort(pair << np.uint64(CODE) | codes[at])
    twice = held[1:][held[1:] == held[:-1]] >> np.uint64(CODE)
    return np.bincount(twice.astype(np.int64), minlength=len(p))


def _labels(codes: np.ndarray, n: np.ndarray, percent: int) -> np.ndarray:
    """For each set of a cell the first one of its component; counts in common come from products of 0-1 matrices."""
    values, dense, times = np.unique(codes, return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(n)), n)
    frequent = times > 1  # a code of one set alone is in no intersection
    number = np.cumsum(frequent) - 1
    use = frequent[dense]
    row, column = row[use], number[dense[use]]
    both = np.zeros((len(n), len(n)), np.float32)
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    for low in range(0, int(frequent.sum()), 4096):
        part = slice(*np.searchsorted(column, [low, low + 4096]))
        ones = np.zeros((len(n), 4096), np.float32)
        ones[row[part], column[part] - low] = 1
        both += ones @ ones.T
    linked = 100 * both >= percent * (n[:, None] + n[None, :] - both)
    label = np.arange(len(n))
    while True:
        least = np.where(linked, label[None, :], len(n)).min(axis=1)
        least = np.minimum(least, label)
        if (least == label).all():
            return label
        label = least[least]


def _column_shingles(column: pa.Array, chars: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of every shingle of a column of lines, rows in order."""
    raw = column.cast(pa.large_string())
    offsets = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset:raw.offset + len(raw) + 1]
    folded, start, end, text, _ = _lines(np.frombuffer(raw.buffers()[2], np.uint8)[offsets[0]:offsets[-1]], offsets - offsets[0])
    line, hashes = _shingles(_values(folded), start, end, chars)
    return text[line], hashes


def _coded(column: pa.Array, chars: int) -> tuple[np.ndarray, np.ndarray]:
    """(codes, bounds): the shingle sets of a column's lines one after another, and where each begins.

    A code is the upper ``CODE`` bits of a shingle's hash, so that one sort of (row, code) in 64 bits gives all sets.
    """
    row, hashes = _column_shingles(column, chars)
    held, last = [], np.zeros(0, np.uint64)
    for first in range(0, max(1, len(column)), 1 << 64 - CODE):
        part = slice(*np.searchsorted(row, [first, first + (1 << 64 - CODE)]))
        key = np.sort((row[part] - first).astype(np.uint64) << np.uint64(CODE) | hashes[part] >> np.uint64(64 - CODE))
        key = key[np.concatenate([np.ones(min(1, len(key)), bool), key[1:] != key[:-1]])]
        held.append(key & np.uint64((1 << CODE) - 1))
        last = np.concatenate([last, (key >> np.uint64(CODE)) + np.uint64(first)])
    return np.concatenate(held), blocks.row_bounds(last, len(column))


def _sets(column: pa.Array, chars: int) -> list[np.ndarray]:
    """The shingle set of each line of a column."""
    row, hashes = _column_shingles(column, chars)
    at = blocks.row_bounds(row, len(column))
    return [np.unique(hashes[at[i]:at[i + 1]]) for i in range(len(column))]


def _texts(scratch: Scratch, docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, n, all, words): the lines ``wanted(node, n, doc_id, row, line, all)`` with their texts, found by place."""
    texts = _Marks(wanted, ["row"], scratch).of(docs.select("doc_id", "row", "text"))
    lines = texts.select("doc_id", "row", F.posexplode(F.split("text", "\n")).alias("at", "words")).withColumn("line", F.col("at").cast("long"))
    same = "l.row = w.row AND l.line = w.line AND l.doc_id <=> w.doc_id"
    return _Marks(wanted, ["row", "line"], scratch).of(lines).alias("l").join(wanted.alias("w"), F.expr(same)).select(
        "w.node", "w.n", "w.all", "l.words")


class _Marks:
    """A map with ``BITS`` bits for each row of a table, ``MAP_BITS`` at most, that is sent to all tasks in rows of 4 KB.

    ``of`` gives the rows of another table whose key has a bit: those with a key of the first table and a few others, so that only
    these are shuffled; with ``inside`` False it gives the rest.
    """

    def __init__(self, wanted: DataFrame, keys: list[str], scratch: Scratch):
        self.keys, self.bits = keys, min(MAP_BITS, max(1 << 10, BITS * wanted.count()))
        bits = wanted.groupBy(F.bitmap_bucket_number(self._slot()).alias("chunk")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position(self._slot())).alias("map"))
        words = "transform(sequence(0, octet_length(map) DIV 8 - 1), i -> CAST(conv(hex(substring(map, 8 * i + 1, 8)), 16, -10) AS bigint))"
        self.map = scratch.write(bits.select(F.col("chunk").alias("_chunk"), F.expr(words).alias("_map")))

    def _slot(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.bits)) + 1

    def of(self, df: DataFrame, inside: bool = True) -> DataFrame:
        known = df.withColumns({"_chunk": F.bitmap_bucket_number(self._slot()), "_bit": F.bitmap_bit_position(self._slot())}).join(
            F.broadcast(self.map), "_chunk", "left")
        bit = F.expr("shiftright(_map[CAST(_bit DIV 64 AS INT)], CAST((7 - _bit % 64 DIV 8) * 8 + _bit % 8 AS INT)) & 1")
        return known.filter((F.coalesce(bit, F.lit(0)) == 1) == F.lit(inside)).select(*df.columns)


def _distances(texts: DataFrame, pairs: DataFrame, chars: int) -> DataFrame:
    """``pairs(a, b)`` with the exact Jaccard distance of the two lines' shingle sets; ``texts(node, words)`` holds the lines."""
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for begin in range(0, whole.num_rows, 1000):
                batch, out = whole.slice(begin, 1000), []
                for x, y in zip(_sets(batch.column("x"), chars), _sets(batch.column("y"), chars), strict=True):
                    both = np.sort(np.concatenate([x, y]))
                    shared = int((both[1:] == both[:-1]).sum())
                    out.append((len(both) - 2 * shared) / (len(both) - shared))
                yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(out, pa.float64())], ["a", "b", "distance"])

    both = (pairs.join(texts.select(F.col("node").alias("a"), F.col("words").alias("x")), "a")
                 .join(texts.select(F.col("node").alias("b"), F.col("words").alias("y")), "b"))
    return both.select("a", "b", "x", "y").mapInArrow(blocks.returning(measure), "a long, b long, distance double").distinct()


def remove(docs: DataFrame, scratch: Scratch, **settings) -> DataFrame:
    """``docs`` without the lines that are not kept; a text that loses its last word with them goes, other texts stay.

    Blank lines stay where they are, texts without words stay as they are, and ``n_chars`` is set anew where it exists. Rows that
    repeat doc_id and text lose the same lines and stay as many as they are.
    """
    lost = (duplicates(docs, scratch, **settings).filter("NOT kept").groupBy("row", "doc_id")
            .agg(F.array_sort(F.collect_set("line")).alias("_lost")))

    def run(columns: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, lost_lines in columns:
            out = []
            for text, gone in zip(texts, lost_lines, strict=True):
                text, gone = text.as_py(), gone.as_py()
                if text is not None and gone:
                    gone = set(gone)
                    text = "\n".join(x for i, x in enumerate(text.split("\n")) if i not in gone)
                    text = text if text.strip(" \t\n\v\f\r") else None
                    out.append((text, text is not None))
                else:
                    out.append((text, True))
            yield pa.StructArray.from_arrays([pa.array([o[0] for o in out], pa.string()), pa.array([o[1] for o in out])], ["text", "stays"])

    cut = F.arrow_udf(blocks.returning(run), "text string, stays boolean", ArrowUDFType.SCALAR_ITER).asNondeterministic()
    joined = (docs.alias("d").join(lost.alias("l"), (F.xxhash64("d.text") == F.col("l.row")) & F.col("d.doc_id").eqNullSafe(F.col("l.doc_id")), "left")
              .select(F.struct("d.*").alias("_row"), "l._lost").withColumn("_new", cut(F.expr("IF(_lost IS NULL, NULL, _row.text)"), F.col("_lost"))))  # other texts need not travel
    new = F.expr("IF(_lost IS NULL, _row.text, _new.text)")
    values = {"text": new, "n_chars": F.length(new).cast(docs.schema["n_chars"].dataType) if "n_chars" in docs.columns else None}
    return joined.filter("_new.stays").select(*[(values[c] if c in values else F.col(f"_row.`{c}`")).alias(c) for c in docs.columns])
