"""Prefix trie of conversations, built in sorted shards around a skeleton of splitter paths.

A conversation's path is the row of its turns' digests, so conversations that share a beginning lie side by side in path order.
The order is cut into range shards at splitters taken from a sample. A node whose path does not begin a splitter has its whole
subtree in one shard: a sorted shard opens and closes its nodes like a stack and hands them on finished. The few nodes that do
begin a splitter are the skeleton. Its paths are broadcast; every shard gives partial figures for the skeleton nodes it meets,
and groupings put them together.

Copies of one conversation may lie in many shards, as splitters hold the conversation id too. The ids that end in a skeleton
node come in sorted chunks of text, and one stream over the chunks of a node makes its hash.
"""

from __future__ import annotations

import bisect
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.sources.lake import Scratch

DIGEST = 16
SHARD_ROWS = 2_000     # conversations in a shard, about, as long as there are at most MAX_SHARDS
MAX_SHARDS = 2_000
SAMPLE = 10            # sampled conversations for each shard; they decide where shards end, never a result
SKELETON_TURNS = 128   # turns of a sampled path: the sample has MAX_SHARDS * SAMPLE * 2 KB = 41 MB at most
CHUNK_IDS = 1_000      # ids of one piece of a skeleton node's list
_FIRST = -(1 << 63)
_EMPTY = hashlib.sha256(b"").hexdigest()

_NODE = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
         "ends_sha256 string, skeleton int, parent_skeleton int, ids string, first_id long, turn_bytes long")


def rebuilt(turns: DataFrame, scratch: Scratch) -> DataFrame:
    """(conv_id, path, sizes) of rebuilt conversations: the first h turns of conversation ``c - c % 5``, then the own ones after the first h.

    h is the checksum of the decimal id modulo 9. ``path`` has a 16-byte digest a turn, ``sizes`` the UTF-8 bytes of its text.
    Turns are read in order of turn (nulls first), ties by digest of role and text; null roles and texts are empty. Rows
    without conv_id take no part, other columns are ignored. A conversation's turns meet in one row, some 50 bytes each; texts
    stay where they are read.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    mark = F.md5(F.concat_ws(":", F.char_length(role).cast("string"), F.concat(role, text)).cast("binary"))
    rows = turns.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(F.col("turn").cast("long").alias("turn"), mark.alias("mark"), F.octet_length(text).alias("size")).alias("t"))
    own = scratch.write(rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("own")))
    base = own.filter("conv_id % 5 = 0").select(F.col("conv_id").alias("_base"), F.slice("own", 1, 8).alias("base"))
    both = own.withColumns({"_base": F.expr("conv_id - conv_id % 5"),
                            "h": (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9).cast("int")}).join(base, "_base", "left")
    none = F.array().cast(own.schema["own"].dataType)
    turns_of = F.concat(F.slice(F.coalesce("base", none), F.lit(1), F.col("h")), F.expr("slice(own, h + 1, greatest(size(own) - h, 0))"))
    return both.select("conv_id", turns_of.alias("p")).select(
        "conv_id", F.unhex(F.array_join(F.transform("p", lambda t: t["mark"]), "")).alias("path"), F.transform("p", lambda t: t["size"]).alias("sizes"))


def trie(paths: DataFrame, scratch: Scratch, shards: int | None = None) -> DataFrame:
    """One row for each node of the trie over ``paths`` (conv_id, path, sizes), from the root without turns.

    conv_id is the smallest member, members being the conversations whose path begins with the node's; depth its turns; then
    parent_conv_id (null for the root), n_convs (members), n_children, n_leaves (nodes without children in the subtree, the top
    included), saved_tokens (over the subtree, members less one times the bytes of a node's last text), ends_sha256 (ids of
    members that end here, ascending, comma-joined). An empty path ends in the root; repeated ids count each; no rows, no nodes.
    """
    session = paths.sparkSession
    paths = scratch.write(paths.select("conv_id", "path", "sizes"))
    total = paths.count()
    shards = max(1, min(MAX_SHARDS, shards or -(-total // SHARD_ROWS)))
    splitters = _splitters(paths, shards)
    sent = session.sparkContext.broadcast((splitters, _skeleton([p for p, _ in splitters])))
    dealt = paths.mapInArrow(lambda batches: _deal(batches, sent.value[0]), "conv_id long, path binary, sizes array<int>, shard int")
    placed = dealt.repartition(shards, "shard").sortWithinPartitions("shard", "path", "conv_id")
    parts = scratch.write(placed.mapInArrow(lambda batches: _close(batches, sent.value[1]), _NODE))

    skeleton = _combine(parts.filter("skeleton IS NOT NULL"), sent.value[1], scratch)
    parents = F.broadcast(skeleton.select(F.col("skeleton").alias("parent_skeleton"), F.col("conv_id").alias("_parent")))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    known = F.coalesce("parent_conv_id", "_parent")
    local = parts.filter("skeleton IS NULL").join(parents, "parent_skeleton", "left").withColumn("parent_conv_id", known)
    top = skeleton.join(parents, "parent_skeleton", "left").withColumn("parent_conv_id", F.col("_parent"))
    return local.select(columns).unionByName(top.select(columns))


def _splitters(paths: DataFrame, shards: int) -> list[tuple[bytes, int]]:
    """Where shards begin, as (path, id), from a sample of bounded size that a hash of the id draws.

    A splitter is cut behind the first turn that tells it from the one before; copies of one path keep all of it and an id.
    Conversations that share more than SKELETON_TURNS turns stay in one shard.
    """
    if shards == 1:
        return []
    whole = F.octet_length("path") <= SKELETON_TURNS * DIGEST
    drawn = paths.select(F.col("path").substr(1, SKELETON_TURNS * DIGEST).alias("path"), F.when(whole, F.col("conv_id")).alias("conv_id"),
                         F.xxhash64("conv_id").alias("_h")).orderBy("_h", "conv_id").limit(SAMPLE * shards)
    rows = sorted((bytes(r["path"]), _FIRST if r["conv_id"] is None else r["conv_id"]) for r in drawn.collect())
    found: list[tuple[bytes, int]] = []
    before = b""
    for k in range(1, shards if rows else 1):
        path, conv = rows[k * len(rows) // shards]
        cut = (path, conv) if path == before else (path[:(_shared(before, path) + 1) * DIGEST], _FIRST)
        before = path
        if not found or cut > found[-1]:
            found.append(cut)
    return found


def _skeleton(splitters: list[bytes]) -> dict[bytes, int]:
    """Every path that begins a splitter, numbered; the root always."""
    found = {b""}
    for path in splitters:
        found.update(path[:k] for k in range(DIGEST, len(path) + 1, DIGEST))
    return {path: k for k, path in enumerate(sorted(found))}


def _deal(batches: Iterator[pa.RecordBatch], splitters: list[tuple[bytes, int]]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = zip(batch.column(1).to_pylist(), batch.column(0).to_pylist(), strict=True)
        shard = pa.array([bisect.bisect_right(splitters, key) for key in keys], pa.int32())
        yield pa.RecordBatch.from_arrays([*batch.columns, shard], [*batch.schema.names, "shard"])


class _Node:
    __slots__ = ("children", "convs", "depth", "hash", "ids", "least", "leaves", "saved", "size", "skeleton", "some", "waiting")

    def __init__(self, depth: int, size: int, skeleton: int | None):
        self.depth, self.size, self.skeleton = depth, size, skeleton
        self.convs = self.children = self.leaves = self.saved = 0
        self.least: int | None = None
        self.hash = None
        self.ids: list[str] = []
        self.some: int | None = None
        self.waiting: list[tuple] = []


def _close(batches: Iterator[pa.RecordBatch], skeleton: dict[bytes, int]) -> Iterator[pa.RecordBatch]:
    """Sorted conversations of a shard into finished nodes, and partial figures of skeleton nodes."""
    out: list[tuple] = []
    stack: list[_Node] = []
    before, own = None, None

    def chunk(node: _Node) -> None:
        out.append((None, node.depth, None, 0, 0, 0, 0, None, node.skeleton, None, ",".join(node.ids), node.some, None))
        node.ids = []

    def close() -> None:
        node = stack.pop()
        parent = stack[-1] if stack else None
        if node.skeleton is not None:
            if node.ids:
                chunk(node)
            out.append((node.least, node.depth, None, node.convs, node.children, node.leaves, node.saved, None, node.skeleton, None, None, None, node.size))
        else:
            leaves, saved = node.leaves or 1, node.saved + (node.convs - 1) * node.size
            parent.children, parent.leaves, parent.saved = parent.children + 1, parent.leaves + leaves, parent.saved + saved
            ends = node.hash.hexdigest() if node.hash else _EMPTY
            row = (node.least, node.depth, None, node.convs, node.children, leaves, saved, ends, None, parent.skeleton, None, None, None)
            if parent.skeleton is None:
                parent.waiting.append(row)
            else:
                out.append(row)
            out.extend((*r[:2], node.least, *r[3:]) for r in node.waiting)
        if parent:
            parent.convs += node.convs
            parent.least = node.least if parent.least is None else min(parent.least, node.least)

    for batch in batches:
        for at in range(0, batch.num_rows, 1000):
            part = batch.slice(at, 1000)
            for conv, path, sizes, shard in zip(*part.columns, strict=True):
                conv, path, shard = conv.as_py(), path.as_py(), shard.as_py()
                if shard != own:
                    while stack:
                        close()
                    before, own = None, shard
                if before is None:
                    stack.append(_Node(0, 0, skeleton[b""]))
                    before = b""
                shared = _shared(before, path)
                while len(stack) > shared + 1:
                    close()
                if len(path) // DIGEST > shared:
                    known = sizes.values.to_numpy()
                    for depth in range(shared + 1, len(path) // DIGEST + 1):
                        stack.append(_Node(depth, int(known[depth - 1]), skeleton.get(path[:depth * DIGEST]) if stack[-1].skeleton is not None else None))
                node = stack[-1]
                node.convs += 1
                node.least = conv if node.least is None else min(node.least, conv)
                if node.skeleton is None:
                    if node.hash is None:
                        node.hash = hashlib.sha256(str(conv).encode())
                    else:
                        node.hash.update(b",%d" % conv)
                else:
                    node.some = node.some if node.ids else conv
                    node.ids.append(str(conv))
                    if len(node.ids) >= CHUNK_IDS:
                        chunk(node)
                before = path
            if len(out) >= 20_000:
                yield _nodes(out)
                out.clear()
    while stack:
        close()
    if out:
        yield _nodes(out)


def _shared(a: bytes, b: bytes) -> int:
    """Turns that two paths begin with alike."""
    n = min(len(a), len(b)) // DIGEST
    if a[:n * DIGEST] == b[:n * DIGEST]:
        return n
    low, high = 0, n  # the first low turns are equal, the first high ones are not
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (middle, high) if a[:middle * DIGEST] == b[:middle * DIGEST] else (low, middle)
    return low


def _nodes(rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "string": pa.string(), "int": pa.int32()}
    fields = [c.split() for c in _NODE.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(zip(*rows, strict=True), fields, strict=True)], [n for n, _ in fields])


def _combine(partial: DataFrame, skeleton: dict[bytes, int], scratch: Scratch) -> DataFrame:
    """Skeleton nodes whole: partial figures added up by node, then along the skeleton to the nodes above."""
    session = partial.sparkSession
    links = session.createDataFrame([(k, skeleton[path[:-DIGEST]] if path else None) for path, k in skeleton.items()],
                                    "skeleton int, parent_skeleton int")
    above = session.createDataFrame([(k, [skeleton[path[:n]] for n in range(0, len(path) + 1, DIGEST)]) for path, k in skeleton.items()],
                                    "skeleton int, tops array<int>")
    figures = partial.filter("ids IS NULL").groupBy("skeleton").agg(
        F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"), F.sum("n_convs").alias("own_convs"), F.max("turn_bytes").alias("turn_bytes"),
        F.sum("n_children").alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))
    inner = links.groupBy(F.col("parent_skeleton").alias("skeleton")).agg(F.count(F.lit(1)).alias("_inner"))
    nodes = figures.join(F.broadcast(links), "skeleton").join(F.broadcast(inner), "skeleton", "left")
    children = F.col("n_children") + F.coalesce("_inner", F.lit(0))
    nodes = scratch.write(nodes.select(
        "skeleton", "parent_skeleton", "conv_id", "depth", F.col("own_convs").alias("n_convs"), children.alias("n_children"),
        (F.col("n_leaves") + F.when(children == 0, 1).otherwise(0)).alias("leaves"),
        (F.col("saved_tokens") + (F.col("own_convs") - 1) * F.col("turn_bytes")).alias("saved")))
    summed = nodes.join(F.broadcast(above), "skeleton").select(F.explode("tops").alias("top"), "leaves", "saved").groupBy(F.col("top").alias("skeleton")).agg(
        F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))
    hashes = (partial.filter("ids IS NOT NULL").select("skeleton", "first_id", "ids").repartition("skeleton")
                     .sortWithinPartitions("skeleton", "first_id").mapInArrow(_hash, "skeleton int, ends_sha256 string"))
    ends: Column = F.coalesce("ends_sha256", F.lit(_EMPTY))
    return scratch.write(nodes.drop("leaves", "saved").join(summed, "skeleton").join(hashes, "skeleton", "left").withColumn("ends_sha256", ends))


def _hash(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted chunks of ids into one hash for each skeleton node."""
    done, node, digest = [], None, None
    for batch in batches:
        for key, ids in zip(batch.column(0), batch.column(2), strict=True):
            if key.as_py() != node:
                if node is not None:
                    done.append((node, digest.hexdigest()))
                node, digest = key.as_py(), hashlib.sha256(ids.as_py().encode())
            else:
                digest.update(b"," + ids.as_py().encode())
    if node is not None:
        done.append((node, digest.hexdigest()))
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in done], pa.int32()), pa.array([h for _, h in done])], ["skeleton", "ends_sha256"])



#: The checksum of a short ASCII text, byte by byte and bit by bit.
CRC32_SQL = """xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split({0}, ''), lambda c: CAST(ascii(c) AS BIGINT))),
    lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, i: xor(x >> 1, CAST(3988292384 AS BIGINT) * (x & 1)))), CAST(4294967295 AS BIGINT))"""

ORACLE = f"""WITH turns AS (SELECT conv_id, md5(length(COALESCE(role, '')) || ':' || COALESCE(role, '') || COALESCE(text, '')) AS mark,
        octet_length(encode(COALESCE(text, ''))) AS size, turn FROM conversations WHERE conv_id IS NOT NULL),
    placed AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, mark) AS n FROM turns),
    convs AS (SELECT conv_id, conv_id - conv_id % 5 AS base, {CRC32_SQL.format("CAST(conv_id AS VARCHAR)")} % 9 AS h FROM (SELECT DISTINCT conv_id FROM turns)),
    made AS (SELECT c.conv_id, 0 AS part, n, mark, size FROM convs c JOIN placed p ON p.conv_id = c.base AND n <= h
        UNION ALL SELECT c.conv_id, 1, n, mark, size FROM convs c JOIN placed p ON p.conv_id = c.conv_id AND n > h),
    steps AS (SELECT conv_id, size, ROW_NUMBER() OVER w AS depth, string_agg(mark, '') OVER w AS path FROM made
        WINDOW w AS (PARTITION BY conv_id ORDER BY part, n ROWS UNBOUNDED PRECEDING)),
    members AS (SELECT conv_id, depth, path, size FROM steps UNION ALL SELECT conv_id, 0, '', 0 FROM convs),
    nodes AS (SELECT path, depth, MIN(conv_id) AS conv_id, COUNT(*) AS n_convs, MAX(size) AS size, depth AS d FROM members GROUP BY path, depth),
    ends AS (SELECT path, sha256(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)) AS ends FROM
        (SELECT conv_id, MAX_BY(path, depth) AS path FROM members GROUP BY conv_id) GROUP BY path),
    kids AS (SELECT left(path, 32 * (depth - 1)) AS path, COUNT(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1),
    figures AS (SELECT v.*, COALESCE(k.n, 0) AS n_children FROM nodes v LEFT JOIN kids k ON k.path = v.path),
    below AS (SELECT left(path, 32 * up) AS path, SUM(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, SUM((n_convs - 1) * size) AS saved
        FROM (SELECT *, unnest(range(0, depth + 1)) AS up FROM figures) GROUP BY 1)
    SELECT v.conv_id, CAST(v.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, CAST(v.n_convs AS BIGINT) AS n_convs,
        CAST(v.n_children AS BIGINT) AS n_children, CAST(b.n_leaves AS BIGINT) AS n_leaves, CAST(b.saved AS BIGINT) AS saved_tokens,
        COALESCE(e.ends, sha256('')) AS ends_sha256
    FROM figures v JOIN below b ON b.path = v.path LEFT JOIN ends e ON e.path = v.path
    LEFT JOIN nodes p ON v.depth > 0 AND p.path = left(v.path, 32 * (v.depth - 1))"""
