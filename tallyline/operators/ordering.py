"""Global row numbers, quantile buckets, running sums and cumulative shares without a single-task sort.

A window without PARTITION BY moves every row to one task. Here rows are range-partitioned by the sort keys and sorted
inside each partition; a row's place is its index in the partition plus the number of rows in the earlier partitions.
The ordered rows are written once, so partition ids cannot change between counting and numbering.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyline.operators.skew import broadcast_if_small, spread_join
from tallyline.sources.lake import Scratch

PART_BYTES = 256 << 20     # of one range partition
MAX_PARTS = 500_000        # 128 TB in partitions of that size
UNKNOWN_BYTES = 1 << 57    # joins without statistics are estimated as products
_INDEX_BITS = 33  # monotonically_increasing_id keeps the partition id above these bits


def _sort_columns(keys: Sequence[Column | str]) -> list[Column]:
    return [F.col(k) if isinstance(k, str) else k for k in keys]


def range_parts(df: DataFrame) -> int:
    """Range partitions for ``df``: its estimated bytes over ``PART_BYTES``, at least the session's shuffle partitions.

    The estimate is the optimizer's, from file sizes, but no more than the tables it reads add up to: a join counts there as
    the product of its sides. One that knows nothing (no statistics) leaves the session's number.
    """
    session = df.sparkSession
    least = int(session.conf.get("spark.sql.shuffle.partitions"))
    plan = df._jdf.queryExecution().optimizedPlan()
    size = int(str(plan.stats().sizeInBytes()))
    if size >= UNKNOWN_BYTES:
        return least
    leaves = plan.collectLeaves()
    read = sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    return max(least, min(-(-min(size, read) // PART_BYTES), MAX_PARTS))


def ordered(df: DataFrame, keys: Sequence[Column | str], scratch: Scratch) -> DataFrame:
    """``df`` in global key order, with ``_pid`` (range partition) and ``_idx`` (0-based place inside it)."""
    columns = _sort_columns(keys)
    place = (df.repartitionByRange(range_parts(df), *columns).sortWithinPartitions(*columns)
               .withColumn("_place", F.monotonically_increasing_id()))
    written = scratch.write(place)
    return (written.withColumn("_pid", F.shiftright("_place", _INDEX_BITS).cast("int"))
                   .withColumn("_idx", F.col("_place").bitwiseAND((1 << _INDEX_BITS) - 1))
                   .drop("_place"))


def _offsets(placed: DataFrame, **totals: Column) -> tuple[DataFrame, dict[str, int]]:
    """(per partition: sums over all earlier partitions, sums over all). One row per partition: small by construction."""
    per_partition = placed.groupBy("_pid").agg(*[agg.alias(name) for name, agg in totals.items()])
    rows = sorted(per_partition.collect(), key=lambda r: r["_pid"])
    running = dict.fromkeys(totals, 0)
    out = []
    for row in rows:
        out.append((row["_pid"], *[running[name] for name in totals]))
        for name in totals:
            running[name] += row[name]
    schema = "_pid int, " + ", ".join(f"_before_{name} bigint" for name in totals)
    return F.broadcast(placed.sparkSession.createDataFrame(out, schema)), running


def number_rows(placed: DataFrame, name: str = "row_number") -> tuple[DataFrame, int]:
    """(the ordered rows with their number from 1, number of rows)."""
    offsets, totals = _offsets(placed, rows=F.count(F.lit(1)))
    numbered = placed.join(offsets, "_pid").withColumn(name, F.col("_idx") + F.col("_before_rows") + 1)
    return numbered.drop("_pid", "_idx", "_before_rows"), totals["rows"]


def global_row_number(df: DataFrame, keys: Sequence[Column | str], scratch: Scratch,
                      name: str = "row_number") -> DataFrame:
    """1..n in the order of ``keys``; the keys should end in a unique one for a repeatable numbering."""
    return number_rows(ordered(df, keys, scratch), name)[0]


def bucket_of(row_number: Column, n_rows: int, buckets: int) -> Column:
    """The NTILE bucket of a row number: the first ``n mod buckets`` buckets hold one row more."""
    size, extra = divmod(n_rows, buckets)
    larger = extra * (size + 1)
    first = F.floor((row_number - 1) / (size + 1)) + 1
    if size == 0:
        return first.cast("int")
    rest = F.floor((row_number - 1 - larger) / size) + 1 + extra
    return F.when(row_number <= larger, first).otherwise(rest).cast("int")


def global_ntile(df: DataFrame, keys: Sequence[Column | str], buckets: int, scratch: Scratch, name: str) -> DataFrame:
    numbered, n_rows = number_rows(ordered(df, keys, scratch), "_rn")
    return numbered.withColumn(name, bucket_of(F.col("_rn"), n_rows, buckets)).drop("_rn")


def ntiles_by_value(df: DataFrame, key: str, scores: dict[str, tuple[str, bool]], buckets: int, scratch: Scratch) -> DataFrame:
    """NTILE columns of a written table: ``scores`` maps a name to (value column, descending), ties by ascending ``key``.

    Values are counted and running counts taken over them, for all scores in one table. A value that lies inside one bucket
    settles the rows that have it. Rows of the few values that straddle a cut, at most ``buckets - 1`` a score, are ranked by
    key, spread over range partitions; the others are not moved but for the joins. ``key`` must be unique.
    """
    n_rows = df.count()
    sign = {name: F.lit(-1.0 if down else 1.0) for name, (_, down) in scores.items()}
    long = df.select(F.inline(F.array(*[F.struct(F.lit(s).alias("_score"), (F.col(c).cast("double") * sign[s]).alias("_v")) for s, (c, _) in scores.items()])))
    counts = long.groupBy("_score", "_v").agg(F.count(F.lit(1)).alias("_n"))
    order = sorted(scores)  # every score has n_rows rows, so the running count starts anew after each
    run = global_running_sum(counts, ["_score", "_v"], {"_upto": "_n"}, scratch)
    upto = F.col("_upto") - F.lit(n_rows) * (F.array_position(F.array(*[F.lit(s) for s in order]), F.col("_score")) - 1)
    run = run.withColumn("_upto", upto)
    low, high = (bucket_of(c, n_rows, buckets) for c in (F.col("_upto") - F.col("_n") + 1, F.col("_upto")))
    known = scratch.write(run.select("_score", "_v", (F.col("_upto") - F.col("_n")).alias("_first"), low.alias("_low"), high.alias("_high")))
    out = df
    for s, (c, _) in scores.items():
        mine = known.filter(F.col("_score") == s).select("_v", F.col("_low").alias(s), F.when(F.col("_low") != F.col("_high"), F.col("_first")).alias(f"_cut_{s}"))
        out = out.withColumn("_v", F.col(c).cast("double") * sign[s]).join(broadcast_if_small(mine), "_v", "left").drop("_v")
    cuts = known.filter(F.col("_low") != F.col("_high")).select("_score", "_first").collect()  # buckets - 1 a score at most
    straddled = sorted({r["_score"] for r in cuts})
    if straddled:
        out = scratch.write(out)
        tied = out.select(key, F.inline(F.filter(F.array(*[F.struct(F.lit(s).alias("_score"), F.col(f"_cut_{s}").alias("_first")) for s in straddled]),
                                                 lambda x: x["_first"].isNotNull())))
        ranked = scratch.write(global_row_number(tied, ["_score", "_first", key], scratch, "_rn"))
        starts = ranked.groupBy("_score", "_first").agg((F.min("_rn") - 1).alias("_start"))
        ranks = ranked.join(F.broadcast(starts), ["_score", "_first"]).select(
            "_score", F.col(key).alias("_key"), bucket_of(F.col("_first") + F.col("_rn") - F.col("_start"), n_rows, buckets).alias("_bucket"))
        wide = ranks.groupBy("_key").agg(*[F.max(F.when(F.col("_score") == s, F.col("_bucket"))).alias(f"_bucket_{s}") for s in straddled])
        out = out.join(wide, out[key] == wide["_key"], "left").withColumns(
            {s: F.coalesce(f"_bucket_{s}", s) for s in straddled}).drop("_key", *[f"_bucket_{s}" for s in straddled])
    return out.drop(*[f"_cut_{s}" for s in scores])


def global_running_sum(df: DataFrame, keys: Sequence[Column | str], values: dict[str, str], scratch: Scratch,
                       row_number: str | None = None) -> DataFrame:
    """Running sums of whole-number columns in key order: ``values`` maps new column to summed column."""
    placed = ordered(df, keys, scratch)
    totals = {new: F.coalesce(F.sum(source), F.lit(0)).cast("bigint") for new, source in values.items()}
    offsets, _ = _offsets(placed, rows=F.count(F.lit(1)), **totals)
    so_far = Window.partitionBy("_pid").orderBy("_idx").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = placed.join(offsets, "_pid")
    for new, source in values.items():
        out = out.withColumn(new, F.coalesce(F.sum(source).over(so_far), F.lit(0)) + F.col(f"_before_{new}"))
    if row_number:
        out = out.withColumn(row_number, F.col("_idx") + F.col("_before_rows") + 1)
    return out.drop("_pid", "_idx", "_before_rows", *[f"_before_{new}" for new in values])


def rows_up_to(df: DataFrame, value: str, scratch: Scratch, name: str = "rows_up_to") -> DataFrame:
    """Per distinct value: how many rows of ``df`` are at or below it (rows are grouped by value first)."""
    counts = df.filter(F.col(value).isNotNull()).groupBy(value).agg(F.count(F.lit(1)).alias("_rows"))
    return global_running_sum(counts, [value], {name: "_rows"}, scratch)


def global_cume_dist(df: DataFrame, value: str, scratch: Scratch, name: str) -> DataFrame:
    """Share of rows at or below each row's value."""
    upto = rows_up_to(df, value, scratch, "_upto").drop("_rows")
    total = df.filter(F.col(value).isNotNull()).agg(F.count(F.lit(1)).alias("_n"))
    joined = spread_join(df, upto, value).crossJoin(F.broadcast(total))
    return joined.withColumn(name, F.try_divide(F.col("_upto").cast("double"), F.col("_n").cast("double"))).drop(
        "_upto", "_n")
