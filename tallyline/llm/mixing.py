"""Mixing sources to target word budgets by counts of exact lengths, a bounded knapsack and seeded selection.

Targets come from weights and are capped at a multiple of each source's size. A source's budget is whole repeats of the
source and a rest. The rest is planned over the counts of documents by exact length: every length gives the same share of all but
the last ``TABLE_SUMS`` words, and a bounded-knapsack table over sums settles those. Documents of a length are then taken in
seeded order. Only counts meet in one task; documents are ranked in parts.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyline.llm import graph
from tallyline.sources.lake import Scratch

WEIGHTS = (5, 2, 1)
REPEATS = 3
SEED = 17
TABLE_SUMS = 1 << 16  # words that the knapsack table spans
WORD = r"[^\x20\x09-\x0D]+"


def targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """(source, source_size, target) for each source of ``sized(source, size)``.

    Sources in code-point order, null last, take the weights in turn and share the total size. A target stops at ``repeats``
    times its source's size; what is above goes to the others by weight until none is above. With the sources in order of
    cap / weight, the open ones share what the capped ones leave: one running sum over the source table.
    """
    by_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    turn = F.element_at(F.array(*map(F.lit, weights)), (F.col("_place") % len(weights) + 1).cast("int"))
    weighed = (by_source.withColumn("_place", place).withColumn("_w", turn)
                        .withColumn("_cap", F.col("source_size") * repeats).withColumn("_ratio", F.col("_cap") / F.col("_w")))
    upto = Window.orderBy("_ratio", "_place")
    before = upto.rowsBetween(Window.unboundedPreceding, -1)
    after = upto.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = upto.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum("_cap").over(before), F.lit(0))) / F.sum("_w").over(after)
    open_ = weighed.withColumn("_level", level)
    settled = F.min(F.when(F.col("_level") <= F.col("_ratio"), F.struct("_ratio", "_place", "_level"))).over(everything)["_level"]
    return (open_.withColumn("_settled", settled)
                 .select("source", "source_size",
                         F.least(F.col("_cap").cast("double"), F.col("_settled") * F.col("_w")).alias("target")))


def fit_budget(counts: dict[int, int], budget: int, table_sums: int = TABLE_SUMS) -> dict[int, int]:
    """How many documents of each length to take, at most ``counts``, so that the words come as near to ``budget`` as possible.

    The sum never passes the budget. A knapsack table settles the last ``table_sums`` words over all documents not taken yet, so
    a budget up to that is met by the best of all choices. Of a larger one an equal share of every length is taken before, which
    leaves the same share of every length to choose from.
    """
    counts = {n: c for n, c in counts.items() if n > 0 and c > 0}
    total = sum(n * c for n, c in counts.items())
    if budget >= total:
        return counts
    take = {n: c * max(0, budget - table_sums) // total for n, c in counts.items()}
    rest = budget - sum(n * t for n, t in take.items())
    for n in sorted(counts, reverse=True):  # what rounding down left beyond the table, long lengths first
        more = min(counts[n] - take[n], max(0, -(-(rest - table_sums) // n)), rest // n)
        take[n] += more
        rest -= n * more
    # bounded knapsack: bit s of ``reach`` tells that sum s can be made; each length enters as 1, 2, 4.. documents at once
    mask, reach, steps = (1 << (rest + 1)) - 1, 1, []
    for n in sorted(counts, reverse=True):
        left, bundle = min(counts[n] - take[n], rest // n), 1
        while left and not reach >> rest & 1:
            many = min(bundle, left)
            steps.append((n, many, reach))
            reach |= (reach << n * many) & mask
            left, bundle = left - many, bundle * 2
    at = reach.bit_length() - 1
    for n, many, earlier in reversed(steps):
        if not earlier >> at & 1:
            take[n] += many
            at -= n * many
    return take


def mix(docs: DataFrame, scratch: Scratch, weights: tuple[int, ...] = WEIGHTS, repeats: int = REPEATS, seed: int = SEED) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken) for every row of ``docs(doc_id, text, source)``.

    ``size`` is the number of words, 0 for null or empty texts; ``taken`` is a multiple of it, at most ``repeats`` times. A
    source's taken words do not pass its target and come as near as ``fit_budget`` finds. Null sources form one
    source. Repeated rows are rows of their own; equal ones stand for each other. An empty table gives an empty result.
    """
    sized = scratch.write(docs.select("doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size")))
    goal = scratch.write(targets(sized, weights, repeats))

    def plan(group: pd.DataFrame) -> pd.DataFrame:
        size, target = int(group["source_size"].iloc[0]), float(group["target"].iloc[0])
        whole = min(int(target // size), repeats) if size else 0
        take = fit_budget(dict(zip(group["size"].tolist(), group["n"].tolist(), strict=True)), int(target) - whole * size if whole < repeats else 0)
        return pd.DataFrame({"source": group["source"], "size": group["size"], "whole": whole,
                             "extra": [take.get(n, 0) for n in group["size"]]})

    same = F.expr("l.source <=> r.source")
    lengths = sized.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n"))
    lengths = lengths.alias("l").join(goal.alias("r"), same).select("l.source", "l.size", "l.n", "r.source_size", "r.target")
    chosen = scratch.write(lengths.groupBy("source").applyInPandas(plan, "source string, size long, whole long, extra long"))
    chosen = chosen.alias("l").join(goal.alias("r"), same).select("l.*", "r.source_size", "r.target")
    order = F.xxhash64(F.lit(seed), "doc_id")
    ranked = graph.rank_in_group(sized, ["source", "size"], [order, F.col("doc_id")], order, "_rank")
    both = ranked.alias("l").join(chosen.alias("r"), F.expr("l.source <=> r.source AND l.size = r.size"))
    repeated = F.col("r.whole") + F.when(F.col("l._rank") < F.col("r.extra"), 1).otherwise(0)
    return both.select("l.doc_id", "l.source", "l.size", "r.source_size", "r.target", (F.col("l.size") * repeated).alias("taken"))


def apply_mix(docs: DataFrame, scratch: Scratch, **settings) -> DataFrame:
    """``docs`` with every row as often as the mix takes it; rows the mix does not take, and those without words, go."""
    taken = mix(docs, scratch, **settings).filter("size > 0")
    each = scratch.write(taken.groupBy("doc_id", "source", "size").agg(F.array_sort(F.collect_list((F.col("taken") / F.col("size")).cast("int"))).alias("_times")))
    counted = docs.withColumn("_size", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long"))
    on = F.expr("d.doc_id <=> e.doc_id AND d.source <=> e.source AND d._size = e.size")
    rows = [F.col(f"d.`{c}`") for c in docs.columns]
    once = (counted.alias("d").join(each.filter("size(_times) = 1 AND _times[0] > 0").alias("e"), on)
                   .select(*rows, F.explode(F.array_repeat(F.lit(1), F.col("e._times")[0])).alias("_copy")))
    place = F.row_number().over(Window.partitionBy("d.doc_id", "d.source", "d._size").orderBy(F.xxhash64("d.text")))
    many = (counted.alias("d").join(each.filter("size(_times) > 1").alias("e"), on).withColumn("_place", place)
                   .select(*rows, F.explode(F.array_repeat(F.lit(1), F.col("e._times")[F.col("_place") - 1])).alias("_copy")))
    return once.unionByName(many).drop("_copy")
