"""Exact interpolated quantiles without holding a group's values in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.operators.ordering import global_running_sum
from tallyline.operators.skew import broadcast_if_small
from tallyline.sources.lake import Scratch


def long_values(df: DataFrame, columns: list[str], keys: tuple[str, ...] = ()) -> DataFrame:
    """(keys, feature, value) rows of the given numeric columns."""
    return df.select(*keys, *[F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        list(keys), columns, "feature", "value")


def exact_quantiles(df: DataFrame, groups: list[str], value: str, quantiles: dict[str, float],
                    scratch: Scratch) -> DataFrame:
    """One row per group: ``n`` and a column per quantile, linear between neighbours.

    Equal values are counted first and put in one global order over (groups, value). The value at a position is the
    smallest one whose running count passes it, so every group is spread over many tasks.
    """
    counts = df.filter(F.col(value).isNotNull()).groupBy(*groups, value).agg(F.count(F.lit(1)).alias("_rows"))
    run = global_running_sum(counts, [*groups, value], {"_upto": "_rows"}, scratch)
    totals = run.groupBy(*groups).agg(F.sum("_rows").alias("n"), F.min(F.col("_upto") - F.col("_rows")).alias("_before"))
    joined = run.join(broadcast_if_small(totals), groups) if groups else run.crossJoin(F.broadcast(totals))

    def at(position: Column) -> Column:
        return F.min(F.when(F.col("_upto") - F.col("_before") > position, F.col(value)))

    ends = []
    for name, q in quantiles.items():
        place = (F.col("n") - 1) * float(q)
        ends += [at(F.floor(place)).alias(f"_{name}_lo"), at(F.ceil(place)).alias(f"_{name}_hi")]
    picked = joined.groupBy(*groups).agg(F.max("n").alias("n"), *ends)

    def between(name: str, q: float) -> Column:
        place = (F.col("n") - 1) * float(q)
        lo, hi = F.col(f"_{name}_lo"), F.col(f"_{name}_hi")
        return (lo + (hi - lo) * (place - F.floor(place))).alias(name)

    return picked.select(*groups, "n", *[between(name, q) for name, q in quantiles.items()])


def describe(df: DataFrame, columns: list[str], scratch: Scratch, keys: tuple[str, ...] = ()) -> DataFrame:
    """count, mean, std, min, quartiles and max per column, and per key if keys are given."""
    long = long_values(df, columns, keys).filter("value IS NOT NULL")
    groups = [*keys, "feature"]
    moments = long.groupBy(*groups).agg(
        F.count(F.lit(1)).alias("count"), F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"), F.min("value").alias("min"), F.max("value").alias("max"))
    quarters = exact_quantiles(long, groups, "value", {"p25": 0.25, "p50": 0.5, "p75": 0.75}, scratch).drop("n")
    return moments.join(quarters, groups)
