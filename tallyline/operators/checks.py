"""Reusable checks. A check returns the violating rows; no rows means it passed."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.functions import exprs as X


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def unique(df: DataFrame, column: str) -> DataFrame:
    """Non-null values that occur more than once, with their count."""
    return df.filter(F.col(column).isNotNull()).groupBy(column).agg(
        F.count(F.lit(1)).alias("rows")).filter("rows > 1")


def accepted_values(df: DataFrame, column: str, values: Iterable) -> DataFrame:
    """Values outside the list, with their count. NULL is left to ``not_null``."""
    return df.filter(~F.col(column).isin(list(values))).groupBy(column).agg(F.count(F.lit(1)).alias("rows"))


def relationships(df: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Non-null values without a parent, with their count. Values are counted before the join."""
    children = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("rows"))
    parents = parent.select(F.col(parent_column).alias(column))
    return children.join(parents, column, "left_anti")


def count_mismatch(**frames: DataFrame) -> DataFrame:
    """One row of counts, kept only if they are not all equal. Frames have one row holding one number each."""
    names = list(frames)
    one = None
    for name, frame in frames.items():
        single = frame.toDF(name)
        one = single if one is None else one.crossJoin(F.broadcast(single))
    return one.filter(~_all_equal(names))


def _all_equal(names: list[str]) -> Column:
    first = F.col(names[0])
    same = F.lit(True)
    for other in names[1:]:
        same = same & first.eqNullSafe(F.col(other))
    return same


def by_key_mismatch(left: DataFrame, right: DataFrame, key: str, left_name: str, right_name: str) -> DataFrame:
    """Full outer compare of two (key, number) frames; a missing side counts as 0."""
    a, b = left.toDF(key, left_name), right.toDF(key, right_name)
    return a.join(b, key, "full_outer").filter(
        F.coalesce(left_name, F.lit(0)) != F.coalesce(right_name, F.lit(0)))


def multiset_difference(left: DataFrame, right: DataFrame, column: str) -> DataFrame:
    """Values whose number of occurrences differs between two frames: no global sort is needed."""
    def counts(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(column).agg(F.count(F.lit(1)).alias(name))

    a, b = counts(left, "left_rows"), counts(right, "right_rows").withColumnRenamed(column, "_other")
    joined = a.join(b, a[column].eqNullSafe(b["_other"]), "full_outer")
    return joined.select(F.coalesce(column, "_other").alias(column),
                         F.coalesce("left_rows", F.lit(0).cast("bigint")).alias("left_rows"),
                         F.coalesce("right_rows", F.lit(0).cast("bigint")).alias("right_rows")).filter(
        "left_rows <> right_rows")


def split_valid_rejected(df: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(accepted rows, rejected rows with the names of the rules they break). A rule is true for a bad row."""
    broken = F.filter(F.array(*[F.when(bad, F.lit(name)) for name, bad in rules.items()]), lambda x: x.isNotNull())
    tagged = df.withColumn("reject_reason", broken)
    return tagged.filter(F.size("reject_reason") == 0).drop("reject_reason"), tagged.filter(
        F.size("reject_reason") > 0)


def as_metrics(one_row: DataFrame, category: str, keys: Iterable[str] = ()) -> DataFrame:
    """Wide aggregate to long (keys, category, metric, value) rows."""
    keys = list(keys)
    values = [c for c in one_row.columns if c not in keys]
    doubles = one_row.select(*keys, *[F.col(c).cast("double").alias(c) for c in values])
    return doubles.unpivot(keys, values, "metric", "value").select(
        *keys, F.lit(category).alias("category"), "metric", "value")


def rate(part: Column, whole: Column, digits: int = 4) -> Column:
    """Share rounded to ``digits``; an empty table counts as one row."""
    return X.round_to(X.ratio(part, F.greatest(whole, F.lit(1))), digits)
