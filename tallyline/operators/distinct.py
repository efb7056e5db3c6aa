"""Several conditional distinct counts beside plain aggregates, as two-level groupings.

``count(DISTINCT a), count(DISTINCT b)`` in one grouping makes Spark repeat every row for each distinct column and one more time.
Here each column has one grouping of its own, by (groups, value), that holds the conditions of all counts over that column as
flags; its rows are then counted by group. Nothing is repeated, and equal values are merged before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.functions import exprs as X


def with_distinct_counts(df: DataFrame, groups: list[str], plain: list[Column], counts: dict[str, tuple[str, Column | None]]) -> DataFrame:
    """(groups, plain aggregates, counts): ``counts`` maps a name to (column, condition): its different non-null values on rows that meet it.

    Null groups are groups of their own. Without ``groups`` there is one row, also for no rows.
    """
    out = df.groupBy(*groups).agg(*plain) if groups else df.agg(*plain)
    by_column: dict[str, dict[str, Column]] = {}
    for name, (column, when) in counts.items():
        by_column.setdefault(column, {})[name] = F.lit(True) if when is None else F.coalesce(when, F.lit(False))
    for column, flags in by_column.items():
        values = df.filter(F.col(column).isNotNull()).groupBy(*groups, F.col(column).alias("_value")).agg(*[F.max(flag).alias(name) for name, flag in flags.items()])
        counted = values.groupBy(*[F.col(g).alias(f"_{g}") for g in groups]).agg(*[X.count_if(F.col(name)).alias(name) for name in flags])
        if groups:
            same = F.lit(True)
            for g in groups:
                same = same & out[g].eqNullSafe(counted[f"_{g}"])
            out = out.join(counted, same, "left").drop(*[f"_{g}" for g in groups])
        else:
            out = out.crossJoin(F.broadcast(counted))
    return out.withColumns({name: F.coalesce(F.col(name), F.lit(0).cast("bigint")) for name in counts})
