"""Joins and broadcasts that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 200_000
HOT_KEYS = 1000
TRACKED = 8192  # sketch size per task: finds every key above about 1/1000 of the rows
SALTS = 64      # pieces a hot key is cut into


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast ``df`` only if it has at most ``max_rows`` rows; otherwise leave the choice to Spark."""
    small = df.select(F.lit(1)).limit(max_rows + 1).count() <= max_rows
    return F.broadcast(df) if small else df


def hot_values(df: DataFrame, *columns: str, share: float = 1 / 1000) -> dict[str, list]:
    """Values that hold at least ``share`` of the rows, per column, from one frequent-items sketch pass.

    At most ``HOT_KEYS`` values per column come back. The answer only steers how rows are spread, never the result.
    """
    top = [F.expr(f"approx_top_k(`{c}`, {HOT_KEYS}, {TRACKED})").alias(c) for c in columns]
    row = df.agg(F.count(F.lit(1)).alias("_n"), *top).first()
    floor = max(row["_n"] * share, 1000)
    return {c: [e["item"] for e in (row[c] or []) if e["item"] is not None and e["count"] >= floor] for c in columns}


def spread_join(left: DataFrame, right: DataFrame, on: str, how: str = "left", hot: list | None = None) -> DataFrame:
    """Join to a side with one row per key, ``left`` or ``inner``, with the hot keys of the left side spread out.

    The join is on the typed key and a salt. Left rows of a hot key, or without a key, take one of ``SALTS`` salts by a hash
    of the row; right rows of hot keys, ``HOT_KEYS`` at most, are repeated for each salt. All other rows have salt 0. So the
    result is that of the plain join for every key type, and only the layout differs.
    """
    if how not in ("left", "inner"):
        raise ValueError("how must be 'left' or 'inner'")
    if hot is None:
        hot = hot_values(left, on)[on]
    if not hot:
        return left.join(right, on, how)
    is_hot = F.coalesce(F.col(on).isin(hot), F.lit(False))
    scattered = F.pmod(F.xxhash64(*left.columns), F.lit(SALTS)).cast("int")
    salted = left.withColumn("_salt", F.when(is_hot | F.col(on).isNull(), scattered).otherwise(0))
    repeated = right.withColumn("_salt", F.explode(F.when(is_hot, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))))
    return salted.join(repeated, [on, "_salt"], how).drop("_salt")
