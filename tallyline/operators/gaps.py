"""Gaps between consecutive events of one key, without gathering a key's whole history in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyline.functions import exprs as X


def event_gaps(events: DataFrame, key: str, at: str, tiebreak: str) -> DataFrame:
    """(key, at, gap_us): one row per pair of consecutive events of a key, like LAG over (key ORDER BY at, tiebreak); ``at`` is the later one's time.

    Gaps inside a day come from a window per (key, day); gaps across days from a second window over one row per
    (key, day). A key with a third of all events is thus spread over its days.
    """
    timed = events.select(key, tiebreak, F.col(at).alias("at"), F.to_date(at).alias("_day"), X.micros(at).alias("_us"))
    in_day = Window.partitionBy(key, "_day").orderBy("_us", tiebreak)
    inside = timed.withColumn("gap_us", F.col("_us") - F.lag("_us").over(in_day))
    days = inside.groupBy(key, "_day").agg(F.min("at").alias("at"), F.min("_us").alias("_first"), F.max("_us").alias("_last"))
    by_day = Window.partitionBy(key).orderBy("_day")
    across = days.select(key, "at", (F.col("_first") - F.lag("_last").over(by_day)).alias("gap_us"))
    return inside.select(key, "at", "gap_us").unionByName(across).filter("gap_us IS NOT NULL")
