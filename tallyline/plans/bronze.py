"""Raw file to monthly bronze partitions."""

from __future__ import annotations

import warnings
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.functions import exprs as X
from tallyline.sources import lake as L
from tallyline.sources import raw_csv

AUDIT_FOLDER = "_ingestion_log"
LATE_FOLDER = "_late_rows"


def ingestion_audit(bronze: DataFrame, source_file: str) -> DataFrame:
    """One audit row per month."""
    return bronze.groupBy("year_month").agg(
        F.count(F.lit(1)).alias("row_count"),
        X.count_if(F.col("is_cancellation")).alias("cancellation_count"),
        X.count_if(F.col("customer_id") == "").alias("null_customer_count"),
        F.min("invoice_date").alias("min_invoice_date"),
        F.max("invoice_date").alias("max_invoice_date"),
        F.count_distinct("country").alias("unique_countries"),
        F.max("ingested_at").alias("ingested_at"),
    ).withColumn("source_file", F.lit(source_file))


def not_ingested(bronze: DataFrame, done: list[str]) -> DataFrame:
    """Rows of months that have no partition yet."""
    return bronze.filter(~F.col("year_month").isin(done)) if done else bronze


def already_ingested(spark: SparkSession, bronze_path: str, year_month: str) -> bool:
    return year_month in L.list_months(spark, bronze_path)


def _write(spark: SparkSession, bronze: DataFrame, bronze_path: str, source_file: str, replaced: Iterable[str] = ()) -> None:
    """Write the months and append their audit rows, counted from the written partitions."""
    before = set(L.list_months(spark, bronze_path)) - set(replaced)
    L.write_months(bronze, bronze_path)
    fresh = [m for m in L.list_months(spark, bronze_path) if m not in before]
    if fresh:
        written = spark.read.parquet(bronze_path).filter(F.col("year_month").isin(fresh))
        ingestion_audit(written, source_file).write.mode("append").parquet(f"{bronze_path}/{AUDIT_FOLDER}")


def ingest_all(spark: SparkSession, raw_path: str, bronze_path: str, shift_days: int = raw_csv.SHIFT_DAYS,
               overwrite: Iterable[str] | bool = False) -> list[str]:
    """Ingest every month that is missing, in one write. Returns all source months, newest first.

    Months named in ``overwrite``, or all with True, are replaced by what the source has now: the way to take in late
    rows. Rows whose date cannot be read have no month; see ``quarantine``.
    """
    raw = raw_csv.read_raw(spark, raw_path)
    months = raw_csv.months_newest_first(raw_csv.discover_months(raw, shift_days))
    ingest_typed(spark, raw_csv.normalize(raw, shift_days), months, bronze_path, raw_path.rsplit("/", 1)[-1], overwrite)
    return months


def ingest_typed(spark: SparkSession, typed: DataFrame, months: list[str], bronze_path: str, source_file: str,
                 overwrite: Iterable[str] | bool = False) -> None:
    """Write the rows of those of ``months`` that have no partition yet or are to be replaced."""
    replaced = set(months) if overwrite is True else set(overwrite or ())
    done = [m for m in L.list_months(spark, bronze_path) if m not in replaced]
    report_late_rows(spark, typed, sorted(set(months) & set(done)), bronze_path, source_file)
    if set(months) - set(done):
        _write(spark, not_ingested(typed.filter("year_month IS NOT NULL"), done), bronze_path, source_file, replaced)


def report_late_rows(spark: SparkSession, typed: DataFrame, kept: list[str], bronze_path: str, source_file: str) -> list[str]:
    """Months that are kept as they are although the source has more rows for them now than bronze, with both counts, as a
    warning and as rows of ``LATE_FOLDER``. ``overwrite`` takes such rows in."""
    if not kept:
        return []
    source = typed.filter(F.col("year_month").isin(kept)).groupBy("year_month").agg(F.count(F.lit(1)).alias("source_rows"))
    stored = spark.read.parquet(bronze_path).filter(F.col("year_month").isin(kept)).groupBy("year_month").agg(F.count(F.lit(1)).alias("stored_rows"))
    late = source.join(F.broadcast(stored), "year_month").filter("source_rows > stored_rows").select(
        "year_month", "source_rows", "stored_rows", F.lit(source_file).alias("source_file"), F.current_timestamp().alias("seen_at"))
    rows = late.collect()  # one row a month
    if rows:
        spark.createDataFrame(rows, late.schema).coalesce(1).write.mode("append").parquet(f"{bronze_path}/{LATE_FOLDER}")
        warnings.warn("late rows left out: " + ", ".join(f"{r['year_month']} has {r['source_rows']}, stored {r['stored_rows']}" for r in rows), stacklevel=3)
    return [r["year_month"] for r in rows]


def ingest(spark: SparkSession, raw_path: str, bronze_path: str, year_month: str,
           shift_days: int = raw_csv.SHIFT_DAYS) -> bool:
    """Ingest one month. False, and nothing written, if it exists already or the source has no such rows."""
    if already_ingested(spark, bronze_path, year_month):
        return False
    month = raw_csv.normalize(raw_csv.read_raw(spark, raw_path), shift_days).filter(F.col("year_month") == year_month)
    if month.limit(1).count() == 0:
        warnings.warn(f"no rows for {year_month} in {raw_path}", stacklevel=2)
        return False
    _write(spark, month, bronze_path, raw_path.rsplit("/", 1)[-1])
    return True


def read_month(spark: SparkSession, bronze_path: str, year_month: str) -> DataFrame:
    if not already_ingested(spark, bronze_path, year_month):
        raise FileNotFoundError(f"no bronze partition {year_month} under {bronze_path}")
    return spark.read.parquet(bronze_path).filter(F.col("year_month") == year_month)
