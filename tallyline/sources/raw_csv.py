"""The raw semicolon-separated sales file and its typed bronze form."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline import schemas
from tallyline.functions import exprs as X

# Last day of the source data and the day it is moved to.
SHIFT_FROM, SHIFT_TO = date(2011, 12, 9), date(2026, 6, 10)
SHIFT_DAYS = (SHIFT_TO - SHIFT_FROM).days


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """All eight columns as text. Header names are matched after trimming, in any order."""
    reader = (spark.read.option("sep", ";").option("encoding", "ISO-8859-1").option("header", True)
              .option("quote", '"').option("escape", '"').option("inferSchema", False))
    raw = reader.csv(path)
    raw = raw.withColumnsRenamed({c: c.strip() for c in raw.columns if c != c.strip()})
    return raw.select([X.missing_to_null(F.col(f"`{f.name}`")).alias(f.name) for f in schemas.RAW])


def discover_months(raw: DataFrame, shift_days: int = SHIFT_DAYS) -> DataFrame:
    """Distinct shifted months. Only the date column is read from the file."""
    shifted = X.shift_days(X.parse_day_first("InvoiceDate"), shift_days)
    return raw.select(X.year_month(shifted).alias("year_month")).filter("year_month IS NOT NULL").distinct()


def months_newest_first(months: DataFrame) -> list[str]:
    return sorted((r["year_month"] for r in months.collect()), reverse=True)


def auto_shift_days(raw: DataFrame, target: date) -> int:
    """Days that move the newest invoice day onto ``target``."""
    newest = raw.select(F.max(F.to_date(X.parse_day_first("InvoiceDate")))).first()[0]
    return (target - newest).days


def normalize(raw: DataFrame, shift_days: int = SHIFT_DAYS, ingested_at: datetime | Column | None = None) -> DataFrame:
    """Raw text columns to the bronze schema. A date that cannot be read leaves ``year_month`` NULL."""
    named = raw.withColumnsRenamed(schemas.RAW_COLUMNS)
    original = X.parse_day_first("invoice_date")
    loaded = F.current_timestamp() if ingested_at is None else F.lit(ingested_at)
    typed = named.select(
        X.clean_text("invoice").alias("invoice"),
        F.upper(X.clean_text("stock_code")).alias("stock_code"),
        X.clean_text("description").alias("description"),
        X.parse_decimal_comma("quantity").alias("quantity"),
        X.shift_days(original, shift_days).alias("invoice_date"),
        original.alias("original_invoice_date"),
        X.parse_decimal_comma("price").alias("price"),
        X.clean_text("customer_id").alias("customer_id"),
        X.clean_text("country").alias("country"),
        F.startswith(X.clean_text("invoice"), F.lit("C")).alias("is_cancellation"),
        loaded.cast("timestamp").alias("ingested_at"),
    )
    return schemas.conform(typed.withColumn("year_month", X.year_month("invoice_date")), schemas.BRONZE)
