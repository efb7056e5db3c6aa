"""Bronze to silver: clean, drop repeats and noise, add calendar columns; and the prepared line layer."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline import schemas
from tallyline.functions import exprs as X
from tallyline.sources import lake as L


def clean(bronze: DataFrame) -> DataFrame:
    """Trimmed texts, 'UNKNOWN' for a blank description, ``line_amount``."""
    texts = {c: X.clean_text(c) for c in ("description", "stock_code", "country", "invoice")}
    out = bronze.withColumns(texts)
    return out.withColumns({
        "description": F.when(F.col("description") == "", "UNKNOWN").otherwise(F.col("description")),
        "line_amount": F.col("quantity") * F.col("price"),
    })


def drop_repeats(bronze: DataFrame) -> DataFrame:
    """One row per business record. The load time is not part of the record, so a re-load adds nothing.

    Records are moved before they are compared: repeats are few, and a table of all records of a large file would spill.
    """
    return bronze.repartition(*schemas.BUSINESS_COLUMNS).dropDuplicates(schemas.BUSINESS_COLUMNS)


def drop_noise(lines: DataFrame) -> DataFrame:
    return lines.filter(~X.is_noise())


PIECES = 1 << 16  # of a month, at most: two bytes of digest to move with a row


def drop_repeats_by_month(bronze: DataFrame) -> DataFrame:
    """As ``drop_repeats``, with the rows laid out by month: they can be written by month without being moved again.

    Range partitions over month and a digest of the record hold a month or two each, and are even whatever a month's size.
    """
    keys = {"_month": X.month_index("invoice_date"), "_record": F.pmod(F.xxhash64(*schemas.BUSINESS_COLUMNS), F.lit(PIECES)).cast("int")}
    moved = bronze.withColumns(keys).repartitionByRange(*keys)
    return moved.dropDuplicates([*keys, *schemas.BUSINESS_COLUMNS]).drop(*keys)


def to_silver(bronze: DataFrame) -> DataFrame:
    """Lines laid out by month. Noise is filtered before the one shuffle, of the de-duplication: both orders keep the same rows."""
    lines = drop_repeats_by_month(drop_noise(clean(bronze))).withColumn("line_amount", F.col("quantity") * F.col("price"))
    return schemas.conform(lines.withColumns(X.calendar_columns("invoice_date")), schemas.SILVER)


def transform_all(spark: SparkSession, bronze_path: str, silver_path: str) -> list[str]:
    """Build every silver month that is missing or older than its bronze month, in one write.

    Returns all bronze months, newest first.
    """
    months, written, made = L.list_months(spark, bronze_path), L.month_times(spark, bronze_path), L.month_times(spark, silver_path)
    todo = [m for m in months if m not in made or made[m] < written[m]]
    if todo:
        bronze = spark.read.parquet(bronze_path).filter(F.col("year_month").isin(todo))
        L.write_months(to_silver(bronze), silver_path, laid_out=True)
    return months


def transform_month(spark: SparkSession, bronze_path: str, silver_path: str, year_month: str) -> bool:
    if year_month in L.list_months(spark, silver_path):
        return False
    if year_month not in L.list_months(spark, bronze_path):
        raise FileNotFoundError(f"no bronze partition {year_month} under {bronze_path}")
    bronze = spark.read.parquet(bronze_path).filter(F.col("year_month") == year_month)
    L.write_months(to_silver(bronze), silver_path, laid_out=True)
    return True


def read_silver(spark: SparkSession, silver_path: str) -> DataFrame:
    """All months, in the declared column order, with the month taken from the partition."""
    return schemas.conform(spark.read.parquet(silver_path), schemas.SILVER)


# ---- staging and prepared views ----------------------------------------------------------------------------

def staging(silver: DataFrame) -> DataFrame:
    """Typed projection of silver."""
    return schemas.conform(silver, schemas.SILVER)


def prepared(silver: DataFrame) -> DataFrame:
    """Lines with their calendar day and the valid-purchase flag."""
    return silver.withColumns({"tx_date": F.to_date("invoice_date"), "is_valid_purchase": X.is_valid_purchase()})


def valid_purchase_rows(lines: DataFrame) -> DataFrame:
    """Known customer, not cancelled, positive amount; blank and NULL customers are both guests."""
    return lines.filter(~X.is_guest() & ~F.col("is_cancellation") & (F.col("line_amount") > 0))


def dashboard_eligible_rows(lines: DataFrame) -> DataFrame:
    return lines.filter((F.col("quantity") >= 0) & (F.col("line_amount") >= 0))
