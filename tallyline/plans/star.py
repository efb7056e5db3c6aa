"""Star schema: four dimensions and the transaction fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline import schemas
from tallyline.operators.ordering import global_row_number
from tallyline.operators.skew import broadcast_if_small, hot_values, spread_join
from tallyline.sources.lake import Scratch

# Total order of the fact: the leading four columns are the business order, the rest make every row distinct.
FACT_ORDER = ["tx_date", "invoice", "stock_code", "customer_id", "invoice_date", "quantity", "price", "description",
              "country", "original_invoice_date"]


def dim_date(lines: DataFrame, scratch: Scratch) -> DataFrame:
    days = lines.select(F.col("tx_date").alias("date")).distinct()
    return global_row_number(days, ["date"], scratch, "date_sk").select(
        "date_sk", "date", F.year("date").alias("year"), F.month("date").alias("month"),
        F.weekofyear("date").alias("week"), F.weekday("date").alias("day_of_week"), F.quarter("date").alias("quarter"))


def dim_product(lines: DataFrame, scratch: Scratch) -> DataFrame:
    products = lines.groupBy("stock_code").agg(F.min("description").alias("description"))
    return global_row_number(products, ["stock_code"], scratch, "product_sk").select(
        "product_sk", "stock_code", "description")


def dim_country(lines: DataFrame, scratch: Scratch) -> DataFrame:
    countries = lines.select(F.col("country").alias("country_name")).distinct()
    return global_row_number(countries, ["country_name"], scratch, "country_sk").select("country_sk", "country_name")


def dim_customer(lines: DataFrame, rfm: DataFrame | None, scratch: Scratch) -> DataFrame:
    """Known customers numbered from 1, and the Unknown member 0 that all guest lines point to."""
    known = lines.filter(F.col("customer_id") != "").groupBy("customer_id").agg(
        F.min("invoice_date").alias("first_seen_date"))
    numbered = global_row_number(known, ["customer_id"], scratch, "customer_sk")
    if rfm is None:
        labelled = numbered.withColumn("segment", F.lit("UNKNOWN"))
    else:
        labelled = numbered.join(rfm.select("customer_id", "segment"), "customer_id", "left").withColumn(
            "segment", F.coalesce("segment", F.lit("UNKNOWN")))
    unknown = lines.sparkSession.range(1).select(
        F.lit(0).cast("bigint").alias("customer_sk"), F.lit("").alias("customer_id"),
        F.lit(None).cast("timestamp_ntz").alias("first_seen_date"), F.lit("Unknown").alias("segment"))
    return labelled.select("customer_sk", "customer_id", "first_seen_date", "segment").unionByName(unknown)


def fact_transactions(lines: DataFrame, customers: DataFrame, products: DataFrame, countries: DataFrame,
                      dates: DataFrame, scratch: Scratch, sk_mode: str = "dense") -> DataFrame:
    """Every line with its surrogate keys.

    ``sk_mode='dense'`` numbers the lines 1..n in business order, before the joins, so that the joins run once.
    ``'hash'`` takes 128 hash bits of the business record, as hexadecimal text, instead: no global order is needed and a key never changes when other rows
    arrive. Guest lines take key 0 and are kept out of the customer join, where they would all meet in one task.
    """
    rows = lines.select(*FACT_ORDER, "line_amount", "is_cancellation")
    if sk_mode == "hash":
        halves = [F.lpad(F.hex(F.xxhash64(F.lit(seed), *FACT_ORDER)), 16, "0") for seed in (1, 2)]
        keyed = rows.withColumn("transaction_sk", F.concat(*halves))
    elif sk_mode == "dense":
        keyed = global_row_number(rows, FACT_ORDER, scratch, "transaction_sk")
    else:
        raise ValueError("sk_mode must be 'dense' or 'hash'")
    keyed = keyed.select("transaction_sk", "tx_date", "customer_id", "stock_code", "country", "quantity", "price",
                         "line_amount", "is_cancellation")
    keyed = keyed.withColumn("customer_key", F.when(F.col("customer_id") != "", F.col("customer_id")).otherwise(
        F.concat(F.lit("guest:"), F.xxhash64("transaction_sk").cast("string")))).drop("customer_id")
    hot = hot_values(keyed, "customer_key", "stock_code")
    known = customers.filter("customer_id <> ''").select(F.col("customer_id").alias("customer_key"), "customer_sk")
    out = spread_join(keyed, known, "customer_key", hot=hot["customer_key"])
    out = spread_join(out, products.select("product_sk", "stock_code"), "stock_code", hot=hot["stock_code"])
    out = out.join(broadcast_if_small(countries.withColumnRenamed("country_name", "country")), "country", "left")
    out = out.join(broadcast_if_small(dates.select("date_sk", F.col("date").alias("tx_date"))), "tx_date", "left")
    out = out.withColumn("customer_sk", F.coalesce("customer_sk", F.lit(0).cast("bigint")))
    return out.select(schemas.FACT_COLUMNS)
