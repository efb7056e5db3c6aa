"""Sales lines in the bronze shape from order tables: lineitem, orders, customer, nation, part."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline import schemas
from tallyline.functions import exprs as X
from tallyline.operators.skew import broadcast_if_small, hot_values, spread_join

TABLES = ["lineitem", "orders", "customer", "nation", "part"]
HOME_COUNTRY = "NATION_0"


def bronze_lines(spark: SparkSession, folder: str) -> DataFrame:
    """One row per order line, in the bronze schema, laid out by month.

    Every third returned order is a cancellation ('C' prefix, negative quantity), every fifth order is a guest order,
    lines without discount and tax have price 0, and lines of every 97th order occur twice.
    """
    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{folder}/{name}.parquet")

    lines = table("lineitem").select(
        "l_orderkey", "l_partkey", "l_quantity", ((F.col("l_returnflag") == "R") & (F.col("l_orderkey") % 3 == 0)).alias("cancelled"),
        ((F.col("l_discount") == 0) & (F.col("l_tax") == 0)).alias("free"),
        F.explode(F.when(F.col("l_orderkey") % 97 == 0, F.array(F.lit(1), F.lit(2))).otherwise(
            F.array(F.lit(1)))).alias("copy"),
    ).drop("copy")
    hot = hot_values(table("lineitem"), "l_orderkey", "l_partkey")

    nation = broadcast_if_small(table("nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name"))
    customer = table("customer").select("c_custkey", "c_nationkey").join(nation, "c_nationkey")
    orders = spread_join(
        table("orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"), "o_orderdate"),
        customer.select("c_custkey", "n_name"), "c_custkey", "inner")
    parts = table("part").select(F.col("p_partkey").alias("l_partkey"), "p_name", "p_retailprice")
    joined = spread_join(lines, orders.withColumnRenamed("o_orderkey", "l_orderkey"), "l_orderkey", "inner",
                         hot["l_orderkey"])
    joined = spread_join(joined, parts, "l_partkey", "inner", hot["l_partkey"])

    # moved by month before texts and times are made of the keys: the rows are shorter
    joined = joined.withColumn("_month", X.month_index("o_orderdate")).hint("rebalance", "_month")
    order, cancelled = F.col("l_orderkey"), F.col("cancelled")
    at = F.col("o_orderdate").cast("timestamp_ntz") + F.make_dt_interval(
        F.lit(0), F.lit(0), (order % 1440).cast("int"))
    bronze = joined.select(
        F.concat(F.when(cancelled, "C").otherwise(""), order.cast("string")).alias("invoice"),
        F.col("l_partkey").cast("string").alias("stock_code"),
        F.col("p_name").alias("description"),
        F.when(cancelled, -F.col("l_quantity")).otherwise(F.col("l_quantity")).alias("quantity"),
        at.alias("invoice_date"),
        at.alias("original_invoice_date"),
        F.when(F.col("free"), F.lit(0.0)).otherwise(F.col("p_retailprice")).alias("price"),
        F.when(order % 5 == 0, "").otherwise(F.col("c_custkey").cast("string")).alias("customer_id"),
        F.col("n_name").alias("country"),
        cancelled.alias("is_cancellation"),
        F.lit("2026-06-10 00:00:00").cast("timestamp").alias("ingested_at"),
        X.year_month(at).alias("year_month"),
    )
    return schemas.conform(bronze, schemas.BRONZE)
