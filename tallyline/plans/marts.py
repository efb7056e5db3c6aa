"""Invoice roll-up, RFM mart and monthly KPI mart."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.functions import exprs as X
from tallyline.operators.distinct import with_distinct_counts
from tallyline.operators.ordering import ntiles_by_value
from tallyline.sources.lake import Scratch


def invoice_rollup(lines: DataFrame) -> DataFrame:
    """Prepared lines at (customer, invoice, time) grain: the one wide shuffle most marts start from.

    Sums are whole 1/10000 units. Distinct invoice counts become plain counts or small distincts over this table.
    """
    valid = F.col("is_valid_purchase")
    amount, quantity = X.units("line_amount"), X.units("quantity")
    zero = F.lit(0).cast("bigint")

    def total(value, when):
        return F.sum(F.when(when, value).otherwise(zero))

    return lines.groupBy("customer_id", "invoice", "invoice_date", "year_month").agg(
        F.count(F.lit(1)).alias("lines"),
        F.max(valid).alias("has_valid"),
        F.max("is_cancellation").alias("has_cancelled"),
        total(amount, valid).alias("valid_amount"),
        total(quantity, valid).alias("valid_quantity"),
        total(amount, F.col("is_cancellation")).alias("cancelled_amount"),
        total(quantity, F.col("quantity") > 0).alias("quantity_out"),
        total(-quantity, F.col("quantity") < 0).alias("quantity_back"),
        F.min("country").alias("country"),
    )


def kpi_monthly(rollup: DataFrame) -> DataFrame:
    valid, cancelled = F.col("has_valid"), F.col("has_cancelled")
    month = with_distinct_counts(
        rollup, ["year_month"],
        [X.from_units(F.sum("valid_amount")).alias("revenue"), X.from_units(F.sum("valid_quantity")).alias("units_sold"),
         X.from_units(F.sum("cancelled_amount")).alias("cancellation_value"), F.sum("lines").alias("line_count")],
        {"orders": ("invoice", valid), "active_customers": ("customer_id", valid), "cancelled_orders": ("invoice", cancelled)})
    return month.select(
        "year_month", "revenue", "units_sold", "orders", "active_customers",
        X.round_to(X.ratio("revenue", "orders"), 4).alias("aov"),
        "cancelled_orders", "cancellation_value",
        (F.col("revenue") + F.col("cancellation_value")).alias("net_revenue"),
        X.round_to(X.ratio("cancelled_orders", F.col("orders") + F.col("cancelled_orders")), 4).alias(
            "cancellation_order_rate"),
        "line_count",
    )


def rfm_base(rollup: DataFrame) -> DataFrame:
    """Recency, frequency and monetary value of every customer with a positive total of valid purchases."""
    purchases = rollup.filter("has_valid")
    invoices = purchases.groupBy("customer_id", "invoice").agg(
        F.max("invoice_date").alias("at"), F.sum("valid_amount").alias("amount"))
    newest = purchases.agg(F.max("invoice_date").alias("reference_at"))
    customers = invoices.groupBy("customer_id").agg(
        F.max("at").alias("last_purchase"), F.count(F.lit(1)).alias("frequency"), F.sum("amount").alias("amount"),
    ).filter(F.col("amount") > 0)
    return customers.crossJoin(F.broadcast(newest)).select(
        "customer_id", X.days_between("last_purchase", "reference_at").alias("recency_days"), "frequency",
        X.from_units("amount").alias("monetary"))


def score_rfm(base: DataFrame, scratch: Scratch) -> DataFrame:
    """Quintile scores 1..5 and the segment. Ties are broken by customer id, so the scores are repeatable.

    The base is written once. Each score is cut from the counts of its values: a customer's bucket follows from its value, and
    only customers whose value straddles a cut are ordered by id.
    """
    scored = ntiles_by_value(scratch.write(base), "customer_id", {
        "r_score": ("recency_days", True), "f_score": ("frequency", False), "m_score": ("monetary", False)}, 5, scratch)
    return scored.select("customer_id", "recency_days", "frequency", "monetary", "r_score", "f_score", "m_score",
                         X.segment_label("r_score", "f_score").alias("segment"))


def mart_rfm(rollup: DataFrame, scratch: Scratch) -> DataFrame:
    return score_rfm(rfm_base(rollup), scratch)
