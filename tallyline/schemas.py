"""Explicit layer schemas, fixed vocabularies and the schema assertion."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


_S, _D, _B, _I, _L = T.StringType(), T.DoubleType(), T.BooleanType(), T.IntegerType(), T.LongType()
_N, _TS, _DT = T.TimestampNTZType(), T.TimestampType(), T.DateType()

# The header of the raw file, in file order, with the snake_case name each column gets.
RAW_COLUMNS = {
    "Invoice": "invoice",
    "StockCode": "stock_code",
    "Description": "description",
    "Quantity": "quantity",
    "InvoiceDate": "invoice_date",
    "Price": "price",
    "Customer ID": "customer_id",
    "Country": "country",
}

RAW = T.StructType([T.StructField(name, _S) for name in RAW_COLUMNS])

BRONZE = _struct(
    invoice=_S, stock_code=_S, description=_S, quantity=_D, invoice_date=_N, original_invoice_date=_N, price=_D,
    customer_id=_S, country=_S, is_cancellation=_B, ingested_at=_TS, year_month=_S,
)

SILVER = _struct(
    invoice=_S, stock_code=_S, description=_S, quantity=_D, price=_D, customer_id=_S, country=_S, is_cancellation=_B,
    line_amount=_D, invoice_date=_N, original_invoice_date=_N, invoice_year=_I, invoice_month=_I, invoice_day=_I,
    invoice_quarter=_I, invoice_day_of_week=_I, invoice_week=_I, year_month=_S,
)

# Names and types of the metric history.
MONITORING = _struct(run_date=_DT, run_id=_S, metric_name=_S, metric_value=_D, category=_S)

# Columns that make up one business record: everything in bronze but the load time and the partition key.
BUSINESS_COLUMNS = [f.name for f in BRONZE if f.name not in ("ingested_at", "year_month")]
KEY_COLUMNS = ["invoice", "stock_code", "customer_id", "country"]
# Columns of the fact in contract order.
FACT_COLUMNS = [
    "transaction_sk", "customer_sk", "product_sk", "country_sk", "date_sk", "quantity", "price", "line_amount",
    "is_cancellation",
]

# The 32 model features in model order.
FEATURE_COLUMNS = [
    "recency_days", "frequency", "monetary", "frequency_last_30d", "frequency_last_90d", "monetary_last_90d",
    "avg_order_value", "avg_basket_size", "avg_unit_price", "total_quantity", "unique_products", "tenure_days",
    "avg_days_between_orders", "std_days_between_orders", "days_since_first_purchase", "is_one_time_buyer",
    "cancellation_rate", "return_quantity_rate", "weekend_purchase_ratio", "monetary_trend",
    "max_single_order_value", "min_single_order_value", "ratio_frequency_90d", "velocity_ratio_180d",
    "spending_recency_ratio", "velocity_ratio_30d_90d", "overdue_ratio", "purchase_regularity", "recency_one_time",
    "product_diversity_trend", "monetary_acceleration", "is_uk",
]

# Features that are log-transformed before clustering.
SKEWED_FEATURES = [
    "recency_days", "frequency", "monetary", "avg_order_value", "avg_basket_size", "avg_unit_price",
    "total_quantity", "unique_products", "tenure_days", "days_since_first_purchase", "max_single_order_value",
    "min_single_order_value", "frequency_last_30d", "frequency_last_90d", "monetary_last_90d", "overdue_ratio",
    "recency_one_time",
]

# Allowed ranges of the features.
BINARY_FEATURES = ["is_one_time_buyer", "is_uk"]
UNIT_INTERVAL_FEATURES = [
    "cancellation_rate", "return_quantity_rate", "weekend_purchase_ratio", "ratio_frequency_90d",
    "velocity_ratio_180d", "spending_recency_ratio", "velocity_ratio_30d_90d", "product_diversity_trend",
]
CAPPED_FEATURES = {"overdue_ratio": 10.0, "purchase_regularity": 5.0, "monetary_acceleration": 20.0}
NON_NEGATIVE_FEATURES = [
    "recency_days", "frequency", "monetary", "frequency_last_30d", "frequency_last_90d", "monetary_last_90d",
    "avg_order_value", "avg_basket_size", "avg_unit_price", "total_quantity", "unique_products", "tenure_days",
    "avg_days_between_orders", "std_days_between_orders", "days_since_first_purchase", "max_single_order_value",
    "min_single_order_value", "recency_one_time",
]

# Columns of the score table and of the retention list in contract order.
SCORING_COLUMNS = ["customer_id", "churn_probability", "churn_flag", "risk_tier"]
RETENTION_COLUMNS = [
    "customer_id", "segment", "churn_probability", "risk_tier", "recency_days", "frequency", "monetary",
]


class SchemaMismatch(ValueError):
    """A table does not have exactly the declared columns, order and types."""


def assert_schema(df: DataFrame, expected: T.StructType) -> DataFrame:
    """Return ``df`` unchanged if names, order and types equal ``expected``; nullability is not compared."""
    have = [(f.name, f.dataType.simpleString()) for f in df.schema]
    want = [(f.name, f.dataType.simpleString()) for f in expected]
    if have != want:
        wrong = [f"{h} != {w}" for h, w in zip(have, want) if h != w]
        raise SchemaMismatch(f"{len(have)} columns against {len(want)} declared; differing: {wrong}")
    return df


def conform(df: DataFrame, expected: T.StructType) -> DataFrame:
    """Project onto the declared columns in order, with the declared types, and assert the result."""
    return assert_schema(df.select([df[f.name].cast(f.dataType).alias(f.name) for f in expected]), expected)
