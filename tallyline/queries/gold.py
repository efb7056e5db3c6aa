"""Star schema, marts, features and labels."""

from __future__ import annotations

from tallyline.functions import exprs as X
from tallyline.plans import features, marts, star
from tallyline.queries.base import HOME, LAYERS, features_sql, query, s_ratio, s_round, with_layers
from tallyline.schemas import FEATURE_COLUMNS

query("g1_dim_date", "SELECT * FROM dim_date")(lambda r: star.dim_date(r.lines, r.scratch))
query("g2_dim_customer", "SELECT * FROM dim_customer")(lambda r: star.dim_customer(r.lines, r.mart_rfm, r.scratch))
query("g3_dim_product", "SELECT * FROM dim_product")(lambda r: star.dim_product(r.lines, r.scratch))
query("g4_dim_country", "SELECT * FROM dim_country")(lambda r: star.dim_country(r.lines, r.scratch))
query("g6_mart_rfm", "SELECT * FROM rfm")(lambda r: marts.mart_rfm(marts.invoice_rollup(r.lines), r.scratch))

KPI_SQL = f"""SELECT year_month, revenue, units_sold, orders, active_customers,
    {s_round(s_ratio("revenue", "orders"), 4)} AS aov, cancelled_orders, cancellation_value,
    revenue + cancellation_value AS net_revenue,
    {s_round(s_ratio("cancelled_orders", "orders + cancelled_orders"), 4)} AS cancellation_order_rate, line_count
    FROM kpi"""
query("g7_mart_kpi_monthly", KPI_SQL)(lambda r: marts.kpi_monthly(marts.invoice_rollup(r.lines)))


@query("g5_fact_transactions", "SELECT * FROM fact")
def fact_dense(r):
    return star.fact_transactions(r.lines, r.dim_customer, r.dim_product, r.dim_country, r.dim_date, r.scratch)


@query("g5_fact_hash_keys", """SELECT customer_sk, product_sk, country_sk, date_sk, quantity, price, line_amount,
    is_cancellation, CAST(1 AS BIGINT) AS rows_per_key FROM fact""")
def fact_hash(r):
    """The hash-keyed fact: every key is unique, everything else equals the dense fact."""
    fact = star.fact_transactions(r.lines, r.dim_customer, r.dim_product, r.dim_country, r.dim_date, r.scratch, "hash")
    per_key = fact.groupBy("transaction_sk").agg(
        *[_first(c) for c in fact.columns if c != "transaction_sk"], _rows().alias("rows_per_key"))
    return per_key.drop("transaction_sk")


def _first(column):
    from pyspark.sql import functions as F
    return F.max(column).alias(column)


def _rows():
    from pyspark.sql import functions as F
    return F.count(F.lit(1))


# Values that come out of floating-point aggregation, compared at six decimals.
NOISY = {"std_days_between_orders", "purchase_regularity"}


def tidy(df):
    return df.withColumns({c: X.round_to(c, 6) for c in NOISY if c in df.columns})


def feature_list_sql(names=FEATURE_COLUMNS):
    return ", ".join(f"{s_round(c, 6)} AS {c}" if c in NOISY else c for c in names)


@query("g8_mart_features", f"SELECT customer_id, {feature_list_sql()} FROM fx")
def feature_mart(r):
    return tidy(features.mart_features(r.lines, home_country=HOME))


_ALL_LAYERS = {**LAYERS, **features_sql("lines", "obs_score", "TRUE")}
_TRAIN_LAYERS = {**LAYERS, **features_sql("lines", "obs_train")}


@query("g8_mart_features_all_invoices", with_layers(f"SELECT customer_id, {feature_list_sql()} FROM fx", _ALL_LAYERS))
def feature_mart_all(r):
    return tidy(features.mart_features(r.lines, gap_scope="all", home_country=HOME))


@query("g9_churn_labels", "SELECT customer_id, churn FROM labels_train")
def labels(r):
    return features.churn_labels(r.lines, features.training_cutoff(r.lines))


@query("g10_feature_matrix_train", with_layers(
    f"SELECT customer_id, {feature_list_sql()}, churn FROM fx JOIN labels_train USING (customer_id)", _TRAIN_LAYERS))
def train_matrix(r):
    return tidy(features.feature_matrix(r.lines, "train", home_country=HOME, rollup=r.rollup))


@query("g10_feature_matrix_score", f"SELECT customer_id, {feature_list_sql()} FROM fx")
def score_matrix(r):
    return tidy(features.feature_matrix(r.lines, "score", home_country=HOME, rollup=r.rollup))


for _position, _name in enumerate(FEATURE_COLUMNS, start=1):
    query(f"f{_position}_{_name}", f"SELECT customer_id, {feature_list_sql([_name])} FROM fx")(
        lambda r, name=_name: tidy(r.mart_features.select("customer_id", name)))
