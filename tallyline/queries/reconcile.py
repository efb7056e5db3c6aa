"""The 29 layer invariants, each on the built tables and on a copy with faults planted in it."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyline.plans import reconcile as R
from tallyline.queries.base import LAYERS, query, s_count, s_units, with_layers
from tallyline.queries.gold import KPI_SQL
from tallyline import schemas

LAYERS["kpi_mart"] = KPI_SQL


class Built:
    """The built tables under the names of ``reconcile.Tables``, opened on first use; ``planted`` ones replace them."""

    def __init__(self, r, **planted):
        self._retail, self._planted = r, planted

    def __getattr__(self, name):
        stored = {"fact": "fact_transactions", "rfm": "mart_rfm", "kpi": "mart_kpi_monthly", "features": "mart_features"}
        return self._planted.get(name) or getattr(self._retail, stored.get(name, name))


# Names of the tables in ``Tables`` and in SQL.
SQL_NAMES = {"bronze": "bronze", "silver": "silver", "lines": "lines", "fact": "fact", "dim_customer": "dim_customer",
             "dim_product": "dim_product", "dim_country": "dim_country", "dim_date": "dim_date", "rfm": "rfm",
             "kpi": "kpi_mart", "features": "fx"}


INVARIANT_SQL: dict[str, str] = {}


def invariant(number: int, name: str, sql: str, table: str, fault, fault_sql: str) -> None:
    """Register the check and its faulty twin. ``sql`` names tables in braces; ``fault_sql`` selects from the table."""
    check = R.INVARIANTS[name].check
    INVARIANT_SQL[name] = sql.format(**SQL_NAMES)
    query(f"t{number}_{name}", with_layers(sql.format(**SQL_NAMES)))(lambda r: check(Built(r)))
    seeded = f"WITH faulty AS ({fault_sql})\n{sql.format(**{**SQL_NAMES, table: 'faulty'})}".replace(
        "\nWITH ", ",\n")
    query(f"t{number}_{name}_seeded", with_layers(seeded))(
        lambda r: check(Built(r, **{table: fault(getattr(Built(r), table))})))


def _drop(condition: str):
    return lambda df: df.filter(f"NOT ({condition})")


def _set(column: str, condition: str, value: str):
    return lambda df: df.withColumn(column, F.expr(f"CASE WHEN {condition} THEN {value} ELSE {column} END"))


def _set_sql(table: str, column: str, condition: str, value: str) -> str:
    return f"SELECT * REPLACE (CASE WHEN {condition} THEN {value} ELSE {column} END AS {column}) FROM {table}"


def _counts(name_a: str, sql_a: str, name_b: str, sql_b: str) -> str:
    return (f"SELECT {name_a}, {name_b} FROM (SELECT CAST(({sql_a}) AS BIGINT) AS {name_a}, "
            f"CAST(({sql_b}) AS BIGINT) AS {name_b}) t WHERE {name_a} <> {name_b}")


BUSINESS = ", ".join(schemas.BUSINESS_COLUMNS)
NOT_NOISE = "(is_cancellation OR price IS NULL OR price > 0)"

invariant(1, "bronze_stg_reconciliation", f"""SELECT bronze_count, dedup_count, expected_count, actual_count FROM (
        SELECT (SELECT {s_count()} FROM {{bronze}}) AS bronze_count,
            (SELECT {s_count()} FROM (SELECT DISTINCT {BUSINESS} FROM {{bronze}}) d) AS dedup_count,
            (SELECT {s_count()} FROM (SELECT DISTINCT {BUSINESS} FROM {{bronze}}) d WHERE {NOT_NOISE}) AS expected_count,
            (SELECT {s_count()} FROM {{silver}}) AS actual_count) t
    WHERE actual_count <> expected_count OR expected_count > bronze_count OR dedup_count > bronze_count""",
          "silver", _drop("country = 'NATION_7'"), "SELECT * FROM silver WHERE NOT (country = 'NATION_7')")

for _n, _name, _col, _dim in ((2, "dim_country_matches_stg_distinct", "country", "dim_country"),
                              (5, "dim_product_matches_stg_distinct", "stock_code", "dim_product")):
    _where = {"dim_country": "country_name = 'NATION_7'", "dim_product": "description = 'blue bolt'"}[_dim]
    invariant(_n, _name, _counts("source_count", f"SELECT COUNT(DISTINCT {_col}) FROM {{silver}}",
                                 "dim_count", f"SELECT COUNT(*) FROM {{{_dim}}}"),
              _dim, _drop(_where), f"SELECT * FROM {_dim} WHERE NOT ({_where})")

invariant(3, "dim_customer_matches_stg_distinct", _counts(
    "source_count", "SELECT COUNT(DISTINCT customer_id) FROM {silver} WHERE customer_id <> ''",
    "dim_count", "SELECT COUNT(*) FROM {dim_customer} WHERE customer_id <> ''"),
    "dim_customer", _drop("segment = 'Lost'"), "SELECT * FROM dim_customer WHERE NOT (segment = 'Lost')")
invariant(4, "dim_date_matches_stg_distinct_dates", _counts(
    "source_count", "SELECT COUNT(DISTINCT CAST(invoice_date AS DATE)) FROM {silver}",
    "dim_count", "SELECT COUNT(*) FROM {dim_date}"),
    "dim_date", _drop("day_of_week = 6"), "SELECT * FROM dim_date WHERE NOT (day_of_week = 6)")
invariant(6, "fact_guest_customer_sk", _counts(
    "source_count", "SELECT COUNT(*) FROM {silver} WHERE customer_id = ''",
    "fact_count", "SELECT COUNT(*) FROM {fact} WHERE customer_sk = 0"),
    "fact", _set("customer_sk", "customer_sk = 0 AND quantity = 13", "1"),
    _set_sql("fact", "customer_sk", "customer_sk = 0 AND quantity = 13", "1"))

_NEG = "(line_amount < 0 AND NOT COALESCE(is_cancellation, FALSE))"
_AMOUNT = f"(ABS(line_amount - quantity * price) > 0.001 OR {_NEG})"
_SIGN = ("((quantity < 0 AND NOT COALESCE(is_cancellation, FALSE)) "
         "OR (COALESCE(is_cancellation, FALSE) AND quantity >= 0))")
_FM = "transaction_sk, quantity, price, line_amount, is_cancellation"
_LM = "invoice, stock_code, quantity, price, line_amount, is_cancellation"

invariant(7, "fact_line_amount_rules", f"SELECT {_FM} FROM {{fact}} WHERE {_AMOUNT}", "fact",
          _set("line_amount", "quantity = 13", "line_amount + 1"),
          _set_sql("fact", "line_amount", "quantity = 13", "line_amount + 1"))
invariant(8, "fact_negative_line_amount_rules", f"SELECT {_FM} FROM {{fact}} WHERE {_NEG}", "fact",
          _set("line_amount", "quantity = 13", "-line_amount"),
          _set_sql("fact", "line_amount", "quantity = 13", "-line_amount"))
invariant(9, "fact_negative_price", f"SELECT {_FM} FROM {{fact}} WHERE price < 0", "fact",
          _set("price", "quantity = 13", "-price"), _set_sql("fact", "price", "quantity = 13", "-price"))
_NN = [c for c in schemas.FACT_COLUMNS if c != "is_cancellation"]
invariant(10, "fact_null_measures", f"SELECT {', '.join(_NN)} FROM {{fact}} WHERE "
          + " OR ".join(f"{c} IS NULL" for c in _NN), "fact",
          _set("product_sk", "quantity = 13", "NULL"), _set_sql("fact", "product_sk", "quantity = 13", "NULL"))
invariant(11, "fact_quantity_cancellation_consistency",
          f"SELECT transaction_sk, quantity, line_amount, is_cancellation FROM {{fact}} WHERE {_SIGN}", "fact",
          _set("is_cancellation", "quantity = 13 OR quantity = -13", "NOT is_cancellation"),
          _set_sql("fact", "is_cancellation", "quantity = 13 OR quantity = -13", "NOT is_cancellation"))
invariant(12, "features_customer_reconcile", _counts(
    "source_count", "SELECT COUNT(DISTINCT customer_id) FROM {lines} WHERE is_valid_purchase",
    "mart_count", "SELECT COUNT(*) FROM {features}"),
    "features", _drop("is_uk = 1"), "SELECT * FROM fx WHERE NOT (is_uk = 1)")
_ORPHAN = "SELECT m.customer_id FROM {%s} m WHERE NOT EXISTS (SELECT 1 FROM {dim_customer} d WHERE d.customer_id = m.customer_id)"
invariant(13, "features_customers_in_dim", _ORPHAN % "features", "dim_customer", _drop("segment = 'Lost'"),
          "SELECT * FROM dim_customer WHERE NOT (segment = 'Lost')")
_RANGES = " OR ".join(
    [f"{c} NOT IN (0, 1)" for c in schemas.BINARY_FEATURES] + [f"{c} < 0" for c in schemas.NON_NEGATIVE_FEATURES]
    + [f"{c} < 0 OR {c} > 1" for c in schemas.UNIT_INTERVAL_FEATURES]
    + [f"{c} < 0 OR {c} > {top:g}" for c, top in schemas.CAPPED_FEATURES.items()] + ["frequency < 1", "monetary <= 0"])
invariant(14, "features_value_ranges", f"SELECT customer_id FROM {{features}} WHERE {_RANGES}", "features",
          _set("cancellation_rate", "frequency = 7", "2.0e0"),
          _set_sql("fx", "cancellation_rate", "frequency = 7", "2.0e0"))


def _by_month(a: str, a_sql: str, b: str, b_sql: str, extra: str = "") -> str:
    return f"""SELECT COALESCE(x.year_month, y.year_month) AS year_month, x.{a}, y.{b}
    FROM ({a_sql}) x FULL OUTER JOIN ({b_sql}) y ON x.year_month = y.year_month
    WHERE COALESCE(x.{a}, 0) <> COALESCE(y.{b}, 0)"""


invariant(15, "kpi_active_customers_reconcile", _by_month(
    "source_customers", "SELECT year_month, CAST(COUNT(DISTINCT customer_id) AS BIGINT) AS source_customers FROM {lines} "
    "WHERE is_valid_purchase GROUP BY year_month",
    "mart_customers", "SELECT year_month, active_customers AS mart_customers FROM {kpi}"),
    "kpi", _set("active_customers", "orders > 150", "active_customers + 1"),
    _set_sql("kpi_mart", "active_customers", "orders > 150", "active_customers + 1"))
invariant(16, "kpi_bounds", """SELECT year_month FROM {kpi} WHERE revenue < 0 OR units_sold < 0 OR orders < 0
    OR active_customers < 0 OR cancelled_orders < 0 OR line_count <= 0 OR aov < 0
    OR cancellation_order_rate < 0 OR cancellation_order_rate > 1""", "kpi",
          _set("cancellation_order_rate", "orders > 150", "1.5e0"),
          _set_sql("kpi_mart", "cancellation_order_rate", "orders > 150", "1.5e0"))
invariant(17, "kpi_revenue_reconcile", _by_month(
    "source_revenue", f"SELECT year_month, {s_units('line_amount')} AS source_revenue FROM {{lines}} "
    "WHERE is_valid_purchase GROUP BY year_month",
    "mart_revenue", "SELECT year_month, revenue AS mart_revenue FROM {kpi}"),
    "kpi", _set("revenue", "orders > 150", "revenue + 0.5e0"),
    _set_sql("kpi_mart", "revenue", "orders > 150", "revenue + 0.5e0"))
invariant(18, "mart_rfm_customers_in_dim", _ORPHAN % "rfm", "dim_customer", _drop("segment = 'Lost'"),
          "SELECT * FROM dim_customer WHERE NOT (segment = 'Lost')")
invariant(19, "partition_bronze_stg_reconcile", _by_month(
    "expected_count", f"SELECT year_month, {s_count()} AS expected_count FROM (SELECT DISTINCT {BUSINESS}, year_month "
    f"FROM {{bronze}}) d WHERE {NOT_NOISE} GROUP BY year_month",
    "actual_count", f"SELECT year_month, {s_count()} AS actual_count FROM {{silver}} GROUP BY year_month"),
    "silver", _drop("year_month = '1997-05' OR (year_month = '1998-02' AND quantity = 13)"),
    "SELECT * FROM silver WHERE NOT (year_month = '1997-05' OR (year_month = '1998-02' AND quantity = 13))")
invariant(20, "partition_fact_matches_stg", _by_month(
    "stg_count", f"SELECT year_month, {s_count()} AS stg_count FROM {{silver}} GROUP BY year_month",
    "fact_count", f"SELECT strftime(d.date, '%Y-%m') AS year_month, {s_count()} AS fact_count FROM {{fact}} f "
    "JOIN {dim_date} d ON f.date_sk = d.date_sk GROUP BY 1"),
    "dim_date", _drop("day_of_week = 6 AND year = 1997"),
    "SELECT * FROM dim_date WHERE NOT (day_of_week = 6 AND year = 1997)")


def _gap(name: str, source: str) -> str:
    return f"""SELECT {name}, rfm_revenue FROM (SELECT ({source}) AS {name},
        (SELECT {s_units('monetary')} FROM {{rfm}}) AS rfm_revenue) t
    WHERE {name} > 0 AND ABS(rfm_revenue - {name}) > {name} * CAST(0.001 AS DOUBLE)"""


invariant(21, "rfm_monetary_reconcile", _gap(
    "stg_revenue", f"SELECT {s_units('line_amount')} FROM {{lines}} WHERE is_valid_purchase"),
    "rfm", _drop("segment = 'Champions'"), "SELECT * FROM rfm WHERE NOT (segment = 'Champions')")
invariant(22, "rfm_monetary_reconcile_bronze", _gap(
    "bronze_revenue", f"SELECT {s_units('quantity * price')} FROM (SELECT DISTINCT {BUSINESS} FROM {{bronze}}) d "
    f"WHERE {NOT_NOISE} AND customer_id <> '' AND NOT is_cancellation AND quantity * price > 0"),
    "rfm", _drop("segment = 'Champions'"), "SELECT * FROM rfm WHERE NOT (segment = 'Champions')")
invariant(23, "rfm_segment_covers_customer_base", f"""SELECT mart_rows, segment_total, null_segments, eligible_count FROM (
        SELECT (SELECT {s_count()} FROM {{rfm}}) AS mart_rows,
            (SELECT CAST(SUM(n) AS BIGINT) FROM (SELECT segment, COUNT(*) AS n FROM {{rfm}} GROUP BY segment) s) AS segment_total,
            (SELECT {s_count()} FROM (SELECT DISTINCT segment FROM {{rfm}} WHERE segment IS NULL) z) AS null_segments,
            (SELECT CAST(COUNT(DISTINCT customer_id) AS BIGINT) FROM {{lines}} WHERE is_valid_purchase) AS eligible_count) t
    WHERE mart_rows <> segment_total OR mart_rows <> eligible_count OR null_segments > 0""",
          "rfm", _set("segment", "segment = 'Lost'", "NULL"), _set_sql("rfm", "segment", "segment = 'Lost'", "NULL"))
invariant(24, "stg_calendar_ranges", """SELECT invoice, stock_code, invoice_date, invoice_year, invoice_month, invoice_day,
    invoice_quarter, invoice_day_of_week, invoice_week FROM {silver} WHERE invoice_month NOT BETWEEN 1 AND 12
    OR invoice_day NOT BETWEEN 1 AND 31 OR invoice_quarter NOT BETWEEN 1 AND 4
    OR invoice_day_of_week NOT BETWEEN 0 AND 6 OR invoice_week NOT BETWEEN 1 AND 53""", "silver",
          _set("invoice_day_of_week", "country = 'NATION_7'", "invoice_day_of_week + 1"),
          _set_sql("silver", "invoice_day_of_week", "country = 'NATION_7'", "invoice_day_of_week + 1"))
invariant(25, "stg_line_amount_rules", f"SELECT {_LM} FROM {{silver}} WHERE {_AMOUNT}", "silver",
          _set("line_amount", "quantity = 13", "line_amount + 1"),
          _set_sql("silver", "line_amount", "quantity = 13", "line_amount + 1"))
invariant(26, "stg_negative_qty_price_rules",
          f"SELECT invoice, stock_code, quantity, price, is_cancellation FROM {{silver}} WHERE price < 0 OR {_SIGN}",
          "silver", _set("quantity", "ABS(quantity) = 13", "-quantity"),
          _set_sql("silver", "quantity", "ABS(quantity) = 13", "-quantity"))
_GRAIN = ", ".join(R._GRAIN)
invariant(27, "stg_no_duplicate_grain", f"SELECT {_GRAIN}, {s_count()} AS duplicate_count FROM {{silver}} GROUP BY {_GRAIN} "
          "HAVING COUNT(*) > 1", "silver", lambda df: df.unionByName(df.filter("quantity = 13")),
          "SELECT * FROM silver UNION ALL SELECT * FROM silver WHERE quantity = 13")
invariant(28, "stg_non_cancel_positive_price", """SELECT invoice, stock_code, quantity, price, is_cancellation FROM {silver}
    WHERE NOT COALESCE(is_cancellation, FALSE) AND price <= 0""", "silver",
          _set("price", "quantity = 13", "0.0e0"), _set_sql("silver", "price", "quantity = 13", "0.0e0"))
invariant(29, "stg_year_month_matches_invoice_date",
          "SELECT invoice, stock_code, invoice_date, year_month FROM {silver} WHERE year_month <> strftime(invoice_date, '%Y-%m')",
          "silver", _set("year_month", "quantity = 13", "'1990-01'"),
          _set_sql("silver", "year_month", "quantity = 13", "'1990-01'"))
