"""Query registry, the per-session retail lake behind it, and the SQL text shared by all oracle queries."""

from __future__ import annotations

import hashlib
import re
import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.functions import exprs as X
from tallyline.plans import build, features, monitoring, silver
from tallyline.session import shared_root
from tallyline.sources import lake as L
from tallyline.sources import order_tables

HOME = order_tables.HOME_COUNTRY

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_ORACLES: dict[str, str] = {}
_RETAIL: dict[tuple[str, str, str], Retail] = {}
_LOCK = threading.RLock()


class Retail:
    """The layers of one input folder, written once per session and input version, then read back."""

    def __init__(self, spark: SparkSession, folder: str, root: str):
        self.spark, self.folder = spark, folder
        self.lake = lake = L.Lake(spark, root)
        self.scratch = lake.scratch
        lake.declare("bronze", lambda k: order_tables.bronze_lines(spark, folder), by_month=True, laid_out=True)
        lake.declare("silver", lambda k: silver.to_silver(k.table("bronze")), by_month=True, laid_out=True)
        build.declare_gold(lake, HOME)
        lake.declare("monitored", lambda k: monitored_scores(features.features_at(
            self.lines, [features.training_cutoff(self.lines), *monitoring.run_dates(self.lines)], home_country=HOME, rollup=self.rollup)))

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.lake.table(name)

    @property
    def lines(self) -> DataFrame:
        return silver.prepared(self.lake.table("silver"))

    @property
    def rollup(self) -> DataFrame:
        return self.lake.table("invoice_rollup")

    @property
    def scores(self) -> DataFrame:
        """Customers with a fixed pseudo probability, for operators that work on any score column."""
        return fixed_scores(self.lake.table("mart_features"))


def fixed_scores(features_df: DataFrame) -> DataFrame:
    """A probability every engine can compute: a digest of the customer id, four decimals."""
    digest = F.conv(F.substring(F.md5("customer_id"), 1, 7), 16, 10).cast("bigint")
    return features_df.withColumn("churn_probability", (digest % 10_001).cast("double") / 10_000.0)


def monitored_scores(features_df: DataFrame) -> DataFrame:
    """A probability that moves with the customer's behaviour, which every engine can compute: silence as a share of silence and rhythm."""
    silence = F.col("recency_days").cast("double")
    return features_df.withColumn("churn_probability", X.round_to(silence / (silence + F.col("avg_days_between_orders") + 1.0), 4))


def retail(spark: SparkSession, folder: str) -> Retail:
    folder = folder.rstrip("/")
    versions = "|".join(L.fingerprint(spark, f"{folder}/{t}.parquet") for t in order_tables.TABLES)
    app = spark.sparkContext.applicationId
    key = (app, folder, versions)
    with _LOCK:
        if key not in _RETAIL:
            digest = hashlib.sha256(f"{folder}|{versions}".encode()).hexdigest()[:16]
            _RETAIL[key] = Retail(spark, folder, f"{shared_root(spark)}/tallyline/{app}/{digest}")
        return _RETAIL[key]


def query(name: str, sql: str | None = None, tables: str = ""):
    """Register ``fn(retail) -> DataFrame`` under ``name``; ``sql`` is the equivalent oracle query."""
    def register(fn: Callable[[Retail], DataFrame]):
        if name in _QUERIES:
            raise ValueError(f"query {name} is registered twice")

        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(retail(spark, folder))

        run.__name__ = name
        run.__doc__ = fn.__doc__
        _QUERIES[name] = run
        if sql is not None:
            _ORACLES[name] = with_layers(sql)
        return fn
    return register


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def all_oracles() -> dict[str, str]:
    return dict(_ORACLES)


# ---- SQL pieces --------------------------------------------------------------------------------------------

def s_units(value: str, when: str | None = None) -> str:
    """SQL: sum of whole 1/10000 units, as in ``exprs.exact_sum``."""
    unit = f"CAST(ROUND({value} * 10000) AS BIGINT)"
    if when:
        unit = f"CASE WHEN {when} THEN {unit} ELSE 0 END"
    return f"(CAST(COALESCE(SUM({unit}), 0) AS DOUBLE) / CAST(10000 AS DOUBLE))"


def s_count(when: str | None = None) -> str:
    return "CAST(COUNT(*) AS BIGINT)" if when is None else f"CAST(COUNT(CASE WHEN {when} THEN 1 END) AS BIGINT)"


def s_ratio(numerator: str, denominator: str) -> str:
    return (f"(CASE WHEN ({denominator}) = 0 THEN NULL ELSE CAST({numerator} AS DOUBLE) / "
            f"CAST({denominator} AS DOUBLE) END)")


def s_div(numerator: str, denominator: str) -> str:
    return f"COALESCE({s_ratio(numerator, denominator)}, CAST(0 AS DOUBLE))"


def s_round(value: str, digits: int) -> str:
    factor = f"CAST({10 ** digits} AS DOUBLE)"
    return f"(FLOOR(CAST({value} AS DOUBLE) * {factor} + CAST(0.5 AS DOUBLE)) / {factor})"


_SEGMENT_CASE = "CASE " + " ".join(
    "WHEN " + " OR ".join(f"(r_score = {r} AND f_score = {f})" for r, f in pairs) + f" THEN '{label}'"
    for label, pairs in X.SEGMENT_PAIRS.items()) + f" ELSE '{X.DEFAULT_SEGMENT}' END"

_TOTAL_ORDER = ("tx_date, invoice, stock_code, customer_id, invoice_date, quantity, price, description, country, "
                "original_invoice_date")


def features_sql(lines: str, obs: str, gap_filter: str = "is_valid_purchase") -> dict[str, str]:
    """CTEs for the feature table over ``lines`` as of the one-row CTE ``obs``(obs_end)."""
    valid = "is_valid_purchase"
    d90 = "invoice_date >= obs_end - INTERVAL 90 DAY"
    amount, quantity = s_units("line_amount", valid), s_units("quantity", valid)
    return {
        "fx_bounds": f"""SELECT o.obs_end, make_timestamp(
                (CAST(epoch_us(MIN(CASE WHEN {valid} THEN l.invoice_date END)) AS BIGINT)
                 + CAST(epoch_us(o.obs_end) AS BIGINT)) // 2) AS middle
            FROM {lines} l, {obs} o WHERE l.invoice_date <= o.obs_end GROUP BY o.obs_end""",
        "fx_lines": f"SELECT l.*, b.* FROM {lines} l, fx_bounds b WHERE customer_id <> '' AND invoice_date <= obs_end",
        "fx_base": f"""SELECT customer_id, MAX(obs_end) AS obs_end,
                MIN(CASE WHEN {valid} THEN invoice_date END) AS first_at,
                MAX(CASE WHEN {valid} THEN invoice_date END) AS last_at,
                COUNT(DISTINCT CASE WHEN {valid} THEN invoice END) AS frequency,
                {amount} AS monetary, {quantity} AS total_quantity,
                COUNT(DISTINCT CASE WHEN {valid} THEN stock_code END) AS unique_products,
                COUNT(DISTINCT CASE WHEN {valid} AND invoice_date >= obs_end - INTERVAL 30 DAY THEN invoice END) AS f30,
                COUNT(DISTINCT CASE WHEN {valid} AND {d90} THEN invoice END) AS f90,
                COUNT(DISTINCT CASE WHEN {valid} AND invoice_date >= obs_end - INTERVAL 180 DAY THEN invoice END) AS f180,
                {s_units("line_amount", f"{valid} AND {d90}")} AS m90,
                COUNT(DISTINCT CASE WHEN {valid} AND {d90} THEN stock_code END) AS p90,
                {s_units("line_amount", f"{valid} AND invoice_date < middle")} AS half1,
                {s_units("line_amount", f"{valid} AND invoice_date >= middle")} AS half2,
                COUNT(DISTINCT invoice) AS invoices,
                COUNT(DISTINCT CASE WHEN is_cancellation THEN invoice END) AS cancelled,
                {s_units("quantity", "quantity > 0")} AS q_out, {s_units("-quantity", "quantity < 0")} AS q_back,
                MIN(country) AS country
            FROM fx_lines GROUP BY customer_id HAVING COUNT(CASE WHEN {valid} THEN 1 END) > 0""",
        "fx_dated": f"""SELECT customer_id, invoice, MIN(invoice_date) AS placed FROM fx_lines WHERE {gap_filter}
            GROUP BY customer_id, invoice""",
        "fx_gap": """SELECT customer_id, placed, epoch_us(placed)
                - LAG(epoch_us(placed)) OVER (PARTITION BY customer_id ORDER BY placed, invoice) AS gap_us
            FROM fx_dated""",
        "fx_rhythm": """SELECT customer_id,
                CAST(SUM(gap_us) AS DOUBLE) / CAST(NULLIF(COUNT(gap_us), 0) AS DOUBLE) / CAST(86400000000 AS DOUBLE) AS avg_gap,
                STDDEV_SAMP(CAST(gap_us AS DOUBLE) / CAST(86400000000 AS DOUBLE)) AS std_gap,
                CAST(COUNT(CASE WHEN isodow(placed) >= 6 THEN 1 END) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) AS weekend
            FROM fx_gap GROUP BY customer_id""",
        "fx_month": f"""SELECT customer_id, CAST((year(invoice_date) - 2000) * 12 + month(invoice_date) AS HUGEINT) AS m,
                CAST(SUM(CAST(ROUND(line_amount * 10000) AS BIGINT)) AS HUGEINT) AS amount
            FROM fx_lines WHERE {valid} GROUP BY 1, 2""",
        "fx_trend": f"""SELECT customer_id, {s_div("COUNT(*) * SUM(m * amount) - SUM(m) * SUM(amount)",
                "CAST(COUNT(*) * SUM(m * m) - SUM(m) * SUM(m) AS DOUBLE) * CAST(10000 AS DOUBLE)")} AS slope
            FROM fx_month GROUP BY customer_id""",
        "fx_order": f"""SELECT customer_id, MAX(amount) AS largest, MIN(amount) AS smallest FROM (
                SELECT customer_id, invoice, {s_units("line_amount")} AS amount FROM fx_lines WHERE {valid}
                GROUP BY customer_id, invoice) t GROUP BY customer_id""",
        "fx_wide": """SELECT b.*, CAST(date_diff('day', CAST(last_at AS DATE), CAST(obs_end AS DATE)) AS INTEGER) AS recency,
                CASE WHEN frequency = 1 THEN 1 ELSE 0 END AS once, r.avg_gap, r.std_gap, r.weekend, t.slope, o.largest,
                o.smallest
            FROM fx_base b LEFT JOIN fx_rhythm r USING (customer_id) LEFT JOIN fx_trend t USING (customer_id)
            LEFT JOIN fx_order o USING (customer_id)""",
        "fx": f"""SELECT customer_id, recency AS recency_days, CAST(frequency AS BIGINT) AS frequency, monetary,
                CAST(f30 AS BIGINT) AS frequency_last_30d, CAST(f90 AS BIGINT) AS frequency_last_90d,
                m90 AS monetary_last_90d, {s_div("monetary", "frequency")} AS avg_order_value,
                {s_div("total_quantity", "frequency")} AS avg_basket_size,
                {s_div("monetary", "total_quantity")} AS avg_unit_price, total_quantity,
                CAST(unique_products AS BIGINT) AS unique_products,
                CAST(date_diff('day', CAST(first_at AS DATE), CAST(last_at AS DATE)) AS INTEGER) AS tenure_days,
                COALESCE(avg_gap, CAST(recency AS DOUBLE)) AS avg_days_between_orders,
                COALESCE(std_gap, CAST(0 AS DOUBLE)) AS std_days_between_orders,
                CAST(date_diff('day', CAST(first_at AS DATE), CAST(obs_end AS DATE)) AS INTEGER) AS days_since_first_purchase,
                once AS is_one_time_buyer, {s_div("cancelled", "invoices")} AS cancellation_rate,
                LEAST({s_div("q_back", "q_out")}, CAST(1 AS DOUBLE)) AS return_quantity_rate,
                COALESCE(weekend, CAST(0 AS DOUBLE)) AS weekend_purchase_ratio, slope AS monetary_trend,
                largest AS max_single_order_value, smallest AS min_single_order_value,
                {s_div("f90", "frequency")} AS ratio_frequency_90d, {s_div("f180", "frequency")} AS velocity_ratio_180d,
                {s_div("m90", "monetary")} AS spending_recency_ratio,
                {s_div("f30", "f90 + 1")} AS velocity_ratio_30d_90d,
                LEAST({s_div("recency", "COALESCE(avg_gap, CAST(recency AS DOUBLE))")}, CAST(10 AS DOUBLE)) AS overdue_ratio,
                LEAST({s_div("COALESCE(std_gap, 0)", "COALESCE(avg_gap, CAST(recency AS DOUBLE))")}, CAST(5 AS DOUBLE)) AS purchase_regularity,
                recency * once AS recency_one_time, {s_div("p90", "unique_products")} AS product_diversity_trend,
                LEAST({s_div("half2", "half1 + 1")}, CAST(20 AS DOUBLE)) AS monetary_acceleration,
                CASE WHEN country = '{HOME}' THEN 1 ELSE 0 END AS is_uk
            FROM fx_wide""",
    }


# Named relations an oracle query may use; each may use the ones above it. Only those needed are put in front.
LAYERS: dict[str, str] = {
    "bronze": """SELECT CASE WHEN l.l_returnflag = 'R' AND l.l_orderkey % 3 = 0 THEN 'C' ELSE '' END
               || CAST(l.l_orderkey AS VARCHAR) AS invoice,
            CAST(l.l_partkey AS VARCHAR) AS stock_code, p.p_name AS description,
            CASE WHEN l.l_returnflag = 'R' AND l.l_orderkey % 3 = 0 THEN -l.l_quantity ELSE l.l_quantity END AS quantity,
            o.o_orderdate + (l.l_orderkey % 1440) * INTERVAL 1 MINUTE AS invoice_date,
            o.o_orderdate + (l.l_orderkey % 1440) * INTERVAL 1 MINUTE AS original_invoice_date,
            CASE WHEN l.l_discount = 0 AND l.l_tax = 0 THEN CAST(0 AS DOUBLE) ELSE p.p_retailprice END AS price,
            CASE WHEN l.l_orderkey % 5 = 0 THEN '' ELSE CAST(o.o_custkey AS VARCHAR) END AS customer_id,
            n.n_name AS country, (l.l_returnflag = 'R' AND l.l_orderkey % 3 = 0) AS is_cancellation,
            strftime(o.o_orderdate + (l.l_orderkey % 1440) * INTERVAL 1 MINUTE, '%Y-%m') AS year_month
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey
        JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN part p ON l.l_partkey = p.p_partkey
        JOIN (VALUES (1), (2)) AS r(n) ON r.n = 1 OR l.l_orderkey % 97 = 0""",
    "distinct_bronze": "SELECT DISTINCT * FROM bronze",
    "silver": """SELECT invoice, stock_code, description, quantity, price, customer_id, country, is_cancellation,
            quantity * price AS line_amount, invoice_date, original_invoice_date,
            CAST(year(invoice_date) AS INTEGER) AS invoice_year, CAST(month(invoice_date) AS INTEGER) AS invoice_month,
            CAST(day(invoice_date) AS INTEGER) AS invoice_day, CAST(quarter(invoice_date) AS INTEGER) AS invoice_quarter,
            CAST(isodow(invoice_date) - 1 AS INTEGER) AS invoice_day_of_week,
            CAST(week(invoice_date) AS INTEGER) AS invoice_week, year_month
        FROM distinct_bronze WHERE is_cancellation OR price IS NULL OR price > 0""",
    "lines": """SELECT *, CAST(invoice_date AS DATE) AS tx_date,
            (customer_id <> '' AND NOT is_cancellation AND line_amount > 0) AS is_valid_purchase FROM silver""",
    "valid": "SELECT * FROM lines WHERE is_valid_purchase",
    "kpi": f"""SELECT year_month, {s_units("line_amount", "is_valid_purchase")} AS revenue,
            {s_units("quantity", "is_valid_purchase")} AS units_sold,
            CAST(COUNT(DISTINCT CASE WHEN is_valid_purchase THEN invoice END) AS BIGINT) AS orders,
            CAST(COUNT(DISTINCT CASE WHEN is_valid_purchase THEN customer_id END) AS BIGINT) AS active_customers,
            CAST(COUNT(DISTINCT CASE WHEN is_cancellation THEN invoice END) AS BIGINT) AS cancelled_orders,
            {s_units("line_amount", "is_cancellation")} AS cancellation_value, CAST(COUNT(*) AS BIGINT) AS line_count
        FROM lines GROUP BY year_month""",
    "rfm_base": f"""SELECT customer_id,
            CAST(date_diff('day', CAST(MAX(invoice_date) AS DATE), (SELECT CAST(MAX(invoice_date) AS DATE) FROM valid)) AS INTEGER) AS recency_days,
            CAST(COUNT(DISTINCT invoice) AS BIGINT) AS frequency, {s_units("line_amount")} AS monetary
        FROM valid GROUP BY customer_id HAVING SUM(line_amount) > 0""",
    "rfm_scored": """SELECT *, CAST(NTILE(5) OVER (ORDER BY recency_days DESC, customer_id) AS INTEGER) AS r_score,
            CAST(NTILE(5) OVER (ORDER BY frequency, customer_id) AS INTEGER) AS f_score,
            CAST(NTILE(5) OVER (ORDER BY monetary, customer_id) AS INTEGER) AS m_score FROM rfm_base""",
    "rfm": f"SELECT *, {_SEGMENT_CASE} AS segment FROM rfm_scored",
    "dim_date": """SELECT ROW_NUMBER() OVER (ORDER BY date) AS date_sk, date, CAST(year(date) AS INTEGER) AS year,
            CAST(month(date) AS INTEGER) AS month, CAST(week(date) AS INTEGER) AS week,
            CAST(isodow(date) - 1 AS INTEGER) AS day_of_week, CAST(quarter(date) AS INTEGER) AS quarter
        FROM (SELECT DISTINCT tx_date AS date FROM lines) t""",
    "dim_product": """SELECT ROW_NUMBER() OVER (ORDER BY stock_code) AS product_sk, stock_code,
            MIN(description) AS description FROM lines GROUP BY stock_code""",
    "dim_country": """SELECT ROW_NUMBER() OVER (ORDER BY country_name) AS country_sk, country_name
        FROM (SELECT DISTINCT country AS country_name FROM lines) t""",
    "first_seen": """SELECT customer_id, MIN(invoice_date) AS first_seen_date FROM lines WHERE customer_id <> ''
        GROUP BY customer_id""",
    "dim_customer": """SELECT CAST(0 AS BIGINT) AS customer_sk, '' AS customer_id, CAST(NULL AS TIMESTAMP) AS first_seen_date,
            'Unknown' AS segment
        UNION ALL SELECT ROW_NUMBER() OVER (ORDER BY f.customer_id), f.customer_id, f.first_seen_date,
            COALESCE(r.segment, 'UNKNOWN') FROM first_seen f LEFT JOIN rfm r ON r.customer_id = f.customer_id""",
    "fact": f"""SELECT ROW_NUMBER() OVER (ORDER BY {_TOTAL_ORDER}) AS transaction_sk,
            COALESCE(c.customer_sk, 0) AS customer_sk, p.product_sk, y.country_sk, d.date_sk, quantity, price,
            line_amount, is_cancellation
        FROM lines l LEFT JOIN (SELECT customer_sk, customer_id AS cid FROM dim_customer) c ON l.customer_id = c.cid
        LEFT JOIN (SELECT product_sk, stock_code AS sc FROM dim_product) p ON l.stock_code = p.sc
        LEFT JOIN dim_country y ON l.country = y.country_name
        LEFT JOIN (SELECT date_sk, date FROM dim_date) d ON l.tx_date = d.date""",
    "obs_score": "SELECT MAX(invoice_date) AS obs_end FROM lines",
    "obs_train": "SELECT MAX(invoice_date) - INTERVAL 90 DAY AS obs_end FROM lines",
    **features_sql("lines", "obs_score"),
    "scores": """SELECT *, CAST(CAST('0x' || substr(md5(customer_id), 1, 7) AS BIGINT) % 10001 AS DOUBLE)
            / CAST(10000 AS DOUBLE) AS churn_probability FROM fx""",
    "labels_train": """SELECT customer_id, CASE WHEN MAX(CASE WHEN invoice_date > obs_end AND NOT is_cancellation THEN 1 ELSE 0 END) = 1
            THEN 0 ELSE 1 END AS churn FROM lines, obs_train WHERE customer_id <> '' GROUP BY customer_id
        HAVING MIN(invoice_date) <= MAX(obs_end)""",
}


def with_layers(sql: str, layers: dict[str, str] | None = None) -> str:
    """Put the layers ``sql`` mentions, directly or through other layers, in front of it as CTEs."""
    layers = layers or LAYERS
    own = set(re.findall(r"(\w+) AS \(", sql)) if sql.lstrip().upper().startswith("WITH") else set()

    def mentioned(text: str) -> set[str]:
        return {w for w in re.findall(r"(?:FROM|JOIN|,)\s+(\w+)", text) if w in layers}

    needed, todo = set(), [*(mentioned(sql) - own)]
    while todo:
        name = todo.pop()
        if name not in needed:
            needed.add(name)
            todo.extend(mentioned(layers[name]))
    if not needed:
        return sql
    ctes = ",\n".join(f"{n} AS ({layers[n]})" for n in layers if n in needed)
    body = sql.strip()
    if body.upper().startswith("WITH"):
        return f"WITH {ctes},\n{body[4:].lstrip()}"
    return f"WITH {ctes}\n{body}"
