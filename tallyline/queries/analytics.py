"""Business and exploration queries."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from tallyline.functions import exprs as X
from tallyline.plans import analytics as A
from tallyline.plans import features as P
from tallyline.queries.base import HOME, LAYERS, query, s_count, s_ratio, s_round, s_units

THRESHOLD = 0.55
UNIT = "CAST(ROUND({} * 10000) AS BIGINT)"


def s_mean(value: str, digits: int) -> str:
    return s_round(s_ratio(s_units(value), f"COUNT({value})"), digits)


def s_pct(part: str, whole: str, digits: int) -> str:
    return s_round(s_ratio(f"({part}) * 100", whole), digits)


# ---- segments ----------------------------------------------------------------------------------------------

query("b1_segment_summary", f"""SELECT segment, {s_count()} AS customers, {s_mean("recency_days", 1)} AS avg_recency_days,
    {s_mean("frequency", 1)} AS avg_frequency, {s_mean("monetary", 2)} AS avg_monetary,
    {s_round(s_units("monetary"), 2)} AS total_monetary,
    {s_pct(s_units("monetary"), f"(SELECT {s_units('monetary')} FROM rfm)", 1)} AS pct_revenue
    FROM rfm GROUP BY segment""")(lambda r: A.segment_summary(r.mart_rfm))
query("b5_churn_by_segment", f"""SELECT segment, {s_count()} AS total, {s_count("recency_days > 90")} AS churned,
    {s_pct(s_count("recency_days > 90"), "COUNT(*)", 1)} AS churn_rate_pct, {s_mean("monetary", 2)} AS avg_monetary
    FROM rfm GROUP BY segment""")(lambda r: A.churn_by_segment(r.mart_rfm))
query("b7_segment_distribution", f"""SELECT segment, {s_count()} AS customers,
    {s_pct("COUNT(*)", "(SELECT COUNT(*) FROM rfm)", 1)} AS pct_customers,
    {s_round("quantile_cont(monetary, 0.5)", 2)} AS median_monetary,
    {s_pct(s_units("monetary"), f"(SELECT {s_units('monetary')} FROM rfm)", 1)} AS pct_revenue
    FROM rfm GROUP BY segment""")(lambda r: A.segment_distribution(r.mart_rfm, r.scratch))
query("b7_top_segments_share", f"""SELECT {s_pct("SUM(v)", f"(SELECT {s_units('monetary')} FROM rfm)", 1)} AS top_share_pct
    FROM (SELECT CAST(SUM({UNIT.format('monetary')}) AS DOUBLE) / 10000 AS v FROM rfm GROUP BY segment ORDER BY v DESC, segment LIMIT 3) t""")(
    lambda r: A.top_segments_share(r.mart_rfm))
query("b8_score_matrix", "SELECT r_score, " + ", ".join(f"{s_count(f'f_score = {f}')} AS f{f}" for f in range(1, 6))
      + " FROM rfm GROUP BY r_score")(lambda r: A.score_matrix(r.mart_rfm))
_SURVIVAL = f"""SELECT CAST(d.days AS INTEGER) AS days, {s_count("recency_days <= days")} AS customers,
    {s_pct("COUNT(CASE WHEN recency_days <= days THEN 1 END)", "COUNT(*)", 4)} AS survival_pct
    FROM rfm CROSS JOIN (SELECT unnest(range(0, 731, 30)) AS days) d GROUP BY d.days"""
query("b11_survival_curve", _SURVIVAL)(lambda r: A.survival_curve(r.mart_rfm))
query("w10_survival_steps", _SURVIVAL)(lambda r: A.survival_curve(r.mart_rfm))

# ---- fact --------------------------------------------------------------------------------------------------

query("b2_monthly_revenue_trend", f"""SELECT d.year, d.month, CAST(COUNT(DISTINCT f.transaction_sk) AS BIGINT) AS transactions,
    CAST(COUNT(DISTINCT f.customer_sk) AS BIGINT) AS unique_customers, {s_round(s_units("line_amount"), 2)} AS revenue,
    {s_round(s_ratio(s_units("line_amount"), "COUNT(*)"), 2)} AS avg_line_value
    FROM fact f JOIN dim_date d ON f.date_sk = d.date_sk WHERE f.line_amount > 0 GROUP BY d.year, d.month""")(
    lambda r: A.monthly_revenue_trend(r.fact_transactions, r.dim_date))
query("b3_top_products", f"""SELECT stock_code, description, {s_count()} AS times_sold,
    {s_round(s_units("quantity"), 0)} AS total_quantity, {s_round(s_units("line_amount"), 2)} AS total_revenue,
    {s_pct(s_units("line_amount"), f"(SELECT {s_units('line_amount')} FROM fact WHERE line_amount > 0)", 2)} AS pct_revenue
    FROM fact f JOIN dim_product p ON f.product_sk = p.product_sk WHERE line_amount > 0
    GROUP BY stock_code, description ORDER BY SUM(line_amount) DESC, stock_code LIMIT 10""")(
    lambda r: A.top_products(r.fact_transactions, r.dim_product))
query("b4_top_countries", f"""SELECT country_name, {s_count()} AS transactions, {s_round(s_units("line_amount"), 2)} AS revenue,
    {s_pct(s_units("line_amount"), f"(SELECT {s_units('line_amount')} FROM fact WHERE line_amount > 0)", 1)} AS pct
    FROM fact f JOIN dim_country c ON f.country_sk = c.country_sk WHERE line_amount > 0
    GROUP BY country_name ORDER BY SUM(line_amount) DESC, country_name LIMIT 10""")(
    lambda r: A.top_countries(r.fact_transactions, r.dim_country))
query("b6_segment_revenue_by_quarter", f"""SELECT c.segment, d.year, d.quarter, {s_round(s_units("line_amount"), 2)} AS revenue
    FROM fact f JOIN dim_customer c ON f.customer_sk = c.customer_sk JOIN dim_date d ON f.date_sk = d.date_sk
    WHERE c.customer_sk <> 0 AND line_amount > 0 GROUP BY c.segment, d.year, d.quarter""")(
    lambda r: A.segment_revenue_by_quarter(r.fact_transactions, r.dim_customer, r.dim_date))
query("j13_largest_lines", """SELECT transaction_sk, customer_id, c.segment AS customer_segment, stock_code, description,
    country_name, d.date AS invoice_date, d.year, d.quarter, quantity, price, line_amount
    FROM fact f LEFT JOIN dim_customer c ON f.customer_sk = c.customer_sk LEFT JOIN dim_product p ON f.product_sk = p.product_sk
    LEFT JOIN dim_country y ON f.country_sk = y.country_sk LEFT JOIN dim_date d ON f.date_sk = d.date_sk
    ORDER BY line_amount DESC, transaction_sk LIMIT 15""")(
    lambda r: A.largest_lines_with_dimensions(r.fact_transactions, r.dim_customer, r.dim_product, r.dim_country, r.dim_date,
                                              r.scratch))

# ---- cohorts -----------------------------------------------------------------------------------------------

LAYERS["cohort_lines"] = """SELECT f.customer_sk, f.line_amount, strftime(c.first_seen_date, '%Y-%m') AS cohort_month,
    (year(d.date) * 12 + month(d.date)) - (year(c.first_seen_date) * 12 + month(c.first_seen_date)) AS cohort_age
    FROM fact f JOIN dim_customer c ON f.customer_sk = c.customer_sk JOIN dim_date d ON f.date_sk = d.date_sk
    WHERE f.customer_sk <> 0"""
LAYERS["cohort_cells"] = f"""SELECT cohort_month, CAST(cohort_age AS INTEGER) AS cohort_age,
    CAST(COUNT(DISTINCT customer_sk) AS BIGINT) AS n_customers, {s_units("line_amount")} AS revenue
    FROM cohort_lines GROUP BY 1, 2"""
LAYERS["cohort_sizes"] = "SELECT cohort_month, n_customers AS cohort_size FROM cohort_cells WHERE cohort_age = 0"
LAYERS["cohorts"] = f"""SELECT c.*, s.cohort_size, {s_pct("n_customers", "s.cohort_size", 4)} AS retention_pct
    FROM cohort_cells c JOIN cohort_sizes s ON c.cohort_month = s.cohort_month"""


def activity(r):
    return A.cohort_activity(r.fact_transactions, r.dim_customer, r.dim_date)


query("b9_cohort_activity", "SELECT * FROM cohorts")(activity)


def _matrix_sql(value: str) -> str:
    return f"""SELECT cohort_month, string_agg(CAST(cohort_age AS VARCHAR) || ':' || CAST(CAST(ROUND({value} * 10000) AS BIGINT) AS VARCHAR), ' ' ORDER BY cohort_age)
        AS cells FROM cohorts GROUP BY cohort_month"""


def matrix(r, value: str):
    """A row of the matrix as text: age:value, the value in ten-thousandths."""
    cell = lambda c: F.concat_ws(":", c["age"].cast("string"), F.round(c["value"] * 10000).cast("bigint").cast("string"))
    return A.cohort_cells(activity(r), value).select("cohort_month", F.array_join(F.transform("cells", cell), " ").alias("cells"))


query("b9_cohort_retention_matrix", _matrix_sql("retention_pct"))(lambda r: matrix(r, "retention_pct"))
query("b9_cohort_revenue_matrix", _matrix_sql("revenue"))(lambda r: matrix(r, "revenue"))
_CURVE = f"SELECT cohort_age, {s_count()} AS cohorts, {s_round(s_ratio(s_units('retention_pct'), 'COUNT(*)'), 4)} AS avg_retention_pct FROM cohorts"
query("b9_retention_curve", f"{_CURVE} GROUP BY cohort_age")(lambda r: A.retention_curve(activity(r)))
query("b9_retention_milestones", f"{_CURVE} WHERE cohort_age IN (1, 3, 6, 12) GROUP BY cohort_age")(
    lambda r: A.retention_milestones(activity(r)))
query("j15_cohort_lines", f"SELECT cohort_month, cohort_age, n_customers FROM cohort_cells")(
    lambda r: activity(r).select("cohort_month", "cohort_age", "n_customers"))
query("w11_cohort_retention", "SELECT cohort_month, cohort_age, cohort_size, retention_pct FROM cohorts")(
    lambda r: activity(r).select("cohort_month", "cohort_age", "cohort_size", "retention_pct"))
query("a18_pivot_cohort_customers", _matrix_sql("n_customers"))(lambda r: matrix(r, "n_customers"))
_CHURN_COHORT = f"""SELECT strftime(c.first_seen_date, '%Y-%m') AS cohort_month, {s_count()} AS total,
    {s_count("recency_days > 90")} AS churned, {s_pct(s_count("recency_days > 90"), "COUNT(*)", 1)} AS churn_rate_pct
    FROM rfm m LEFT JOIN dim_customer c ON m.customer_id = c.customer_id GROUP BY 1"""
query("b10_churn_by_cohort", _CHURN_COHORT)(lambda r: A.churn_by_cohort(r.mart_rfm, r.dim_customer))
query("j16_segment_cohorts", f"""SELECT strftime(c.first_seen_date, '%Y-%m') AS cohort_month, m.segment, {s_count()} AS customers
    FROM rfm m LEFT JOIN dim_customer c ON m.customer_id = c.customer_id GROUP BY 1, 2""")(
    lambda r: r.mart_rfm.select("customer_id", "segment").join(r.dim_customer.select(
        "customer_id", X.year_month("first_seen_date").alias("cohort_month")), "customer_id", "left").groupBy(
        "cohort_month", "segment").agg(F.count(F.lit(1)).alias("customers")))

# ---- concentration -----------------------------------------------------------------------------------------


def _ranked_sql(key: str, where: str = "TRUE") -> str:
    return f"""SELECT {key}, CAST(ROW_NUMBER() OVER (ORDER BY amount DESC, {key}) AS BIGINT) AS rank, amount,
        CAST(SUM(amount) OVER (ORDER BY amount DESC, {key} ROWS UNBOUNDED PRECEDING) AS BIGINT) AS running,
        CAST(SUM(amount) OVER () AS BIGINT) AS total, CAST(COUNT(*) OVER () AS BIGINT) AS members
        FROM (SELECT {key}, CAST(SUM({UNIT.format("(quantity * price)")}) AS BIGINT) AS amount FROM bronze WHERE {where}
              GROUP BY {key}) t WHERE amount > 0"""


for _key, _where in (("customer_id", "customer_id <> ''"), ("stock_code", "TRUE")):
    _label = {"customer_id": "customers", "stock_code": "products"}[_key]
    _sql = f"SELECT *, {s_round(s_ratio('running', 'total'), 6)} AS cum_share FROM ({_ranked_sql(_key, _where)}) q"
    query(f"b12_pareto_{_label}", _sql)(
        lambda r, k=_key, w=_where: A.pareto(r.bronze.filter(w), k, r.scratch))
    query(f"b12_{_label}_for_share", f"""SELECT CAST(p.percent AS INTEGER) AS percent,
        CAST(COUNT(CASE WHEN CAST(running AS HUGEINT) * 100 <= CAST(total AS HUGEINT) * p.percent THEN 1 END) + 1 AS BIGINT) AS members_needed,
        {s_round(s_ratio("COUNT(CASE WHEN CAST(running AS HUGEINT) * 100 <= CAST(total AS HUGEINT) * p.percent THEN 1 END) + 1", "COUNT(*)"), 4)} AS share_of_members
        FROM ({_ranked_sql(_key, _where)}) q CROSS JOIN (VALUES (50), (80)) AS p(percent) GROUP BY p.percent""")(
        lambda r, k=_key, w=_where: A.members_for_share(A.pareto(r.bronze.filter(w), k, r.scratch)))

query("l5_top_percent_share", f"""SELECT CAST(p.percent AS INTEGER) AS percent, CAST(FLOOR(MAX(n) * p.percent / 100) AS BIGINT) AS lines,
    {s_round(s_ratio("SUM(CASE WHEN rn <= FLOOR(n * p.percent / 100) THEN unit ELSE 0 END)", "SUM(unit)"), 6)} AS revenue_share
    FROM (SELECT unit, ROW_NUMBER() OVER (ORDER BY unit DESC) AS rn, COUNT(*) OVER () AS n FROM (
        SELECT {UNIT.format("line_amount")} AS unit FROM lines WHERE NOT is_cancellation) a) b
    CROSS JOIN (VALUES (1), (5), (10)) AS p(percent) GROUP BY p.percent""")(
    lambda r: A.top_percent_share(r.lines, r.scratch))
query("w6_cumulative_share_products", f"SELECT stock_code, rank, {s_round(s_ratio('running', 'total'), 6)} AS cum_share FROM ({_ranked_sql('stock_code')}) q")(
    lambda r: A.pareto(r.bronze, "stock_code", r.scratch).select("stock_code", "rank", "cum_share"))

# ---- lines -------------------------------------------------------------------------------------------------

query("b13_outlier_counts", f"""SELECT {s_count("ABS(quantity) > 1000")} AS quantity_over_1000, {s_count("price > 100")} AS price_over_100,
    {s_count("price = 0")} AS price_zero FROM bronze""")(lambda r: A.outlier_counts(r.bronze))
query("b14_cancellation_rates", f"""SELECT year_month, {s_count()} AS rows, {s_count("is_cancellation")} AS cancelled,
    {s_round(s_ratio(s_count("is_cancellation"), "COUNT(*)"), 6)} AS cancellation_rate FROM bronze GROUP BY year_month""")(
    lambda r: A.cancellation_rates(r.bronze))
query("b14_cancellation_overview", f"""SELECT {s_round(s_ratio(s_count("is_cancellation"), "COUNT(*)"), 6)} AS cancellation_rate,
    COALESCE(BOOL_AND(CASE WHEN is_cancellation THEN invoice LIKE 'C%' END), TRUE) AS all_have_prefix,
    COALESCE(BOOL_AND(CASE WHEN is_cancellation THEN quantity < 0 END), TRUE) AS all_negative FROM bronze""")(
    lambda r: A.cancellation_overview(r.bronze))
_REV = s_units("quantity * price")
query("b15_country_distribution", f"""SELECT country, {s_count()} AS rows, {_REV} AS revenue,
    {s_pct("COUNT(*)", "(SELECT COUNT(*) FROM bronze)", 4)} AS pct_rows,
    {s_pct(_REV, f"(SELECT {_REV} FROM bronze)", 4)} AS pct_revenue FROM bronze GROUP BY country""")(
    lambda r: A.country_distribution(r.bronze))
query("b15_home_share", f"""SELECT {s_pct(f"COUNT(CASE WHEN country = '{HOME}' THEN 1 END)", "COUNT(*)", 4)} AS pct_rows,
    {s_pct(s_units("quantity * price", f"country = '{HOME}'"), _REV, 4)} AS pct_revenue FROM bronze""")(
    lambda r: A.country_distribution(r.bronze).filter(F.col("country") == HOME).select("pct_rows", "pct_revenue"))
query("b16_weekday_distribution", f"""SELECT CAST(isodow(invoice_date) - 1 AS INTEGER) AS day_of_week, {s_count()} AS rows
    FROM bronze GROUP BY 1""")(lambda r: A.weekday_distribution(r.bronze))
query("b16_year_month_volume", "SELECT invoice_year, " + ", ".join(
    f"{s_count(f'invoice_month = {m}')} AS m{m}" for m in range(1, 13)) + " FROM silver GROUP BY invoice_year")(
    lambda r: A.year_month_volume(r.lines))
_STABLE = f"""SELECT COALESCE(a.year_month, b.year_month) AS year_month, bronze_rows, silver_rows, bronze_rows - silver_rows AS dropped,
    {s_round(s_ratio("bronze_rows - silver_rows", "bronze_rows"), 6)} AS drop_rate
    FROM (SELECT year_month, {s_count()} AS bronze_rows FROM bronze GROUP BY year_month) a
    FULL OUTER JOIN (SELECT year_month, {s_count()} AS silver_rows FROM silver GROUP BY year_month) b ON a.year_month = b.year_month"""
query("b17_layer_stability", _STABLE)(lambda r: A.layer_stability(r.bronze, r.lines))
query("j10_layer_outer_merge", f"SELECT year_month, bronze_rows, silver_rows FROM ({_STABLE}) s")(
    lambda r: A.layer_stability(r.bronze, r.lines).select("year_month", "bronze_rows", "silver_rows"))
LAYERS["monthly_sales"] = f"""SELECT year_month, {s_units("line_amount")} AS revenue, CAST(COUNT(DISTINCT invoice) AS BIGINT) AS n_transactions,
    CAST(COUNT(DISTINCT CASE WHEN customer_id <> '' THEN customer_id END) AS BIGINT) AS n_customers, {s_count()} AS n_rows,
    {s_round(s_ratio(s_units("line_amount"), "COUNT(DISTINCT invoice)"), 4)} AS aov FROM lines WHERE NOT is_cancellation GROUP BY year_month"""
query("b18_monthly_sales", "SELECT * FROM monthly_sales")(lambda r: A.monthly_sales(r.lines))
_BEST = """SELECT (SELECT year_month FROM monthly_sales ORDER BY revenue DESC, year_month DESC LIMIT 1) AS best_month,
    (SELECT MAX(revenue) FROM monthly_sales) AS best_revenue,
    (SELECT year_month FROM monthly_sales ORDER BY revenue, year_month LIMIT 1) AS worst_month,
    (SELECT MIN(revenue) FROM monthly_sales) AS worst_revenue"""
query("b18_best_and_worst_month", _BEST)(lambda r: A.best_and_worst_month(A.monthly_sales(r.lines)))
query("a19_arg_max_month", _BEST)(lambda r: A.best_and_worst_month(A.monthly_sales(r.lines)))
query("b19_largest_invoices", f"SELECT invoice, {s_count()} AS rows FROM bronze GROUP BY invoice ORDER BY rows DESC, invoice LIMIT 5")(
    lambda r: A.largest_invoices(r.bronze))
query("b19_missing_customer_rates", f"""SELECT year_month, {s_count()} AS rows, {s_count("customer_id = ''")} AS missing,
    {s_round(s_ratio(s_count("customer_id = ''"), "COUNT(*)"), 6)} AS missing_rate FROM bronze GROUP BY year_month""")(
    lambda r: A.missing_customer_rates(r.bronze))

_V, _C = "is_valid_purchase", "is_cancellation"
_MEASURES = f"""SELECT {s_units("line_amount", _V)} + {s_units("line_amount", _C)} AS net_revenue,
    CAST(COUNT(DISTINCT CASE WHEN {_V} THEN invoice END) AS BIGINT) AS orders,
    CAST(COUNT(DISTINCT CASE WHEN {_V} THEN customer_id END) AS BIGINT) AS active_customers,
    {s_round(s_ratio(s_units("line_amount", _V), f"COUNT(DISTINCT CASE WHEN {_V} THEN invoice END)"), 4)} AS aov,
    {s_units("quantity", _V)} AS units,
    {s_round(s_ratio(f"COUNT(DISTINCT CASE WHEN {_C} THEN invoice END)",
             f"COUNT(DISTINCT CASE WHEN {_V} THEN invoice END) + COUNT(DISTINCT CASE WHEN {_C} THEN invoice END)"), 6)} AS cancellation_rate
    FROM lines"""
query("b24_business_measures", _MEASURES)(lambda r: A.business_measures(r.rollup))
query("b24_business_measures_period", f"{_MEASURES} WHERE tx_date BETWEEN DATE '1997-01-01' AND DATE '1998-06-30'")(
    lambda r: A.business_measures(r.rollup, date(1997, 1, 1), date(1998, 6, 30)))

query("b27_rolling_churn", f"""WITH bought AS (SELECT DISTINCT customer_id, tx_date AS d FROM valid),
    month_ends AS (SELECT DISTINCT last_day(d) AS month_end FROM bought),
    bounds AS (SELECT MIN(d) AS lo, MAX(d) AS hi FROM bought),
    seen AS (SELECT e.month_end, b.customer_id, MAX(CASE WHEN b.d > e.month_end THEN 1 ELSE 0 END) AS back,
            MAX(CASE WHEN b.d <= e.month_end THEN 1 ELSE 0 END) AS before
        FROM month_ends e, bought b WHERE b.d > e.month_end - INTERVAL 90 DAY AND b.d <= e.month_end + INTERVAL 90 DAY
        GROUP BY 1, 2)
    SELECT month_end, {s_count()} AS active_customers, {s_count("back = 0")} AS churned_customers,
        {s_round(s_ratio(s_count("back = 0"), "COUNT(*)"), 6)} AS churn_rate
    FROM seen, bounds WHERE before = 1 AND month_end >= lo AND month_end + INTERVAL 90 DAY <= hi GROUP BY month_end""")(
    lambda r: A.rolling_churn(r.rollup))
query("b28_returning_revenue", f"""SELECT v.year_month, {s_units("line_amount")} AS revenue,
    {s_units("line_amount", "v.year_month > strftime(f.first_seen_date, '%Y-%m')")} AS returning_revenue,
    {s_round(s_ratio(s_units("line_amount", "v.year_month > strftime(f.first_seen_date, '%Y-%m')"), s_units("line_amount")), 6)} AS returning_share
    FROM valid v JOIN first_seen f ON v.customer_id = f.customer_id GROUP BY v.year_month""")(
    lambda r: A.returning_revenue(r.rollup, r.dim_customer))
_REF = date(2001, 9, 1)
query("b29_freshness", " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, MAX(CAST({c} AS DATE)) AS latest_date, CAST(date_diff('day', MAX(CAST({c} AS DATE)), DATE '{_REF}') AS INTEGER) AS days_behind FROM {s}"
    for n, s, c in (("bronze", "bronze", "invoice_date"), ("silver", "silver", "invoice_date"), ("dim_date", "dim_date", "date"),
                    ("dim_customer", "dim_customer", "first_seen_date"))))(
    lambda r: A.freshness(_REF, bronze=(r.bronze, "invoice_date"), silver=(r.lines, "invoice_date"),
                          dim_date=(r.dim_date, "date"), dim_customer=(r.dim_customer, "first_seen_date")))

# ---- scored customers --------------------------------------------------------------------------------------

_TIER = "CASE WHEN churn_probability >= 0.7 THEN 'High' WHEN churn_probability >= 0.4 THEN 'Medium' ELSE 'Low' END"
LAYERS["scored"] = f"""SELECT s.*, m.segment, CASE WHEN churn_probability >= {THRESHOLD} THEN 1 ELSE 0 END AS churn_flag, {_TIER} AS risk_tier
    FROM scores s LEFT JOIN (SELECT customer_id AS cid, segment FROM rfm) m ON s.customer_id = m.cid"""


def customers(r):
    return r.scores.join(r.mart_rfm.select("customer_id", "segment"), "customer_id", "left")


query("b20_overview", f"""SELECT {s_count()} AS customers, {s_round(s_ratio("SUM(churn_flag)", "COUNT(*)"), 6)} AS churn_rate,
    {s_count("risk_tier = 'High'")} AS high_risk, {s_count("risk_tier = 'Medium'")} AS medium_risk,
    {s_count("risk_tier = 'Low'")} AS low_risk, {s_units("monetary", "churn_flag = 1")} AS revenue_at_risk FROM scored""")(
    lambda r: A.overview(r.scores, THRESHOLD))
query("b21_churn_by_segment_scored", f"""SELECT segment, {s_count()} AS customers, {s_round(s_ratio("SUM(churn_flag)", "COUNT(*)"), 6)} AS churn_rate,
    {s_mean("monetary", 2)} AS avg_monetary FROM scored GROUP BY segment""")(
    lambda r: A.churn_by_group(customers(r), THRESHOLD, "segment"))
query("b21_churn_by_group", f"""SELECT is_uk, {s_count()} AS customers, {s_round(s_ratio("SUM(churn_flag)", "COUNT(*)"), 6)} AS churn_rate,
    {s_mean("monetary", 2)} AS avg_monetary FROM scored GROUP BY is_uk""")(
    lambda r: A.churn_by_group(r.scores, THRESHOLD, "is_uk"))
_CHOSEN = "risk_tier IN ('High', 'Medium') AND segment IN ('At Risk', 'Champions', 'Hibernating') AND monetary >= 500"
_FILTERS = {"tiers": ["High", "Medium"], "segments": ["At Risk", "Champions", "Hibernating"], "min_monetary": 500.0}
_RET = "customer_id, segment, churn_probability, risk_tier, recency_days, frequency, monetary"
query("p20_retention_list", f"SELECT {_RET} FROM scored WHERE {_CHOSEN} ORDER BY churn_probability DESC, customer_id")(
    lambda r: A.retention_list(customers(r), THRESHOLD, **_FILTERS).select(_RET.split(", ")))
query("p24_scoring_projection", "SELECT customer_id, churn_probability, churn_flag, risk_tier FROM scored")(
    lambda r: A.scored(r.scores, THRESHOLD).select("customer_id", "churn_probability", "churn_flag", "risk_tier"))
query("b22_retention_overview", f"""SELECT {s_count(_CHOSEN)} AS targeted, {s_units("monetary", _CHOSEN)} AS revenue_at_stake,
    {s_round(s_ratio(s_count(_CHOSEN), "COUNT(*)"), 6)} AS share_of_base FROM scored""")(
    lambda r: A.retention_overview(customers(r), THRESHOLD, **_FILTERS))
query("a17_score_histogram", f"""WITH span AS (SELECT MIN(churn_probability) AS lo, MAX(churn_probability) AS hi FROM scores)
    SELECT CAST(LEAST(FLOOR((churn_probability - lo) / ((hi - lo) / 40)), 39) AS BIGINT) AS bin, {s_count()} AS customers
    FROM scores, span GROUP BY 1""")(lambda r: A.score_histogram(r.scores))
DRIVERS = ["recency_days", "frequency", "monetary", "avg_order_value", "tenure_days", "is_one_time_buyer"]
query("b23_customer_percentiles", " UNION ALL ".join(
    f"SELECT customer_id, '{d}' AS feature, CAST({d} AS DOUBLE) AS value, CUME_DIST() OVER (ORDER BY {d}) AS percentile FROM fx"
    for d in DRIVERS))(lambda r: A.customer_percentiles(r.mart_features, DRIVERS, r.scratch))
query("b23_customer_snapshot", f"""SELECT customer_id, recency_days, frequency, monetary, avg_order_value, tenure_days,
    is_one_time_buyer = 1 AS one_time_buyer, segment, risk_tier FROM scored""")(
    lambda r: A.scored(customers(r), THRESHOLD).select(
        "customer_id", "recency_days", "frequency", "monetary", "avg_order_value", "tenure_days",
        (F.col("is_one_time_buyer") == 1).alias("one_time_buyer"), "segment", "risk_tier"))


def labelled(r):
    return r.train_features


query("b25_label_balance", f"SELECT churn, {s_count()} AS customers, {s_pct('COUNT(*)', '(SELECT COUNT(*) FROM labels_train)', 4)} AS pct "
      "FROM labels_train GROUP BY churn")(
    lambda r: A.label_balance(P.churn_labels(r.lines, P.training_cutoff(r.lines))))
_BOX = ["recency_days", "frequency", "monetary", "avg_order_value", "tenure_days"]
query("b25_label_boxplot", " UNION ALL ".join(
    f"SELECT churn, '{c}' AS feature, {s_round(f'MIN({c})', 6)} AS lowest, {s_round(f'quantile_cont({c}, 0.25)', 6)} AS p25, "
    f"{s_round(f'quantile_cont({c}, 0.5)', 6)} AS median, {s_round(f'quantile_cont({c}, 0.75)', 6)} AS p75, "
    f"{s_round(f'MAX({c})', 6)} AS highest FROM (SELECT churn, CAST({c} AS DOUBLE) AS {c} FROM fx JOIN labels_train USING (customer_id)) t "
    "GROUP BY churn" for c in _BOX))(
    lambda r: A.label_boxplot(P.mart_features(r.lines, home_country=HOME, rollup=r.rollup).join(
        P.churn_labels(r.lines, P.training_cutoff(r.lines)), "customer_id"), _BOX, r.scratch))
