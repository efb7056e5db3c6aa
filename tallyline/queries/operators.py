"""Single operators on whole tables: projections, filters, joins, aggregates, windows, limits, sets, sources and sinks."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import functions as F

from tallyline import schemas
from tallyline.functions import exprs as X
from tallyline.operators import checks as C
from tallyline.operators import ordering as O
from tallyline.operators import quantiles as N
from tallyline.operators.distinct import with_distinct_counts
from tallyline.operators.gaps import event_gaps
from tallyline.operators.skew import broadcast_if_small
from tallyline.plans import analytics as A
from tallyline.plans import bronze as B
from tallyline.plans import export as E
from tallyline.plans import features as P
from tallyline.plans import quality, silver, star
from tallyline.plans import scoring as S
from tallyline.queries.base import HOME, LAYERS, query, s_count, s_ratio, s_round, s_units
from tallyline.sources import lake as L
from tallyline.sources import raw_csv
from tallyline.streaming import incremental


def n(name="rows"):
    return F.count(F.lit(1)).alias(name)


BUSINESS = schemas.BUSINESS_COLUMNS
BUSINESS_SQL = ", ".join(BUSINESS)

# ---- projections and filters -------------------------------------------------------------------------------


def as_raw(bronze):
    """Bronze lines written the way the raw file has them."""
    def comma(c):
        return F.replace(F.col(c).cast("string"), F.lit("."), F.lit(","))
    values = {"Invoice": F.col("invoice"), "StockCode": F.lower("stock_code"), "Description": F.concat(F.lit(" "), "description", F.lit(" ")),
              "Quantity": comma("quantity"), "InvoiceDate": F.date_format("invoice_date", "d.M.yyyy H:mm"), "Price": comma("price"),
              "Customer ID": F.col("customer_id"), "Country": F.concat("country", F.lit(" "))}
    return bronze.select([v.alias(k) for k, v in values.items()])


query("p1_rename_columns", f"SELECT {BUSINESS_SQL} FROM bronze")(
    lambda r: r.bronze.select(BUSINESS).withColumnsRenamed({v: k for k, v in schemas.RAW_COLUMNS.items()}).withColumnsRenamed(
        schemas.RAW_COLUMNS).select(BUSINESS))
query("p2_parse_dates", "SELECT invoice, stock_code, invoice_date AS parsed FROM bronze")(
    lambda r: as_raw(r.bronze).select(F.col("Invoice").alias("invoice"), F.col("StockCode").alias("stock_code"),
                                      X.parse_day_first("InvoiceDate").alias("parsed")))
query("p3_shift_dates", f"SELECT invoice, stock_code, invoice_date + INTERVAL {raw_csv.SHIFT_DAYS} DAY AS shifted FROM bronze")(
    lambda r: r.bronze.select("invoice", "stock_code", X.shift_days("invoice_date", raw_csv.SHIFT_DAYS).alias("shifted")))
query("p3_shift_to_target", """SELECT invoice, invoice_date + date_diff('day', (SELECT MAX(CAST(invoice_date AS DATE)) FROM bronze), DATE '2026-06-10') * INTERVAL 1 DAY AS shifted FROM bronze""")(
    lambda r: r.bronze.select("invoice", X.shift_days(
        "invoice_date", raw_csv.auto_shift_days(as_raw(r.bronze), date(2026, 6, 10))).alias("shifted")))
query("p4_parse_decimals", "SELECT invoice, quantity, price FROM bronze")(
    lambda r: as_raw(r.bronze).select(F.col("Invoice").alias("invoice"), X.parse_decimal_comma("Quantity").alias("quantity"),
                                      X.parse_decimal_comma("Price").alias("price")))
query("p5_clean_text", "SELECT invoice, description, country FROM bronze")(
    lambda r: as_raw(r.bronze).select(F.col("Invoice").alias("invoice"), X.clean_text("Description").alias("description"),
                                      X.clean_text("Country").alias("country")))
query("p6_cancellation_flag", "SELECT invoice, invoice LIKE 'C%' AS is_cancellation FROM bronze")(
    lambda r: r.bronze.select("invoice", F.startswith("invoice", F.lit("C")).alias("is_cancellation")))
query("p7_unknown_description", "SELECT invoice, CASE WHEN description LIKE '%ring' THEN 'UNKNOWN' ELSE description END AS description FROM bronze")(
    lambda r: silver.clean(r.bronze.withColumn("description", F.when(F.endswith("description", F.lit("ring")), " ").otherwise(
        F.col("description")))).select("invoice", "description"))
query("p8_line_amount", "SELECT invoice, quantity * price AS line_amount FROM bronze")(
    lambda r: silver.clean(r.bronze).select("invoice", "line_amount"))
query("p9_noise_filter", f"SELECT {BUSINESS_SQL} FROM bronze WHERE is_cancellation OR price IS NULL OR price > 0")(
    lambda r: silver.drop_noise(r.bronze).select(BUSINESS))
query("p9_noise_filter_keeps_null_price", f"""SELECT invoice, stock_code, quantity FROM (SELECT *, CASE WHEN quantity = 13 THEN NULL ELSE price END AS p FROM bronze) t
    WHERE is_cancellation OR p IS NULL OR p > 0""")(
    lambda r: silver.drop_noise(r.bronze.withColumn("price", F.when(F.col("quantity") == 13, None).otherwise(F.col("price")))).select(
        "invoice", "stock_code", "quantity"))
_CAL = [c for c in [f.name for f in schemas.SILVER] if c.startswith("invoice_") and c != "invoice_date"] + ["year_month"]
query("p10_calendar_columns", f"SELECT invoice, invoice_date, {', '.join(_CAL)} FROM silver")(
    lambda r: r.lines.select("invoice", "invoice_date").withColumns(X.calendar_columns("invoice_date")))
query("p11_staging_projection", f"SELECT {', '.join(f.name for f in schemas.SILVER)} FROM silver")(lambda r: silver.staging(r.silver))
query("p12_prepared_lines", "SELECT invoice, stock_code, quantity, tx_date, is_valid_purchase FROM lines")(
    lambda r: silver.prepared(silver.to_silver(r.bronze)).select("invoice", "stock_code", "quantity", "tx_date", "is_valid_purchase"))
query("p13_valid_purchase_rows", "SELECT invoice, stock_code, customer_id, line_amount FROM valid")(
    lambda r: silver.valid_purchase_rows(r.lines).select("invoice", "stock_code", "customer_id", "line_amount"))
query("p14_dashboard_rows", "SELECT invoice, stock_code, quantity, line_amount FROM lines WHERE quantity >= 0 AND line_amount >= 0")(
    lambda r: silver.dashboard_eligible_rows(r.lines).select("invoice", "stock_code", "quantity", "line_amount"))
query("p15_segment_labels", "SELECT customer_id, r_score, f_score, segment FROM rfm")(
    lambda r: r.mart_rfm.select("customer_id", "r_score", "f_score", X.segment_label("r_score", "f_score").alias("segment")))
query("p18_safe_divide", """SELECT customer_id, COALESCE(frequency_last_90d / CAST(NULLIF(frequency_last_30d, 0) AS DOUBLE), 0) AS quotient,
    COALESCE(monetary / NULLIF(frequency_last_30d, 0), -1) AS with_default FROM fx""")(
    lambda r: r.mart_features.select("customer_id", X.safe_divide("frequency_last_90d", "frequency_last_30d").alias("quotient"),
                                     X.safe_divide("monetary", "frequency_last_30d", -1.0).alias("with_default")))
query("p19_upper_clip", "SELECT customer_id, LEAST(CAST(recency_days AS DOUBLE), 100.0e0) AS clipped FROM fx")(
    lambda r: r.mart_features.select("customer_id", X.at_most("recency_days", 100).alias("clipped")))


@query("p21_percentile_clip", """SELECT transaction_sk, line_amount FROM fact WHERE line_amount BETWEEN
    (SELECT quantile_cont(line_amount, 0.01) FROM fact) AND (SELECT quantile_cont(line_amount, 0.99) FROM fact)""")
def percentile_clip(r):
    bounds = N.exact_quantiles(r.fact_transactions, [], "line_amount", {"lo": 0.01, "hi": 0.99}, r.scratch).drop("n")
    return r.fact_transactions.select("transaction_sk", "line_amount").crossJoin(F.broadcast(bounds)).filter(
        "line_amount BETWEEN lo AND hi").drop("lo", "hi")


query("p25_log_transform", "SELECT customer_id, " + ", ".join(
    f"{s_round(f'LN(1 + GREATEST({c}, 0))', 6)} AS {c}" for c in schemas.SKEWED_FEATURES) + " FROM fx")(
    lambda r: r.mart_features.select("customer_id", *[
        X.round_to(F.log1p(F.greatest(F.col(c), F.lit(0))), 6).alias(c) for c in schemas.SKEWED_FEATURES]))

# ---- joins -------------------------------------------------------------------------------------------------


@query("j1_star_left_joins", f"""SELECT customer_sk, country_sk, date_sk, {s_count()} AS rows, {s_units("line_amount")} AS amount
    FROM fact GROUP BY 1, 2, 3""")
def star_joins(r):
    fact = star.fact_transactions(r.lines, r.dim_customer, r.dim_product, r.dim_country, r.dim_date, r.scratch, "hash")
    return fact.groupBy("customer_sk", "country_sk", "date_sk").agg(n(), X.exact_sum("line_amount").alias("amount"))


query("j2_customer_segments", "SELECT customer_id, segment FROM dim_customer")(
    lambda r: star.dim_customer(r.lines, r.mart_rfm, r.scratch).select("customer_id", "segment"))
query("j3_cross_join_parameters", """SELECT customer_id, CAST(date_diff('day', CAST(MAX(invoice_date) AS DATE), (SELECT CAST(MAX(invoice_date) AS DATE) FROM lines)) AS INTEGER) AS days_ago
    FROM lines WHERE customer_id <> '' GROUP BY customer_id""")(
    lambda r: r.rollup.filter("customer_id <> ''").groupBy("customer_id").agg(F.max("invoice_date").alias("last_seen")).crossJoin(
        F.broadcast(r.rollup.agg(F.max("invoice_date").alias("as_of")))).select(
        "customer_id", X.days_between("last_seen", "as_of").alias("days_ago")))
query("j4_feature_assembly", "SELECT customer_id, frequency, unique_products, weekend_purchase_ratio, max_single_order_value FROM fx")(
    lambda r: P.mart_features(r.lines, home_country=HOME, rollup=r.rollup).select(
        "customer_id", "frequency", "unique_products", "weekend_purchase_ratio", "max_single_order_value"))
query("j5_features_with_labels", "SELECT fx.customer_id, fx.frequency, l.churn FROM fx JOIN labels_train l ON fx.customer_id = l.customer_id")(
    lambda r: r.mart_features.join(P.churn_labels(r.lines, P.training_cutoff(r.lines)), "customer_id").select(
        "customer_id", "frequency", "churn"))


@query("j6_semi_and_anti", """SELECT m.customer_id, CASE WHEN EXISTS (SELECT 1 FROM valid v WHERE v.customer_id = m.customer_id AND v.invoice_date > TIMESTAMP '2001-01-01')
    THEN 'back' ELSE 'gone' END AS state FROM rfm m""")
def semi_and_anti(r):
    buyers = r.rollup.filter("has_valid").filter(F.col("invoice_date") > F.lit("2001-01-01").cast("timestamp_ntz")).select("customer_id").distinct()
    known = r.mart_rfm.select("customer_id")
    return known.join(buyers, "customer_id", "left_semi").withColumn("state", F.lit("back")).unionByName(
        known.join(buyers, "customer_id", "left_anti").withColumn("state", F.lit("gone")))


query("j8_anti_join", "SELECT d.customer_id FROM dim_customer d LEFT JOIN rfm m ON d.customer_id = m.customer_id WHERE m.customer_id IS NULL")(
    lambda r: r.dim_customer.select("customer_id").join(r.mart_rfm.select("customer_id"), "customer_id", "left_anti"))
query("j9_full_outer_reconcile", f"""SELECT COALESCE(a.year_month, b.year_month) AS year_month, bronze_revenue, silver_revenue FROM
    (SELECT year_month, {s_units("quantity * price")} AS bronze_revenue FROM bronze GROUP BY year_month) a FULL OUTER JOIN
    (SELECT year_month, {s_units("line_amount")} AS silver_revenue FROM silver GROUP BY year_month) b ON a.year_month = b.year_month
    WHERE COALESCE(bronze_revenue, 0) <> COALESCE(silver_revenue, 0)""")(
    lambda r: C.by_key_mismatch(
        r.bronze.groupBy("year_month").agg(X.exact_sum(F.col("quantity") * F.col("price"))),
        r.lines.groupBy("year_month").agg(X.exact_sum("line_amount")), "year_month", "bronze_revenue", "silver_revenue"))
query("j11_one_row_joins", f"""SELECT (SELECT {s_count()} FROM bronze) AS bronze_rows, (SELECT {s_count()} FROM silver) AS silver_rows,
    (SELECT {s_count()} FROM rfm) AS rfm_rows""")(
    lambda r: C.count_mismatch(bronze_rows=r.bronze.agg(n()), silver_rows=r.lines.agg(n()), rfm_rows=r.mart_rfm.agg(n())))
query("j12_exists", f"""SELECT country_name FROM dim_country c WHERE EXISTS (SELECT 1 FROM fact f WHERE f.country_sk = c.country_sk AND f.line_amount > 53500)""")(
    lambda r: r.dim_country.join(r.fact_transactions.filter("line_amount > 53500").select("country_sk").distinct(), "country_sk", "left_semi").select(
        "country_name"))
query("j14_inner_joins", f"""SELECT d.year, d.quarter, y.country_name, {s_units("line_amount")} AS revenue, CAST(COUNT(DISTINCT f.customer_sk) AS BIGINT) AS customers
    FROM fact f JOIN dim_date d ON f.date_sk = d.date_sk JOIN dim_country y ON f.country_sk = y.country_sk JOIN dim_product p ON f.product_sk = p.product_sk
    JOIN dim_customer c ON f.customer_sk = c.customer_sk WHERE line_amount > 0 GROUP BY 1, 2, 3""")(
    lambda r: r.fact_transactions.filter("line_amount > 0").groupBy("date_sk", "country_sk", "customer_sk", "product_sk").agg(
        F.sum(X.units("line_amount")).alias("amount"))
    .join(broadcast_if_small(r.dim_date.select("date_sk", "year", "quarter")), "date_sk")
    .join(broadcast_if_small(r.dim_country), "country_sk").join(r.dim_product.select("product_sk"), "product_sk", "left_semi")
    .join(r.dim_customer.select("customer_sk"), "customer_sk", "left_semi").groupBy("year", "quarter", "country_name").agg(
        X.from_units(F.sum("amount")).alias("revenue"), F.count_distinct("customer_sk").alias("customers")))
query("j18_aligned_with_default", f"""SELECT m.customer_id, COALESCE(c.cancelled, 0) AS cancelled FROM rfm m LEFT JOIN
    (SELECT customer_id, CAST(COUNT(DISTINCT invoice) AS BIGINT) AS cancelled FROM lines WHERE is_cancellation AND customer_id <> '' GROUP BY customer_id) c
    ON m.customer_id = c.customer_id""")(
    lambda r: r.mart_rfm.select("customer_id").join(
        r.rollup.filter("has_cancelled AND customer_id <> ''").select("customer_id", "invoice").distinct().groupBy("customer_id").agg(n("cancelled")),
        "customer_id", "left").withColumn("cancelled", F.coalesce("cancelled", F.lit(0).cast("bigint"))))

# ---- aggregates --------------------------------------------------------------------------------------------

query("a1_group_aggregates", f"""SELECT country, {s_count()} AS rows, {s_units("line_amount")} AS total, MIN(line_amount) AS least, MAX(line_amount) AS most,
    {s_ratio(s_units("line_amount"), "COUNT(*)")} AS mean FROM lines GROUP BY country""")(
    lambda r: r.lines.groupBy("country").agg(n(), X.exact_sum("line_amount").alias("total"), F.min("line_amount").alias("least"),
                                             F.max("line_amount").alias("most"),
                                             X.ratio(X.exact_sum("line_amount"), F.count(F.lit(1))).alias("mean")))
query("a2_count_distinct", """SELECT country, CAST(COUNT(DISTINCT invoice) AS BIGINT) AS invoices, CAST(COUNT(DISTINCT stock_code) AS BIGINT) AS products
    FROM lines GROUP BY country""")(
    lambda r: with_distinct_counts(r.lines, ["country"], [F.count(F.lit(1)).alias("_rows")], {"invoices": ("invoice", None), "products": ("stock_code", None)}).drop("_rows"))
query("a3_conditional_aggregates", f"""SELECT customer_id, {s_units("line_amount", "is_valid_purchase")} AS bought,
    {s_units("line_amount", "is_cancellation")} AS cancelled, CAST(COUNT(DISTINCT CASE WHEN is_cancellation THEN invoice END) AS BIGINT) AS cancelled_invoices
    FROM lines WHERE customer_id <> '' GROUP BY customer_id""")(
    lambda r: r.rollup.filter("customer_id <> ''").groupBy("customer_id", "invoice").agg(
        F.sum("valid_amount").alias("v"), F.sum("cancelled_amount").alias("c"), F.max("has_cancelled").alias("x")).groupBy("customer_id").agg(
        X.from_units(F.sum("v")).alias("bought"), X.from_units(F.sum("c")).alias("cancelled"), X.count_if(F.col("x")).alias("cancelled_invoices")))
query("a4_having", f"SELECT stock_code, {s_count()} AS rows FROM lines GROUP BY stock_code HAVING COUNT(*) > 35")(
    lambda r: r.lines.groupBy("stock_code").agg(n()).filter("rows > 35"))
query("a7_scalar_parameters", """SELECT MAX(invoice_date) AS obs_end, MIN(CASE WHEN is_valid_purchase THEN invoice_date END) AS first_valid FROM lines""")(
    lambda r: r.lines.agg(F.max("invoice_date").alias("obs_end"), F.min(F.when(F.col("is_valid_purchase"), F.col("invoice_date"))).alias("first_valid")))
query("a8_sample_deviation", f"SELECT stock_code, {s_round('STDDEV_SAMP(quantity)', 6)} AS deviation FROM lines GROUP BY stock_code")(
    lambda r: r.lines.groupBy("stock_code").agg(X.round_to(F.stddev_samp("quantity"), 6).alias("deviation")))
LAYERS["country_months"] = f"SELECT country, CAST((invoice_year - 2000) * 12 + invoice_month AS HUGEINT) AS m, CAST(SUM(CAST(ROUND(line_amount * 10000) AS BIGINT)) AS HUGEINT) AS a FROM lines GROUP BY 1, 2"
query("a9_regression_slope", f"""SELECT country, {s_ratio("COUNT(*) * SUM(m * a) - SUM(m) * SUM(a)", "CAST(COUNT(*) * SUM(m * m) - SUM(m) * SUM(m) AS DOUBLE) * CAST(10000 AS DOUBLE)")} AS slope
    FROM country_months GROUP BY country""")(
    lambda r: r.lines.groupBy("country", ((F.col("invoice_year") - 2000) * 12 + F.col("invoice_month")).cast("bigint").alias("m")).agg(
        F.sum(X.units("line_amount")).alias("a")).groupBy("country").agg(P.least_squares_slope(F.col("m"), F.col("a")).alias("slope")))
query("a9_builtin_slope", f"SELECT country, {s_round('regr_slope(CAST(a AS DOUBLE) / 10000, CAST(m AS DOUBLE))', 2)} AS slope FROM country_months GROUP BY country")(
    lambda r: r.lines.groupBy("country", ((F.col("invoice_year") - 2000) * 12 + F.col("invoice_month")).alias("m")).agg(
        X.exact_sum("line_amount").alias("a")).groupBy("country").agg(X.round_to(F.regr_slope("a", F.col("m").cast("double")), 2).alias("slope")))
query("a10_two_level_aggregate", f"""SELECT customer_id, MAX(v) AS largest, MIN(v) AS smallest, MIN(first_at) AS first_at FROM (
    SELECT customer_id, invoice, {s_units("line_amount")} AS v, MIN(invoice_date) AS first_at FROM valid GROUP BY 1, 2) t GROUP BY customer_id""")(
    lambda r: r.rollup.filter("has_valid").groupBy("customer_id", "invoice").agg(
        F.sum("valid_amount").alias("v"), F.min("invoice_date").alias("at")).groupBy("customer_id").agg(
        X.from_units(F.max("v")).alias("largest"), X.from_units(F.min("v")).alias("smallest"), F.min("at").alias("first_at")))
query("a11_representative_value", "SELECT stock_code, MIN(description) AS description, MIN(country) AS country FROM lines GROUP BY stock_code")(
    lambda r: r.lines.groupBy("stock_code").agg(F.min("description").alias("description"), F.min("country").alias("country")))
_QS = {"p01": 0.01, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p90": 0.9, "p99": 0.99}
query("a12_quantiles", " UNION ALL ".join(
    f"SELECT '{c}' AS feature, " + ", ".join(f"{s_round(f'quantile_cont({c}, {q})', 6)} AS {k}" for k, q in _QS.items()) + " FROM lines"
    for c in quality.MEASURES))(
    lambda r: N.exact_quantiles(N.long_values(r.lines, quality.MEASURES), ["feature"], "value", _QS, r.scratch).select(
        "feature", *[X.round_to(k, 6).alias(k) for k in _QS]))
query("a13_describe", " UNION ALL ".join(
    f"SELECT is_cancellation, '{c}' AS feature, {s_count()} AS count, {s_round(f'AVG({c})', 4)} AS mean, {s_round(f'STDDEV_SAMP({c})', 4)} AS std, "
    f"MIN({c}) AS min, {s_round(f'quantile_cont({c}, 0.25)', 4)} AS p25, {s_round(f'quantile_cont({c}, 0.5)', 4)} AS p50, "
    f"{s_round(f'quantile_cont({c}, 0.75)', 4)} AS p75, MAX({c}) AS max FROM lines GROUP BY is_cancellation" for c in quality.MEASURES))(
    lambda r: N.describe(r.lines, quality.MEASURES, r.scratch, ("is_cancellation",)).select(
        "is_cancellation", "feature", "count", "min", "max", *[X.round_to(c, 4).alias(c) for c in ("mean", "std", "p25", "p50", "p75")]))


def skewness(column):
    """Bias-corrected skewness from Spark's population one."""
    size = F.count(column).cast("double")
    return F.skewness(column) * F.try_divide(F.sqrt(size * (size - 1)), size - 2)


query("a14_skewness", "SELECT " + ", ".join(f"{s_round(f'skewness({c})', 5)} AS {c}" for c in quality.MEASURES) + " FROM lines")(
    lambda r: r.lines.agg(*[X.round_to(skewness(c), 5).alias(c) for c in quality.MEASURES]))
_CORR = ["quantity", "price", "line_amount", "invoice_year", "invoice_month", "invoice_quarter", "invoice_day_of_week", "invoice_week"]
_PAIRS = [(a, b) for i, a in enumerate(_CORR) for b in _CORR[i + 1:]]


def correlations(df):
    """All pairs in one pass."""
    one = df.agg(*[F.corr(a, b).alias(f"c{i}") for i, (a, b) in enumerate(_PAIRS)])
    rows = F.array(*[F.struct(F.lit(a).alias("left_column"), F.lit(b).alias("right_column"), F.col(f"c{i}").alias("r"))
                     for i, (a, b) in enumerate(_PAIRS)])
    return one.select(F.inline(rows)).select("left_column", "right_column", X.round_to("r", 6).alias("r"), (F.abs("r") > 0.7).alias("strong"))


query("a15_correlations", " UNION ALL ".join(
    f"SELECT '{a}' AS left_column, '{b}' AS right_column, {s_round(f'corr({a}, {b})', 6)} AS r, ABS(corr({a}, {b})) > 0.7 AS strong FROM lines WHERE NOT is_cancellation"
    for a, b in _PAIRS))(lambda r: correlations(r.lines.filter("NOT is_cancellation")))
query("a20_sum_of_counts", f"SELECT CAST(SUM(c) AS BIGINT) AS total, CAST(COUNT(*) AS BIGINT) AS segments FROM (SELECT segment, COUNT(*) AS c FROM rfm GROUP BY segment) t")(
    lambda r: r.mart_rfm.groupBy("segment").agg(n("c")).agg(F.sum("c").alias("total"), n("segments")))
query("a22_distinct_members", "SELECT DISTINCT country FROM lines")(lambda r: r.lines.select("country").distinct())

# ---- windows -----------------------------------------------------------------------------------------------

query("w1_dense_keys", "SELECT ROW_NUMBER() OVER (ORDER BY stock_code) AS sk, stock_code FROM (SELECT DISTINCT stock_code FROM lines) t")(
    lambda r: O.global_row_number(r.lines.select("stock_code").distinct(), ["stock_code"], r.scratch, "sk").select("sk", "stock_code"))
query("w2_reserved_key", "SELECT customer_sk, customer_id FROM dim_customer")(
    lambda r: star.dim_customer(r.lines, None, r.scratch).select("customer_sk", "customer_id"))
query("w3_quintiles", "SELECT customer_id, CAST(NTILE(5) OVER (ORDER BY frequency, customer_id) AS INTEGER) AS quintile, CAST(NTILE(7) OVER (ORDER BY monetary DESC, customer_id) AS INTEGER) AS septile FROM rfm")(
    lambda r: O.global_ntile(O.global_ntile(r.mart_rfm.select("customer_id", "frequency", "monetary"), ["frequency", "customer_id"], 5, r.scratch, "quintile"),
                             [F.desc("monetary"), F.asc("customer_id")], 7, r.scratch, "septile").select("customer_id", "quintile", "septile"))
query("w4_order_gaps", """SELECT customer_id, gap_us FROM (SELECT customer_id, epoch_us(placed) - LAG(epoch_us(placed)) OVER (PARTITION BY customer_id ORDER BY placed, invoice) AS gap_us
    FROM (SELECT customer_id, invoice, MIN(invoice_date) AS placed FROM valid GROUP BY 1, 2) a) b WHERE gap_us IS NOT NULL""")(
    lambda r: event_gaps(r.rollup.filter("has_valid").groupBy("customer_id", "invoice").agg(F.min("invoice_date").alias("at")), "customer_id", "at", "invoice").drop("at"))
_LINES_TOTAL = f"(SELECT {s_units('line_amount')} FROM lines)"
query("w5_percent_of_total", f"SELECT country, {s_round(s_ratio(s_units('line_amount') + ' * 100', _LINES_TOTAL), 4)} AS pct FROM lines GROUP BY country")(
    lambda r: A.with_total(r.lines.groupBy("country").agg(F.sum(X.units("line_amount")).alias("amount")), "amount").select(
        "country", X.round_to(X.ratio(X.from_units("amount") * 100, X.from_units("grand_total")), 4).alias("pct")))
query("w8_first_rank_quintile", "SELECT customer_id, CAST(NTILE(5) OVER (ORDER BY recency_days DESC, customer_id) AS INTEGER) AS r_score FROM rfm")(
    lambda r: O.global_ntile(r.mart_rfm.select("customer_id", "recency_days"), [F.desc("recency_days"), F.asc("customer_id")], 5, r.scratch, "r_score").select(
        "customer_id", "r_score"))
query("w9_cumulative_distribution", "SELECT customer_id, CUME_DIST() OVER (ORDER BY frequency) AS share FROM rfm")(
    lambda r: O.global_cume_dist(r.mart_rfm.select("customer_id", "frequency"), "frequency", r.scratch, "share").select("customer_id", "share"))
query("w6_cumulative_share_customers", f"""SELECT customer_id, {s_round(s_ratio("SUM(a) OVER (ORDER BY a DESC, customer_id ROWS UNBOUNDED PRECEDING)", "SUM(a) OVER ()"), 6)} AS cum_share
    FROM (SELECT customer_id, SUM(CAST(ROUND(quantity * price * 10000) AS BIGINT)) AS a FROM bronze WHERE customer_id <> '' GROUP BY customer_id) t WHERE a > 0""")(
    lambda r: A.pareto(r.bronze.filter("customer_id <> ''"), "customer_id", r.scratch).select("customer_id", "cum_share"))

# ---- limits and sets ---------------------------------------------------------------------------------------

query("l1_top_customers", "SELECT customer_id, monetary FROM rfm ORDER BY monetary DESC, customer_id LIMIT 10")(
    lambda r: r.mart_rfm.select("customer_id", "monetary").orderBy(F.desc("monetary"), "customer_id").limit(10))
_TOPL = "invoice, stock_code, quantity, price, line_amount, country"
query("l2_largest_lines", f"SELECT {_TOPL} FROM lines WHERE NOT is_cancellation ORDER BY line_amount DESC, invoice, stock_code, quantity LIMIT 20")(
    lambda r: r.lines.filter("NOT is_cancellation").select(_TOPL.split(", ")).orderBy(
        F.desc("line_amount"), "invoice", "stock_code", "quantity").limit(20))
query("l4_newest_first_months", "SELECT DISTINCT year_month FROM silver ORDER BY year_month DESC")(
    lambda r: r.spark.createDataFrame([(m,) for m in L.list_months(r.spark, r.lake.path("silver"))] if r.silver is not None else [], "year_month string"))
query("u1_union_unknown_member", "SELECT customer_id, first_seen_date FROM dim_customer")(
    lambda r: star.dim_customer(r.lines, None, r.scratch).select("customer_id", "first_seen_date"))
query("u2_append_partitions", f"SELECT year_month, {s_count()} AS rows FROM silver GROUP BY year_month")(
    lambda r: r.lines.filter("year_month < '1998-01'").unionByName(r.lines.filter("year_month >= '1998-01'")).groupBy("year_month").agg(n()))
query("u3_set_difference", "SELECT customer_id FROM first_seen EXCEPT SELECT customer_id FROM rfm WHERE frequency > 3")(
    lambda r: r.dim_customer.filter("customer_sk <> 0").select("customer_id").exceptAll(r.mart_rfm.filter("frequency > 3").select("customer_id")))
query("u5_union_of_keys", f"""SELECT COALESCE(a.year_month, b.year_month) AS year_month, COALESCE(x, 0) AS purchases, COALESCE(y, 0) AS returns FROM
    (SELECT year_month, {s_count()} AS x FROM lines WHERE is_valid_purchase AND invoice_month > 3 GROUP BY year_month) a FULL OUTER JOIN
    (SELECT year_month, {s_count()} AS y FROM lines WHERE is_cancellation AND invoice_month < 10 GROUP BY year_month) b ON a.year_month = b.year_month""")(
    lambda r: r.lines.filter("is_valid_purchase AND invoice_month > 3").groupBy("year_month").agg(n("purchases")).join(
        r.lines.filter("is_cancellation AND invoice_month < 10").groupBy("year_month").agg(n("returns")), "year_month", "full_outer").select(
        "year_month", F.coalesce("purchases", F.lit(0).cast("bigint")).alias("purchases"), F.coalesce("returns", F.lit(0).cast("bigint")).alias("returns")))

# ---- sources and sinks -------------------------------------------------------------------------------------


def raw_file(r):
    """The bronze lines as a raw file in the lake, written once."""
    path = r.lake.path("raw_text")
    if not L.is_complete(r.spark, path):
        (as_raw(r.bronze).write.mode("overwrite").option("sep", ";").option("header", True).option("encoding", "ISO-8859-1")
         .option("quote", '"').option("escape", '"').csv(path))
    return path


query("s1_raw_file_scan", f"SELECT {BUSINESS_SQL} FROM bronze")(
    lambda r: raw_csv.normalize(raw_csv.read_raw(r.spark, raw_file(r)), 0).select(BUSINESS))
query("s2_dates_only_scan", f"SELECT CAST(invoice_date AS DATE) AS day, {s_count()} AS rows FROM bronze GROUP BY 1")(
    lambda r: raw_csv.read_raw(r.spark, raw_file(r)).select(F.to_date(X.parse_day_first("InvoiceDate")).alias("day")).groupBy("day").agg(n()))


def _fresh(r, name):
    return f"{r.lake.root}/{name}-{uuid.uuid4().hex}"


@query("s4_write_month_partition", "SELECT year_month, CAST(COUNT(*) AS BIGINT) AS rows FROM bronze WHERE year_month IN ('1996-03', '1996-04') GROUP BY year_month")
def write_partition(r):
    """Two months written twice: the second write replaces just its own month."""
    path = _fresh(r, "bronze_months")
    two = r.bronze.filter("year_month IN ('1996-03', '1996-04')")
    L.write_months(two, path)
    L.write_months(two.filter("year_month = '1996-04'"), path)
    return r.spark.read.parquet(path).groupBy(F.col("year_month").cast("string").alias("year_month")).agg(n())


@query("s5_ingest_one_month", f"SELECT {BUSINESS_SQL} FROM bronze WHERE year_month = '1997-06'")
def ingest_month(r):
    path = _fresh(r, "bronze_one")
    B.ingest(r.spark, raw_file(r), path, "1997-06", 0)
    B.ingest(r.spark, raw_file(r), path, "1997-06", 0)
    return B.read_month(r.spark, path, "1997-06").select(BUSINESS)


@query("s6_ingest_all_months", f"""SELECT year_month, {s_count()} AS row_count, {s_count("is_cancellation")} AS cancellation_count FROM bronze GROUP BY year_month""")
def ingest_everything(r):
    """One month first, then all: the audit has one row per month and every month is there once."""
    path = _fresh(r, "bronze_all")
    B.ingest(r.spark, raw_file(r), path, "1997-06", 0)
    B.ingest_all(r.spark, raw_file(r), path, 0)
    return r.spark.read.parquet(f"{path}/{B.AUDIT_FOLDER}").select("year_month", "row_count", "cancellation_count")


query("s7_missing_partitions", "SELECT DISTINCT year_month FROM bronze WHERE year_month NOT IN (SELECT DISTINCT year_month FROM silver WHERE invoice_year < 2000)")(
    lambda r: r.bronze.select("year_month").distinct().join(r.lines.filter("invoice_year < 2000").select("year_month").distinct(), "year_month", "left_anti"))
query("s9_read_bronze_month", f"SELECT {BUSINESS_SQL} FROM bronze WHERE year_month = '1999-11'")(
    lambda r: r.bronze.filter("year_month = '1999-11'").select(BUSINESS))
query("s10_read_all_silver", f"SELECT year_month, invoice_year, {s_count()} AS rows, {s_units('line_amount')} AS amount FROM silver GROUP BY 1, 2")(
    lambda r: silver.read_silver(r.spark, _silver_path(r)).groupBy("year_month", "invoice_year").agg(n(), X.exact_sum("line_amount").alias("amount")))


def _silver_path(r):
    r.silver
    return r.lake.path("silver")


query("s11_pruned_glob_scan", f"SELECT year_month, {s_count()} AS rows FROM silver WHERE year_month BETWEEN '1996-01' AND '1996-12' GROUP BY year_month")(
    lambda r: r.spark.read.parquet(_silver_path(r)).filter("year_month BETWEEN '1996-01' AND '1996-12'").groupBy("year_month").agg(n()))


@query("s13_transform_all_months", f"SELECT year_month, {s_count()} AS rows, {s_units('line_amount')} AS amount FROM silver GROUP BY year_month")
def transform_everything(r):
    r.bronze
    path = _fresh(r, "silver_all")
    silver.transform_month(r.spark, r.lake.path("bronze"), path, "1997-06")
    silver.transform_all(r.spark, r.lake.path("bronze"), path)
    return silver.read_silver(r.spark, path).groupBy("year_month").agg(n(), X.exact_sum("line_amount").alias("amount"))


query("s16_build_log", " UNION ALL ".join(
    f"SELECT '{m}' AS measure, {s_count()} AS value FROM {t}" for m, t in (
        ("silver_rows", "silver"), ("fact_transactions_rows", "fact"), ("mart_rfm_customers", "rfm"), ("dim_customer_rows", "dim_customer"),
        ("dim_product_rows", "dim_product"), ("dim_country_rows", "dim_country"), ("dim_date_rows", "dim_date")))
      + f" UNION ALL SELECT 'fact_null_customer_sk', {s_count('customer_sk IS NULL')} FROM fact UNION ALL SELECT 'segment: ' || segment, {s_count()} FROM rfm GROUP BY segment")(
    lambda r: E.build_log(r.lines, r.fact_transactions, r.mart_rfm, dim_customer=r.dim_customer, dim_product=r.dim_product,
                          dim_country=r.dim_country, dim_date=r.dim_date))
query("s17_view_and_table", "SELECT segment, CAST(COUNT(*) AS BIGINT) AS customers FROM rfm GROUP BY segment")(
    lambda r: E.publish_or_view(E.publish_or_view(r.mart_rfm, "rfm_view"), "rfm_table", _fresh(r, "rfm_table")).groupBy("segment").agg(n("customers")))


@query("s18_bi_export", f"""SELECT 'dim_customer' AS table_name, 'exported' AS status, {s_count()} AS rows FROM dim_customer
    UNION ALL SELECT 'fact_transactions', 'exported', {s_count()} FROM fact UNION ALL SELECT 'mart_rfm', 'exported', {s_count()} FROM rfm
    UNION ALL SELECT 'mart_features', 'excluded', CAST(NULL AS BIGINT) UNION ALL SELECT 'mart_churn_scores', 'missing', CAST(NULL AS BIGINT)""")
def bi_export(r):
    for table in ("dim_customer", "fact_transactions", "mart_rfm", "mart_features"):
        getattr(r, table)
    return E.export_for_bi(r.spark, r.lake.root, _fresh(r, "bi"), "csv").filter(F.col("table_name").isin(
        "dim_customer", "fact_transactions", "mart_rfm", "mart_features", "mart_churn_scores"))


@query("s19_retention_round_trip", "SELECT customer_id, segment, churn_probability, risk_tier, recency_days, frequency, monetary FROM scored WHERE risk_tier = 'High'")
def retention_round_trip(r):
    from tallyline.queries.analytics import THRESHOLD, customers
    path = _fresh(r, "retention")
    E.export_retention_list(A.retention_list(customers(r), THRESHOLD), path)
    return E.read_retention_list(r.spark, path)


@query("s20_publish_scores", "SELECT customer_id, churn_probability, churn_flag, risk_tier FROM scored")
def publish_scores(r):
    from tallyline.plans import scoring as S
    from tallyline.queries.analytics import THRESHOLD
    path = _fresh(r, "scores")
    E.publish(S.score(r.scores, THRESHOLD), path)
    return r.spark.read.parquet(path)


query("s24_sample_rows")(lambda r: E.sample_rows(r.lines, 0.1).select("invoice", "stock_code", "line_amount"))
_GOLD = {
    "dim_date": "dim_date", "dim_product": "dim_product", "dim_country": "dim_country", "dim_customer": "dim_customer",
    "fact_transactions": "fact", "mart_rfm": "rfm", "mart_kpi_monthly": "kpi", "mart_features": "fx", "mart_churn_scores": "scores"}
_GOLD_COLUMNS = {
    "dim_date": "date_sk, date, year, month, week, day_of_week, quarter", "dim_product": "product_sk, stock_code, description",
    "dim_country": "country_sk, country_name", "dim_customer": "customer_sk, customer_id, first_seen_date, segment",
    "fact_transactions": ", ".join(schemas.FACT_COLUMNS),
    "mart_rfm": "customer_id, recency_days, frequency, monetary, r_score, f_score, m_score, segment",
    "mart_kpi_monthly": "year_month, revenue, units_sold, orders, active_customers, aov, cancelled_orders, cancellation_value, net_revenue, "
                        "cancellation_order_rate, line_count",
    "mart_features": ", ".join(["customer_id", *schemas.FEATURE_COLUMNS]), "mart_churn_scores": ", ".join(schemas.SCORING_COLUMNS)}
query("s25_table_catalogue", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, {s_count()} AS rows, CAST({_GOLD_COLUMNS[t].count(',') + 1} AS INTEGER) AS columns, '{_GOLD_COLUMNS[t]}' AS column_list FROM {src}"
    for t, src in _GOLD.items()))(
    lambda r: E.table_catalogue(**{t: getattr(r, t) for t in _GOLD if t != "mart_churn_scores"}, mart_churn_scores=S.score(r.scores, 0.5)))

# ---- incremental loading -----------------------------------------------------------------------------------


@query("x1_stream_ingest", f"SELECT year_month, {s_count()} AS rows, {s_units('line_amount')} AS amount FROM silver GROUP BY year_month")
def stream_ingest(r):
    base = _fresh(r, "stream")
    incremental.stream_ingest(r.spark, raw_file(r), f"{base}/bronze", f"{base}/silver", f"{base}/checkpoint", 0).awaitTermination()
    return silver.read_silver(r.spark, f"{base}/silver").groupBy("year_month").agg(n(), X.exact_sum("line_amount").alias("amount"))


def _line_stream(r, table):
    df = getattr(r, table)
    return r.spark.readStream.schema(df.schema).parquet(r.lake.path(table))


@query("x2_stream_kpi", f"""SELECT CAST(window_start AS TIMESTAMP) AS window_start, {s_units("line_amount")} AS revenue, {s_count()} AS lines FROM (
        SELECT *, TIMESTAMP '1970-01-01' + CAST(FLOOR(epoch_us(invoice_date) / 604800000000.0) AS BIGINT) * INTERVAL 7 DAY AS window_start FROM valid) t
    WHERE window_start + INTERVAL 7 DAY <= (SELECT MAX(invoice_date) FROM valid) - INTERVAL 1 DAY GROUP BY window_start""")
def stream_kpi(r):
    base = _fresh(r, "stream_kpi")
    incremental.run_to_table(incremental.stream_kpi(_line_stream(r, "silver")), f"{base}/out", f"{base}/checkpoint")
    return r.spark.read.parquet(f"{base}/out").select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "revenue", "lines")


@query("x3_stream_dedup", f"SELECT DISTINCT {BUSINESS_SQL} FROM bronze")
def stream_dedup(r):
    base = _fresh(r, "stream_dedup")
    incremental.run_to_table(incremental.stream_dedup(_line_stream(r, "bronze")).select(BUSINESS), f"{base}/out", f"{base}/checkpoint")
    return r.spark.read.parquet(f"{base}/out")
