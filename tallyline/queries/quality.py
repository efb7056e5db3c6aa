"""Data-quality metrics, layer reconciliation and the sources' audit tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyline import schemas
from tallyline.functions import exprs as X
from tallyline.operators import checks as C
from tallyline.plans import bronze as B
from tallyline.plans import quality as Q
from tallyline.plans import reconcile as R
from tallyline.queries.base import LAYERS, query, s_count, s_ratio, s_round, s_units
from tallyline.queries.reconcile import INVARIANT_SQL, Built

SILVER_COLUMNS = [f.name for f in schemas.SILVER]
TEXTS = [f.name for f in schemas.SILVER if f.dataType.simpleString() == "string"]
BUSINESS = ", ".join(schemas.BUSINESS_COLUMNS)


def s_rate(part: str, whole: str, digits: int = 4) -> str:
    return s_round(s_ratio(part, f"GREATEST({whole}, 1)"), digits)


# ---- completeness, uniqueness, consistency, ranges, time ----------------------------------------------------

def completeness_sql(keys: str = "") -> str:
    group = f" GROUP BY {keys}" if keys else ""
    lead = f"{keys}, " if keys else ""
    parts = []
    for c in SILVER_COLUMNS:
        if c == keys:
            continue
        empty = space = "CAST(NULL AS DOUBLE)"
        if c in TEXTS:
            blank = f"trim(COALESCE({c}, '')) = ''"
            empty = s_rate(s_count(blank), "COUNT(*)")
            space = s_rate(s_count(f"{blank} AND COALESCE({c}, '') <> ''"), "COUNT(*)")
        nulls = s_count(f"{c} IS NULL")
        parts.append(f"SELECT {lead}{s_count()} AS total_rows, '{c}' AS column_name, {nulls} AS null_count, "
                     f"{s_rate(nulls, 'COUNT(*)')} AS null_rate, {empty} AS empty_string_rate, "
                     f"{space} AS whitespace_only_rate FROM silver{group}")
    return " UNION ALL ".join(parts)


query("q1_completeness", completeness_sql())(lambda r: Q.completeness(r.lines.select(SILVER_COLUMNS)))
query("a21_null_rates_bronze", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, {s_count(f'{c} IS NULL')} AS null_count FROM bronze"
    for c in schemas.BUSINESS_COLUMNS))(
    lambda r: Q.completeness(r.bronze.select(schemas.BUSINESS_COLUMNS)).select("column_name", "null_count"))

_UNIQUE = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST(COUNT(DISTINCT {c}) AS BIGINT) AS n_unique, "
    f"{s_rate(f'COUNT(DISTINCT {c})', f'COUNT({c})')} AS unique_rate, "
    f"{s_round('CAST(1 AS DOUBLE) - ' + s_ratio(f'COUNT(DISTINCT {c})', f'COUNT({c})'), 4)} AS duplicate_rate FROM silver"
    for c in schemas.KEY_COLUMNS)
query("q2_uniqueness", _UNIQUE)(lambda r: Q.uniqueness(r.lines))

_TOP = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, value, rows, rank FROM (SELECT {c} AS value, {s_count()} AS rows, "
    f"CAST(ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, {c}) AS INTEGER) AS rank FROM silver GROUP BY {c}) t WHERE rank <= 5"
    for c in schemas.KEY_COLUMNS)
query("q2_top_values", _TOP)(lambda r: Q.top_values(r.lines))
query("a16_value_counts_country", f"""SELECT country, {s_count()} AS rows FROM lines GROUP BY country
    ORDER BY rows DESC, country LIMIT 5""")(
    lambda r: r.lines.groupBy("country").agg(F.count(F.lit(1)).alias("rows")).orderBy(F.desc("rows"), "country").limit(5))

CONSISTENCY = {
    "quantity_negative_not_cancellation": "quantity < 0 AND NOT is_cancellation",
    "cancellation_positive_quantity": "is_cancellation AND NOT quantity < 0",
    "price_negative_count": "price < 0",
    "line_amount_mismatch_count": "ABS(line_amount - quantity * price) > 0.01",
    "cancellation_flag_mismatch": "(invoice LIKE 'C%') <> is_cancellation",
}
_CONS = ", ".join(f"{s_count(c)} AS {n}" for n, c in CONSISTENCY.items())
query("q3_consistency", f"SELECT {_CONS} FROM silver")(lambda r: Q.consistency(r.lines))


def flip(df):
    """Silver with wrong flags and amounts planted, to show the counts move."""
    return df.withColumns({
        "is_cancellation": F.when(F.abs("quantity") == 13, ~F.col("is_cancellation")).otherwise(F.col("is_cancellation")),
        "line_amount": F.when(F.abs("quantity") == 17, F.col("line_amount") + 1).otherwise(F.col("line_amount")),
    })


_FLIPPED = """SELECT * REPLACE (CASE WHEN ABS(quantity) = 13 THEN NOT is_cancellation ELSE is_cancellation END AS is_cancellation,
    CASE WHEN ABS(quantity) = 17 THEN line_amount + 1 ELSE line_amount END AS line_amount) FROM silver"""
query("q3_consistency_seeded", f"WITH flipped AS ({_FLIPPED}) SELECT {_CONS} FROM flipped")(
    lambda r: Q.consistency(flip(r.lines)))

_RANGE_LIST = []
for _m in Q.MEASURES:
    _RANGE_LIST += [f"MIN({_m}) AS {_m}_min", f"MAX({_m}) AS {_m}_max",
                    f"{s_round(s_ratio(s_units(_m), f'COUNT({_m})'), 4)} AS {_m}_mean",
                    f"{s_count(f'{_m} = 0')} AS {_m}_zero_count"]
_RANGE_LIST.append(f"{s_count('quantity < 0')} AS quantity_negative_count")
query("q4_value_ranges", f"SELECT {', '.join(_RANGE_LIST)} FROM silver")(lambda r: Q.value_ranges(r.lines))

LAYERS["month_numbers"] = "SELECT DISTINCT year(invoice_date) * 12 + month(invoice_date) AS m FROM silver"
LAYERS["holes"] = "SELECT m, m - LAG(m) OVER (ORDER BY m) - 1 AS missing_before FROM month_numbers"
_TEMPORAL = """SELECT MIN(invoice_date) AS date_min, MAX(invoice_date) AS date_max,
    CAST(FLOOR((epoch_us(MAX(invoice_date)) - epoch_us(MIN(invoice_date))) / 86400000000) AS BIGINT) AS date_range_days,
    CAST((SELECT COUNT(*) FROM month_numbers) AS BIGINT) AS unique_months,
    CAST((SELECT COALESCE(SUM(missing_before), 0) FROM holes WHERE missing_before > 0) AS BIGINT) AS month_gaps FROM silver"""
query("q5_temporal", _TEMPORAL)(lambda r: Q.temporal(r.lines))
query("w7_month_gaps", """WITH kept AS (SELECT * FROM silver WHERE invoice_quarter <> 2),
    kept_months AS (SELECT DISTINCT year(invoice_date) * 12 + month(invoice_date) AS m FROM kept)
    SELECT CAST(m AS INTEGER) AS m, CAST(missing_before AS INTEGER) AS missing_before FROM (
        SELECT m, m - LAG(m) OVER (ORDER BY m) - 1 AS missing_before FROM kept_months) t WHERE missing_before > 0""")(
    lambda r: Q.month_gaps(r.lines.filter("invoice_quarter <> 2")))


def _metric_sql(category: str, source: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{category}' AS category, '{c}' AS metric, CAST({c} AS DOUBLE) AS value FROM ({source}) {category}_t"
        for c in columns)


_RANGE_NAMES = [x.rsplit(" AS ", 1)[1] for x in _RANGE_LIST]
_SUMMARY = " UNION ALL ".join([
    f"SELECT 'completeness' AS category, 'total_rows' AS metric, CAST({s_count()} AS DOUBLE) AS value FROM silver",
    *[f"SELECT 'completeness', 'columns.' || column_name || '.{m}', CAST({m} AS DOUBLE) FROM ({completeness_sql()}) c "
      f"WHERE {m} IS NOT NULL" for m in ("null_count", "null_rate", "empty_string_rate", "whitespace_only_rate")],
    *[f"SELECT 'uniqueness', column_name || '.{m}', CAST({m} AS DOUBLE) FROM ({_UNIQUE}) u"
      for m in ("n_unique", "unique_rate", "duplicate_rate")],
    f"SELECT 'uniqueness', column_name || '.top_duplicates.' || value, CAST(rows AS DOUBLE) FROM ({_TOP}) p",
    _metric_sql("consistency", f"SELECT {_CONS} FROM silver", list(CONSISTENCY)),
    _metric_sql("value_ranges", f"SELECT {', '.join(_RANGE_LIST)} FROM silver", _RANGE_NAMES),
    _metric_sql("temporal", f"""SELECT CAST(epoch_us(date_min) AS DOUBLE) / CAST(1000000 AS DOUBLE) AS date_min,
        CAST(epoch_us(date_max) AS DOUBLE) / CAST(1000000 AS DOUBLE) AS date_max, date_range_days, unique_months,
        month_gaps FROM ({_TEMPORAL}) t""", ["date_min", "date_max", "date_range_days", "unique_months", "month_gaps"]),
])
query("q6_quality_summary", _SUMMARY)(lambda r: Q.quality_summary(r.lines.select(SILVER_COLUMNS), r.scratch))


# ---- audit and monthly reports ------------------------------------------------------------------------------

query("s3_discover_months", "SELECT DISTINCT year_month FROM bronze ORDER BY year_month DESC")(
    lambda r: r.bronze.select("year_month").distinct().orderBy(F.desc("year_month")))
query("s8_ingestion_audit", f"""SELECT year_month, {s_count()} AS row_count, {s_count('is_cancellation')} AS cancellation_count,
    {s_count("customer_id = ''")} AS null_customer_count, MIN(invoice_date) AS min_invoice_date,
    MAX(invoice_date) AS max_invoice_date, CAST(COUNT(DISTINCT country) AS BIGINT) AS unique_countries,
    'order tables' AS source_file FROM bronze GROUP BY year_month""")(
    lambda r: B.ingestion_audit(r.bronze, "order tables").drop("ingested_at"))


def _monthly_report_sql() -> str:
    full = completeness_sql("year_month")
    parts = [f"SELECT year_month, 'completeness' AS category, 'total_rows' AS metric, CAST({s_count()} AS DOUBLE) AS value "
             "FROM silver GROUP BY year_month"]
    parts += [f"SELECT year_month, 'completeness', 'columns.' || column_name || '.{m}', CAST({m} AS DOUBLE) "
              f"FROM ({full}) c WHERE {m} IS NOT NULL"
              for m in ("null_count", "null_rate", "empty_string_rate", "whitespace_only_rate")]
    for category, cols, names in (("consistency", _CONS, list(CONSISTENCY)),
                                  ("value_ranges", ", ".join(_RANGE_LIST), _RANGE_NAMES)):
        parts += [f"SELECT year_month, '{category}', '{n}', CAST({n} AS DOUBLE) FROM "
                  f"(SELECT year_month, {cols} FROM silver GROUP BY year_month) {category}_t" for n in names]
    return " UNION ALL ".join(parts)


query("s14_monthly_quality_report", _monthly_report_sql())(lambda r: Q.monthly_quality_report(r.lines.select(SILVER_COLUMNS)))
query("s15_flat_quality_report", f"""SELECT year_month, CAST({s_count()} AS DOUBLE) AS total_rows,
    {s_rate(s_count("customer_id = ''"), "COUNT(*)")} AS empty_customer_rate, """ + ", ".join(
    f"CAST({s_count(CONSISTENCY[source])} AS DOUBLE) AS {name}" for name, source in Q.FLAT_REPORT.items()
    if source in CONSISTENCY) + " FROM silver GROUP BY year_month")(
    lambda r: Q.flatten_reports(Q.monthly_quality_report(r.lines.select(SILVER_COLUMNS))))


# ---- layers -------------------------------------------------------------------------------------------------

def _layer_sql(layer: str, source: str, columns: str) -> str:
    distinct = f"(SELECT COUNT(*) FROM (SELECT DISTINCT {columns} FROM {source}) d)"
    nulls = ", ".join(f"{s_rate(s_count(f'{c} IS NULL'), 'COUNT(*)', 6)} AS {c}_null_rate" for c in schemas.KEY_COLUMNS)
    blank = s_count("trim(COALESCE(customer_id, '')) = ''")
    return f"""SELECT '{layer}' AS layer, {s_count()} AS row_count, CAST(COUNT(*) - {distinct} AS BIGINT) AS duplicate_rows,
        {s_rate(f"COUNT(*) - {distinct}", "COUNT(*)", 6)} AS duplicate_rate, {nulls},
        {s_rate(blank, "COUNT(*)", 6)} AS empty_customer_rate FROM {source}"""


query("q7_layer_metrics", _layer_sql("bronze", "bronze", BUSINESS) + " UNION ALL "
      + _layer_sql("silver", "silver", ", ".join(SILVER_COLUMNS)))(
    lambda r: Q.layer_metrics(r.bronze.select(schemas.BUSINESS_COLUMNS), "bronze").unionByName(
        Q.layer_metrics(r.lines.select(SILVER_COLUMNS), "silver")))
query("a5_full_row_distinct", f"SELECT DISTINCT {BUSINESS} FROM bronze")(
    lambda r: r.bronze.select(schemas.BUSINESS_COLUMNS).dropDuplicates())
query("a6_duplicate_rows", f"""SELECT {s_count()} AS row_count,
    CAST(COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT {BUSINESS} FROM bronze) d) AS BIGINT) AS duplicate_rows,
    CAST(COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT invoice, stock_code FROM bronze) d) AS BIGINT) AS pair_duplicates
    FROM bronze""")(
    lambda r: Q.duplicate_rows(r.bronze, schemas.BUSINESS_COLUMNS).crossJoin(F.broadcast(
        Q.duplicate_rows(r.bronze, ["invoice", "stock_code"]).select(F.col("duplicate_rows").alias("pair_duplicates")))))
_DELTA = f"""SELECT bronze_rows, after_dedup, bronze_rows - after_dedup AS dedup_removed,
    after_dedup - noise_removed AS after_noise_filter, noise_removed, after_dedup - noise_removed AS expected_silver_rows
    FROM (SELECT (SELECT {s_count()} FROM bronze) AS bronze_rows, {s_count()} AS after_dedup,
        {s_count("NOT is_cancellation AND price <= 0")} AS noise_removed
        FROM (SELECT DISTINCT {BUSINESS} FROM bronze) d) t"""
query("q8_bronze_silver_delta", _DELTA)(lambda r: Q.bronze_to_silver_delta(r.bronze))

_NEG, _POS = "quantity < 0 AND NOT is_cancellation", "is_cancellation AND NOT quantity < 0"


def _findings_sql(layer: str, source: str, rules: list[tuple[str, str, str]]) -> str:
    return " UNION ALL ".join(f"SELECT '{layer}' AS layer, '{n}' AS rule, '{sev}' AS severity, {s_count(c)} AS rows "
                              f"FROM {source}" for n, c, sev in rules)


query("q9_sign_findings", f"WITH flipped AS ({_FLIPPED}) " + _findings_sql("silver", "silver", [
    ("price_negative", "price < 0", "error"), ("negative_quantity_not_cancelled", _NEG, "error"),
    ("cancellation_quantity_not_negative", _POS, "warning")]) + " UNION ALL " + _findings_sql("planted", "flipped", [
        ("price_negative", "price < 0", "error"), ("negative_quantity_not_cancelled", _NEG, "error"),
        ("cancellation_quantity_not_negative", _POS, "warning")]))(
    lambda r: Q.sign_findings(r.lines, "silver").unionByName(Q.sign_findings(flip(r.lines), "planted")))
query("q10_quantity_cancellation", f"WITH flipped AS ({_FLIPPED}) " + _findings_sql("planted", "flipped", [
    ("negative_not_cancelled", _NEG, "warning"), ("cancelled_not_negative", _POS, "warning")]))(
    lambda r: Q.quantity_cancellation_findings(flip(r.lines), "planted"))
_NN = [c for c in schemas.FACT_COLUMNS if c != "is_cancellation"]
query("q11_fact_nulls", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, {s_count(f'{c} IS NULL')} AS null_count FROM fact" for c in _NN))(
    lambda r: Q.fact_null_counts(r.fact_transactions))
_MULTI = """SELECT COALESCE(a.quantity, b.quantity) AS quantity, COALESCE(left_rows, 0) AS left_rows,
    COALESCE(right_rows, 0) AS right_rows FROM (SELECT quantity, CAST(COUNT(*) AS BIGINT) AS left_rows FROM {a} GROUP BY quantity) a
    FULL OUTER JOIN (SELECT quantity, CAST(COUNT(*) AS BIGINT) AS right_rows FROM {b} GROUP BY quantity) b
    ON a.quantity IS NOT DISTINCT FROM b.quantity WHERE COALESCE(left_rows, 0) <> COALESCE(right_rows, 0)"""
query("q12_quantity_multiset", _MULTI.format(a="fact", b="silver"))(
    lambda r: C.multiset_difference(r.fact_transactions, r.lines, "quantity"))
query("u4_multiset_difference", _MULTI.format(a="bronze", b="silver"))(
    lambda r: C.multiset_difference(r.bronze, r.lines, "quantity"))
query("q13_quantity_aggregate", f"""SELECT (SELECT {s_count()} FROM fact) AS fact_rows,
    (SELECT {s_count("quantity < 0")} FROM fact) AS fact_negative, {s_count()} AS source_rows,
    {s_count("quantity < 0")} AS source_negative, {s_count(_NEG)} AS negative_not_cancelled FROM silver""")(
    lambda r: Q.quantity_aggregate(r.fact_transactions, r.lines))
query("q14_cancellation_measures", _findings_sql("fact_transactions", "fact", [
    ("negative_not_cancelled", _NEG, "warning"), ("cancelled_not_negative", _POS, "warning"),
    ("negative_amount_not_cancelled", "NOT is_cancellation AND line_amount < 0", "error")]))(
    lambda r: Q.cancellation_measure_findings(r.fact_transactions))
query("q15_dashboard_measures", f"""SELECT 'quantity_negative' AS rule, {s_count("quantity < 0")} AS rows FROM fact
    UNION ALL SELECT 'line_amount_negative', {s_count("line_amount < 0")} FROM fact""")(
    lambda r: Q.dashboard_measure_findings(r.fact_transactions))
_REC = f"""SELECT rfm_revenue, rfm_rows, rfm_customers, null_segments, eligible_revenue, eligible_customers,
    COALESCE(ABS(rfm_revenue - eligible_revenue) / NULLIF(eligible_revenue, 0), 0) <= 0.001 AS revenue_ok,
    rfm_rows = eligible_customers AS customers_ok, rfm_rows = rfm_customers AS unique_ok, null_segments = 0 AS segments_ok
    FROM (SELECT {s_units("monetary")} AS rfm_revenue, {s_count()} AS rfm_rows,
        CAST(COUNT(DISTINCT customer_id) AS BIGINT) AS rfm_customers, {s_count("segment IS NULL")} AS null_segments,
        (SELECT {s_units("line_amount")} FROM valid) AS eligible_revenue,
        (SELECT CAST(COUNT(DISTINCT customer_id) AS BIGINT) FROM valid) AS eligible_customers FROM rfm) t"""
query("q16_rfm_reconciliation", _REC)(lambda r: Q.rfm_reconciliation(r.mart_rfm, r.lines))
query("q17_revenue_from_bronze", f"""SELECT {s_units("quantity * price")} AS bronze_revenue,
    (SELECT {s_units("monetary")} FROM rfm) AS rfm_revenue FROM (SELECT DISTINCT {BUSINESS} FROM bronze) d
    WHERE customer_id <> '' AND NOT is_cancellation AND quantity * price > 0 AND (price IS NULL OR price > 0)""")(
    lambda r: Q.bronze_eligible_revenue(r.bronze).crossJoin(F.broadcast(
        r.mart_rfm.agg(X.exact_sum("monetary").alias("rfm_revenue")))))
query("q18_partition_rows", f"""SELECT a.year_month, expected_rows, actual_rows FROM
    (SELECT year_month, {s_count()} AS expected_rows FROM (SELECT DISTINCT {BUSINESS}, year_month FROM bronze) d
     WHERE is_cancellation OR price IS NULL OR price > 0 GROUP BY year_month) a
    FULL OUTER JOIN (SELECT year_month, {s_count()} AS actual_rows FROM silver GROUP BY year_month) b
    ON a.year_month = b.year_month""")(
    lambda r: Q.expected_rows_by_month(r.bronze).withColumnRenamed("rows", "expected_rows").join(
        Q.rows_by_month(r.lines).withColumnRenamed("rows", "actual_rows"), "year_month", "full_outer"))


@query("q19_build_parity", f"""SELECT metric, value AS first_value, value AS second_value, TRUE AS agrees FROM (
    SELECT 'fact_rows' AS metric, CAST({s_count()} AS DOUBLE) AS value FROM fact
    UNION ALL SELECT 'guest_rows', CAST({s_count("customer_sk = 0")} AS DOUBLE) FROM fact
    UNION ALL SELECT 'negative_rows', CAST({s_count("line_amount < 0")} AS DOUBLE) FROM fact
    UNION ALL SELECT 'rfm_customers', CAST({s_count()} AS DOUBLE) FROM rfm
    UNION ALL SELECT 'rfm_revenue', {s_units("monetary")} FROM rfm) t""")
def build_parity(r):
    """The dense-key build against the hash-key build of the same lines."""
    from tallyline.plans import marts, star
    other = star.fact_transactions(r.lines, r.dim_customer, r.dim_product, r.dim_country, r.dim_date, r.scratch, "hash")
    rfm = marts.rfm_base(marts.invoice_rollup(r.lines))
    return Q.parity(Q.gold_summary(r.fact_transactions, r.mart_rfm), Q.gold_summary(other, rfm))


query("q20_validation_report", " UNION ALL ".join(
    f"SELECT '{name}' AS rule, '{inv.severity}' AS severity, (SELECT {s_count()} FROM ({INVARIANT_SQL[name]}) x) AS violations"
    for name, inv in R.INVARIANTS.items()))(lambda r: R.validation_report(Built(r), r.scratch))
query("q21_dimension_checks", " UNION ALL ".join(
    f"""SELECT '{d}' AS dimension, (SELECT {s_count()} FROM {d} WHERE {w}) AS members,
    (SELECT CAST(COUNT(DISTINCT {v}) AS BIGINT) FROM lines WHERE {lw}) AS source_values,
    (SELECT CAST(COUNT(*) AS BIGINT) FROM (SELECT {k} FROM {d} GROUP BY {k} HAVING COUNT(*) > 1) x) AS repeated_keys,
    (SELECT {s_count(f'{k} IS NULL')} FROM fact) AS fact_nulls"""
    for d, k, v, w, lw in (("dim_customer", "customer_sk", "customer_id", "customer_id <> ''", "customer_id <> ''"),
                           ("dim_product", "product_sk", "stock_code", "TRUE", "TRUE"),
                           ("dim_country", "country_sk", "country", "TRUE", "TRUE"),
                           ("dim_date", "date_sk", "tx_date", "TRUE", "TRUE"))))(
    lambda r: Q.dimension_checks(r.lines, r.fact_transactions, r.dim_customer, r.dim_product, r.dim_country, r.dim_date, r.scratch))


def _dims(r):
    return {f"dim_{d}": (getattr(r, f"dim_{d}"), f"{d}_sk") for d in ("customer", "product", "country", "date")}


_COVER = " UNION ALL ".join(
    f"""SELECT 'dim_{d}' AS dimension,
    (SELECT CAST(COUNT(*) AS BIGINT) FROM fact f WHERE f.{d}_sk NOT IN (SELECT {d}_sk FROM dim_{d})) AS orphans,
    (SELECT {s_count()} FROM dim_{d}) AS members, (SELECT CAST(COUNT(DISTINCT {d}_sk) AS BIGINT) FROM fact) AS in_fact,
    {s_round(s_ratio(f"(SELECT COUNT(DISTINCT {d}_sk) FROM fact) * 100", f"(SELECT COUNT(*) FROM dim_{d})"), 4)} AS coverage_pct"""
    for d in ("customer", "product", "country", "date"))
query("q22_key_coverage", _COVER)(lambda r: Q.key_coverage(r.fact_transactions, r.scratch, **_dims(r)))
query("j7_foreign_key_orphans", " UNION ALL ".join(
    f"SELECT '{d}_sk' AS foreign_key, CAST(COUNT(*) AS BIGINT) AS orphans FROM fact f WHERE f.{d}_sk NOT IN "
    f"(SELECT {d}_sk FROM dim_{d} WHERE {d}_sk > 3)" for d in ("customer", "product", "country", "date")))(
    lambda r: _orphans(r))


def _orphans(r):
    """Orphans against dimensions that lost their first members."""
    out = None
    for d in ("customer", "product", "country", "date"):
        bad = C.relationships(r.fact_transactions, f"{d}_sk", getattr(r, f"dim_{d}").filter(f"{d}_sk > 3"), f"{d}_sk")
        part = bad.agg(F.coalesce(F.sum("rows"), F.lit(0)).cast("bigint").alias("orphans")).select(
            F.lit(f"{d}_sk").alias("foreign_key"), "orphans")
        out = part if out is None else out.unionByName(part)
    return out


def _rule_condition(rule: str) -> str:
    name, text = rule.split(": ")
    if text == "not 0 or 1":
        return f"{name} NOT IN (0, 1)"
    if text == "negative":
        return f"{name} < 0"
    if text == "below 1":
        return f"{name} < 1"
    return f"{name} < 0 OR {name} > {text.rsplit('..', 1)[1]}"


_FEATURE_RULES = [*[f"{c}: not 0 or 1" for c in schemas.BINARY_FEATURES], *[f"{c}: negative" for c in schemas.NON_NEGATIVE_FEATURES],
                  *[f"{c}: outside 0..1" for c in schemas.UNIT_INTERVAL_FEATURES],
                  *[f"{c}: outside 0..{t:g}" for c, t in schemas.CAPPED_FEATURES.items()], "frequency: below 1"]
_SHIFTED = "SELECT * REPLACE (recency_days - 30 AS recency_days, cancellation_rate * 3 AS cancellation_rate) FROM fx"
query("q24_feature_ranges", " UNION ALL ".join(
    f"SELECT '{rule}' AS rule, {s_count(_rule_condition(rule))} AS rows FROM fx" for rule in _FEATURE_RULES))(
    lambda r: Q.feature_range_counts(r.mart_features))
query("q24_feature_ranges_seeded", f"WITH shifted AS ({_SHIFTED}) " + " UNION ALL ".join(
    f"SELECT '{rule}' AS rule, {s_count(_rule_condition(rule))} AS rows FROM shifted" for rule in _FEATURE_RULES))(
    lambda r: Q.feature_range_counts(r.mart_features.withColumns({
        "recency_days": F.col("recency_days") - 30, "cancellation_rate": F.col("cancellation_rate") * 3})))

_REASONS = {"unreadable_date": "invoice_date IS NULL", "unreadable_quantity": "quantity IS NULL",
            "unreadable_price": "price IS NULL", "negative_price": "price < 0",
            "price_not_positive": "NOT is_cancellation AND price <= 0", "blank_invoice": "trim(invoice) = ''",
            "blank_stock_code": "trim(stock_code) = ''"}
query("q30_quarantine", "SELECT invoice, stock_code, quantity, price, reasons FROM (SELECT *, concat_ws(',', " + ", ".join(
    f"CASE WHEN {c} THEN '{n}' END" for n, c in _REASONS.items()) + ") AS reasons FROM bronze) t WHERE reasons <> ''")(
    lambda r: Q.quarantine(r.bronze)[1].select("invoice", "stock_code", "quantity", "price",
                                               F.concat_ws(",", "reject_reason").alias("reasons")))
query("q30_accepted", f"SELECT year_month, {s_count()} AS rows FROM bronze WHERE NOT (" + " OR ".join(
    f"COALESCE({c}, FALSE)" for c in _REASONS.values()) + ") GROUP BY year_month")(
    lambda r: Q.rows_by_month(Q.quarantine(r.bronze)[0]))

# ---- generic column checks ----------------------------------------------------------------------------------

_COLUMN_SQL = []
_SQL = {"fact": "fact", "rfm": "rfm", "kpi": "kpi_mart", "features": "fx", "silver": "silver"}
for _t, _c, _k, *_rest in R.COLUMN_CHECKS:
    _src = _SQL.get(_t, _t)
    if _k == "not_null":
        _v = f"(SELECT {s_count(f'{_c} IS NULL')} FROM {_src})"
    elif _k == "accepted_values":
        _list = ", ".join(repr(v) for v in _rest[0])
        _v = f"(SELECT {s_count(f'{_c} NOT IN ({_list})')} FROM {_src})"
    elif _k == "unique":
        _v = f"(SELECT CAST(COUNT(*) AS BIGINT) FROM (SELECT {_c} FROM {_src} WHERE {_c} IS NOT NULL GROUP BY {_c} HAVING COUNT(*) > 1) x)"
    else:
        _v = (f"(SELECT CAST(COUNT(DISTINCT {_c}) AS BIGINT) FROM {_src} c WHERE NOT EXISTS "
              f"(SELECT 1 FROM {_rest[0]} p WHERE p.{_rest[1]} = c.{_c}))")
    _COLUMN_SQL.append(f"SELECT '{_t}' AS table_name, '{_c}' AS column_name, '{_k}' AS kind, {_v} AS violations")
query("declared_column_checks", " UNION ALL ".join(_COLUMN_SQL))(lambda r: R.column_check_counts(Built(r), r.scratch))
