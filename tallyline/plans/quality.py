"""Data-quality metrics and rule checks over the layers.

Row-level measures of a table are taken in one pass and turned into long (category, metric, value) rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyline import schemas
from tallyline.functions import exprs as X
from tallyline.operators import checks as C
from tallyline.operators import fusion
from tallyline.plans import silver
from tallyline.sources.lake import Scratch

REVENUE_TOLERANCE = 0.001
MEASURES = ["quantity", "price", "line_amount"]


def _text_columns(df: DataFrame) -> set[str]:
    return {f.name for f in df.schema if f.dataType.simpleString() == "string"}


# ---- metric families ---------------------------------------------------------------------------------------

def _completeness_aggs(df: DataFrame, measured: list[str]) -> list[Column]:
    texts = _text_columns(df)
    aggs = [F.count(F.lit(1)).alias("total_rows")]
    for c in measured:
        aggs.append(X.count_if(F.col(c).isNull()).alias(f"{c}|null"))
        if c in texts:
            blank = X.is_guest(c)
            aggs.append(X.count_if(blank).alias(f"{c}|empty"))
            aggs.append(X.count_if(blank & (F.coalesce(c, F.lit("")) != "")).alias(f"{c}|space"))
    return aggs


def completeness(df: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Per column: NULL count and rate; for texts also empty and whitespace-only rates."""
    measured = [c for c in df.columns if c not in keys]
    return _completeness_rows(df.groupBy(*keys).agg(*_completeness_aggs(df, measured)), measured, _text_columns(df), keys)


def _completeness_rows(wide: DataFrame, measured: list[str], texts: set[str], keys: tuple[str, ...] = ()) -> DataFrame:
    def entry(c: str):
        def share(kind: str):
            if c not in texts:
                return F.lit(None).cast("double")
            return C.rate(F.col(f"`{c}|{kind}`"), F.col("total_rows"))

        nulls = F.col(f"`{c}|null`")
        return F.struct(F.lit(c).alias("column_name"), nulls.alias("null_count"),
                        C.rate(nulls, F.col("total_rows")).alias("null_rate"),
                        share("empty").alias("empty_string_rate"), share("space").alias("whitespace_only_rate"))

    return wide.select(*keys, "total_rows", F.inline(F.array(*[entry(c) for c in measured])))


def _value_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, value, rows) over all key columns with one scan and one shuffle."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns])
    return df.select(F.inline(pairs)).filter("value IS NOT NULL").groupBy("column_name", "value").agg(
        F.count(F.lit(1)).alias("rows"))


def uniqueness(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    return _uniqueness(_value_counts(df, columns or schemas.KEY_COLUMNS))


def _uniqueness(counts: DataFrame) -> DataFrame:
    return counts.groupBy("column_name").agg(F.count(F.lit(1)).alias("n_unique"), F.sum("rows").alias("total")).select(
        "column_name", "n_unique", C.rate(F.col("n_unique"), F.col("total")).alias("unique_rate"),
        X.round_to(1 - X.ratio("n_unique", "total"), 4).alias("duplicate_rate"))


def top_values(df: DataFrame, columns: list[str] | None = None, n: int = 5) -> DataFrame:
    """The n most frequent values per column. The rank limit is applied before the shuffle as well as after it."""
    return _top_values(_value_counts(df, columns or schemas.KEY_COLUMNS), n)


def _top_values(counts: DataFrame, n: int = 5) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("column_name").orderBy(F.desc("rows"), "value"))
    return counts.withColumn("rank", rank).filter(F.col("rank") <= n)


def consistency(df: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    return df.groupBy(*keys).agg(*_consistency_aggs())


def _consistency_aggs() -> list[Column]:
    negative, cancelled = F.col("quantity") < 0, F.col("is_cancellation")
    return [
        X.count_if(negative & ~cancelled).alias("quantity_negative_not_cancellation"),
        X.count_if(cancelled & ~negative).alias("cancellation_positive_quantity"),
        X.count_if(F.col("price") < 0).alias("price_negative_count"),
        X.count_if(F.abs(F.col("line_amount") - F.col("quantity") * F.col("price")) > 0.01).alias(
            "line_amount_mismatch_count"),
        X.count_if(F.startswith("invoice", F.lit("C")) != cancelled).alias("cancellation_flag_mismatch"),
    ]


def value_ranges(df: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    return df.groupBy(*keys).agg(*_range_aggs())


def _range_aggs() -> list[Column]:
    aggs = []
    for m in MEASURES:
        aggs += [F.min(m).alias(f"{m}_min"), F.max(m).alias(f"{m}_max"),
                 X.round_to(X.ratio(X.exact_sum(m), F.count(m)), 4).alias(f"{m}_mean"),
                 X.count_if(F.col(m) == 0).alias(f"{m}_zero_count")]
    aggs.append(X.count_if(F.col("quantity") < 0).alias("quantity_negative_count"))
    return aggs


def months_present(df: DataFrame) -> DataFrame:
    return df.filter("invoice_date IS NOT NULL").select(X.month_index("invoice_date").alias("m")).distinct()


def month_gaps(df: DataFrame) -> DataFrame:
    """Per month after a hole: how many months are missing before it. Only distinct months are ordered."""
    return _month_gaps(months_present(df))


def _month_gaps(months: DataFrame) -> DataFrame:
    before = F.lag("m").over(Window.orderBy("m"))
    return months.select("m", (F.col("m") - before - 1).alias("missing_before")).filter("missing_before > 0")


def temporal(df: DataFrame) -> DataFrame:
    return _temporal(df.agg(F.min("invoice_date").alias("date_min"), F.max("invoice_date").alias("date_max")), months_present(df))


def _temporal(span: DataFrame, present: DataFrame) -> DataFrame:
    months = present.agg(F.count(F.lit(1)).alias("unique_months"))
    gaps = _month_gaps(present).agg(F.coalesce(F.sum("missing_before"), F.lit(0)).cast("bigint").alias("month_gaps"))
    whole_days = F.floor((X.micros("date_max") - X.micros("date_min")) / F.lit(X.MICROS_PER_DAY)).cast("bigint")
    return span.crossJoin(F.broadcast(months)).crossJoin(F.broadcast(gaps)).select(
        "date_min", "date_max", whole_days.alias("date_range_days"), "unique_months", "month_gaps")


def quality_summary(df: DataFrame, scratch: Scratch) -> DataFrame:
    """All metric families as (category, metric, value) rows; times are seconds since 1970.

    The rows are read twice: once for everything that is a sum, a count or an extreme, once for the values of the key columns
    and the months, which are counted and written before they are ranked.
    """
    measured, texts = list(df.columns), _text_columns(df)
    ranges, rules = _range_aggs(), _consistency_aggs()
    span = [F.min("invoice_date").alias("date_min"), F.max("invoice_date").alias("date_max")]
    wide = scratch.write(df.agg(*_completeness_aggs(df, measured), *rules, *ranges, *span))
    counts = scratch.write(_value_counts(df.withColumn("_month", X.month_index("invoice_date")), [*schemas.KEY_COLUMNS, "_month"]))
    keys_counted, months = counts.filter("column_name <> '_month'"), counts.filter("column_name = '_month'").select(F.col("value").cast("int").alias("m"))
    names = lambda before, after: wide.columns[before:after]
    at = wide.columns.index("quantity_negative_not_cancellation")

    per_column = _completeness_rows(wide, measured, texts).unpivot(
        ["column_name"], [F.col("null_count").cast("double").alias("null_count"), "null_rate", "empty_string_rate",
                          "whitespace_only_rate"], "measure", "value").filter("value IS NOT NULL").select(
        F.lit("completeness").alias("category"),
        F.concat_ws(".", F.lit("columns"), "column_name", "measure").alias("metric"), "value")
    rows = wide.select(F.lit("completeness").alias("category"), F.lit("total_rows").alias("metric"), F.col("total_rows").cast("double").alias("value"))
    keys = _uniqueness(keys_counted).unpivot(
        ["column_name"], [F.col("n_unique").cast("double").alias("n_unique"), "unique_rate", "duplicate_rate"],
        "measure", "value").select(
        F.lit("uniqueness").alias("category"), F.concat_ws(".", "column_name", "measure").alias("metric"), "value")
    tops = _top_values(keys_counted).select(
        F.lit("uniqueness").alias("category"),
        F.concat_ws(".", "column_name", F.lit("top_duplicates"), "value").alias("metric"),
        F.col("rows").cast("double").alias("value"))
    times = _temporal(wide.select("date_min", "date_max"), months).select(
        (X.micros("date_min") / 1_000_000).alias("date_min"), (X.micros("date_max") / 1_000_000).alias("date_max"),
        "date_range_days", "unique_months", "month_gaps")
    parts = [rows, per_column, keys, tops, C.as_metrics(wide.select(names(at, at + len(rules))), "consistency"),
             C.as_metrics(wide.select(names(at + len(rules), at + len(rules) + len(ranges))), "value_ranges"), C.as_metrics(times, "temporal")]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def monthly_quality_report(lines: DataFrame) -> DataFrame:
    """Per month: (year_month, category, metric, value) rows, for the cumulative log."""
    key = ("year_month",)
    full = completeness(lines, key)
    per_column = full.unpivot(
        ["year_month", "column_name"], [F.col("null_count").cast("double").alias("null_count"), "null_rate",
                                        "empty_string_rate", "whitespace_only_rate"], "measure", "value").filter(
        "value IS NOT NULL").select(
        "year_month", F.lit("completeness").alias("category"),
        F.concat_ws(".", F.lit("columns"), "column_name", "measure").alias("metric"), "value")
    rows = C.as_metrics(lines.groupBy(*key).agg(F.count(F.lit(1)).alias("total_rows")), "completeness", key)
    return (rows.unionByName(per_column)
            .unionByName(C.as_metrics(consistency(lines, key), "consistency", key))
            .unionByName(C.as_metrics(value_ranges(lines, key), "value_ranges", key)))


# Metric names of the flat monthly report and the metric each is taken from.
FLAT_REPORT = {
    "total_rows": "total_rows",
    "empty_customer_rate": "columns.customer_id.empty_string_rate",
    "qty_neg_not_cancel": "quantity_negative_not_cancellation",
    "cancel_pos_qty": "cancellation_positive_quantity",
    "price_negative": "price_negative_count",
    "line_amt_mismatch": "line_amount_mismatch_count",
    "cancel_flag_mismatch": "cancellation_flag_mismatch",
}


def flatten_reports(report: DataFrame) -> DataFrame:
    """One row per month from the long report."""
    picks = [F.coalesce(F.max(F.when(F.col("metric") == source, F.col("value"))), F.lit(0.0)).alias(name)
             for name, source in FLAT_REPORT.items()]
    return report.groupBy("year_month").agg(*picks)


# ---- layer metrics and reconciliation ----------------------------------------------------------------------

def duplicate_rows(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Rows, and rows that repeat an earlier one on ``columns``: grouped, never compared pairwise."""
    groups = df.groupBy(*(columns or df.columns)).agg(F.count(F.lit(1)).alias("_rows"))
    return groups.agg(F.coalesce(F.sum("_rows"), F.lit(0)).cast("bigint").alias("row_count"),
                      F.coalesce(F.sum(F.col("_rows") - 1), F.lit(0)).cast("bigint").alias("duplicate_rows"))


def layer_metrics(df: DataFrame, layer: str, columns: list[str] | None = None) -> DataFrame:
    rows = F.count(F.lit(1))
    nulls = df.agg(*[C.rate(X.count_if(F.col(c).isNull()), rows, 6).alias(f"{c}_null_rate")
                     for c in schemas.KEY_COLUMNS], C.rate(X.count_if(X.is_guest()), rows, 6).alias(
        "empty_customer_rate"))
    repeats = duplicate_rows(df, columns).withColumn(
        "duplicate_rate", C.rate(F.col("duplicate_rows"), F.col("row_count"), 6))
    return repeats.crossJoin(F.broadcast(nulls)).select(F.lit(layer).alias("layer"), "*")


def bronze_to_silver_delta(bronze: DataFrame) -> DataFrame:
    """How many rows cleaning must remove, and why."""
    distinct = bronze.groupBy(*schemas.BUSINESS_COLUMNS).agg(F.count(F.lit(1)).alias("_rows"))
    noise = X.count_if(X.is_noise())
    kept = F.count(F.lit(1))
    return distinct.agg(F.coalesce(F.sum("_rows"), F.lit(0)).cast("bigint").alias("bronze_rows"),
                        kept.alias("after_dedup"), noise.alias("noise_removed")).select(
        "bronze_rows", "after_dedup", (F.col("bronze_rows") - F.col("after_dedup")).alias("dedup_removed"),
        (F.col("after_dedup") - F.col("noise_removed")).alias("after_noise_filter"), "noise_removed",
        (F.col("after_dedup") - F.col("noise_removed")).alias("expected_silver_rows"))


def expected_rows_by_month(bronze: DataFrame) -> DataFrame:
    distinct = bronze.select(*schemas.BUSINESS_COLUMNS, X.year_month("invoice_date").alias("year_month")).distinct()
    return distinct.filter(~X.is_noise()).groupBy("year_month").agg(F.count(F.lit(1)).alias("rows"))


def rows_by_month(df: DataFrame) -> DataFrame:
    return df.groupBy("year_month").agg(F.count(F.lit(1)).alias("rows"))


def fact_rows_by_month(fact: DataFrame, dates: DataFrame) -> DataFrame:
    per_day = fact.groupBy("date_sk").agg(F.count(F.lit(1)).alias("rows"))
    return per_day.join(dates.select("date_sk", X.year_month("date").alias("year_month")), "date_sk").groupBy(
        "year_month").agg(F.sum("rows").alias("rows"))


def sign_findings(df: DataFrame, layer: str) -> DataFrame:
    """Sign rules with their severity. A cancellation with quantity >= 0 is a known source anomaly: a warning."""
    negative, cancelled = F.col("quantity") < 0, F.col("is_cancellation")
    counts = df.agg(X.count_if(F.col("price") < 0).alias("price_negative"),
                    X.count_if(negative & ~cancelled).alias("negative_quantity_not_cancelled"),
                    X.count_if(cancelled & ~negative).alias("cancellation_quantity_not_negative"))
    long = counts.unpivot([], counts.columns, "rule", "rows")
    severity = F.when(F.col("rule") == "cancellation_quantity_not_negative", "warning").otherwise("error")
    return long.select(F.lit(layer).alias("layer"), "rule", severity.alias("severity"), "rows")


def quantity_cancellation_findings(df: DataFrame, layer: str) -> DataFrame:
    """quantity < 0 if and only if cancelled; both directions are warnings (known anomaly)."""
    negative, cancelled = F.col("quantity") < 0, F.col("is_cancellation")
    counts = df.agg(X.count_if(negative & ~cancelled).alias("negative_not_cancelled"),
                    X.count_if(cancelled & ~negative).alias("cancelled_not_negative"))
    return counts.unpivot([], counts.columns, "rule", "rows").select(
        F.lit(layer).alias("layer"), "rule", F.lit("warning").alias("severity"), "rows")


def fact_null_counts(fact: DataFrame) -> DataFrame:
    columns = [c for c in schemas.FACT_COLUMNS if c != "is_cancellation"]
    counts = fact.agg(*[X.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], columns, "column_name", "null_count")


def quantity_aggregate(fact: DataFrame, source: DataFrame) -> DataFrame:
    def totals(df: DataFrame, side: str) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias(f"{side}_rows"), X.count_if(F.col("quantity") < 0).alias(f"{side}_negative"))

    stray = source.agg(X.count_if((F.col("quantity") < 0) & ~F.col("is_cancellation")).alias("negative_not_cancelled"))
    return totals(fact, "fact").crossJoin(F.broadcast(totals(source, "source"))).crossJoin(F.broadcast(stray))


def cancellation_measure_findings(fact: DataFrame) -> DataFrame:
    amount = fact.agg(X.count_if(~F.col("is_cancellation") & (F.col("line_amount") < 0)).alias("rows")).select(
        F.lit("fact_transactions").alias("layer"), F.lit("negative_amount_not_cancelled").alias("rule"),
        F.lit("error").alias("severity"), "rows")
    return quantity_cancellation_findings(fact, "fact_transactions").unionByName(amount)


def dashboard_measure_findings(fact: DataFrame) -> DataFrame:
    counts = fact.agg(X.count_if(F.col("quantity") < 0).alias("quantity_negative"),
                      X.count_if(F.col("line_amount") < 0).alias("line_amount_negative"))
    return counts.unpivot([], counts.columns, "rule", "rows")


def eligible_totals(lines: DataFrame) -> DataFrame:
    """Revenue and customers that RFM must account for: customers are grouped first, then counted."""
    per_customer = silver.valid_purchase_rows(lines).groupBy("customer_id").agg(
        F.sum(X.units("line_amount")).alias("amount"))
    return per_customer.agg(X.from_units(F.coalesce(F.sum("amount"), F.lit(0))).alias("eligible_revenue"),
                            F.count(F.lit(1)).alias("eligible_customers"))


def bronze_eligible_revenue(bronze: DataFrame) -> DataFrame:
    """Revenue re-derived from bronze: repeats and noise removed, then the RFM rules."""
    lines = silver.drop_repeats(silver.drop_noise(bronze)).withColumn(
        "line_amount", F.col("quantity") * F.col("price"))
    return silver.valid_purchase_rows(lines).agg(X.exact_sum("line_amount").alias("bronze_revenue"))


def rfm_reconciliation(rfm: DataFrame, lines: DataFrame, tolerance: float = REVENUE_TOLERANCE) -> DataFrame:
    """One row of totals and pass flags."""
    mart = rfm.groupBy("customer_id").agg(
        F.sum(X.units("monetary")).alias("amount"), F.count(F.lit(1)).alias("n"),
        X.count_if(F.col("segment").isNull()).alias("no_segment")).agg(
        X.from_units(F.coalesce(F.sum("amount"), F.lit(0))).alias("rfm_revenue"),
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("rfm_rows"),
        F.count(F.lit(1)).alias("rfm_customers"),
        F.coalesce(F.sum("no_segment"), F.lit(0)).cast("bigint").alias("null_segments"))
    both = mart.crossJoin(F.broadcast(eligible_totals(lines)))
    off = F.coalesce(F.abs(X.ratio(F.col("rfm_revenue") - F.col("eligible_revenue"), "eligible_revenue")), F.lit(0.0))
    return both.withColumns({
        "revenue_ok": off <= tolerance,
        "customers_ok": F.col("rfm_rows") == F.col("eligible_customers"),
        "unique_ok": F.col("rfm_rows") == F.col("rfm_customers"),
        "segments_ok": F.col("null_segments") == 0,
    })


def gold_summary(fact: DataFrame, rfm: DataFrame) -> DataFrame:
    """The numbers two builds of the gold layer must share."""
    f = fact.agg(F.count(F.lit(1)).alias("fact_rows"), X.count_if(F.col("customer_sk") == 0).alias("guest_rows"),
                 X.count_if(F.col("line_amount") < 0).alias("negative_rows"))
    m = rfm.agg(F.count(F.lit(1)).alias("rfm_customers"), X.exact_sum("monetary").alias("rfm_revenue"))
    return f.crossJoin(F.broadcast(m))


def parity(first: DataFrame, second: DataFrame, tolerance: float = REVENUE_TOLERANCE) -> DataFrame:
    """Compare two ``gold_summary`` rows, number by number; revenue may differ by the tolerance."""
    def long(df: DataFrame, name: str) -> DataFrame:
        return C.as_metrics(df, "gold").select("metric", F.col("value").alias(name))

    both = long(first, "first_value").join(F.broadcast(long(second, "second_value")), "metric")
    close = F.abs(F.col("second_value") - F.col("first_value")) <= F.abs(F.col("first_value")) * tolerance
    same = F.when(F.col("metric") == "rfm_revenue", close).otherwise(F.col("first_value") == F.col("second_value"))
    return both.withColumn("agrees", same)


def dimension_checks(lines: DataFrame, fact: DataFrame, customers: DataFrame, products: DataFrame,
                     countries: DataFrame, dates: DataFrame, scratch: Scratch) -> DataFrame:
    """Per dimension: members, distinct source values, repeated and missing keys in the fact. Every table is read once."""
    known = F.col("customer_id") != ""
    dims = {"dim_customer": (customers.filter(known), "customer_sk", fusion.Entry("customer_sk", known, value=F.col("customer_id"))),
            "dim_product": (products, "product_sk", fusion.Entry("product_sk", value=F.col("stock_code"))),
            "dim_country": (countries, "country_sk", fusion.Entry("country_sk", value=F.col("country"))),
            "dim_date": (dates, "date_sk", fusion.Entry("date_sk", value=F.col("tx_date")))}
    tally = fusion.Tally({
        "lines": (lines, [source for *_, source in dims.values()]),
        "fact": (fact, [fusion.Entry(sk, F.col(sk).isNull()) for _, sk, _ in dims.values()]),
        **{name: (dim, [fusion.Entry("members", value=F.col(sk))]) for name, (dim, sk, _) in dims.items()}}, scratch)
    rows = [(name, tally.rows(name, "members"), tally.distinct("lines", sk), tally.repeated(name, "members"), tally.rows("fact", sk))
            for name, (_, sk, _) in dims.items()]
    return lines.sparkSession.createDataFrame(rows, "dimension string, members bigint, source_values bigint, repeated_keys bigint, fact_nulls bigint")


def key_coverage(fact: DataFrame, scratch: Scratch, **dimensions: tuple[DataFrame, str]) -> DataFrame:
    """Per foreign key: orphan fact rows, and the share of dimension members the fact uses. The fact is read once."""
    tally = fusion.Tally({"fact": (fact, [fusion.key(sk) for _, sk in dimensions.values()]),
                          **{name: (dim, [fusion.key(sk)]) for name, (dim, sk) in dimensions.items()}}, scratch)
    found = tally.against([(("fact", sk), (name, sk)) for name, (_, sk) in dimensions.items()])
    rows = [(name, f["orphan_rows"], f["members"], f["used"]) for name, f in zip(dimensions, found, strict=True)]
    out = fact.sparkSession.createDataFrame(rows, "dimension string, orphans bigint, members bigint, in_fact bigint")
    return out.withColumn("coverage_pct", X.round_to(X.ratio(F.col("in_fact") * 100, "members"), 4))


# ---- feature checks ----------------------------------------------------------------------------------------

def feature_schema_issues(df: DataFrame, expected: list[str] | None = None) -> list[str]:
    """Missing, extra, misordered, non-numeric and NULL-holding feature columns."""
    expected = expected or schemas.FEATURE_COLUMNS
    issues = []
    missing = [c for c in expected if c not in df.columns]
    if missing:
        issues.append(f"missing features: {', '.join(missing)}")
    extra = [c for c in df.columns if c not in expected and c not in ("customer_id", "churn")]
    if extra:
        issues.append(f"unexpected features: {', '.join(extra)}")
    present = [c for c in df.columns if c in expected]
    if present and present != expected:
        issues.append("features are not in model order")
    for f in df.schema:
        if f.name in expected and f.dataType.simpleString().split("(")[0] not in (
                "double", "float", "int", "bigint", "smallint", "tinyint", "decimal"):
            issues.append(f"{f.name} is {f.dataType.simpleString()}, not a number")
    if present:
        nulls = df.agg(*[X.count_if(F.col(c).isNull()).alias(c) for c in present]).first()
        issues += [f"{c} has {nulls[c]} NULLs" for c in present if nulls[c]]
    return issues


def feature_rules() -> dict[str, object]:
    """Rule name to the condition of a bad row."""
    rules = {f"{c}: not 0 or 1": ~F.col(c).isin(0, 1) for c in schemas.BINARY_FEATURES}
    rules |= {f"{c}: negative": F.col(c) < 0 for c in schemas.NON_NEGATIVE_FEATURES}
    rules |= {f"{c}: outside 0..1": (F.col(c) < 0) | (F.col(c) > 1) for c in schemas.UNIT_INTERVAL_FEATURES}
    rules |= {f"{c}: outside 0..{top:g}": (F.col(c) < 0) | (F.col(c) > top)
              for c, top in schemas.CAPPED_FEATURES.items()}
    rules["frequency: below 1"] = F.col("frequency") < 1
    return rules


def feature_range_counts(df: DataFrame) -> DataFrame:
    """(rule, rows) with every rule counted in one pass."""
    rules = feature_rules()
    wide = df.agg(*[X.count_if(bad).alias(f"r{i}") for i, bad in enumerate(rules.values())])
    pairs = F.array(*[F.struct(F.lit(name).alias("rule"), F.col(f"r{i}").alias("rows")) for i, name in enumerate(rules)])
    return wide.select(F.inline(pairs))


def feature_matrix_report(df: DataFrame) -> dict:
    issues = feature_schema_issues(df)
    if not any(i.startswith("missing") for i in issues):
        issues += [f"{r['rule']} on {r['rows']} rows" for r in feature_range_counts(df).filter("rows > 0").collect()]
    return {"issues": issues, "passed": not issues}


QUARANTINE_RULES = {
    "unreadable_date": lambda: F.col("invoice_date").isNull(),
    "unreadable_quantity": lambda: F.col("quantity").isNull(),
    "unreadable_price": lambda: F.col("price").isNull(),
    "negative_price": lambda: F.col("price") < 0,
    "price_not_positive": lambda: X.is_noise(),
    "blank_invoice": lambda: X.is_guest("invoice"),
    "blank_stock_code": lambda: X.is_guest("stock_code"),
}


def quarantine(bronze: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Bronze rows that may go on, and rows held back with the reasons."""
    rules = {name: F.coalesce(rule(), F.lit(False)) for name, rule in QUARANTINE_RULES.items()}
    return C.split_valid_rejected(bronze, rules)


def split_unreadable(typed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with a date, a quantity and a price, and the others with all their reasons: what every form of loading keeps back."""
    broken = F.col("invoice_date").isNull() | F.col("quantity").isNull() | F.col("price").isNull()
    return typed.filter(~broken), quarantine(typed.filter(broken))[1]
