"""Invariants between and inside the layers. Each returns its violations; an empty frame means it holds."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline import schemas
from tallyline.functions import exprs as X
from tallyline.operators import checks as C
from tallyline.operators import fusion
from tallyline.plans import quality
from tallyline.sources.lake import Scratch


@dataclass(frozen=True)
class Tables:
    """The layer tables the invariants look at. Unused ones may be None."""

    bronze: DataFrame | None = None
    silver: DataFrame | None = None
    lines: DataFrame | None = None
    fact: DataFrame | None = None
    dim_customer: DataFrame | None = None
    dim_product: DataFrame | None = None
    dim_country: DataFrame | None = None
    dim_date: DataFrame | None = None
    rfm: DataFrame | None = None
    kpi: DataFrame | None = None
    features: DataFrame | None = None


def _count(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def _distinct(df: DataFrame, column: str | Column, name: str) -> DataFrame:
    return _count(df.select(column).distinct(), name)


def _is_true(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(False))


def _wrong_amount() -> Column:
    off = F.abs(F.col("line_amount") - F.col("quantity") * F.col("price")) > 0.001
    return off | _negative_without_cancel()


def _negative_without_cancel() -> Column:
    return (F.col("line_amount") < 0) & ~_is_true("is_cancellation")


def _sign_conflict() -> Column:
    cancelled = _is_true("is_cancellation")
    return ((F.col("quantity") < 0) & ~cancelled) | (cancelled & (F.col("quantity") >= 0))


def bronze_silver_counts(t: Tables) -> DataFrame:
    delta = quality.bronze_to_silver_delta(t.bronze).select(
        F.col("bronze_rows").alias("bronze_count"), F.col("after_dedup").alias("dedup_count"),
        F.col("expected_silver_rows").alias("expected_count"))
    both = delta.crossJoin(F.broadcast(_count(t.silver, "actual_count")))
    return both.filter("actual_count <> expected_count OR expected_count > bronze_count OR dedup_count > bronze_count")


def country_count(t: Tables) -> DataFrame:
    return C.count_mismatch(source_count=_distinct(t.silver, "country", "n"), dim_count=_count(t.dim_country, "n"))


def customer_count(t: Tables) -> DataFrame:
    return C.count_mismatch(source_count=_distinct(t.silver.filter("customer_id <> ''"), "customer_id", "n"),
                            dim_count=_count(t.dim_customer.filter("customer_id <> ''"), "n"))


def date_count(t: Tables) -> DataFrame:
    return C.count_mismatch(source_count=_distinct(t.silver, F.to_date("invoice_date").alias("d"), "n"),
                            dim_count=_count(t.dim_date, "n"))


def product_count(t: Tables) -> DataFrame:
    return C.count_mismatch(source_count=_distinct(t.silver, "stock_code", "n"), dim_count=_count(t.dim_product, "n"))


def guest_lines(t: Tables) -> DataFrame:
    return C.count_mismatch(source_count=_count(t.silver.filter("customer_id = ''"), "n"),
                            fact_count=_count(t.fact.filter("customer_sk = 0"), "n"))


# Row-level rules: (table, condition of a bad row, columns shown). One pass per table counts them all.

_FACT_MEASURES = ["transaction_sk", "quantity", "price", "line_amount", "is_cancellation"]
_LINE_MEASURES = ["invoice", "stock_code", "quantity", "price", "line_amount", "is_cancellation"]
_FACT_KEYS_AND_MEASURES = [c for c in schemas.FACT_COLUMNS if c != "is_cancellation"]
_CALENDAR = {"invoice_month": (1, 12), "invoice_day": (1, 31), "invoice_quarter": (1, 4), "invoice_day_of_week": (0, 6),
             "invoice_week": (1, 53)}


def _any(conditions: list[Column]) -> Column:
    bad = F.lit(False)
    for condition in conditions:
        bad = bad | F.coalesce(condition, F.lit(False))
    return bad


def _missing_key_or_measure() -> Column:
    return _any([F.col(c).isNull() for c in _FACT_KEYS_AND_MEASURES])


def _feature_out_of_range() -> Column:
    return _any([F.col("monetary") <= 0, *quality.feature_rules().values()])


def _kpi_out_of_bounds() -> Column:
    share = F.col("cancellation_order_rate")
    negative = [F.col(c) < 0 for c in ("revenue", "units_sold", "orders", "active_customers", "cancelled_orders", "aov")]
    return _any([F.col("line_count") <= 0, *negative, share < 0, share > 1])


def _calendar_out_of_range() -> Column:
    return _any([~F.col(c).between(low, high) for c, (low, high) in _CALENDAR.items()])


@dataclass(frozen=True)
class RowRule:
    table: str
    bad: Callable[[], Column]
    shown: list[str]

    def __call__(self, t: Tables) -> DataFrame:
        return getattr(t, self.table).filter(self.bad()).select(self.shown)


fact_amounts = RowRule("fact", _wrong_amount, _FACT_MEASURES)
fact_negative_amounts = RowRule("fact", _negative_without_cancel, _FACT_MEASURES)
fact_negative_prices = RowRule("fact", lambda: F.col("price") < 0, _FACT_MEASURES)
fact_nulls = RowRule("fact", _missing_key_or_measure, _FACT_KEYS_AND_MEASURES)
fact_signs = RowRule("fact", _sign_conflict, ["transaction_sk", "quantity", "line_amount", "is_cancellation"])
feature_ranges = RowRule("features", _feature_out_of_range, ["customer_id"])
kpi_bounds = RowRule("kpi", _kpi_out_of_bounds, ["year_month"])
silver_calendar = RowRule("silver", _calendar_out_of_range, ["invoice", "stock_code", "invoice_date", "invoice_year", *_CALENDAR])
silver_amounts = RowRule("silver", _wrong_amount, _LINE_MEASURES)
silver_signs = RowRule("silver", lambda: (F.col("price") < 0) | _sign_conflict(),
                       ["invoice", "stock_code", "quantity", "price", "is_cancellation"])
silver_prices = RowRule("silver", lambda: ~_is_true("is_cancellation") & (F.col("price") <= 0),
                        ["invoice", "stock_code", "quantity", "price", "is_cancellation"])
silver_month_keys = RowRule("silver", lambda: F.col("year_month") != X.year_month("invoice_date"),
                            ["invoice", "stock_code", "invoice_date", "year_month"])


def feature_customer_count(t: Tables) -> DataFrame:
    return C.count_mismatch(source_count=_distinct(t.lines.filter("is_valid_purchase"), "customer_id", "n"),
                            mart_count=_count(t.features, "n"))


def feature_orphans(t: Tables) -> DataFrame:
    return t.features.select("customer_id").join(t.dim_customer.select("customer_id"), "customer_id", "left_anti")


def kpi_customers(t: Tables) -> DataFrame:
    pairs = t.lines.filter("is_valid_purchase").select("year_month", "customer_id").distinct()
    source = pairs.groupBy("year_month").agg(F.count(F.lit(1)).alias("n"))
    return C.by_key_mismatch(source, t.kpi.select("year_month", "active_customers"), "year_month",
                             "source_customers", "mart_customers")


def kpi_revenue(t: Tables) -> DataFrame:
    """Exact comparison: revenue is added in whole units, so equal inputs give equal sums."""
    source = t.lines.filter("is_valid_purchase").groupBy("year_month").agg(X.exact_sum("line_amount").alias("v"))
    return C.by_key_mismatch(source, t.kpi.select("year_month", "revenue"), "year_month", "source_revenue",
                             "mart_revenue")


def rfm_orphans(t: Tables) -> DataFrame:
    return t.rfm.select("customer_id").join(t.dim_customer.select("customer_id"), "customer_id", "left_anti")


def bronze_silver_months(t: Tables) -> DataFrame:
    return C.by_key_mismatch(quality.expected_rows_by_month(t.bronze), quality.rows_by_month(t.silver), "year_month",
                             "expected_count", "actual_count")


def silver_fact_months(t: Tables) -> DataFrame:
    return C.by_key_mismatch(quality.rows_by_month(t.silver), quality.fact_rows_by_month(t.fact, t.dim_date),
                             "year_month", "stg_count", "fact_count")


def _revenue_gap(source: DataFrame, name: str, rfm: DataFrame) -> DataFrame:
    both = source.toDF(name).crossJoin(F.broadcast(rfm.agg(X.exact_sum("monetary").alias("rfm_revenue"))))
    off = F.abs(F.col("rfm_revenue") - F.col(name)) > F.col(name) * quality.REVENUE_TOLERANCE
    return both.filter((F.col(name) > 0) & off)


def rfm_revenue(t: Tables) -> DataFrame:
    source = t.lines.filter("is_valid_purchase").agg(X.exact_sum("line_amount"))
    return _revenue_gap(source, "stg_revenue", t.rfm)


def rfm_revenue_from_bronze(t: Tables) -> DataFrame:
    return _revenue_gap(quality.bronze_eligible_revenue(t.bronze), "bronze_revenue", t.rfm)


def rfm_covers_customers(t: Tables) -> DataFrame:
    per_segment = t.rfm.groupBy("segment").agg(F.count(F.lit(1)).alias("n"))
    totals = per_segment.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("segment_total"),
                             X.count_if(F.col("segment").isNull()).alias("null_segments"))
    eligible = _distinct(t.lines.filter("is_valid_purchase"), "customer_id", "eligible_count")
    one = _count(t.rfm, "mart_rows").crossJoin(F.broadcast(totals)).crossJoin(F.broadcast(eligible))
    return one.filter("mart_rows <> segment_total OR mart_rows <> eligible_count OR null_segments > 0")


_GRAIN = ["invoice", "stock_code", "description", "quantity", "price", "customer_id", "country", "is_cancellation",
          "invoice_date"]


def silver_repeats(t: Tables) -> DataFrame:
    return t.silver.groupBy(*_GRAIN).agg(F.count(F.lit(1)).alias("duplicate_count")).filter("duplicate_count > 1")


@dataclass(frozen=True)
class Invariant:
    check: Callable[[Tables], DataFrame]
    severity: str = "error"


INVARIANTS: dict[str, Invariant] = {
    "bronze_stg_reconciliation": Invariant(bronze_silver_counts),
    "dim_country_matches_stg_distinct": Invariant(country_count),
    "dim_customer_matches_stg_distinct": Invariant(customer_count),
    "dim_date_matches_stg_distinct_dates": Invariant(date_count),
    "dim_product_matches_stg_distinct": Invariant(product_count),
    "fact_guest_customer_sk": Invariant(guest_lines),
    "fact_line_amount_rules": Invariant(fact_amounts),
    "fact_negative_line_amount_rules": Invariant(fact_negative_amounts),
    "fact_negative_price": Invariant(fact_negative_prices),
    "fact_null_measures": Invariant(fact_nulls),
    "fact_quantity_cancellation_consistency": Invariant(fact_signs, "warning"),
    "features_customer_reconcile": Invariant(feature_customer_count),
    "features_customers_in_dim": Invariant(feature_orphans),
    "features_value_ranges": Invariant(feature_ranges),
    "kpi_active_customers_reconcile": Invariant(kpi_customers),
    "kpi_bounds": Invariant(kpi_bounds),
    "kpi_revenue_reconcile": Invariant(kpi_revenue),
    "mart_rfm_customers_in_dim": Invariant(rfm_orphans),
    "partition_bronze_stg_reconcile": Invariant(bronze_silver_months),
    "partition_fact_matches_stg": Invariant(silver_fact_months),
    "rfm_monetary_reconcile": Invariant(rfm_revenue),
    "rfm_monetary_reconcile_bronze": Invariant(rfm_revenue_from_bronze),
    "rfm_segment_covers_customer_base": Invariant(rfm_covers_customers),
    "stg_calendar_ranges": Invariant(silver_calendar),
    "stg_line_amount_rules": Invariant(silver_amounts),
    "stg_negative_qty_price_rules": Invariant(silver_signs, "warning"),
    "stg_no_duplicate_grain": Invariant(silver_repeats),
    "stg_non_cancel_positive_price": Invariant(silver_prices),
    "stg_year_month_matches_invoice_date": Invariant(silver_month_keys),
}


# Declared column checks: table, column, kind. ``relationships`` names the parent table and column.
COLUMN_CHECKS: list[tuple] = [
    *[("dim_customer", c, k) for c, k in (("customer_sk", "not_null"), ("customer_sk", "unique"), ("customer_id", "unique"))],
    *[("dim_product", c, k) for c in ("product_sk", "stock_code") for k in ("not_null", "unique")],
    *[("dim_country", c, k) for c in ("country_sk", "country_name") for k in ("not_null", "unique")],
    *[("dim_date", c, k) for c in ("date_sk", "date") for k in ("not_null", "unique")],
    ("dim_date", "year", "not_null"), ("dim_date", "month", "not_null"),
    ("fact", "transaction_sk", "not_null"), ("fact", "transaction_sk", "unique"), ("fact", "customer_sk", "not_null"),
    *[("fact", c, "not_null") for c in ("quantity", "price", "line_amount", "is_cancellation")],
    *[("fact", f"{d}_sk", "relationships", f"dim_{d}", f"{d}_sk") for d in ("customer", "product", "country", "date")],
    ("rfm", "customer_id", "not_null"), ("rfm", "customer_id", "unique"),
    ("rfm", "customer_id", "relationships", "dim_customer", "customer_id"),
    *[("rfm", c, "not_null") for c in ("recency_days", "frequency", "monetary", "r_score", "f_score", "m_score", "segment")],
    *[("rfm", c, "accepted_values", [1, 2, 3, 4, 5]) for c in ("r_score", "f_score", "m_score")],
    ("rfm", "segment", "accepted_values", X.SEGMENTS),
    ("kpi", "year_month", "not_null"), ("kpi", "year_month", "unique"),
    *[("kpi", c, "not_null") for c in ("revenue", "units_sold", "orders", "active_customers", "cancelled_orders",
                                       "cancellation_value", "net_revenue", "line_count")],
    ("features", "customer_id", "not_null"), ("features", "customer_id", "unique"),
    ("features", "customer_id", "relationships", "dim_customer", "customer_id"),
    *[("features", c, "not_null") for c in schemas.FEATURE_COLUMNS],
    *[("features", c, "accepted_values", [0, 1]) for c in schemas.BINARY_FEATURES],
    *[("silver", c, "not_null") for c in ("invoice", "stock_code", "invoice_date", "quantity", "price", "is_cancellation",
                                          "line_amount", "year_month", "customer_id")],
]


def column_check_counts(t: Tables, scratch: Scratch) -> DataFrame:
    """(table_name, column_name, kind, violations) for every declared column check: one pass over each table, one over the tally."""
    entries: dict[str, dict[str, fusion.Entry]] = {}

    def ask(table: str, entry: fusion.Entry) -> None:
        mine = entries.setdefault(table, {})
        if entry.name not in mine or mine[entry.name].repeats:
            mine[entry.name] = entry

    links = []
    for table, column, kind, *rest in COLUMN_CHECKS:
        if kind == "not_null":
            ask(table, fusion.Entry(f"{kind}|{column}", F.col(column).isNull()))
        elif kind == "accepted_values":
            ask(table, fusion.Entry(f"{kind}|{column}", ~F.col(column).isin(rest[0])))
        elif kind == "unique":
            ask(table, fusion.key(f"key|{column}", column, repeats=True))
        else:
            ask(table, fusion.key(f"key|{column}", column))
            ask(rest[0], fusion.key(f"key|{rest[1]}", rest[1]))
            links.append(((table, f"key|{column}"), (rest[0], f"key|{rest[1]}")))
    tally = fusion.Tally({table: (getattr(t, table), list(asked.values())) for table, asked in entries.items()}, scratch)
    orphans = dict(zip([child for child, _ in links], tally.against(links), strict=True))
    rows = []
    for table, column, kind, *_ in COLUMN_CHECKS:
        if kind == "unique":
            found = tally.repeated(table, f"key|{column}")
        elif kind == "relationships":
            found = orphans[table, f"key|{column}"]["orphan_values"]
        else:
            found = tally.rows(table, f"{kind}|{column}")
        rows.append((table, column, kind, int(found)))
    return t.fact.sparkSession.createDataFrame(rows, "table_name string, column_name string, kind string, violations bigint")


def _report_entries(t: Tables) -> dict[str, list[fusion.Entry]]:
    """What the invariants count of each table. ``lines`` are the rows of silver, so silver stands for both."""
    valid, known = X.is_valid_purchase(), F.col("customer_id") != ""
    month = F.col("year_month")
    rules: dict[str, list[fusion.Entry]] = {}
    for name, invariant in INVARIANTS.items():
        if isinstance(invariant.check, RowRule):
            rules.setdefault(invariant.check.table, []).append(fusion.Entry(f"rule|{name}", F.coalesce(invariant.check.bad(), F.lit(False))))
    own = {
        "silver": [
            fusion.Entry("rows", group=month), fusion.Entry("country", value=F.col("country")), fusion.Entry("stock_code", value=F.col("stock_code")),
            fusion.Entry("customer_id", known, value=F.col("customer_id")), fusion.Entry("date", value=F.to_date("invoice_date")),
            fusion.Entry("guests", F.col("customer_id") == ""), fusion.Entry("buyers", valid, value=F.col("customer_id")),
            fusion.Entry("month_buyers", valid, group=month, value=F.col("customer_id")),
            fusion.Entry("month_revenue", valid, group=month, units=X.units("line_amount")),
            fusion.Entry("grain", value=F.md5(F.to_json(F.struct(*_GRAIN), {"ignoreNullFields": "false"}).cast("binary")), repeats=True)],
        "fact": [fusion.Entry("guests", F.col("customer_sk") == 0), fusion.key("date_sk")],
        "dim_customer": [fusion.Entry("members", known), fusion.key("customer_id")],
        "dim_product": [fusion.Entry("members")], "dim_country": [fusion.Entry("members")],
        "dim_date": [fusion.Entry("members"), fusion.Entry("months", group=X.year_month("date"), value=F.col("date_sk"))],
        "rfm": [fusion.Entry("rows", units=X.units("monetary")), fusion.Entry("segments", group=F.col("segment")), fusion.key("customer_id")],
        "kpi": [fusion.Entry("months", group=month, units=F.col("active_customers")), fusion.Entry("revenue", group=month, units=X.units("revenue"))],
        "features": [fusion.Entry("rows"), fusion.key("customer_id")],
    }
    return {table: entries + rules.get(table, []) for table, entries in own.items()}


def _bronze_entries() -> list[fusion.Entry]:
    """Counted over groups of equal business records, so bronze is de-duplicated once."""
    amount = F.col("quantity") * F.col("price")
    buys = ~X.is_noise() & ~X.is_guest() & ~F.col("is_cancellation") & (amount > 0)
    return [fusion.Entry("records", units=F.col("_rows")), fusion.Entry("noise", X.is_noise()),
            fusion.Entry("expected", ~X.is_noise(), group=X.year_month("invoice_date")),
            fusion.Entry("revenue", F.coalesce(buys, F.lit(False)), units=X.units(amount))]


def validation_report(t: Tables, scratch: Scratch, skip: tuple[str, ...] = ()) -> DataFrame:
    """(rule, severity, violations) over all invariants. The layers pass when no error rule has violations.

    Violations are the rows the single checks return. Every table is read once; bronze is grouped once before.
    """
    groups = t.bronze.groupBy(*schemas.BUSINESS_COLUMNS).agg(F.count(F.lit(1)).alias("_rows"))
    tables = {name: (getattr(t, name), entries) for name, entries in _report_entries(t).items() if getattr(t, name) is not None}
    tally = fusion.Tally({"bronze": (groups, _bronze_entries()), **tables}, scratch)
    months = tally.by_group(("bronze", "expected"), ("silver", "rows"), ("silver", "month_buyers"), ("silver", "month_revenue"),
                            ("kpi", "months"), ("kpi", "revenue"), ("rfm", "segments"))
    features, rfm = tally.against([(("features", "customer_id"), ("dim_customer", "customer_id")), (("rfm", "customer_id"), ("dim_customer", "customer_id"))])

    def differ(*counts: int) -> int:
        return int(len(set(counts)) > 1)

    def month_gap(left: dict, at: int, right: dict, to: int) -> int:
        missing = (0, 0, 0)
        return sum(left.get(m, missing)[at] != right.get(m, missing)[to] or m is None for m in {*left, *right})

    def fact_months() -> dict:
        days = tally.rows_.filter("table_name = 'fact' AND name = 'date_sk'").select("value", F.col("rows").alias("n"))
        dates = tally.rows_.filter("table_name = 'dim_date' AND name = 'months'").select("value", "grp")
        return {r["grp"]: (r["n"], 0, 0) for r in days.join(dates, "value").groupBy("grp").agg(F.sum("n").alias("n")).collect()}

    def revenue_gap(source: int) -> int:
        return int(source > 0 and abs(tally.units("rfm", "rows") - source) > source * quality.REVENUE_TOLERANCE)

    expected = tally.rows("bronze", "records") - tally.rows("bronze", "noise")
    bronze_rows, dedup = tally.units("bronze", "records"), tally.rows("bronze", "records")
    segments = months["rfm", "segments"]
    found = {
        "bronze_stg_reconciliation": int(tally.rows("silver", "rows") != expected or expected > bronze_rows or dedup > bronze_rows),
        "dim_country_matches_stg_distinct": differ(tally.distinct("silver", "country"), tally.rows("dim_country", "members")),
        "dim_customer_matches_stg_distinct": differ(tally.distinct("silver", "customer_id"), tally.rows("dim_customer", "members")),
        "dim_date_matches_stg_distinct_dates": differ(tally.distinct("silver", "date"), tally.rows("dim_date", "members")),
        "dim_product_matches_stg_distinct": differ(tally.distinct("silver", "stock_code"), tally.rows("dim_product", "members")),
        "fact_guest_customer_sk": differ(tally.rows("silver", "guests"), tally.rows("fact", "guests")),
        "features_customer_reconcile": differ(tally.distinct("silver", "buyers"), tally.rows("features", "rows")),
        "features_customers_in_dim": features["orphan_rows"], "mart_rfm_customers_in_dim": rfm["orphan_rows"],
        "kpi_active_customers_reconcile": month_gap(months["silver", "month_buyers"], 1, months["kpi", "months"], 2),
        "kpi_revenue_reconcile": month_gap(months["silver", "month_revenue"], 2, months["kpi", "revenue"], 2),
        "partition_bronze_stg_reconcile": month_gap(months["bronze", "expected"], 0, months["silver", "rows"], 0),
        "partition_fact_matches_stg": month_gap(months["silver", "rows"], 0, fact_months(), 0),
        "rfm_monetary_reconcile": revenue_gap(sum(u for _, _, u in months["silver", "month_revenue"].values())),
        "rfm_monetary_reconcile_bronze": revenue_gap(tally.units("bronze", "revenue")),
        "rfm_segment_covers_customer_base": int(None in segments or differ(
            tally.rows("rfm", "rows"), sum(n for n, _, _ in segments.values()), tally.distinct("silver", "buyers"))),
        "stg_no_duplicate_grain": tally.repeated("silver", "grain"),
    }
    rows = [(name, invariant.severity, int(found[name] if name in found else tally.rows(invariant.check.table, f"rule|{name}")))
            for name, invariant in INVARIANTS.items() if name not in skip]
    return t.fact.sparkSession.createDataFrame(rows, "rule string, severity string, violations bigint")


def passed(report: DataFrame) -> bool:
    return report.filter("severity = 'error' AND violations > 0").limit(1).count() == 0
