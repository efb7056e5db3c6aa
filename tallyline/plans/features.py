"""The 32 customer features, the 90-day churn label and the model matrix."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.functions import exprs as X
from tallyline.operators.gaps import event_gaps
from tallyline.plans.marts import invoice_rollup
from tallyline.schemas import FEATURE_COLUMNS

EVALUATION_DAYS = 90
KEYS = ["as_of", "customer_id"]
HOME_COUNTRY = "United Kingdom"


def _ntz(value: datetime) -> Column:
    """A zone-less literal; it goes through text so that no session or machine zone can shift it."""
    return F.lit(value.replace(tzinfo=None).isoformat(sep=" ")).cast("timestamp_ntz")


def as_of_bounds(lines: DataFrame, as_of: datetime | None = None) -> tuple[datetime, datetime]:
    """(observation end, first valid purchase up to it). One row leaves the cluster; both bounds become literals."""
    seen = lines if as_of is None else lines.filter(F.col("invoice_date") <= _ntz(as_of))
    row = seen.agg(F.max("invoice_date").alias("last"),
                   F.min(F.when(F.col("is_valid_purchase"), F.col("invoice_date"))).alias("first_valid")).first()
    if row["first_valid"] is None:
        raise ValueError("no customer purchase up to the observation end")
    return (as_of or row["last"]), row["first_valid"]


def _midpoint(first: datetime, last: datetime) -> datetime:
    return first + timedelta(microseconds=((last - first) // timedelta(microseconds=1)) // 2)


def at_dates(df: DataFrame, dates: list[tuple[datetime, datetime]], at: str = "invoice_date") -> DataFrame:
    """Each row once for every (as_of, middle) whose ``as_of`` it lies before; copies are made inside the tasks."""
    if len(dates) == 1:
        (as_of, middle), = dates
        return df.filter(F.col(at) <= _ntz(as_of)).withColumns({"as_of": _ntz(as_of), "middle": _ntz(middle)})
    pairs = F.array(*[F.struct(_ntz(d).alias("as_of"), _ntz(m).alias("middle")) for d, m in dates])
    return df.select("*", F.inline(F.filter(pairs, lambda d: d["as_of"] >= F.col(at))))


def _before(days: int) -> Column:
    return F.col("as_of") - F.make_dt_interval(F.lit(days))


def _per_invoice(rollup: DataFrame) -> DataFrame:
    """(date, customer, invoice) grain with the time windows applied."""
    def valid_since(days: int) -> Column:
        return F.col("has_valid") & (F.col("invoice_date") >= _before(days))

    def amount(when: Column) -> Column:
        return F.sum(F.when(when, F.col("valid_amount")).otherwise(F.lit(0).cast("bigint")))

    valid_at = F.when(F.col("has_valid"), F.col("invoice_date"))
    return rollup.groupBy(*KEYS, "invoice").agg(
        F.max("has_valid").alias("valid"), F.max("has_cancelled").alias("cancelled"),
        F.min(valid_at).alias("first_at"), F.max(valid_at).alias("last_at"),
        F.sum("valid_amount").alias("amount"), F.sum("valid_quantity").alias("quantity"),
        F.max(valid_since(30)).alias("in_30d"), F.max(valid_since(90)).alias("in_90d"),
        F.max(valid_since(180)).alias("in_180d"), amount(valid_since(90)).alias("amount_90d"),
        amount(F.col("invoice_date") < F.col("middle")).alias("amount_first_half"),
        amount(F.col("invoice_date") >= F.col("middle")).alias("amount_second_half"),
        F.sum("quantity_out").alias("quantity_out"), F.sum("quantity_back").alias("quantity_back"),
        F.max("at_home").alias("at_home"), F.max("before_home").alias("before_home"),
    )


def _customer_base(invoices: DataFrame) -> DataFrame:
    valid = F.col("valid")
    return invoices.groupBy(*KEYS).agg(
        F.min("first_at").alias("first_purchase"), F.max("last_at").alias("last_purchase"),
        X.count_if(valid).alias("frequency"), F.sum("amount").alias("amount"), F.sum("quantity").alias("quantity"),
        X.count_if(F.col("in_30d")).alias("frequency_last_30d"), X.count_if(F.col("in_90d")).alias("frequency_last_90d"),
        X.count_if(F.col("in_180d")).alias("frequency_last_180d"), F.sum("amount_90d").alias("amount_90d"),
        F.sum("amount_first_half").alias("amount_first_half"), F.sum("amount_second_half").alias("amount_second_half"),
        F.count(F.lit(1)).alias("invoices"), X.count_if(F.col("cancelled")).alias("cancelled_invoices"),
        F.sum("quantity_out").alias("quantity_out"), F.sum("quantity_back").alias("quantity_back"),
        F.max(F.when(valid, F.col("amount"))).alias("largest_order"),
        F.min(F.when(valid, F.col("amount"))).alias("smallest_order"),
        F.max("at_home").alias("at_home"), F.max("before_home").alias("before_home"),
    ).filter(F.col("frequency") >= 1)


def _each(dates: list[tuple[datetime, datetime]], at: str, **values: Callable[[Column, Column], Column]) -> list[Column]:
    """A column ``name_i`` of ``values(seen, as_of)`` for each date, where ``seen`` tells the rows known by then: no row is copied."""
    return [f(F.col(at) <= _ntz(d), _ntz(d)).alias(f"{name}_{i}") for i, (d, _) in enumerate(dates) for name, f in values.items()]


def _order_rhythm(rollup: DataFrame, gap_scope: str, dates: list[tuple[datetime, datetime]]) -> tuple[DataFrame, DataFrame]:
    """Gap statistics and weekend share over a customer's invoices (``valid`` ones, or ``all`` of them), a column for each date.

    The gap before an invoice does not depend on what comes later, so gaps are found once for all dates.
    """
    scoped = rollup.filter("has_valid") if gap_scope == "valid" else rollup
    dated = scoped.groupBy("customer_id", "invoice").agg(F.min("invoice_date").alias("at"))
    gap = F.col("gap_us")
    gaps = event_gaps(dated, "customer_id", "at", "invoice").groupBy("customer_id").agg(*_each(
        dates, "at",
        avg_gap=lambda seen, _: X.ratio(X.ratio(F.sum(F.when(seen, gap)), F.count(F.when(seen, gap))), F.lit(X.MICROS_PER_DAY)),
        std_gap=lambda seen, _: F.stddev_samp(F.when(seen, gap / float(X.MICROS_PER_DAY)))))
    weekend = dated.groupBy("customer_id").agg(*_each(
        dates, "at", weekend_purchase_ratio=lambda seen, _: X.ratio(X.count_if(seen & (F.weekday("at") >= 5)), X.count_if(seen))))
    return gaps, weekend


def least_squares_slope(x: Column, y_units: Column, when: Column | None = None) -> Column:
    """Slope of whole-number points, added up as integers so that it does not depend on the order of merging."""
    def wide(agg: Column) -> Column:
        return agg.cast("decimal(19,0)")

    def total(value: Column) -> Column:
        return F.sum(value if when is None else F.when(when, value))

    n, sx, sy = F.count(F.lit(1)) if when is None else X.count_if(when), total(x), total(y_units)
    rise = wide(n) * wide(total(x * y_units)) - wide(sx) * wide(sy)
    run = wide(n) * wide(total(x * x)) - wide(sx) * wide(sx)
    return X.safe_divide(rise.cast("double"), run.cast("double") * float(X.MONEY_SCALE))


def _monthly_trend(rollup: DataFrame, dates: list[tuple[datetime, datetime]]) -> DataFrame:
    """Least-squares slope of monthly spend, a column for each date; 0 for fewer than two months."""
    month = (X.month_index("invoice_date") - 2000 * 12).cast("bigint")
    monthly = rollup.filter("has_valid").groupBy("customer_id", month.alias("m")).agg(*_each(
        dates, "invoice_date", amount=lambda seen, _: F.sum(F.when(seen, F.col("valid_amount"))), seen=lambda seen, _: F.max(seen)))
    return monthly.groupBy("customer_id").agg(*[
        least_squares_slope(F.col("m"), F.col(f"amount_{i}"), F.col(f"seen_{i}")).alias(f"monetary_trend_{i}") for i in range(len(dates))])


def _product_breadth(lines: DataFrame, dates: list[tuple[datetime, datetime]]) -> DataFrame:
    per_product = lines.filter("is_valid_purchase").groupBy("customer_id", "stock_code").agg(*_each(
        dates, "invoice_date", seen=lambda seen, _: F.max(seen),
        recent=lambda seen, as_of: F.max(seen & (F.col("invoice_date") >= as_of - F.make_dt_interval(F.lit(90))))))
    return per_product.groupBy("customer_id").agg(*[X.count_if(F.col(f"{flag}_{i}")).alias(f"{name}_{i}") for i in range(len(dates))
                                                    for name, flag in (("unique_products", "seen"), ("unique_products_90d", "recent"))])


def mart_features(lines: DataFrame, as_of: datetime | None = None, gap_scope: str = "valid",
                  home_country: str = HOME_COUNTRY, rollup: DataFrame | None = None) -> DataFrame:
    """One row per customer with a valid purchase up to ``as_of`` (default: newest line of any customer).

    Guests are dropped before any customer shuffle. ``rollup`` is the written ``invoice_rollup`` if there is one.
    """
    obs, first_valid = as_of_bounds(lines, as_of)
    return _features(lines, [(obs, first_valid)], gap_scope, home_country, rollup).drop("as_of")


def features_at(lines: DataFrame, dates: list[datetime], gap_scope: str = "valid", home_country: str = HOME_COUNTRY,
                rollup: DataFrame | None = None) -> DataFrame:
    """(as_of, customer_id, features): the feature table as it was on each of ``dates``, in one job.

    A date before the first valid purchase has no rows. Line copies are bounded by the number of dates.
    """
    _, first_valid = as_of_bounds(lines)
    return _features(lines, [(d, first_valid) for d in sorted(set(dates)) if d >= first_valid], gap_scope, home_country, rollup)


def _features(lines: DataFrame, bounds: list[tuple[datetime, datetime]], gap_scope: str, home_country: str, rollup: DataFrame | None) -> DataFrame:
    if gap_scope not in ("valid", "all"):
        raise ValueError("gap_scope must be 'valid' or 'all'")
    if not bounds:
        raise ValueError("no customer purchase up to any of the dates")
    dates = [(d, _midpoint(first, d)) for d, first in bounds]
    seen = (F.col("customer_id") != "") & (F.col("invoice_date") <= _ntz(max(d for d, _ in dates)))
    known = lines.filter(seen)
    rolled = invoice_rollup(known) if rollup is None else rollup.filter(seen)
    # min(country) is the home country where one is and none comes before it; flags are grouped by hashing, texts by sorting
    placed = rolled.withColumns({"at_home": F.col("country") == home_country, "before_home": F.col("country") < home_country})
    if len(dates) > 1:  # the copies for the dates are made where an invoice's rows already are
        placed = placed.repartition("customer_id", "invoice")
    wide = _customer_base(_per_invoice(at_dates(placed, dates)))
    gaps, sides = _order_rhythm(rolled, gap_scope, dates)  # the weekend share is there for every customer of ``wide``
    for side in (gaps, _monthly_trend(rolled, dates), _product_breadth(known, dates)):
        sides = sides.join(side, "customer_id", "left")
    names = ["avg_gap", "std_gap", "weekend_purchase_ratio", "monetary_trend", "unique_products", "unique_products_90d"]
    sides = sides.select("customer_id", F.inline(F.array(*[
        F.struct(_ntz(d).alias("as_of"), *[F.col(f"{n}_{i}").alias(n) for n in names]) for i, (d, _) in enumerate(dates)])))
    wide = wide.join(sides, KEYS, "left")

    recency = X.days_between("last_purchase", F.col("as_of"))
    money = wide.select(
        "*", recency.alias("recency_days"), X.from_units("amount").alias("monetary"),
        X.from_units("amount_90d").alias("monetary_last_90d"), X.from_units("quantity").alias("total_quantity"),
        F.coalesce("avg_gap", recency.cast("double")).alias("avg_days_between_orders"),
        F.coalesce("std_gap", F.lit(0.0)).alias("std_days_between_orders"),
        X.as_int(F.col("frequency") == 1).alias("is_one_time_buyer"))
    features = money.withColumns({
        "avg_order_value": X.safe_divide("monetary", "frequency"),
        "avg_basket_size": X.safe_divide("total_quantity", "frequency"),
        "avg_unit_price": X.safe_divide("monetary", "total_quantity"),
        "tenure_days": X.days_between("first_purchase", "last_purchase"),
        "days_since_first_purchase": X.days_between("first_purchase", F.col("as_of")),
        "cancellation_rate": X.safe_divide("cancelled_invoices", "invoices"),
        "return_quantity_rate": X.at_most(X.safe_divide("quantity_back", "quantity_out"), 1.0),
        "weekend_purchase_ratio": F.coalesce("weekend_purchase_ratio", F.lit(0.0)),
        "monetary_trend": F.coalesce("monetary_trend", F.lit(0.0)),
        "max_single_order_value": X.from_units("largest_order"),
        "min_single_order_value": X.from_units("smallest_order"),
        "ratio_frequency_90d": X.safe_divide("frequency_last_90d", "frequency"),
        "velocity_ratio_180d": X.safe_divide("frequency_last_180d", "frequency"),
        "spending_recency_ratio": X.safe_divide("monetary_last_90d", "monetary"),
        "velocity_ratio_30d_90d": X.safe_divide("frequency_last_30d", F.col("frequency_last_90d") + 1),
        "overdue_ratio": X.at_most(X.safe_divide("recency_days", "avg_days_between_orders"), 10.0),
        "purchase_regularity": X.at_most(X.safe_divide("std_days_between_orders", "avg_days_between_orders"), 5.0),
        "recency_one_time": F.col("recency_days") * F.col("is_one_time_buyer"),
        "product_diversity_trend": X.safe_divide("unique_products_90d", "unique_products"),
        "monetary_acceleration": X.at_most(X.safe_divide(
            X.from_units("amount_second_half"), X.from_units("amount_first_half") + 1), 20.0),
        "is_uk": X.as_int(F.col("at_home") & ~F.col("before_home")),
    })
    return features.select(*KEYS, *FEATURE_COLUMNS)


def churn_labels(lines: DataFrame, observation_end: datetime) -> DataFrame:
    """1 for customers seen up to the observation end who never come back with a non-cancelled line."""
    known = lines.filter(~X.is_guest())
    end = _ntz(observation_end)
    per_customer = known.groupBy("customer_id").agg(
        F.max(F.col("invoice_date") <= end).alias("seen"),
        F.max((F.col("invoice_date") > end) & ~F.col("is_cancellation")).alias("came_back"))
    return per_customer.filter("seen").select("customer_id", X.as_int(~F.col("came_back")).alias("churn"))


def training_cutoff(lines: DataFrame) -> datetime:
    return lines.agg(F.max("invoice_date")).first()[0] - timedelta(days=EVALUATION_DAYS)


def feature_matrix(lines: DataFrame, mode: str = "train", observation_end: datetime | None = None, **options) -> DataFrame:
    """Features as of the newest line (``score``), or 90 days earlier with the churn label (``train``)."""
    if mode == "score":
        return mart_features(lines, observation_end, **options)
    if mode != "train":
        raise ValueError("mode must be 'train' or 'score'")
    end = observation_end or training_cutoff(lines)
    return mart_features(lines, end, **options).join(churn_labels(lines, end), "customer_id")
