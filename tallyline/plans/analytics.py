"""Business queries over the star schema and the marts.

Facts are aggregated to the key a question needs before any dimension is joined, so joins move small tables.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.functions import exprs as X
from tallyline.operators.distinct import with_distinct_counts
from tallyline.operators.ordering import global_running_sum
from tallyline.operators.quantiles import exact_quantiles, long_values
from tallyline.operators.skew import broadcast_if_small
from tallyline.sources.lake import Scratch

CHURN_DAYS = 90


def _n() -> Column:
    return F.count(F.lit(1))


def _mean(column: str, digits: int) -> Column:
    """Mean of an exactly summed column."""
    return X.round_to(X.ratio(X.exact_sum(column), F.count(column)), digits)


def _percent(part: Column | str, whole: Column | str, digits: int) -> Column:
    return X.round_to(X.ratio(X.col(part) * 100, whole), digits)


def with_total(df: DataFrame, column: str, name: str = "grand_total") -> DataFrame:
    """Attach the sum of a whole-number column over all rows: a one-row total, not an unpartitioned window."""
    total = df.agg(F.sum(column).alias(name))
    return df.crossJoin(F.broadcast(total))


# ---- segments ----------------------------------------------------------------------------------------------

def segment_summary(rfm: DataFrame) -> DataFrame:
    per = rfm.groupBy("segment").agg(
        _n().alias("customers"), _mean("recency_days", 1).alias("avg_recency_days"),
        _mean("frequency", 1).alias("avg_frequency"), _mean("monetary", 2).alias("avg_monetary"),
        F.sum(X.units("monetary")).alias("amount"))
    return with_total(per, "amount").select(
        "segment", "customers", "avg_recency_days", "avg_frequency", "avg_monetary",
        X.round_to(X.from_units("amount"), 2).alias("total_monetary"),
        _percent(X.from_units("amount"), X.from_units("grand_total"), 1).alias("pct_revenue"))


def segment_distribution(rfm: DataFrame, scratch: Scratch) -> DataFrame:
    """Members, share of members, median spend and share of revenue per segment."""
    per = rfm.groupBy("segment").agg(_n().alias("customers"), F.sum(X.units("monetary")).alias("amount"))
    median = exact_quantiles(rfm, ["segment"], "monetary", {"median_monetary": 0.5}, scratch).drop("n")
    both = with_total(with_total(per, "customers", "all_customers"), "amount", "all_amount").join(median, "segment")
    return both.select("segment", "customers", _percent("customers", "all_customers", 1).alias("pct_customers"),
                       X.round_to("median_monetary", 2).alias("median_monetary"),
                       _percent(X.from_units("amount"), X.from_units("all_amount"), 1).alias("pct_revenue"))


def top_segments_share(rfm: DataFrame, n: int = 3) -> DataFrame:
    per = rfm.groupBy("segment").agg(F.sum(X.units("monetary")).alias("amount"))
    top = per.orderBy(F.desc("amount"), "segment").limit(n).agg(F.sum("amount").alias("top_amount"))
    return top.crossJoin(F.broadcast(per.agg(F.sum("amount").alias("all_amount")))).select(
        _percent(X.from_units("top_amount"), X.from_units("all_amount"), 1).alias("top_share_pct"))


def churn_by_segment(rfm: DataFrame) -> DataFrame:
    churned = X.count_if(F.col("recency_days") > CHURN_DAYS)
    return rfm.groupBy("segment").agg(_n().alias("total"), churned.alias("churned"),
                                      _percent(churned, _n(), 1).alias("churn_rate_pct"),
                                      _mean("monetary", 2).alias("avg_monetary"))


def score_matrix(rfm: DataFrame) -> DataFrame:
    """Customers per (r, f) pair, one column per f score."""
    pivoted = rfm.groupBy("r_score").pivot("f_score", [1, 2, 3, 4, 5]).agg(_n())
    return pivoted.select("r_score", *[F.coalesce(F.col(str(f)), F.lit(0).cast("bigint")).alias(f"f{f}") for f in range(1, 6)])


def survival_curve(rfm: DataFrame, last: int = 730, step: int = 30) -> DataFrame:
    """Share of customers whose last purchase is at most T days ago, all T in one pass."""
    days = list(range(0, last + 1, step))
    one = rfm.agg(_n().alias("n"), *[X.count_if(F.col("recency_days") <= d).alias(f"d{d}") for d in days])
    rows = F.array(*[F.struct(F.lit(d).alias("days"), F.col(f"d{d}").alias("customers")) for d in days])
    return one.select("n", F.inline(rows)).select("days", "customers", _percent("customers", "n", 4).alias("survival_pct"))


# ---- fact and dimensions -----------------------------------------------------------------------------------

def monthly_revenue_trend(fact: DataFrame, dates: DataFrame) -> DataFrame:
    per = fact.filter("line_amount > 0").groupBy("date_sk", "customer_sk").agg(
        _n().alias("lines"), F.sum(X.units("line_amount")).alias("amount"))
    dated = per.join(broadcast_if_small(dates.select("date_sk", "year", "month")), "date_sk")
    month = dated.groupBy("year", "month").agg(
        F.sum("lines").alias("transactions"), F.count_distinct("customer_sk").alias("unique_customers"),
        F.sum("amount").alias("amount"))
    revenue = X.from_units("amount")
    return month.select("year", "month", "transactions", "unique_customers", X.round_to(revenue, 2).alias("revenue"),
                        X.round_to(X.ratio(revenue, "transactions"), 2).alias("avg_line_value"))


def top_products(fact: DataFrame, products: DataFrame, n: int = 10) -> DataFrame:
    per = fact.filter("line_amount > 0").groupBy("product_sk").agg(
        _n().alias("times_sold"), F.sum(X.units("quantity")).alias("quantity"), F.sum(X.units("line_amount")).alias("amount"))
    total = per.agg(F.sum("amount").alias("grand_total"))
    named = per.join(products, "product_sk").orderBy(F.desc("amount"), "stock_code").limit(n)
    return named.crossJoin(F.broadcast(total)).select(
        "stock_code", "description", "times_sold", X.round_to(X.from_units("quantity"), 0).alias("total_quantity"),
        X.round_to(X.from_units("amount"), 2).alias("total_revenue"),
        _percent(X.from_units("amount"), X.from_units("grand_total"), 2).alias("pct_revenue"))


def top_countries(fact: DataFrame, countries: DataFrame, n: int = 10) -> DataFrame:
    per = fact.filter("line_amount > 0").groupBy("country_sk").agg(
        _n().alias("transactions"), F.sum(X.units("line_amount")).alias("amount"))
    named = with_total(per, "amount").join(broadcast_if_small(countries), "country_sk")
    return named.orderBy(F.desc("amount"), "country_name").limit(n).select(
        "country_name", "transactions", X.round_to(X.from_units("amount"), 2).alias("revenue"),
        _percent(X.from_units("amount"), X.from_units("grand_total"), 1).alias("pct"))


def segment_revenue_by_quarter(fact: DataFrame, customers: DataFrame, dates: DataFrame) -> DataFrame:
    per = fact.filter("line_amount > 0 AND customer_sk <> 0").groupBy("customer_sk", "date_sk").agg(
        F.sum(X.units("line_amount")).alias("amount"))
    quarter = per.join(broadcast_if_small(dates.select("date_sk", "year", "quarter")), "date_sk").groupBy(
        "customer_sk", "year", "quarter").agg(F.sum("amount").alias("amount"))
    return quarter.join(customers.select("customer_sk", "segment"), "customer_sk").groupBy(
        "segment", "year", "quarter").agg(X.round_to(X.from_units(F.sum("amount")), 2).alias("revenue"))


def largest_lines_with_dimensions(fact: DataFrame, customers: DataFrame, products: DataFrame, countries: DataFrame,
                                  dates: DataFrame, scratch: Scratch, n: int = 15) -> DataFrame:
    """The n largest lines with everything known about them: the fact is read once for them, then they meet the dimensions."""
    top = scratch.write(fact.orderBy(F.desc("line_amount"), "transaction_sk").limit(n))
    out = top
    for dim, key in ((customers.withColumnRenamed("segment", "customer_segment"), "customer_sk"), (products, "product_sk"),
                     (countries, "country_sk"), (dates.withColumnRenamed("date", "invoice_date"), "date_sk")):
        wanted = dim.join(F.broadcast(top.select(key).distinct()), key, "left_semi")
        out = out.join(F.broadcast(wanted), key, "left")
    return out.select("transaction_sk", "customer_id", "customer_segment", "stock_code", "description", "country_name",
                      "invoice_date", "year", "quarter", "quantity", "price", "line_amount")


# ---- cohorts -----------------------------------------------------------------------------------------------

def cohort_activity(fact: DataFrame, customers: DataFrame, dates: DataFrame) -> DataFrame:
    """(cohort month, age in months): active customers, revenue, cohort size and retention."""
    per_day = fact.filter("customer_sk <> 0").groupBy("customer_sk", "date_sk").agg(
        F.sum(X.units("line_amount")).alias("amount"))
    per_month = per_day.join(broadcast_if_small(dates.select("date_sk", X.month_index("date").alias("m"))), "date_sk").groupBy(
        "customer_sk", "m").agg(F.sum("amount").alias("amount"))
    first = customers.filter("customer_sk <> 0").select(
        "customer_sk", X.month_index("first_seen_date").alias("c"), X.year_month("first_seen_date").alias("cohort_month"))
    active = per_month.join(first, "customer_sk").groupBy("cohort_month", (F.col("m") - F.col("c")).alias("cohort_age")).agg(
        _n().alias("n_customers"), F.sum("amount").alias("amount"))
    size = active.filter("cohort_age = 0").select("cohort_month", F.col("n_customers").alias("cohort_size"))
    return active.join(size, "cohort_month").select(
        "cohort_month", "cohort_age", "n_customers", X.from_units("amount").alias("revenue"), "cohort_size",
        _percent("n_customers", "cohort_size", 4).alias("retention_pct"))


def cohort_matrix(activity: DataFrame, value: str = "retention_pct") -> DataFrame:
    """One column m<age> for every age that occurs; ages are months, so there are at most as many as months of data."""
    ages = sorted(r["cohort_age"] for r in activity.select("cohort_age").distinct().collect())
    pivoted = activity.groupBy("cohort_month").pivot("cohort_age", ages).agg(F.max(value))
    return pivoted.select("cohort_month", *[F.col(str(a)).alias(f"m{a}") for a in ages])


def cohort_cells(activity: DataFrame, value: str = "retention_pct") -> DataFrame:
    """(cohort_month, cells): the same matrix with one array of (age, value) a cohort, so the schema does not grow with the months."""
    cell = F.struct(F.col("cohort_age").alias("age"), F.col(value).alias("value"))
    return activity.groupBy("cohort_month").agg(F.sort_array(F.collect_list(cell)).alias("cells"))


def retention_curve(activity: DataFrame) -> DataFrame:
    """Mean retention over the cohorts that reach each age."""
    return activity.groupBy("cohort_age").agg(
        _n().alias("cohorts"), X.round_to(X.ratio(X.exact_sum("retention_pct"), _n()), 4).alias("avg_retention_pct"))


def retention_milestones(activity: DataFrame, months: tuple[int, ...] = (1, 3, 6, 12)) -> DataFrame:
    return retention_curve(activity.filter(F.col("cohort_age").isin(*months)))


def churn_by_cohort(rfm: DataFrame, customers: DataFrame) -> DataFrame:
    churned = X.count_if(F.col("recency_days") > CHURN_DAYS)
    joined = rfm.select("customer_id", "recency_days").join(
        customers.select("customer_id", X.year_month("first_seen_date").alias("cohort_month")), "customer_id", "left")
    return joined.groupBy("cohort_month").agg(_n().alias("total"), churned.alias("churned"),
                                              _percent(churned, _n(), 1).alias("churn_rate_pct"))


# ---- concentration -----------------------------------------------------------------------------------------

def revenue_by(lines: DataFrame, key: str) -> DataFrame:
    """Net revenue in whole units per key, positive totals only."""
    per = lines.groupBy(key).agg(F.sum(X.units(F.col("quantity") * F.col("price"))).alias("amount"))
    return per.filter(F.col("amount") > 0)


def pareto(lines: DataFrame, key: str, scratch: Scratch) -> DataFrame:
    """Members by falling revenue with their rank and cumulative share."""
    running = global_running_sum(revenue_by(lines, key), [F.desc("amount"), F.asc(key)], {"running": "amount"}, scratch, "rank")
    total = running.agg(F.max("running").alias("total"), F.max("rank").alias("members"))
    return running.crossJoin(F.broadcast(total)).select(
        key, "rank", "amount", "running", "total", "members", X.round_to(X.ratio("running", "total"), 6).alias("cum_share"))


def members_for_share(ranked: DataFrame, percents: tuple[int, ...] = (50, 80)) -> DataFrame:
    """How many top members it takes to reach each share of revenue."""
    one = ranked.agg(F.max("members").alias("members"), *[
        X.count_if(F.col("running") * 100 <= F.col("total") * p).alias(f"p{p}") for p in percents])
    rows = F.array(*[F.struct(F.lit(p).alias("percent"), (F.col(f"p{p}") + 1).alias("members_needed")) for p in percents])
    return one.select("members", F.inline(rows)).select(
        "percent", "members_needed", X.round_to(X.ratio("members_needed", "members"), 4).alias("share_of_members"))


def top_percent_share(lines: DataFrame, scratch: Scratch, percents: tuple[int, ...] = (1, 5, 10)) -> DataFrame:
    """Share of revenue in the top x % of purchase lines.

    Lines are counted per distinct amount first. The n-th line falls into one group of equal amounts, of which only
    the part up to n counts.
    """
    groups = lines.filter(~F.col("is_cancellation")).groupBy(X.units("line_amount").alias("unit")).agg(_n().alias("rows"))
    groups = groups.withColumn("amount", F.col("unit") * F.col("rows"))
    run = global_running_sum(groups, [F.desc("unit")], {"rows_to": "rows", "amount_to": "amount"}, scratch)
    totals = run.agg(F.sum("rows").alias("n"), F.sum("amount").alias("total"))
    both = run.crossJoin(F.broadcast(totals))
    aggs = []
    for p in percents:
        n = F.floor(F.col("n") * p / 100)
        taken = F.greatest(F.lit(0), F.least(F.col("rows"), n - (F.col("rows_to") - F.col("rows"))))
        aggs.append(F.sum(taken * F.col("unit")).alias(f"a{p}"))
        aggs.append(F.max(n).alias(f"n{p}"))
    one = both.agg(F.max("total").alias("total"), *aggs)
    rows = F.array(*[F.struct(F.lit(p).alias("percent"), F.col(f"n{p}").alias("lines"), F.col(f"a{p}").alias("amount"))
                     for p in percents])
    return one.select("total", F.inline(rows)).select(
        "percent", "lines", X.round_to(X.ratio("amount", "total"), 6).alias("revenue_share"))


# ---- lines -------------------------------------------------------------------------------------------------

def outlier_counts(lines: DataFrame) -> DataFrame:
    return lines.agg(X.count_if(F.abs("quantity") > 1000).alias("quantity_over_1000"),
                     X.count_if(F.col("price") > 100).alias("price_over_100"),
                     X.count_if(F.col("price") == 0).alias("price_zero"))


def cancellation_rates(lines: DataFrame) -> DataFrame:
    cancelled = X.count_if(F.col("is_cancellation"))
    return lines.groupBy("year_month").agg(_n().alias("rows"), cancelled.alias("cancelled"),
                                           X.round_to(X.ratio(cancelled, _n()), 6).alias("cancellation_rate"))


def cancellation_overview(lines: DataFrame) -> DataFrame:
    cancelled = F.col("is_cancellation")
    return lines.agg(
        X.round_to(X.ratio(X.count_if(cancelled), _n()), 6).alias("cancellation_rate"),
        F.coalesce(F.every(F.when(cancelled, F.startswith("invoice", F.lit("C")))), F.lit(True)).alias("all_have_prefix"),
        F.coalesce(F.every(F.when(cancelled, F.col("quantity") < 0)), F.lit(True)).alias("all_negative"))


def country_distribution(lines: DataFrame) -> DataFrame:
    per = lines.groupBy("country").agg(_n().alias("rows"), F.sum(X.units(F.col("quantity") * F.col("price"))).alias("amount"))
    both = with_total(with_total(per, "rows", "all_rows"), "amount", "all_amount")
    return both.select("country", "rows", X.from_units("amount").alias("revenue"),
                       _percent("rows", "all_rows", 4).alias("pct_rows"),
                       _percent(X.from_units("amount"), X.from_units("all_amount"), 4).alias("pct_revenue"))


def weekday_distribution(lines: DataFrame) -> DataFrame:
    return lines.groupBy(F.weekday("invoice_date").alias("day_of_week")).agg(_n().alias("rows"))


def year_month_volume(lines: DataFrame) -> DataFrame:
    """Rows per year, one column per month."""
    pivoted = lines.groupBy("invoice_year").pivot("invoice_month", list(range(1, 13))).agg(_n())
    return pivoted.select("invoice_year", *[
        F.coalesce(F.col(str(m)), F.lit(0).cast("bigint")).alias(f"m{m}") for m in range(1, 13)])


def layer_stability(bronze: DataFrame, lines: DataFrame) -> DataFrame:
    a = bronze.groupBy("year_month").agg(_n().alias("bronze_rows"))
    b = lines.groupBy("year_month").agg(_n().alias("silver_rows"))
    dropped = F.col("bronze_rows") - F.col("silver_rows")
    return a.join(b, "year_month", "full_outer").select(
        "year_month", "bronze_rows", "silver_rows", dropped.alias("dropped"),
        X.round_to(X.ratio(dropped, "bronze_rows"), 6).alias("drop_rate"))


def monthly_sales(lines: DataFrame) -> DataFrame:
    """Purchases per month; customers are counted once each."""
    per = lines.filter(~F.col("is_cancellation")).groupBy("year_month", "invoice", "customer_id").agg(
        _n().alias("rows"), F.sum(X.units("line_amount")).alias("amount"))
    month = with_distinct_counts(
        per, ["year_month"], [X.from_units(F.sum("amount")).alias("revenue"), F.sum("rows").alias("n_rows")],
        {"n_transactions": ("invoice", None), "n_customers": ("customer_id", F.col("customer_id") != "")})
    return month.withColumn("aov", X.round_to(X.ratio("revenue", "n_transactions"), 4))


def best_and_worst_month(monthly: DataFrame) -> DataFrame:
    rank_high = F.struct("revenue", "year_month")
    return monthly.agg(F.max_by("year_month", rank_high).alias("best_month"), F.max("revenue").alias("best_revenue"),
                       F.min_by("year_month", rank_high).alias("worst_month"), F.min("revenue").alias("worst_revenue"))


def largest_invoices(lines: DataFrame, n: int = 5) -> DataFrame:
    return lines.groupBy("invoice").agg(_n().alias("rows")).orderBy(F.desc("rows"), "invoice").limit(n)


def missing_customer_rates(lines: DataFrame) -> DataFrame:
    missing = X.count_if(F.col("customer_id") == "")
    return lines.groupBy("year_month").agg(_n().alias("rows"), missing.alias("missing"),
                                           X.round_to(X.ratio(missing, _n()), 6).alias("missing_rate"))


def business_measures(rollup: DataFrame, first: date | None = None, last: date | None = None) -> DataFrame:
    """Headline measures over a period. Customers and orders are distinct over the whole period, not summed by month."""
    part = rollup
    if first is not None:
        part = part.filter(F.to_date("invoice_date") >= F.lit(first))
    if last is not None:
        part = part.filter(F.to_date("invoice_date") <= F.lit(last))
    valid, cancelled = F.col("has_valid"), F.col("has_cancelled")
    one = with_distinct_counts(
        part, [],
        [X.from_units(F.sum("valid_amount")).alias("revenue"), X.from_units(F.sum("cancelled_amount")).alias("cancellation_value"),
         X.from_units(F.sum("valid_quantity")).alias("units")],
        {"orders": ("invoice", valid), "active_customers": ("customer_id", valid), "cancelled_orders": ("invoice", cancelled)})
    return one.select((F.col("revenue") + F.col("cancellation_value")).alias("net_revenue"), "orders", "active_customers",
                      X.round_to(X.ratio("revenue", "orders"), 4).alias("aov"), "units",
                      X.round_to(X.ratio("cancelled_orders", F.col("orders") + F.col("cancelled_orders")), 6).alias(
                          "cancellation_rate"))


# ---- churn over time and returning customers ----------------------------------------------------------------

def rolling_churn(rollup: DataFrame, days: int = 90) -> DataFrame:
    """Per month end: customers with a purchase in the ``days`` days up to it, and those without one in the next ``days``.

    Each purchase day counts for the month ends less than ``days`` away on either side, at most a handful, so days
    are exploded onto month ends instead of range-joined. A month whose window after it is not complete is left out.
    """
    bought = rollup.filter("has_valid").select("customer_id", F.to_date("invoice_date").alias("d")).distinct()
    reach = days // 28 + 1
    ends = F.transform(F.sequence(F.lit(-reach), F.lit(reach)), lambda k: F.last_day(F.add_months("d", k)))
    onto = bought.select("customer_id", "d", F.explode(ends).alias("month_end"))
    lag = F.datediff("d", "month_end")
    per = onto.filter((lag > -days) & (lag <= days)).groupBy("customer_id", "month_end").agg(
        F.max(F.datediff("d", "month_end") <= 0).alias("before"), F.max(F.datediff("d", "month_end") > 0).alias("after"))
    span = bought.agg(F.min("d").alias("lo"), F.max("d").alias("hi"))
    counted = per.filter("before").groupBy("month_end").agg(
        _n().alias("active_customers"), X.count_if(~F.col("after")).alias("churned_customers"))
    inside = counted.crossJoin(F.broadcast(span)).filter(
        (F.col("month_end") >= F.col("lo")) & (F.date_add("month_end", days) <= F.col("hi")))
    return inside.select("month_end", "active_customers", "churned_customers",
                         X.round_to(X.ratio("churned_customers", "active_customers"), 6).alias("churn_rate"))


def returning_revenue(rollup: DataFrame, customers: DataFrame) -> DataFrame:
    """Per month: revenue from customers first seen in an earlier month, and its share."""
    per = rollup.filter("has_valid").groupBy("customer_id", "year_month").agg(F.sum("valid_amount").alias("amount"))
    first = customers.filter("customer_sk <> 0").select("customer_id", X.year_month("first_seen_date").alias("first_month"))
    known = per.join(first, "customer_id")
    back = F.when(F.col("year_month") > F.col("first_month"), F.col("amount")).otherwise(F.lit(0).cast("bigint"))
    return known.groupBy("year_month").agg(
        X.from_units(F.sum("amount")).alias("revenue"), X.from_units(F.sum(back)).alias("returning_revenue"),
        X.round_to(X.ratio(F.sum(back), F.sum("amount")), 6).alias("returning_share"))


def freshness(reference: date, **latest: tuple[DataFrame, str]) -> DataFrame:
    """Newest day per table and its distance to the reference day."""
    out = None
    for name, (df, column) in latest.items():
        part = df.agg(F.max(F.to_date(column)).alias("latest_date")).select(
            F.lit(name).alias("table_name"), "latest_date", F.datediff(F.lit(reference), "latest_date").alias("days_behind"))
        out = part if out is None else out.unionByName(part)
    return out


# ---- scored customers --------------------------------------------------------------------------------------

def scored(customers: DataFrame, threshold: float) -> DataFrame:
    return customers.withColumns({"churn_flag": X.churn_flag("churn_probability", threshold),
                                  "risk_tier": X.risk_tier("churn_probability")})


def overview(customers: DataFrame, threshold: float) -> DataFrame:
    base = scored(customers, threshold)
    return base.agg(
        _n().alias("customers"), X.round_to(X.ratio(F.sum("churn_flag"), _n()), 6).alias("churn_rate"),
        *[X.count_if(F.col("risk_tier") == t).alias(f"{t.lower()}_risk") for t in X.RISK_TIERS],
        X.exact_sum("monetary", F.col("churn_flag") == 1).alias("revenue_at_risk"))


def churn_by_group(customers: DataFrame, threshold: float, group: str) -> DataFrame:
    return scored(customers, threshold).groupBy(group).agg(
        _n().alias("customers"), X.round_to(X.ratio(F.sum("churn_flag"), _n()), 6).alias("churn_rate"),
        _mean("monetary", 2).alias("avg_monetary"))


def retention_list(customers: DataFrame, threshold: float, tiers: list[str] | None = None,
                   segments: list[str] | None = None, min_monetary: float = 0.0) -> DataFrame:
    """Customers to contact. The order is that of presentation: highest probability first."""
    view = scored(customers, threshold).filter(F.col("risk_tier").isin(tiers or ["High"]))
    if segments:
        view = view.filter(F.col("segment").isin(segments))
    return view.filter(F.col("monetary") >= min_monetary).orderBy(F.desc("churn_probability"), "customer_id")


def retention_overview(customers: DataFrame, threshold: float, **filters) -> DataFrame:
    chosen = retention_list(customers, threshold, **filters).agg(
        _n().alias("targeted"), X.exact_sum("monetary").alias("revenue_at_stake"))
    return chosen.crossJoin(F.broadcast(customers.agg(_n().alias("base")))).select(
        "targeted", "revenue_at_stake", X.round_to(X.ratio("targeted", F.greatest("base", F.lit(1))), 6).alias("share_of_base"))


def score_histogram(customers: DataFrame, bins: int = 40) -> DataFrame:
    """Customers per equal-width bin of the observed score range."""
    span = customers.agg(F.min("churn_probability").alias("lo"), F.max("churn_probability").alias("hi"))
    width = (F.col("hi") - F.col("lo")) / bins
    place = F.floor(F.try_divide(F.col("churn_probability") - F.col("lo"), width))
    bin_no = F.coalesce(F.least(place, F.lit(bins - 1).cast("bigint")), F.lit(0).cast("bigint"))
    return customers.crossJoin(F.broadcast(span)).groupBy(bin_no.alias("bin")).agg(_n().alias("customers"))


def customer_percentiles(features: DataFrame, drivers: list[str], scratch: Scratch) -> DataFrame:
    """Per customer and driver: the share of customers at or below this value. All drivers share one global order."""
    long = features.select("customer_id", *[F.col(d).cast("double").alias(d) for d in drivers]).unpivot(
        ["customer_id"], drivers, "feature", "value")
    counts = long.groupBy("feature", "value").agg(_n().alias("rows"))
    run = global_running_sum(counts, ["feature", "value"], {"upto": "rows"}, scratch)
    totals = run.groupBy("feature").agg(F.sum("rows").alias("n"), F.min(F.col("upto") - F.col("rows")).alias("before"))
    share = run.join(F.broadcast(totals), "feature").select(
        "feature", "value", X.ratio(F.col("upto") - F.col("before"), "n").alias("percentile"))
    # a value that many customers share is a skewed key of a left join, which adaptive execution splits
    return long.join(share, ["feature", "value"], "left").select("customer_id", "feature", "value", "percentile")


def label_balance(labelled: DataFrame) -> DataFrame:
    per = labelled.groupBy("churn").agg(_n().alias("customers"))
    return with_total(per, "customers", "n").select("churn", "customers", _percent("customers", "n", 4).alias("pct"))


def label_boxplot(labelled: DataFrame, columns: list[str], scratch: Scratch) -> DataFrame:
    """Five-number summary per label and column."""
    five = {"lowest": 0.0, "p25": 0.25, "median": 0.5, "p75": 0.75, "highest": 1.0}
    long = long_values(labelled, columns, ("churn",))
    box = exact_quantiles(long, ["churn", "feature"], "value", five, scratch)
    return box.select("churn", "feature", *[X.round_to(c, 6).alias(c) for c in five])
