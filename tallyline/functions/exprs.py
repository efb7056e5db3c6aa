"""Column expressions shared by the plans. All stay inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_DAY = 86_400_000_000
MONEY_SCALE = 10_000


def col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


# ---- text and number parsing -------------------------------------------------------------------------------

# Texts a raw field may hold that stand for "missing".
MISSING_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
    "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Spellings of a day and of a time of day, tried in this order on texts whose separators ``parse_day_first`` has made alike.
DAY_PATTERNS = ["d-M-yyyy", "yyyy-M-d", "d-M-yy", "M-d-yyyy", "M-d-yy", "d-MMM-yyyy", "d-MMMM-yyyy", "d-MMM-yy",
                "MMM-d-yyyy", "MMMM-d-yyyy", "yyyy-MMM-d", "yyyyMMdd"]
TIME_PATTERNS = ["[ H:mm[:ss[.SSSSSS]]]", " h:mm[:ss] a"]


def missing_to_null(value: Column | str) -> Column:
    return F.when(~col(value).isin(MISSING_TOKENS), col(value))


# Every character that counts as white space at the ends of a text.
WHITE_SPACE = (" \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
               "\u2028\u2029\u202f\u205f\u3000")


def strip(value: Column | str) -> Column:
    """Trim every Unicode space at both ends (plain ``trim`` leaves e.g. no-break spaces)."""
    return F.btrim(col(value), F.lit(WHITE_SPACE))


def clean_text(value: Column | str) -> Column:
    return strip(F.coalesce(col(value), F.lit("")))


def parse_day_first(value: Column | str) -> Column:
    """Zone-less timestamp of a text in any of the mixed forms, or NULL when none fits.

    ``.``, ``/``, ``-`` and spaces part day, month and year; a ``T`` or spaces part day and time. A four-digit year may lead,
    months may be English names, two-digit years lie in 2000 to 2099. Of two numbers the first is the day, unless only the
    other order gives a date.
    """
    text = F.regexp_replace(strip(value), r"\s+", " ")
    text = F.regexp_replace(text, r"(?i)(?<=\d)\s?(am|pm)$", " $1")
    at = F.regexp_extract(text, r"^(.*?\d)(?:,? |T)(\d{1,2}:.*)$", 1)
    time = F.regexp_extract(text, r"^(.*?\d)(?:,? |T)(\d{1,2}:.*)$", 2)
    day = F.regexp_replace(F.when(at == "", text).otherwise(at), r"[ .,/-]+", "-")
    whole = F.when(at == "", day).otherwise(F.concat(day, F.lit(" "), time))
    tried = [F.try_to_timestamp(whole, F.lit(d + TIME_PATTERNS[0])) for d in DAY_PATTERNS]
    half = [F.try_to_timestamp(whole, F.lit(d + TIME_PATTERNS[1])) for d in DAY_PATTERNS]
    twelve = F.rlike(text, F.lit("(?i) [ap]m$"))
    mixed = F.when(twelve, F.coalesce(*half)).otherwise(F.coalesce(*tried))
    usual = F.try_to_timestamp(strip(value), F.lit("d.M.yyyy" + TIME_PATTERNS[0]))  # spares most rows the patterns below
    return F.coalesce(usual, mixed).cast("timestamp_ntz")


def parse_decimal_comma(value: Column | str) -> Column:
    return strip(F.replace(col(value), F.lit(","), F.lit("."))).try_cast("double")


# ---- arithmetic --------------------------------------------------------------------------------------------

def safe_divide(numerator: Column | str, denominator: Column | str, default: float = 0.0) -> Column:
    """Quotient, or ``default`` where it is missing, infinite or not a number."""
    quotient = F.try_divide(col(numerator).cast("double"), col(denominator).cast("double"))
    return F.when(F.abs(quotient) < float("inf"), quotient).otherwise(F.lit(default))


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Double division, NULL for a zero denominator."""
    return F.try_divide(col(numerator).cast("double"), col(denominator).cast("double"))


def at_most(value: Column | str, cap: float) -> Column:
    return F.least(col(value), F.lit(float(cap)))


def round_to(value: Column | str, digits: int) -> Column:
    """Round half up with plain double arithmetic, so that any engine gives the same bits."""
    factor = float(10 ** digits)
    return F.floor(col(value).cast("double") * factor + 0.5) / factor


def units(value: Column | str) -> Column:
    """A money or quantity value as a whole number of 1/10000 units."""
    return F.rint(col(value) * MONEY_SCALE).cast("bigint")


def from_units(value: Column | str) -> Column:
    return col(value).cast("double") / float(MONEY_SCALE)


def exact_sum(value: Column | str, when: Column | None = None) -> Column:
    """Sum that does not depend on the order of rows: whole 1/10000 units added as integers."""
    amount = units(value)
    if when is not None:
        amount = F.when(when, amount).otherwise(F.lit(0).cast("bigint"))
    return from_units(F.coalesce(F.sum(amount), F.lit(0).cast("bigint")))


def count_if(condition: Column) -> Column:
    """Number of rows where the condition is true; 0 on no rows."""
    return F.count(F.when(condition, F.lit(1)))


def as_int(condition: Column) -> Column:
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


# ---- time --------------------------------------------------------------------------------------------------

def micros(value: Column | str) -> Column:
    """Microseconds since 1970-01-01 of a zone-less timestamp, whatever the session zone is."""
    ts = col(value)
    clock = F.hour(ts).cast("bigint") * 3600 + F.minute(ts) * 60
    seconds = F.date_part(F.lit("SECONDS"), ts)
    return (F.unix_date(F.to_date(ts)).cast("bigint") * 86_400 + clock) * 1_000_000 + (seconds * 1_000_000).cast("bigint")


def days_between(start: Column | str, end: Column | str) -> Column:
    """Calendar-day difference (clock times are ignored)."""
    return F.datediff(F.to_date(col(end)), F.to_date(col(start)))


def year_month(value: Column | str) -> Column:
    return F.date_format(col(value), "yyyy-MM")


def month_index(value: Column | str) -> Column:
    """Months as consecutive integers."""
    return F.year(col(value)) * 12 + F.month(col(value))


def month_index_of_key(year_month_key: Column | str) -> Column:
    """Month index of a 'YYYY-MM' text."""
    key = col(year_month_key)
    return F.substring(key, 1, 4).cast("int") * 12 + F.substring(key, 6, 2).cast("int")


def shift_days(value: Column | str, days: int) -> Column:
    return col(value) + F.make_dt_interval(F.lit(days))


def calendar_columns(value: Column | str) -> dict[str, Column]:
    ts = col(value)
    return {
        "invoice_year": F.year(ts),
        "invoice_month": F.month(ts),
        "invoice_day": F.day(ts),
        "invoice_quarter": F.quarter(ts),
        "invoice_day_of_week": F.weekday(ts),
        "invoice_week": F.weekofyear(ts),
        "year_month": year_month(ts),
    }


# ---- business rules ----------------------------------------------------------------------------------------

def is_guest(customer: Column | str = "customer_id") -> Column:
    return F.coalesce(strip(customer), F.lit("")) == ""


def is_noise() -> Column:
    """A non-cancelled row at price <= 0. A NULL price is not noise."""
    return ~F.col("is_cancellation") & F.coalesce(F.col("price") <= 0, F.lit(False))


def is_valid_purchase() -> Column:
    return F.coalesce(
        (F.col("customer_id") != "") & ~F.col("is_cancellation") & (F.col("line_amount") > 0), F.lit(False)
    )


# Label of every (recency score, frequency score) pair that has one; other pairs need attention.
SEGMENT_PAIRS = {
    "Champions": [(5, 5), (5, 4), (4, 5)],
    "Loyal Customers": [(4, 4), (4, 3), (3, 5)],
    "Potential Loyalists": [(3, 4), (3, 3)],
    "New Customers": [(5, 1)],
    "Promising": [(5, 2), (4, 1)],
    "Cannot Lose Them": [(2, 5), (1, 5), (1, 4)],
    "At Risk": [(2, 4), (2, 3), (2, 2)],
    "About to Sleep": [(3, 1), (2, 1)],
    "Hibernating": [(1, 3), (1, 2)],
    "Lost": [(1, 1)],
}
DEFAULT_SEGMENT = "Need Attention"
SEGMENTS = [*SEGMENT_PAIRS, DEFAULT_SEGMENT]


def segment_label(r_score: Column | str, f_score: Column | str) -> Column:
    pair = col(r_score) * 10 + col(f_score)
    label = None
    for name, pairs in SEGMENT_PAIRS.items():
        hit = pair.isin([r * 10 + f for r, f in pairs])
        label = F.when(hit, F.lit(name)) if label is None else label.when(hit, F.lit(name))
    return label.otherwise(F.lit(DEFAULT_SEGMENT))


HIGH_RISK, MEDIUM_RISK = 0.7, 0.4
RISK_TIERS = ["High", "Medium", "Low"]


def risk_tier(probability: Column | str, high: float = HIGH_RISK, medium: float = MEDIUM_RISK) -> Column:
    p = col(probability)
    return F.when(p >= high, "High").when(p >= medium, "Medium").otherwise("Low")


def churn_flag(probability: Column | str, threshold: float) -> Column:
    return as_int(col(probability) >= threshold)
