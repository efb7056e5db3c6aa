"""The whole batch build in its order: raw file, bronze, silver, gold tables, checks."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.plans import bronze, export, features, marts, quality, reconcile, silver, star
from tallyline.sources import lake as L
from tallyline.sources import raw_csv
from tallyline.sources.lake import Lake, Scratch

GOLD_TABLES = ["invoice_rollup", "mart_rfm", "mart_kpi_monthly", "dim_date", "dim_product", "dim_country", "dim_customer",
               "fact_transactions", "mart_features"]


def declare_gold(lake: Lake, home_country: str = features.HOME_COUNTRY) -> None:
    """Declare the gold tables over the lake's ``silver`` table. Each is built from written tables it depends on."""
    def lines(k: Lake) -> DataFrame:
        return silver.prepared(k.table("silver"))

    lake.declare("invoice_rollup", lambda k: marts.invoice_rollup(lines(k)))
    lake.declare("mart_rfm", lambda k: marts.mart_rfm(k.table("invoice_rollup"), k.scratch))
    lake.declare("mart_kpi_monthly", lambda k: marts.kpi_monthly(k.table("invoice_rollup")))
    lake.declare("dim_date", lambda k: star.dim_date(lines(k), k.scratch))
    lake.declare("dim_product", lambda k: star.dim_product(lines(k), k.scratch))
    lake.declare("dim_country", lambda k: star.dim_country(lines(k), k.scratch))
    lake.declare("dim_customer", lambda k: star.dim_customer(lines(k), k.table("mart_rfm"), k.scratch))
    lake.declare("fact_transactions", lambda k: star.fact_transactions(
        lines(k), k.table("dim_customer"), k.table("dim_product"), k.table("dim_country"), k.table("dim_date"), k.scratch))
    lake.declare("mart_features", lambda k: features.mart_features(
        lines(k), home_country=home_country, rollup=k.table("invoice_rollup")))
    lake.declare("train_features", lambda k: features.feature_matrix(
        lines(k), "train", home_country=home_country, rollup=k.table("invoice_rollup")))


def build_gold(spark: SparkSession, silver_path: str, gold_path: str, home_country: str = features.HOME_COUNTRY) -> Lake:
    """Write the gold tables and the build log where they are missing or silver has changed since they were written.

    The months of silver and the times they were written are kept next to the tables. Gold that was made from the same
    months is left as it is; otherwise every table is written again.
    """
    source = sorted(L.month_times(spark, silver_path).items())
    stored = f"{gold_path.rstrip('/')}/_source_months"
    known = spark.read.parquet(stored).collect() if L.is_complete(spark, stored) else []
    lake = Lake(spark, gold_path, rebuild=sorted((r["year_month"], r["written"]) for r in known) != source)
    lake.attach("silver", silver.read_silver(spark, silver_path))
    declare_gold(lake, home_country)
    lake.declare("_build_log", lambda k: export.build_log(
        k.table("silver"), k.table("fact_transactions"), k.table("mart_rfm"),
        **{d: k.table(d) for d in ("dim_customer", "dim_product", "dim_country", "dim_date")}).withColumn(
        "built_at", F.current_timestamp()))
    with lake.scratch:
        for name in [*GOLD_TABLES, "_build_log"]:
            lake.table(name)
    spark.createDataFrame(source, "year_month string, written long").coalesce(1).write.mode("overwrite").parquet(stored)
    lake.rebuild = False
    return lake


def validate(lake: Lake, bronze_df: DataFrame) -> DataFrame:
    """The invariants over a built lake."""
    clean = lake.table("silver")
    return reconcile.validation_report(scratch=lake.scratch, t=reconcile.Tables(
        bronze=bronze_df, silver=clean, lines=silver.prepared(clean), fact=lake.table("fact_transactions"),
        dim_customer=lake.table("dim_customer"), dim_product=lake.table("dim_product"), dim_country=lake.table("dim_country"),
        dim_date=lake.table("dim_date"), rfm=lake.table("mart_rfm"), kpi=lake.table("mart_kpi_monthly"),
        features=lake.table("mart_features")))


def run(spark: SparkSession, raw_path: str, root: str, shift_days: int = raw_csv.SHIFT_DAYS,
        home_country: str = features.HOME_COUNTRY, overwrite: Iterable[str] | bool = False) -> dict:
    """Raw file to checked gold tables. Months that exist are kept unless named in ``overwrite``; gold follows silver.

    The raw file is typed once. Rows that cannot be typed or dated go to ``<root>/quarantine`` with their reasons and
    nowhere else; the other rows go on.
    """
    with Scratch(spark) as scratch:
        typed = scratch.write(raw_csv.normalize(raw_csv.read_raw(spark, raw_path), shift_days))
        readable, unreadable = quality.split_unreadable(typed)
        unreadable.write.mode("overwrite").parquet(f"{root}/quarantine")
        months = raw_csv.months_newest_first(readable.select("year_month").distinct())
        bronze.ingest_typed(spark, readable, months, f"{root}/bronze", raw_path.rsplit("/", 1)[-1], overwrite)
    silver.transform_all(spark, f"{root}/bronze", f"{root}/silver")
    lake = build_gold(spark, f"{root}/silver", f"{root}/gold", home_country)
    report = validate(lake, spark.read.parquet(f"{root}/bronze"))
    return {"months": months, "lake": lake, "report": report, "passed": reconcile.passed(report)}
