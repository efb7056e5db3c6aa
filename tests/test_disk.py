"""Disk that layers take: moves of a line, shuffle files that outlive a write."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import functions as F

from tallyline import schemas
from tallyline.plans import silver
from tallyline.sources import lake as L
from tallyline.sources import order_tables


def shuffle_files(spark):
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {f for d in manager.localDirsString() for f in Path(d).rglob("shuffle_*.data")}


def bronze_rows(spark, n=60):
    kinds = {f.name: f.dataType.simpleString() for f in schemas.BRONZE}
    month = F.col("id") % 3 + 1
    made = {"invoice": F.concat(F.lit("i"), (F.col("id") % 20).cast("string")), "stock_code": F.lit("s"), "customer_id": F.lit("c"), "price": F.lit(2.0),
            "quantity": F.when(F.col("id") < 30, 0.0).otherwise(F.lit(-0.0)), "invoice_date": F.make_timestamp_ntz(F.lit(2024), F.col("id") % 20 % 3 + 1, F.lit(1), F.lit(0), F.lit(0), F.lit(0)),
            "is_cancellation": F.lit(False), "year_month": F.concat(F.lit("2024-0"), (F.col("id") % 20 % 3 + 1).cast("string"))}
    return spark.range(n).repartition(3).select(*[made.get(c, F.lit(None)).cast(kinds[c]).alias(c) for c in schemas.BRONZE.names])


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange ")


def test_lines_are_moved_once_and_repeats_go(spark, tmp_path):
    bronze = bronze_rows(spark).withColumn("description", F.lit("d")).withColumn("country", F.lit("x"))
    lines = silver.to_silver(bronze)
    assert exchanges(lines) - exchanges(bronze) == 1
    L.write_months(lines, str(tmp_path / "silver"), laid_out=True)
    back = spark.read.parquet(str(tmp_path / "silver"))
    assert back.count() == 20 and back.select("invoice").distinct().count() == 20
    assert L.list_months(spark, str(tmp_path / "silver")) == ["2024-03", "2024-02", "2024-01"]
    plain = silver.drop_repeats(bronze).count()
    assert plain == 20 and silver.drop_repeats_by_month(bronze).count() == plain
    undated = bronze.withColumn("invoice_date", F.lit(None).cast("timestamp_ntz"))
    assert silver.drop_repeats_by_month(undated).count() == silver.drop_repeats(undated).count() == 20


def test_bronze_of_order_tables_is_laid_out_by_month(spark):
    plan = order_tables.bronze_lines(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    moved = plan.index("RebalancePartitions")
    assert "_month" in plan[moved:].splitlines()[0] and "invoice" not in plan[moved:]


def test_written_tables_leave_no_shuffle_files(spark, scratch):
    before = shuffle_files(spark)
    own = spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None)
    written = scratch.write(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count())
    assert not shuffle_files(spark) - before and written.count() == 7
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None) == own
