"""Raw file -> bronze -> silver -> star schema on small files."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from retail_rows import SEVEN_LINES
from tallyline import schemas
from tallyline.functions import exprs as X
from tallyline.plans import bronze as B
from tallyline.plans import marts, quality, reconcile, silver, star
from tallyline.sources import lake as L
from tallyline.sources import raw_csv


def normalized(spark, path):
    return raw_csv.normalize(raw_csv.read_raw(spark, path))


def test_shift_is_computed_from_the_two_days():
    assert raw_csv.SHIFT_DAYS == (date(2026, 6, 10) - date(2011, 12, 9)).days == 5297


def test_normalize_edge_rows(spark, raw_file):
    path = raw_file([
        "A123; 85049a ;  Dotted \xa0;1,5;1.12.2009 07:45;2,50;\xa0;Norway ",
        "C9;x;\"a \"\"quoted\"\" name\";-1;01.12.2009 7:45;0,10;NULL;EIRE",
        "10;y;;bad;31.02.2010 10:00;n/a;12;EIRE",
    ])
    rows = {r["invoice"]: r for r in normalized(spark, path).collect()}
    first = rows["A123"]
    assert (first["stock_code"], first["description"], first["quantity"], first["price"]) == ("85049A", "Dotted", 1.5, 2.5)
    assert first["customer_id"] == "" and first["country"] == "Norway" and not first["is_cancellation"]
    assert first["original_invoice_date"] == datetime(2009, 12, 1, 7, 45)
    assert rows["C9"]["is_cancellation"] and rows["C9"]["customer_id"] == ""
    assert rows["C9"]["description"] == 'a "quoted" name'
    assert rows["10"]["quantity"] is None and rows["10"]["price"] is None and rows["10"]["year_month"] is None


def test_header_is_trimmed_and_may_come_in_any_order(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text(" Country ;Invoice;StockCode;Description;Quantity;InvoiceDate;Price; Customer ID\n"
                    "France;1;a;b;2;01.01.2010 10:00;3;7\n", encoding="ISO-8859-1")
    row = normalized(spark, str(path)).first()
    assert (row["country"], row["customer_id"], row["quantity"]) == ("France", "7", 2.0)


def test_ingest_all_is_idempotent_and_newest_first(spark, raw_file, tmp_path):
    path, out = raw_file(SEVEN_LINES), str(tmp_path / "bronze")
    months = B.ingest_all(spark, path, out)
    assert months == sorted(months, reverse=True) == ["2024-12", "2024-06"]
    before = sorted(spark.read.parquet(out).inputFiles())
    assert B.ingest_all(spark, path, out) == months
    assert sorted(spark.read.parquet(out).inputFiles()) == before
    assert spark.read.parquet(out).count() == 7
    audit = {r["year_month"]: r for r in spark.read.parquet(f"{out}/{B.AUDIT_FOLDER}").collect()}
    assert audit["2024-06"]["row_count"] == 5 and audit["2024-06"]["cancellation_count"] == 1
    assert audit["2024-06"]["null_customer_count"] == 1 and audit["2024-06"]["unique_countries"] == 4
    assert audit["2024-06"]["source_file"] == "sales.csv" and len(audit) == 2


def test_ingest_one_month(spark, raw_file, tmp_path):
    path, out = raw_file(SEVEN_LINES), str(tmp_path / "bronze")
    assert B.ingest(spark, path, out, "2024-12") is True
    assert B.ingest(spark, path, out, "2024-12") is False
    with pytest.warns(UserWarning, match="no rows"):
        assert B.ingest(spark, path, out, "1999-01") is False
    assert B.read_month(spark, out, "2024-12").count() == 2
    with pytest.raises(FileNotFoundError):
        B.read_month(spark, out, "2024-06")
    B.ingest_all(spark, path, out)
    assert spark.read.parquet(out).count() == 7


@pytest.fixture()
def seven(spark, raw_file, tmp_path, scratch):
    path, bronze, out = raw_file(SEVEN_LINES), str(tmp_path / "bronze"), str(tmp_path / "silver")
    B.ingest_all(spark, path, bronze)
    months = silver.transform_all(spark, bronze, out)
    assert months == ["2024-12", "2024-06"] and silver.transform_all(spark, bronze, out) == months
    return spark.read.parquet(bronze), silver.read_silver(spark, out)


def test_silver_and_star(seven, spark, scratch):
    bronze, clean = seven
    schemas.assert_schema(clean, schemas.SILVER)
    lines = silver.prepared(clean)
    assert bronze.count() == 7 and clean.count() == 6
    delta = quality.bronze_to_silver_delta(bronze).first()
    assert (delta["dedup_removed"], delta["noise_removed"], delta["expected_silver_rows"]) == (1, 0, 6)
    rollup = marts.invoice_rollup(lines)
    rfm = marts.mart_rfm(rollup, scratch)
    dims = (star.dim_customer(lines, rfm, scratch), star.dim_product(lines, scratch), star.dim_country(lines, scratch),
            star.dim_date(lines, scratch))
    fact = star.fact_transactions(lines, *dims, scratch)
    assert fact.count() == 6 and fact.filter("customer_sk = 0").count() == 1
    assert sorted(r[0] for r in fact.select("transaction_sk").collect()) == [1, 2, 3, 4, 5, 6]
    tables = reconcile.Tables(bronze, clean, lines, fact, *dims, rfm=rfm, kpi=marts.kpi_monthly(rollup))
    report = reconcile.validation_report(tables, scratch, skip=(
        "features_customer_reconcile", "features_customers_in_dim", "features_value_ranges"))
    assert reconcile.passed(report) and report.filter("violations > 0").count() == 0
    broken = reconcile.Tables(bronze, clean.filter("country <> 'France'"), lines, fact, *dims, rfm=rfm, kpi=tables.kpi)
    assert not reconcile.passed(reconcile.validation_report(broken, scratch, skip=(
        "features_customer_reconcile", "features_customers_in_dim", "features_value_ranges")))


def test_reload_with_another_load_time_adds_nothing(seven):
    bronze, clean = seven
    twice = bronze.unionByName(bronze.withColumn("ingested_at", F.lit("2030-01-01").cast("timestamp")))
    assert silver.to_silver(twice).count() == clean.count()


def test_noise_keeps_null_price_and_cancellations(spark):
    df = spark.createDataFrame([(2.0, False), (0.0, False), (3.0, False), (-1.0, False), (None, False), (0.0, True)],
                               "price double, is_cancellation boolean")
    assert silver.drop_noise(df).count() == 4


def test_quarantine_names_the_reasons(spark, raw_file):
    path = raw_file(["1;a;b;2;01.01.2010 10:00;3;7;France", ";a;b;x;nonsense;-3;7;France", "2;a;b;2;01.01.2010 10:00;0;7;France"])
    good, bad = quality.quarantine(normalized(spark, path))
    assert [r["invoice"] for r in good.collect()] == ["1"]
    reasons = {r["invoice"]: set(r["reject_reason"]) for r in bad.collect()}
    assert reasons[""] == {"unreadable_date", "unreadable_quantity", "negative_price", "price_not_positive", "blank_invoice"}
    assert reasons["2"] == {"price_not_positive"}


def test_assert_schema_names_the_difference(spark):
    with pytest.raises(schemas.SchemaMismatch):
        schemas.assert_schema(spark.range(1), schemas.SILVER)


def test_date_forms_and_auto_shift(spark):
    df = spark.createDataFrame([("1.2.2010 7:05",), ("01.02.2010 07:05:09",), ("01/02/2010",), ("2010-02-01 07:05",), ("x",)], "InvoiceDate string")
    got = [r[0] for r in df.select(X.parse_day_first("InvoiceDate")).collect()]
    assert got == [datetime(2010, 2, 1, 7, 5), datetime(2010, 2, 1, 7, 5, 9), datetime(2010, 2, 1), datetime(2010, 2, 1, 7, 5), None]
    assert raw_csv.auto_shift_days(df, date(2010, 2, 11)) == 10


def test_partition_replacement_touches_only_its_month(spark, tmp_path):
    path = str(tmp_path / "t")
    L.write_months(spark.createDataFrame([(1, "2024-01"), (2, "2024-02")], "v int, year_month string"), path)
    L.write_months(spark.createDataFrame([(3, "2024-02")], "v int, year_month string"), path)
    assert sorted(r["v"] for r in spark.read.parquet(path).collect()) == [1, 3]
    assert L.list_months(spark, path) == ["2024-02", "2024-01"]


def test_whole_build_is_checked_and_repeatable(spark, raw_file, tmp_path):
    from tallyline.plans import build

    path, root = raw_file([*SEVEN_LINES, "490000;1;Bad;x;03.12.2009 11:00;2,95;13085;France"]), str(tmp_path / "lake")
    first = build.run(spark, path, root)
    assert first["passed"] and first["lake"].table("silver").count() == 6
    reasons = [set(r["reject_reason"]) for r in spark.read.parquet(f"{root}/quarantine").collect()]
    assert reasons == [{"unreadable_quantity"}]
    good_root = str(tmp_path / "good")
    good = build.run(spark, raw_file(SEVEN_LINES, "good.csv"), good_root)
    assert good["passed"] and good["months"] == ["2024-12", "2024-06"]
    log = {r["measure"]: r["value"] for r in spark.read.parquet(f"{good_root}/gold/_build_log").collect()}
    assert log["silver_rows"] == log["fact_transactions_rows"] == 6 and log["fact_null_customer_sk"] == 0
    files = sorted(good["lake"].table("fact_transactions").inputFiles())
    again = build.run(spark, raw_file(SEVEN_LINES, "good.csv"), good_root)
    assert again["passed"] and sorted(again["lake"].table("fact_transactions").inputFiles()) == files


def test_new_and_changed_months_reach_gold(spark, raw_file, tmp_path):
    from tallyline.plans import build

    root, late = str(tmp_path / "lake"), "489437;22087;Lace;5;04.12.2009 12:00;2,95;13086;France"
    build.run(spark, raw_file(SEVEN_LINES[:5], "first.csv"), root)
    more = build.run(spark, raw_file(SEVEN_LINES, "second.csv"), root)
    assert more["passed"] and more["lake"].table("fact_transactions").count() == 6
    with pytest.warns(UserWarning, match="2024-06 has 5, stored 4|2024-06 has"):
        same = build.run(spark, raw_file([*SEVEN_LINES, late], "third.csv"), root)
    reported = spark.read.parquet(f"{root}/bronze/_late_rows").collect()
    assert [(r["year_month"], r["source_rows"] - r["stored_rows"], r["source_file"]) for r in reported] == [("2024-06", 1, "third.csv")]
    assert same["lake"].table("fact_transactions").count() == 6
    changed = build.run(spark, raw_file([*SEVEN_LINES, late], "third.csv"), root, overwrite=["2024-06"])
    assert changed["passed"] and changed["lake"].table("fact_transactions").count() == 7


def test_stream_reads_each_file_by_its_own_header(spark, raw_file, tmp_path):
    from tallyline.plans import silver
    from tallyline.streaming import incremental

    (tmp_path / "in").mkdir()
    raw_file(SEVEN_LINES[:4], "in/a.csv")
    swapped = [";".join([p[1], p[0], *p[2:]]) for p in (line.split(";") for line in SEVEN_LINES[4:])]
    head = "StockCode;Invoice;Description;Quantity;InvoiceDate;Price;Customer ID;Country"
    (tmp_path / "in" / "b.csv").write_text("\n".join([head, *swapped]) + "\n", encoding="ISO-8859-1")
    out = str(tmp_path / "out")
    incremental.stream_ingest(spark, str(tmp_path / "in"), f"{out}/bronze", f"{out}/silver", f"{out}/checkpoint").awaitTermination()
    got = {r["invoice"] for r in silver.read_silver(spark, f"{out}/silver").collect()}
    assert got == {line.split(";")[0] for line in SEVEN_LINES}


def test_stream_and_batch_keep_the_same_bronze(spark, raw_file, tmp_path):
    """Month by month, in one folder, unreadable rows kept back; batches that are repeated change nothing."""
    from tallyline.plans import build
    from tallyline.streaming import incremental

    bad = ["490000;1;Bad;x;03.12.2009 11:00;2,95;13085;France", "490001;1;Bad;1;no date;2,95;13085;France"]
    build.run(spark, raw_file([*SEVEN_LINES, *bad], "all.csv"), str(tmp_path / "batch"))
    (tmp_path / "in").mkdir()
    root = str(tmp_path / "stream")
    load = lambda check: incremental.stream_ingest(spark, str(tmp_path / "in"), f"{root}/bronze", f"{root}/silver", f"{root}/{check}",
                                                   quarantine_path=f"{root}/quarantine").awaitTermination()
    raw_file([*SEVEN_LINES[:3], bad[0]], "in/a.csv")
    load("check")
    raw_file([*SEVEN_LINES[3:], bad[1]], "in/b.csv")
    load("check")
    load("check")
    columns = [*schemas.BUSINESS_COLUMNS, "year_month"]

    def rows(path, names=columns):
        return sorted(map(repr, spark.read.option("recursiveFileLookup", path.endswith("quarantine")).parquet(path).select(names).collect()))
    for layer in ("bronze", "silver"):
        names = columns if layer == "bronze" else schemas.SILVER.names
        assert rows(f"{root}/{layer}", names) == rows(f"{tmp_path}/batch/{layer}", names)
    held = lambda path: sorted((r["invoice"], r["reject_reason"]) for r in spark.read.option("recursiveFileLookup", True).parquet(path).collect())
    assert held(f"{root}/quarantine") == held(f"{tmp_path}/batch/quarantine") and len(held(f"{root}/quarantine")) == 2
    before = rows(f"{root}/bronze")
    last = sorted((tmp_path / "stream" / "check" / "commits").glob("[0-9]*"))[-1]
    last.unlink()  # the batch was done, its commit is lost: it runs again
    (last.parent / f".{last.name}.crc").unlink(missing_ok=True)
    load("check")
    assert rows(f"{root}/bronze") == before
    audit = {(r["source_file"], r["year_month"]): r["row_count"] for r in incremental.stream_audit(spark, f"{root}/bronze").collect()}
    assert {f for f, _ in audit} == {"a.csv", "b.csv"} and max(n for (_, m), n in audit.items() if m == "2024-06") == spark.read.parquet(f"{root}/bronze").filter("year_month = '2024-06'").count()


def test_records_are_moved_before_they_are_compared(spark):
    kinds = {f.name: f.dataType.simpleString() for f in schemas.BRONZE}
    empty = [F.lit(None).cast(kinds[c]).alias(c) for c in schemas.BRONZE.names if c not in ("invoice", "quantity")]
    base = spark.range(12).repartition(3).select(*empty, F.concat(F.lit("i"), (F.col("id") % 2).cast("string")).alias("invoice"),
                                                 F.when(F.col("id") < 6, 0.0).otherwise(F.lit(-0.0)).alias("quantity"))
    out = silver.drop_repeats(base)
    assert sorted(r["invoice"] for r in out.collect()) == ["i0", "i1"]
    steps = out._jdf.queryExecution().executedPlan().toString().splitlines()
    moved = max(i for i, step in enumerate(steps) if "Exchange hashpartitioning" in step)
    assert not any("Aggregate(" in step for step in steps[moved:])
