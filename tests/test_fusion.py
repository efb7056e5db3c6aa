"""Fused checks: numbers equal plain counts, and every table is read once."""

from __future__ import annotations

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F
from retail_rows import SMALL_DATA

from tallyline.operators import fusion
from tallyline.plans import quality, reconcile
from tallyline.queries import base
from tallyline.queries.reconcile import Built
from tallyline.sources.lake import Scratch


@pytest.fixture(scope="module")
def small(spark):
    rows = [(1, "a", "m1", 5), (2, "a", "m1", None), (2, "b", "m2", 7), (None, "c", "m2", 1), (3, None, None, -4)]
    return spark.createDataFrame(rows, "id int, k string, month string, v int")


def test_tally_counts_like_plain_groupings(small, spark, scratch):
    parent = spark.createDataFrame([("a",), ("a",), ("x",), (None,)], "k string")
    tally = fusion.Tally({"t": (small, [
        fusion.Entry("all"), fusion.Entry("bad", F.col("v") < 0), fusion.key("id", repeats=True), fusion.key("k"), fusion.Entry("any_k", value=F.col("k")),
        fusion.Entry("months", group=F.col("month"), value=F.col("k"), units=F.col("v"))]), "p": (parent, [fusion.key("k")])}, scratch)
    assert (tally.rows("t", "all"), tally.rows("t", "bad"), tally.repeated("t", "id"), tally.distinct("t", "k"), tally.distinct("t", "any_k")) == (5, 1, 1, 3, 4)
    assert tally.rows("t", "unheard of") == 0 and tally.units("t", "months") == 9
    assert tally.by_group(("t", "months"))["t", "months"] == {"m1": (2, 1, 5), "m2": (2, 2, 8), None: (1, 1, -4)}
    assert tally.against([(("t", "k"), ("p", "k"))]) == [{"pair": 0, "orphan_values": 2, "orphan_rows": 2, "members": 3, "used": 3}]


class Watching(Scratch):
    """Counts the Parquet scans by table in the plans that are written."""

    def __init__(self, spark):
        super().__init__(spark)
        self.seen: Counter[str] = Counter()

    def write(self, df):
        plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
        self.seen.update(m.rsplit("/", 1)[-1] for m in re.findall(r"FileScan parquet .*?InMemoryFileIndex.*?paths\)\[([^\], ]+)", plan))
        return super().write(df)


def test_report_reads_every_table_once(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    r = base.retail(spark, SMALL_DATA)
    watch = Watching(spark)
    reconcile.validation_report(Built(r), watch).collect()
    layers = ["silver", "bronze", "fact_transactions", "mart_rfm", "mart_features", "mart_kpi_monthly", "dim_date", "dim_product", "dim_customer", "dim_country"]
    assert {n: watch.seen[n] for n in layers} == dict.fromkeys(layers, 1)
    watch = Watching(spark)
    reconcile.column_check_counts(Built(r), watch).collect()
    assert {n: watch.seen[n] for n in layers if n != "bronze"} == dict.fromkeys([n for n in layers if n != "bronze"], 1)
    watch = Watching(spark)
    quality.key_coverage(r.fact_transactions, watch, dim_date=(r.dim_date, "date_sk"), dim_product=(r.dim_product, "product_sk")).collect()
    assert watch.seen["fact_transactions"] == 1
    watch = Watching(spark)
    quality.quality_summary(r.silver, watch).collect()
    assert watch.seen["silver"] == 2
