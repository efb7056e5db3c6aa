from __future__ import annotations

import os
import sys
from datetime import datetime

import pytest
from retail_rows import HEADER

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tallyline.session import build_session  # noqa: E402
from tallyline.sources.lake import Scratch  # noqa: E402

@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("tests", "local[4]", 4, **{
        "spark.ui.enabled": "false", "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "4g",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def scratch(spark):
    return Scratch(spark)


@pytest.fixture()
def raw_file(tmp_path):
    def write(lines, name="sales.csv"):
        path = tmp_path / name
        path.write_text("\n".join([HEADER, *lines]) + "\n", encoding="ISO-8859-1")
        return str(path)
    return write


@pytest.fixture(scope="session")
def make_lines(spark):
    """Prepared lines from (invoice, stock_code, quantity, price, customer_id, country, time)."""
    from pyspark.sql import functions as F

    from tallyline.plans import silver

    def make(*rows):
        df = spark.createDataFrame(
            [(i, s, float(q), float(p), c, country, datetime.fromisoformat(at)) for i, s, q, p, c, country, at in rows],
            "invoice string, stock_code string, quantity double, price double, customer_id string, country string, "
            "invoice_date timestamp_ntz")
        bronze = df.withColumns({
            "description": F.lit("thing"), "original_invoice_date": F.col("invoice_date"),
            "is_cancellation": F.startswith("invoice", F.lit("C")), "ingested_at": F.current_timestamp()})
        return silver.prepared(silver.to_silver(bronze))
    return make
