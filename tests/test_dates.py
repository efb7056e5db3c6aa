"""Mixed spellings of the invoice time against an independent day-first parser."""

from __future__ import annotations

import pandas as pd

from tallyline.functions import exprs as X

FORMS = [
    "01.12.2009 07:45", "1.2.2010 7:05", "31/01/2010 23:59:58", "13-06-2010", "2010-06-13 10:00:00", "2010-06-13T10:00:01",
    "2010-06-13T10:00:01.250", "2010-06-13", "01.12.09 07:45", "5/6/11", "12/25/2010", "12/25/2010 08:30", "25/12/2010",
    "1 Dec 2009", "01-Dec-2009 07:45", "3 February 2011 10:20:30", "Dec 1, 2009", "December 24, 2010 18:00", "1/12/2009 7:45 PM",
    "01.12.2009 12:05 am", "20101224", "  02.03.2010   04:05  ", "02 03 2010", "4-Mar-10",
]
UNREADABLE = ["", "soon", "32.01.2010", "31.02.2010", "01.13.x", "12:30 tomorrow", "1.2.2010 25:00"]


def test_mixed_date_forms_equal_a_day_first_parser(spark):
    table = spark.createDataFrame([(i, t) for i, t in enumerate(FORMS)], "i int, t string")
    got = {r["t"]: r["d"] for r in table.select("t", X.parse_day_first("t").alias("d")).collect()}
    want = {t: pd.to_datetime(t.strip(), format="mixed", dayfirst=True).to_pydatetime() for t in FORMS}
    assert got == want


def test_texts_without_a_date_are_null(spark):
    table = spark.createDataFrame([(t,) for t in [*UNREADABLE, None]], "t string")
    assert [r[0] for r in table.select(X.parse_day_first("t")).collect()] == [None] * (len(UNREADABLE) + 1)
