"""Casts and date arithmetic on literals."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from wardhouse.functions import dates
from wardhouse.functions.casts import safe_cast

CASES = {
    "integer": {
        "12": 12, "12.7": 13, "-12.5": -13, "12.4": 12, " 7 ": 7, "abc": None, "": None,
        None: None, "1e3": 1000, "99999999999999999999": None,
    },
    "smallint": {"10": 10, "3000000000": None},
    "decimal(10,2)": {"350.505": Decimal("350.51"), "x": None, "123456789": None, "-1": Decimal("-1.00")},
    "date": {
        "2026-04-29": date(2026, 4, 29), "2026": None, "29/04/2026": None, "2026-02-30": None,
        "": None,
    },
    "timestamp": {
        "2026-04-29 06:33:09": datetime(2026, 4, 29, 6, 33, 9),
        "2026-04-29T06:33:09": datetime(2026, 4, 29, 6, 33, 9),
        "1999-03-01": datetime(1999, 3, 1), "2026": None, "yesterday": None,
        "2026-04-29 25:00:00": None,
    },
    "boolean": {
        "True": True, "on": True, "1": True, "Y": True, "False": False, "off": False, "0": False,
        "maybe": None, "": None,
    },
    "varchar": {"": None, " ": " ", "x": "x"},
}


@pytest.mark.parametrize("kind", CASES)
def test_safe_cast(spark, kind):
    cases = CASES[kind]
    df = spark.createDataFrame([(k,) for k in cases], "s string")
    got = [r["v"] for r in df.select(safe_cast(F.col("s"), kind).alias("v")).collect()]
    assert got == list(cases.values())


def test_unknown_kind(spark):
    with pytest.raises(ValueError):
        safe_cast(F.col("s"), "clob")


def test_differences_count_boundaries(spark):
    rows = [
        (datetime(2026, 4, 29, 23, 45), datetime(2026, 4, 30, 0, 30), 1, 1, 45),
        (datetime(2026, 4, 29, 22, 59), datetime(2026, 4, 30, 6, 0), 1, 8, 421),
        (datetime(2026, 4, 29, 9, 0, 59), datetime(2026, 4, 29, 9, 1, 0), 0, 0, 1),
        (datetime(2026, 4, 30, 0, 0), datetime(2026, 4, 29, 23, 59), -1, -1, -1),
        (datetime(1969, 12, 31, 23, 59), datetime(1970, 1, 1, 0, 1), 1, 1, 2),
    ]
    df = spark.createDataFrame(rows, "a timestamp_ntz, b timestamp_ntz, d long, h long, m long")
    a, b = F.col("a"), F.col("b")
    for zone in ("UTC", "Europe/Paris", "America/Los_Angeles"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            got = df.select(
                dates.days_between(a, b), dates.hours_between(a, b), dates.minutes_between(a, b)
            ).collect()
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
        assert [tuple(r) for r in got] == [r[2:] for r in rows]


def test_age(spark):
    df = spark.sql(
        "SELECT DATE'2000-02-29' AS b, TIMESTAMP_NTZ'2026-02-27 10:00:00' AS t"
        " UNION ALL SELECT DATE'2000-02-29', TIMESTAMP_NTZ'2026-03-01 00:00:00'"
    )
    got = [r[0] for r in df.select(dates.age_in_years(F.col("b"), F.col("t"))).collect()]
    assert got == [25, 26]


def test_periods(spark):
    day = spark.sql("SELECT DATE'2026-04-29' AS d")
    got = day.select(*[dates.period_start(F.col("d"), p) for p in dates.PERIODS]).first()
    assert tuple(got) == (date(2026, 4, 29), date(2026, 4, 1), date(2026, 1, 1))
    with pytest.raises(ValueError):
        dates.period_start(F.col("d"), "week")
