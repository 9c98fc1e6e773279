"""Which days a place was taken, from stays with a start and an open-ended end.

Days are packed as one bit each into an integer per month. A stay yields one
row per month it touches instead of one per day, masks of the same place and
month fold together by ``bit_or`` before any shuffle, and the places-by-days
grid is only unfolded in the last step, after the join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def calendar(dates: DataFrame, column: str) -> DataFrame:
    """Distinct days as one array of (month, days), oldest month first.

    ``days`` has bit d-1 set for each day d of the month. The array is one value
    with at most twelve entries per calendar year, however many rows are read.
    """
    months = (
        dates.select(F.to_date(column).alias("_day"))
        .filter("_day IS NOT NULL")
        .groupBy(F.trunc("_day", "MM").alias("month"))
        .agg(F.expr("bit_or(shiftleft(1, dayofmonth(_day) - 1))").alias("days"))
    )
    return months.agg(F.array_sort(F.collect_list(F.struct("month", "days"))).alias("calendar"))


def taken_days(
    stays: DataFrame, place: str, start: str, end: str, days: DataFrame
) -> DataFrame:
    """Mask of taken days per place and month, within the calendar's span.

    An open stay lasts to the end of the calendar.
    """
    clipped = (
        stays.select(
            F.col(place).alias("place"),
            F.to_date(start).alias("_start"),
            F.to_date(end).alias("_end"),
            days.scalar().alias("_calendar"),
        )
        .selectExpr(
            "place",
            "_start",
            "_end",
            "get(_calendar, 0).month AS _first",
            "last_day(get(_calendar, size(_calendar) - 1).month) AS _last",
        )
        .selectExpr(
            "place",
            "greatest(_start, _first) AS _from",
            "least(coalesce(_end, _last), _last) AS _to",
        )
        .filter("place IS NOT NULL AND _from <= _to")
    )
    return (
        clipped.selectExpr(
            "place",
            "_from",
            "_to",
            "explode(sequence(trunc(_from, 'MM'), trunc(_to, 'MM'), INTERVAL 1 MONTH)) AS month",
        )
        .selectExpr(
            "place",
            "month",
            # Bits first day - 1 up to last day - 1; 64 bits, as a month may fill 31.
            "shiftleft(1L, dayofmonth(least(_to, last_day(month))))"
            " - shiftleft(1L, dayofmonth(greatest(_from, month)) - 1) AS _bits",
        )
        .groupBy("place", "month")
        .agg(F.bit_or("_bits").alias("taken"))
    )


def day_grid(places: DataFrame, place: str, days: DataFrame, taken: DataFrame) -> DataFrame:
    """Every place on every calendar day, with ``report_date`` and ``is_taken`` 0/1."""
    by_month = places.withColumn("_calendar", days.scalar()).select(
        *places.columns, F.inline_outer("_calendar").alias("_month", "_days")
    ).filter("_month IS NOT NULL")
    masks = taken.select(
        F.col("place").alias(place), F.col("month").alias("_month"), F.col("taken").alias("_taken")
    )
    return (
        by_month.join(masks, [place, "_month"], "left")
        .withColumn(
            "_d", F.expr("explode(filter(sequence(1, 31), d -> getbit(_days, d - 1) = 1))")
        )
        .select(
            F.expr("date_add(_month, _d - 1)").alias("report_date"),
            *places.columns,
            F.expr("CAST(getbit(coalesce(_taken, 0L), _d - 1) AS INT)").alias("is_taken"),
        )
    )
