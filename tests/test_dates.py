from __future__ import annotations

from datetime import date, timedelta

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from adtide.functions import dates
from adtide.functions.dates import (
    Period,
    date_rows,
    days_in_month,
    lastmonth,
    lastweek,
    month_end,
    month_start,
    parse_range,
    resolve_target_dates,
    review_period,
    week_start,
    yesterday,
)

D = date


def test_windows_of_a_monday():
    assert yesterday(D(2026, 4, 20)) == (D(2026, 4, 19), D(2026, 4, 19))
    assert lastweek(D(2026, 4, 20)) == (D(2026, 4, 13), D(2026, 4, 19))


def test_last_week_from_the_middle_of_a_week():
    assert lastweek(D(2026, 4, 23)) == (D(2026, 4, 13), D(2026, 4, 19))
    assert lastweek(D(2026, 4, 26)) == (D(2026, 4, 13), D(2026, 4, 19))


def test_last_month_also_over_new_year():
    assert lastmonth(D(2026, 4, 15)) == (D(2026, 3, 1), D(2026, 3, 31))
    assert lastmonth(D(2026, 1, 10)) == (D(2025, 12, 1), D(2025, 12, 31))


@given(st.dates(D(2000, 1, 1), D(2100, 1, 1)))
def test_windows_end_before_the_day(day):
    week, month = lastweek(day), lastmonth(day)
    assert week.start.weekday() == 0 and (week.end - week.start).days == 6
    assert 1 <= (day - week.end).days <= 7
    assert month.start.day == 1 and month.end.month != day.month
    assert 1 <= (day - month.end).days <= 31


def test_ranges():
    assert parse_range(D(2026, 4, 16)) == (D(2026, 4, 16), D(2026, 4, 16))
    with pytest.raises(ValueError):
        parse_range(D(2026, 4, 16), D(2026, 4, 15))
    with pytest.raises(ValueError):
        parse_range(None)
    assert review_period(None, None, D(2026, 4, 15)) == (D(2026, 3, 1), D(2026, 3, 31))
    assert review_period(D(2026, 4, 1), None, D(2026, 4, 15)) == (D(2026, 4, 1), D(2026, 4, 1))


def test_load_ranges():
    assert resolve_target_dates("", None, D(2026, 4, 20)) == (D(2026, 4, 19), D(2026, 4, 19))
    days = resolve_target_dates("2026-04-01", "2026-04-03", D(2026, 4, 20))
    assert days == (D(2026, 4, 1), D(2026, 4, 3))
    for start, end in (("2026-04-01", None), (None, "2026-04-01"), ("2026-04-03", "2026-04-01")):
        with pytest.raises(ValueError):
            resolve_target_dates(start, end, D(2026, 4, 20))


def test_date_rows(spark):
    rows = date_rows(spark, Period(D(2024, 2, 28), D(2024, 3, 1))).collect()
    assert [r[0] for r in rows] == [D(2024, 2, 28), D(2024, 2, 29), D(2024, 3, 1)]


def test_calendar_columns(spark):
    day = F.lit(D(2024, 2, 14))
    row = spark.range(1).select(
        week_start(day), month_start(day), month_end(day), days_in_month(day)
    ).first()
    assert tuple(row) == (D(2024, 2, 12), D(2024, 2, 1), D(2024, 2, 29), 29)


def test_period_columns_equal_the_functions(spark):
    texts = [None, "", "2026-02-03", "2026-03-31", "2024-02-29", "2026-02-30", "soon"]
    days = [date(2026, 4, 1), date(2026, 1, 1), date(2024, 3, 31), date(2026, 4, 5)]
    given = [(d, s, e) for d in days for s in texts for e in texts]

    def of(function, *arguments):
        try:
            return tuple(function(*arguments))
        except ValueError:
            return (None, None)

    def day(text):
        return date.fromisoformat(text) if text else None

    rows = dates.with_periods(spark.createDataFrame(given, "as_of date, start_date string, end_date string")).collect()
    for row in rows:
        as_of, start, end = row["as_of"], row["start_date"], row["end_date"]
        review = of(lambda a, s, e: dates.review_period(day(s), day(e), a), as_of, start, end)
        assert (row["review"]["start"], row["review"]["end"]) == review
        assert (row["review"]["problem"] is None) == (review[0] is not None)
        load = of(dates.resolve_target_dates, start, end, as_of)
        assert (row["load"]["start"], row["load"]["end"]) == load
        assert (row["load"]["problem"] is None) == (load[0] is not None)


def test_window_columns_equal_the_functions(spark):
    days = [date(2023, 12, 25) + timedelta(days=i) for i in range(430)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    for name, (first, last) in dates.window_columns(F.col("d")).items():
        got = {r["d"]: (r["a"], r["b"]) for r in df.select("d", first.alias("a"), last.alias("b")).collect()}
        assert got == {d: tuple(dates.WINDOWS[name](d)) for d in days}


def test_figures_of_many_reviews_in_one_job(spark):
    figures = spark.createDataFrame([(date(2026, 3, 1) + timedelta(days=i), float(i)) for i in range(60)], "date date, spend double")
    asked = spark.createDataFrame([("r1", date(2026, 4, 9), None, None), ("r2", date(2026, 4, 9), "2026-04-01", "2026-04-03"), ("r3", date(2026, 4, 9), "2026-04-03", "2026-04-01")], "name string, as_of date, start_date string, end_date string")
    found = dates.in_given_period(figures, dates.with_periods(asked))
    got = {r["name"]: (r["n"], r["s"]) for r in found.groupBy("name").agg(F.count("*").alias("n"), F.sum("spend").alias("s")).collect()}
    assert got == {"r1": (31, float(sum(range(31)))), "r2": (3, 31.0 + 32 + 33)}
