"""Reporting windows. Nothing here reads a clock: the day is always passed in."""

from __future__ import annotations

from datetime import date, timedelta
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


class Period(NamedTuple):
    """Inclusive date range."""

    start: date
    end: date


def yesterday(as_of: date) -> Period:
    day = as_of - timedelta(days=1)
    return Period(day, day)


def lastweek(as_of: date) -> Period:
    """Monday to Sunday of the week before the one holding ``as_of``."""
    sunday = as_of - timedelta(days=as_of.isoweekday())
    return Period(sunday - timedelta(days=6), sunday)


def lastmonth(as_of: date) -> Period:
    """The whole calendar month before ``as_of``."""
    last_day = as_of - timedelta(days=as_of.day)
    return Period(last_day.replace(day=1), last_day)


WINDOWS = {"yesterday": yesterday, "lastweek": lastweek, "lastmonth": lastmonth}


def parse_range(start: date | None, end: date | None = None) -> Period:
    """A given range; a missing end means one day."""
    if start is None:
        raise ValueError("a start date is required")
    period = Period(start, start if end is None else end)
    if period.end < period.start:
        raise ValueError("the end date must not lie before the start date")
    return period


def review_period(start: date | None, end: date | None, as_of: date) -> Period:
    """Range of a review: the previous month unless a start is given."""
    return lastmonth(as_of) if start is None else parse_range(start, end)


def resolve_target_dates(start: str | None, end: str | None, as_of: date) -> Period:
    """Load range from ISO texts: both empty mean the day before ``as_of``."""
    if not start and not end:
        return yesterday(as_of)
    if not (start and end):
        raise ValueError("give both dates or none")
    return parse_range(date.fromisoformat(start), date.fromisoformat(end))


def date_rows(spark: SparkSession, period: Period, name: str = "date") -> DataFrame:
    """One row per day of the period, oldest first."""
    days = F.sequence(F.lit(period.start), F.lit(period.end))
    return spark.range(1).select(F.explode(days).alias(name))


def week_start(column: Column) -> Column:
    """Monday of the week."""
    return F.date_trunc("week", column).cast("date")


def month_start(column: Column) -> Column:
    return F.trunc(column, "MM")


def month_end(column: Column) -> Column:
    return F.last_day(column)


def days_in_month(column: Column) -> Column:
    return F.dayofmonth(F.last_day(column))


def window_columns(as_of: Column) -> dict[str, tuple[Column, Column]]:
    """First and last day of each named window, for a column of days."""
    before, week, month = F.date_sub(as_of, 1), week_start(as_of), month_start(as_of)
    return {
        "yesterday": (before, before),
        "lastweek": (F.date_sub(week, 7), F.date_sub(week, 1)),
        "lastmonth": (F.add_months(month, -1), F.date_sub(month, 1)),
    }


# What is wrong with a given range.
NO_START, WRONG_ORDER, ONE_DATE, NO_DATE = "start missing", "end before start", "one date missing", "not a date"


def _range(start: Column, end: Column, problem: Column) -> Column:
    ordered = F.coalesce(problem, F.when(end < start, WRONG_ORDER))
    whole = ordered.isNull()
    return F.struct(F.when(whole, start).alias("start"), F.when(whole, end).alias("end"), ordered.alias("problem"))


def parsed_range(start: Column, end: Column) -> Column:
    """``parse_range`` of date columns: start, end and what is wrong, which leaves both NULL."""
    return _range(start, F.coalesce(end, start), F.when(start.isNull(), NO_START))


def resolved_review_period(start: Column, end: Column, as_of: Column) -> Column:
    """``review_period`` of date columns: start, end and what is wrong."""
    first, last = window_columns(as_of)["lastmonth"]
    return F.when(start.isNull(), _range(first, last, F.lit(None).cast("string"))).otherwise(parsed_range(start, end))


def resolved_target_dates(start: Column, end: Column, as_of: Column) -> Column:
    """``resolve_target_dates`` of ISO text columns: start, end and what is wrong; blank texts are none."""
    first, last = F.nullif(start, F.lit("")), F.nullif(end, F.lit(""))
    neither = first.isNull() & last.isNull()
    iso = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
    days = [F.when(text.rlike(iso), F.try_to_date(text, "yyyy-MM-dd")) for text in (first, last)]
    problem = F.when(first.isNull() | last.isNull(), ONE_DATE).when(days[0].isNull() | days[1].isNull(), NO_DATE)
    before = window_columns(as_of)["yesterday"]
    return F.when(neither, _range(*before, F.lit(None).cast("string"))).otherwise(_range(*days, problem))


def with_periods(df: DataFrame, as_of: str = "as_of", start: str = "start_date", end: str = "end_date") -> DataFrame:
    """Rows with the review period and the load range that their day and their given ISO texts mean.

    One job thus serves reviews of many days. Adds ``review`` and ``load``, each with start, end
    and problem; a text that is no date is a problem of both.
    """
    day = F.col(as_of)
    first, last = F.nullif(F.col(start), F.lit("")), F.nullif(F.col(end), F.lit(""))
    review = resolved_review_period(F.try_to_date(first, "yyyy-MM-dd"), F.try_to_date(last, "yyyy-MM-dd"), day)
    unread = (first.isNotNull() & F.try_to_date(first, "yyyy-MM-dd").isNull()) | (
        last.isNotNull() & F.try_to_date(last, "yyyy-MM-dd").isNull()
    )
    none = F.lit(None).cast("date")
    wrong = F.struct(none.alias("start"), none.alias("end"), F.lit(NO_DATE).alias("problem"))
    return df.withColumns(
        {"review": F.when(unread, wrong).otherwise(review), "load": resolved_target_dates(F.col(start), F.col(end), day)}
    )


def in_given_period(days: DataFrame, periods: DataFrame, period: str = "review", column: str = "date") -> DataFrame:
    """Rows of daily figures with each period that holds their day.

    Each period is a row per day, so that figures meet it by an equi-join. ``periods`` without
    start and end, those with a problem, meet no day. The day is named ``column`` on both sides.
    """
    held = periods.where(F.col(f"{period}.start").isNotNull())
    each = F.explode(F.sequence(F.col(f"{period}.start"), F.col(f"{period}.end")))
    return days.join(held.withColumn(column, each), column)
