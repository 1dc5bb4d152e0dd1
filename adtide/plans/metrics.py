"""Metric queries over gold tables. Raw and silver tables are never read here."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adtide.functions.dates import WINDOWS, Period
from adtide.functions.numeric import exact_sum
from adtide.operators.filters import for_account, for_platform, in_range
from adtide.operators.grouping import totals_by

DAILY_COLUMNS = (
    "account_id",
    "account_name",
    "date",
    "platform",
    "impressions",
    "clicks",
    "spend",
    "conversions",
    "ctr",
    "cpc",
    "cost_per_conversion",
    "conversion_rate",
)


def daily_range(
    daily: DataFrame, platform: str, period: Period, account: str | None = None
) -> DataFrame:
    """Daily figures of one platform, oldest day first."""
    rows = for_account(in_range(for_platform(daily, platform), period), account)
    return rows.select(*DAILY_COLUMNS).orderBy("date", "account_id")


def daily_window(
    daily: DataFrame, platform: str, window: str, as_of: date, account: str | None = None
) -> DataFrame:
    """Daily figures of a named window: yesterday, lastweek or lastmonth."""
    return daily_range(daily, platform, WINDOWS[window](as_of), account)


def keywords_range(keywords: DataFrame, period: Period, account: str | None = None) -> DataFrame:
    """Keyword totals of a range, busiest keyword of each account first."""
    return (
        totals_by(
            for_account(in_range(keywords, period), account),
            ["account_id", "keyword_text", "ad_group_name", "campaign_name"],
            F.max("account_name").alias("account_name"),
            F.max("match_type").alias("match_type"),
            F.sum("impressions").alias("impressions"),
            F.sum("clicks").alias("clicks"),
            exact_sum("spend").alias("spend"),
            exact_sum("conversions").alias("conversions"),
        )
        .select(
            "account_id",
            "account_name",
            "campaign_name",
            "ad_group_name",
            "keyword_text",
            "match_type",
            "impressions",
            "clicks",
            "spend",
            "conversions",
        )
        .orderBy(
            "account_id",
            F.desc("impressions"),
            "keyword_text",
            "ad_group_name",
            "campaign_name",
        )
    )


def clients(daily: DataFrame, account: str | None = None) -> DataFrame:
    """Accounts that ever spent, with the ordered list of their platforms."""
    return (
        for_account(daily, account)
        .groupBy("account_id")
        .agg(
            F.max("account_name").alias("account_name"),
            F.array_sort(F.collect_set("platform")).alias("platforms"),
        )
        .orderBy("account_id")
    )


def budgets(
    budget: DataFrame, account: str | None = None, platform: str | None = None
) -> DataFrame:
    """Registered budgets, google before meta."""
    rows = for_platform(for_account(budget, account), platform)
    return rows.withColumn("monthly_budget", F.col("monthly_budget").cast("double")).orderBy(
        "account_id", "platform"
    )
