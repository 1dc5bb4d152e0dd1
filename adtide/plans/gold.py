"""Gold models: KPI tables, latest negatives and budget pacing."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adtide.functions.dates import days_in_month, month_end, month_start, week_start
from adtide.functions.numeric import exact_avg, exact_round, exact_sum
from adtide.functions.text import normalize_account_id
from adtide.operators.filters import active_only, having_positive
from adtide.operators.grouping import totals_by
from adtide.operators.kpis import add_kpis, table_roas
from adtide.operators.latest import latest_snapshot
from adtide.schemas import META

PACE_MARGIN = 10.0  # percentage points around the elapsed share of the month


def _totals(with_value: bool = True) -> list[Column]:
    totals = [
        F.sum("impressions").alias("impressions"),
        F.sum("clicks").alias("clicks"),
        exact_sum("spend").alias("spend"),
        exact_sum("conversions").alias("conversions"),
    ]
    if with_value:
        value = exact_sum("coalesce(conversion_value, 0D)")
        totals.append(value.alias("conversion_value"))
    return totals


def daily_performance(unified: DataFrame) -> DataFrame:
    """KPIs per account, day and platform."""
    keys = ["account_id", "account_name", "date", "platform"]
    return add_kpis(having_positive(unified.groupBy(*keys).agg(*_totals())))


def weekly_performance(unified: DataFrame) -> DataFrame:
    """KPIs per account, Monday-based week and platform."""
    totals = unified.groupBy(
        "account_id", "account_name", "platform", week_start(F.col("date")).alias("week_start")
    ).agg(
        F.min("date").alias("period_start"),
        F.max("date").alias("period_end"),
        *_totals(with_value=False),
    )
    return add_kpis(having_positive(totals), with_roas=False)


def gold_keywords(silver: DataFrame) -> DataFrame:
    """Keyword KPIs per day. The quality score is an unweighted mean of daily means."""
    totals = totals_by(
        silver,
        [
            "account_id",
            "account_name",
            "campaign_name",
            "ad_group_name",
            "keyword_text",
            "match_type",
            "date",
        ],
        *_totals(),
        exact_avg("quality_score").alias("quality_score"),
        F.max("campaign_status").alias("campaign_status"),
        F.max("ad_group_status").alias("ad_group_status"),
        F.max("criterion_status").alias("criterion_status"),
    )
    return having_positive(totals).withColumn("roas", table_roas())


def gold_search_terms(silver: DataFrame) -> DataFrame:
    """Search-term KPIs per day."""
    totals = silver.groupBy(
        "account_id",
        "account_name",
        "campaign_name",
        "ad_group_name",
        "search_term",
        "search_term_status",
        "matched_keyword_text",
        "matched_keyword_match_type",
        "date",
    ).agg(*_totals())
    return having_positive(totals).withColumn("roas", table_roas())


def gold_negatives(
    silver: DataFrame, per_account: bool = False, days_from: DataFrame | None = None
) -> DataFrame:
    """Negative keywords of the newest snapshot.

    By default one day counts for everybody, so an account missing from the newest
    snapshot has no negatives; ``per_account`` takes each account's own newest day.
    """
    return latest_snapshot(silver, per_account=per_account, days_from=days_from).select(
        "account_id",
        "campaign_id",
        "campaign_name",
        "ad_group_id",
        "ad_group_name",
        "criterion_id",
        "criterion_text",
        "match_type",
        "scope",
        "snapshot_date",
    )


def month_calendar(as_of: date) -> dict[str, Column]:
    """Calendar of the month of ``as_of`` as constants, folded by the optimizer."""
    day = F.lit(as_of)
    return {
        "month_start": month_start(day),
        "month_end": month_end(day),
        "days_in_month": days_in_month(day),
        "day_of_month": F.dayofmonth(day),
    }


def spend_mtd(daily: DataFrame, as_of: date, cap_at_as_of: bool = False) -> DataFrame:
    """Spend per account and platform in the month of ``as_of``.

    The whole month counts, days after ``as_of`` included, unless a past day is
    replayed with ``cap_at_as_of``.
    """
    calendar = month_calendar(as_of)
    last = F.lit(as_of) if cap_at_as_of else calendar["month_end"]
    return (
        daily.where(F.col("date").between(calendar["month_start"], last))
        .groupBy("account_id", "platform")
        .agg(exact_sum("spend").alias("spent_mtd"))
    )


def budget_with_spend(budget: DataFrame, mtd: DataFrame) -> DataFrame:
    """Active budgets with the month's spend; no spend is zero."""
    return (
        active_only(budget)
        .join(mtd, ["account_id", "platform"], "left")
        .withColumns(
            {
                "monthly_budget": F.col("monthly_budget").cast("double"),
                "spent_mtd": F.coalesce("spent_mtd", F.lit(0.0)),
            }
        )
    )


def budget_pacing(
    budget: DataFrame,
    daily: DataFrame,
    as_of: date,
    cap_at_as_of: bool = False,
    prefix_meta_ids: bool = False,
) -> DataFrame:
    """Spend of the month against the budget and the elapsed share of the month.

    ``prefix_meta_ids`` adds the ``act_`` prefix to Meta account ids of the spend
    side, for budgets registered under prefixed ids.
    """
    mtd = spend_mtd(daily, as_of, cap_at_as_of)
    if prefix_meta_ids:
        account = F.col("account_id")
        prefixed = F.when(F.col("platform") == META, normalize_account_id(account))
        mtd = mtd.withColumn("account_id", prefixed.otherwise(account))
    calendar = month_calendar(as_of)
    consumed = F.expr("spent_mtd * 100D / nullif(monthly_budget, 0D)")
    elapsed = calendar["day_of_month"] * F.lit(100.0) / calendar["days_in_month"]
    rows = budget_with_spend(budget, mtd)
    rows = rows.withColumns({"consumed": consumed, "elapsed": elapsed})
    consumed, elapsed = F.col("consumed"), F.col("elapsed")
    flag = (
        F.when(F.col("monthly_budget") == 0, "unknown")
        .when(consumed > elapsed + PACE_MARGIN, "over")
        .when(consumed < elapsed - PACE_MARGIN, "under")
        .otherwise("on_track")
    )
    return rows.select(
        "account_id",
        "platform",
        "monthly_budget",
        "currency",
        exact_round("spent_mtd", 2).alias("spent_mtd"),
        exact_round("consumed", 2).alias("pct_consumed"),
        exact_round("elapsed", 2).alias("days_elapsed_pct"),
        flag.alias("pace_flag"),
    )
