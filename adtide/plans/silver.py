"""Silver models: latest version of every raw record, typed and conformed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adtide.functions.actions import ParseMode, action_conversions
from adtide.functions.numeric import exact_avg, exact_sum
from adtide.operators.filters import non_empty
from adtide.operators.grouping import totals_by
from adtide.operators.latest import latest_by_key
from adtide.schemas import GOOGLE, META

Ties = Sequence[Column]

ACCOUNT_NAMES = {"customer_id": "account_id", "customer_name": "account_name"}


def _zero(name: str, kind: str) -> Column:
    return F.expr(f"CAST(coalesce({name}, 0) AS {kind})").alias(name)


def _counts(*names: str) -> list[Column]:
    return [F.expr(f"sum(coalesce({name}, 0L))").alias(name) for name in names]


def _amounts(*names: str) -> list[Column]:
    return [exact_sum(f"coalesce({name}, 0D)").alias(name) for name in names]


def silver_google_ads(
    bronze: DataFrame, ties: Ties = (), include_ad_group: bool = False
) -> DataFrame:
    """Keyword rows rolled up to account, campaign, device and day.

    The version key leaves the ad group out, so a keyword id used by two ad groups
    keeps one of them; ``include_ad_group`` counts both.
    """
    keys = ["customer_id", "campaign_id", "keyword_id", "device", "date"]
    if include_ad_group:
        keys.append("ad_group_id")
    latest = latest_by_key(bronze, keys, ties=ties or [F.desc("ad_group_id")])
    totals = totals_by(
        latest.withColumnsRenamed(ACCOUNT_NAMES),
        ["account_id", "account_name", "campaign_id", "campaign_name", "device", "date"],
        *_counts("impressions", "clicks"),
        *_amounts(
            "spend",
            "conversions",
            "conversion_value",
            "view_through_conversions",
            "all_conversions",
        ),
        exact_avg("search_impression_share").alias("search_impression_share"),
        F.avg("quality_score").alias("quality_score"),
        F.max("campaign_status").alias("campaign_status"),
        F.max("ad_group_status").alias("ad_group_status"),
        F.max("_extracted_at").alias("_extracted_at"),
    )
    none = F.lit(None).cast("string")
    return totals.select(
        "account_id",
        "account_name",
        "campaign_id",
        "campaign_name",
        none.alias("ad_id"),
        none.alias("ad_name"),
        "device",
        "impressions",
        "clicks",
        "spend",
        "date",
        "conversions",
        "conversion_value",
        "view_through_conversions",
        "all_conversions",
        "search_impression_share",
        "quality_score",
        "campaign_status",
        "ad_group_status",
        none.alias("actions_raw"),
        "_extracted_at",
        F.lit(GOOGLE).alias("platform"),
    )


def silver_keywords(bronze: DataFrame, ties: Ties = ()) -> DataFrame:
    """Keyword-level figures per day, devices added together."""
    keys = ["customer_id", "campaign_id", "ad_group_id", "keyword_id", "device", "date"]
    latest = latest_by_key(non_empty(bronze, "keyword_text"), keys, ties=ties)
    return totals_by(
        latest.withColumnsRenamed(ACCOUNT_NAMES),
        [
            "account_id",
            "account_name",
            "campaign_id",
            "campaign_name",
            "ad_group_id",
            "ad_group_name",
            "keyword_id",
            "keyword_text",
            "match_type",
            "date",
        ],
        *_counts("impressions", "clicks"),
        *_amounts("spend", "conversions", "conversion_value"),
        F.avg("quality_score").alias("quality_score"),
        F.max("campaign_status").alias("campaign_status"),
        F.max("ad_group_status").alias("ad_group_status"),
        F.max("criterion_status").alias("criterion_status"),
        F.max("_extracted_at").alias("_extracted_at"),
    ).withColumn("platform", F.lit(GOOGLE))


def silver_search_terms(bronze: DataFrame, ties: Ties = ()) -> DataFrame:
    """Latest version of every search term, matched keyword and day."""
    keys = [
        "customer_id",
        "ad_group_id",
        "search_term",
        F.coalesce("matched_keyword_text", F.lit("")),
        F.coalesce("matched_keyword_match_type", F.lit("")),
        "date",
    ]
    latest = latest_by_key(non_empty(bronze, "search_term"), keys, ties=ties)
    return latest.select(
        F.col("customer_id").alias("account_id"),
        F.col("customer_name").alias("account_name"),
        "campaign_id",
        "campaign_name",
        "ad_group_id",
        "ad_group_name",
        "search_term",
        "search_term_status",
        "matched_keyword_text",
        "matched_keyword_match_type",
        "date",
        _zero("impressions", "bigint"),
        _zero("clicks", "bigint"),
        _zero("spend", "double"),
        _zero("conversions", "double"),
        _zero("conversion_value", "double"),
        "_extracted_at",
        F.lit(GOOGLE).alias("platform"),
    )


def silver_negatives(bronze: DataFrame, ties: Ties = ()) -> DataFrame:
    """Latest version of every negative keyword of every snapshot."""
    keys = [
        "snapshot_date",
        "customer_id",
        "scope",
        "criterion_id",
        F.coalesce("ad_group_id", F.lit("")),
        F.coalesce("campaign_id", F.lit("")),
    ]
    latest = latest_by_key(non_empty(bronze, "criterion_text"), keys, ties=ties)
    return latest.select(
        F.col("customer_id").alias("account_id"),
        "campaign_id",
        "campaign_name",
        "ad_group_id",
        "ad_group_name",
        "criterion_id",
        "criterion_text",
        "match_type",
        "scope",
        "snapshot_date",
        "_extracted_at",
        F.lit(GOOGLE).alias("platform"),
    )


def silver_meta_ads(bronze: DataFrame, ties: Ties = (), mode: ParseMode = "strict") -> DataFrame:
    """Latest version of every ad and placement per day, with counted conversions."""
    keys = ["account_id", "ad_id", "device_platform", "publisher_platform", "date_start"]
    return latest_by_key(bronze, keys, ties=ties).select(
        "account_id",
        "account_name",
        "campaign_id",
        "campaign_name",
        "ad_id",
        "ad_name",
        _zero("impressions", "bigint"),
        _zero("clicks", "bigint"),
        _zero("spend", "double"),
        F.col("date_start").alias("date"),
        "device_platform",
        "publisher_platform",
        action_conversions(F.col("actions"), mode).alias("conversions"),
        F.col("actions").alias("actions_raw"),
        "_extracted_at",
        F.lit(META).alias("platform"),
    )


def _per_campaign(silver: DataFrame, conversion_value: Column) -> DataFrame:
    return silver.groupBy(
        "account_id", "account_name", "campaign_id", "campaign_name", "date", "platform"
    ).agg(
        F.sum("impressions").alias("impressions"),
        F.sum("clicks").alias("clicks"),
        exact_sum("spend").alias("spend"),
        exact_sum("conversions").alias("conversions"),
        conversion_value.alias("conversion_value"),
    )


def unified_campaigns(meta: DataFrame, google: DataFrame) -> DataFrame:
    """Both platforms at campaign and day. Meta reports no conversion value yet."""
    google_value = exact_sum("coalesce(conversion_value, 0D)")
    return _per_campaign(meta, F.lit(0.0)).unionByName(_per_campaign(google, google_value))
