"""The declared checks of every model."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adtide.operators.quality import (
    Check,
    accepted_values,
    expression_is_true,
    not_null,
    run_checks,
    run_checks_with_key,
)
from adtide.schemas import GOOGLE, META, PACE_FLAGS, PLATFORMS, ROLES, SCOPES


def _spend_at_least_zero() -> list[Check]:
    return expression_is_true("spend", F.col("spend") >= 0)


def _spend_positive() -> list[Check]:
    return expression_is_true("spend", F.col("spend") > 0)


def _platform(*values: str) -> list[Check]:
    return accepted_values("platform", values)


def model_checks() -> dict[str, list[Check]]:
    """Row conditions per model, named ``layer.table``."""
    figures = ("impressions", "clicks", "spend")
    return {
        "silver.google_ads": not_null("account_id", "campaign_id", "date", "platform", *figures)
        + _platform(GOOGLE),
        "silver.meta_ads": not_null(
            "account_id", "ad_id", "campaign_id", "date", "platform", *figures
        )
        + _platform(META),
        "silver.unified_campaigns": not_null("account_id", "campaign_id", "date", "platform")
        + _platform(*PLATFORMS),
        "silver.google_ads_keywords_dedup": not_null(
            "account_id", "keyword_id", "keyword_text", "date", "platform"
        )
        + _platform(GOOGLE),
        "silver.google_search_terms_dedup": not_null("account_id", "search_term", "date"),
        "silver.google_negatives_dedup": not_null(
            "account_id", "criterion_id", "scope", "snapshot_date"
        )
        + accepted_values("scope", SCOPES),
        "gold.daily_performance": not_null(
            "account_id", "date", "platform", "impressions", "spend"
        )
        + _platform(*PLATFORMS)
        + _spend_at_least_zero(),
        "gold.weekly_performance": not_null("account_id", "week_start", "platform", "spend")
        + _platform(*PLATFORMS)
        + _spend_at_least_zero(),
        "gold.google_ads_keywords": not_null("account_id", "keyword_text", "date", "spend")
        + _spend_positive(),
        "gold.google_search_terms": not_null("account_id", "search_term", "date", "spend")
        + _spend_positive(),
        "gold.google_negatives": not_null("account_id", "criterion_id", "scope")
        + accepted_values("scope", SCOPES),
        "gold.budget_pacing": not_null("account_id", "platform", "pace_flag")
        + _platform(*PLATFORMS)
        + accepted_values("pace_flag", PACE_FLAGS),
        "ops.client_budget": not_null("account_id", "platform", "monthly_budget")
        + _platform(*PLATFORMS)
        + expression_is_true("monthly_budget", F.col("monthly_budget") > 0),
        "ops.managed_accounts": not_null("account_id", "platform") + _platform(*PLATFORMS),
        "users.app_users": not_null("id", "email", "role") + accepted_values("role", ROLES),
    }


# Declared uniqueness. It is narrower than the grouping of some models on purpose:
# the check reports such rows instead of assuming that there are none.
UNIQUE_KEYS = {
    "gold.daily_performance": ("account_id", "date", "platform"),
    "gold.weekly_performance": ("account_id", "week_start", "platform"),
    "gold.google_ads_keywords": (
        "account_id",
        "keyword_text",
        "ad_group_name",
        "campaign_name",
        "date",
    ),
    "gold.google_search_terms": (
        "account_id",
        "ad_group_name",
        "search_term",
        "matched_keyword_text",
        "matched_keyword_match_type",
        "date",
    ),
    "ops.client_budget": ("account_id", "platform"),
    "ops.managed_accounts": ("account_id", "platform"),
    "users.app_users": ("email",),
}


def checked_columns(name: str) -> list[str]:
    """The columns the checks of a model read; the rest need not be computed."""
    columns = [check.column for check in model_checks()[name]]
    return list(dict.fromkeys([*columns, *UNIQUE_KEYS.get(name, ())]))


def check_models(models: dict[str, DataFrame]) -> DataFrame:
    """Declared checks of the given models, one pass over each."""
    declared = model_checks()
    reports = [
        run_checks_with_key(df, name, declared[name], UNIQUE_KEYS[name])
        if name in UNIQUE_KEYS
        else run_checks(df, name, declared[name])
        for name, df in models.items()
    ]
    return reduce(DataFrame.unionByName, reports)


def failed(report: DataFrame) -> DataFrame:
    broken: Column = F.col("failures") > 0
    return report.where(broken)
