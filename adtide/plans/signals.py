"""Rule signals of an account review, as column expressions over account facts.

Facts are one row per account: ``spend`` and ``roas`` of the period, ``pace_flag``,
``pct_consumed`` and ``days_elapsed_pct`` of the month, and for each list rule the
number of offenders and the first names (or the total spend).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adtide.functions.numeric import fixed_text
from adtide.functions.text import first_names

ROAS_CRITICAL = 1.0
MIN_SPEND = 50.0
MIN_WASTED_TERMS = 5
LISTED_NAMES = 5

# Codes, severities and message texts of the signals. `{}` is a slot.
RULES = {
    "roas_below_one": (
        "critical",
        "ROAS de {} com spend R$ {} "
        "— a conta está gastando mais do que fatura em conversão atribuída.",
    ),
    "budget_over_pace": (
        "warning",
        "Spend do mês em {}% com apenas {}% do mês decorrido.",
    ),
    "budget_under_pace": (
        "info",
        "Spend do mês em {}% com {}% do mês decorrido — veicular mais.",
    ),
    "campaigns_with_zero_conversions": (
        "warning",
        "{} campanhas com spend sem nenhuma conversão: {}",
    ),
    "search_terms_wasting_spend": (
        "warning",
        "{} search terms com R$ {} de spend sem conversão — candidatos a negativa.",
    ),
    "campaigns_without_negatives": (
        "info",
        "{} campanhas sem negativas: {}",
    ),
}


def _signal(code: str, fires: Column, *slots: Column) -> Column:
    severity, text = RULES[code]
    pieces = text.split("{}")
    message = [F.lit(pieces[0])]
    for slot, piece in zip(slots, pieces[1:], strict=True):
        message += [slot.cast("string"), F.lit(piece)]
    return F.when(
        fires,
        F.struct(
            F.lit(code).alias("code"),
            F.lit(severity).alias("severity"),
            F.concat(*message).alias("message"),
        ),
    )


def roas_below_one() -> Column:
    spend, roas = F.col("spend"), F.col("roas")
    fires = (spend >= MIN_SPEND) & (roas < ROAS_CRITICAL)
    return _signal("roas_below_one", fires, fixed_text("roas", 2), fixed_text("spend", 2))


def _pace(code: str, flag: str) -> Column:
    consumed = F.col("pct_consumed")
    fires = (F.col("pace_flag") == flag) & consumed.isNotNull()
    return _signal(code, fires, fixed_text("pct_consumed", 1), fixed_text("days_elapsed_pct", 1))


def budget_over_pace() -> Column:
    return _pace("budget_over_pace", "over")


def budget_under_pace() -> Column:
    return _pace("budget_under_pace", "under")


def campaigns_with_zero_conversions() -> Column:
    count = F.col("zero_conversion_count")
    names = first_names(F.col("zero_conversion_names"), LISTED_NAMES)
    return _signal("campaigns_with_zero_conversions", count > 0, count, names)


def search_terms_wasting_spend() -> Column:
    count = F.col("wasted_count")
    total = fixed_text("wasted_spend", 2)
    return _signal("search_terms_wasting_spend", count >= MIN_WASTED_TERMS, count, total)


def campaigns_without_negatives() -> Column:
    count = F.col("uncovered_count")
    names = first_names(F.col("uncovered_names"), LISTED_NAMES)
    return _signal("campaigns_without_negatives", count > 0, count, names)


def evaluate_all() -> Column:
    """The signals that fire, in rule order."""
    rules = F.array(
        roas_below_one(),
        budget_over_pace(),
        budget_under_pace(),
        campaigns_with_zero_conversions(),
        search_terms_wasting_spend(),
        campaigns_without_negatives(),
    )
    return F.filter(rules, lambda signal: signal.isNotNull())


def signal_rows(facts: DataFrame) -> DataFrame:
    """One row per account and fired signal with its place in the list."""
    fired = facts.select("account_id", F.posexplode(evaluate_all()).alias("position", "signal"))
    return fired.select(
        "account_id",
        (F.col("position") + 1).alias("position"),
        "signal.code",
        "signal.severity",
        "signal.message",
    )
