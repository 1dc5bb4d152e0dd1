"""Derived performance figures. A zero divisor gives NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adtide.functions.numeric import binary_round, ratio


def kpi_columns() -> dict[str, Column]:
    """KPIs of a warehouse table, rounded as SQL ``numeric``."""
    return {
        "ctr": ratio("clicks * 100D", "impressions", 2),
        "cpc": ratio("spend", "clicks", 2),
        "cost_per_conversion": ratio("spend", "conversions", 2),
        "conversion_rate": ratio("conversions * 100D", "clicks", 2),
    }


def table_roas() -> Column:
    """Return on spend of a warehouse row, four decimals."""
    return ratio("conversion_value", "spend", 4)


def add_kpis(df: DataFrame, with_roas: bool = True) -> DataFrame:
    columns = kpi_columns()
    if with_roas:
        columns["roas"] = table_roas()
    return df.withColumns(columns)


def row_roas() -> Column:
    """Return on spend of a review row, rounded on its binary value."""
    return binary_round("conversion_value / nullif(spend, 0D)", 4)


def period_kpis(df: DataFrame) -> DataFrame:
    """KPIs on the totals of a review period; missing totals count as zero."""
    counts = {name: F.expr(f"coalesce({name}, 0L)") for name in ("impressions", "clicks")}
    amounts = {
        name: F.expr(f"coalesce({name}, 0D)")
        for name in ("spend", "conversions", "conversion_value")
    }
    return df.withColumns(counts | amounts).withColumns(
        {
            "ctr": binary_round("clicks / nullif(impressions, 0L) * 100", 2),
            "cpc": binary_round("spend / nullif(clicks, 0L)", 2),
            "cpa": binary_round("spend / nullif(conversions, 0D)", 2),
            "roas": row_roas(),
        }
    )
