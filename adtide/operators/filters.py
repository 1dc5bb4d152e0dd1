"""Row filters shared by the models and the metric queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adtide.functions.dates import Period


def non_empty(df: DataFrame, column: str) -> DataFrame:
    """Keep rows whose text is neither NULL nor blank."""
    return df.where(F.col(column).isNotNull() & (F.col(column) != ""))


drop_blank = non_empty


def in_range(df: DataFrame, period: Period, column: str = "date") -> DataFrame:
    return df.where(F.col(column).between(F.lit(period.start), F.lit(period.end)))


def for_account(df: DataFrame, account: str | None = None, column: str = "account_id") -> DataFrame:
    """Narrow to one account, or leave all of them."""
    return df.where(F.col(column) == account) if account else df


def for_platform(df: DataFrame, platform: str | None = None) -> DataFrame:
    return df.where(F.col("platform") == platform) if platform else df


def active_only(df: DataFrame) -> DataFrame:
    return df.where(F.col("active"))


def having_positive(df: DataFrame, column: str = "spend") -> DataFrame:
    """Post-aggregate filter: only groups that cost something."""
    return df.where(F.col(column) > 0)


def zero_conversions(df: DataFrame) -> DataFrame:
    return df.where(F.col("conversions") == 0)


def roas_above(df: DataFrame, threshold: float = 1.0) -> DataFrame:
    """Keep rows above a return on spend; an undefined return does not pass."""
    return df.where(F.col("roas") > threshold)


def not_revoked(df: DataFrame) -> DataFrame:
    return df.where(F.col("revoked_at").isNull())
