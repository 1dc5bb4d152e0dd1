"""Access tables as batch reports."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adtide.operators.filters import not_revoked

IDLE_DAYS = 14


def keys_with_users(keys: DataFrame, users: DataFrame) -> DataFrame:
    """Every key with the role and state of its user, if it has one."""
    owners = users.select(F.col("id").alias("user_id"), "role", "disabled_at")
    # keys without a user meet nobody; in the join they would all go to one task
    owned = keys.where("user_id IS NOT NULL").join(owners, "user_id", "left")
    return owned.unionByName(keys.where("user_id IS NULL"), allowMissingColumns=True)


def is_idle(last_used: Column, at: datetime, days: int = IDLE_DAYS) -> Column:
    """Not used for longer than ``days``; a key never used is not idle."""
    now = F.lit(at.isoformat(sep=" ")).cast("timestamp_ntz")
    return F.coalesce(now - last_used > F.expr(f"INTERVAL '{days}' DAY"), F.lit(False))


def api_key_status(keys: DataFrame, users: DataFrame, as_of: datetime) -> DataFrame:
    """State of every API key: revoked, then disabled, then expired, else valid."""
    status = (
        F.when(F.col("revoked_at").isNotNull(), "revoked")
        .when(F.col("disabled_at").isNotNull(), "disabled")
        .when(is_idle(F.col("last_used_at"), as_of), "expired")
        .otherwise("valid")
    )
    return keys_with_users(keys, users).select(
        "id", "user_id", "role", "last_used_at", status.alias("status")
    )


def live_key_status(keys: DataFrame, users: DataFrame, as_of: datetime) -> DataFrame:
    """State of the keys that were never revoked."""
    return api_key_status(not_revoked(keys), users, as_of)


def admin_keys(status: DataFrame) -> DataFrame:
    """Keys that may read the user list: valid and owned by an administrator."""
    return status.where((F.col("status") == "valid") & (F.col("role") == "admin"))


def list_users(users: DataFrame) -> DataFrame:
    return users.select("id", "email", "name", "role", "created_at", "disabled_at").orderBy("id")
