"""Latest-wins de-duplication and snapshot selection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adtide.schemas import BronzeTable


def latest_by_key(
    df: DataFrame,
    keys: Sequence[Column | str],
    order_col: str = "_extracted_at",
    ties: Sequence[Column] = (),
) -> DataFrame:
    """One row per key: the newest, an unknown load time counting as newest.

    Spark turns ``row_number() = 1`` into a group limit on both sides of the
    shuffle, so a key with very many copies sends one row per input task and no
    task ever sees the whole group. ``ties`` orders rows of equal load time.

    A hash of the key leads the sort: one 64-bit comparison then settles nearly
    every pair of rows, instead of one text comparison per key column.
    """
    newest = Window.partitionBy(F.xxhash64(*keys), *keys).orderBy(F.desc_nulls_first(order_col), *ties)
    return df.withColumn("rn", F.row_number().over(newest)).where("rn = 1").drop("rn")


def bronze_dedup(df: DataFrame, table: BronzeTable, ties: Sequence[Column] = ()) -> DataFrame:
    """Raw table reduced to one row per natural key, before uniqueness is relied on."""
    return latest_by_key(df, table.keys, ties=ties)


def latest_snapshot(
    df: DataFrame,
    day_col: str = "snapshot_date",
    per_account: bool = False,
    days_from: DataFrame | None = None,
) -> DataFrame:
    """Rows of the newest snapshot, over all accounts or of each account.

    The global day is a scalar subquery, so it reaches the scan as a filter and
    older snapshots are neither de-duplicated nor shuffled. ``days_from`` is a
    cheaper table with the same days (and accounts), such as the rows before
    their de-duplication.
    """
    days = df if days_from is None else days_from
    if not per_account:
        return df.where(F.col(day_col) == days.agg(F.max(day_col)).scalar())
    newest = days.groupBy("account_id").agg(F.max(day_col).alias(day_col))
    return df.join(newest, ["account_id", day_col])
