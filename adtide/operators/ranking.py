"""Top-k per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adtide.sources.tables import staged


def top_per_group(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int, rank: str = "position"
) -> DataFrame:
    """First ``k`` rows of every group with their 1-based position.

    Each input task keeps at most ``k`` rows of a group before the shuffle, so one
    huge group costs no more than ``k`` rows per task.
    """
    window = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= k)


def positions(
    df: DataFrame, group: str, order: Sequence[Column], name: str = "position"
) -> DataFrame:
    """All rows with their 1-based position in their group, whatever its size.

    The rows are sorted in ranges, so that a huge group is numbered by many tasks; what
    is added up afterwards has a row per group and range.
    """
    ranged = df.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    # the upper bits are the range, the lower ones the place in it
    numbered = staged(ranged.withColumn("_number", F.monotonically_increasing_id()), "ranges")
    numbered = numbered.withColumn("_range", F.shiftright("_number", 33))
    spans = numbered.groupBy(group, "_range").agg(
        F.min("_number").alias("_first"), F.count("*").alias("_rows")
    )
    earlier = Window.partitionBy(group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.withColumn("_before", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
    spans = spans.select(F.col(group).alias("_group"), F.col("_range").alias("_of"), "_first", "_before")
    same = F.col(group).eqNullSafe(F.col("_group")) & (F.col("_range") == F.col("_of"))
    place = F.col("_number") - F.col("_first") + F.col("_before") + 1
    return numbered.join(spans, same).select(*df.columns, place.alias(name))


def first_platform(df: DataFrame) -> DataFrame:
    """One row per account: the alphabetically first platform."""
    rest = [name for name in df.columns if name != "account_id"]
    return (
        df.groupBy("account_id")
        .agg(F.min_by(F.struct(*rest), F.col("platform")).alias("first"))
        .select("account_id", *[F.col(f"first.{name}").alias(name) for name in rest])
    )
