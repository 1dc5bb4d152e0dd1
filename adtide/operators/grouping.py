"""Grouping with text aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def totals_by(df: DataFrame, keys: Sequence[str], *aggregates: Column) -> DataFrame:
    """``groupBy(keys).agg(aggregates)`` for aggregates that include ``max`` of a text.

    Text buffers cannot be updated in place, so Spark sorts instead of hashing. A
    hash of the key leads that sort: one 64-bit comparison settles nearly every
    pair of rows, where the key alone takes one text comparison per column.
    """
    grouped = df.groupBy(F.xxhash64(*keys).alias("_key_hash"), *keys)
    return grouped.agg(*aggregates).drop("_key_hash")
