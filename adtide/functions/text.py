"""Text helpers for identifiers, keys and messages."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ACCOUNT_PREFIX = "act_"


def normalize_account_id(column: Column) -> Column:
    """Meta account id with its ``act_`` prefix, added once."""
    return F.when(column.startswith(ACCOUNT_PREFIX), column).otherwise(
        F.concat(F.lit(ACCOUNT_PREFIX), column)
    )


def blank_nulls(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """NULL becomes ``''`` so that the columns can be parts of a natural key."""
    return df.withColumns({name: F.coalesce(F.col(name), F.lit("")) for name in columns})


def key_hash(column: Column, pepper: str) -> Column:
    """Stored form of an API key: SHA-256 of the key followed by the pepper."""
    return F.sha2(F.concat(column, F.lit(pepper)), 256)


def first_names(names: Column, n: int = 5) -> Column:
    """The first ``n`` elements of a text array, comma separated."""
    return F.array_join(F.slice(names, 1, n), ", ")
