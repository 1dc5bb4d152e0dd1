"""Tables of a database, scanned in parallel over ranges of a column."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date, timedelta
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from adtide.functions.dates import Period
from adtide.sources.tables import LAYERS, conform

#: Rows that a scan fetches at once.
FETCHED_ROWS = 10_000


class Ranges(NamedTuple):
    """A whole-number or date column and the bounds that its scan is cut into parts between.

    The bounds shape the parts only; rows outside them and rows without a value are read too.
    """

    column: str
    lower: int | date
    upper: int | date
    parts: int

    def cuts(self) -> list[int | date]:
        """First values of all parts but the first, rising and without repeats."""
        if self.parts < 1 or self.upper < self.lower:
            raise ValueError("a scan needs one part or more and bounds in order")
        is_date = isinstance(self.lower, date)
        width = (self.upper - self.lower).days if is_date else self.upper - self.lower
        steps = [width * part // self.parts for part in range(1, self.parts)]
        found = [self.lower + timedelta(days=s) if is_date else self.lower + s for s in steps]
        return [value for value in dict.fromkeys(found) if value > self.lower]

    def predicates(self) -> list[str]:
        """Conditions of which every row meets exactly one."""
        name = '"' + self.column.replace('"', '""') + '"'
        marks = [f"DATE '{c.isoformat()}'" if isinstance(c, date) else str(c) for c in self.cuts()]
        if not marks:
            return ["1 = 1"]
        inner = [f"{name} >= {low} AND {name} < {high}" for low, high in zip(marks, marks[1:], strict=False)]
        return [f"{name} < {marks[0]} OR {name} IS NULL", *inner, f"{name} >= {marks[-1]}"]


def day_ranges(column: str, period: Period, parts: int) -> Ranges:
    """Parts of about as many days each."""
    return Ranges(column, period.start, period.end + timedelta(days=1), parts)


def read_database_table(
    spark: SparkSession,
    url: str,
    layer: str,
    name: str,
    schema: StructType | None = None,
    ranges: Ranges | None = None,
    properties: Mapping[str, str] | None = None,
) -> DataFrame:
    """A table of the database, one scan task per range.

    Filters and the choice of columns reach the database, as Spark pushes both into each
    part's query. Without ``ranges`` a single task reads the table. With a declared schema
    its columns come in order and type, missing ones as NULL. A failing query fails the job.
    """
    if layer not in LAYERS:
        raise ValueError(f"unknown layer {layer!r}")
    options = {"fetchsize": str(FETCHED_ROWS), "pushDownPredicate": "true", **(properties or {})}
    predicates = ranges.predicates() if ranges else None
    rows = spark.read.jdbc(url, f"{layer}.{name}", predicates=predicates, properties=options)
    return conform(rows, schema) if schema else rows
