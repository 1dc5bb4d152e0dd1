"""Data-quality checks as data: one row per check with its number of failures."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from adtide.functions.actions import is_action_list
from adtide.session import new_workspace


class Check(NamedTuple):
    """A row condition that must not hold."""

    name: str
    column: str
    broken: Column


def not_null(*columns: str) -> list[Check]:
    return [Check("not_null", name, F.col(name).isNull()) for name in columns]


def accepted_values(column: str, values: Sequence[str]) -> list[Check]:
    """Values outside the list; NULL is left to ``not_null``."""
    return [Check("accepted_values", column, ~F.col(column).isin(*values))]


def expression_is_true(column: str, condition: Column) -> list[Check]:
    return [Check("expression_is_true", column, ~condition)]


def action_text(column: str) -> list[Check]:
    """Text that is no JSON array of actions."""
    return [Check("action_list", column, ~is_action_list(F.col(column)))]


def run_checks(df: DataFrame, model: str, checks: Sequence[Check]) -> DataFrame:
    """All row conditions of a model in one pass over it."""
    counts = df.agg(*[F.count_if(c.broken).alias(f"c{i}") for i, c in enumerate(checks)])
    rows = [
        F.struct(
            F.lit(model).alias("model"),
            F.lit(check.name).alias("check"),
            F.lit(check.column).alias("column"),
            F.col(f"c{i}").alias("failures"),
        )
        for i, check in enumerate(checks)
    ]
    return counts.select(F.inline(F.array(*rows)))


def unique_combination(df: DataFrame, model: str, keys: Sequence[str]) -> DataFrame:
    """Number of key values held by more than one row."""
    repeated = df.groupBy(*keys).agg(F.count("*").alias("copies")).where("copies > 1")
    return repeated.agg(F.count("*").alias("failures")).select(
        F.lit(model).alias("model"),
        F.lit("unique_combination").alias("check"),
        F.lit(",".join(keys)).alias("column"),
        "failures",
    )


def run_checks_with_key(
    df: DataFrame, model: str, checks: Sequence[Check], keys: Sequence[str]
) -> DataFrame:
    """Row conditions and the uniqueness of a key in one pass: counts per key, then their sums."""
    broken = [F.count_if(c.broken).alias(f"c{i}") for i, c in enumerate(checks)]
    by_key = df.groupBy(*keys).agg(F.count("*").alias("copies"), *broken)
    sums = [F.coalesce(F.sum(f"c{i}"), F.lit(0)).alias(f"c{i}") for i in range(len(checks))]
    counts = by_key.agg(F.count_if(F.col("copies") > 1).alias("repeated"), *sums)
    found = [(c.name, c.column, f"c{i}") for i, c in enumerate(checks)]
    found.append(("unique_combination", ",".join(keys), "repeated"))
    rows = [
        F.struct(
            F.lit(model).alias("model"),
            F.lit(name).alias("check"),
            F.lit(column).alias("column"),
            F.col(count).alias("failures"),
        )
        for name, column, count in found
    ]
    return counts.select(F.inline(F.array(*rows)))


def dq_not_null(df: DataFrame, model: str, columns: Sequence[str]) -> DataFrame:
    return run_checks(df, model, not_null(*columns))


def dq_accepted_values(
    df: DataFrame, model: str, column: str, values: Sequence[str]
) -> DataFrame:
    return run_checks(df, model, accepted_values(column, values))


def dq_unique(df: DataFrame, model: str, keys: Sequence[str]) -> DataFrame:
    return unique_combination(df, model, keys)


def dq_expression(df: DataFrame, model: str, column: str, condition: Column) -> DataFrame:
    return run_checks(df, model, expression_is_true(column, condition))


class Constrained(NamedTuple):
    """Rows that keep the constraints, rows that do not with ``reasons``, and how many broke which."""

    kept: DataFrame
    refused: DataFrame
    counts: dict[str, int]


def _reason(check: Check) -> str:
    return f"{check.name}({check.column})"


def split_refused(df: DataFrame, checks: Sequence[Check], purpose: str = "constrained") -> Constrained:
    """Part rows that break a constraint from those to be stored, in one pass over them.

    As in a database, a condition that is undefined is not broken. A refused row names every
    constraint it breaks. ``counts`` has the rows, the refused ones and those of each constraint,
    counted while the rows are written; both parts are read from what was written.
    """
    broken = {_reason(c): F.coalesce(c.broken, F.lit(False)) for c in checks}
    reasons = F.array_compact(F.array(*[F.when(flag, F.lit(name)) for name, flag in broken.items()]))
    if not broken:
        reasons = F.array().cast("array<string>")
    marked = df.withColumn("reasons", reasons).withColumn("refused", F.size("reasons") > 0)
    counted = Observation()
    names = list(broken)
    marked = marked.observe(
        counted,
        F.count("*").alias("rows"),
        F.count_if("refused").alias("refused"),
        *[F.count_if(F.array_contains("reasons", name)).alias(f"c{i}") for i, name in enumerate(names)],
    )
    path = new_workspace(df.sparkSession, purpose)
    marked.write.partitionBy("refused").parquet(path)
    rows = df.sparkSession.read.schema(marked.schema).parquet(path)
    got = counted.get
    counts = {"rows": got["rows"], "refused": got["refused"]} | {n: got[f"c{i}"] for i, n in enumerate(names)}
    return Constrained(
        rows.where("not refused").select(*df.columns),
        rows.where("refused").select(*df.columns, "reasons"),
        counts,
    )
