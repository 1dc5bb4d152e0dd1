"""Load ledger: how each unit of a load went, how often it was tried, and what is still to load."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adtide.operators.upsert import OpsTable, load_units, merged
from adtide.schemas import LEDGER_KEYS, LOAD_LEDGER, BronzeTable
from adtide.sources.tables import conform, staged

# Fixed value: times that a failed unit is tried before it is left to an operator.
MAX_ATTEMPTS = 3
UNIT = ("date", "account_id")


def of_table(ledger: DataFrame, table: str) -> DataFrame:
    return ledger.where(F.col("table_name") == table)


def is_done() -> Column:
    """Units that need no further load: stored, or without activity."""
    return F.col("status").isin("loaded", "empty")


def recorded(ledger: DataFrame, results: DataFrame, table: str, at: datetime) -> DataFrame:
    """Ledger after a run: its units with their new status and one attempt more, all others as before.

    results: a row per unit as ``load_results`` gives them.
    """
    tried = of_table(ledger, table).select(*UNIT, F.col("attempts").alias("tried"))
    counted = (F.coalesce("tried", F.lit(0)) + 1).alias("attempts")
    now = F.lit(at.isoformat(sep=" ")).cast("timestamp_ntz")
    rows = results.join(tried, list(UNIT), "left").select(
        F.lit(table).alias("table_name"), *UNIT, "status", "rows", counted, now.alias("updated_at")
    )
    return merged(ledger, conform(rows, LOAD_LEDGER), LEDGER_KEYS)


def open_units(plan: DataFrame, ledger: DataFrame, table: str, max_attempts: int = MAX_ATTEMPTS) -> DataFrame:
    """Planned units that are neither done nor out of attempts. Units the ledger lacks are open."""
    closed = of_table(ledger, table).where(is_done() | (F.col("attempts") >= max_attempts))
    return plan.select(*UNIT).join(closed.select(*UNIT), list(UNIT), "left_anti")


def given_up(ledger: DataFrame, table: str, max_attempts: int = MAX_ATTEMPTS) -> DataFrame:
    """Units that failed as often as they are tried."""
    return of_table(ledger, table).where(~is_done() & (F.col("attempts") >= max_attempts))


def reopen(ledger: DataFrame, table: str, days: tuple[date, date]) -> DataFrame:
    """Ledger with the units of a day range to be loaded again, such as after late figures of a platform."""
    inside = (F.col("table_name") == table) & F.col("date").between(*map(F.lit, days))
    return ledger.where(~F.coalesce(inside, F.lit(False)))


def resume_backfill(
    spark: SparkSession,
    root: str,
    ledger: OpsTable,
    table: BronzeTable,
    rows: DataFrame,
    landed: DataFrame,
    plan: DataFrame,
    at: datetime,
    source: str,
    account_col: str,
    max_attempts: int = MAX_ATTEMPTS,
) -> DataFrame:
    """Load the open units of a plan and note how they went; gives the results of this run.

    Units that an earlier run has stored are not read again. A run that dies before it has noted
    its units loads them again the next time, which changes no row.
    """
    before = ledger.read(spark)
    todo = staged(open_units(plan, before, table.name, max_attempts), f"units-{table.name}")
    found = load_units(spark, root, table, rows, todo, at, source, account_col, landed)
    found = staged(found, f"results-{table.name}")
    ledger.replace(recorded(before, found, table.name, at))
    return found
