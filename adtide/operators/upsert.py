"""Natural-key upsert, insert-if-absent, delete and load reporting.

Parquet has no row updates. Every raw natural key holds the day the table is
partitioned by, so a load rewrites only the days it touches: old rows without a
newer version plus the new rows, written with dynamic partition overwrite.
"""

from __future__ import annotations

import threading
import time
import uuid
from collections.abc import Callable, Sequence
from datetime import date, datetime
from typing import Literal, NamedTuple

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from adtide.functions.dates import Period
from adtide.functions.text import blank_nulls
from adtide.operators.latest import bronze_dedup, latest_by_key
from adtide.schemas import BUDGET_KEYS, CLIENT_BUDGET, PLATFORMS, BronzeTable
from adtide.sources.reports import stamp_load
from adtide.sources.tables import (
    balanced,
    conform,
    create_alone,
    current_path,
    delete_path,
    exists,
    folder_files,
    materialize,
    move_folders,
    read_table,
    small_files,
    staged,
    take_over,
)

OnDuplicate = Literal["error", "latest"]

# Fixed value: report of a load that did not reach every partition. `{}` is a slot.
INCOMPLETE_TEXT = "{} backfill incompleto: {}/{} partições falharam (amostra: {})"
SAMPLE_SIZE = 5

#: Times that a load merges days anew which other loads have replaced.
ATTEMPTS = 20
#: Seconds between looks at a claimed day, and after which a claim of another application is void.
CLAIM_PAUSE = 0.2
LEASE_SECONDS = 900
#: Writers of this application that are at work.
_LIVE: set[str] = set()
_LIVE_LOCK = threading.Lock()


class ConcurrentLoads(RuntimeError):
    """Other loads replaced the same days again and again."""


class DuplicateKeys(ValueError):
    """One batch holds several rows of the same natural key."""


class BatchProfile(NamedTuple):
    """What a load needs to know about its batch."""

    rows: int
    most_copies: int
    days: list[date]


def profile_batch(batch: DataFrame, keys: Sequence[str], partition: str) -> BatchProfile:
    """Row count, copies of the most frequent key and touched days, in one pass.

    Only this one row comes back; its list has an entry per calendar day of the
    load, so it does not grow with the rows.
    """
    copies = batch.groupBy(*keys).agg(F.count("*").alias("copies"))
    found = copies.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("rows"),
        F.coalesce(F.max("copies"), F.lit(0)).alias("most"),
        F.array_sort(F.collect_set(partition)).alias("days"),
    ).first()
    return BatchProfile(found["rows"], found["most"], found["days"])


def merged(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows after the upsert. ``batch`` must hold each key once.

    Only columns of the batch are updated. If it has all of them, replaced rows are
    dropped by an anti-join that sends keys only; otherwise one full outer join
    keeps the old values of the columns it lacks. Keys must not be NULL, as in the
    stored tables, where blank text stands for a missing part.
    """
    lacking = [name for name in target.columns if name not in batch.columns]
    if not lacking:
        kept = target.join(batch.select(*keys), list(keys), "left_anti")
        return kept.select(*target.columns).unionByName(batch.select(*target.columns))
    old = target.alias("old")
    new = batch.withColumn("in_batch", F.lit(True)).alias("new")
    rows = old.join(new, [F.col(f"old.{key}") == F.col(f"new.{key}") for key in keys], "full")

    def value(name: str) -> Column:
        if name in lacking:
            return F.col(f"old.{name}")
        updated = F.when(F.col("in_batch"), F.col(f"new.{name}"))
        return updated.otherwise(F.col(f"old.{name}")).alias(name)

    return rows.select(*[value(name).alias(name) for name in target.columns])


def merge_upsert(
    spark: SparkSession,
    root: str,
    table: BronzeTable,
    batch: DataFrame,
    on_duplicate: OnDuplicate = "error",
    ties: Sequence[Column] = (),
    tie_columns: Sequence[str] = (),
    is_staged: bool = False,
) -> int:
    """Upsert a batch into a stored raw table and return the number of its rows.

    Running it twice leaves the same table. Loads may run at a time: those of different days
    do not meet, and a day that another load has stored meanwhile is merged again, so that no row
    is lost. A load that died while replacing days is finished by the next one. ``tie_columns`` are
    columns outside the table that ``ties`` refer to. ``is_staged`` says that the batch
    reads from a written table already.
    """
    text_keys = [key for key in table.keys if table.schema[key].dataType.typeName() == "string"]
    batch = blank_nulls(batch.select(*_known(batch, table), *tie_columns), text_keys)
    if on_duplicate == "latest":
        batch = latest_by_key(batch, table.keys, ties=ties)
    elif on_duplicate != "error":
        raise ValueError(f"unknown duplicate handling {on_duplicate!r}")
    batch = batch.select(*_known(batch, table))
    if not is_staged or on_duplicate == "latest":
        # written once: checking, matching and inserting then read columns, not reports
        batch = staged(batch, f"batch-{table.name}")
    profile = profile_batch(batch, table.keys, table.partition)
    if profile.most_copies > 1:
        raise DuplicateKeys(f"rows of one batch share a key of {', '.join(table.keys)}")
    if not profile.rows:
        return 0
    _merge_days(spark, root, table, profile.days, lambda stored: batch if stored is None else merged(stored, batch, table.keys))
    return profile.rows


def _merge_days(
    spark: SparkSession,
    root: str,
    table: BronzeTable,
    days: Sequence[date],
    merge: Callable[[DataFrame | None], DataFrame],
) -> None:
    """Put ``merge`` of the stored rows of some days in their place.

    Another load may store one of the days in the meantime. Days are therefore claimed while
    they are replaced, and merged again if their files are no longer those that were read.
    """
    partition = table.partition
    for _ in range(ATTEMPTS):
        finish_publishing(spark, root, table)
        path = current_path(spark, root, "bronze", table.name)
        # looked at before the rows are read: what comes later is noticed
        seen = folder_files(spark, path, partition, days)
        stored = None
        if exists(spark, path):
            rows = read_table(spark, root, "bronze", table.name, table.schema)
            stored = rows.where(F.col(partition).isin(list(days)))
        try:
            if _replace_days(spark, root, table, merge(stored), seen):
                return
        except (Py4JJavaError, PySparkException):
            # files that were being read may have been replaced
            if folder_files(spark, path, partition, days) == seen:
                raise
    raise ConcurrentLoads(f"other loads kept replacing days of {table.name}")


def _replace_days(
    spark: SparkSession, root: str, table: BronzeTable, rows: DataFrame, seen: dict[date, tuple]
) -> bool:
    """Put the days of ``rows`` in the place of the stored ones, written once; False if those have changed.

    They are written whole beside the table before any stored day goes, and stay there
    until all are in place. ``seen`` has the files of each day that the rows were made of.
    """
    writer = f"{spark.sparkContext.applicationId}-{uuid.uuid4().hex}"
    with _LIVE_LOCK:
        _LIVE.add(writer)
    try:
        path = f"{_publishing(root, table)}/rows-{writer}"
        whole = balanced(conform(rows, table.schema), table.partition)
        whole.write.partitionBy(table.partition).parquet(path)
        # in one order for all writers, so that none waits for another in a circle
        for day in sorted(seen):
            _claim(spark, root, table, day, writer)
        target = current_path(spark, root, "bronze", table.name)
        if folder_files(spark, target, table.partition, list(seen)) != seen:
            _release(spark, root, table, writer)
            delete_path(spark, path)
            return False
        note = f"{_publishing(root, table)}/note-{writer}"
        create_alone(spark, note, writer)
        _publish(spark, root, table, note, writer)
        return True
    finally:
        with _LIVE_LOCK:
            _LIVE.discard(writer)


def _claim(spark: SparkSession, root: str, table: BronzeTable, day: date, writer: str) -> None:
    """Wait until no other writer is replacing a day."""
    claim = f"{_publishing(root, table)}/claim-{day.isoformat()}"
    while not create_alone(spark, claim, writer):
        finish_publishing(spark, root, table)
        time.sleep(CLAIM_PAUSE)


def _release(spark: SparkSession, root: str, table: BronzeTable, writer: str) -> None:
    for path, owner, _ in small_files(spark, _publishing(root, table), "claim-"):
        if owner == writer:
            delete_path(spark, path)


def _publish(spark: SparkSession, root: str, table: BronzeTable, note: str, owner: str) -> None:
    """Move what is left of an owner's days into place, then drop the claims and the note."""
    move_folders(spark, f"{_publishing(root, table)}/rows-{owner}", current_path(spark, root, "bronze", table.name))
    _release(spark, root, table, owner)
    delete_path(spark, note)


def _publishing(root: str, table: BronzeTable) -> str:
    return f"{root}/bronze/_publishing/{table.name}"


def _is_dead(spark: SparkSession, writer: str, age: float) -> bool:
    """Whether nobody is behind a claim or note any more: known for the own application, else by its age."""
    if writer.startswith(f"{spark.sparkContext.applicationId}-"):
        with _LIVE_LOCK:
            return writer not in _LIVE
    return age > LEASE_SECONDS


def finish_publishing(spark: SparkSession, root: str, table: BronzeTable) -> None:
    """Put noted merged days of drivers that died in place, and drop claims they left.

    Replacing several folders is not one step for the file system. A note says that its owner's
    days are whole and were still those it had read; those still in its folder take their places
    by renames. Its name tells who is doing so, and changes in one step when another takes over.
    Days without a note were never published and their claims are void.
    """
    folder = _publishing(root, table)
    for path, owner, age in small_files(spark, folder, "note-"):
        if not _is_dead(spark, path.rpartition("/note-")[2], age):
            continue
        finisher = f"{spark.sparkContext.applicationId}-{uuid.uuid4().hex}"
        with _LIVE_LOCK:
            _LIVE.add(finisher)
        try:
            note = f"{folder}/note-{finisher}"
            if take_over(spark, path, note):
                _publish(spark, root, table, note, owner)
        finally:
            with _LIVE_LOCK:
                _LIVE.discard(finisher)
    noted = {owner for _, owner, _ in small_files(spark, folder, "note-")}
    for path, owner, age in small_files(spark, folder, "claim-"):
        if owner and owner not in noted and _is_dead(spark, owner, age):
            delete_path(spark, path)


def _known(batch: DataFrame, table: BronzeTable) -> list[str]:
    return [name for name in table.schema.fieldNames() if name in batch.columns]


def append_rows(root: str, table: BronzeTable, batch: DataFrame) -> int:
    """Plain append, for loads without a conflict key."""
    counted = Observation()
    rows = conform(batch, table.schema).observe(counted, F.count("*").alias("rows"))
    path = current_path(batch.sparkSession, root, "bronze", table.name)
    balanced(rows, table.partition).write.mode("append").partitionBy(table.partition).parquet(path)
    return counted.get["rows"]


def load_bronze(
    spark: SparkSession,
    root: str,
    table: BronzeTable,
    rows: DataFrame,
    at: datetime,
    source: str,
    upsert: bool = True,
    on_duplicate: OnDuplicate = "error",
    is_staged: bool = False,
    ties: Sequence[Column] = (),
    tie_columns: Sequence[str] = (),
) -> int:
    """Stamp a batch with its load time and source and store it."""
    batch = stamp_load(rows, at, source)
    if upsert:
        return merge_upsert(spark, root, table, batch, on_duplicate, ties, tie_columns, is_staged)
    return append_rows(root, table, batch)


def snapshot_load(
    spark: SparkSession, root: str, table: BronzeTable, rows: DataFrame, at: datetime, source: str
) -> int:
    """Store today's state of a source without history, under the day of ``at``."""
    stamped = rows.withColumn(table.partition, F.lit(at.date()))
    return load_bronze(spark, root, table, stamped, at, source)


def upsert_budget(
    target: DataFrame, new: DataFrame, at: datetime, on_duplicate: OnDuplicate = "error"
) -> DataFrame:
    """Budgets after an upsert: a known budget keeps its creation time.

    A batch with a key twice is refused; ``latest`` takes its largest amount.
    """
    now = F.lit(at.isoformat(sep=" ")).cast("timestamp_ntz")
    defaults = {"currency": F.lit("BRL"), "active": F.lit(True)}
    given = {
        name: F.coalesce(F.col(name), value) if name in new.columns else value
        for name, value in defaults.items()
    }
    new = new.withColumns(given).select(*BUDGET_KEYS, "monthly_budget", *defaults)
    new = new.withColumn("monthly_budget", _checked_budget())
    if on_duplicate == "latest":
        new = latest_by_key(new.withColumn("at", now), BUDGET_KEYS, "at", [F.desc("monthly_budget")])
    elif not new.groupBy(*BUDGET_KEYS).count().where("count > 1").isEmpty():
        raise DuplicateKeys(f"budgets of one batch share {', '.join(BUDGET_KEYS)}")
    new = new.select(*BUDGET_KEYS, "monthly_budget", *defaults)
    created = target.select(*BUDGET_KEYS, "created_at")
    updated = new.join(created, list(BUDGET_KEYS), "left").withColumns(
        {"created_at": F.coalesce("created_at", now), "updated_at": now}
    )
    return merged(target, updated, BUDGET_KEYS)


def _checked_budget() -> Column:
    amount = F.col("monthly_budget").cast(CLIENT_BUDGET["monthly_budget"].dataType)
    accepted = (amount > 0) & F.col("platform").isin(*PLATFORMS)
    refused = F.raise_error(F.lit("a budget must be positive and of a known platform"))
    return F.when(accepted, amount).otherwise(refused)


def insert_if_absent(
    target: DataFrame, new: DataFrame, keys: Sequence[str], order: Sequence[Column] = ()
) -> DataFrame:
    """Target plus the first new row, in ``order``, of each key it does not hold yet.

    Without an order the smallest of the remaining columns decides.
    """
    absent = new.join(target.select(*keys), list(keys), "left_anti")
    rest = [F.col(name) for name in target.columns if name not in keys]
    first = Window.partitionBy(*keys).orderBy(*(order or rest or [F.col(keys[0])]))
    one = absent.withColumn("rn", F.row_number().over(first)).where("rn = 1")
    return target.unionByName(one.select(*target.columns))


def delete_where(target: DataFrame, predicate: Column) -> DataFrame:
    """Target without the matching rows. An undefined predicate does not match."""
    return target.where(~F.coalesce(predicate, F.lit(False)))


class OpsTable(NamedTuple):
    """A small stored table that is changed as a whole, by a switch to a new version."""

    root: str
    layer: str
    name: str
    schema: StructType

    def read(self, spark: SparkSession) -> DataFrame:
        return read_table(spark, self.root, self.layer, self.name, self.schema)

    def replace(self, rows: DataFrame) -> DataFrame:
        return materialize(conform(rows, self.schema), self.root, self.layer, self.name)


def store_budgets(
    spark: SparkSession, table: OpsTable, new: DataFrame, at: datetime, on_duplicate: OnDuplicate = "error"
) -> DataFrame:
    """Upsert budgets into the stored table and return it."""
    return table.replace(upsert_budget(table.read(spark), new, at, on_duplicate))


def store_if_absent(
    spark: SparkSession, table: OpsTable, new: DataFrame, keys: Sequence[str], order: Sequence[Column] = ()
) -> DataFrame:
    """Insert rows of unknown keys into the stored table and return it."""
    return table.replace(insert_if_absent(table.read(spark), conform(new, table.schema), keys, order))


def delete_stored(spark: SparkSession, table: OpsTable, predicate: Column) -> DataFrame:
    """Delete rows of the stored table and return it."""
    return table.replace(delete_where(table.read(spark), predicate))


def dedup_stored(spark: SparkSession, root: str, table: BronzeTable, ties: Sequence[Column] = ()) -> int:
    """Keep the latest row of each key of a stored raw table; returns the number of rewritten days.

    Keys hold the day, so only days with a key twice are rewritten.
    """
    finish_publishing(spark, root, table)
    stored = read_table(spark, root, "bronze", table.name, table.schema)
    copies = stored.groupBy(*table.keys).agg(F.count("*").alias("copies")).where("copies > 1")
    # an entry per calendar day
    days = [row[0] for row in copies.select(table.partition).distinct().collect()]
    if days:
        _merge_days(spark, root, table, days, lambda rows: bronze_dedup(rows, table, ties))
    return len(days)


def partition_plan(spark: SparkSession, period: Period, accounts: DataFrame) -> DataFrame:
    """Units of a load, one per day and account, oldest day first.

    The days of each account are a sequence exploded in place, so no two tables
    are paired up.
    """
    days = F.explode(F.sequence(F.lit(period.start), F.lit(period.end)))
    return accounts.select(days.alias("date"), "account_id").orderBy("date", "account_id")


def load_results(plan: DataFrame, loaded: DataFrame, landed: DataFrame | None = None) -> DataFrame:
    """Rows and status of every planned unit, from the landed or stored rows.

    ``landed`` has ``date``, ``account_id`` and ``broken`` of every unit with a file. A unit
    without rows is ``empty`` if its files landed whole, as an account may have had no
    activity, else ``failed``. Without ``landed`` every planned unit counts as landed.
    """
    keys = ["date", "account_id"]
    counts = loaded.groupBy(*keys).agg(F.count("*").alias("rows"))
    units = plan.join(counts, keys, "left")
    failed = F.lit(False)
    if landed is not None:
        # reduced first: a unit of many files is one row
        whole = landed.groupBy(*keys).agg(F.max(F.col("broken").cast("int")).alias("bad"))
        units = units.join(whole, keys, "left")
        failed = F.coalesce("bad", F.lit(1)) == 1
    status = F.when(failed, "failed").when(F.col("rows").isNull(), "empty").otherwise("loaded")
    rows = F.when(failed, F.lit(0)).otherwise(F.coalesce("rows", F.lit(0)))
    return units.select(*keys, rows.cast("bigint").alias("rows"), status.alias("status"))


def missing_partitions(plan: DataFrame, loaded: DataFrame) -> DataFrame:
    """Planned units without any row."""
    # reduced first: a unit with very many rows is one row per task in the join
    units = loaded.select("date", "account_id").distinct()
    return plan.join(units, ["date", "account_id"], "left_anti")


def load_report(results: DataFrame, source: str) -> DataFrame:
    """One row: loaded rows, failed and planned units, and a message naming the first.

    The sample is a top-k, so failures are never gathered as a whole.
    """
    totals = results.agg(
        F.sum("rows").alias("rows_loaded"),
        F.count_if(F.col("status") == "failed").alias("failed"),
        F.count("*").alias("planned"),
    )
    first = (
        results.where(F.col("status") == "failed")
        .orderBy("date", "account_id")
        .limit(SAMPLE_SIZE)
        .agg(F.array_sort(F.collect_list(F.struct("date", "account_id"))).alias("units"))
    )
    unit = F.transform(
        "units", lambda u: F.concat(u["date"].cast("string"), F.lit("/"), u["account_id"])
    )
    sample = first.select(F.array_join(unit, ", ")).scalar()
    slots = [F.lit(source), F.col("failed"), F.col("planned"), sample]
    pieces = INCOMPLETE_TEXT.split("{}")
    text = [F.lit(pieces[0])]
    for slot, piece in zip(slots, pieces[1:], strict=True):
        text += [slot.cast("string"), F.lit(piece)]
    return totals.select(
        F.coalesce("rows_loaded", F.lit(0)).alias("rows_loaded"),
        "failed",
        "planned",
        F.when(F.col("failed") > 0, F.concat(*text)).alias("message"),
    )


def backfill(
    spark: SparkSession,
    root: str,
    table: BronzeTable,
    rows: DataFrame,
    period: Period,
    accounts: DataFrame,
    at: datetime,
    source: str,
    account_col: str,
    landed: DataFrame | None = None,
) -> DataFrame:
    """Load all landed units of a range in one job and report how each of them went.

    ``rows`` are those of whole units only and ``landed`` is their list, both as
    ``read_landed`` gives them. What landed is stored; a broken or missing unit is reported
    with ``load_report`` and can be loaded later without touching the rest.
    """
    plan = partition_plan(spark, period, accounts)
    return load_units(spark, root, table, rows, plan, at, source, account_col, landed)


def load_units(
    spark: SparkSession,
    root: str,
    table: BronzeTable,
    rows: DataFrame,
    plan: DataFrame,
    at: datetime,
    source: str,
    account_col: str,
    landed: DataFrame | None = None,
) -> DataFrame:
    """Load the rows of the planned units, whatever others there are, and report how each unit went."""
    units = plan.select(F.col("date").alias(table.partition), F.col("account_id").alias(account_col))
    kept = rows.join(units, [table.partition, account_col], "left_semi").select(*rows.columns)
    # stored and reported from one written copy; the reports are parsed once
    kept = staged(kept, f"landed-{table.name}")
    load_bronze(spark, root, table, kept, at, source, is_staged=True)
    stored = kept.select(
        F.col(table.partition).alias("date"), F.col(account_col).alias("account_id")
    )
    return load_results(plan, stored, landed)
