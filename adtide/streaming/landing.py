"""Incremental form of the raw load: new report files since the last run.

The stream only finds the new files; storing them is the same upsert as the batch
load. A file seen twice changes nothing, so a restart after a failure is safe.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from adtide.operators.upsert import OnDuplicate, load_bronze
from adtide.schemas import BronzeTable
from adtide.sources.reports import LANDED


def utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def ingest_landed_reports(
    spark: SparkSession,
    landing: str,
    progress: str,
    report_schema: StructType,
    flatten: Callable[[DataFrame], DataFrame],
    root: str,
    table: BronzeTable,
    source: str,
    on_duplicate: OnDuplicate = "latest",
    files_per_load: int = 1000,
    clock: Callable[[], datetime] = utc_now,
) -> None:
    """Load all report files that landed since the last call, then stop.

    Of rows with one key the one in the newest file is kept, by modification time and then
    by name. The files of a key may fall into several loads, in that order.
    ``progress`` is the folder of the stream's own bookkeeping, on shared storage.
    """

    def store(batch: DataFrame, _: int) -> None:
        rows = flatten(batch)
        load_bronze(
            spark, root, table, rows, clock(), source, on_duplicate=on_duplicate, ties=[F.desc(LANDED)], tie_columns=[LANDED]
        )

    place = F.struct("_metadata.file_modification_time", "_metadata.file_path").alias(LANDED)
    query = (
        spark.readStream.schema(report_schema)
        .option("maxFilesPerTrigger", files_per_load)
        .json(landing)
        .select("*", place)
        .writeStream.foreachBatch(store)
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
