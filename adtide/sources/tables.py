"""Layered Parquet tables, seed files and the JSON export of reviews."""

from __future__ import annotations

import threading
import time
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import date

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from adtide.functions.dates import Period
from adtide.session import new_workspace

CONCURRENT_WRITES = 4
_CREATING = threading.Lock()

#: File with the name of a table's current version, and what such names begin with.
POINTER = "_current"
VERSION = "version-"

LAYERS = ("bronze", "silver", "gold", "ops", "users")

# Fixed value: account id of the template row of a seed file.
PLACEHOLDER = "__PLACEHOLDER__"


def table_path(root: str, layer: str, name: str) -> str:
    if layer not in LAYERS:
        raise ValueError(f"unknown layer {layer!r}")
    return f"{root}/{layer}/{name}"


def read_table(
    spark: SparkSession, root: str, layer: str, name: str, schema: StructType | None = None
) -> DataFrame:
    """Stored table; with a declared schema, columns missing in old files read as NULL."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(current_path(spark, root, layer, name))


def _files(spark: SparkSession, path: str) -> tuple:
    """File system of a path, and the path as that system takes it."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def current_path(spark: SparkSession, root: str, layer: str, name: str) -> str:
    """Folder with the files of a stored table: the version its pointer names."""
    folder = table_path(root, layer, name)
    version = _pointed(spark, folder)
    return f"{folder}/{version}" if version else folder


def _pointed(spark: SparkSession, folder: str) -> str | None:
    """Version that the pointer of a table names, if there is one."""
    files, pointer = _files(spark, f"{folder}/{POINTER}")
    if not files.exists(pointer):
        return None
    stream = files.open(pointer)
    name = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    stream.close()
    return name


def _switch(spark: SparkSession, folder: str, version: str) -> None:
    """Make a written version the current one in one rename; the one before stays for its readers."""
    files, pointer = _files(spark, f"{folder}/{POINTER}")
    before = _pointed(spark, folder)
    _, written = _files(spark, f"{folder}/{POINTER}-{version}")
    stream = files.create(written, True)
    stream.write(bytearray(version.encode()))
    stream.close()
    fs = spark._jvm.org.apache.hadoop.fs
    rename = getattr(fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    context = fs.FileContext.getFileContext(files.getUri(), spark._jsc.hadoopConfiguration())
    context.rename(written, pointer, options)
    for status in files.listStatus(_files(spark, folder)[1]):
        found = status.getPath().getName()
        if found.startswith(VERSION) and found not in (version, before):
            files.delete(status.getPath(), True)


def balanced(df: DataFrame, partition_by: str | None = None) -> DataFrame:
    """Rows of one partition value brought together, in evenly sized write tasks.

    Adaptive execution splits a value that holds much of the data over several
    tasks and joins small ones, so neither one huge file nor a file per task and
    value comes out.
    """
    return df.hint("rebalance", partition_by) if partition_by else df.hint("rebalance")


def materialize(
    df: DataFrame,
    root: str,
    layer: str,
    name: str,
    partition_by: str | None = None,
    only_touched: bool = False,
) -> DataFrame:
    """Write a model and return the stored table.

    A full refresh writes a new version beside the old one and then switches, so that
    readers always find a whole table and ``df`` may read the one it replaces.
    ``only_touched`` replaces just the partition values present in ``df``.
    """
    if only_touched and not partition_by:
        raise ValueError("replacing touched partitions needs a partition column")
    spark = df.sparkSession
    writer = balanced(df, partition_by).write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    if only_touched:
        path = current_path(spark, root, layer, name)
        writer.option("partitionOverwriteMode", "dynamic").parquet(path)
    else:
        folder, version = table_path(root, layer, name), f"{VERSION}{uuid.uuid4().hex}"
        path = f"{folder}/{version}"
        writer.parquet(path)
        _switch(spark, folder, version)
    # the written schema is known, so the files need not be opened to infer it
    return spark.read.schema(df.schema).parquet(path).select(df.columns)


def replace_days(
    df: DataFrame, root: str, layer: str, name: str, partition_by: str, days: Period
) -> None:
    """Replace the partitions of a day range, those without any new row included.

    Dynamic overwrite leaves a day alone that has no row left. The days written are
    observed while writing, and stored days of the range beyond them are dropped.
    """
    spark, path = df.sparkSession, current_path(df.sparkSession, root, layer, name)
    written = Observation()
    seen = df.observe(written, F.collect_set(partition_by).alias("days"))
    materialize(seen, root, layer, name, partition_by, only_touched=True)
    inside = F.col(partition_by).between(F.lit(days.start), F.lit(days.end))
    stored = spark.read.parquet(path).where(inside).select(partition_by).distinct()
    kept = set(written.get["days"])
    # both lists have at most one entry per calendar day
    for row in stored.collect():
        if row[0] not in kept:
            delete_path(spark, f"{path}/{partition_by}={row[0].isoformat()}")


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a folder of the storage the tables live on, if it is there."""
    files, hadoop = _files(spark, path)
    files.delete(hadoop, True)


def indexed_files(spark: SparkSession, path: str) -> DataFrame:
    """``file``: escaped paths of all files below a folder, those without content included.

    Spark lists many folders in a job. The names stay in the JVM, where every scan keeps
    the index of its files anyway.
    """
    index = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    names = spark._jvm.scala.collection.immutable.ArraySeq.unsafeWrapArray(index._jdf.inputFiles())
    rows = spark._jsparkSession.createDataset(names, spark._jvm.org.apache.spark.sql.Encoders.STRING())
    return DataFrame(rows.toDF(), spark).toDF("file")


def folder_files(spark: SparkSession, path: str, column: str, days: Sequence[date]) -> dict[date, tuple]:
    """Names of the files of each of some day folders of a table; names are never used twice."""
    files, _ = _files(spark, path)
    found = {}
    for day in days:
        folder = _files(spark, f"{path}/{column}={day.isoformat()}")[1]
        listed = files.listStatus(folder) if files.exists(folder) else []
        found[day] = tuple(sorted(status.getPath().getName() for status in listed))
    return found


def create_alone(spark: SparkSession, path: str, content: str) -> bool:
    """Write a small file unless it is there already; of several writers one succeeds."""
    files, hadoop = _files(spark, path)
    files.mkdirs(hadoop.getParent())
    with _CREATING:
        # a local file system looks and creates in two steps
        if files.exists(hadoop):
            return False
        try:
            stream = files.create(hadoop, False)
        except Py4JJavaError:
            if files.exists(hadoop):
                return False
            raise
        stream.write(bytearray(content.encode()))
        stream.close()
    return True


def take_over(spark: SparkSession, source: str, target: str) -> bool:
    """Rename a small file and make it new; of several that try one succeeds."""
    files, hadoop = _files(spark, source)
    place = _files(spark, target)[1]
    try:
        if not files.rename(hadoop, place):
            return False
    except Py4JJavaError:
        if files.exists(hadoop):
            raise
        return False
    files.setTimes(place, int(time.time() * 1000), -1)
    return True


def small_files(spark: SparkSession, folder: str, prefix: str) -> list[tuple[str, str, float]]:
    """Path, content and age in seconds of the small files of a folder whose names begin so."""
    files, hadoop = _files(spark, folder)
    found = []
    if not files.exists(hadoop):
        return found
    for status in files.listStatus(hadoop):
        if status.getPath().getName().startswith(prefix):
            path = status.getPath().toString()
            try:
                stream = files.open(status.getPath())
            except Py4JJavaError:
                # gone meanwhile
                continue
            content = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
            stream.close()
            found.append((path, content, time.time() - status.getModificationTime() / 1000))
    return found


def move_folders(spark: SparkSession, source: str, target: str) -> None:
    """Replace folders of ``target`` by those of the same name in ``source``, one rename each.

    Doing it again after an interruption moves what is left.
    """
    files, folder = _files(spark, source)
    if not files.exists(folder):
        return
    files.mkdirs(_files(spark, target)[1])
    # an entry per calendar day of a load
    for status in files.listStatus(folder):
        name = status.getPath().getName()
        if status.isDirectory() and not name.startswith("_"):
            place = _files(spark, f"{target}/{name}")[1]
            files.delete(place, True)
            files.rename(status.getPath(), place)
    files.delete(folder, True)


def staged(df: DataFrame, purpose: str) -> DataFrame:
    """The rows as a written table in the shared folder, cut off from their lineage.

    A lost executor then costs a re-read of some files, not a re-run of the job
    that made them.
    """
    path = new_workspace(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def side_by_side(tasks: Sequence[Callable[[], DataFrame | None]]) -> list:
    """Results of independent writes, whose Spark jobs share the cluster.

    The driver only waits here; small tables do not leave executors idle in turn.
    """
    with ThreadPoolExecutor(max_workers=CONCURRENT_WRITES) as pool:
        return list(pool.map(lambda task: task(), tasks))


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Columns of ``schema`` in its order and types; missing ones are typed NULLs."""
    present = set(df.columns)
    return df.select(
        *[
            (F.col(field.name) if field.name in present else F.lit(None))
            .cast(field.dataType)
            .alias(field.name)
            for field in schema
        ]
    )


def exists(spark: SparkSession, path: str) -> bool:
    """Whether something is stored under a path."""
    files, hadoop = _files(spark, path)
    return files.exists(hadoop)


def load_seed(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Reference data from CSV with a header, template rows left out."""
    rows = spark.read.schema(schema).csv(path, header=True)
    return rows.where(F.col("account_id") != PLACEHOLDER)


def write_review_json(reviews: DataFrame, path: str) -> None:
    """Nested review documents as JSON lines; undefined figures stay as ``null``."""
    reviews.write.mode("overwrite").json(path, ignoreNullFields=False)


def write_review_lines(lines: DataFrame, path: str) -> None:
    """Whole reviews as JSON lines, a folder for each section; undefined figures stay as ``null``.

    lines: section and value, as ``review_lines`` gives them.
    """
    lines.write.mode("overwrite").partitionBy("section").text(path)


def read_review_lines(spark: SparkSession, path: str, section: str, schema: StructType) -> DataFrame:
    """Documents or pages of one section. A section that no account has gives no rows."""
    folder = f"{path}/section={section}"
    if not exists(spark, folder):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("mode", "FAILFAST").json(folder)
