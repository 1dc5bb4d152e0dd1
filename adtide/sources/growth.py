"""Stored tables whose files were written under earlier declared schemas."""

from __future__ import annotations

from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import DataType, DecimalType, StructField, StructType

from adtide.sources.tables import _files, current_path

# Types that a stored type may grow into without loss.
_GROWS = {
    "byte": ("short", "integer", "long", "double"),
    "short": ("integer", "long", "double"),
    "integer": ("long", "double"),
    "float": ("double",),
    "date": ("timestamp_ntz",),
}


# Fixed value: Spark's name for file schemas of which one does not contain the other.
_UNMERGED = "CANNOT_MERGE_SCHEMAS"


class SchemaMismatch(ValueError):
    """Files hold a column in a type that the declared one cannot take whole."""


def fits(stored: DataType, declared: DataType) -> bool:
    """Whether every value of the stored type is one of the declared type."""
    if isinstance(stored, DecimalType) and isinstance(declared, DecimalType):
        whole = stored.precision - stored.scale <= declared.precision - declared.scale
        return whole and stored.scale <= declared.scale
    if stored.typeName() == declared.typeName():
        return stored == declared or not isinstance(stored, StructType)
    return declared.typeName() in _GROWS.get(stored.typeName(), ())


def mismatches(stored: StructType, declared: StructType) -> list[str]:
    """Declared columns that the stored ones do not fit, as texts."""
    found = {f.name: f for f in stored}
    return [
        f"{f.name}: {found[f.name].dataType.simpleString()} stored, {f.dataType.simpleString()} declared"
        for f in declared
        if f.name in found and not fits(found[f.name].dataType, f.dataType)
    ]


def _partitions(spark: SparkSession, path: str) -> list[str]:
    """Partition folders of a table, one per calendar day, or the table's folder."""
    files, folder = _files(spark, path)
    names = [s.getPath().getName() for s in files.listStatus(folder) if s.isDirectory()]
    return [f"{path}/{n}" for n in sorted(names) if "=" in n] or [path]


def generations(spark: SparkSession, path: str) -> list[StructType]:
    """Schemas that the files of a table were written with, one if they agree or only add columns.

    Spark merges the schemas in the file footers in a job. It cannot merge a column that has
    grown, so then the days are looked at one by one.
    """
    reader = spark.read.option("mergeSchema", "true")
    try:
        return [reader.parquet(path).schema]
    except (Py4JJavaError, PySparkException) as error:
        if _UNMERGED not in str(error):
            raise
    found: list[StructType] = []
    for folder in _partitions(spark, path):
        for own in _schemas_of(spark, path, folder):
            if own not in found:
                found.append(own)
    return found


def _schemas_of(spark: SparkSession, path: str, folder: str) -> list[StructType]:
    """Schemas of one day's files, which are looked at singly if they hold a column in two types."""
    reader = spark.read.option("basePath", path).option("mergeSchema", "true")
    try:
        return [reader.parquet(folder).schema]
    except (Py4JJavaError, PySparkException) as error:
        if _UNMERGED not in str(error):
            raise
    return [reader.parquet(name).schema for name in spark.read.parquet(folder).inputFiles()]


def read_grown(
    spark: SparkSession, root: str, layer: str, name: str, declared: StructType, others: bool = False
) -> DataFrame:
    """Stored table under its declared schema, whatever earlier ones its files have.

    Columns that files lack are typed NULLs, narrower figures are widened while they are read. A
    column that would have to be narrowed fails before anything is read. ``others`` gives columns
    that files have beyond the declared ones too, as they are stored.
    """
    path = current_path(spark, root, layer, name)
    stored = generations(spark, path)
    wrong = dict.fromkeys(text for schema in stored for text in mismatches(schema, declared))
    if wrong:
        raise SchemaMismatch(f"{layer}.{name}: " + "; ".join(wrong))
    return spark.read.schema(_wanted(stored, declared, others)).parquet(path)


def _wanted(stored: Sequence[StructType], declared: StructType, others: bool) -> StructType:
    known = set(declared.fieldNames())
    added: dict[str, StructField] = {}
    for field in (f for schema in stored for f in schema):
        if others and field.name not in known:
            before = added.get(field.name)
            if before is not None and not fits(before.dataType, field.dataType):
                if fits(field.dataType, before.dataType):
                    continue
                raise SchemaMismatch(f"{field.name}: stored in types of which none takes the other")
            added[field.name] = StructField(field.name, field.dataType)
    return StructType([*declared.fields, *added.values()])
