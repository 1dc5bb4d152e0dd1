from __future__ import annotations

from datetime import date, datetime

import pytest
import samples
from pyspark.sql.types import StructType

from adtide.schemas import GOOGLE_ADS_RAW
from adtide.sources.growth import SchemaMismatch, fits, generations, mismatches, read_grown
from adtide.sources.tables import table_path

NEXT = date(2026, 4, 2)


def written(spark, root, rows, schema, layer="ops", name="grown"):
    path = table_path(root, layer, name)
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
    return path


def schema(text):
    return StructType.fromDDL(text)


def test_added_columns_are_typed_nulls_in_old_files(spark, root):
    path = written(spark, root, [(1,)], "id long")
    written(spark, root, [(2, "new")], "id long, status string")
    declared = schema("id long, status string, later double")
    assert len(generations(spark, path)) == 1
    got = read_grown(spark, root, "ops", "grown", declared)
    assert got.schema == declared
    assert sorted(map(tuple, got.collect())) == [(1, None, None), (2, "new", None)]


@pytest.mark.parametrize(
    ("old", "new", "value", "read"),
    [("int", "long", 7, 7), ("float", "double", 0.5, 0.5), ("int", "double", 7, 7.0), ("date", "timestamp_ntz", date(2026, 4, 1), datetime(2026, 4, 1)),
     ("decimal(8,2)", "decimal(14,2)", 3, 3)],
)
def test_narrower_figures_are_widened_beside_new_ones(spark, root, old, new, value, read):
    from decimal import Decimal

    value, read = (Decimal(v) if "decimal" in old else v for v in (value, read))
    path = written(spark, root, [(1, value)], f"id long, figure {old}")
    written(spark, root, [(2, read)], f"id long, figure {new}")
    assert len(generations(spark, path)) == (2 if "decimal" not in old else len(generations(spark, path)))
    got = read_grown(spark, root, "ops", "grown", schema(f"id long, figure {new}"))
    assert sorted(map(tuple, got.collect())) == [(1, read), (2, read)]


@pytest.mark.parametrize(("stored", "declared"), [("long", "int"), ("double", "float"), ("string", "long"), ("decimal(14,2)", "decimal(12,2)"), ("timestamp_ntz", "date"), ("double", "long")])
def test_a_narrowing_type_fails_before_anything_is_read(spark, root, stored, declared):
    written(spark, root, [(1, None)], f"id long, figure {stored}")
    with pytest.raises(SchemaMismatch, match="figure: .* stored, .* declared"):
        read_grown(spark, root, "ops", "grown", schema(f"id long, figure {declared}"))
    assert mismatches(schema(f"figure {stored}"), schema("other string")) == []


def test_one_narrowing_generation_of_several_is_found(spark, root):
    written(spark, root, [(1, 1)], "id long, figure int")
    written(spark, root, [(2, 2.5)], "id long, figure double")
    with pytest.raises(SchemaMismatch, match="double stored, bigint declared"):
        read_grown(spark, root, "ops", "grown", schema("id long, figure long"))


def test_days_of_a_raw_table_under_two_schemas(spark, root):
    path = table_path(root, "bronze", GOOGLE_ADS_RAW.name)
    old = samples.google(spark, {}, {"date": NEXT, "keyword_id": "2"}).drop("campaign_status", "conversion_value")
    old.withColumn("clicks", old.clicks.cast("int")).write.partitionBy("date").parquet(path)
    # one day gets a file of the later schema beside that of the earlier one
    samples.google(spark, {"date": NEXT}).write.mode("append").partitionBy("date").parquet(path)
    got = read_grown(spark, root, "bronze", GOOGLE_ADS_RAW.name, GOOGLE_ADS_RAW.schema)
    rows = sorted((r["date"], r["keyword_id"], r["clicks"], r["campaign_status"], r["conversion_value"]) for r in got.collect())
    assert rows == [(samples.DAY, "1000", 10, None, None), (NEXT, "1000", 10, "ENABLED", 50.0), (NEXT, "2", 10, None, None)]


def test_other_columns_come_on_request(spark, root):
    written(spark, root, [(1, "x", 4)], "id long, extra string, count int")
    written(spark, root, [(2, "y", 5)], "id long, extra string, count long")
    declared = schema("id long")
    assert read_grown(spark, root, "ops", "grown", declared).columns == ["id"]
    got = read_grown(spark, root, "ops", "grown", declared, others=True)
    assert dict(got.dtypes) == {"id": "bigint", "extra": "string", "count": "bigint"}
    assert sorted(map(tuple, got.collect())) == [(1, "x", 4), (2, "y", 5)]


def test_nested_types_fit_only_themselves():
    one, two = schema("s struct<a:int>")["s"].dataType, schema("s struct<a:int,b:int>")["s"].dataType
    assert fits(one, one) and not fits(one, two)
