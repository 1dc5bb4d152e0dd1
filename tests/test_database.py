from __future__ import annotations

from datetime import date, timedelta

import pytest
from pyspark.sql import DataFrameReader
from pyspark.sql import functions as F

from adtide.functions.dates import Period
from adtide.schemas import CLIENT_BUDGET
from adtide.sources.database import Ranges, day_ranges, read_database_table


def parts_met(rows, ranges):
    """How many of the conditions each row meets, as Spark reads them."""
    met = [F.when(F.expr(p.replace('"', "`")), 1).otherwise(0) for p in ranges.predicates()]
    return {r["found"] for r in rows.select(sum(met[1:], met[0]).alias("found")).collect()}


@pytest.mark.parametrize(
    "ranges", [Ranges("id", 0, 100, 7), Ranges("id", -5, 5, 3), Ranges("id", 3, 3, 4), Ranges("id", 0, 2, 9), Ranges("id", 1, 50, 1)]
)
def test_every_row_is_in_one_part(spark, ranges):
    rows = spark.createDataFrame([(i,) for i in range(-20, 130)] + [(None,)], "id long")
    assert parts_met(rows, ranges) == {1}
    assert len(ranges.predicates()) <= ranges.parts


def test_days_are_dealt_evenly_and_days_outside_are_read_too(spark):
    period = Period(date(2026, 1, 1), date(2026, 3, 31))
    ranges = day_ranges("date", period, 9)
    days = [(period.start + timedelta(days=d),) for d in range(-40, 150)] + [(None,)]
    assert parts_met(spark.createDataFrame(days, "date date"), ranges) == {1}
    assert [b - a for a, b in zip(ranges.cuts(), ranges.cuts()[1:], strict=False)] == [timedelta(days=10)] * 7


def test_bad_ranges_are_refused():
    for ranges in (Ranges("id", 5, 1, 2), Ranges("id", 1, 5, 0)):
        with pytest.raises(ValueError):
            ranges.predicates()


def test_names_are_quoted():
    assert Ranges('odd "name', 0, 10, 2).predicates()[1] == '"odd ""name" >= 5'


def test_a_scan_asks_for_one_query_a_part_and_gives_the_declared_columns(spark, monkeypatch):
    asked = {}

    def jdbc(self, url, table, predicates=None, properties=None, **_):
        asked.update(url=url, table=table, predicates=predicates, properties=properties)
        return spark.createDataFrame([("1", "google_ads", 5.0)], "account_id string, platform string, monthly_budget double")

    monkeypatch.setattr(DataFrameReader, "jdbc", jdbc)
    rows = read_database_table(spark, "jdbc:x", "ops", "client_budget", CLIENT_BUDGET, Ranges("slot", 0, 8, 4), {"user": "reader"})
    assert asked["table"] == "ops.client_budget" and len(asked["predicates"]) == 4
    assert asked["properties"] == {"fetchsize": "10000", "pushDownPredicate": "true", "user": "reader"}
    assert [f.name for f in rows.schema] == CLIENT_BUDGET.fieldNames() and rows.first()["active"] is None
    with pytest.raises(ValueError):
        read_database_table(spark, "jdbc:x", "nowhere", "client_budget")
    read_database_table(spark, "jdbc:x", "gold", "daily_performance")
    assert asked["predicates"] is None
