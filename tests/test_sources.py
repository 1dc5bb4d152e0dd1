from __future__ import annotations

import json
from datetime import date
from decimal import Decimal

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from adtide.functions.dates import Period
from adtide.schemas import CLIENT_BUDGET, GOOGLE_ADS_RAW
from adtide.sources import reports, tables

DAY = date(2026, 4, 1)


def keyword_row(status="ENABLED", day="2026-04-01", keyword=1000):
    return {
        "customer": {"id": 1, "descriptive_name": "Acme"},
        "campaign": {"id": 10, "name": "Camp A", "status": "ENABLED"},
        "ad_group": {"id": 100, "name": "AG1", "status": "PAUSED"},
        "ad_group_criterion": {
            "criterion_id": keyword,
            "status": status,
            "keyword": {"text": "kw1", "match_type": "EXACT"},
            "quality_info": {"quality_score": 7},
        },
        "metrics": {
            "impressions": 100,
            "clicks": 10,
            "cost_micros": 12_340_000,
            "conversions": 1.5,
            "conversions_value": 20.0,
            "view_through_conversions": 0.0,
            "all_conversions": 2.0,
            "search_impression_share": 0.25,
        },
        "segments": {"device": "MOBILE", "date": day},
    }


def landed(tmp_path, *rows):
    path = tmp_path / "landed"
    path.mkdir(exist_ok=True)
    (path / "part.json").write_text("\n".join(json.dumps(r) for r in rows))
    return str(path)


def test_keyword_report(spark, tmp_path):
    path = landed(tmp_path, keyword_row(), keyword_row("REMOVED", keyword=2), keyword_row(day="2026-04-09"))
    rows = reports.read_keyword_report(spark, path, Period(DAY, DAY)).collect()
    assert len(rows) == 1
    row = rows[0].asDict()
    assert (row["customer_id"], row["keyword_id"], row["spend"]) == ("1", "1000", 12.34)
    assert (row["conversion_value"], row["quality_score"], row["date"]) == (20.0, 7, DAY)
    payload = [f for f in GOOGLE_ADS_RAW.schema.fieldNames() if not f.startswith("_")]
    assert sorted(row) == sorted(payload)


def test_the_same_report_as_csv_and_parquet(spark, tmp_path):
    path = landed(tmp_path, keyword_row(), keyword_row("PAUSED", keyword=5))
    expected = sorted(tuple(r) for r in reports.read_keyword_report(spark, path).collect())
    nested = reports.read_report(spark, path, reports.KEYWORD_REPORT)
    parquet, csv = str(tmp_path / "pq"), str(tmp_path / "csv")
    nested.write.parquet(parquet)
    leaves = [F.col(n).alias(n) for n, _ in reports._leaves(reports.KEYWORD_REPORT)]
    nested.select(*leaves).write.csv(csv, header=True)
    for where, kind in ((parquet, "parquet"), (csv, "csv")):
        got = reports.read_keyword_report(spark, where, file_format=kind).collect()
        assert sorted(tuple(r) for r in got) == expected


def test_malformed_report_fails(spark, tmp_path):
    path = landed(tmp_path, keyword_row())
    (tmp_path / "landed" / "bad.json").write_text("{broken")
    with pytest.raises((PySparkException, Py4JJavaError), match="(?i)malformed|broken|FAILED_READ"):
        reports.read_keyword_report(spark, path).collect()


def test_search_term_report_blanks_missing_keywords(spark, tmp_path):
    row = {
        "customer": {"id": 1, "descriptive_name": "Acme"},
        "campaign": {"id": 10, "name": "Camp A"},
        "ad_group": {"id": 100, "name": "AG1"},
        "search_term_view": {"search_term": "shoes", "status": "NONE"},
        "metrics": {"impressions": 1, "clicks": 1, "cost_micros": 5, "conversions": 0.0,
                    "conversions_value": 0.0},
        "segments": {"date": "2026-04-01"},
    }
    got = reports.read_search_term_report(spark, landed(tmp_path, row)).first()
    assert (got["matched_keyword_text"], got["matched_keyword_match_type"]) == ("", "")
    assert (got["search_term_status"], got["spend"]) == ("NONE", 0.000005)


def criterion(number, **changes):
    base = {"criterion_id": number, "type": "KEYWORD", "negative": True, "status": "ENABLED",
            "keyword": {"text": "free", "match_type": "BROAD"}}
    return base | changes


def test_negatives_of_both_scopes(spark, tmp_path):
    shared = {"customer": {"id": 1}, "campaign": {"id": 10, "name": "Camp A"},
              "ad_group": {"id": 100, "name": "AG1"}}
    rows = [criterion(1), criterion(2, negative=False), criterion(3, type="PLACEMENT"),
            criterion(4, status="REMOVED")]
    whole = landed(tmp_path, *[shared | {"campaign_criterion": r, "ad_group_criterion": r} for r in rows])
    campaign = reports.read_campaign_negatives(spark, whole, DAY)
    ad_group = reports.read_ad_group_negatives(spark, whole, DAY)
    got = sorted(
        (r["scope"], r["criterion_id"], r["ad_group_id"], r["snapshot_date"])
        for r in reports.all_negatives(campaign, ad_group).collect()
    )
    # campaign criteria have no status filter
    assert got == [("ad_group", "1", "100", DAY), ("campaign", "1", "", DAY), ("campaign", "4", "", DAY)]


def test_meta_insights(spark, tmp_path):
    full = {"account_id": "2", "account_name": "Beta", "campaign_id": "3", "campaign_name": "C",
            "ad_id": "4", "ad_name": "A", "impressions": "10", "clicks": "2", "spend": "3.50",
            "date_start": "2026-04-01", "date_stop": "2026-04-01",
            "actions": [{"action_type": "lead", "value": "2"}], "device_platform": "mobile",
            "publisher_platform": "facebook"}
    bare = {"account_id": "2", "date_start": "2026-04-01"}
    path = landed(tmp_path, full, bare, full | {"date_start": "2026-03-01"})
    rows = {r["ad_id"]: r for r in reports.read_meta_insights(spark, path, Period(DAY, DAY)).collect()}
    assert (rows["4"]["impressions"], rows["4"]["spend"]) == (10, 3.5)
    assert json.loads(rows["4"]["actions"]) == [{"action_type": "lead", "value": "2"}]
    assert (rows[""]["clicks"], rows[""]["spend"], rows[""]["actions"]) == (0, 0.0, "[]")
    assert rows[""]["publisher_platform"] == ""


def test_account_lists(spark):
    def client(number, status="ENABLED", manager=False, hidden=False):
        return ((number, status, manager, hidden),)

    google = spark.createDataFrame(
        [client(1), client(2, "CANCELED"), client(3, manager=True), client(4, hidden=True)],
        reports.GOOGLE_ACCOUNT_LIST,
    )
    meta = spark.createDataFrame([("7", 1), ("8", 2)], reports.META_ACCOUNT_LIST)
    assert [r[0] for r in reports.list_accounts(google, "google_ads").collect()] == ["1"]
    assert [r[0] for r in reports.list_accounts(meta, "meta_ads").collect()] == ["7"]


def test_seed_drops_the_template_row(spark, tmp_path):
    seed = tmp_path / "budget.csv"
    seed.write_text(
        "account_id,platform,monthly_budget,currency,active,created_at,updated_at\n"
        "__PLACEHOLDER__,google_ads,1.00,BRL,false,,\n"
        "123,google_ads,10000.00,BRL,true,,\n"
    )
    rows = tables.load_seed(spark, str(seed), CLIENT_BUDGET).collect()
    assert [(r["account_id"], r["monthly_budget"]) for r in rows] == [("123", Decimal("10000.00"))]


def test_materialize_reads_back_and_prunes(spark, root):
    df = spark.createDataFrame([("a", DAY, 1.0), ("b", date(2026, 4, 2), 2.0)], "k string, date date, x double")
    back = tables.materialize(df, root, "gold", "t", "date")
    assert back.columns == df.columns and sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    plan = back.where(F.col("date") == F.lit(DAY)).select("x")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan and "ReadSchema: struct<x:double>" in plan


def test_missing_columns_become_typed_nulls(spark):
    row = tables.conform(spark.createDataFrame([("1",)], "customer_id string"), GOOGLE_ADS_RAW.schema)
    assert row.schema["clicks"].dataType.simpleString() == "bigint"
    assert row.first()["customer_id"] == "1" and row.first()["clicks"] is None
