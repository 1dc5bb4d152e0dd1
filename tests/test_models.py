from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest
import samples
from samples import DAY, LOADED

from adtide.plans import gold, silver
from adtide.schemas import CLIENT_BUDGET

EARLIER = datetime(2026, 4, 2, 4)


def only(df):
    (row,) = df.collect()
    return row.asDict()


def test_google_rollup_keeps_one_ad_group_per_keyword_unless_asked(spark):
    raw = samples.google(spark, {}, {"ad_group_id": "101", "spend": 7.0})
    assert only(silver.silver_google_ads(raw))["spend"] == 7.0
    assert only(silver.silver_google_ads(raw, include_ad_group=True))["spend"] == 27.0


def test_google_rollup_takes_latest_and_zeroes_missing_figures(spark):
    raw = samples.google(
        spark,
        {"_extracted_at": EARLIER, "spend": 99.0},
        {"clicks": None, "conversion_value": None, "campaign_status": "PAUSED"},
        {"keyword_id": "1001", "quality_score": None, "campaign_status": "ENABLED"},
    )
    row = only(silver.silver_google_ads(raw))
    assert (row["spend"], row["clicks"], row["conversion_value"]) == (40.0, 10, 50.0)
    assert row["campaign_status"] == "PAUSED"  # greatest text, not the latest one
    assert row["quality_score"] == 7.0 and row["ad_id"] is None
    assert row["platform"] == "google_ads"


def test_keywords_drop_blank_texts_and_add_devices(spark):
    raw = samples.google(
        spark, {}, {"device": "DESKTOP"}, {"keyword_id": "2", "keyword_text": ""},
        {"keyword_id": "3", "keyword_text": None},
    )
    row = only(silver.silver_keywords(raw))
    assert (row["keyword_text"], row["impressions"], row["spend"]) == ("kw1", 200, 40.0)


def test_search_terms_treat_null_and_blank_keywords_as_one(spark):
    raw = samples.terms(
        spark,
        {"matched_keyword_text": None, "_extracted_at": EARLIER},
        {"matched_keyword_text": "", "spend": 5.0},
        {"search_term": ""},
        {"search_term": None},
    )
    row = only(silver.silver_search_terms(raw))
    assert (row["matched_keyword_text"], row["spend"]) == ("", 5.0)


def test_negatives_by_scope_and_latest_snapshot(spark):
    raw = samples.negatives(
        spark,
        {"_extracted_at": EARLIER, "criterion_text": "stale"},
        {},
        {"scope": "ad_group", "ad_group_id": "100"},
        {"criterion_id": "6", "criterion_text": ""},
        {"customer_id": "9", "snapshot_date": date(2026, 3, 31)},
    )
    rows = silver.silver_negatives(raw)
    assert sorted(r["criterion_text"] for r in rows.collect()) == ["free", "free", "free"]
    assert {r["account_id"] for r in gold.gold_negatives(rows).collect()} == {"1"}
    both = gold.gold_negatives(rows, per_account=True)
    assert {r["account_id"] for r in both.collect()} == {"1", "9"}


def test_meta_conversions_and_union(spark):
    meta = silver.silver_meta_ads(
        samples.meta(spark, {}, {"_extracted_at": EARLIER, "spend": 1.0}, {"clicks": None, "ad_id": "x"})
    )
    assert sorted(r["conversions"] for r in meta.collect()) == [3.0, 3.0]
    unified = silver.unified_campaigns(meta, silver.silver_google_ads(samples.google(spark)))
    rows = {r["platform"]: r.asDict() for r in unified.collect()}
    assert rows["meta_ads"]["spend"] == 60.0 and rows["meta_ads"]["conversion_value"] == 0.0
    assert rows["google_ads"]["conversion_value"] == 50.0


def unified_rows(spark, *rows):
    schema = """account_id string, account_name string, campaign_id string, campaign_name string,
        date date, platform string, impressions bigint, clicks bigint, spend double,
        conversions double, conversion_value double"""
    return spark.createDataFrame(rows, schema)


def test_daily_kpis_and_zero_divisors(spark):
    unified = unified_rows(
        spark,
        ("1", "A", "c", "C", DAY, "google_ads", 1000, 100, 150.0, 5.0, 300.0),
        ("1", "A", "d", "D", DAY, "google_ads", 0, 0, 50.0, 5.0, 300.0),
        ("2", "B", "c", "C", DAY, "meta_ads", 0, 0, 10.0, 0.0, None),
        ("3", "Z", "c", "C", DAY, "meta_ads", 9, 9, 0.0, 9.0, 0.0),
    )
    rows = {r["account_id"]: r for r in gold.daily_performance(unified).collect()}
    assert set(rows) == {"1", "2"}  # no spend, no row
    first, second = rows["1"], rows["2"]
    assert (first["ctr"], first["cpc"], first["cost_per_conversion"]) == (10.0, 2.0, 20.0)
    assert (first["conversion_rate"], first["roas"]) == (10.0, 3.0)
    assert [second[k] for k in ("ctr", "cpc", "cost_per_conversion", "conversion_rate")] == [None] * 4
    assert second["roas"] == 0.0


def test_weeks_start_on_monday(spark):
    days = [date(2026, 4, 5), date(2026, 4, 6), date(2026, 4, 12)]
    unified = unified_rows(
        spark, *[("1", "A", "c", "C", d, "google_ads", 10, 1, 2.0, 1.0, 1.0) for d in days]
    )
    rows = {r["week_start"]: r for r in gold.weekly_performance(unified).collect()}
    assert set(rows) == {date(2026, 3, 30), date(2026, 4, 6)}
    week = rows[date(2026, 4, 6)]
    assert (week["period_start"], week["period_end"], week["spend"]) == (days[1], days[2], 4.0)
    assert "roas" not in week.asDict()


def pacing(spark, budget, spends, as_of=date(2026, 4, 15), **options):
    made = datetime(2026, 1, 1)
    budgets = spark.createDataFrame(
        [("1", "google_ads", Decimal(budget), "BRL", True, made, made)], CLIENT_BUDGET
    )
    daily = spark.createDataFrame(
        [("1", "google_ads", d, s) for d, s in spends],
        "account_id string, platform string, date date, spend double",
    )
    return only(gold.budget_pacing(budgets, daily, as_of, **options))


@pytest.mark.parametrize(
    ("spend", "flag"),
    [(600.0, "on_track"), (600.01, "over"), (400.0, "on_track"), (399.99, "under"), (0.0, "under")],
)
def test_pace_edges(spark, spend, flag):
    row = pacing(spark, "1000", [(date(2026, 4, 2), spend)])
    assert (row["pace_flag"], row["days_elapsed_pct"]) == (flag, 50.0)


def test_pacing_counts_the_month_only(spark):
    spends = [(date(2026, 3, 31), 5.0), (date(2026, 4, 1), 7.0), (date(2026, 4, 30), 9.0),
              (date(2026, 5, 1), 11.0)]
    assert pacing(spark, "100", spends)["spent_mtd"] == 16.0
    assert pacing(spark, "100", spends, cap_at_as_of=True)["spent_mtd"] == 7.0
    empty = pacing(spark, "100", [(date(2026, 1, 1), 5.0)])
    assert (empty["spent_mtd"], empty["pct_consumed"]) == (0.0, 0.0)
    assert pacing(spark, "0", spends)["pace_flag"] == "unknown"
    assert pacing(spark, "0", spends)["pct_consumed"] is None


def test_prefixed_budget_ids(spark):
    made = datetime(2026, 1, 1)
    budgets = spark.createDataFrame(
        [
            ("act_2", "meta_ads", Decimal("100"), "BRL", True, made, made),
            ("3", "google_ads", Decimal("100"), "BRL", False, made, made),
        ],
        CLIENT_BUDGET,
    )
    daily = spark.createDataFrame(
        [("2", "meta_ads", date(2026, 4, 2), 40.0)],
        "account_id string, platform string, date date, spend double",
    )
    day = date(2026, 4, 15)
    assert only(gold.budget_pacing(budgets, daily, day))["spent_mtd"] == 0.0
    assert only(gold.budget_pacing(budgets, daily, day, prefix_meta_ids=True))["spent_mtd"] == 40.0


def test_gold_keywords_and_terms(spark):
    keywords = gold.gold_keywords(
        silver.silver_keywords(
            samples.google(spark, {}, {"keyword_id": "9", "quality_score": 4}, {
                "keyword_id": "8", "keyword_text": "free", "spend": 0.0})
        )
    )
    row = only(keywords)
    assert (row["spend"], row["roas"], row["quality_score"]) == (40.0, 2.5, 5.5)
    terms = gold.gold_search_terms(
        silver.silver_search_terms(samples.terms(spark, {}, {"search_term": "x", "spend": 0.0}))
    )
    assert only(terms)["roas"] == 2.5


def test_load_time_is_kept(spark):
    assert only(silver.silver_google_ads(samples.google(spark)))["_extracted_at"] == LOADED
