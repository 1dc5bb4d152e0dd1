from __future__ import annotations

import json
from datetime import date, datetime
from decimal import Decimal

import pytest

from adtide.functions.dates import Period
from adtide.plans import review
from adtide.plans.review import GoldTables
from adtide.plans.signals import signal_rows
from adtide.schemas import CLIENT_BUDGET
from adtide.sources.tables import read_review_lines, write_review_json, write_review_lines

DAY = date(2026, 4, 10)
PERIOD = Period(date(2026, 4, 1), date(2026, 4, 22))
AS_OF = date(2026, 4, 15)
MADE = datetime(2026, 1, 1)

DAILY = """account_id string, account_name string, date date, platform string, impressions bigint,
    clicks bigint, spend double, conversions double, conversion_value double"""
KEYWORDS = """account_id string, account_name string, campaign_name string, ad_group_name string,
    keyword_text string, match_type string, date date, impressions bigint, clicks bigint,
    spend double, conversions double, conversion_value double, quality_score double,
    campaign_status string"""
TERMS = """account_id string, campaign_name string, ad_group_name string, search_term string,
    search_term_status string, matched_keyword_text string, matched_keyword_match_type string,
    date date, impressions bigint, clicks bigint, spend double, conversions double,
    conversion_value double"""


def keyword(account, campaign, spend, conversions, value, text="kw1", status="ENABLED", quality=7.5):
    return (account, "Acme", campaign, "AG1", text, "EXACT", DAY, 1000, 100, spend, conversions,
            value, quality, status)


def term(account, text, spend, conversions=0.0, value=0.0):
    return (account, "Camp A", "AG1", text, "NONE", "kw1", "EXACT", DAY, 10, 1, spend,
            conversions, value)


def tables(spark, daily=(), keywords=(), terms=(), negatives=(), budget=()):
    return GoldTables(
        daily=spark.createDataFrame(list(daily), DAILY),
        keywords=spark.createDataFrame(list(keywords), KEYWORDS),
        search_terms=spark.createDataFrame(list(terms), TERMS),
        negatives=spark.createDataFrame(
            list(negatives), "account_id string, campaign_name string"
        ),
        budget=spark.createDataFrame(
            [(a, p, Decimal(b), "BRL", True, MADE, MADE) for a, p, b in budget], CLIENT_BUDGET
        ),
    )


def day_row(account, spend, value, impressions=1000, clicks=100, conversions=10.0, day=DAY):
    return (account, "Acme", day, "google_ads", impressions, clicks, spend, conversions, value)


def test_performance_figures(spark):
    gold = tables(
        spark,
        daily=[
            day_row("123", 200.0, 600.0),
            day_row("123", 999.0, 1.0, day=date(2026, 3, 1)),
            day_row("9", 5.0, 5.0, day=date(2026, 3, 1)),
        ],
    )
    rows = {r["account_id"]: r for r in review.account_performance(gold.daily, PERIOD).collect()}
    got = rows["123"]
    assert [got[k] for k in ("ctr", "cpc", "cpa", "roas")] == [10.0, 2.0, 20.0, 3.0]
    idle = rows["9"]
    assert (idle["spend"], idle["impressions"]) == (0.0, 0)
    assert [idle[k] for k in ("ctr", "cpc", "cpa", "roas")] == [None] * 4


def test_campaign_and_keyword_rows(spark):
    gold = tables(
        spark,
        keywords=[
            keyword("123", "Camp A", 100.0, 5.0, 250.0),
            keyword("123", "Camp B", 50.0, 0.0, 0.0, "kw2", "PAUSED"),
            keyword("123", "Camp B", 150.0, 0.0, 150.0),
        ],
    )
    rows = review.campaign_rows(gold.keywords, PERIOD).collect()
    assert [(r["campaign_name"], r["status"], r["roas"]) for r in rows] == [
        ("Camp B", "PAUSED", 0.75),
        ("Camp A", "ENABLED", 2.5),
    ]
    top = review.top_keywords(gold.keywords, PERIOD, k=1).collect()
    assert [(r["keyword_text"], r["spend"], r["roas"], r["campaign_name"]) for r in top] == [
        ("kw1", 250.0, 1.6, "Camp B")
    ]


def test_high_returns_are_cut_before_they_are_filtered(spark):
    terms = [term("1", f"t{i:02}", 10.0, 1.0, 100.0 - i) for i in range(20)]
    terms += [term("1", "poor", 1.0, 1.0, 0.5)]
    gold = tables(spark, terms=terms)
    kept = review.high_roas_search_terms(gold.search_terms, PERIOD).collect()
    assert sorted(r["search_term"] for r in kept) == [f"t{i:02}" for i in range(15)]
    few = tables(spark, terms=[term("1", "good", 1.0, 1.0, 2.0), term("1", "poor", 1.0, 1.0, 1.0)])
    kept = review.high_roas_search_terms(few.search_terms, PERIOD).collect()
    assert [r["search_term"] for r in kept] == ["good"]


def fired(spark, **facts):
    base = {
        "account_id": "1",
        "spend": 0.0,
        "roas": None,
        "pace_flag": "unknown",
        "pct_consumed": None,
        "days_elapsed_pct": 50.0,
        "zero_conversion_count": 0,
        "zero_conversion_names": [],
        "uncovered_count": 0,
        "uncovered_names": [],
        "wasted_count": 0,
        "wasted_spend": 0.0,
    }
    schema = """account_id string, spend double, roas double, pace_flag string,
        pct_consumed double, days_elapsed_pct double, zero_conversion_count bigint,
        zero_conversion_names array<string>, uncovered_count bigint,
        uncovered_names array<string>, wasted_count bigint, wasted_spend double"""
    rows = spark.createDataFrame([tuple((base | facts).values())], schema)
    return {r["code"]: (r["position"], r["severity"], r["message"]) for r in signal_rows(rows).collect()}


@pytest.mark.parametrize(
    ("spend", "roas", "fires"),
    [(200.0, 0.5, True), (10.0, 0.2, False), (500.0, 1.5, False), (500.0, None, False),
     (50.0, 0.99, True), (49.99, 0.5, False), (500.0, 1.0, False)],
)
def test_low_return(spark, spend, roas, fires):
    assert ("roas_below_one" in fired(spark, spend=spend, roas=roas)) == fires


def test_pace_signals(spark):
    over = fired(spark, pace_flag="over", pct_consumed=60.15, days_elapsed_pct=48.39)
    assert over == {
        "budget_over_pace": (1, "warning", "Spend do mês em 60.1% com apenas 48.4% do mês decorrido.")
    }
    under = fired(spark, pace_flag="under", pct_consumed=20.0)
    assert list(under) == ["budget_under_pace"] and under["budget_under_pace"][1] == "info"
    assert fired(spark, pace_flag="over") == {}
    assert fired(spark, pace_flag="on_track", pct_consumed=50.0) == {}


def test_list_signals(spark):
    assert fired(spark, wasted_count=4, wasted_spend=40.0) == {}
    got = fired(
        spark, wasted_count=6, wasted_spend=120.0, zero_conversion_count=7,
        zero_conversion_names=list("ABCDEFG"), uncovered_count=2, uncovered_names=["A", "B"],
    )
    assert got["search_terms_wasting_spend"][2] == (
        "6 search terms com R$ 120.00 de spend sem conversão — candidatos a negativa."
    )
    assert got["campaigns_with_zero_conversions"][2] == (
        "7 campanhas com spend sem nenhuma conversão: A, B, C, D, E"
    )
    assert got["campaigns_without_negatives"] == (3, "info", "2 campanhas sem negativas: A, B")


def full_case(spark):
    return tables(
        spark,
        daily=[
            day_row("1", 200.0, 100.0),
            day_row("2", 100.0, 900.0),
        ],
        keywords=[
            keyword("1", "Camp A", 100.0, 0.0, 0.0),
            keyword("1", "Camp B", 200.0, 5.0, 100.0, "kw2"),
            keyword("1", "Camp C", 10.0, 0.0, 0.0, "kw3"),
            keyword("1", None, 500.0, 0.0, 0.0, "kw4"),
            keyword("2", "Camp A", 100.0, 5.0, 900.0),
        ],
        terms=[term("1", f"t{i}", 20.0) for i in range(6)]
        + [term("1", "win", 1.0, 1.0, 9.0), term("2", "ok", 1.0, 1.0, 0.5)],
        negatives=[("1", "Camp B"), ("1", "Camp B"), ("2", "Camp A")],
        budget=[("1", "google_ads", "300"), ("1", "meta_ads", "1")],
    )


def listed(rows, account, name="campaign_name"):
    own = sorted((r for r in rows.collect() if r["account_id"] == account), key=lambda r: r["position"])
    assert [r["position"] for r in own] == list(range(1, len(own) + 1))
    return [r[name] for r in own]


def test_whole_review(spark):
    gold = full_case(spark)
    documents = review.account_review(gold, PERIOD, AS_OF).collect()
    docs = {d["account"]["account_id"]: d for d in documents}
    assert set(docs) == {"1", "2"} and len(documents) == 2
    first, second = docs["1"], docs["2"]
    campaigns = review.flagged_campaigns(gold, PERIOD)
    assert listed(review.review_campaigns(campaigns), "1") == [None, "Camp B", "Camp A", "Camp C"]
    assert first["campaign_count"] == 4
    assert [k["keyword_text"] for k in first["keywords_top"]] == ["kw4", "kw2", "kw1", "kw3"]
    assert [t["search_term"] for t in first["search_terms"]["top_by_spend_no_conv"]] == [
        f"t{i}" for i in range(6)
    ]
    assert [t["search_term"] for t in first["search_terms"]["high_roas"]] == ["win"]
    assert first["negatives"]["total_negatives"] == 2
    assert first["negatives"]["uncovered_count"] == 2
    assert listed(review.review_uncovered(campaigns), "1") == ["Camp A", "Camp C"]
    assert (first["budget"]["monthly_budget"], first["budget"]["pace_flag"]) == (300.0, "over")
    assert [s["code"] for s in first["signals"]] == [
        "roas_below_one",
        "budget_over_pace",
        "campaigns_with_zero_conversions",
        "search_terms_wasting_spend",
        "campaigns_without_negatives",
    ]
    assert first["signals"][2]["message"].endswith("1 campanhas com spend sem nenhuma conversão: Camp A")
    assert second["signals"] == [] and second["budget"]["pace_flag"] == "unknown"
    assert second["budget"]["spent_mtd"] == 0.0
    assert second["search_terms"]["high_roas"] == []
    assert first["period"]["start"] == PERIOD.start


def test_many_campaigns_keep_one_form(spark):
    gold = full_case(spark)
    many = spark.range(12_000).selectExpr(
        "'2' AS account_id", "concat('C', lpad(id, 5, '0')) AS campaign_name", "CAST(id % 900 + 1 AS DOUBLE) AS spend"
    )
    base = gold.keywords.where("account_id = '2'").limit(1).drop("account_id", "campaign_name", "spend")
    gold = gold._replace(keywords=gold.keywords.unionByName(many.crossJoin(base)))
    documents = review.account_review(gold, PERIOD, AS_OF).collect()
    assert sorted(d["account"]["account_id"] for d in documents) == ["1", "2"]
    second = next(d for d in documents if d["account"]["account_id"] == "2")
    assert second["campaign_count"] == 12_001 and second["negatives"]["uncovered_count"] == 12_000
    campaigns = review.flagged_campaigns(gold, PERIOD)
    brute = sorted([(-(i % 900 + 1.0), f"C{i:05}") for i in range(12_000)] + [(-100.0, "Camp A")])
    assert listed(review.review_campaigns(campaigns), "2") == [name for _, name in brute]
    assert listed(review.review_uncovered(campaigns, "2"), "2") == [f"C{i:05}" for i in range(12_000)]


def test_one_account_is_the_same_review(spark):
    gold = full_case(spark)
    every = {d["account"]["account_id"]: d for d in review.account_review(gold, PERIOD, AS_OF).collect()}
    (one,) = review.account_review(gold, PERIOD, AS_OF, account="1").collect()
    assert one == every["1"]
    assert review.account_review(gold, PERIOD, AS_OF, account="none").isEmpty()


def test_inputs_of_a_review_give_the_same_review(spark):
    gold = full_case(spark)
    slim = review.review_inputs(gold, PERIOD)
    order = lambda rows: sorted(rows, key=lambda r: r["account_id"])
    assert order(review.review_summary(slim, PERIOD, AS_OF).collect()) == order(
        review.review_summary(gold, PERIOD, AS_OF).collect()
    )


def test_documents_as_json(spark, tmp_path):
    path = str(tmp_path / "reviews")
    write_review_json(review.account_review(full_case(spark), PERIOD, AS_OF), path)
    lines = [json.loads(r[0]) for r in spark.read.text(path).collect()]
    document = next(d for d in lines if d["account"]["account_id"] == "2")
    assert document["budget"]["monthly_budget"] is None
    assert document["period"] == {"start": "2026-04-01", "end": "2026-04-22"}
    assert document["signals"] == []


@pytest.mark.parametrize("size", [1, 7, 500])
def test_whole_reviews_are_written_in_bounded_pages(spark, tmp_path, size):
    gold = full_case(spark)
    many = [keyword("2", f"C{i:04}", float(i % 9 + 1), 0.0, 0.0) for i in range(1203)]
    gold = gold._replace(keywords=gold.keywords.unionByName(spark.createDataFrame(many, KEYWORDS)))
    campaigns = review.flagged_campaigns(gold, PERIOD)
    documents, path = review.account_review(gold, PERIOD, AS_OF), str(tmp_path / "whole")
    write_review_lines(review.review_lines(documents, campaigns, size), path)
    assert sorted(read_review_lines(spark, path, review.DOCUMENT, documents.schema).collect()) == sorted(documents.collect())
    for section, rows in ((review.CAMPAIGN_PAGES, review.review_campaigns(campaigns)), (review.UNCOVERED_PAGES, review.review_uncovered(campaigns))):
        pages = read_review_lines(spark, path, section, review.page_schema(section))
        assert pages.selectExpr("max(size(entries))").first()[0] <= size
        back = review.page_entries(pages, size).select(*rows.columns)
        assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, rows.collect()), key=str)
        lengths = {r["account_id"]: r["n"] for r in rows.groupBy("account_id").count().withColumnRenamed("count", "n").collect()}
        found = {r["account_id"]: r["n"] for r in pages.groupBy("account_id").count().withColumnRenamed("count", "n").collect()}
        assert found == {account: -(-n // size) for account, n in lengths.items()}


def test_a_review_without_lists_has_documents_only(spark, tmp_path):
    gold, path = tables(spark, daily=[day_row("1", 9.0, 9.0)]), str(tmp_path / "whole")
    documents = review.account_review(gold, PERIOD, AS_OF)
    write_review_lines(review.review_lines(documents, review.flagged_campaigns(gold, PERIOD)), path)
    assert read_review_lines(spark, path, review.DOCUMENT, documents.schema).count() == 1
    assert read_review_lines(spark, path, review.CAMPAIGN_PAGES, review.page_schema(review.CAMPAIGN_PAGES)).isEmpty()


def test_hot_account_keeps_whole_counts(spark):
    """A third of the campaigns and terms in one account, against brute force."""
    rows = [keyword("hot", f"C{i % 700}", 60.0, float(i % 2), 1.0, f"k{i}") for i in range(2100)]
    rows += [keyword(f"a{i % 50}", f"C{i}", 60.0, 0.0, 1.0) for i in range(1000)]
    terms = [term("hot", f"t{i % 900}", 1.0 + i % 7, float(i % 3 == 0)) for i in range(1800)]
    gold = tables(spark, daily=[day_row("hot", 9.0, 9.0)], keywords=rows, terms=terms)
    got = review.review_summary(gold, PERIOD, AS_OF).first()
    totals: dict[str, float] = {}
    for row in rows:
        if row[0] == "hot":
            totals[row[2]] = totals.get(row[2], 0.0) + row[10]
    facts = review.review_facts(gold, PERIOD, AS_OF).first()
    assert got["campaign_count"] == len(totals) == got["uncovered_count"]
    assert facts["zero_conversion_count"] == sum(1 for v in totals.values() if v == 0)
    assert facts["uncovered_names"] == sorted(totals)[:5]
    spend: dict[str, list[float]] = {}
    for row in terms:
        entry = spend.setdefault(row[3], [0.0, 0.0])
        entry[0] += row[10]
        entry[1] += row[11]
    wasted = sorted(((-s, t) for t, (s, c) in spend.items() if c == 0))[:15]
    assert [t["search_term"] for t in facts["wasted_terms"]] == [t for _, t in wasted]
