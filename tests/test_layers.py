from __future__ import annotations

import inspect
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from test_transform import DAYS, fill

from adtide.functions.dates import Period
from adtide.operators import ranking
from adtide.plans import access, gold, metrics, review
from adtide.plans.layers import LayerViolation, read_paths, read_tables, refuse_layers
from adtide.plans.transform import gold_tables, run_transform
from adtide.schemas import APP_USERS, API_KEYS, CLIENT_BUDGET
from adtide.sources.tables import materialize, read_table

PERIOD = Period(DAYS[0], DAYS[2])


@pytest.fixture(scope="module")
def served(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("layers") / "warehouse")
    fill(spark, root)
    run_transform(spark, root)
    made = datetime(2026, 1, 1)
    materialize(spark.createDataFrame([("1", "google_ads", Decimal(9), "BRL", True, made, made)], CLIENT_BUDGET), root, "ops", "client_budget")
    materialize(spark.createDataFrame([], APP_USERS), root, "users", "app_users")
    materialize(spark.createDataFrame([], API_KEYS), root, "ops", "api_keys")
    return root


@pytest.fixture
def tables(spark, served, monkeypatch):
    """Stored gold tables; what is written in between is looked at before it is written."""
    plain = ranking.staged

    def looked_at(df, purpose):
        return plain(refuse_layers(df, served), purpose)

    for module in (ranking, review):
        monkeypatch.setattr(module, "staged", looked_at)
    return gold_tables(spark, served)


def calls(g):
    """Every public query of the modules that serve figures, on stored tables."""
    campaigns = review.flagged_campaigns(g, PERIOD)
    pacing = gold.budget_pacing(g.budget, g.daily, DAYS[2])
    accounts = review.account_overview(g.daily)
    documents = review.account_review(g, PERIOD, DAYS[2], campaigns=campaigns)
    return {
        metrics: {
            "daily_range": metrics.daily_range(g.daily, "google_ads", PERIOD),
            "daily_window": metrics.daily_window(g.daily, "google_ads", "lastmonth", DAYS[2]),
            "keywords_range": metrics.keywords_range(g.keywords, PERIOD),
            "clients": metrics.clients(g.daily),
            "budgets": metrics.budgets(g.budget),
        },
        review: {
            "account_overview": accounts,
            "account_performance": review.account_performance(g.daily, PERIOD),
            "campaign_totals": review.campaign_totals(g.keywords, PERIOD),
            "campaign_rows": review.campaign_rows(g.keywords, PERIOD),
            "top_keywords": review.top_keywords(g.keywords, PERIOD),
            "search_term_totals": review.search_term_totals(g.search_terms, PERIOD),
            "wasted_search_terms": review.wasted_search_terms(g.search_terms, PERIOD),
            "high_roas_search_terms": review.high_roas_search_terms(g.search_terms, PERIOD),
            "search_term_buckets": review.search_term_buckets(g.search_terms, PERIOD),
            "negatives_total": review.negatives_total(g.negatives),
            "campaigns_without_negatives": review.campaigns_without_negatives(g.keywords, g.negatives, PERIOD),
            "negatives_coverage": review.negatives_coverage(g.negatives, g.keywords, accounts, PERIOD),
            "pacing_for_review": review.pacing_for_review(pacing, accounts),
            "flagged_campaigns": campaigns,
            "review_facts": review.review_facts(g, PERIOD, DAYS[2]),
            "signals": review.signals(g, PERIOD, DAYS[2]),
            "review_summary": review.review_summary(g, PERIOD, DAYS[2]),
            "account_review": documents,
            "review_campaigns": review.review_campaigns(campaigns),
            "review_uncovered": review.review_uncovered(campaigns),
            "review_lines": review.review_lines(documents, campaigns),
        },
    }


#: Functions that are given no stored table, and the one that gives several.
HELPERS = {"page_schema", "page_entries", "review_inputs"}


def test_every_query_that_serves_figures_reads_gold_and_ops_alone(tables, served):
    for module, queries in calls(tables).items():
        public = {n for n, f in inspect.getmembers(module, inspect.isfunction) if f.__module__ == module.__name__ and not n.startswith("_")}
        assert public - HELPERS == set(queries)
        for df in queries.values():
            assert {layer for layer, _ in read_tables(refuse_layers(df, served), served)} <= {"gold", "ops"}
    for df in review.review_inputs(tables, PERIOD):
        refuse_layers(df, served)


def test_access_reports_read_users_and_ops_alone(spark, served):
    keys = read_table(spark, served, "ops", "api_keys", API_KEYS)
    users = read_table(spark, served, "users", "app_users", APP_USERS)
    status = access.live_key_status(keys, users, datetime(2026, 4, 1))
    assert read_tables(refuse_layers(status, served), served) == [("ops", "api_keys"), ("users", "app_users")]


@pytest.mark.parametrize("layer", ["silver", "bronze"])
def test_a_query_on_a_closed_layer_is_refused_however_it_hides(spark, tables, served, layer):
    name = {"silver": "unified_campaigns", "bronze": "google_ads_raw"}[layer]
    closed = read_table(spark, served, layer, name)
    daily = metrics.daily_range(tables.daily, "google_ads", PERIOD)
    closed.createOrReplaceTempView("hidden")
    hidden = {
        "joined": daily.join(closed.select(F.col("date").alias("d")), F.col("d") == F.col("date"), "left_semi"),
        "scalar": daily.where(F.col("date") <= closed.agg(F.max("date")).scalar()),
        "view": daily.unionByName(spark.sql("SELECT * FROM hidden").select(F.lit("x").alias("account_id")), allowMissingColumns=True),
        "table": closed,
    }
    for df in hidden.values():
        with pytest.raises(LayerViolation, match=f"{layer}.{name}"):
            refuse_layers(df, served)
    assert refuse_layers(closed, served, [layer]) is closed


def test_made_rows_and_other_folders_are_no_layer(spark, served, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "silver" / "x"))
    df = spark.read.parquet(str(tmp_path / "silver" / "x")).unionByName(spark.range(2))
    assert read_paths(df) == [str(tmp_path / "silver" / "x")] and read_tables(df, served) == []
    assert read_tables(spark.range(1), served) == []
    assert date(2026, 4, 1) in DAYS
