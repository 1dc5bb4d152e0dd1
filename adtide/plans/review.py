"""Account review: period figures, top lists, coverage, pacing and signals.

Every section is computed for all accounts in one plan, keyed by ``account_id``;
naming an account only adds a filter that reaches the scans. Sections are reduced
to one row per account before they are joined.
"""

from __future__ import annotations

from datetime import date
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from adtide.functions.dates import Period
from adtide.functions.numeric import exact_avg, exact_sum
from adtide.operators.filters import (
    drop_blank,
    for_account,
    in_range,
    roas_above,
    zero_conversions,
)
from adtide.operators.grouping import totals_by
from adtide.operators.kpis import period_kpis, row_roas
from adtide.operators.ranking import first_platform, positions, top_per_group
from adtide.plans.gold import budget_pacing
from adtide.plans.signals import LISTED_NAMES, MIN_SPEND, evaluate_all, signal_rows
from adtide.schemas import record
from adtide.sources.tables import staged

TOP_KEYWORDS = 20
TOP_SEARCH_TERMS = 15
MIN_ROAS = 1.0

#: Entries of a long list that one page of a written review holds.
PAGE_ENTRIES = 500
#: Sections of written reviews.
DOCUMENT, CAMPAIGN_PAGES, UNCOVERED_PAGES = "review", "campaigns", "campaigns_without_negatives"
JSON_OPTIONS = {"ignoreNullFields": "false"}


class GoldTables(NamedTuple):
    """Inputs of a review."""

    daily: DataFrame
    keywords: DataFrame
    search_terms: DataFrame
    negatives: DataFrame
    budget: DataFrame

    def of_account(self, account: str | None) -> GoldTables:
        return GoldTables(*[for_account(df, account) for df in self])


def review_inputs(gold: GoldTables, period: Period) -> GoldTables:
    """The days and columns a review reads, to be stored before it reads them.

    Days are part of every grouping and version key below, so the filter goes
    through them to the raw tables.
    """
    figures = ["impressions", "clicks", "spend", "conversions", "conversion_value"]
    names = ["account_id", "campaign_name", "ad_group_name", "date"]
    return gold._replace(
        daily=gold.daily.select("account_id", "account_name", "platform", "date", *figures),
        keywords=in_range(gold.keywords, period).select(
            *names, "keyword_text", "match_type", "campaign_status", "quality_score", *figures
        ),
        search_terms=in_range(gold.search_terms, period).select(
            *names,
            "search_term",
            "search_term_status",
            "matched_keyword_text",
            "matched_keyword_match_type",
            *figures,
        ),
        negatives=gold.negatives.select("account_id", "campaign_name"),
    )


def _account_totals(daily: DataFrame, period: Period) -> DataFrame:
    """Identification from all days and totals from the period, in one pass."""
    inside = F.col("date").between(F.lit(period.start), F.lit(period.end))
    return (
        daily.withColumn("inside", inside)
        .groupBy("account_id")
        .agg(
            F.max("account_name").alias("account_name"),
            F.min("platform").alias("platform"),
            F.expr("sum(impressions) FILTER (WHERE inside)").alias("impressions"),
            F.expr("sum(clicks) FILTER (WHERE inside)").alias("clicks"),
            exact_sum("if(inside, spend, NULL)").alias("spend"),
            exact_sum("if(inside, conversions, NULL)").alias("conversions"),
            exact_sum("if(inside, conversion_value, NULL)").alias("conversion_value"),
        )
    )


def account_overview(daily: DataFrame, account: str | None = None) -> DataFrame:
    """Name and first platform of every account that ever spent."""
    return (
        for_account(daily, account)
        .groupBy("account_id")
        .agg(F.max("account_name").alias("account_name"), F.min("platform").alias("platform"))
    )


PERFORMANCE = (
    "impressions",
    "clicks",
    "spend",
    "conversions",
    "conversion_value",
    "ctr",
    "cpc",
    "cpa",
    "roas",
)


def account_performance(daily: DataFrame, period: Period, account: str | None = None) -> DataFrame:
    """Totals and KPIs of the period; an account without rows in it gets zeros."""
    totals = period_kpis(_account_totals(for_account(daily, account), period))
    return totals.select("account_id", *PERFORMANCE)


def campaign_totals(keywords: DataFrame, period: Period) -> DataFrame:
    totals = totals_by(
        in_range(keywords, period),
        ["account_id", "campaign_name"],
        F.max("campaign_status").alias("status"),
        exact_sum("spend").alias("spend"),
        exact_sum("conversions").alias("conversions"),
        exact_sum("conversion_value").alias("conversion_value"),
    )
    return totals.withColumn("roas", row_roas())


def campaign_rows(keywords: DataFrame, period: Period, account: str | None = None) -> DataFrame:
    """One row per campaign with its status and return, dearest first."""
    rows = campaign_totals(for_account(keywords, account), period)
    return rows.orderBy("account_id", F.desc("spend"), "campaign_name")


def top_keywords(
    keywords: DataFrame, period: Period, k: int = TOP_KEYWORDS, account: str | None = None
) -> DataFrame:
    """Dearest keyword texts of each account, added up over campaigns."""
    totals = totals_by(
        in_range(for_account(keywords, account), period),
        ["account_id", "keyword_text"],
        F.max("match_type").alias("match_type"),
        F.max("campaign_name").alias("campaign_name"),
        F.max("ad_group_name").alias("ad_group_name"),
        F.sum("impressions").alias("impressions"),
        F.sum("clicks").alias("clicks"),
        exact_sum("spend").alias("spend"),
        exact_sum("conversions").alias("conversions"),
        exact_sum("conversion_value").alias("conversion_value"),
        exact_avg("quality_score").alias("quality_score"),
    )
    ranked = top_per_group(totals, ["account_id"], [F.desc("spend"), F.asc("keyword_text")], k)
    return ranked.withColumn("roas", row_roas())


def search_term_totals(
    terms: DataFrame, period: Period, account: str | None = None
) -> DataFrame:
    return totals_by(
        in_range(for_account(terms, account), period),
        ["account_id", "search_term"],
        F.max("campaign_name").alias("campaign_name"),
        F.max("ad_group_name").alias("ad_group_name"),
        F.max("matched_keyword_text").alias("matched_keyword_text"),
        F.max("matched_keyword_match_type").alias("matched_keyword_match_type"),
        F.max("search_term_status").alias("status"),
        F.sum("impressions").alias("impressions"),
        F.sum("clicks").alias("clicks"),
        exact_sum("spend").alias("spend"),
        exact_sum("conversions").alias("conversions"),
        exact_sum("conversion_value").alias("conversion_value"),
    )


def _wasted(totals: DataFrame, k: int) -> DataFrame:
    order = [F.desc("spend"), F.asc("search_term")]
    ranked = top_per_group(zero_conversions(totals), ["account_id"], order, k)
    return ranked.withColumn("roas", row_roas())


def _high_roas(totals: DataFrame, k: int, min_roas: float) -> DataFrame:
    unrounded = F.col("conversion_value") / F.nullif(F.col("spend"), F.lit(0.0))
    order = [unrounded.desc_nulls_last(), F.asc("search_term")]
    ranked = top_per_group(totals, ["account_id"], order, k)
    return roas_above(ranked.withColumn("roas", row_roas()), min_roas)


def wasted_search_terms(
    terms: DataFrame, period: Period, k: int = TOP_SEARCH_TERMS, account: str | None = None
) -> DataFrame:
    """Dearest search terms of each account that never converted."""
    return _wasted(search_term_totals(terms, period, account), k)


def high_roas_search_terms(
    terms: DataFrame,
    period: Period,
    k: int = TOP_SEARCH_TERMS,
    min_roas: float = MIN_ROAS,
    account: str | None = None,
) -> DataFrame:
    """Best returns of each account: the list is cut first, then filtered."""
    return _high_roas(search_term_totals(terms, period, account), k, min_roas)


def search_term_buckets(
    terms: DataFrame, period: Period, account: str | None = None
) -> DataFrame:
    """Both search-term lists, told apart by ``bucket``."""
    totals = search_term_totals(terms, period, account)
    wasted = _wasted(totals, TOP_SEARCH_TERMS)
    winners = _high_roas(totals, TOP_SEARCH_TERMS, MIN_ROAS)
    return wasted.withColumn("bucket", F.lit("top_by_spend_no_conv")).unionByName(
        winners.withColumn("bucket", F.lit("high_roas"))
    )


def negatives_total(negatives: DataFrame, account: str | None = None) -> DataFrame:
    """Number of negative keywords per account."""
    rows = for_account(negatives, account).groupBy("account_id")
    return rows.agg(F.count("*").alias("total_negatives"))


def _covered_campaigns(negatives: DataFrame) -> DataFrame:
    # de-duplicated first: a campaign with very many negatives is one row per task
    return negatives.select("account_id", "campaign_name").distinct()


def campaigns_without_negatives(
    keywords: DataFrame, negatives: DataFrame, period: Period, account: str | None = None
) -> DataFrame:
    """Campaigns with spend in the period that no negative keyword names."""
    running = in_range(for_account(keywords, account), period)
    names = drop_blank(running.select("account_id", "campaign_name"), "campaign_name").distinct()
    covered = _covered_campaigns(for_account(negatives, account))
    uncovered = names.join(covered, ["account_id", "campaign_name"], "left_anti")
    return uncovered.orderBy("account_id", "campaign_name")


def negatives_coverage(
    negatives: DataFrame, keywords: DataFrame, accounts: DataFrame, period: Period
) -> DataFrame:
    """Negative keywords and uncovered campaigns of every account, as counts."""
    uncovered = campaigns_without_negatives(keywords, negatives, period)
    counts = uncovered.groupBy("account_id").agg(F.count("*").alias("uncovered_count"))
    return (
        accounts.select("account_id")
        .join(negatives_total(negatives), "account_id", "left")
        .join(counts, "account_id", "left")
        .fillna(0, ["total_negatives", "uncovered_count"])
    )


def pacing_for_review(pacing: DataFrame, accounts: DataFrame) -> DataFrame:
    """Pacing of each account's first platform; ``unknown`` where no budget is set."""
    return (
        accounts.select("account_id")
        .join(first_platform(pacing).drop("platform"), "account_id", "left")
        .withColumns(
            {
                "spent_mtd": F.coalesce("spent_mtd", F.lit(0.0)),
                "pace_flag": F.coalesce("pace_flag", F.lit("unknown")),
            }
        )
    )


def flagged_campaigns(gold: GoldTables, period: Period) -> DataFrame:
    """Campaign rows of all accounts with the two conditions the list rules look at.

    The review reads them several times; a caller may store them and pass them on.
    """
    campaigns = campaign_totals(gold.keywords, period)
    covered = _covered_campaigns(gold.negatives).withColumn("covered", F.lit(True))
    named = F.coalesce(F.col("campaign_name") != "", F.lit(False))
    joined = campaigns.join(covered, ["account_id", "campaign_name"], "left")
    return joined.withColumns(
        {
            "no_conversion": named & (F.col("spend") >= MIN_SPEND) & (F.col("conversions") == 0),
            "uncovered": named & F.col("covered").isNull(),
        }
    ).drop("covered")


def _campaign_facts(campaigns: DataFrame) -> DataFrame:
    """Counts per account and the first names of both offender lists."""
    counts = campaigns.groupBy("account_id").agg(
        F.count("*").alias("campaign_count"),
        F.count_if("no_conversion").alias("zero_conversion_count"),
        F.count_if("uncovered").alias("uncovered_count"),
    )

    def entry(kind: str, flag: str, place: Column) -> Column:
        fields = F.struct(F.lit(kind).alias("kind"), place.alias("place"))
        return F.when(F.col(flag), fields)

    # one list is ordered by falling spend, the other by name alone
    entries = F.array_compact(
        F.array(
            entry("no_conversion", "no_conversion", -F.col("spend")),
            entry("uncovered", "uncovered", F.lit(0.0)),
        )
    )
    listed = campaigns.select("account_id", "campaign_name", F.inline(entries))
    first = top_per_group(listed, ["account_id", "kind"], ["place", "campaign_name"], LISTED_NAMES)

    def names(kind: str) -> Column:
        found = F.collect_list(
            F.when(F.col("kind") == kind, F.struct("position", "campaign_name"))
        )
        return F.transform(F.array_sort(found), lambda e: e["campaign_name"])

    lists = first.groupBy("account_id").agg(
        names("no_conversion").alias("zero_conversion_names"),
        names("uncovered").alias("uncovered_names"),
    )
    return counts.join(lists, "account_id", "left")


def _ordered(*fields: str) -> Column:
    """Aggregate: the rows of a ranked, bounded group as an ordered array."""
    found = F.collect_list(F.struct("position", F.struct(*fields).alias("row")))
    return F.transform(F.array_sort(found), lambda e: e["row"])


KEYWORD_FIELDS = (
    "keyword_text",
    "match_type",
    "campaign_name",
    "ad_group_name",
    "impressions",
    "clicks",
    "spend",
    "conversions",
    "conversion_value",
    "roas",
    "quality_score",
)
SEARCH_TERM_FIELDS = (
    "search_term",
    "campaign_name",
    "ad_group_name",
    "matched_keyword_text",
    "matched_keyword_match_type",
    "status",
    "impressions",
    "clicks",
    "spend",
    "conversions",
    "roas",
)
CAMPAIGN_FIELDS = ("campaign_name", "status", "spend", "conversions", "conversion_value", "roas")
BUDGET_FIELDS = (
    "monthly_budget",
    "currency",
    "spent_mtd",
    "pct_consumed",
    "days_elapsed_pct",
    "pace_flag",
)


def _empty_if_null(name: str, like: DataFrame) -> Column:
    kind = like.schema[name].dataType
    return F.coalesce(F.col(name), F.array().cast(kind))


def _pacing(gold: GoldTables, accounts: DataFrame, as_of: date, **options: bool) -> DataFrame:
    return pacing_for_review(budget_pacing(gold.budget, gold.daily, as_of, **options), accounts)


def review_facts(
    gold: GoldTables,
    period: Period,
    as_of: date,
    campaigns: DataFrame | None = None,
    **options: bool,
) -> DataFrame:
    """One row per account with all that the signals need, and the bounded lists."""
    accounts = period_kpis(_account_totals(gold.daily, period))
    if campaigns is None:
        campaigns = flagged_campaigns(gold, period)
    campaign_facts = _campaign_facts(campaigns)
    keywords = (
        top_keywords(gold.keywords, period)
        .groupBy("account_id")
        .agg(_ordered(*KEYWORD_FIELDS).alias("keywords_top"))
    )
    totals = search_term_totals(gold.search_terms, period)
    wasted = (
        _wasted(totals, TOP_SEARCH_TERMS)
        .groupBy("account_id")
        .agg(
            F.count("*").alias("wasted_count"),
            exact_sum("spend").alias("wasted_spend"),
            _ordered(*SEARCH_TERM_FIELDS).alias("wasted_terms"),
        )
    )
    winners = (
        _high_roas(totals, TOP_SEARCH_TERMS, MIN_ROAS)
        .groupBy("account_id")
        .agg(_ordered(*SEARCH_TERM_FIELDS).alias("high_roas_terms"))
    )
    facts = accounts
    for section in (
        campaign_facts,
        keywords,
        wasted,
        winners,
        negatives_total(gold.negatives),
        _pacing(gold, accounts, as_of, **options),
    ):
        facts = facts.join(section, "account_id", "left")
    counts = (
        "campaign_count",
        "zero_conversion_count",
        "uncovered_count",
        "wasted_count",
        "total_negatives",
    )
    lists = (
        "zero_conversion_names",
        "uncovered_names",
        "keywords_top",
        "wasted_terms",
        "high_roas_terms",
    )
    filled = {name: F.coalesce(F.col(name), F.lit(0)) for name in counts}
    filled |= {name: _empty_if_null(name, facts) for name in lists}
    return facts.withColumns(filled | {"wasted_spend": F.coalesce("wasted_spend", F.lit(0.0))})


def signals(
    gold: GoldTables,
    period: Period,
    as_of: date,
    campaigns: DataFrame | None = None,
    **options: bool,
) -> DataFrame:
    """Fired signals of every account, one per row."""
    return signal_rows(review_facts(gold, period, as_of, campaigns, **options))


def review_summary(gold: GoldTables, period: Period, as_of: date, **options: bool) -> DataFrame:
    """Flat review: figures, list sizes, list heads and fired codes per account."""
    facts = review_facts(gold, period, as_of, **options)
    head = F.get(F.col("keywords_top"), F.lit(0))
    return facts.select(
        "account_id",
        "account_name",
        "platform",
        F.lit(period.start).alias("period_start"),
        F.lit(period.end).alias("period_end"),
        *PERFORMANCE,
        "campaign_count",
        F.size("keywords_top").cast("bigint").alias("keyword_count"),
        head["keyword_text"].alias("top_keyword"),
        head["roas"].alias("top_keyword_roas"),
        "wasted_count",
        "wasted_spend",
        F.size("high_roas_terms").cast("bigint").alias("high_roas_count"),
        "total_negatives",
        "uncovered_count",
        *BUDGET_FIELDS,
        F.array_join(F.transform(evaluate_all(), lambda s: s["code"]), ",").alias("signal_codes"),
    )


def account_review(
    gold: GoldTables,
    period: Period,
    as_of: date,
    account: str | None = None,
    campaigns: DataFrame | None = None,
    **options: bool,
) -> DataFrame:
    """Nested review documents, one per account, of the bounded sections and all counts.

    The two lists without a bound are rows of their own for every account, however many
    it has: ``review_campaigns`` and ``review_uncovered``.
    """
    gold = gold.of_account(account)
    if campaigns is None:
        # read by four sections
        campaigns = staged(flagged_campaigns(gold, period), "campaigns")
    facts = review_facts(gold, period, as_of, for_account(campaigns, account), **options)
    return facts.select(
        F.struct("account_id", "account_name", "platform").alias("account"),
        F.struct(F.lit(period.start).alias("start"), F.lit(period.end).alias("end")).alias(
            "period"
        ),
        F.struct(*PERFORMANCE).alias("performance"),
        "campaign_count",
        "keywords_top",
        F.struct(
            F.col("wasted_terms").alias("top_by_spend_no_conv"),
            F.col("high_roas_terms").alias("high_roas"),
        ).alias("search_terms"),
        F.struct("total_negatives", "uncovered_count").alias("negatives"),
        F.struct(*BUDGET_FIELDS).alias("budget"),
        evaluate_all().alias("signals"),
    )


def review_campaigns(campaigns: DataFrame, account: str | None = None) -> DataFrame:
    """Campaign list of every account as rows, dearest first, of ``flagged_campaigns``."""
    rows = for_account(campaigns, account)
    order = [F.desc("spend"), F.asc("campaign_name")]
    return positions(rows, "account_id", order).select("account_id", "position", *CAMPAIGN_FIELDS)


def review_uncovered(campaigns: DataFrame, account: str | None = None) -> DataFrame:
    """Campaigns without negatives of every account as rows, by name, of ``flagged_campaigns``."""
    rows = for_account(campaigns, account).where("uncovered")
    numbered = positions(rows, "account_id", [F.asc("campaign_name")])
    return numbered.select("account_id", "position", "campaign_name")


def _pages(rows: DataFrame, section: str, fields: tuple[str, ...], size: int) -> DataFrame:
    """Entries of a list without a bound, in pages of at most ``size``."""
    entry = F.struct("position", F.struct(*fields).alias("row"))
    page = F.expr(f"(position - 1) div {size} + 1")
    paged = rows.groupBy("account_id", page.alias("page")).agg(F.array_sort(F.collect_list(entry)).alias("entries"))
    entries = F.transform("entries", lambda e: e["row"])
    line = F.struct("account_id", F.lit(section).alias("section"), "page", entries.alias("entries"))
    return paged.select(F.lit(section).alias("section"), F.to_json(line, JSON_OPTIONS).alias("value"))


def review_lines(documents: DataFrame, campaigns: DataFrame, size: int = PAGE_ENTRIES) -> DataFrame:
    """Whole reviews as JSON texts: a document per account and the pages of its long lists.

    documents: of ``account_review``. campaigns: of ``flagged_campaigns`` of the same tables and
    period. An account's lists may be of any length: no text holds more than ``size`` entries of
    one, and each names its account, section and page. An empty list has no page; the document
    has the number of entries of each list.
    """
    heads = documents.select(F.lit(DOCUMENT).alias("section"), F.to_json(F.struct(*documents.columns), JSON_OPTIONS).alias("value"))
    listed = _pages(review_campaigns(campaigns), CAMPAIGN_PAGES, CAMPAIGN_FIELDS, size)
    lacking = _pages(review_uncovered(campaigns), UNCOVERED_PAGES, ("campaign_name",), size)
    return heads.unionByName(listed).unionByName(lacking)


def page_schema(section: str) -> StructType:
    """Declared schema of the pages of a section."""
    kinds = {"spend": "double", "conversions": "double", "conversion_value": "double", "roas": "double"}
    fields = CAMPAIGN_FIELDS if section == CAMPAIGN_PAGES else ("campaign_name",)
    entry = record(**{name: kinds.get(name, "string") for name in fields})
    return record(account_id="string", section="string", page="long").add("entries", ArrayType(entry))


def page_entries(pages: DataFrame, size: int = PAGE_ENTRIES) -> DataFrame:
    """Entries of pages as rows again, with their positions in the whole list."""
    rows = pages.select("account_id", "page", F.posexplode("entries").alias("place", "entry"))
    position = (F.col("page") - 1) * size + F.col("place") + 1
    return rows.select("account_id", position.alias("position"), "entry.*")
