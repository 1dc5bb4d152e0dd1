"""The registered queries: library functions applied to the given tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adtide.functions.dates import Period, with_periods
from adtide.functions.text import key_hash, normalize_account_id
from adtide.operators import quality, upsert
from adtide.operators.filters import in_range, non_empty
from adtide.operators.latest import bronze_dedup
from adtide.operators.ledger import resume_backfill
from adtide.plans import access, checks, gold, metrics, review, silver
from adtide.plans.review import GoldTables
from adtide.plans.transform import budget_pacing_view
from adtide.schemas import ACCOUNT_KEYS, CLIENT_BUDGET, GOOGLE, GOOGLE_ADS_RAW, GOOGLE_NEGATIVES_RAW, LOAD_LEDGER, META, record
from adtide.session import new_workspace
from adtide.sources import reports, testdata
from adtide.sources.growth import read_grown
from adtide.sources.tables import PLACEHOLDER, load_seed, materialize, read_review_lines, read_table, side_by_side, staged, write_review_lines
from adtide.streaming.landing import ingest_landed_reports

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = testdata.AS_OF
PERIOD = Period(date(2024, 1, 1), date(2024, 1, 20))
NEXT_MONTH = date(2024, 2, 10)
LOADED_AT = datetime(2024, 1, 20, 5, 0)
REREAD = ("daily", "keywords", "search_terms", "negatives")
LATE_BATCH = datetime(2000, 6, 1)
#: Records of a landed file: about 130 MB of JSON, 10 MB compressed.
LANDED_RECORDS = 250_000
SCANNED_DAYS = Period(date(1996, 1, 1), date(1998, 12, 31))


class Models:
    """Lazy models over one folder of given tables, each built when asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir
        self.lines: DataFrame | None = None

    def share_lines(self) -> None:
        """Write the joined order lines once, for a query whose models start from them several times."""
        lines = testdata.order_lines(self.spark, self.sf_dir).select(*testdata.LINE_COLUMNS)
        self.lines = staged(lines, "lines")

    def _raw(self, build: Callable[[SparkSession, str], DataFrame]) -> DataFrame:
        return build(self.spark, self.sf_dir)

    def google_raw(self) -> DataFrame:
        return testdata.google_ads_raw(self.spark, self.sf_dir, self.lines)

    def meta_raw(self) -> DataFrame:
        return self._raw(testdata.meta_ads_raw)

    def table(self, name: str) -> DataFrame:
        return testdata.table(self.spark, self.sf_dir, name)

    def google(self, include_ad_group: bool = False) -> DataFrame:
        return silver.silver_google_ads(
            self.google_raw(), testdata.google_ads_ties(), include_ad_group
        )

    def keywords(self) -> DataFrame:
        return silver.silver_keywords(self.google_raw(), testdata.google_ads_ties())

    def search_terms(self) -> DataFrame:
        raw = testdata.google_search_terms_raw(self.spark, self.sf_dir, self.lines)
        return silver.silver_search_terms(raw, testdata.search_term_ties())

    def negatives(self) -> DataFrame:
        return silver.silver_negatives(
            self._raw(testdata.google_negatives_raw), testdata.newest_seq()
        )

    def meta(self) -> DataFrame:
        return silver.silver_meta_ads(self.meta_raw(), testdata.newest_seq())

    def unified(self) -> DataFrame:
        return silver.unified_campaigns(self.meta(), self.google())

    def daily(self) -> DataFrame:
        return gold.daily_performance(self.unified())

    def gold_keywords(self) -> DataFrame:
        return gold.gold_keywords(self.keywords())

    def gold_search_terms(self) -> DataFrame:
        return gold.gold_search_terms(self.search_terms())

    def gold_negatives(self, per_account: bool = False) -> DataFrame:
        raw = self._raw(testdata.google_negatives_raw)
        days = non_empty(raw.withColumnsRenamed(silver.ACCOUNT_NAMES), "criterion_text")
        return gold.gold_negatives(self.negatives(), per_account, days_from=days)

    def budget(self) -> DataFrame:
        return self._raw(testdata.client_budget)

    def pacing(self, **options: bool) -> DataFrame:
        return gold.budget_pacing(self.budget(), self.daily(), AS_OF, **options)

    def gold_tables(self) -> GoldTables:
        return GoldTables(
            daily=self.daily(),
            keywords=self.gold_keywords(),
            search_terms=self.gold_search_terms(),
            negatives=self.gold_negatives(),
            budget=self.budget(),
        )

    def accounts(self) -> DataFrame:
        """Accounts to load, as the raw tables name them."""
        orders = self.table("orders")
        return orders.select((F.col("o_custkey") % 4).cast("string").alias("account_id")).distinct()


def _stored(frames: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Models that are read several times, as written tables."""
    writes = [partial(staged, df, name) for name, df in frames.items()]
    return dict(zip(frames, side_by_side(writes), strict=True))


def _review_inputs(m: Models, *reread: str) -> GoldTables:
    m.share_lines()
    inputs = review.review_inputs(m.gold_tables(), PERIOD)
    return inputs._replace(**_stored({name: getattr(inputs, name) for name in reread}))


def _signals(m: Models) -> DataFrame:
    # only these two are read several times; campaigns are far fewer than keywords
    inputs = _review_inputs(m)
    campaigns = review.flagged_campaigns(inputs, PERIOD)
    stored = _stored({"daily": inputs.daily, "campaigns": campaigns})
    inputs = inputs._replace(daily=stored["daily"])
    return review.signals(inputs, PERIOD, AS_OF, stored["campaigns"])


def _review(m: Models) -> DataFrame:
    return review.review_summary(_review_inputs(m, *REREAD), PERIOD, AS_OF)


def _bounded_entries(documents: DataFrame) -> DataFrame:
    """Every entry of the lists inside review documents, one per row."""

    def entries(section: str, name: Column, figure: Callable[[Column], Column], key: str) -> Column:
        return F.transform(
            name,
            lambda e, i: F.struct(
                F.lit(section).alias("section"),
                (i + 1).cast("bigint").alias("position"),
                e[key].alias("entry"),
                figure(e).alias("spend"),
            ),
        )

    def spend(e: Column) -> Column:
        return e["spend"]

    def none(_: Column) -> Column:
        return F.lit(None).cast("double")

    lists = F.concat(
        entries("keywords_top", F.col("keywords_top"), spend, "keyword_text"),
        entries("top_by_spend_no_conv", F.col("search_terms.top_by_spend_no_conv"), spend, "search_term"),
        entries("high_roas", F.col("search_terms.high_roas"), spend, "search_term"),
        entries("signals", F.col("signals"), none, "message"),
    )
    return documents.select(F.col("account.account_id"), F.inline(lists))


def _listed_entries(section: str, rows: DataFrame) -> DataFrame:
    """Entries of a campaign list as rows."""
    spend = F.col("spend") if "spend" in rows.columns else F.lit(None).cast("double")
    return rows.select(
        "account_id",
        F.lit(section).alias("section"),
        "position",
        F.col("campaign_name").alias("entry"),
        spend.alias("spend"),
    )


def _reviewed(m: Models) -> tuple[DataFrame, DataFrame]:
    """Review documents and the campaign rows of the same review."""
    inputs = _review_inputs(m, *REREAD)
    campaigns = staged(review.flagged_campaigns(inputs, PERIOD), "campaigns")
    return review.account_review(inputs, PERIOD, AS_OF, campaigns=campaigns), campaigns


def _document_entries(m: Models) -> DataFrame:
    """Every list entry of the nested review documents, one per row."""
    documents, campaigns = _reviewed(m)
    listed = _listed_entries(review.CAMPAIGN_PAGES, review.review_campaigns(campaigns))
    lacking = _listed_entries(review.UNCOVERED_PAGES, review.review_uncovered(campaigns))
    return _bounded_entries(documents).unionByName(listed).unionByName(lacking)


def _late(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Raw rows as an earlier state and a later batch, each with unique keys."""
    late = F.col("_extracted_at") >= F.lit(LATE_BATCH.isoformat(sep=" ")).cast("timestamp_ntz")
    ties = testdata.google_ads_ties()
    target = bronze_dedup(raw.where(~late), GOOGLE_ADS_RAW, ties)
    batch = bronze_dedup(raw.where(late), GOOGLE_ADS_RAW, ties)
    return target, batch


MERGED_COLUMNS = (
    "date",
    "customer_id",
    "campaign_id",
    "ad_group_id",
    "keyword_id",
    "device",
    "impressions",
    "clicks",
    "spend",
    "match_type",
    "_extracted_at",
)


def _merged(m: Models) -> DataFrame:
    target, batch = _late(m.google_raw())
    return upsert.merged(target, batch, GOOGLE_ADS_RAW.keys).select(*MERGED_COLUMNS)


def _merged_some_columns(m: Models) -> DataFrame:
    """The batch lacks two columns, whose stored values stay."""
    target, batch = _late(m.google_raw())
    batch = batch.drop("match_type", "clicks")
    return upsert.merged(target, batch, GOOGLE_ADS_RAW.keys).select(*MERGED_COLUMNS)


def _merge_table(m: Models) -> DataFrame:
    """Upsert into a stored, day-partitioned table and read it back."""
    root = new_workspace(m.spark, "merge")
    target, batch = _late(m.google_raw())
    columns = GOOGLE_ADS_RAW.schema.fieldNames()
    known = [name for name in columns if name in target.columns]
    stored = upsert.conform(target.select(*known), GOOGLE_ADS_RAW.schema)
    materialize(stored, root, "bronze", GOOGLE_ADS_RAW.name, GOOGLE_ADS_RAW.partition)
    upsert.merge_upsert(m.spark, root, GOOGLE_ADS_RAW, batch.select(*known))
    rows = read_table(m.spark, root, "bronze", GOOGLE_ADS_RAW.name, GOOGLE_ADS_RAW.schema)
    return rows.select(*MERGED_COLUMNS)


def _new_budgets(m: Models) -> tuple[DataFrame, DataFrame]:
    first = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    target = m.budget().withColumns({"created_at": first, "updated_at": first})
    slot = F.col("slot")
    new = (
        m.table("customer")
        .select((F.col("c_custkey") % 8).alias("slot"))
        .distinct()
        .select(
            slot.cast("string").alias("account_id"),
            F.lit(GOOGLE).alias("platform"),
            ((slot + 1) * 1000).cast("decimal(14,2)").alias("monthly_budget"),
        )
    )
    return target, new


def _plain_budget(rows: DataFrame) -> DataFrame:
    return rows.withColumn("monthly_budget", F.col("monthly_budget").cast("double"))


def _upsert_budget(m: Models) -> DataFrame:
    return _plain_budget(upsert.upsert_budget(*_new_budgets(m), LOADED_AT))


def _stored_ops(name: str, rows: DataFrame) -> upsert.OpsTable:
    table = upsert.OpsTable(new_workspace(rows.sparkSession, "ops"), "ops", name, rows.schema)
    table.replace(rows)
    return table


def _upsert_budget_table(m: Models) -> DataFrame:
    target, new = _new_budgets(m)
    table = _stored_ops("client_budget", upsert.conform(target, CLIENT_BUDGET))
    return _plain_budget(upsert.store_budgets(m.spark, table, new, LOADED_AT))


def _managed(m: Models) -> DataFrame:
    supplier = m.table("supplier")
    return supplier.select(
        (F.col("s_suppkey") % 500).cast("string").alias("account_id"),
        F.when(F.col("s_nationkey") % 2 == 0, GOOGLE).otherwise(META).alias("platform"),
        F.col("s_name").alias("account_name"),
        F.when(F.col("s_acctbal") > 0, 1).otherwise(0).cast("smallint").alias("enabled"),
    )


def _insert_if_absent(m: Models) -> DataFrame:
    accounts = _managed(m)
    target = accounts.where("enabled = 1")
    new = accounts.where("enabled = 0")
    return upsert.insert_if_absent(target, new, ACCOUNT_KEYS, [F.asc("account_name")])


def _insert_table(m: Models) -> DataFrame:
    """All accounts into a table that holds none yet."""
    accounts = _managed(m)
    table = _stored_ops("managed_accounts", accounts.limit(0))
    return upsert.store_if_absent(m.spark, table, accounts, ACCOUNT_KEYS, [F.asc("account_name")])


def _delete_table(m: Models) -> DataFrame:
    table = _stored_ops("managed_accounts", _managed(m))
    return upsert.delete_stored(m.spark, table, F.col("enabled") == 0)


def _nested_keywords(m: Models) -> DataFrame:
    """The order lines as a nested keyword report with costs in millionths."""
    lines, orders = m.table("lineitem"), m.table("orders")
    rows = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    status = F.when(F.col("l_returnflag") == "R", "REMOVED").otherwise("ENABLED")
    part, supplier = F.col("l_partkey"), F.col("l_suppkey")
    metrics_struct = F.struct(
        F.col("l_quantity").cast("bigint").alias("impressions"),
        F.col("l_linenumber").cast("bigint").alias("clicks"),
        F.round(F.col("l_extendedprice") * 1_000_000).cast("bigint").alias("cost_micros"),
        F.col("l_discount").alias("conversions"),
        F.col("l_tax").alias("conversions_value"),
        F.lit(0.0).alias("view_through_conversions"),
        F.col("l_tax").alias("all_conversions"),
        F.col("l_discount").alias("search_impression_share"),
    )
    criterion = F.struct(
        part.alias("criterion_id"),
        status.alias("status"),
        F.struct(
            F.concat(F.lit("kw "), part.cast("string")).alias("text"),
            F.lit("EXACT").alias("match_type"),
        ).alias("keyword"),
        F.struct((part % 10).cast("int").alias("quality_score")).alias("quality_info"),
    )
    return rows.select(
        F.struct(
            F.col("o_custkey").alias("id"),
            F.concat(F.lit("Account "), F.col("o_custkey").cast("string")).alias(
                "descriptive_name"
            ),
        ).alias("customer"),
        F.struct(
            supplier.alias("id"),
            F.concat(F.lit("Campaign "), supplier.cast("string")).alias("name"),
            F.col("l_linestatus").alias("status"),
        ).alias("campaign"),
        F.struct(
            F.col("l_linenumber").cast("bigint").alias("id"),
            F.lit("group").alias("name"),
            F.lit("ENABLED").alias("status"),
        ).alias("ad_group"),
        criterion.alias("ad_group_criterion"),
        metrics_struct.alias("metrics"),
        F.struct(F.lit("MOBILE").alias("device"), F.col("l_shipdate").cast("date").alias("date"))
        .alias("segments"),
    )


def _nested_search_terms(m: Models) -> DataFrame:
    lines, part = m.table("lineitem"), m.table("part")
    rows = lines.join(part, F.col("l_partkey") == F.col("p_partkey"))
    info = F.struct(
        F.when(F.col("p_size") % 3 != 0, F.col("p_brand")).alias("text"),
        F.when(F.col("p_size") % 2 != 0, F.lit("BROAD")).alias("match_type"),
    )
    return rows.select(
        F.struct(
            F.col("l_suppkey").alias("id"),
            F.lit("Account").alias("descriptive_name"),
        ).alias("customer"),
        F.struct(F.col("l_suppkey").alias("id"), F.lit("Campaign").alias("name")).alias(
            "campaign"
        ),
        F.struct(
            F.col("l_linenumber").cast("bigint").alias("id"), F.lit("group").alias("name")
        ).alias("ad_group"),
        F.struct(
            F.col("p_name").alias("search_term"), F.col("l_returnflag").alias("status")
        ).alias("search_term_view"),
        F.struct(
            F.col("l_quantity").cast("bigint").alias("impressions"),
            F.col("l_linenumber").cast("bigint").alias("clicks"),
            F.round(F.col("l_extendedprice") * 1_000_000).cast("bigint").alias("cost_micros"),
            F.col("l_discount").alias("conversions"),
            F.col("l_tax").alias("conversions_value"),
        ).alias("metrics"),
        F.struct(
            F.col("l_shipdate").cast("date").alias("date"),
            F.struct(info.alias("info")).alias("keyword"),
        ).alias("segments"),
    )


def _nested_negatives(m: Models, criterion: str) -> DataFrame:
    part = m.table("part")
    key = F.col("p_partkey")
    ad_group = F.struct(
        F.col("p_size").cast("bigint").alias("id"),
        F.concat(F.lit("AdGroup "), F.col("p_size").cast("string")).alias("name"),
    )
    return part.select(
        F.struct((key % 4).alias("id"), F.lit("Account").alias("descriptive_name")).alias(
            "customer"
        ),
        F.struct(
            (key % 3).alias("id"),
            F.concat(F.lit("Campaign "), (key % 3).cast("string")).alias("name"),
        ).alias("campaign"),
        ad_group.alias("ad_group"),
        F.struct(
            key.alias("criterion_id"),
            F.when(F.col("p_type") == "SMALL", "PLACEMENT").otherwise("KEYWORD").alias("type"),
            (F.col("p_size") % 2 == 0).alias("negative"),
            F.when(F.col("p_size") % 5 == 0, "REMOVED").otherwise("ENABLED").alias("status"),
            F.struct(F.col("p_name").alias("text"), F.lit("BROAD").alias("match_type")).alias(
                "keyword"
            ),
        ).alias(criterion),
    )


def _snapshot_negatives(m: Models) -> DataFrame:
    return reports.all_negatives(
        reports.campaign_negatives(_nested_negatives(m, "campaign_criterion"), AS_OF),
        reports.ad_group_negatives(_nested_negatives(m, "ad_group_criterion"), AS_OF),
    )


def _insight_rows(m: Models) -> DataFrame:
    """The events as ad insights with text figures and nested actions."""
    event, user = F.col("event_id"), F.col("user_id")
    # an action with more fields than the ones that are counted
    action = F.struct(
        F.col("event_type").alias("action_type"),
        (event % 7).cast("string").alias("value"),
        (event % 3).cast("string").alias("7d_click"),
    )
    return m.table("events").select(
        user.cast("string").alias("account_id"),
        F.when(user % 3 != 0, F.lit("Account")).alias("account_name"),
        (user % 12).cast("string").alias("campaign_id"),
        F.lit("Campaign").alias("campaign_name"),
        event.cast("string").alias("ad_id"),
        F.lit("Ad").alias("ad_name"),
        F.when(event % 5 != 0, (event % 500).cast("string")).alias("impressions"),
        F.when(event % 7 != 0, (event % 40).cast("string")).alias("clicks"),
        F.when(event % 11 != 0, F.col("value").cast("string")).alias("spend"),
        F.col("ts").cast("date").alias("date_start"),
        F.col("ts").cast("date").alias("date_stop"),
        F.when(F.col("event_type") != "error", F.to_json(F.array(action))).alias("actions"),
        F.lit("mobile").alias("device_platform"),
        F.when(event % 2 == 0, F.col("event_type")).alias("publisher_platform"),
    )


def _insights(m: Models) -> DataFrame:
    return reports.stamp_load(reports.conform_meta(_insight_rows(m)), LOADED_AT, META)


def _landed(m: Models, report: DataFrame, name: str) -> str:
    """A nested report as compressed JSON files, and their folder.

    Plain JSON repeats every field name in every record and took some thirty times the disk of the tables. A compressed
    file is read by one task, so that each holds a bounded number of records.
    """
    path = new_workspace(m.spark, name)
    report.write.option("maxRecordsPerFile", LANDED_RECORDS).json(path, compression="gzip")
    return path


def _scan_keywords(m: Models) -> DataFrame:
    return reports.read_keyword_report(m.spark, _landed(m, _nested_keywords(m), "keywords"))


def _scan_search_terms(m: Models) -> DataFrame:
    path = _landed(m, _nested_search_terms(m), "terms")
    return reports.read_search_term_report(m.spark, path, SCANNED_DAYS)


def _scan_negatives(m: Models) -> DataFrame:
    campaign = _landed(m, _nested_negatives(m, "campaign_criterion"), "campaign")
    ad_group = _landed(m, _nested_negatives(m, "ad_group_criterion"), "ad-group")
    return reports.all_negatives(
        reports.read_campaign_negatives(m.spark, campaign, AS_OF),
        reports.read_ad_group_negatives(m.spark, ad_group, AS_OF),
    )


def _scan_meta(m: Models) -> DataFrame:
    actions = "array<struct<action_type:string,value:string,`7d_click`:string>>"
    nested = _insight_rows(m).withColumn("actions", F.from_json("actions", actions))
    rows = reports.read_meta_insights(m.spark, _landed(m, nested, "insights"))
    return reports.stamp_load(rows, LOADED_AT, META)


def _snapshot_table(m: Models) -> DataFrame:
    """Today's negatives, stored twice as a rerun would."""
    root, rows = new_workspace(m.spark, "snapshot"), _snapshot_negatives(m)
    for _ in range(2):
        upsert.snapshot_load(m.spark, root, GOOGLE_NEGATIVES_RAW, rows.drop("snapshot_date"), LOADED_AT, GOOGLE)
    stored = read_table(m.spark, root, "bronze", GOOGLE_NEGATIVES_RAW.name, GOOGLE_NEGATIVES_RAW.schema)
    return stored.select(*rows.columns)


def _as_report(rows: DataFrame) -> DataFrame:
    """Raw keyword rows as the nested report they could have come from, with day and account."""

    def entity(id_column: str, name: str, status: str) -> Column:
        return F.struct(F.col(id_column).cast("long").alias("id"), F.col(name).alias("name"), F.col(status).alias("status"))

    criterion = F.struct(
        F.col("keyword_id").cast("long").alias("criterion_id"),
        F.col("criterion_status").alias("status"),
        F.struct(F.col("keyword_text").alias("text"), "match_type").alias("keyword"),
        F.struct("quality_score").alias("quality_info"),
    )
    figures = F.struct(
        "impressions",
        "clicks",
        F.round(F.col("spend") * 1_000_000).cast("bigint").alias("cost_micros"),
        "conversions",
        F.col("conversion_value").alias("conversions_value"),
        "view_through_conversions",
        "all_conversions",
        "search_impression_share",
    )
    return rows.select(
        F.struct(F.col("customer_id").cast("long").alias("id"), F.col("customer_name").alias("descriptive_name")).alias("customer"),
        entity("campaign_id", "campaign_name", "campaign_status").alias("campaign"),
        entity("ad_group_id", "ad_group_name", "ad_group_status").alias("ad_group"),
        criterion.alias("ad_group_criterion"),
        figures.alias("metrics"),
        F.struct("device", "date").alias("segments"),
        "date",
        F.col("customer_id").alias("account_id"),
    )


def _stream_restart(m: Models) -> DataFrame:
    """Reports landed and loaded by the stream, then later ones after a restart; equal to the batch upsert."""
    root, landing = new_workspace(m.spark, "stream"), new_workspace(m.spark, "landing")
    progress = new_workspace(m.spark, "progress")
    for part in _late(m.google_raw()):
        _as_report(part).drop("date", "account_id").write.mode("append").json(landing)
        ingest_landed_reports(
            m.spark, landing, progress, reports.KEYWORD_REPORT, reports.flatten_keyword, root, GOOGLE_ADS_RAW, GOOGLE,
            clock=lambda: LOADED_AT,
        )
    rows = read_table(m.spark, root, "bronze", GOOGLE_ADS_RAW.name, GOOGLE_ADS_RAW.schema)
    return rows.select(*[c for c in MERGED_COLUMNS if c != "_extracted_at"])


def _two_writers(m: Models) -> DataFrame:
    """The late batch in two halves, whose loads run at a time and touch the same days."""
    root = new_workspace(m.spark, "writers")
    target, batch = _late(m.google_raw())
    known = [name for name in GOOGLE_ADS_RAW.schema.fieldNames() if name in target.columns]
    upsert.merge_upsert(m.spark, root, GOOGLE_ADS_RAW, target.select(*known))
    half = F.pmod(F.xxhash64(*GOOGLE_ADS_RAW.keys), F.lit(2))
    batch = staged(batch.select(*known), "late")
    loads = [partial(upsert.merge_upsert, m.spark, root, GOOGLE_ADS_RAW, batch.where(half == i)) for i in range(2)]
    side_by_side(loads)
    rows = read_table(m.spark, root, "bronze", GOOGLE_ADS_RAW.name, GOOGLE_ADS_RAW.schema)
    return rows.select(*MERGED_COLUMNS)


def _append_table(m: Models) -> DataFrame:
    """Raw rows stored by loads without a conflict key, one after the other."""
    root, raw = new_workspace(m.spark, "append"), m.google_raw()
    late = F.col("_extracted_at") >= F.lit(LATE_BATCH.isoformat(sep=" ")).cast("timestamp_ntz")
    for part in (raw.where(~late), raw.where(late)):
        upsert.append_rows(root, GOOGLE_ADS_RAW, part.select(*[c for c in raw.columns if c != "_seq"]))
    rows = read_table(m.spark, root, "bronze", GOOGLE_ADS_RAW.name, GOOGLE_ADS_RAW.schema)
    return rows.select(*MERGED_COLUMNS)


def _seed_accounts(m: Models) -> DataFrame:
    """Accounts from a seed file with template rows, into a table that holds none yet."""
    path, accounts = new_workspace(m.spark, "seed"), m.table("supplier")
    name = F.when(F.col("s_nationkey") == 7, PLACEHOLDER).otherwise(F.col("s_suppkey").cast("string"))
    rows = accounts.select(
        name.alias("account_id"),
        F.when(F.col("s_nationkey") % 2 == 0, GOOGLE).otherwise(META).alias("platform"),
        F.col("s_name").alias("account_name"),
        (F.col("s_suppkey") % 2).cast("smallint").alias("enabled"),
    )
    rows.write.csv(path, header=True)
    fields = record(account_id="string", platform="string", account_name="string", enabled="short")
    table = _stored_ops("managed_accounts", rows.limit(0))
    return upsert.store_if_absent(m.spark, table, load_seed(m.spark, path, fields), ACCOUNT_KEYS)


LEFT_OUT = "date = DATE'2024-01-31' OR (date = DATE'2024-01-29' AND account_id = '1')"
STILL_BROKEN = "date = DATE'2024-01-30' AND account_id = '2'"
LOAD_DAYS = Period(date(2024, 1, 28), date(2024, 2, 2))


def _backfill_resume(m: Models) -> DataFrame:
    """Ledger after a load with missing and malformed units and a second one that resumes it."""
    root = new_workspace(m.spark, "resume")
    ledger = upsert.OpsTable(root, "ops", "load_ledger", LOAD_LEDGER)
    ledger.replace(m.spark.createDataFrame([], LOAD_LEDGER))
    rows = bronze_dedup(in_range(m.google_raw(), LOAD_DAYS), GOOGLE_ADS_RAW, testdata.google_ads_ties())
    rows = staged(rows.drop("_seq", "_extracted_at").withColumn("account_id", F.col("customer_id")), "rows")
    plan = staged(upsert.partition_plan(m.spark, LOAD_DAYS, m.accounts()), "plan")
    first = plan.where("date <> DATE'2024-01-31'").withColumn("broken", F.expr(f"({LEFT_OUT}) OR ({STILL_BROKEN})"))
    second = plan.withColumn("broken", F.expr(STILL_BROKEN))
    for hour, landed in enumerate((first, second)):
        whole = landed.where("NOT broken").select("date", "account_id")
        found = rows.join(whole, ["date", "account_id"], "left_semi").drop("account_id")
        resume_backfill(
            m.spark, root, ledger, GOOGLE_ADS_RAW, found, landed, plan, LOADED_AT.replace(hour=5 + hour), GOOGLE, "customer_id"
        )
    return ledger.read(m.spark).select("date", "account_id", "status", "rows", "attempts")


def _backfill_landed(m: Models) -> DataFrame:
    """Units of landed report files, one of them malformed and one missing, loaded in one job."""
    root, path = new_workspace(m.spark, "backfill"), new_workspace(m.spark, "landed")
    rows = bronze_dedup(in_range(m.google_raw(), LOAD_DAYS), GOOGLE_ADS_RAW, testdata.google_ads_ties())
    report = _as_report(rows).where(f"NOT ({STILL_BROKEN})")
    report.write.partitionBy("date", "account_id").json(path)
    unfinished = m.spark.range(1).select(F.lit('{"customer": {"id": ').alias("value"))
    unfinished.write.text(f"{path}/date=2024-01-29/account_id=1/late")
    found, landed = reports.read_landed(m.spark, path, reports.KEYWORD_REPORT)
    results = upsert.backfill(
        m.spark, root, GOOGLE_ADS_RAW, reports.flatten_keyword(found), LOAD_DAYS, m.accounts(), LOADED_AT, GOOGLE, "customer_id", landed
    )
    stored = read_table(m.spark, root, "bronze", GOOGLE_ADS_RAW.name, GOOGLE_ADS_RAW.schema)
    kept = stored.groupBy("date", F.col("customer_id").alias("account_id")).agg(F.count("*").alias("stored"))
    joined = staged(results, "results").join(kept, ["date", "account_id"], "left")
    return joined.select("date", "account_id", "rows", "status", F.coalesce("stored", F.lit(0)).alias("stored"))


ADDED_COLUMNS = ("campaign_status", "ad_group_status", "criterion_status", "conversion_value")


def _schema_growth(m: Models) -> DataFrame:
    """Days written under an earlier schema, with columns lacking and narrower clicks, read with later ones."""
    root, raw = new_workspace(m.spark, "growth"), m.google_raw().drop("_seq")
    early = F.col("date") < F.lit(date(2024, 1, 16))
    path = f"{root}/bronze/{GOOGLE_ADS_RAW.name}"
    old = raw.where(early).drop(*ADDED_COLUMNS).withColumn("clicks", F.col("clicks").cast("int"))
    for rows in (old, raw.where(~early)):
        rows.write.mode("append").partitionBy("date").parquet(path)
    grown = read_grown(m.spark, root, "bronze", GOOGLE_ADS_RAW.name, GOOGLE_ADS_RAW.schema)
    return grown.select("date", "customer_id", "keyword_id", "device", "clicks", "spend", *ADDED_COLUMNS, "_source")


def _refused_rows(m: Models) -> DataFrame:
    """Raw rows that break a constraint, with the constraints they break."""
    constraints = [
        *quality.not_null("clicks", "keyword_text"),
        *quality.accepted_values("campaign_status", ["ENABLED", "PAUSED"]),
        *quality.expression_is_true("spend", F.col("spend") > 0),
    ]
    refused = quality.split_refused(m.google_raw(), constraints).refused
    return refused.select("_seq", "date", "customer_id", "keyword_id", "spend", F.array_join("reasons", ",").alias("reasons"))


def _resolved_periods(m: Models) -> DataFrame:
    """Review and load periods of the orders' days, whose given texts are of all kinds."""
    key, day = F.col("o_orderkey"), F.col("o_orderdate").cast("date")
    start = (
        F.when(key % 7 == 0, F.lit(None).cast("string"))
        .when(key % 7 == 1, "")
        .when(key % 7 == 2, "not a day")
        .otherwise(F.date_sub(day, (key % 40).cast("int")).cast("string"))
    )
    end = (
        F.when(key % 5 == 0, F.lit(None).cast("string"))
        .when(key % 5 == 1, "")
        .otherwise(F.date_sub(day, (key % 30).cast("int")).cast("string"))
    )
    rows = m.table("orders").select("o_orderkey", day.alias("as_of"), start.alias("start_date"), end.alias("end_date"))
    return with_periods(rows).select(
        "o_orderkey",
        *[F.col(f"{p}.{f}").alias(f"{p}_{f}") for p in ("review", "load") for f in ("start", "end", "problem")],
    )


def _signals_under_pace(m: Models) -> DataFrame:
    """Signals under budgets that are a hundred times as large, which spend falls short of."""
    inputs = _review_inputs(m, "daily")
    larger = (F.col("monthly_budget") * 100).cast("decimal(14,2)")
    inputs = inputs._replace(budget=inputs.budget.withColumn("monthly_budget", larger))
    return review.signals(inputs, PERIOD, AS_OF)


def _dedup_table(m: Models) -> DataFrame:
    """Stored raw rows with keys several times, of which only the touched days are rewritten."""
    root = new_workspace(m.spark, "dedup")
    stored = upsert.conform(m.google_raw(), GOOGLE_ADS_RAW.schema)
    materialize(stored, root, "bronze", GOOGLE_ADS_RAW.name, GOOGLE_ADS_RAW.partition)
    # the order of arrival is no column of the table
    upsert.dedup_stored(m.spark, root, GOOGLE_ADS_RAW, testdata.google_ads_ties()[1:])
    rows = read_table(m.spark, root, "bronze", GOOGLE_ADS_RAW.name, GOOGLE_ADS_RAW.schema)
    return rows.select(*MERGED_COLUMNS)


def _pacing_view(m: Models) -> DataFrame:
    root = new_workspace(m.spark, "view")
    materialize(m.daily(), root, "gold", "daily_performance", "date")
    materialize(upsert.conform(m.budget(), CLIENT_BUDGET), root, "ops", "client_budget")
    budget_pacing_view(m.spark, root, AS_OF, "registered_pacing")
    return m.spark.table("registered_pacing")


def _written_reviews(m: Models, size: int = review.PAGE_ENTRIES) -> tuple[str, DataFrame]:
    """Folder of written reviews and their documents as read back."""
    documents, campaigns = _reviewed(m)
    path = new_workspace(m.spark, "reviews")
    write_review_lines(review.review_lines(documents, campaigns, size), path)
    return path, read_review_lines(m.spark, path, review.DOCUMENT, documents.schema)


def _review_json(m: Models) -> DataFrame:
    """Every list entry of whole reviews written as JSON lines, with pages of two entries, and read back."""
    size = 2
    path, documents = _written_reviews(m, size)
    rows = _bounded_entries(documents)
    for section in (review.CAMPAIGN_PAGES, review.UNCOVERED_PAGES):
        pages = read_review_lines(m.spark, path, section, review.page_schema(section))
        rows = rows.unionByName(_listed_entries(section, review.page_entries(pages, size)))
    return rows


def _review_json_heads(m: Models) -> DataFrame:
    _, documents = _written_reviews(m)
    return documents.select("account.account_id", "campaign_count", F.array_join("signals.code", ",").alias("signal_codes"))


def _google_accounts(m: Models) -> DataFrame:
    supplier = m.table("supplier")
    client = F.struct(
        F.col("s_suppkey").alias("id"),
        F.when(F.col("s_acctbal") > 0, "ENABLED").otherwise("CANCELED").alias("status"),
        (F.col("s_nationkey") == 3).alias("manager"),
        (F.col("s_nationkey") == 5).alias("hidden"),
    )
    return reports.list_accounts(supplier.select(client.alias("customer_client")), GOOGLE)


def _meta_accounts(m: Models) -> DataFrame:
    customer = m.table("customer")
    listed = customer.select(
        F.col("c_custkey").cast("string").alias("account_id"),
        F.when(F.col("c_mktsegment") == "HOUSEHOLD", 2).otherwise(1).alias("account_status"),
    )
    return reports.list_accounts(listed, META)


def _normalized(m: Models) -> DataFrame:
    key = F.col("s_suppkey").cast("string")
    given = F.when(F.col("s_nationkey") % 2 == 0, key).otherwise(F.concat(F.lit("act_"), key))
    rows = m.table("supplier").select("s_suppkey", given.alias("account_id"))
    return rows.withColumn("account_id", normalize_account_id(F.col("account_id")))


def _load_plan(m: Models) -> tuple[DataFrame, DataFrame]:
    period = Period(date(2024, 1, 28), date(2024, 2, 2))
    plan = upsert.partition_plan(m.spark, period, m.accounts())
    loaded = in_range(m.google_raw(), period).select("date", F.col("customer_id").alias("account_id"))
    return plan, loaded


def _missing(m: Models) -> DataFrame:
    return upsert.missing_partitions(*_load_plan(m))


def _load_report(m: Models) -> DataFrame:
    """One day whose files never came, one unit with a malformed file, and days without activity."""
    plan, loaded = _load_plan(m)
    malformed = F.expr("date = DATE'2024-01-29' AND account_id = '1'")
    landed = plan.where("date <> DATE'2024-01-31'").withColumn("broken", malformed)
    results = staged(upsert.load_results(plan, loaded, landed), "results")
    return upsert.load_report(results, GOOGLE)


def _load_results(m: Models) -> DataFrame:
    plan, loaded = _load_plan(m)
    return upsert.load_results(plan, loaded, plan.withColumn("broken", F.lit(False)))


def _users(m: Models) -> DataFrame:
    disabled = F.lit("2024-01-10 00:00:00").cast("timestamp_ntz")
    return m.table("customer").select(
        F.col("c_custkey").cast("int").alias("id"),
        F.concat(F.lower("c_name"), F.lit("@example.com")).alias("email"),
        F.col("c_name").alias("name"),
        F.when(F.col("c_nationkey") % 5 == 0, "admin").otherwise("user").alias("role"),
        F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("created_at"),
        F.when(F.col("c_acctbal") < 0, disabled).alias("disabled_at"),
    )


def _keys(m: Models) -> DataFrame:
    order = F.col("o_orderkey")
    used = F.lit("2023-12-22 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(
        (order % 30).cast("int"), (order % 24).cast("int")
    )
    return m.table("orders").select(
        order.cast("int").alias("id"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_custkey").cast("int")).alias(
            "user_id"
        ),
        F.when(F.col("o_orderstatus") != "P", used).alias("last_used_at"),
        F.when(F.col("o_totalprice") > 400_000, F.col("o_orderdate")).alias("revoked_at"),
    )


def _key_status(m: Models) -> DataFrame:
    return access.api_key_status(_keys(m), _users(m), LOADED_AT)


def _hashes(m: Models) -> DataFrame:
    key = F.concat(F.lit("key-"), F.col("c_custkey").cast("string"))
    return m.table("customer").select("c_custkey", key_hash(key, "pepper").alias("key_hash"))


def _dq_not_null(m: Models) -> DataFrame:
    columns = ["customer_id", "keyword_text", "clicks", "conversion_value", "date"]
    return quality.dq_not_null(m.google_raw(), "bronze.google_ads_raw", columns)


def _dq_accepted(m: Models) -> DataFrame:
    return quality.dq_accepted_values(
        m.google_raw(), "bronze.google_ads_raw", "campaign_status", ["ENABLED", "PAUSED"]
    )


def _dq_unique(m: Models) -> DataFrame:
    name = "gold.google_ads_keywords"
    return quality.dq_unique(m.gold_keywords(), name, checks.UNIQUE_KEYS[name])


def _dq_expression(m: Models) -> DataFrame:
    positive = F.col("spend") > 0
    return quality.dq_expression(m.google_raw(), "bronze.google_ads_raw", "spend", positive)


def _checked(models: dict[str, DataFrame]) -> DataFrame:
    needed = {name: df.select(*checks.checked_columns(name)) for name, df in models.items()}
    return checks.check_models(needed)


def _dq_gold(m: Models) -> DataFrame:
    m.share_lines()
    # the unified campaigns are below three of the models
    unified = staged(m.unified(), "unified")
    daily = gold.daily_performance(unified)
    return _checked(
        {
            "gold.daily_performance": daily,
            "gold.weekly_performance": gold.weekly_performance(unified),
            "gold.google_ads_keywords": m.gold_keywords(),
            "gold.google_search_terms": m.gold_search_terms(),
            "gold.google_negatives": m.gold_negatives(),
            "gold.budget_pacing": gold.budget_pacing(m.budget(), daily, AS_OF),
        }
    )


def _dq_silver(m: Models) -> DataFrame:
    m.share_lines()
    meta, google = m.meta(), m.google()
    return _checked(
        {
            "silver.google_ads": google,
            "silver.meta_ads": meta,
            "silver.unified_campaigns": silver.unified_campaigns(meta, google),
            "silver.google_ads_keywords_dedup": m.keywords(),
            "silver.google_search_terms_dedup": m.search_terms(),
            "silver.google_negatives_dedup": m.negatives(),
        }
    )


def _dq_ops(m: Models) -> DataFrame:
    return _checked(
        {
            "ops.client_budget": m.budget(),
            "ops.managed_accounts": _managed(m),
            "users.app_users": _users(m),
        }
    )


def _clients(m: Models) -> DataFrame:
    rows = metrics.clients(m.daily())
    return rows.withColumn("platforms", F.array_join("platforms", ","))


def _coverage(m: Models) -> DataFrame:
    daily, keywords = m.daily(), m.gold_keywords()
    accounts = review.account_overview(daily)
    return review.negatives_coverage(m.gold_negatives(), keywords, accounts, PERIOD)


def _review_pacing(m: Models) -> DataFrame:
    daily = staged(m.daily(), "daily")
    pacing = gold.budget_pacing(m.budget(), daily, AS_OF)
    return review.pacing_for_review(pacing, review.account_overview(daily))


def _window(window: str, platform: str, as_of: date) -> Callable[[Models], DataFrame]:
    return lambda m: metrics.daily_window(m.daily(), platform, window, as_of)


RUNS: dict[str, Callable[[Models], DataFrame]] = {
    "silver_google_ads": lambda m: m.google(),
    "silver_google_ads_by_ad_group": lambda m: m.google(include_ad_group=True),
    "silver_keywords": lambda m: m.keywords(),
    "silver_search_terms": lambda m: m.search_terms(),
    "silver_negatives": lambda m: m.negatives(),
    "silver_meta_ads": lambda m: m.meta(),
    "unified_campaigns": lambda m: m.unified(),
    "daily_performance": lambda m: m.daily(),
    "weekly_performance": lambda m: gold.weekly_performance(m.unified()),
    "gold_keywords": lambda m: m.gold_keywords(),
    "gold_search_terms": lambda m: m.gold_search_terms(),
    "gold_negatives": lambda m: m.gold_negatives(),
    "gold_negatives_per_account": lambda m: m.gold_negatives(per_account=True),
    "spend_mtd": lambda m: gold.spend_mtd(m.daily(), AS_OF),
    "budget_pacing": lambda m: m.pacing(),
    "budget_pacing_to_date": lambda m: m.pacing(cap_at_as_of=True),
    "daily_range": lambda m: metrics.daily_range(m.daily(), GOOGLE, PERIOD),
    "daily_range_one_account": lambda m: metrics.daily_range(m.daily(), META, PERIOD, "2"),
    "daily_yesterday": _window("yesterday", GOOGLE, AS_OF),
    "daily_lastweek": _window("lastweek", META, AS_OF),
    "daily_lastmonth": _window("lastmonth", GOOGLE, NEXT_MONTH),
    "keywords_range": lambda m: metrics.keywords_range(m.gold_keywords(), PERIOD),
    "clients": _clients,
    "budgets": lambda m: metrics.budgets(m.budget()),
    "account_overview": lambda m: review.account_overview(m.daily()),
    "account_performance": lambda m: review.account_performance(m.daily(), PERIOD),
    "campaign_rows": lambda m: review.campaign_rows(m.gold_keywords(), PERIOD),
    "top_keywords": lambda m: review.top_keywords(m.gold_keywords(), PERIOD),
    "wasted_search_terms": lambda m: review.wasted_search_terms(m.gold_search_terms(), PERIOD),
    "high_roas_search_terms": lambda m: review.high_roas_search_terms(
        m.gold_search_terms(), PERIOD
    ),
    "search_term_buckets": lambda m: review.search_term_buckets(m.gold_search_terms(), PERIOD),
    "negatives_total": lambda m: review.negatives_total(m.gold_negatives()),
    "campaigns_without_negatives": lambda m: review.campaigns_without_negatives(
        m.gold_keywords(), m.gold_negatives(), PERIOD
    ),
    "negatives_coverage": _coverage,
    "review_pacing": _review_pacing,
    "signals": _signals,
    "account_review": _review,
    "account_review_documents": _document_entries,
    "merge_upsert": _merged,
    "merge_upsert_some_columns": _merged_some_columns,
    "merge_upsert_table": _merge_table,
    "upsert_budget": _upsert_budget,
    "insert_if_absent": _insert_if_absent,
    "upsert_budget_table": _upsert_budget_table,
    "insert_if_absent_table": _insert_table,
    "delete_where_table": _delete_table,
    "delete_where": lambda m: upsert.delete_where(_managed(m), F.col("enabled") == 0),
    "bronze_dedup": lambda m: bronze_dedup(
        m.google_raw(), GOOGLE_ADS_RAW, testdata.google_ads_ties()
    ).select(*MERGED_COLUMNS),
    "backfill_plan": lambda m: upsert.partition_plan(m.spark, PERIOD, m.accounts()),
    "missing_partitions": _missing,
    "load_report": _load_report,
    "load_results": _load_results,
    "micros_and_flatten": lambda m: reports.flatten_keyword(_nested_keywords(m)),
    "flatten_search_terms": lambda m: reports.flatten_search_term(_nested_search_terms(m)),
    "snapshot_negatives": _snapshot_negatives,
    "conform_meta": _insights,
    "scan_keyword_report": _scan_keywords,
    "scan_search_term_report": _scan_search_terms,
    "scan_negative_reports": _scan_negatives,
    "scan_meta_insights": _scan_meta,
    "snapshot_load_table": _snapshot_table,
    "bronze_dedup_table": _dedup_table,
    "budget_pacing_view": _pacing_view,
    "review_json": _review_json,
    "review_json_heads": _review_json_heads,
    "list_google_accounts": _google_accounts,
    "list_meta_accounts": _meta_accounts,
    "normalize_accounts": _normalized,
    "dq_not_null": _dq_not_null,
    "dq_accepted_values": _dq_accepted,
    "dq_unique": _dq_unique,
    "dq_expression": _dq_expression,
    "dq_gold_models": _dq_gold,
    "dq_silver_models": _dq_silver,
    "dq_ops_tables": _dq_ops,
    "api_key_status": _key_status,
    "key_hashes": _hashes,
    "live_key_status": lambda m: access.live_key_status(_keys(m), _users(m), LOADED_AT),
    "stream_restart": _stream_restart,
    "merge_upsert_two_writers": _two_writers,
    "append_table": _append_table,
    "seed_accounts": _seed_accounts,
    "backfill_resume": _backfill_resume,
    "backfill_landed": _backfill_landed,
    "schema_growth": _schema_growth,
    "refused_rows": _refused_rows,
    "resolved_periods": _resolved_periods,
    "signals_under_pace": _signals_under_pace,
    "list_users": lambda m: access.list_users(_users(m)),
}


def _registered(run: Callable[[Models], DataFrame]) -> Query:
    return lambda spark, sf_dir: run(Models(spark, sf_dir))


QUERIES: dict[str, Query] = {name: _registered(run) for name, run in RUNS.items()}
