"""Landed platform reports: declared nested schemas, flattening and load stamps.

The report files hold what the ad platforms return: one nested record per row,
costs in millionths, enum names as text. Readers take JSON, CSV (with dotted
column names) or Parquet.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from adtide.functions.dates import Period
from adtide.functions.numeric import micros_to_currency
from adtide.functions.text import blank_nulls
from adtide.schemas import GOOGLE, META, record, texts
from adtide.sources.tables import indexed_files, staged

_ENTITY = record(id="long", name="string")
_ENTITY_WITH_STATUS = record(id="long", name="string", status="string")
_CUSTOMER = record(id="long", descriptive_name="string")
_KEYWORD = record(text="string", match_type="string")


def _metrics() -> StructType:
    return record(
        impressions="long",
        clicks="long",
        cost_micros="long",
        conversions="double",
        conversions_value="double",
    )


KEYWORD_REPORT = record(
    customer=_CUSTOMER,
    campaign=_ENTITY_WITH_STATUS,
    ad_group=_ENTITY_WITH_STATUS,
    ad_group_criterion=record(
        criterion_id="long",
        status="string",
        keyword=_KEYWORD,
        quality_info=record(quality_score="integer"),
    ),
    metrics=_metrics()
    .add("view_through_conversions", "double")
    .add("all_conversions", "double")
    .add("search_impression_share", "double"),
    segments=record(device="string", date="date"),
)

SEARCH_TERM_REPORT = record(
    customer=_CUSTOMER,
    campaign=_ENTITY,
    ad_group=_ENTITY,
    search_term_view=record(search_term="string", status="string"),
    metrics=_metrics(),
    segments=record(date="date", keyword=record(info=_KEYWORD)),
)

_CRITERION = record(
    criterion_id="long",
    type="string",
    negative="boolean",
    status="string",
    keyword=_KEYWORD,
)

CAMPAIGN_NEGATIVE_REPORT = record(
    customer=_CUSTOMER, campaign=_ENTITY, campaign_criterion=_CRITERION
)

AD_GROUP_NEGATIVE_REPORT = record(
    customer=_CUSTOMER, campaign=_ENTITY, ad_group=_ENTITY, ad_group_criterion=_CRITERION
)

META_INSIGHT_REPORT = record(
    **texts("account_id", "account_name", "campaign_id", "campaign_name", "ad_id", "ad_name"),
    **texts("impressions", "clicks", "spend"),
    date_start="date",
    date_stop="date",
    # kept as its own JSON text, whatever fields an action has
    actions="string",
    **texts("device_platform", "publisher_platform"),
)

GOOGLE_ACCOUNT_LIST = record(
    customer_client=record(id="long", status="string", manager="boolean", hidden="boolean")
)
META_ACCOUNT_LIST = record(account_id="string", account_status="integer")

REMOVED = "REMOVED"

#: Place of a row's file among the landed ones, where a reader adds it; flattening keeps it.
LANDED = "_landed"


def _leaves(schema: StructType, prefix: str = "") -> list[tuple[str, str]]:
    found: list[tuple[str, str]] = []
    for field in schema:
        name = prefix + field.name
        if isinstance(field.dataType, StructType):
            found += _leaves(field.dataType, name + ".")
        else:
            found.append((name, field.dataType.simpleString()))
    return found


def _nest(schema: StructType, prefix: str = "") -> list[Column]:
    columns = []
    for field in schema:
        name = prefix + field.name
        if isinstance(field.dataType, StructType):
            value = F.struct(*_nest(field.dataType, name + "."))
        else:
            value = F.col(f"`{name}`")
        columns.append(value.alias(field.name))
    return columns


def read_report(
    spark: SparkSession, path: str, schema: StructType, file_format: str = "json"
) -> DataFrame:
    """Report files with a declared schema; a malformed file fails the job."""
    if file_format == "csv":
        flat = ", ".join(f"`{name}` {kind}" for name, kind in _leaves(schema))
        rows = spark.read.schema(flat).option("mode", "FAILFAST").csv(path, header=True)
        return rows.select(*_nest(schema))
    reader = spark.read.schema(schema)
    if file_format == "json":
        reader = reader.option("mode", "FAILFAST")
    return reader.format(file_format).load(path)


def read_landed(
    spark: SparkSession, path: str, schema: StructType, account_as: str = "account_id"
) -> tuple[DataFrame, DataFrame]:
    """Report rows and the list of units of a landing folder ``date=…/account_id=…/*.json``.

    A unit with a malformed record is ``broken``: none of its rows is given and all other
    units are. A unit whose files hold no row is listed all the same.
    """
    keys = ["unit_date", "unit_account"]
    record_of, account = F.col("_corrupt"), F.regexp_extract(F.col("file"), "/account_id=([^/]+)/", 1)
    unit = [
        F.to_date(F.regexp_extract(F.col("file"), "/date=([^/]+)/", 1)).alias(keys[0]),
        # escaped once as a folder name and once as part of a path
        F.url_decode(F.url_decode(account)).alias(keys[1]),
    ]
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    reader = spark.read.options(recursiveFileLookup=True, **options)
    fields = StructType([*schema.fields, StructField("_corrupt", StringType())])
    rows = reader.schema(fields).json(path).withColumn("file", F.col("_metadata.file_path"))
    # parsed once: records and their faults are read from the written copy
    rows = staged(rows.select(*schema.fieldNames(), "_corrupt", *unit), "landed")
    broken = rows.where(record_of.isNotNull()).select(*keys).distinct()
    # a scan leaves out files without content, so the names come from the index behind it
    units = indexed_files(spark, path).select(*unit).distinct()
    marked = units.join(broken.withColumn("broken", F.lit(True)), keys, "left").select(
        F.col(keys[0]).alias("date"),
        F.col(keys[1]).alias(account_as),
        F.coalesce("broken", F.lit(False)).alias("broken"),
    )
    return rows.join(broken, keys, "left_anti").select(*schema.fieldNames()), marked


def _on_days(df: DataFrame, column: str, dates: Period | None) -> DataFrame:
    if dates is None:
        return df
    return df.where(F.col(column).between(F.lit(dates.start), F.lit(dates.end)))


def _id(path: str) -> Column:
    return F.col(path).cast("string")


def _landed(report: DataFrame) -> list[str]:
    return [LANDED] if LANDED in report.columns else []


def flatten_keyword(report: DataFrame) -> DataFrame:
    """Nested keyword report to raw-table columns; removed keywords are left out."""
    return report.where(F.col("ad_group_criterion.status") != REMOVED).select(
        _id("customer.id").alias("customer_id"),
        F.col("customer.descriptive_name").alias("customer_name"),
        _id("campaign.id").alias("campaign_id"),
        F.col("campaign.name").alias("campaign_name"),
        F.col("campaign.status").alias("campaign_status"),
        _id("ad_group.id").alias("ad_group_id"),
        F.col("ad_group.name").alias("ad_group_name"),
        F.col("ad_group.status").alias("ad_group_status"),
        _id("ad_group_criterion.criterion_id").alias("keyword_id"),
        F.col("ad_group_criterion.status").alias("criterion_status"),
        F.col("ad_group_criterion.keyword.text").alias("keyword_text"),
        F.col("ad_group_criterion.keyword.match_type").alias("match_type"),
        "metrics.impressions",
        "metrics.clicks",
        micros_to_currency("metrics.cost_micros").alias("spend"),
        "metrics.conversions",
        F.col("metrics.conversions_value").alias("conversion_value"),
        "metrics.view_through_conversions",
        "metrics.all_conversions",
        "metrics.search_impression_share",
        "ad_group_criterion.quality_info.quality_score",
        "segments.device",
        "segments.date",
        *_landed(report),
    )


def flatten_search_term(report: DataFrame) -> DataFrame:
    """Nested search-term report to raw-table columns, key texts never NULL."""
    rows = report.select(
        _id("customer.id").alias("customer_id"),
        F.col("customer.descriptive_name").alias("customer_name"),
        _id("campaign.id").alias("campaign_id"),
        F.col("campaign.name").alias("campaign_name"),
        _id("ad_group.id").alias("ad_group_id"),
        F.col("ad_group.name").alias("ad_group_name"),
        "search_term_view.search_term",
        F.col("search_term_view.status").alias("search_term_status"),
        F.col("segments.keyword.info.text").alias("matched_keyword_text"),
        F.col("segments.keyword.info.match_type").alias("matched_keyword_match_type"),
        "metrics.impressions",
        "metrics.clicks",
        micros_to_currency("metrics.cost_micros").alias("spend"),
        "metrics.conversions",
        F.col("metrics.conversions_value").alias("conversion_value"),
        "segments.date",
        *_landed(report),
    )
    return blank_nulls(rows, ["matched_keyword_text", "matched_keyword_match_type"])


def stamp_negatives(report: DataFrame, scope: str, snapshot_date: date) -> DataFrame:
    """Nested negative-keyword report to raw-table columns of one snapshot day."""
    if scope == "campaign":
        criterion, ad_group_id, ad_group_name = "campaign_criterion", F.lit(""), F.lit("")
    elif scope == "ad_group":
        criterion = "ad_group_criterion"
        ad_group_id, ad_group_name = _id("ad_group.id"), F.col("ad_group.name")
    else:
        raise ValueError(f"unknown scope {scope!r}")
    return report.select(
        _id("customer.id").alias("customer_id"),
        _id("campaign.id").alias("campaign_id"),
        F.col("campaign.name").alias("campaign_name"),
        ad_group_id.alias("ad_group_id"),
        ad_group_name.alias("ad_group_name"),
        _id(f"{criterion}.criterion_id").alias("criterion_id"),
        F.col(f"{criterion}.keyword.text").alias("criterion_text"),
        F.col(f"{criterion}.keyword.match_type").alias("match_type"),
        F.lit(scope).alias("scope"),
        F.lit(snapshot_date).alias("snapshot_date"),
        *_landed(report),
    )


def campaign_negatives(report: DataFrame, snapshot_date: date) -> DataFrame:
    criterion = "campaign_criterion"
    kept = report.where((F.col(f"{criterion}.type") == "KEYWORD") & F.col(f"{criterion}.negative"))
    return stamp_negatives(kept, "campaign", snapshot_date)


def ad_group_negatives(report: DataFrame, snapshot_date: date) -> DataFrame:
    criterion = "ad_group_criterion"
    kept = report.where(
        (F.col(f"{criterion}.type") == "KEYWORD")
        & F.col(f"{criterion}.negative")
        & (F.col(f"{criterion}.status") != REMOVED)
    )
    return stamp_negatives(kept, "ad_group", snapshot_date)


def all_negatives(campaign: DataFrame, ad_group: DataFrame) -> DataFrame:
    """Negatives of both scopes as one snapshot."""
    return campaign.unionByName(ad_group)


def conform_meta(report: DataFrame) -> DataFrame:
    """Ad insights to raw-table columns: absent text is ``''``, absent figures zero."""
    texts = [
        "account_id",
        "account_name",
        "campaign_id",
        "campaign_name",
        "ad_id",
        "ad_name",
        "device_platform",
        "publisher_platform",
    ]
    return blank_nulls(report, texts).withColumns(
        {
            "impressions": F.coalesce(F.col("impressions").cast("bigint"), F.lit(0)),
            "clicks": F.coalesce(F.col("clicks").cast("bigint"), F.lit(0)),
            "spend": F.coalesce(F.col("spend").cast("double"), F.lit(0.0)),
            "actions": F.coalesce("actions", F.lit("[]")),
        }
    )


def read_keyword_report(
    spark: SparkSession, path: str, dates: Period | None = None, file_format: str = "json"
) -> DataFrame:
    report = read_report(spark, path, KEYWORD_REPORT, file_format)
    return flatten_keyword(_on_days(report, "segments.date", dates))


def read_search_term_report(
    spark: SparkSession, path: str, dates: Period | None = None, file_format: str = "json"
) -> DataFrame:
    report = read_report(spark, path, SEARCH_TERM_REPORT, file_format)
    return flatten_search_term(_on_days(report, "segments.date", dates))


def read_campaign_negatives(
    spark: SparkSession, path: str, snapshot_date: date, file_format: str = "json"
) -> DataFrame:
    report = read_report(spark, path, CAMPAIGN_NEGATIVE_REPORT, file_format)
    return campaign_negatives(report, snapshot_date)


def read_ad_group_negatives(
    spark: SparkSession, path: str, snapshot_date: date, file_format: str = "json"
) -> DataFrame:
    report = read_report(spark, path, AD_GROUP_NEGATIVE_REPORT, file_format)
    return ad_group_negatives(report, snapshot_date)


def read_meta_insights(
    spark: SparkSession, path: str, dates: Period | None = None, file_format: str = "json"
) -> DataFrame:
    """Ad insights by device and placement. Nested actions exclude CSV."""
    report = read_report(spark, path, META_INSIGHT_REPORT, file_format)
    return conform_meta(_on_days(report, "date_start", dates))


def list_accounts(accounts: DataFrame, platform: str) -> DataFrame:
    """Accounts to load: enabled, visible client accounts or active ad accounts."""
    if platform == GOOGLE:
        client = "customer_client"
        return accounts.where(
            (F.col(f"{client}.status") == "ENABLED")
            & ~F.col(f"{client}.manager")
            & ~F.col(f"{client}.hidden")
        ).select(_id(f"{client}.id").alias("account_id"))
    if platform == META:
        return accounts.where(F.col("account_status") == 1).select("account_id")
    raise ValueError(f"unknown platform {platform!r}")


def stamp_load(df: DataFrame, at: datetime, source: str) -> DataFrame:
    """Load time, one value for the whole batch, and the name of the source."""
    return df.withColumns(
        {
            "_extracted_at": F.lit(at.isoformat(sep=" ")).cast("timestamp_ntz"),
            "_source": F.lit(source),
        }
    )
