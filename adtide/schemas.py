"""Declared schemas, natural keys and allowed values. Nothing is inferred."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql.types import DataType, StructType

GOOGLE = "google_ads"
META = "meta_ads"

# Allowed texts of the coded columns.
PLATFORMS = (GOOGLE, META)
SCOPES = ("campaign", "ad_group")
PACE_FLAGS = ("over", "under", "on_track", "unknown")
ROLES = ("admin", "user")


def record(**fields: str | DataType) -> StructType:
    """Struct type from field names and simple type names or nested types."""
    kind = StructType()
    for name, field in fields.items():
        kind = kind.add(name, field)
    return kind


def texts(*names: str) -> dict[str, str]:
    return dict.fromkeys(names, "string")


class BronzeTable(NamedTuple):
    """Raw table: columns, natural key and the key column it is partitioned by."""

    name: str
    schema: StructType
    keys: tuple[str, ...]
    partition: str


def _bronze(name: str, payload: StructType, keys: tuple[str, ...], partition: str) -> BronzeTable:
    """A raw table: the payload followed by the load time and the source name."""
    schema = payload.add("_extracted_at", "timestamp_ntz").add("_source", "string")
    return BronzeTable(name, schema, keys, partition)


META_ADS_RAW = _bronze(
    "meta_ads_raw",
    record(
        **texts("account_id", "account_name", "campaign_id", "campaign_name", "ad_id", "ad_name"),
        impressions="long",
        clicks="long",
        spend="double",
        date_start="date",
        date_stop="date",
        **texts("actions", "device_platform", "publisher_platform"),
    ),
    ("date_start", "account_id", "ad_id", "device_platform", "publisher_platform"),
    "date_start",
)

GOOGLE_ADS_RAW = _bronze(
    "google_ads_raw",
    record(
        **texts(
            "customer_id",
            "customer_name",
            "campaign_id",
            "campaign_name",
            "campaign_status",
            "ad_group_id",
            "ad_group_name",
            "ad_group_status",
            "keyword_id",
            "criterion_status",
            "keyword_text",
            "match_type",
        ),
        impressions="long",
        clicks="long",
        spend="double",
        conversions="double",
        conversion_value="double",
        view_through_conversions="double",
        all_conversions="double",
        search_impression_share="double",
        quality_score="integer",
        device="string",
        date="date",
    ),
    ("date", "customer_id", "campaign_id", "ad_group_id", "keyword_id", "device"),
    "date",
)

GOOGLE_SEARCH_TERMS_RAW = _bronze(
    "google_search_terms_raw",
    record(
        **texts(
            "customer_id",
            "customer_name",
            "campaign_id",
            "campaign_name",
            "ad_group_id",
            "ad_group_name",
            "search_term",
            "search_term_status",
            "matched_keyword_text",
            "matched_keyword_match_type",
        ),
        impressions="long",
        clicks="long",
        spend="double",
        conversions="double",
        conversion_value="double",
        date="date",
    ),
    (
        "date",
        "customer_id",
        "ad_group_id",
        "search_term",
        "matched_keyword_text",
        "matched_keyword_match_type",
    ),
    "date",
)

GOOGLE_NEGATIVES_RAW = _bronze(
    "google_negatives_raw",
    record(
        **texts(
            "customer_id",
            "campaign_id",
            "campaign_name",
            "ad_group_id",
            "ad_group_name",
            "criterion_id",
            "criterion_text",
            "match_type",
            "scope",
        ),
        snapshot_date="date",
    ),
    ("snapshot_date", "customer_id", "scope", "criterion_id", "ad_group_id", "campaign_id"),
    "snapshot_date",
)

BRONZE = {
    table.name: table
    for table in (META_ADS_RAW, GOOGLE_ADS_RAW, GOOGLE_SEARCH_TERMS_RAW, GOOGLE_NEGATIVES_RAW)
}

CLIENT_BUDGET = record(
    **texts("account_id", "platform"),
    monthly_budget="decimal(14,2)",
    currency="string",
    active="boolean",
    created_at="timestamp_ntz",
    updated_at="timestamp_ntz",
)
BUDGET_KEYS = ("account_id", "platform")

MANAGED_ACCOUNTS = record(
    **texts("account_id", "platform", "account_name"),
    enabled="short",
    created_at="timestamp_ntz",
    updated_at="timestamp_ntz",
)
ACCOUNT_KEYS = ("account_id", "platform")

APP_USERS = record(
    id="integer",
    **texts("email", "name", "role"),
    created_at="timestamp_ntz",
    disabled_at="timestamp_ntz",
)

API_KEYS = record(
    id="integer",
    **texts("name", "key_hash"),
    user_id="integer",
    created_at="timestamp_ntz",
    last_used_at="timestamp_ntz",
    revoked_at="timestamp_ntz",
)

LOAD_LEDGER = record(
    table_name="string",
    date="date",
    **texts("account_id", "status"),
    rows="long",
    attempts="integer",
    updated_at="timestamp_ntz",
)
LEDGER_KEYS = ("table_name", "date", "account_id")
