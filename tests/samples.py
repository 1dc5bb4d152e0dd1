"""Small raw rows with every column, overridden where a test cares."""

from __future__ import annotations

from datetime import date, datetime

from adtide.schemas import (
    GOOGLE_ADS_RAW,
    GOOGLE_NEGATIVES_RAW,
    GOOGLE_SEARCH_TERMS_RAW,
    META_ADS_RAW,
)

DAY = date(2026, 4, 1)
LOADED = datetime(2026, 4, 2, 5)

_GOOGLE = {
    "customer_id": "1",
    "customer_name": "Acme",
    "campaign_id": "10",
    "campaign_name": "Camp A",
    "campaign_status": "ENABLED",
    "ad_group_id": "100",
    "ad_group_name": "AG1",
    "ad_group_status": "ENABLED",
    "keyword_id": "1000",
    "criterion_status": "ENABLED",
    "keyword_text": "kw1",
    "match_type": "EXACT",
    "impressions": 100,
    "clicks": 10,
    "spend": 20.0,
    "conversions": 2.0,
    "conversion_value": 50.0,
    "view_through_conversions": 0.0,
    "all_conversions": 2.0,
    "search_impression_share": 0.5,
    "quality_score": 7,
    "device": "MOBILE",
    "date": DAY,
    "_extracted_at": LOADED,
    "_source": "google_ads",
}
_TERM = {
    "customer_id": "1",
    "customer_name": "Acme",
    "campaign_id": "10",
    "campaign_name": "Camp A",
    "ad_group_id": "100",
    "ad_group_name": "AG1",
    "search_term": "shoes",
    "search_term_status": "NONE",
    "matched_keyword_text": "kw1",
    "matched_keyword_match_type": "EXACT",
    "impressions": 100,
    "clicks": 10,
    "spend": 20.0,
    "conversions": 2.0,
    "conversion_value": 50.0,
    "date": DAY,
    "_extracted_at": LOADED,
    "_source": "google_ads",
}
_NEGATIVE = {
    "customer_id": "1",
    "campaign_id": "10",
    "campaign_name": "Camp A",
    "ad_group_id": "",
    "ad_group_name": "",
    "criterion_id": "5",
    "criterion_text": "free",
    "match_type": "BROAD",
    "scope": "campaign",
    "snapshot_date": DAY,
    "_extracted_at": LOADED,
    "_source": "google_ads",
}
_META = {
    "account_id": "2",
    "account_name": "Beta",
    "campaign_id": "20",
    "campaign_name": "Meta A",
    "ad_id": "200",
    "ad_name": "Ad",
    "impressions": 1000,
    "clicks": 50,
    "spend": 30.0,
    "date_start": DAY,
    "date_stop": DAY,
    "actions": '[{"action_type":"lead","value":"3"},{"action_type":"link_click","value":"40"}]',
    "device_platform": "mobile",
    "publisher_platform": "facebook",
    "_extracted_at": LOADED,
    "_source": "meta_ads",
}


def _rows(spark, table, base, overrides):
    names = table.schema.fieldNames()
    rows = [tuple((base | change)[name] for name in names) for change in overrides]
    return spark.createDataFrame(rows, table.schema)


def google(spark, *overrides):
    return _rows(spark, GOOGLE_ADS_RAW, _GOOGLE, overrides or ({},))


def terms(spark, *overrides):
    return _rows(spark, GOOGLE_SEARCH_TERMS_RAW, _TERM, overrides or ({},))


def negatives(spark, *overrides):
    return _rows(spark, GOOGLE_NEGATIVES_RAW, _NEGATIVE, overrides or ({},))


def meta(spark, *overrides):
    return _rows(spark, META_ADS_RAW, _META, overrides or ({},))
