from __future__ import annotations

from datetime import date, datetime

from adtide.functions.dates import Period
from adtide.operators.filters import (
    active_only,
    drop_blank,
    for_account,
    for_platform,
    having_positive,
    in_range,
    not_revoked,
    roas_above,
    zero_conversions,
)

D1, D2, D3 = date(2026, 4, 1), date(2026, 4, 2), date(2026, 4, 3)


def frame(spark):
    schema = """account_id string, platform string, date date, spend double, conversions double,
        roas double, active boolean, name string, revoked_at timestamp_ntz"""
    rows = [
        ("1", "google_ads", D1, 1.0, 0.0, None, True, "a", None),
        ("1", "meta_ads", D2, 0.0, 1.0, 1.0, False, "", datetime(2026, 1, 1)),
        ("2", "google_ads", D3, None, None, 1.1, None, None, None),
    ]
    return spark.createDataFrame(rows, schema)


def days(df):
    return sorted(r["date"] for r in df.collect())


def test_each_filter(spark):
    df = frame(spark)
    assert days(in_range(df, Period(D1, D2))) == [D1, D2]
    assert days(for_account(df, "1")) == [D1, D2] and days(for_account(df)) == [D1, D2, D3]
    assert days(for_platform(df, "google_ads")) == [D1, D3]
    assert days(active_only(df)) == [D1]
    assert days(having_positive(df)) == [D1]
    assert days(zero_conversions(df)) == [D1]
    assert days(roas_above(df, 1.0)) == [D3]
    assert days(drop_blank(df, "name")) == [D1]
    assert days(not_revoked(df)) == [D1, D3]
