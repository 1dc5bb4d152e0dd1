from __future__ import annotations

import hashlib
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from adtide.functions.text import key_hash, normalize_account_id
from adtide.plans.access import admin_keys, api_key_status, list_users
from adtide.schemas import API_KEYS, APP_USERS

NOW = datetime(2026, 4, 20, 12)
MADE = datetime(2026, 1, 1)


def status(spark):
    users = spark.createDataFrame(
        [
            (1, "a@x.org", "A", "admin", MADE, None),
            (2, "b@x.org", None, "user", MADE, datetime(2026, 1, 1)),
        ],
        APP_USERS,
    )

    def key(number, user, used, revoked=None):
        return (number, f"k{number}", f"h{number}", user, MADE, used, revoked)

    keys = spark.createDataFrame(
        [
            key(1, 1, NOW - timedelta(days=13, hours=23)),
            key(2, 1, NOW - timedelta(days=14, minutes=1)),
            key(3, 1, None),
            key(4, 2, NOW),
            key(5, 2, NOW - timedelta(days=90), NOW),
            key(6, None, NOW - timedelta(days=14)),
        ],
        API_KEYS,
    )
    return api_key_status(keys, users, NOW), users


def test_key_states(spark):
    report, _ = status(spark)
    got = {r["id"]: (r["status"], r["role"]) for r in report.collect()}
    assert got == {
        1: ("valid", "admin"),
        2: ("expired", "admin"),
        3: ("valid", "admin"),
        4: ("disabled", "user"),
        5: ("revoked", "user"),
        6: ("valid", None),
    }
    assert {r["id"] for r in admin_keys(report).collect()} == {1, 3}


def test_users_are_listed_by_id(spark):
    _, users = status(spark)
    assert [r["id"] for r in list_users(users).collect()] == [1, 2]


def test_hash_and_prefix(spark):
    df = spark.createDataFrame([("abc",), ("act_9",)], "k string")
    row = df.select(key_hash(F.col("k"), "p")).first()
    assert row[0] == hashlib.sha256(b"abcp").hexdigest()
    ids = [r[0] for r in df.select(normalize_account_id(F.col("k"))).collect()]
    assert ids == ["act_abc", "act_9"]
