from __future__ import annotations

import random
from datetime import date, datetime

from pyspark.sql import functions as F

from adtide.operators.latest import latest_by_key, latest_snapshot
from adtide.operators.ranking import first_platform, top_per_group


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_newest_wins_and_unknown_time_counts_as_newest(spark):
    rows = [
        ("a", datetime(2024, 1, 1), 1),
        ("a", datetime(2024, 1, 2), 2),
        ("b", None, 3),
        ("b", datetime(2024, 1, 2), 4),
        (None, datetime(2024, 1, 1), 5),
        (None, datetime(2024, 1, 3), 6),
    ]
    df = spark.createDataFrame(rows, "k string, _extracted_at timestamp_ntz, v int")
    kept = {(r["k"], r["v"]) for r in latest_by_key(df, ["k"]).collect()}
    assert kept == {("a", 2), ("b", 3), (None, 6)}


def test_ties_are_settled_by_the_given_order(spark):
    at = datetime(2024, 1, 1)
    df = spark.createDataFrame(
        [("a", at, v) for v in range(9)], "k string, _extracted_at timestamp_ntz, v int"
    ).repartition(4)
    assert latest_by_key(df, ["k"], ties=[F.desc("v")]).first()["v"] == 8


def test_hot_key_against_brute_force_and_cut_before_the_shuffle(spark):
    rng = random.Random(3)
    rows = [
        ("hot" if rng.random() < 0.4 else f"k{rng.randrange(300)}", rng.randrange(1000), i)
        for i in range(6000)
    ]
    df = spark.createDataFrame(rows, "k string, t int, v int").repartition(6)
    got = latest_by_key(df, ["k"], "t", [F.desc("v")])
    best: dict[str, tuple[int, int]] = {}
    for k, t, v in rows:
        best[k] = max(best.get(k, (-1, -1)), (t, v))
    assert {r["k"]: (r["t"], r["v"]) for r in got.collect()} == best
    plan = plan_of(got)
    shuffle = plan.index("Exchange")
    assert "Partial" in plan[shuffle:] and "WindowGroupLimit" in plan[shuffle:]


def test_top_per_group_is_cut_before_the_shuffle(spark):
    rows = [("hot", float(i)) for i in range(500)] + [("cold", 1.0)]
    df = spark.createDataFrame(rows, "g string, x double").repartition(5)
    top = top_per_group(df, ["g"], [F.desc("x")], 3)
    assert {(r["g"], r["position"], r["x"]) for r in top.collect()} == {
        ("hot", 1, 499.0),
        ("hot", 2, 498.0),
        ("hot", 3, 497.0),
        ("cold", 1, 1.0),
    }
    plan = plan_of(top)
    assert "WindowGroupLimit" in plan[plan.index("Exchange") :]


SNAPSHOTS = [
    ("1", date(2024, 1, 29), "old"),
    ("1", date(2024, 1, 30), "new"),
    ("2", date(2024, 1, 29), "only"),
]


def test_latest_snapshot_is_global_unless_asked_per_account(spark):
    df = spark.createDataFrame(SNAPSHOTS, "account_id string, snapshot_date date, v string")
    assert {r["v"] for r in latest_snapshot(df).collect()} == {"new"}
    assert {r["v"] for r in latest_snapshot(df, per_account=True).collect()} == {"new", "only"}


def test_first_platform(spark):
    df = spark.createDataFrame(
        [("1", "meta_ads", 2.0), ("1", "google_ads", 1.0), ("2", "meta_ads", 3.0)],
        "account_id string, platform string, x double",
    )
    got = {r["account_id"]: (r["platform"], r["x"]) for r in first_platform(df).collect()}
    assert got == {"1": ("google_ads", 1.0), "2": ("meta_ads", 3.0)}
