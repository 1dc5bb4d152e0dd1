from __future__ import annotations

import random

from pyspark.sql import functions as F

from adtide.operators import quality
from adtide.operators.quality import (
    dq_accepted_values,
    dq_expression,
    dq_not_null,
    dq_unique,
)
from adtide.plans.checks import UNIQUE_KEYS, check_models, failed, model_checks


def frame(spark):
    return spark.createDataFrame(
        [("1", "google_ads", 1.0), ("1", "google_ads", -1.0), (None, "tiktok", None), ("2", None, 0.0)],
        "account_id string, platform string, spend double",
    )


def failures(report):
    return {(r["check"], r["column"]): r["failures"] for r in report.collect()}


def test_single_checks(spark):
    df = frame(spark)
    assert failures(dq_not_null(df, "m", ["account_id", "platform"])) == {
        ("not_null", "account_id"): 1,
        ("not_null", "platform"): 1,
    }
    values = dq_accepted_values(df, "m", "platform", ["google_ads", "meta_ads"])
    assert failures(values) == {("accepted_values", "platform"): 1}
    positive = dq_expression(df, "m", "spend", F.col("spend") >= 0)
    assert failures(positive) == {("expression_is_true", "spend"): 1}
    assert failures(dq_unique(df, "m", ["account_id", "platform"])) == {
        ("unique_combination", "account_id,platform"): 1
    }


def test_an_empty_table_has_no_failures(spark):
    empty = frame(spark).where("false")
    assert failures(dq_not_null(empty, "m", ["spend"])) == {("not_null", "spend"): 0}
    assert failures(dq_unique(empty, "m", ["spend"])) == {("unique_combination", "spend"): 0}


def test_declared_checks_of_models(spark):
    users = spark.createDataFrame(
        [(1, "a@x", "admin"), (2, "a@x", "owner")], "id int, email string, role string"
    )
    report = failed(check_models({"users.app_users": users}))
    assert failures(report) == {
        ("accepted_values", "role"): 1,
        ("unique_combination", "email"): 1,
    }
    assert set(UNIQUE_KEYS) <= set(model_checks())


def test_refused_rows_name_every_constraint_and_the_rest_is_kept(spark):
    rng = random.Random(7)
    rows = [(i, rng.choice([None, 0, 1, 5]), rng.choice(["a", "b", "z", None])) for i in range(500)]
    df = spark.createDataFrame(rows, "id int, figure int, kind string").repartition(4)
    checks = [*quality.not_null("figure"), *quality.accepted_values("kind", ["a", "b"]), *quality.expression_is_true("figure", F.col("figure") > 0)]
    found = quality.split_refused(df, checks)
    names = ["not_null(figure)", "accepted_values(kind)", "expression_is_true(figure)"]
    # an undefined condition is not broken
    reasons = {i: [n for n, broken in zip(names, (f is None, k == "z", f == 0), strict=True) if broken] for i, f, k in rows}
    assert {r["id"]: r["reasons"] for r in found.refused.collect()} == {i: r for i, r in reasons.items() if r}
    assert sorted(map(tuple, found.kept.collect())) == [row for row in rows if not reasons[row[0]]]
    assert found.counts == {"rows": 500, "refused": sum(map(bool, reasons.values()))} | {n: sum(n in r for r in reasons.values()) for n in names}


def test_nothing_is_refused_without_constraints_or_rows(spark):
    df = spark.createDataFrame([(1,), (None,)], "id int")
    assert quality.split_refused(df, []).kept.count() == 2
    none = quality.split_refused(df.where("false"), quality.not_null("id"))
    assert none.kept.isEmpty() and none.refused.isEmpty() and none.counts == {"rows": 0, "refused": 0, "not_null(id)": 0}
