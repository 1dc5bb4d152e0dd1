from __future__ import annotations

import random
from datetime import date, datetime, timedelta

import samples
from samples import DAY

from adtide.functions.dates import Period
from adtide.operators import ledger
from adtide.operators.upsert import OpsTable, partition_plan
from adtide.schemas import GOOGLE_ADS_RAW, LOAD_LEDGER
from adtide.sources.tables import read_table

NEXT = date(2026, 4, 2)
AT = datetime(2026, 4, 3, 5)
TABLE = GOOGLE_ADS_RAW.name
RESULTS = "date date, account_id string, rows long, status string"


def entry(day, account, status, attempts, rows=0, table=TABLE):
    return (table, day, account, status, rows, attempts, AT)


def filled(spark, *rows):
    return spark.createDataFrame(list(rows), LOAD_LEDGER)


def test_a_run_adds_an_attempt_and_leaves_other_units_alone(spark):
    before = filled(spark, entry(DAY, "a", "failed", 1), entry(DAY, "b", "loaded", 1, 5), entry(DAY, "a", "failed", 2, table="other"))
    results = spark.createDataFrame([(DAY, "a", 3, "loaded"), (NEXT, "a", 0, "empty")], RESULTS)
    later = AT + timedelta(hours=1)
    got = {(r["table_name"], r["date"], r["account_id"]): r for r in ledger.recorded(before, results, TABLE, later).collect()}
    assert {k: (r["status"], r["rows"], r["attempts"], r["updated_at"]) for k, r in got.items()} == {
        (TABLE, DAY, "a"): ("loaded", 3, 2, later),
        (TABLE, DAY, "b"): ("loaded", 5, 1, AT),
        (TABLE, NEXT, "a"): ("empty", 0, 1, later),
        ("other", DAY, "a"): ("failed", 0, 2, AT),
    }


def test_open_units_against_brute_force(spark):
    rng = random.Random(6)
    plan = [(DAY + timedelta(days=d), f"a{i}") for d in range(8) for i in range(6)]
    noted = {u: (rng.choice(["loaded", "empty", "failed"]), rng.randint(1, 4)) for u in plan if rng.random() < 0.7}
    rows = filled(spark, *[entry(*u, status, tries) for u, (status, tries) in noted.items()], *[entry(*u, "loaded", 1, table="other") for u in plan])
    units = spark.createDataFrame(plan, "date date, account_id string")
    got = {tuple(r) for r in ledger.open_units(units, rows, TABLE).collect()}
    assert got == {u for u in plan if u not in noted or (noted[u][0] == "failed" and noted[u][1] < 3)}
    out = {(r["date"], r["account_id"]) for r in ledger.given_up(rows, TABLE).collect()}
    assert out == {u for u, (status, tries) in noted.items() if status == "failed" and tries >= 3}
    again = ledger.reopen(rows, TABLE, (DAY, DAY))
    assert {u for u in plan if u[0] == DAY} <= {tuple(r) for r in ledger.open_units(units, again, TABLE).collect()}
    assert ledger.of_table(again, "other").count() == len(plan)


def test_a_backfill_is_resumed_until_its_units_are_done_or_given_up(spark, root):
    table = OpsTable(root, "ops", "load_ledger", LOAD_LEDGER)
    table.replace(filled(spark))
    accounts = spark.createDataFrame([("a1",), ("a2",), ("a3",)], "account_id string")
    plan = partition_plan(spark, Period(DAY, NEXT), accounts)
    every = [(d, a) for d in (DAY, NEXT) for a in ("a1", "a2", "a3")]

    def run(hour, spend, whole, broken=()):
        rows = samples.google(spark, *[{"customer_id": a, "date": d, "spend": spend} for d, a in whole])
        landed = spark.createDataFrame([(*u, u in broken) for u in [*whole, *broken]], "date date, account_id string, broken boolean")
        found = ledger.resume_backfill(
            spark, root, table, GOOGLE_ADS_RAW, rows.drop("_extracted_at", "_source"), landed, plan, AT.replace(hour=hour), "google_ads", "customer_id"
        )
        return sorted((r["date"], r["account_id"], r["status"]) for r in found.collect())

    hopeless = (NEXT, "a3")
    first = run(5, 1.0, [every[0], every[1]], [hopeless])
    assert [s for *_, s in first] == ["loaded", "loaded", "failed", "failed", "failed", "failed"]
    # what the first run has stored is not loaded again, although its files are still there
    second = run(6, 2.0, every[:5], [hopeless])
    assert [(d, a) for d, a, _ in second] == every[2:] and [s for *_, s in second] == ["loaded"] * 3 + ["failed"]
    stored = read_table(spark, root, "bronze", TABLE, GOOGLE_ADS_RAW.schema)
    assert sorted((r["date"], r["customer_id"], r["spend"]) for r in stored.collect()) == [
        (*unit, 1.0 if unit in every[:2] else 2.0) for unit in every[:5]
    ]
    assert run(7, 3.0, every[:5], [hopeless]) == [(*hopeless, "failed")]
    # three attempts: it is left to an operator, and a run without open units changes nothing
    assert run(8, 4.0, every) == []
    assert [(r["date"], r["account_id"], r["attempts"]) for r in ledger.given_up(table.read(spark), TABLE).collect()] == [(*hopeless, 3)]
    assert table.read(spark).count() == 6
