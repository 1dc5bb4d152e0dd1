from __future__ import annotations

import json
from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import pytest
import samples
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from samples import DAY
from test_sources import keyword_row

from adtide.functions.dates import Period
from adtide.operators import upsert
from adtide.schemas import CLIENT_BUDGET, GOOGLE_ADS_RAW, GOOGLE_SEARCH_TERMS_RAW
from adtide.sources import reports
from adtide.sources.tables import create_alone, delete_path, read_table

NEXT = date(2026, 4, 2)
AT = datetime(2026, 4, 3, 5)


def stored(spark, root, table=GOOGLE_ADS_RAW):
    return read_table(spark, root, "bronze", table.name, table.schema)


def figures(df):
    return sorted((r["date"], r["keyword_id"], r["spend"]) for r in df.collect())


def test_insert_then_update_then_repeat(spark, root):
    first = samples.google(spark, {}, {"keyword_id": "2"}, {"date": NEXT})
    assert upsert.merge_upsert(spark, root, GOOGLE_ADS_RAW, first) == 3
    change = samples.google(spark, {"spend": 99.0}, {"keyword_id": "3"})
    expected = [(DAY, "1000", 99.0), (DAY, "2", 20.0), (DAY, "3", 20.0), (NEXT, "1000", 20.0)]
    for _ in range(2):
        assert upsert.merge_upsert(spark, root, GOOGLE_ADS_RAW, change) == 2
        assert figures(stored(spark, root)) == expected


def test_untouched_days_are_not_rewritten(spark, root):
    upsert.merge_upsert(spark, root, GOOGLE_ADS_RAW, samples.google(spark, {}, {"date": NEXT}))
    folder = Path(root) / "bronze" / "google_ads_raw" / f"date={NEXT}"
    before = sorted(p.name for p in folder.iterdir())
    upsert.merge_upsert(spark, root, GOOGLE_ADS_RAW, samples.google(spark, {"spend": 1.0}))
    assert sorted(p.name for p in folder.iterdir()) == before


def test_columns_the_batch_lacks_keep_their_values(spark, root):
    upsert.merge_upsert(spark, root, GOOGLE_ADS_RAW, samples.google(spark))
    change = samples.google(spark, {"spend": 5.0}, {"keyword_id": "7"}).drop("clicks", "match_type")
    upsert.merge_upsert(spark, root, GOOGLE_ADS_RAW, change)
    got = {r["keyword_id"]: (r["spend"], r["clicks"], r["match_type"]) for r in stored(spark, root).collect()}
    assert got == {"1000": (5.0, 10, "EXACT"), "7": (20.0, None, None)}


def test_a_load_that_died_while_replacing_days_loses_nothing(spark, root, monkeypatch):
    both = samples.google(spark, {}, {"keyword_id": "2"})
    upsert.merge_upsert(spark, root, GOOGLE_ADS_RAW, both)
    folder = f"{root}/bronze/google_ads_raw/date={DAY}"

    def die(*_):
        delete_path(spark, folder)
        raise RuntimeError("driver lost")

    with monkeypatch.context() as patched:
        patched.setattr(upsert, "move_folders", die)
        with pytest.raises(RuntimeError):
            upsert.merge_upsert(spark, root, GOOGLE_ADS_RAW, samples.google(spark, {"spend": 9.0}))
    other = samples.google(spark, {"date": NEXT})
    upsert.merge_upsert(spark, root, GOOGLE_ADS_RAW, other)
    assert figures(stored(spark, root)) == [(DAY, "1000", 9.0), (DAY, "2", 20.0), (NEXT, "1000", 20.0)]


def test_a_day_that_another_load_stored_meanwhile_is_merged_again(spark, root, monkeypatch):
    upsert.merge_upsert(spark, root, GOOGLE_ADS_RAW, samples.google(spark, {}, {"date": NEXT}))
    replace, made = upsert._replace_days, []

    def other_load_first(*arguments):
        made.append(1)
        if len(made) == 1:
            other = samples.google(spark, {"keyword_id": "2"}, {"spend": 5.0})
            upsert.merge_upsert(spark, root, GOOGLE_ADS_RAW, other)
        return replace(*arguments)

    monkeypatch.setattr(upsert, "_replace_days", other_load_first)
    own = samples.google(spark, {"keyword_id": "3"}, {"keyword_id": "4", "date": NEXT})
    assert upsert.merge_upsert(spark, root, GOOGLE_ADS_RAW, own) == 2
    # the own load twice and the other one once
    assert len(made) == 3
    assert figures(stored(spark, root)) == [
        (DAY, "1000", 5.0), (DAY, "2", 20.0), (DAY, "3", 20.0), (NEXT, "1000", 20.0), (NEXT, "4", 20.0)
    ]


def test_loads_of_other_days_do_not_meet(spark, root, monkeypatch):
    upsert.merge_upsert(spark, root, GOOGLE_ADS_RAW, samples.google(spark, {}, {"date": NEXT}))
    replace, made = upsert._replace_days, []

    def other_load_first(*arguments):
        made.append(1)
        if len(made) == 1:
            upsert.merge_upsert(spark, root, GOOGLE_ADS_RAW, samples.google(spark, {"date": NEXT, "spend": 5.0}))
        return replace(*arguments)

    monkeypatch.setattr(upsert, "_replace_days", other_load_first)
    upsert.merge_upsert(spark, root, GOOGLE_ADS_RAW, samples.google(spark, {"spend": 6.0}))
    assert len(made) == 2
    assert figures(stored(spark, root)) == [(DAY, "1000", 6.0), (NEXT, "1000", 5.0)]


def test_many_loads_at_a_time_lose_no_row(spark, root):
    loads = [samples.google(spark, {"keyword_id": f"k{i}"}, {"keyword_id": f"k{i}", "date": NEXT}) for i in range(6)]
    with ThreadPoolExecutor(6) as pool:
        done = list(pool.map(lambda batch: upsert.merge_upsert(spark, root, GOOGLE_ADS_RAW, batch), loads))
    assert done == [2] * 6
    expected = sorted((day, f"k{i}", 20.0) for day in (DAY, NEXT) for i in range(6))
    assert figures(stored(spark, root)) == expected
    # nothing is left beside the table
    folder = Path(root) / "bronze" / "_publishing" / GOOGLE_ADS_RAW.name
    assert [p.name for p in folder.iterdir() if not p.name.startswith(".")] == []


def test_claims_of_a_dead_driver_are_void_and_of_a_live_one_are_kept(spark, root, monkeypatch):
    upsert.merge_upsert(spark, root, GOOGLE_ADS_RAW, samples.google(spark))
    claim = f"{root}/bronze/_publishing/{GOOGLE_ADS_RAW.name}/claim-{DAY}"
    # of this application, with nobody at work
    assert create_alone(spark, claim, f"{spark.sparkContext.applicationId}-gone")
    assert not create_alone(spark, claim, "again")
    upsert.merge_upsert(spark, root, GOOGLE_ADS_RAW, samples.google(spark, {"spend": 2.0}))
    # of another application: kept until its lease is over
    assert create_alone(spark, claim, "application_9-x")
    upsert.finish_publishing(spark, root, GOOGLE_ADS_RAW)
    assert Path(claim).exists()
    monkeypatch.setattr(upsert, "LEASE_SECONDS", -1)
    upsert.merge_upsert(spark, root, GOOGLE_ADS_RAW, samples.google(spark, {"spend": 3.0}))
    assert figures(stored(spark, root)) == [(DAY, "1000", 3.0)] and not Path(claim).exists()


def test_a_load_gives_up_when_its_days_never_rest(spark, root, monkeypatch):
    upsert.merge_upsert(spark, root, GOOGLE_ADS_RAW, samples.google(spark))
    monkeypatch.setattr(upsert, "_replace_days", lambda *_: False)
    with pytest.raises(upsert.ConcurrentLoads):
        upsert.merge_upsert(spark, root, GOOGLE_ADS_RAW, samples.google(spark))


def test_an_empty_batch_changes_nothing(spark, root):
    upsert.merge_upsert(spark, root, GOOGLE_ADS_RAW, samples.google(spark))
    assert upsert.merge_upsert(spark, root, GOOGLE_ADS_RAW, samples.google(spark).where("false")) == 0
    assert stored(spark, root).count() == 1


def test_duplicate_keys_are_refused_or_reduced(spark, root):
    batch = samples.google(spark, {"spend": 1.0, "_extracted_at": datetime(2026, 4, 1)}, {"spend": 2.0})
    with pytest.raises(upsert.DuplicateKeys):
        upsert.merge_upsert(spark, root, GOOGLE_ADS_RAW, batch)
    assert upsert.merge_upsert(spark, root, GOOGLE_ADS_RAW, batch, on_duplicate="latest") == 1
    assert figures(stored(spark, root)) == [(DAY, "1000", 2.0)]


def test_null_key_parts_match_blank_ones(spark, root):
    table = GOOGLE_SEARCH_TERMS_RAW
    for _ in range(2):
        batch = samples.terms(spark, {"matched_keyword_text": None})
        upsert.merge_upsert(spark, root, table, batch)
    assert [r["matched_keyword_text"] for r in stored(spark, root, table).collect()] == [""]


def test_load_stamps_one_time_and_appends_without_keys(spark, root):
    rows = samples.google(spark, {}, {"keyword_id": "2"}).drop("_extracted_at", "_source")
    assert upsert.load_bronze(spark, root, GOOGLE_ADS_RAW, rows, AT, "google_ads") == 2
    got = stored(spark, root).select("_extracted_at", "_source").distinct().collect()
    assert [tuple(r) for r in got] == [(AT, "google_ads")]
    upsert.load_bronze(spark, root, GOOGLE_ADS_RAW, rows, AT, "google_ads", upsert=False)
    assert stored(spark, root).count() == 4


def test_hot_day_against_brute_force(spark):
    old = [{"keyword_id": str(i), "spend": 1.0} for i in range(300)]
    new = [{"keyword_id": str(i), "spend": 2.0} for i in range(200, 400)]
    got = upsert.merged(samples.google(spark, *old), samples.google(spark, *new), GOOGLE_ADS_RAW.keys)
    expected = {str(i): 2.0 if i >= 200 else 1.0 for i in range(400)}
    assert {r["keyword_id"]: r["spend"] for r in got.collect()} == expected


def budgets(spark, *rows):
    return spark.createDataFrame(list(rows), CLIENT_BUDGET)


def test_budget_upsert_keeps_creation_time(spark):
    made = datetime(2026, 4, 1)
    target = budgets(
        spark,
        ("123", "google_ads", Decimal("5000"), "BRL", True, made, made),
        ("9", "meta_ads", Decimal("10"), "USD", False, made, made),
    )
    new = spark.createDataFrame(
        [("123", "google_ads", 750.5), ("123", "meta_ads", 1.0)],
        "account_id string, platform string, monthly_budget double",
    )
    got = {(r["account_id"], r["platform"]): r for r in upsert.upsert_budget(target, new, AT).collect()}
    changed, added, other = got[("123", "google_ads")], got[("123", "meta_ads")], got[("9", "meta_ads")]
    assert (changed["monthly_budget"], changed["created_at"], changed["updated_at"]) == (
        Decimal("750.50"), made, AT)
    assert (added["currency"], added["active"], added["created_at"]) == ("BRL", True, AT)
    assert (other["currency"], other["updated_at"]) == ("USD", made)


@pytest.mark.parametrize(("platform", "amount"), [("google_ads", 0.0), ("tiktok", 5.0)])
def test_bad_budgets_are_refused(spark, platform, amount):
    new = spark.createDataFrame(
        [("1", platform, amount)], "account_id string, platform string, monthly_budget double"
    )
    with pytest.raises(PySparkException):
        upsert.upsert_budget(budgets(spark), new, AT).collect()


def test_insert_if_absent_and_delete(spark):
    schema = "email string, name string"
    target = spark.createDataFrame([("a", "old")], schema)
    new = spark.createDataFrame([("a", "new"), ("b", "new")], schema)
    rows = upsert.insert_if_absent(target, new, ["email"])
    assert sorted(tuple(r) for r in rows.collect()) == [("a", "old"), ("b", "new")]
    left = upsert.delete_where(rows.unionByName(spark.createDataFrame([(None, "x")], schema)), F.col("email") == "a")
    assert sorted(r["name"] for r in left.collect()) == ["new", "x"]


def test_one_row_of_a_key_is_inserted_and_twice_in_a_budget_batch_is_refused(spark, root):
    schema = "email string, name string"
    target, new = spark.createDataFrame([("a", "old")], schema), [("b", "2"), ("b", "1"), ("a", "x"), ("b", "3")]
    rows = upsert.insert_if_absent(target, spark.createDataFrame(new, schema), ["email"])
    assert sorted(tuple(r) for r in rows.collect()) == [("a", "old"), ("b", "1")]
    twice = spark.createDataFrame([("1", "google_ads", 5.0), ("1", "google_ads", 7.0)], "account_id string, platform string, monthly_budget double")
    with pytest.raises(upsert.DuplicateKeys):
        upsert.upsert_budget(budgets(spark), twice, AT)
    kept = upsert.upsert_budget(budgets(spark), twice, AT, "latest").collect()
    assert [r["monthly_budget"] for r in kept] == [Decimal("7.00")]


def test_stored_forms_switch_versions(spark, root):
    table = upsert.OpsTable(root, "ops", "client_budget", CLIENT_BUDGET)
    made = datetime(2026, 4, 1)
    table.replace(budgets(spark, ("9", "meta_ads", Decimal("10"), "USD", False, made, made)))
    before = table.read(spark)
    new = spark.createDataFrame([("1", "google_ads", 5.0)], "account_id string, platform string, monthly_budget double")
    assert {r["account_id"] for r in upsert.store_budgets(spark, table, new, AT).collect()} == {"1", "9"}
    # a reader that started before still finds its rows
    assert [r["account_id"] for r in before.collect()] == ["9"]
    again = upsert.store_if_absent(spark, table, budgets(spark, ("9", "meta_ads", Decimal("1"), "USD", True, made, made)), ["account_id", "platform"])
    assert {(r["account_id"], r["monthly_budget"]) for r in again.collect()} == {("1", Decimal("5.00")), ("9", Decimal("10.00"))}
    assert [r["account_id"] for r in upsert.delete_stored(spark, table, F.col("platform") == "meta_ads").collect()] == ["1"]
    assert [r["account_id"] for r in table.read(spark).collect()] == ["1"]
    bad = table.read(spark).withColumn("currency", F.raise_error(F.lit("stop")))
    with pytest.raises(PySparkException):
        table.replace(bad)
    assert [r["account_id"] for r in table.read(spark).collect()] == ["1"]


def accounts(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "account_id string")


def units(spark, *landed):
    rows = [(*unit, False) for unit in landed]
    return spark.createDataFrame(rows, "date date, account_id string, broken boolean")


def test_a_bad_file_fails_only_its_unit_and_an_empty_one_is_no_failure(spark, root, tmp_path):
    landing = tmp_path / "landed"
    lines = {"a1": json.dumps(keyword_row(keyword=1)), "a2": '{"customer": {"id": ', "a3": "", "a4": json.dumps(keyword_row(keyword=4))}
    for account, text in lines.items():
        folder = landing / f"date={keyword_row()['segments']['date']}" / f"account_id={account}"
        folder.mkdir(parents=True)
        (folder / "part.json").write_text(text)
    rows, landed = reports.read_landed(spark, str(landing), reports.KEYWORD_REPORT)
    flat = reports.flatten_keyword(rows)
    assert sorted(r["keyword_id"] for r in flat.collect()) == ["1", "4"]
    found = {r["account_id"]: r["broken"] for r in landed.collect()}
    assert found == {"a1": False, "a2": True, "a3": False, "a4": False}
    day = date.fromisoformat(keyword_row()["segments"]["date"])
    plan = upsert.partition_plan(spark, Period(day, day), accounts(spark, "a1", "a2", "a3", "a4", "a5"))
    loaded = spark.createDataFrame([(day, "a1"), (day, "a4")], "date date, account_id string")
    results = upsert.load_results(plan, loaded, landed)
    status = {r["account_id"]: r["status"] for r in results.collect()}
    assert status == {"a1": "loaded", "a2": "failed", "a3": "empty", "a4": "loaded", "a5": "failed"}
    assert upsert.load_report(results, "x").first()["failed"] == 2


def test_plan_is_oldest_day_first(spark):
    plan = upsert.partition_plan(spark, Period(DAY, NEXT), accounts(spark, "a1", "a2"))
    assert [tuple(r) for r in plan.collect()] == [(DAY, "a1"), (DAY, "a2"), (NEXT, "a1"), (NEXT, "a2")]


def test_backfill_keeps_what_landed_and_reports_the_rest(spark, root):
    rows = samples.google(
        spark,
        {"customer_id": "a2"},
        {"customer_id": "a1", "date": NEXT},
        {"customer_id": "a2", "date": NEXT},
        {"customer_id": "stranger"},
        {"customer_id": "a1", "date": date(2026, 5, 1)},
    ).drop("_extracted_at", "_source")
    results = upsert.backfill(
        spark, root, GOOGLE_ADS_RAW, rows, Period(DAY, NEXT), accounts(spark, "a1", "a2"), AT,
        "google_ads", "customer_id", units(spark, (DAY, "a2"), (NEXT, "a1"), (NEXT, "a2")),
    )
    assert stored(spark, root).count() == 3
    report = upsert.load_report(results, "google_ads").first()
    assert (report["rows_loaded"], report["failed"], report["planned"]) == (3, 1, 4)
    assert report["message"] == (
        "google_ads backfill incompleto: 1/4 partições falharam (amostra: 2026-04-01/a1)"
    )


def test_report_samples_five_and_is_silent_on_success(spark):
    plan = upsert.partition_plan(spark, Period(DAY, NEXT), accounts(spark, "a", "b", "c", "d"))
    nothing = spark.createDataFrame([], "date date, account_id string")
    report = upsert.load_report(upsert.load_results(plan, nothing, units(spark)), "x").first()
    assert report["failed"] == 8 and report["message"].count("2026-") == 5
    assert "2026-04-01/a, 2026-04-01/b, 2026-04-01/c, 2026-04-01/d, 2026-04-02/a" in report["message"]
    done = upsert.load_report(upsert.load_results(plan, plan), "x").first()
    assert (done["rows_loaded"], done["failed"], done["message"]) == (8, 0, None)


def test_snapshot_load_replaces_the_day(spark, root):
    from adtide.schemas import GOOGLE_NEGATIVES_RAW as NEGATIVES

    rows = samples.negatives(spark).drop("_extracted_at", "_source", "snapshot_date")
    for _ in range(2):
        upsert.snapshot_load(spark, root, NEGATIVES, rows, AT, "google_ads")
    got = stored(spark, root, NEGATIVES).collect()
    assert [r["snapshot_date"] for r in got] == [AT.date()]
