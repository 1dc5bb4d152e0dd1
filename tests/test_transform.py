from __future__ import annotations

import inspect
from datetime import date, datetime

import samples
from pyspark.sql import functions as F

from adtide.functions.dates import Period
from adtide.operators.upsert import merge_upsert
from adtide.plans import metrics, review, signals
from adtide.plans.transform import MODELS, WAVES, gold_tables, lazy_models, run_transform
from adtide.schemas import (
    BRONZE,
    CLIENT_BUDGET,
    GOOGLE_ADS_RAW,
    GOOGLE_NEGATIVES_RAW,
    GOOGLE_SEARCH_TERMS_RAW,
    META_ADS_RAW,
)
from adtide.sources.tables import materialize, read_table

DAYS = [date(2026, 3, 30), date(2026, 4, 1), date(2026, 4, 6)]


def fill(spark, root):
    load = lambda table, rows: merge_upsert(spark, root, table, rows)
    load(GOOGLE_ADS_RAW, samples.google(spark, *[{"date": d, "keyword_id": k} for d in DAYS for k in "12"]))
    load(META_ADS_RAW, samples.meta(spark, *[{"date_start": d} for d in DAYS]))
    load(GOOGLE_SEARCH_TERMS_RAW, samples.terms(spark, *[{"date": d} for d in DAYS]))
    load(GOOGLE_NEGATIVES_RAW, samples.negatives(spark, {"snapshot_date": DAYS[0]}, {"snapshot_date": DAYS[1]}))


def contents(spark, root):
    found = {}
    for name, model in MODELS.items():
        df = read_table(spark, root, model.layer, name)
        found[name] = sorted(str(sorted(r.asDict().items())) for r in df.collect())
    return found


def bronze(spark, root):
    return {n: read_table(spark, root, "bronze", n, t.schema) for n, t in BRONZE.items()}


def test_stored_models_equal_lazy_ones_and_days_equal_a_full_rebuild(spark, root):
    fill(spark, root)
    run_transform(spark, root)
    stored = contents(spark, root)
    lazy = {
        name: sorted(str(sorted(r.asDict().items())) for r in df.collect())
        for name, df in lazy_models(bronze(spark, root)).items()
    }
    assert stored == lazy

    # one day changes: its cost vanishes on one platform and rises on the other
    day = DAYS[1]
    gone = [{"date": day, "keyword_id": k, "spend": 0.0} for k in "12"]
    merge_upsert(spark, root, GOOGLE_ADS_RAW, samples.google(spark, *gone))
    merge_upsert(spark, root, GOOGLE_SEARCH_TERMS_RAW, samples.terms(spark, {"date": day, "spend": 0.0}))
    merge_upsert(spark, root, META_ADS_RAW, samples.meta(spark, {"date_start": day, "spend": 77.0}))
    run_transform(spark, root, Period(day, day))
    partial = contents(spark, root)
    assert partial != stored
    run_transform(spark, root)
    assert contents(spark, root) == partial


def test_review_from_stored_tables(spark, root):
    fill(spark, root)
    run_transform(spark, root)
    made = datetime(2026, 1, 1)
    budget = spark.createDataFrame([], CLIENT_BUDGET)
    materialize(budget.withColumn("created_at", F.lit(made)), root, "ops", "client_budget")
    tables = gold_tables(spark, root)
    summary = review.review_summary(tables, Period(DAYS[0], DAYS[2]), DAYS[2])
    rows = {r["account_id"]: r for r in summary.collect()}
    assert (rows["1"]["spend"], rows["2"]["spend"]) == (120.0, 90.0)
    assert rows["1"]["pace_flag"] == "unknown"


def test_waves_cover_the_models_in_dependency_order():
    done = set(BRONZE)
    for wave in WAVES:
        for name in wave:
            assert set(MODELS[name].inputs) <= done
        done |= set(wave)
    assert done == set(BRONZE) | set(MODELS)


def test_metric_queries_know_no_raw_tables():
    for module in (metrics, review, signals):
        imports = [line for line in inspect.getsource(module).splitlines() if "import" in line]
        found = [line for line in imports if "silver" in line or "BRONZE" in line or "_RAW" in line]
        assert imports and not found
