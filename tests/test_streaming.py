from __future__ import annotations

import json
import os
from datetime import datetime

import pytest
from test_sources import keyword_row

from adtide.schemas import GOOGLE_ADS_RAW
from adtide.sources.reports import KEYWORD_REPORT, flatten_keyword
from adtide.sources.tables import read_table
from adtide.streaming.landing import ingest_landed_reports


def test_only_new_files_are_loaded_and_repeats_change_nothing(spark, tmp_path, root):
    landing = tmp_path / "landing"
    landing.mkdir()

    def load(hour):
        ingest_landed_reports(
            spark, str(landing), str(tmp_path / "progress"), KEYWORD_REPORT, flatten_keyword,
            root, GOOGLE_ADS_RAW, "google_ads", clock=lambda: datetime(2026, 4, 2, hour),
        )
        rows = read_table(spark, root, "bronze", "google_ads_raw", GOOGLE_ADS_RAW.schema)
        return {r["keyword_id"]: r["_extracted_at"].hour for r in rows.collect()}

    (landing / "a.json").write_text(json.dumps(keyword_row(keyword=1)))
    assert load(5) == {"1": 5}
    assert load(6) == {"1": 5}
    (landing / "b.json").write_text(
        "\n".join(json.dumps(keyword_row(keyword=k)) for k in (1, 2))
    )
    assert load(7) == {"1": 7, "2": 7}


@pytest.mark.parametrize("newer", ["a.json", "b.json"])
def test_the_newer_of_two_files_with_one_key_wins(spark, tmp_path, root, newer):
    landing = tmp_path / "landing"
    landing.mkdir()
    for at, name in enumerate(("a.json", "b.json")):
        row = keyword_row(keyword=1)
        row["ad_group"]["name"] = name
        (landing / name).write_text(json.dumps(row))
        os.utime(landing / name, (1_700_000_000 + (name == newer) * 60 + at, ) * 2)
    ingest_landed_reports(
        spark, str(landing), str(tmp_path / "progress"), KEYWORD_REPORT, flatten_keyword,
        root, GOOGLE_ADS_RAW, "google_ads",
    )
    rows = read_table(spark, root, "bronze", "google_ads_raw", GOOGLE_ADS_RAW.schema)
    assert [r["ad_group_name"] for r in rows.collect()] == [newer]


def test_a_load_that_fails_is_taken_up_again_with_the_same_files(spark, tmp_path, root, monkeypatch):
    from adtide.streaming import landing as module

    landing = tmp_path / "landing"
    landing.mkdir()
    load = module.load_bronze

    def run(files_per_load=1):
        ingest_landed_reports(
            spark, str(landing), str(tmp_path / "progress"), KEYWORD_REPORT, flatten_keyword, root, GOOGLE_ADS_RAW, "google_ads",
            files_per_load=files_per_load, clock=lambda: datetime(2026, 4, 2, 5),
        )

    for k in range(4):
        (landing / f"{k}.json").write_text(json.dumps(keyword_row(keyword=k)))
    done = []

    def dies_at_the_third(*arguments, **options):
        if len(done) == 2:
            raise RuntimeError("driver lost")
        done.append(1)
        return load(*arguments, **options)

    with monkeypatch.context() as patched:
        patched.setattr(module, "load_bronze", dies_at_the_third)
        with pytest.raises(Exception, match="driver lost"):
            run()
    rows = read_table(spark, root, "bronze", "google_ads_raw", GOOGLE_ADS_RAW.schema)
    assert rows.count() == 2
    run()
    rows = read_table(spark, root, "bronze", "google_ads_raw", GOOGLE_ADS_RAW.schema)
    assert sorted(r["keyword_id"] for r in rows.collect()) == ["0", "1", "2", "3"]
