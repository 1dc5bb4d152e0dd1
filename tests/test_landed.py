"""Reports landed by the registered scans: disk they take, records of a file, rows read back."""

from __future__ import annotations

from datetime import datetime, timedelta
from pathlib import Path

from pyspark.sql import functions as F

from registry import runs
from registry.runs import QUERIES, Models

RECORDS = 100


def given_tables(spark, folder):
    """Order lines with repeated rows, lacking orders and parts, and NULLs."""
    shipped = [datetime(1995, 12, 30) + timedelta(days=i) for i in range(6)]
    lines = [
        (i % 150, i % 61, i % 7, i % 5 + 1, float(i % 50), 1000.37 + i * 3.7, 0.04, 0.02 * (i % 3), "ANR"[i % 3],
         None if i % 11 == 0 else "OF"[i % 2], None if i % 13 == 0 else shipped[i % 6])
        for i in range(900)
    ]
    spark.createDataFrame(
        lines + lines[:20],
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double,"
        " l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    ).write.parquet(f"{folder}/lineitem.parquet")
    orders = [(i, None if i % 17 == 0 else i % 23) for i in range(140)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long").write.parquet(f"{folder}/orders.parquet")
    part = [(i, None if i % 9 == 0 else f"blue ring {i}", f"Brand#{i % 4}", i % 12) for i in range(60)]
    spark.createDataFrame(part, "p_partkey long, p_name string, p_brand string, p_size int").write.parquet(f"{folder}/part.parquet")


def check_landed(spark, tmp_path, monkeypatch, query, nested, flatten):
    given_tables(spark, str(tmp_path))
    written = []

    def workspace(_, purpose):
        written.append(tmp_path / "work" / purpose)
        return str(written[-1])

    monkeypatch.setattr(runs, "new_workspace", workspace)
    monkeypatch.setattr(runs, "LANDED_RECORDS", RECORDS, raising=False)
    got = QUERIES[query](spark, str(tmp_path))
    report = nested(Models(spark, str(tmp_path)))
    expected = flatten(report)
    assert got.exceptAll(expected).count() == expected.exceptAll(got).count() == 0
    assert got.count() > 300

    (folder,) = written
    plain = report.select(F.sum(F.length(F.to_json(F.struct("*"))) + 1)).first()[0]
    assert 5 * sum(f.stat().st_size for f in Path(folder).glob("part-*")) < plain
    # a file that cannot be split is one task's, so none may grow with the tables
    records = spark.read.text(str(folder)).groupBy(F.input_file_name()).count()
    assert records.agg(F.max("count"), F.sum("count")).first() == (RECORDS, report.count())


def test_landed_keywords_take_a_part_of_the_disk_of_their_text(spark, tmp_path, monkeypatch):
    check_landed(spark, tmp_path, monkeypatch, "scan_keyword_report", runs._nested_keywords, runs.reports.flatten_keyword)


def test_landed_search_terms_take_a_part_of_the_disk_of_their_text(spark, tmp_path, monkeypatch):
    def flatten(report):
        days = F.col("segments.date").between(F.lit(runs.SCANNED_DAYS.start), F.lit(runs.SCANNED_DAYS.end))
        return runs.reports.flatten_search_term(report.where(days))

    check_landed(spark, tmp_path, monkeypatch, "scan_search_term_report", runs._nested_search_terms, flatten)
