"""Headline queries on one folder of given tables; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402

from adtide.session import local_session  # noqa: E402
from registry.runs import QUERIES  # noqa: E402

HEADLINE = (
    "daily_performance",
    "weekly_performance",
    "silver_keywords",
    "silver_search_terms",
    "silver_meta_ads",
    "gold_keywords",
    "gold_search_terms",
    "gold_negatives",
    "budget_pacing",
    "top_keywords",
    "search_term_buckets",
    "campaigns_without_negatives",
    "signals",
    "account_review",
    "merge_upsert",
    "merge_upsert_table",
    "dq_gold_models",
)


WARM_UP = ("account_review", "merge_upsert")


def warm_up_folder(sf_dir: str) -> str:
    """The smallest folder of given tables beside the measured one."""
    folders = [f for f in Path(sf_dir).parent.glob("sf*") if (f / "lineitem.parquet").exists()]
    return str(min(folders, key=lambda f: (f / "lineitem.parquet").stat().st_size, default=sf_dir))


def run(spark: SparkSession, name: str, sf_dir: str) -> None:
    """Produce every row of a query and keep none."""
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES", "").split() or list(HEADLINE)
    spark = local_session("bench", cores, memory="16g")
    spark.sparkContext.setLogLevel("ERROR")
    for name in WARM_UP:
        # class loading and compilation of a new JVM are no query's cost
        run(spark, name, warm_up_folder(sf_dir))
    seconds: dict[str, float] = {}
    for name in chosen:
        begin = time.perf_counter()
        run(spark, name, sf_dir)
        seconds[name] = round(time.perf_counter() - begin, 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr)
    spark.stop()
    result = {
        "metric": "total_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": Path(sf_dir).name.removeprefix("sf"),
        "cores": cores,
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
