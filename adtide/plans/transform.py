"""The daily transform: raw tables to stored silver and gold tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import date, timedelta
from functools import partial
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adtide.functions.dates import Period
from adtide.plans import gold, silver
from adtide.plans.review import GoldTables
from adtide.schemas import BRONZE, CLIENT_BUDGET
from adtide.sources.tables import materialize, read_table, replace_days, side_by_side


class Model(NamedTuple):
    """One stored table: its inputs, the function and its day column, if any."""

    layer: str
    inputs: tuple[str, ...]
    build: Callable[..., DataFrame]
    partition: str | None


# In dependency order; names are those of the stored tables.
MODELS: dict[str, Model] = {
    "google_ads": Model("silver", ("google_ads_raw",), silver.silver_google_ads, "date"),
    "google_ads_keywords_dedup": Model(
        "silver", ("google_ads_raw",), silver.silver_keywords, "date"
    ),
    "google_search_terms_dedup": Model(
        "silver", ("google_search_terms_raw",), silver.silver_search_terms, "date"
    ),
    "google_negatives_dedup": Model(
        "silver", ("google_negatives_raw",), silver.silver_negatives, "snapshot_date"
    ),
    "meta_ads": Model("silver", ("meta_ads_raw",), silver.silver_meta_ads, "date"),
    "unified_campaigns": Model(
        "silver", ("meta_ads", "google_ads"), silver.unified_campaigns, "date"
    ),
    "daily_performance": Model("gold", ("unified_campaigns",), gold.daily_performance, "date"),
    "weekly_performance": Model(
        "gold", ("unified_campaigns",), gold.weekly_performance, "week_start"
    ),
    "google_ads_keywords": Model(
        "gold", ("google_ads_keywords_dedup",), gold.gold_keywords, "date"
    ),
    "google_search_terms": Model(
        "gold", ("google_search_terms_dedup",), gold.gold_search_terms, "date"
    ),
    "google_negatives": Model("gold", ("google_negatives_dedup",), gold.gold_negatives, None),
}


# Tables of one wave read only earlier waves, so they are written side by side.
WAVES = (
    (
        "google_ads",
        "google_ads_keywords_dedup",
        "google_search_terms_dedup",
        "google_negatives_dedup",
        "meta_ads",
    ),
    ("unified_campaigns", "google_ads_keywords", "google_search_terms", "google_negatives"),
    ("daily_performance", "weekly_performance"),
)


def lazy_models(
    bronze: Mapping[str, DataFrame], ties: Mapping[str, list[Column]] | None = None
) -> dict[str, DataFrame]:
    """Every model as a DataFrame over the raw tables; nothing runs or is stored."""
    frames = dict(bronze)
    for name, model in MODELS.items():
        options = {}
        if ties and model.inputs[0] in ties:
            options["ties"] = ties[model.inputs[0]]
        frames[name] = model.build(*[frames[source] for source in model.inputs], **options)
    return {name: frames[name] for name in MODELS}


def _whole_weeks(days: Period) -> Period:
    monday = days.start - timedelta(days=days.start.weekday())
    sunday = days.end + timedelta(days=6 - days.end.weekday())
    return Period(monday, sunday)


def run_transform(spark: SparkSession, root: str, days: Period | None = None) -> None:
    """Rebuild the stored models from the stored raw tables.

    Without ``days`` every table is replaced. With ``days`` only those days are
    read, recomputed and replaced: each model works within a day, weeks are widened
    to whole ones, and the small table of newest negatives is always rebuilt. The
    result is the same as a full rebuild as long as no other day changed.
    """
    for wave in WAVES:
        side_by_side([partial(_rebuild, spark, root, name, days) for name in wave])


def _rebuild(spark: SparkSession, root: str, name: str, days: Period | None) -> None:
    model = MODELS[name]
    rows = model.build(*[_input(spark, root, source, name, days) for source in model.inputs])
    if days is None or model.partition is None:
        materialize(rows, root, model.layer, name, model.partition)
    else:
        replaced = _whole_weeks(days) if name == "weekly_performance" else days
        replace_days(rows, root, model.layer, name, model.partition, replaced)


def _input(
    spark: SparkSession, root: str, source: str, consumer: str, days: Period | None
) -> DataFrame:
    if source in BRONZE:
        table = BRONZE[source]
        df = read_table(spark, root, "bronze", source, table.schema)
        column = table.partition
    else:
        df = read_table(spark, root, MODELS[source].layer, source)
        column = MODELS[source].partition
    if days is None or MODELS[consumer].partition is None or column is None:
        return df
    if consumer == "weekly_performance":
        days = _whole_weeks(days)
    return df.where(F.col(column).between(F.lit(days.start), F.lit(days.end)))


def gold_tables(spark: SparkSession, root: str) -> GoldTables:
    """Stored inputs of the metric queries and of a review."""
    return GoldTables(
        daily=read_table(spark, root, "gold", "daily_performance"),
        keywords=read_table(spark, root, "gold", "google_ads_keywords"),
        search_terms=read_table(spark, root, "gold", "google_search_terms"),
        negatives=read_table(spark, root, "gold", "google_negatives"),
        budget=read_table(spark, root, "ops", "client_budget", CLIENT_BUDGET),
    )


def budget_pacing_view(
    spark: SparkSession, root: str, as_of: date, name: str = "budget_pacing"
) -> DataFrame:
    """Pacing as a view: recomputed from the stored tables whenever it is read."""
    budget = read_table(spark, root, "ops", "client_budget", CLIENT_BUDGET)
    daily = read_table(spark, root, "gold", "daily_performance")
    view = gold.budget_pacing(budget, daily, as_of)
    view.createOrReplaceTempView(name)
    return view
