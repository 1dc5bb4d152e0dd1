"""Raw ad tables derived from the given order, part, customer and event tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = date(2024, 1, 20)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with their order. Both sides grow with the data: never broadcast."""
    orders = table(spark, sf_dir, "orders").hint("merge")
    lines = table(spark, sf_dir, "lineitem")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))


#: Columns of the joined lines that the raw ad tables are made of.
LINE_COLUMNS = (
    "l_orderkey",
    "l_partkey",
    "l_suppkey",
    "l_linenumber",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
    "o_custkey",
    "o_totalprice",
    "o_orderdate",
)


def _texts(expressions: dict[str, str]) -> list[str]:
    return [f"CAST({text} AS STRING) AS {name}" for name, text in expressions.items()]


_LINE_TEXTS = {
    "customer_id": "o_custkey % 4",
    "customer_name": "concat('Account ', o_custkey % 4)",
    "campaign_id": "l_suppkey % 5",
    "campaign_name": "concat('Campaign ', l_suppkey % 5)",
    "ad_group_id": "(l_suppkey % 5) * 10 + l_linenumber % 3",
    "ad_group_name": "concat('AdGroup ', l_linenumber % 3)",
}
_LINE_FIGURES = [
    "CAST(l_quantity * 20 AS BIGINT) AS impressions",
    "if(l_discount = 0, 0D, l_extendedprice) AS spend",
    "date_add(DATE '2024-01-01', CAST(l_orderkey % 30 AS INT)) AS date",
    "o_orderdate AS _extracted_at",
    "l_orderkey AS _seq",
]
_ORDER_VALUE = "if(o_custkey % 4 = 3, o_totalprice / 50, o_totalprice)"


def google_ads_raw(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    return (order_lines(spark, sf_dir) if lines is None else lines).selectExpr(
        *_texts(
            _LINE_TEXTS
            | {
                "campaign_status": """CASE l_returnflag WHEN 'A' THEN 'ENABLED'
                    WHEN 'N' THEN 'PAUSED' ELSE 'REMOVED' END""",
                "ad_group_status": "if(l_linestatus = 'O', 'ENABLED', 'PAUSED')",
                "keyword_id": "l_partkey % 40",
                "criterion_status": "'ENABLED'",
                "keyword_text": """CASE l_partkey % 40 WHEN 7 THEN '' WHEN 8 THEN NULL
                    ELSE concat('kw ', (l_partkey % 40) % 25) END""",
                "match_type": """CASE l_partkey % 3 WHEN 0 THEN 'EXACT'
                    WHEN 1 THEN 'PHRASE' ELSE 'BROAD' END""",
                "device": "if(l_linestatus = 'O', 'MOBILE', 'DESKTOP')",
            }
        ),
        *_LINE_FIGURES,
        "if(l_tax = 0, NULL, CAST(l_quantity AS BIGINT)) AS clicks",
        """if(l_returnflag = 'R' OR l_suppkey % 5 = 4, 0D, CAST(l_linenumber AS DOUBLE))
           AS conversions""",
        f"if(l_returnflag = 'R', NULL, {_ORDER_VALUE}) AS conversion_value",
        "CAST(l_linenumber % 2 AS DOUBLE) AS view_through_conversions",
        "CAST(l_linenumber AS DOUBLE) AS all_conversions",
        "l_discount AS search_impression_share",
        "CAST(l_partkey % 10 AS INT) AS quality_score",
    )


def google_ads_ties() -> list[Column]:
    return [
        F.desc("_seq"),
        F.desc("spend"),
        F.desc("impressions"),
        F.desc("conversions"),
        F.desc_nulls_last("conversion_value"),
        F.asc("match_type"),
        F.asc("ad_group_id"),
        F.asc("campaign_status"),
        F.desc_nulls_last("clicks"),
        F.asc("ad_group_status"),
    ]


def google_search_terms_raw(
    spark: SparkSession, sf_dir: str, lines: DataFrame | None = None
) -> DataFrame:
    part = table(spark, sf_dir, "part")
    lines = order_lines(spark, sf_dir) if lines is None else lines
    rows = lines.join(part, F.col("l_partkey") == F.col("p_partkey"))
    return rows.selectExpr(
        *_texts(
            _LINE_TEXTS
            | {
                "search_term": "if(l_partkey % 97 = 0, '', p_name)",
                "search_term_status": """CASE l_returnflag WHEN 'A' THEN 'ADDED'
                    WHEN 'N' THEN 'NONE' ELSE 'EXCLUDED' END""",
                "matched_keyword_text": "nullif(p_type, 'ECONOMY')",
                "matched_keyword_match_type": """CASE l_partkey % 3 WHEN 0 THEN 'EXACT'
                    WHEN 1 THEN 'PHRASE' ELSE '' END""",
            }
        ),
        *_LINE_FIGURES,
        "CAST(l_quantity AS BIGINT) AS clicks",
        """if(l_returnflag = 'A' AND ascii(p_name) >= 109, CAST(l_linenumber AS DOUBLE), 0D)
           AS conversions""",
        f"if(l_returnflag = 'A', {_ORDER_VALUE}, NULL) AS conversion_value",
    )


def search_term_ties() -> list[Column]:
    return [
        F.desc("_seq"),
        F.desc("spend"),
        F.desc("impressions"),
        F.desc("conversions"),
        F.desc_nulls_last("conversion_value"),
        F.asc("search_term_status"),
        F.asc("campaign_id"),
    ]


# Action lists of the derived insights. `{}` is a slot.
CLICK_ACTIONS = '[{"action_type":"link_click","value":"9"},{"action_type":"lead","value":"2"}]'
PURCHASE_ACTIONS = (
    '[{"action_type":"purchase","value":"{}"},{"action_type":"post_engagement","value":"3"},'
    '{"value":"8"},{"action_type":"lead"}]'
)


def meta_ads_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    before, after = PURCHASE_ACTIONS.split("{}")
    return table(spark, sf_dir, "events").selectExpr(
        *_texts(
            {
                "account_id": "user_id % 4",
                "account_name": "concat('Account ', user_id % 4)",
                "campaign_id": "user_id % 12",
                "campaign_name": "concat('Meta ', user_id % 12)",
                "ad_id": "user_id",
                "ad_name": "concat('Ad ', user_id)",
                "device_platform": "if(event_id % 2 = 0, 'mobile', 'desktop')",
                "publisher_platform": "event_type",
                "actions": f"""CASE event_type WHEN 'error' THEN NULL WHEN 'signup' THEN ''
                    WHEN 'view' THEN '[]' WHEN 'click' THEN '{CLICK_ACTIONS}'
                    ELSE concat('{before}', event_id % 5, '{after}') END""",
            }
        ),
        "event_id % 500 AS impressions",
        "if(event_id % 17 = 0, NULL, event_id % 40) AS clicks",
        "value AS spend",
        "CAST(ts AS DATE) AS date_start",
        "ts AS _extracted_at",
        "event_id AS _seq",
    )


def newest_seq() -> list[Column]:
    return [F.desc("_seq")]


def google_negatives_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(
        *_texts(
            {
                "customer_id": "p_partkey % 4",
                "campaign_id": "p_partkey % 3",
                "campaign_name": "concat('Campaign ', p_partkey % 3)",
                "ad_group_id": "if(p_size % 2 = 0, '', CAST(p_size % 3 AS STRING))",
                "ad_group_name": "if(p_size % 2 = 0, '', concat('AdGroup ', p_size % 3))",
                "criterion_id": "p_partkey % 50",
                "criterion_text": "if(p_partkey % 50 = 13, '', p_name)",
                "match_type": "'BROAD'",
                "scope": "if(p_size % 2 = 0, 'campaign', 'ad_group')",
            }
        ),
        "if(p_partkey % 7 < 3, DATE '2024-01-29', DATE '2024-01-30') AS snapshot_date",
        "TIMESTAMP_NTZ '2024-01-30 00:00:00' AS _extracted_at",
        "p_partkey AS _seq",
    )


def client_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One budget per account and platform; every customer falls into one of them."""
    slots = table(spark, sf_dir, "customer").selectExpr("c_custkey % 12 AS slot").distinct()
    return slots.selectExpr(
        "CAST(slot % 6 AS STRING) AS account_id",
        "if(slot < 6, 'google_ads', 'meta_ads') AS platform",
        """CAST(if(slot < 6, 150000000 * (slot + 1), 60000 + (slot - 6) * 60000)
           AS DECIMAL(14,2)) AS monthly_budget""",
        "'BRL' AS currency",
        "slot <> 5 AS active",
    )
