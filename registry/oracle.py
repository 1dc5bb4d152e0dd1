"""The registered queries as plain SQL over the given tables.

Written from the meaning of each query, not from its Spark plan: nested common
table expressions, window de-duplication, decimal sums and numeric rounding.
"""

from __future__ import annotations

import re


def dsum(x: str) -> str:
    """Sum of an amount to twelve decimals; within its binary rounding of six, it is that amount."""
    value = f"CAST({x} AS DOUBLE)"
    millionths = f"(({value} - FLOOR({value})) * 1e6)"
    even = f"ABS({millionths} - ROUND({millionths})) <= ABS({value}) * 1e6 * 4.5e-16"
    places = f"CASE WHEN {even} THEN CAST({value} AS DECIMAL(28,6)) END"
    return f"CAST(SUM(COALESCE(CAST({places} AS DECIMAL(28,12)), CAST({value} AS DECIMAL(28,12)))) AS DOUBLE)"


def davg(x: str) -> str:
    return f"{dsum(x)} / NULLIF(COUNT({x}), 0)"


def isum(x: str) -> str:
    return f"CAST(SUM({x}) AS BIGINT)"


def rnd(x: str, k: int) -> str:
    """SQL numeric rounding."""
    return f"CAST(ROUND(CAST({x} AS DECIMAL(38,10)), {k}) AS DOUBLE)"


def pyround(x: str, k: int) -> str:
    """Rounding of the exact binary value."""
    return f"CAST(printf('%.{k}f', {x}) AS DOUBLE)"


START, END, AS_OF = "DATE '2024-01-01'", "DATE '2024-01-20'", "DATE '2024-01-20'"
IN_PERIOD = f"date BETWEEN {START} AND {END}"

GOOGLE_TIES = """_extracted_at DESC NULLS FIRST, _seq DESC, spend DESC, impressions DESC,
    conversions DESC, conversion_value DESC NULLS LAST, match_type, ad_group_id,
    campaign_status, clicks DESC NULLS LAST, ad_group_status"""
TERM_TIES = """_extracted_at DESC NULLS FIRST, _seq DESC, spend DESC, impressions DESC,
    conversions DESC, conversion_value DESC NULLS LAST, search_term_status, campaign_id"""
SEQ_TIES = "_extracted_at DESC NULLS FIRST, _seq DESC"
NATURAL = "date, customer_id, campaign_id, ad_group_id, keyword_id, device"


def latest(source: str, keys: str, ties: str, where: str = "TRUE") -> str:
    return f"""SELECT * FROM (
        SELECT *, ROW_NUMBER() OVER (PARTITION BY {keys} ORDER BY {ties}) AS rn
        FROM {source} WHERE {where}) ranked WHERE rn = 1"""


def google_rollup(source: str) -> str:
    return f"""SELECT customer_id AS account_id, customer_name AS account_name, campaign_id,
        campaign_name, CAST(NULL AS VARCHAR) AS ad_id, CAST(NULL AS VARCHAR) AS ad_name, device,
        {isum('COALESCE(impressions, 0)')} AS impressions,
        {isum('COALESCE(clicks, 0)')} AS clicks,
        {dsum('COALESCE(spend, 0)')} AS spend, date,
        {dsum('COALESCE(conversions, 0)')} AS conversions,
        {dsum('COALESCE(conversion_value, 0)')} AS conversion_value,
        {dsum('COALESCE(view_through_conversions, 0)')} AS view_through_conversions,
        {dsum('COALESCE(all_conversions, 0)')} AS all_conversions,
        {davg('search_impression_share')} AS search_impression_share,
        AVG(quality_score) AS quality_score,
        MAX(campaign_status) AS campaign_status, MAX(ad_group_status) AS ad_group_status,
        CAST(NULL AS VARCHAR) AS actions_raw, MAX(_extracted_at) AS _extracted_at,
        'google_ads' AS platform
    FROM {source}
    GROUP BY customer_id, customer_name, campaign_id, campaign_name, device, date"""


def campaign_day(source: str, value: str) -> str:
    return f"""SELECT account_id, account_name, campaign_id, campaign_name, date, platform,
        {isum('impressions')} AS impressions, {isum('clicks')} AS clicks,
        {dsum('spend')} AS spend, {dsum('conversions')} AS conversions,
        {value} AS conversion_value
    FROM {source}
    GROUP BY account_id, account_name, campaign_id, campaign_name, date, platform"""


KPIS = f"""
    {rnd('clicks * 100.0e0 / NULLIF(impressions, 0)', 2)} AS ctr,
    {rnd('spend / NULLIF(clicks, 0)', 2)} AS cpc,
    {rnd('spend / NULLIF(conversions, 0)', 2)} AS cost_per_conversion,
    {rnd('conversions * 100.0e0 / NULLIF(clicks, 0)', 2)} AS conversion_rate"""
ROAS = f"{rnd('conversion_value / NULLIF(spend, 0)', 4)} AS roas"
ROW_ROAS = f"{pyround('conversion_value / NULLIF(spend, 0)', 4)} AS roas"
TOTALS = f"""{isum('impressions')} AS impressions, {isum('clicks')} AS clicks,
    {dsum('spend')} AS spend, {dsum('conversions')} AS conversions,
    {dsum('conversion_value')} AS conversion_value"""

ELAPSED = "20 * 100.0e0 / 31"
CONSUMED = "spent * 100.0e0 / NULLIF(budget, 0)"


def pacing(last_day: str) -> str:
    return f"""SELECT account_id, platform, budget AS monthly_budget, currency,
        {rnd('spent', 2)} AS spent_mtd, {rnd(CONSUMED, 2)} AS pct_consumed,
        {rnd(ELAPSED, 2)} AS days_elapsed_pct,
        CASE WHEN budget = 0 THEN 'unknown'
             WHEN {CONSUMED} > {ELAPSED} + 10 THEN 'over'
             WHEN {CONSUMED} < {ELAPSED} - 10 THEN 'under'
             ELSE 'on_track' END AS pace_flag
    FROM (
        SELECT b.account_id, b.platform, CAST(b.monthly_budget AS DOUBLE) AS budget, b.currency,
               COALESCE(s.spent, 0) AS spent
        FROM client_budget b
        LEFT JOIN (
            SELECT account_id, platform, {dsum('spend')} AS spent FROM daily
            WHERE date BETWEEN DATE '2024-01-01' AND {last_day}
            GROUP BY account_id, platform) s
          ON s.account_id = b.account_id AND s.platform = b.platform
        WHERE b.active) joined"""


def ranked(source: str, order: str, k: int, where: str = "TRUE") -> str:
    return f"""SELECT * FROM (
        SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY account_id ORDER BY {order}) AS INTEGER)
               AS position
        FROM {source} WHERE {where}) r WHERE position <= {k}"""


def named_list(source: str, place: str, where: str) -> str:
    """Count and first five names per account."""
    return f"""SELECT account_id, COUNT(*) AS n,
        string_agg(campaign_name, ', ' ORDER BY place) FILTER (WHERE place <= 5) AS names
    FROM (SELECT account_id, campaign_name,
                 ROW_NUMBER() OVER (PARTITION BY account_id ORDER BY {place}) AS place
          FROM {source} WHERE {where} AND campaign_name <> '') x
    GROUP BY account_id"""


LATE = "_extracted_at >= TIMESTAMP '2000-06-01 00:00:00'"

CTES: dict[str, str] = {
    "google_ads_raw": """SELECT
        CAST(o.o_custkey % 4 AS VARCHAR) AS customer_id,
        CONCAT('Account ', CAST(o.o_custkey % 4 AS VARCHAR)) AS customer_name,
        CAST(l.l_suppkey % 5 AS VARCHAR) AS campaign_id,
        CONCAT('Campaign ', CAST(l.l_suppkey % 5 AS VARCHAR)) AS campaign_name,
        CASE l.l_returnflag WHEN 'A' THEN 'ENABLED' WHEN 'N' THEN 'PAUSED' ELSE 'REMOVED' END
            AS campaign_status,
        CAST((l.l_suppkey % 5) * 10 + l.l_linenumber % 3 AS VARCHAR) AS ad_group_id,
        CONCAT('AdGroup ', CAST(l.l_linenumber % 3 AS VARCHAR)) AS ad_group_name,
        CASE l.l_linestatus WHEN 'O' THEN 'ENABLED' ELSE 'PAUSED' END AS ad_group_status,
        CAST(l.l_partkey % 40 AS VARCHAR) AS keyword_id,
        'ENABLED' AS criterion_status,
        CASE WHEN l.l_partkey % 40 = 7 THEN '' WHEN l.l_partkey % 40 = 8 THEN NULL
             ELSE CONCAT('kw ', CAST((l.l_partkey % 40) % 25 AS VARCHAR)) END AS keyword_text,
        CASE l.l_partkey % 3 WHEN 0 THEN 'EXACT' WHEN 1 THEN 'PHRASE' ELSE 'BROAD' END
            AS match_type,
        CASE l.l_linestatus WHEN 'O' THEN 'MOBILE' ELSE 'DESKTOP' END AS device,
        CAST(l.l_quantity * 20 AS BIGINT) AS impressions,
        CASE WHEN l.l_tax = 0 THEN NULL ELSE CAST(l.l_quantity AS BIGINT) END AS clicks,
        CASE WHEN l.l_discount = 0 THEN 0.0e0 ELSE l.l_extendedprice END AS spend,
        CASE WHEN l.l_returnflag = 'R' OR l.l_suppkey % 5 = 4 THEN 0.0e0
             ELSE CAST(l.l_linenumber AS DOUBLE) END AS conversions,
        CASE WHEN l.l_returnflag = 'R' THEN NULL
             WHEN o.o_custkey % 4 = 3 THEN o.o_totalprice / 50
             ELSE o.o_totalprice END AS conversion_value,
        CAST(l.l_linenumber % 2 AS DOUBLE) AS view_through_conversions,
        CAST(l.l_linenumber AS DOUBLE) AS all_conversions,
        l.l_discount AS search_impression_share,
        CAST(l.l_partkey % 10 AS INT) AS quality_score,
        CAST(DATE '2024-01-01' + CAST(l.l_orderkey % 30 AS INT) AS DATE) AS date,
        o.o_orderdate AS _extracted_at, l.l_orderkey AS _seq
    FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey""",
    "google_search_terms_raw": """SELECT
        CAST(o.o_custkey % 4 AS VARCHAR) AS customer_id,
        CONCAT('Account ', CAST(o.o_custkey % 4 AS VARCHAR)) AS customer_name,
        CAST(l.l_suppkey % 5 AS VARCHAR) AS campaign_id,
        CONCAT('Campaign ', CAST(l.l_suppkey % 5 AS VARCHAR)) AS campaign_name,
        CAST((l.l_suppkey % 5) * 10 + l.l_linenumber % 3 AS VARCHAR) AS ad_group_id,
        CONCAT('AdGroup ', CAST(l.l_linenumber % 3 AS VARCHAR)) AS ad_group_name,
        CASE WHEN l.l_partkey % 97 = 0 THEN '' ELSE p.p_name END AS search_term,
        CASE l.l_returnflag WHEN 'A' THEN 'ADDED' WHEN 'N' THEN 'NONE' ELSE 'EXCLUDED' END
            AS search_term_status,
        CASE WHEN p.p_type = 'ECONOMY' THEN NULL ELSE p.p_type END AS matched_keyword_text,
        CASE l.l_partkey % 3 WHEN 0 THEN 'EXACT' WHEN 1 THEN 'PHRASE' ELSE '' END
            AS matched_keyword_match_type,
        CAST(l.l_quantity * 20 AS BIGINT) AS impressions,
        CAST(l.l_quantity AS BIGINT) AS clicks,
        CASE WHEN l.l_discount = 0 THEN 0.0e0 ELSE l.l_extendedprice END AS spend,
        CASE WHEN l.l_returnflag = 'A' AND ascii(p.p_name) >= 109
             THEN CAST(l.l_linenumber AS DOUBLE) ELSE 0.0e0 END AS conversions,
        CASE WHEN l.l_returnflag <> 'A' THEN NULL
             WHEN o.o_custkey % 4 = 3 THEN o.o_totalprice / 50
             ELSE o.o_totalprice END AS conversion_value,
        CAST(DATE '2024-01-01' + CAST(l.l_orderkey % 30 AS INT) AS DATE) AS date,
        o.o_orderdate AS _extracted_at, l.l_orderkey AS _seq
    FROM lineitem l
    JOIN orders o ON o.o_orderkey = l.l_orderkey
    JOIN part p ON p.p_partkey = l.l_partkey""",
    "meta_ads_raw": """SELECT
        CAST(user_id % 4 AS VARCHAR) AS account_id,
        CONCAT('Account ', CAST(user_id % 4 AS VARCHAR)) AS account_name,
        CAST(user_id % 12 AS VARCHAR) AS campaign_id,
        CONCAT('Meta ', CAST(user_id % 12 AS VARCHAR)) AS campaign_name,
        CAST(user_id AS VARCHAR) AS ad_id, CONCAT('Ad ', CAST(user_id AS VARCHAR)) AS ad_name,
        CAST(event_id % 500 AS BIGINT) AS impressions,
        CASE WHEN event_id % 17 = 0 THEN NULL ELSE CAST(event_id % 40 AS BIGINT) END AS clicks,
        value AS spend, CAST(ts AS DATE) AS date_start,
        CASE event_type WHEN 'error' THEN NULL WHEN 'signup' THEN '' WHEN 'view' THEN '[]'
            WHEN 'click' THEN '[{"action_type":"link_click","value":"9"},{"action_type":"lead","value":"2"}]'
            ELSE CONCAT('[{"action_type":"purchase","value":"', CAST(event_id % 5 AS VARCHAR),
                '"},{"action_type":"post_engagement","value":"3"},{"value":"8"},{"action_type":"lead"}]')
            END AS actions,
        CASE WHEN event_id % 2 = 0 THEN 'mobile' ELSE 'desktop' END AS device_platform,
        event_type AS publisher_platform, ts AS _extracted_at, event_id AS _seq
    FROM events""",
    "google_negatives_raw": """SELECT
        CAST(p_partkey % 4 AS VARCHAR) AS customer_id,
        CAST(p_partkey % 3 AS VARCHAR) AS campaign_id,
        CONCAT('Campaign ', CAST(p_partkey % 3 AS VARCHAR)) AS campaign_name,
        CASE WHEN p_size % 2 = 0 THEN '' ELSE CAST(p_size % 3 AS VARCHAR) END AS ad_group_id,
        CASE WHEN p_size % 2 = 0 THEN ''
             ELSE CONCAT('AdGroup ', CAST(p_size % 3 AS VARCHAR)) END AS ad_group_name,
        CAST(p_partkey % 50 AS VARCHAR) AS criterion_id,
        CASE WHEN p_partkey % 50 = 13 THEN '' ELSE p_name END AS criterion_text,
        'BROAD' AS match_type,
        CASE WHEN p_size % 2 = 0 THEN 'campaign' ELSE 'ad_group' END AS scope,
        CASE WHEN p_partkey % 7 < 3 THEN DATE '2024-01-29' ELSE DATE '2024-01-30' END
            AS snapshot_date,
        CAST(DATE '2024-01-30' AS TIMESTAMP) AS _extracted_at, p_partkey AS _seq
    FROM part""",
    "client_budget": """SELECT CAST(slot % 6 AS VARCHAR) AS account_id,
        CASE WHEN slot < 6 THEN 'google_ads' ELSE 'meta_ads' END AS platform,
        CAST(CASE WHEN slot < 6 THEN 150000000 * (slot + 1) ELSE 60000 + (slot - 6) * 60000 END
            AS DECIMAL(14,2)) AS monthly_budget,
        'BRL' AS currency, slot <> 5 AS active
    FROM (SELECT DISTINCT c_custkey % 12 AS slot FROM customer) slots""",
    "google_latest": latest(
        "google_ads_raw", "customer_id, campaign_id, keyword_id, device, date", GOOGLE_TIES
    ),
    "google_latest_ag": latest(
        "google_ads_raw",
        "customer_id, campaign_id, ad_group_id, keyword_id, device, date",
        GOOGLE_TIES,
    ),
    "keyword_latest": latest(
        "google_ads_raw",
        "customer_id, campaign_id, ad_group_id, keyword_id, device, date",
        GOOGLE_TIES,
        "keyword_text IS NOT NULL AND keyword_text <> ''",
    ),
    "term_latest": latest(
        "google_search_terms_raw",
        """customer_id, ad_group_id, search_term, COALESCE(matched_keyword_text, ''),
           COALESCE(matched_keyword_match_type, ''), date""",
        TERM_TIES,
        "search_term IS NOT NULL AND search_term <> ''",
    ),
    "negative_latest": latest(
        "google_negatives_raw",
        """snapshot_date, customer_id, scope, criterion_id, COALESCE(ad_group_id, ''),
           COALESCE(campaign_id, '')""",
        SEQ_TIES,
        "criterion_text IS NOT NULL AND criterion_text <> ''",
    ),
    "meta_latest": latest(
        "meta_ads_raw", "account_id, ad_id, device_platform, publisher_platform, date_start", SEQ_TIES
    ),
    "s_google": google_rollup("google_latest"),
    "s_google_ag": google_rollup("google_latest_ag"),
    "s_keywords": f"""SELECT customer_id AS account_id, customer_name AS account_name, campaign_id,
        campaign_name, ad_group_id, ad_group_name, keyword_id, keyword_text, match_type, date,
        {isum('COALESCE(impressions, 0)')} AS impressions,
        {isum('COALESCE(clicks, 0)')} AS clicks,
        {dsum('COALESCE(spend, 0)')} AS spend,
        {dsum('COALESCE(conversions, 0)')} AS conversions,
        {dsum('COALESCE(conversion_value, 0)')} AS conversion_value,
        AVG(quality_score) AS quality_score,
        MAX(campaign_status) AS campaign_status, MAX(ad_group_status) AS ad_group_status,
        MAX(criterion_status) AS criterion_status, MAX(_extracted_at) AS _extracted_at,
        'google_ads' AS platform
    FROM keyword_latest
    GROUP BY customer_id, customer_name, campaign_id, campaign_name, ad_group_id, ad_group_name,
             keyword_id, keyword_text, match_type, date""",
    "s_terms": """SELECT customer_id AS account_id, customer_name AS account_name, campaign_id,
        campaign_name, ad_group_id, ad_group_name, search_term, search_term_status,
        matched_keyword_text, matched_keyword_match_type, date,
        COALESCE(impressions, 0) AS impressions, COALESCE(clicks, 0) AS clicks,
        COALESCE(spend, 0) AS spend, COALESCE(conversions, 0) AS conversions,
        COALESCE(conversion_value, 0) AS conversion_value, _extracted_at,
        'google_ads' AS platform
    FROM term_latest""",
    "s_negatives": """SELECT customer_id AS account_id, campaign_id, campaign_name, ad_group_id,
        ad_group_name, criterion_id, criterion_text, match_type, scope, snapshot_date,
        _extracted_at, 'google_ads' AS platform
    FROM negative_latest""",
    "s_meta": """SELECT account_id, account_name, campaign_id, campaign_name, ad_id, ad_name,
        COALESCE(impressions, 0) AS impressions, COALESCE(clicks, 0) AS clicks,
        COALESCE(spend, 0) AS spend, date_start AS date, device_platform, publisher_platform,
        COALESCE((
            SELECT SUM(CAST(elem ->> 'value' AS DOUBLE))
            FROM (SELECT UNNEST(CAST(CASE WHEN actions IS NULL OR actions = '' THEN '[]'
                                          ELSE actions END AS JSON[])) AS elem) a
            WHERE (elem ->> 'action_type') NOT IN
                ('link_click', 'landing_page_view', 'page_engagement', 'post_engagement')
        ), 0.0) AS conversions,
        actions AS actions_raw, _extracted_at, 'meta_ads' AS platform
    FROM meta_latest""",
    "unified": campaign_day("s_meta", "0.0e0")
    + " UNION ALL "
    + campaign_day("s_google", dsum("COALESCE(conversion_value, 0)")),
    "daily": f"""SELECT *, {KPIS}, {ROAS} FROM (
        SELECT account_id, account_name, date, platform, {TOTALS} FROM unified
        GROUP BY account_id, account_name, date, platform) t WHERE spend > 0""",
    "weekly": f"""SELECT *, {KPIS} FROM (
        SELECT account_id, account_name, platform,
            CAST(DATE_TRUNC('week', date) AS DATE) AS week_start,
            MIN(date) AS period_start, MAX(date) AS period_end,
            {isum('impressions')} AS impressions, {isum('clicks')} AS clicks,
            {dsum('spend')} AS spend, {dsum('conversions')} AS conversions
        FROM unified
        GROUP BY account_id, account_name, platform, DATE_TRUNC('week', date)) t
        WHERE spend > 0""",
    "g_keywords": f"""SELECT *, {ROAS} FROM (
        SELECT account_id, account_name, campaign_name, ad_group_name, keyword_text, match_type,
            date, {TOTALS}, {davg('quality_score')} AS quality_score,
            MAX(campaign_status) AS campaign_status, MAX(ad_group_status) AS ad_group_status,
            MAX(criterion_status) AS criterion_status
        FROM s_keywords
        GROUP BY account_id, account_name, campaign_name, ad_group_name, keyword_text,
                 match_type, date) t WHERE spend > 0""",
    "g_terms": f"""SELECT *, {ROAS} FROM (
        SELECT account_id, account_name, campaign_name, ad_group_name, search_term,
            search_term_status, matched_keyword_text, matched_keyword_match_type, date, {TOTALS}
        FROM s_terms
        GROUP BY account_id, account_name, campaign_name, ad_group_name, search_term,
                 search_term_status, matched_keyword_text, matched_keyword_match_type, date) t
        WHERE spend > 0""",
    "g_negatives": """SELECT account_id, campaign_id, campaign_name, ad_group_id, ad_group_name,
        criterion_id, criterion_text, match_type, scope, snapshot_date
    FROM s_negatives WHERE snapshot_date = (SELECT MAX(snapshot_date) FROM s_negatives)""",
    "g_negatives_acc": """SELECT n.account_id, campaign_id, campaign_name, ad_group_id,
        ad_group_name, criterion_id, criterion_text, match_type, scope, n.snapshot_date
    FROM s_negatives n
    JOIN (SELECT account_id, MAX(snapshot_date) AS newest FROM s_negatives GROUP BY account_id) x
      ON x.account_id = n.account_id AND x.newest = n.snapshot_date""",
    "pacing": pacing("DATE '2024-01-31'"),
    "pacing_capped": pacing(AS_OF),
    "overview": """SELECT account_id, MAX(account_name) AS account_name,
        MIN(platform) AS platform FROM daily GROUP BY account_id""",
    "performance": f"""SELECT account_id, impressions, clicks, spend, conversions,
        conversion_value,
        {pyround('clicks / NULLIF(CAST(impressions AS DOUBLE), 0) * 100', 2)} AS ctr,
        {pyround('spend / NULLIF(clicks, 0)', 2)} AS cpc,
        {pyround('spend / NULLIF(conversions, 0)', 2)} AS cpa, {ROW_ROAS}
    FROM (
        SELECT o.account_id, COALESCE({isum('impressions')}, 0) AS impressions,
            COALESCE({isum('clicks')}, 0) AS clicks, COALESCE({dsum('spend')}, 0) AS spend,
            COALESCE({dsum('conversions')}, 0) AS conversions,
            COALESCE({dsum('conversion_value')}, 0) AS conversion_value
        FROM overview o
        LEFT JOIN daily d ON d.account_id = o.account_id AND d.{IN_PERIOD}
        GROUP BY o.account_id) t""",
    "campaigns": f"""SELECT *, {ROW_ROAS} FROM (
        SELECT account_id, campaign_name, MAX(campaign_status) AS status, {dsum('spend')} AS spend,
            {dsum('conversions')} AS conversions, {dsum('conversion_value')} AS conversion_value
        FROM g_keywords WHERE {IN_PERIOD} GROUP BY account_id, campaign_name) t""",
    "keyword_totals": f"""SELECT *, {ROW_ROAS} FROM (
        SELECT account_id, keyword_text, MAX(match_type) AS match_type,
            MAX(campaign_name) AS campaign_name, MAX(ad_group_name) AS ad_group_name, {TOTALS},
            {davg('quality_score')} AS quality_score
        FROM g_keywords WHERE {IN_PERIOD} GROUP BY account_id, keyword_text) t""",
    "top_kw": ranked("keyword_totals", "spend DESC, keyword_text", 20),
    "term_totals": f"""SELECT *, {ROW_ROAS} FROM (
        SELECT account_id, search_term, MAX(campaign_name) AS campaign_name,
            MAX(ad_group_name) AS ad_group_name,
            MAX(matched_keyword_text) AS matched_keyword_text,
            MAX(matched_keyword_match_type) AS matched_keyword_match_type,
            MAX(search_term_status) AS status, {TOTALS}
        FROM g_terms WHERE {IN_PERIOD} GROUP BY account_id, search_term) t""",
    "wasted": ranked("term_totals", "spend DESC, search_term", 15, "conversions = 0"),
    "winners": "SELECT * FROM ("
    + ranked(
        "term_totals",
        "conversion_value / NULLIF(spend, 0) DESC NULLS LAST, search_term",
        15,
    )
    + ") w WHERE roas > 1.0",
    "neg_totals": """SELECT account_id, COUNT(*) AS total_negatives FROM g_negatives
        GROUP BY account_id""",
    "uncovered": f"""SELECT DISTINCT k.account_id, k.campaign_name FROM g_keywords k
        WHERE k.{IN_PERIOD} AND k.campaign_name <> '' AND NOT EXISTS (
            SELECT 1 FROM g_negatives n WHERE n.account_id = k.account_id
              AND n.campaign_name = k.campaign_name)""",
    "first_pacing": """SELECT * FROM (
        SELECT *, ROW_NUMBER() OVER (PARTITION BY account_id ORDER BY platform) AS rn
        FROM pacing) p WHERE rn = 1""",
    "rev_pacing": """SELECT o.account_id, monthly_budget, currency,
        COALESCE(spent_mtd, 0) AS spent_mtd, pct_consumed, days_elapsed_pct,
        COALESCE(pace_flag, 'unknown') AS pace_flag
    FROM overview o LEFT JOIN first_pacing p ON p.account_id = o.account_id""",
    "zero_list": named_list(
        "campaigns", "spend DESC, campaign_name", "spend >= 50 AND conversions = 0"
    ),
    "uncovered_list": named_list("uncovered", "campaign_name", "TRUE"),
    "wasted_sum": f"""SELECT account_id, COUNT(*) AS n, {dsum('spend')} AS total FROM wasted
        GROUP BY account_id""",
    "fired": """
        SELECT account_id, 1 AS rule, 'roas_below_one' AS code, 'critical' AS severity,
            'ROAS de ' || printf('%.2f', roas) || ' com spend R$ ' || printf('%.2f', spend) ||
            ' — a conta está gastando mais do que fatura em conversão atribuída.' AS message
        FROM performance WHERE roas IS NOT NULL AND spend >= 50 AND roas < 1.0
        UNION ALL
        SELECT account_id, 2, 'budget_over_pace', 'warning',
            'Spend do mês em ' || printf('%.1f', pct_consumed) || '% com apenas ' ||
            printf('%.1f', days_elapsed_pct) || '% do mês decorrido.'
        FROM rev_pacing WHERE pace_flag = 'over' AND pct_consumed IS NOT NULL
        UNION ALL
        SELECT account_id, 3, 'budget_under_pace', 'info',
            'Spend do mês em ' || printf('%.1f', pct_consumed) || '% com ' ||
            printf('%.1f', days_elapsed_pct) || '% do mês decorrido — veicular mais.'
        FROM rev_pacing WHERE pace_flag = 'under' AND pct_consumed IS NOT NULL
        UNION ALL
        SELECT z.account_id, 4, 'campaigns_with_zero_conversions', 'warning',
            z.n || ' campanhas com spend sem nenhuma conversão: ' || z.names
        FROM zero_list z JOIN overview o ON o.account_id = z.account_id
        UNION ALL
        SELECT w.account_id, 5, 'search_terms_wasting_spend', 'warning',
            w.n || ' search terms com R$ ' || printf('%.2f', w.total) ||
            ' de spend sem conversão — candidatos a negativa.'
        FROM wasted_sum w JOIN overview o ON o.account_id = w.account_id WHERE w.n >= 5
        UNION ALL
        SELECT u.account_id, 6, 'campaigns_without_negatives', 'info',
            u.n || ' campanhas sem negativas: ' || u.names
        FROM uncovered_list u JOIN overview o ON o.account_id = u.account_id""",
    "google_latest_stored": latest("google_ads_raw", NATURAL, GOOGLE_TIES.replace(" _seq DESC,", "")),
    "merge_target": latest("google_ads_raw", NATURAL, GOOGLE_TIES, f"NOT ({LATE})"),
    "merge_batch": latest("google_ads_raw", NATURAL, GOOGLE_TIES, LATE),
    "managed": """SELECT CAST(s_suppkey % 500 AS VARCHAR) AS account_id,
        CASE WHEN s_nationkey % 2 = 0 THEN 'google_ads' ELSE 'meta_ads' END AS platform,
        s_name AS account_name, CAST(CASE WHEN s_acctbal > 0 THEN 1 ELSE 0 END AS SMALLINT) AS enabled
    FROM supplier""",
    "accounts": "SELECT DISTINCT CAST(o_custkey % 4 AS VARCHAR) AS account_id FROM orders",
    "load_plan": """SELECT CAST(d AS DATE) AS date, account_id
        FROM generate_series(DATE '2024-01-28', DATE '2024-02-02', INTERVAL 1 DAY) g(d), accounts""",
    "load_failed": """SELECT * FROM load_plan WHERE date = DATE '2024-01-31'
        OR (date = DATE '2024-01-29' AND account_id = '1')""",
    "load_missing": """SELECT * FROM load_plan p WHERE NOT EXISTS (
        SELECT 1 FROM google_ads_raw r WHERE r.date = p.date AND r.customer_id = p.account_id)""",
    "users": """SELECT CAST(c_custkey AS INTEGER) AS id,
        CONCAT(LOWER(c_name), '@example.com') AS email, c_name AS name,
        CASE WHEN c_nationkey % 5 = 0 THEN 'admin' ELSE 'user' END AS role,
        TIMESTAMP '2024-01-01 00:00:00' AS created_at,
        CASE WHEN c_acctbal < 0 THEN TIMESTAMP '2024-01-10 00:00:00' END AS disabled_at
    FROM customer""",
    "api_keys": """SELECT CAST(o_orderkey AS INTEGER) AS id,
        CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(o_custkey AS INTEGER) END AS user_id,
        CASE WHEN o_orderstatus <> 'P' THEN TIMESTAMP '2023-12-22 00:00:00'
             + to_days(CAST(o_orderkey % 30 AS INTEGER)) + to_hours(o_orderkey % 24) END
            AS last_used_at,
        CASE WHEN o_totalprice > 400000 THEN o_orderdate END AS revoked_at
    FROM orders""",
}


def with_ctes(final: str) -> str:
    """Prefix a query with the common table expressions it needs."""
    needed: list[str] = []

    def visit(sql: str) -> None:
        for word in dict.fromkeys(re.findall(r"[a-z_]+", sql)):
            if word in CTES and word not in needed:
                visit(CTES[word])
                needed.append(word)

    visit(final)
    if not needed:
        return final
    return "WITH " + ",\n".join(f"{name} AS ({CTES[name]})" for name in needed) + "\n" + final


DAILY_COLUMNS = """account_id, account_name, date, platform, impressions, clicks, spend,
    conversions, ctr, cpc, cost_per_conversion, conversion_rate"""
MERGED = """date, customer_id, campaign_id, ad_group_id, keyword_id, device, impressions, clicks,
    spend, match_type, _extracted_at"""
KEY_MATCH = " AND ".join(f"t.{key.strip()} = b.{key.strip()}" for key in NATURAL.split(","))
UPSERTED = f"""SELECT {MERGED} FROM merge_target t WHERE NOT EXISTS (
    SELECT 1 FROM merge_batch b WHERE {KEY_MATCH})
    UNION ALL SELECT {MERGED} FROM merge_batch"""


def daily_rows(platform: str, start: str, end: str, where: str = "TRUE") -> str:
    return f"""SELECT {DAILY_COLUMNS} FROM daily WHERE platform = '{platform}'
        AND date BETWEEN DATE '{start}' AND DATE '{end}' AND {where}"""


def check(model: str, name: str, column: str, broken: str, source: str) -> str:
    return f"""SELECT '{model}' AS model, '{name}' AS "check", '{column}' AS "column",
        COUNT(*) FILTER (WHERE {broken}) AS failures FROM {source}"""


def nulls(model: str, source: str, *columns: str) -> list[str]:
    return [check(model, "not_null", name, f"{name} IS NULL", source) for name in columns]


def not_unique(model: str, source: str, keys: str) -> str:
    return f"""SELECT '{model}' AS model, 'unique_combination' AS "check",
        '{keys.replace(" ", "")}' AS "column", COUNT(*) AS failures
        FROM (SELECT 1 FROM {source} GROUP BY {keys} HAVING COUNT(*) > 1) r"""


PLATFORM_OUTSIDE = "platform NOT IN ('google_ads', 'meta_ads')"
KEYWORD_KEYS = "account_id, keyword_text, ad_group_name, campaign_name, date"
TERM_KEYS = """account_id, ad_group_name, search_term, matched_keyword_text,
    matched_keyword_match_type, date""".replace("\n    ", " ")

SCOPE_OUTSIDE = "scope NOT IN ('campaign', 'ad_group')"
ACCEPTED = "accepted_values"
FIGURES = ("impressions", "clicks", "spend")


def expression(model: str, column: str, condition: str, source: str) -> str:
    return check(model, "expression_is_true", column, f"NOT {column} {condition}", source)


DQ_GOLD = [
    *nulls("gold.daily_performance", "daily", "account_id", "date", "platform", "impressions", "spend"),
    check("gold.daily_performance", ACCEPTED, "platform", PLATFORM_OUTSIDE, "daily"),
    expression("gold.daily_performance", "spend", ">= 0", "daily"),
    not_unique("gold.daily_performance", "daily", "account_id, date, platform"),
    *nulls("gold.weekly_performance", "weekly", "account_id", "week_start", "platform", "spend"),
    check("gold.weekly_performance", ACCEPTED, "platform", PLATFORM_OUTSIDE, "weekly"),
    expression("gold.weekly_performance", "spend", ">= 0", "weekly"),
    not_unique("gold.weekly_performance", "weekly", "account_id, week_start, platform"),
    *nulls("gold.google_ads_keywords", "g_keywords", "account_id", "keyword_text", "date", "spend"),
    expression("gold.google_ads_keywords", "spend", "> 0", "g_keywords"),
    not_unique("gold.google_ads_keywords", "g_keywords", KEYWORD_KEYS),
    *nulls("gold.google_search_terms", "g_terms", "account_id", "search_term", "date", "spend"),
    expression("gold.google_search_terms", "spend", "> 0", "g_terms"),
    not_unique("gold.google_search_terms", "g_terms", TERM_KEYS),
    *nulls("gold.google_negatives", "g_negatives", "account_id", "criterion_id", "scope"),
    check("gold.google_negatives", ACCEPTED, "scope", SCOPE_OUTSIDE, "g_negatives"),
    *nulls("gold.budget_pacing", "pacing", "account_id", "platform", "pace_flag"),
    check("gold.budget_pacing", ACCEPTED, "platform", PLATFORM_OUTSIDE, "pacing"),
    check(
        "gold.budget_pacing",
        ACCEPTED,
        "pace_flag",
        "pace_flag NOT IN ('over', 'under', 'on_track', 'unknown')",
        "pacing",
    ),
]

DQ_SILVER = [
    *nulls("silver.google_ads", "s_google", "account_id", "campaign_id", "date", "platform", *FIGURES),
    check("silver.google_ads", ACCEPTED, "platform", "platform <> 'google_ads'", "s_google"),
    *nulls("silver.meta_ads", "s_meta", "account_id", "ad_id", "campaign_id", "date", "platform", *FIGURES),
    check("silver.meta_ads", ACCEPTED, "platform", "platform <> 'meta_ads'", "s_meta"),
    *nulls("silver.unified_campaigns", "unified", "account_id", "campaign_id", "date", "platform"),
    check("silver.unified_campaigns", ACCEPTED, "platform", PLATFORM_OUTSIDE, "unified"),
    *nulls(
        "silver.google_ads_keywords_dedup", "s_keywords", "account_id", "keyword_id", "keyword_text", "date", "platform"
    ),
    check("silver.google_ads_keywords_dedup", ACCEPTED, "platform", "platform <> 'google_ads'", "s_keywords"),
    *nulls("silver.google_search_terms_dedup", "s_terms", "account_id", "search_term", "date"),
    *nulls("silver.google_negatives_dedup", "s_negatives", "account_id", "criterion_id", "scope", "snapshot_date"),
    check("silver.google_negatives_dedup", ACCEPTED, "scope", SCOPE_OUTSIDE, "s_negatives"),
]

DQ_OPS = [
    *nulls("ops.client_budget", "client_budget", "account_id", "platform", "monthly_budget"),
    check("ops.client_budget", ACCEPTED, "platform", PLATFORM_OUTSIDE, "client_budget"),
    expression("ops.client_budget", "monthly_budget", "> 0", "client_budget"),
    not_unique("ops.client_budget", "client_budget", "account_id, platform"),
    *nulls("ops.managed_accounts", "managed", "account_id", "platform"),
    check("ops.managed_accounts", ACCEPTED, "platform", PLATFORM_OUTSIDE, "managed"),
    not_unique("ops.managed_accounts", "managed", "account_id, platform"),
    *nulls("users.app_users", "users", "id", "email", "role"),
    check("users.app_users", ACCEPTED, "role", "role NOT IN ('admin', 'user')", "users"),
    not_unique("users.app_users", "users", "email"),
]


def entries(section: str, source: str, name: str, order: str, spend: str = "spend") -> str:
    return f"""SELECT account_id, '{section}' AS section,
        ROW_NUMBER() OVER (PARTITION BY account_id ORDER BY {order}) AS position,
        {name} AS entry, {spend} AS spend
        FROM {source} WHERE account_id IN (SELECT account_id FROM overview)"""


NO_SPEND = "CAST(NULL AS DOUBLE)"

_FINALS: dict[str, str] = {
    "silver_google_ads": "SELECT * FROM s_google",
    "silver_google_ads_by_ad_group": "SELECT * FROM s_google_ag",
    "silver_keywords": "SELECT * FROM s_keywords",
    "silver_search_terms": "SELECT * FROM s_terms",
    "silver_negatives": "SELECT * FROM s_negatives",
    "silver_meta_ads": "SELECT * FROM s_meta",
    "unified_campaigns": "SELECT * FROM unified",
    "daily_performance": "SELECT * FROM daily",
    "weekly_performance": "SELECT * FROM weekly",
    "gold_keywords": "SELECT * FROM g_keywords",
    "gold_search_terms": "SELECT * FROM g_terms",
    "gold_negatives": "SELECT * FROM g_negatives",
    "gold_negatives_per_account": "SELECT * FROM g_negatives_acc",
    "spend_mtd": f"""SELECT account_id, platform, {dsum('spend')} AS spent_mtd FROM daily
        WHERE date BETWEEN DATE '2024-01-01' AND DATE '2024-01-31'
        GROUP BY account_id, platform""",
    "budget_pacing": "SELECT * FROM pacing",
    "budget_pacing_to_date": "SELECT * FROM pacing_capped",
    "daily_range": daily_rows("google_ads", "2024-01-01", "2024-01-20"),
    "daily_range_one_account": daily_rows(
        "meta_ads", "2024-01-01", "2024-01-20", "account_id = '2'"
    ),
    "daily_yesterday": daily_rows("google_ads", "2024-01-19", "2024-01-19"),
    "daily_lastweek": daily_rows("meta_ads", "2024-01-08", "2024-01-14"),
    "daily_lastmonth": daily_rows("google_ads", "2024-01-01", "2024-01-31"),
    "keywords_range": f"""SELECT account_id, MAX(account_name) AS account_name, campaign_name,
        ad_group_name, keyword_text, MAX(match_type) AS match_type,
        {isum('impressions')} AS impressions, {isum('clicks')} AS clicks,
        {dsum('spend')} AS spend, {dsum('conversions')} AS conversions
        FROM g_keywords WHERE {IN_PERIOD}
        GROUP BY account_id, keyword_text, ad_group_name, campaign_name""",
    "clients": """SELECT account_id, MAX(account_name) AS account_name,
        string_agg(DISTINCT platform, ',' ORDER BY platform) AS platforms
        FROM daily GROUP BY account_id""",
    "budgets": """SELECT account_id, platform, CAST(monthly_budget AS DOUBLE) AS monthly_budget,
        currency, active FROM client_budget""",
    "account_overview": "SELECT * FROM overview",
    "account_performance": "SELECT * FROM performance",
    "campaign_rows": "SELECT * FROM campaigns",
    "top_keywords": "SELECT * FROM top_kw",
    "wasted_search_terms": "SELECT * FROM wasted",
    "high_roas_search_terms": "SELECT * FROM winners",
    "search_term_buckets": """SELECT *, 'top_by_spend_no_conv' AS bucket FROM wasted
        UNION ALL SELECT *, 'high_roas' AS bucket FROM winners""",
    "negatives_total": "SELECT * FROM neg_totals",
    "campaigns_without_negatives": "SELECT * FROM uncovered",
    "negatives_coverage": """SELECT o.account_id, COALESCE(n.total_negatives, 0) AS total_negatives,
        COALESCE(u.n, 0) AS uncovered_count
        FROM overview o LEFT JOIN neg_totals n ON n.account_id = o.account_id
        LEFT JOIN uncovered_list u ON u.account_id = o.account_id""",
    "review_pacing": "SELECT * FROM rev_pacing",
    "signals": """SELECT account_id, CAST(ROW_NUMBER() OVER (PARTITION BY account_id ORDER BY rule)
        AS INTEGER) AS position, code, severity, message FROM fired""",
    "account_review": f"""SELECT o.account_id, o.account_name, o.platform,
        {START} AS period_start, {END} AS period_end,
        p.impressions, p.clicks, p.spend, p.conversions, p.conversion_value, p.ctr, p.cpc, p.cpa,
        p.roas,
        (SELECT COUNT(*) FROM campaigns c WHERE c.account_id = o.account_id) AS campaign_count,
        (SELECT COUNT(*) FROM top_kw k WHERE k.account_id = o.account_id) AS keyword_count,
        k.keyword_text AS top_keyword, k.roas AS top_keyword_roas,
        COALESCE(w.n, 0) AS wasted_count, COALESCE(w.total, 0) AS wasted_spend,
        (SELECT COUNT(*) FROM winners x WHERE x.account_id = o.account_id) AS high_roas_count,
        COALESCE(n.total_negatives, 0) AS total_negatives,
        COALESCE(u.n, 0) AS uncovered_count,
        b.monthly_budget, b.currency, b.spent_mtd, b.pct_consumed, b.days_elapsed_pct, b.pace_flag,
        COALESCE((SELECT string_agg(f.code, ',' ORDER BY f.rule) FROM fired f
                  WHERE f.account_id = o.account_id), '') AS signal_codes
    FROM overview o
    JOIN performance p ON p.account_id = o.account_id
    JOIN rev_pacing b ON b.account_id = o.account_id
    LEFT JOIN top_kw k ON k.account_id = o.account_id AND k.position = 1
    LEFT JOIN wasted_sum w ON w.account_id = o.account_id
    LEFT JOIN neg_totals n ON n.account_id = o.account_id
    LEFT JOIN uncovered_list u ON u.account_id = o.account_id""",
    "account_review_documents": " UNION ALL ".join(
        [
            entries("campaigns", "campaigns", "campaign_name", "spend DESC, campaign_name"),
            entries("keywords_top", "top_kw", "keyword_text", "position"),
            entries("top_by_spend_no_conv", "wasted", "search_term", "position"),
            entries("high_roas", "winners", "search_term", "position"),
            entries(
                "campaigns_without_negatives",
                "uncovered",
                "campaign_name",
                "campaign_name",
                NO_SPEND,
            ),
            entries("signals", "fired", "message", "rule", NO_SPEND),
        ]
    ),
    "merge_upsert": UPSERTED,
    "merge_upsert_table": UPSERTED,
    "merge_upsert_some_columns": f"""SELECT {MERGED} FROM merge_target t WHERE NOT EXISTS (
        SELECT 1 FROM merge_batch b WHERE {KEY_MATCH})
        UNION ALL
        SELECT b.date, b.customer_id, b.campaign_id, b.ad_group_id, b.keyword_id, b.device,
            b.impressions, t.clicks, b.spend, t.match_type, b._extracted_at
        FROM merge_batch b LEFT JOIN merge_target t ON {KEY_MATCH}""",
    "upsert_budget": """SELECT COALESCE(n.account_id, t.account_id) AS account_id,
        COALESCE(n.platform, t.platform) AS platform,
        CAST(COALESCE(n.monthly_budget, t.monthly_budget) AS DOUBLE) AS monthly_budget,
        'BRL' AS currency, CASE WHEN n.account_id IS NULL THEN t.active ELSE TRUE END AS active,
        CASE WHEN t.account_id IS NULL THEN TIMESTAMP '2024-01-20 05:00:00'
             ELSE TIMESTAMP '2024-01-01 00:00:00' END AS created_at,
        CASE WHEN n.account_id IS NULL THEN TIMESTAMP '2024-01-01 00:00:00'
             ELSE TIMESTAMP '2024-01-20 05:00:00' END AS updated_at
        FROM client_budget t FULL OUTER JOIN (
            SELECT CAST(slot AS VARCHAR) AS account_id, 'google_ads' AS platform,
                CAST((slot + 1) * 1000 AS DECIMAL(14,2)) AS monthly_budget
            FROM (SELECT DISTINCT c_custkey % 8 AS slot FROM customer) s) n
        ON n.account_id = t.account_id AND n.platform = t.platform""",
    "upsert_budget_table": """SELECT COALESCE(n.account_id, t.account_id) AS account_id,
        COALESCE(n.platform, t.platform) AS platform,
        CAST(COALESCE(n.monthly_budget, t.monthly_budget) AS DOUBLE) AS monthly_budget,
        'BRL' AS currency, CASE WHEN n.account_id IS NULL THEN t.active ELSE TRUE END AS active,
        CASE WHEN t.account_id IS NULL THEN TIMESTAMP '2024-01-20 05:00:00'
             ELSE TIMESTAMP '2024-01-01 00:00:00' END AS created_at,
        CASE WHEN n.account_id IS NULL THEN TIMESTAMP '2024-01-01 00:00:00'
             ELSE TIMESTAMP '2024-01-20 05:00:00' END AS updated_at
        FROM client_budget t FULL OUTER JOIN (
            SELECT CAST(slot AS VARCHAR) AS account_id, 'google_ads' AS platform,
                CAST((slot + 1) * 1000 AS DECIMAL(14,2)) AS monthly_budget
            FROM (SELECT DISTINCT c_custkey % 8 AS slot FROM customer) s) n
        ON n.account_id = t.account_id AND n.platform = t.platform""",
    "insert_if_absent": """SELECT * FROM managed WHERE enabled = 1 UNION ALL
        SELECT account_id, platform, account_name, enabled FROM (
            SELECT m.*, ROW_NUMBER() OVER (PARTITION BY account_id, platform ORDER BY account_name) AS rn
            FROM managed m WHERE enabled = 0 AND NOT EXISTS (
                SELECT 1 FROM managed t WHERE t.enabled = 1 AND t.account_id = m.account_id
                  AND t.platform = m.platform)) a WHERE rn = 1""",
    "insert_if_absent_table": """SELECT account_id, platform, account_name, enabled FROM (
            SELECT m.*, ROW_NUMBER() OVER (PARTITION BY account_id, platform ORDER BY account_name) AS rn
            FROM managed m) a WHERE rn = 1""",
    "delete_where_table": "SELECT * FROM managed WHERE NOT (enabled = 0)",
    "delete_where": "SELECT * FROM managed WHERE NOT (enabled = 0)",
    "bronze_dedup": f"SELECT {MERGED} FROM google_latest_ag",
    "backfill_plan": f"""SELECT CAST(d AS DATE) AS date, account_id
        FROM generate_series({START}, {END}, INTERVAL 1 DAY) g(d), accounts""",
    "missing_partitions": "SELECT * FROM load_missing",
    "load_report": """SELECT
        (SELECT COUNT(*) FROM google_ads_raw r JOIN load_plan p
           ON r.date = p.date AND r.customer_id = p.account_id
         WHERE NOT EXISTS (SELECT 1 FROM load_failed f
           WHERE f.date = p.date AND f.account_id = p.account_id)) AS rows_loaded,
        (SELECT COUNT(*) FROM load_failed) AS failed,
        (SELECT COUNT(*) FROM load_plan) AS planned,
        CASE WHEN (SELECT COUNT(*) FROM load_failed) > 0 THEN
            'google_ads backfill incompleto: ' || (SELECT COUNT(*) FROM load_failed) || '/' ||
            (SELECT COUNT(*) FROM load_plan) || ' partições falharam (amostra: ' ||
            (SELECT string_agg(CAST(date AS VARCHAR) || '/' || account_id, ', '
                               ORDER BY date, account_id)
             FROM (SELECT * FROM load_failed ORDER BY date, account_id LIMIT 5) s) || ')'
        END AS message""",
    "load_results": """SELECT p.date, p.account_id, COUNT(r.date) AS rows,
        CASE WHEN COUNT(r.date) = 0 THEN 'empty' ELSE 'loaded' END AS status
        FROM load_plan p LEFT JOIN google_ads_raw r
          ON r.date = p.date AND r.customer_id = p.account_id
        GROUP BY p.date, p.account_id""",
    "micros_and_flatten": """SELECT CAST(o_custkey AS VARCHAR) AS customer_id,
        CONCAT('Account ', CAST(o_custkey AS VARCHAR)) AS customer_name,
        CAST(l_suppkey AS VARCHAR) AS campaign_id,
        CONCAT('Campaign ', CAST(l_suppkey AS VARCHAR)) AS campaign_name,
        l_linestatus AS campaign_status, CAST(l_linenumber AS VARCHAR) AS ad_group_id,
        'group' AS ad_group_name, 'ENABLED' AS ad_group_status,
        CAST(l_partkey AS VARCHAR) AS keyword_id, 'ENABLED' AS criterion_status,
        CONCAT('kw ', CAST(l_partkey AS VARCHAR)) AS keyword_text, 'EXACT' AS match_type,
        CAST(l_quantity AS BIGINT) AS impressions, CAST(l_linenumber AS BIGINT) AS clicks,
        l_extendedprice AS spend, l_discount AS conversions, l_tax AS conversion_value,
        0.0e0 AS view_through_conversions, l_tax AS all_conversions,
        l_discount AS search_impression_share, CAST(l_partkey % 10 AS INTEGER) AS quality_score,
        'MOBILE' AS device, CAST(l_shipdate AS DATE) AS date
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE l_returnflag <> 'R'""",
    "flatten_search_terms": """SELECT CAST(l_suppkey AS VARCHAR) AS customer_id,
        'Account' AS customer_name, CAST(l_suppkey AS VARCHAR) AS campaign_id,
        'Campaign' AS campaign_name, CAST(l_linenumber AS VARCHAR) AS ad_group_id,
        'group' AS ad_group_name, p_name AS search_term, l_returnflag AS search_term_status,
        CASE WHEN p_size % 3 = 0 THEN '' ELSE p_brand END AS matched_keyword_text,
        CASE WHEN p_size % 2 = 0 THEN '' ELSE 'BROAD' END AS matched_keyword_match_type,
        CAST(l_quantity AS BIGINT) AS impressions, CAST(l_linenumber AS BIGINT) AS clicks,
        l_extendedprice AS spend, l_discount AS conversions, l_tax AS conversion_value,
        CAST(l_shipdate AS DATE) AS date
        FROM lineitem JOIN part ON p_partkey = l_partkey""",
    "snapshot_negatives": """SELECT CAST(p_partkey % 4 AS VARCHAR) AS customer_id,
        CAST(p_partkey % 3 AS VARCHAR) AS campaign_id,
        CONCAT('Campaign ', CAST(p_partkey % 3 AS VARCHAR)) AS campaign_name,
        '' AS ad_group_id, '' AS ad_group_name, CAST(p_partkey AS VARCHAR) AS criterion_id,
        p_name AS criterion_text, 'BROAD' AS match_type, 'campaign' AS scope,
        DATE '2024-01-20' AS snapshot_date
        FROM part WHERE p_type <> 'SMALL' AND p_size % 2 = 0
        UNION ALL
        SELECT CAST(p_partkey % 4 AS VARCHAR), CAST(p_partkey % 3 AS VARCHAR),
        CONCAT('Campaign ', CAST(p_partkey % 3 AS VARCHAR)), CAST(p_size AS VARCHAR),
        CONCAT('AdGroup ', CAST(p_size AS VARCHAR)), CAST(p_partkey AS VARCHAR), p_name, 'BROAD',
        'ad_group', DATE '2024-01-20'
        FROM part WHERE p_type <> 'SMALL' AND p_size % 2 = 0 AND p_size % 5 <> 0""",
    "conform_meta": """SELECT CAST(user_id AS VARCHAR) AS account_id,
        CASE WHEN user_id % 3 = 0 THEN '' ELSE 'Account' END AS account_name,
        CAST(user_id % 12 AS VARCHAR) AS campaign_id, 'Campaign' AS campaign_name,
        CAST(event_id AS VARCHAR) AS ad_id, 'Ad' AS ad_name,
        CASE WHEN event_id % 5 = 0 THEN 0 ELSE event_id % 500 END AS impressions,
        CASE WHEN event_id % 7 = 0 THEN 0 ELSE event_id % 40 END AS clicks,
        CASE WHEN event_id % 11 = 0 THEN 0 ELSE value END AS spend,
        CAST(ts AS DATE) AS date_start, CAST(ts AS DATE) AS date_stop,
        CASE WHEN event_type = 'error' THEN '[]' ELSE
            CONCAT('[{"action_type":"', event_type, '","value":"', CAST(event_id % 7 AS VARCHAR),
                   '","7d_click":"', CAST(event_id % 3 AS VARCHAR), '"}]') END AS actions,
        'mobile' AS device_platform,
        CASE WHEN event_id % 2 = 0 THEN event_type ELSE '' END AS publisher_platform,
        TIMESTAMP '2024-01-20 05:00:00' AS _extracted_at, 'meta_ads' AS _source
        FROM events""",
    "list_google_accounts": """SELECT CAST(s_suppkey AS VARCHAR) AS account_id FROM supplier
        WHERE s_acctbal > 0 AND s_nationkey <> 3 AND s_nationkey <> 5""",
    "list_meta_accounts": """SELECT CAST(c_custkey AS VARCHAR) AS account_id FROM customer
        WHERE c_mktsegment <> 'HOUSEHOLD'""",
    "normalize_accounts": """SELECT s_suppkey, CONCAT('act_', CAST(s_suppkey AS VARCHAR))
        AS account_id FROM supplier""",
    "dq_not_null": " UNION ALL ".join(
        nulls(
            "bronze.google_ads_raw",
            "google_ads_raw",
            "customer_id",
            "keyword_text",
            "clicks",
            "conversion_value",
            "date",
        )
    ),
    "dq_accepted_values": check(
        "bronze.google_ads_raw",
        "accepted_values",
        "campaign_status",
        "campaign_status NOT IN ('ENABLED', 'PAUSED')",
        "google_ads_raw",
    ),
    "dq_unique": not_unique("gold.google_ads_keywords", "g_keywords", KEYWORD_KEYS),
    "dq_expression": check(
        "bronze.google_ads_raw", "expression_is_true", "spend", "NOT spend > 0", "google_ads_raw"
    ),
    "dq_gold_models": " UNION ALL ".join(DQ_GOLD),
    "dq_silver_models": " UNION ALL ".join(DQ_SILVER),
    "dq_ops_tables": " UNION ALL ".join(DQ_OPS),
    "api_key_status": """SELECT k.id, k.user_id, u.role, k.last_used_at,
        CASE WHEN k.revoked_at IS NOT NULL THEN 'revoked'
             WHEN u.disabled_at IS NOT NULL THEN 'disabled'
             WHEN TIMESTAMP '2024-01-20 05:00:00' > k.last_used_at + INTERVAL 14 DAY
             THEN 'expired' ELSE 'valid' END AS status
        FROM api_keys k LEFT JOIN users u ON u.id = k.user_id""",
    "key_hashes": """SELECT c_custkey,
        sha256(CONCAT('key-', CAST(c_custkey AS VARCHAR), 'pepper')) AS key_hash FROM customer""",
    "list_users": "SELECT * FROM users",
}

_FINALS |= {
    "scan_keyword_report": _FINALS["micros_and_flatten"],
    "scan_search_term_report": _FINALS["flatten_search_terms"]
    + " WHERE l_shipdate >= DATE '1996-01-01' AND l_shipdate < DATE '1999-01-01'",
    "scan_negative_reports": _FINALS["snapshot_negatives"],
    "scan_meta_insights": _FINALS["conform_meta"],
    "snapshot_load_table": _FINALS["snapshot_negatives"],
    "bronze_dedup_table": f"SELECT {MERGED} FROM google_latest_stored",
    "budget_pacing_view": _FINALS["budget_pacing"],
    "review_json": _FINALS["account_review_documents"],
    "review_json_heads": f"SELECT account_id, campaign_count, signal_codes FROM ({_FINALS['account_review']}) r",
}

_FAILS_FIRST = """(date = DATE '2024-01-31' OR (date = DATE '2024-01-29' AND account_id = '1')
    OR (date = DATE '2024-01-30' AND account_id = '2'))"""
_FAILS_AGAIN = "(date = DATE '2024-01-30' AND account_id = '2')"
_UNIT_ROWS = """SELECT p.date, p.account_id, COUNT(r.date) AS n FROM load_plan p
    LEFT JOIN google_latest_ag r ON r.date = p.date AND r.customer_id = p.account_id GROUP BY ALL"""
_ADDED = ", ".join(
    f"CASE WHEN date >= DATE '2024-01-16' THEN {c} END AS {c}"
    for c in ("campaign_status", "ad_group_status", "criterion_status", "conversion_value")
)
_BROKEN = {
    "not_null(clicks)": "clicks IS NULL",
    "not_null(keyword_text)": "keyword_text IS NULL",
    "accepted_values(campaign_status)": "campaign_status NOT IN ('ENABLED', 'PAUSED')",
    "expression_is_true(spend)": "NOT (spend > 0)",
}
_REASONS = "concat_ws(',', " + ", ".join(f"CASE WHEN {c} THEN '{n}' END" for n, c in _BROKEN.items()) + ")"
_GIVEN = """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS as_of,
    CASE o_orderkey % 7 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'not a day'
        ELSE strftime(CAST(o_orderdate AS DATE) - CAST(o_orderkey % 40 AS INTEGER), '%Y-%m-%d') END AS s,
    CASE o_orderkey % 5 WHEN 0 THEN NULL WHEN 1 THEN ''
        ELSE strftime(CAST(o_orderdate AS DATE) - CAST(o_orderkey % 30 AS INTEGER), '%Y-%m-%d') END AS e
    FROM orders"""
_READ = f"""SELECT *, TRY_CAST(nullif(s, '') AS DATE) AS sd, TRY_CAST(nullif(e, '') AS DATE) AS ed,
    coalesce(s, '') = '' AS no_s, coalesce(e, '') = '' AS no_e FROM ({_GIVEN}) g"""
_JUDGED = f"""SELECT *, CASE WHEN s = 'not a day' THEN 'not a date' WHEN no_s THEN NULL
        WHEN coalesce(ed, sd) < sd THEN 'end before start' END AS rp,
    CASE WHEN no_s AND no_e THEN NULL WHEN no_s OR no_e THEN 'one date missing'
        WHEN s = 'not a day' THEN 'not a date' WHEN ed < sd THEN 'end before start' END AS lp FROM ({_READ}) r"""

_FINALS |= {
    "live_key_status": _FINALS["api_key_status"].rstrip() + " WHERE k.revoked_at IS NULL",
    "stream_restart": f"SELECT * EXCLUDE (_extracted_at) FROM ({UPSERTED}) u",
    "merge_upsert_two_writers": UPSERTED,
    "append_table": f"SELECT {MERGED} FROM google_ads_raw",
    "seed_accounts": """SELECT CAST(s_suppkey AS VARCHAR) AS account_id,
        CASE WHEN s_nationkey % 2 = 0 THEN 'google_ads' ELSE 'meta_ads' END AS platform,
        s_name AS account_name, CAST(s_suppkey % 2 AS SMALLINT) AS enabled
        FROM supplier WHERE s_nationkey <> 7""",
    "backfill_resume": f"""SELECT date, account_id,
        CASE WHEN {_FAILS_AGAIN} THEN 'failed' WHEN n = 0 THEN 'empty' ELSE 'loaded' END AS status,
        CASE WHEN {_FAILS_AGAIN} THEN 0 ELSE n END AS rows,
        CAST(CASE WHEN {_FAILS_FIRST} THEN 2 ELSE 1 END AS INTEGER) AS attempts
        FROM ({_UNIT_ROWS}) u""",
    "backfill_landed": f"""SELECT date, account_id, CASE WHEN bad THEN 0 ELSE n END AS rows,
        CASE WHEN bad THEN 'failed' ELSE 'loaded' END AS status, CASE WHEN bad THEN 0 ELSE n END AS stored
        FROM (SELECT *, n = 0 OR {_FAILS_AGAIN} OR (date = DATE '2024-01-29' AND account_id = '1') AS bad
              FROM ({_UNIT_ROWS}) u) v""",
    "schema_growth": f"""SELECT date, customer_id, keyword_id, device, clicks, spend, {_ADDED},
        CAST(NULL AS VARCHAR) AS _source FROM google_ads_raw""",
    "refused_rows": f"""SELECT _seq, date, customer_id, keyword_id, spend, {_REASONS} AS reasons
        FROM google_ads_raw WHERE {_REASONS} <> ''""",
    "resolved_periods": f"""SELECT o_orderkey,
        CASE WHEN rp IS NOT NULL THEN NULL WHEN no_s THEN CAST(date_trunc('month', as_of) - INTERVAL 1 MONTH AS DATE)
            ELSE sd END AS review_start,
        CASE WHEN rp IS NOT NULL THEN NULL WHEN no_s THEN CAST(date_trunc('month', as_of) - INTERVAL 1 DAY AS DATE)
            ELSE coalesce(ed, sd) END AS review_end, rp AS review_problem,
        CASE WHEN lp IS NOT NULL THEN NULL WHEN no_s THEN as_of - 1 ELSE sd END AS load_start,
        CASE WHEN lp IS NOT NULL THEN NULL WHEN no_s THEN as_of - 1 ELSE ed END AS load_end, lp AS load_problem
        FROM ({_JUDGED}) j""",
}

ORACLES: dict[str, str] = {name: with_ctes(sql) for name, sql in _FINALS.items()}
# the same signals under budgets that are a hundred times as large
ORACLES["signals_under_pace"] = (
    ORACLES["signals"].replace("150000000 *", "15000000000 *").replace("60000 + (slot - 6) * 60000", "6000000 + (slot - 6) * 6000000")
)
