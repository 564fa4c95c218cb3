"""Named relations the oracle queries build on, from raw inputs to the fact."""

from __future__ import annotations

import re

_CODE = "CASE WHEN p_size = 1 THEN '' WHEN p_size = 2 THEN NULL ELSE p_brand END"
_SERIES = (
    "CASE l_returnflag WHEN 'A' THEN 'abs' WHEN 'N' THEN 'growth_yoy' ELSE 'growth_mom' END"
)
_SERIES_TYPE = "CASE WHEN o_orderstatus = 'F' THEN 'change_weekly' ELSE 'level' END"
_SHIP_MONTH = "CAST(date_trunc('month', l_shipdate) AS DATE)"


def _fact(trade: str) -> str:
    return f"""
        SELECT
            COALESCE(d.date_key, CAST(strftime(t.record_date, '%Y%m%d') AS INTEGER)) AS date_key,
            COALESCE(g.msic_group_key, 'UNKNOWN') AS msic_group_key,
            t.record_date,
            t.msic_group_code,
            t.sales_value_rm_mil,
            t.volume_index,
            f.avg_ron95_price_rm,
            f.avg_ron97_price_rm,
            f.avg_diesel_peninsular_price_rm,
            CAST(EXTRACT(year FROM t.record_date) AS INTEGER) AS year,
            CAST(EXTRACT(month FROM t.record_date) AS INTEGER) AS month
        FROM {trade} t
        LEFT JOIN int_fuelprice_monthly f
            ON CAST(date_trunc('month', t.record_date) AS DATE) = f.year_month_date
        LEFT JOIN dim_date d ON t.record_date = d.full_date
        LEFT JOIN dim_msic_group g ON t.msic_group_code = g.msic_group_code
    """


def _stg_trade(raw: str) -> str:
    return f"""
        SELECT ymd_date AS record_date, group_code AS msic_group_code,
               sales AS sales_value_rm_mil, volume AS volume_index
        FROM {raw}
        WHERE series = 'abs' AND group_code IS NOT NULL AND group_code <> ''
    """


def calendar(spine: str) -> str:
    """Calendar attributes over a relation with ``full_date``."""
    return f"""
        SELECT
            full_date,
            CAST(strftime(full_date, '%Y%m%d') AS INTEGER) AS date_key,
            CAST(year(full_date) AS INTEGER) AS year,
            CAST(month(full_date) AS INTEGER) AS month,
            CAST(day(full_date) AS INTEGER) AS day,
            CAST(quarter(full_date) AS INTEGER) AS quarter,
            CAST(isoyear(full_date) AS INTEGER) AS year_of_week,
            CAST(weekofyear(full_date) AS INTEGER) AS week_of_year,
            CAST(isodow(full_date) AS INTEGER) AS day_of_week,
            CAST(dayofyear(full_date) AS INTEGER) AS day_of_year,
            strftime(full_date, '%Y-%m') AS year_month,
            CAST(date_trunc('month', full_date) AS DATE) AS first_day_of_month,
            dayname(full_date) AS day_name
        FROM {spine}
    """


RELATIONS: dict[str, str] = {
    "trade_lines": f"""
        SELECT {_SERIES} AS series, {_SHIP_MONTH} AS ymd_date, {_CODE} AS group_code,
               l_extendedprice AS sales, l_quantity AS volume
        FROM lineitem JOIN part ON l_partkey = p_partkey
    """,
    "raw_iowrt_3d": """
        SELECT series, ymd_date, group_code,
               CAST(SUM(CAST(sales AS DECIMAL(18,2))) AS DOUBLE) AS sales,
               SUM(volume) AS volume
        FROM trade_lines GROUP BY 1, 2, 3
    """,
    "raw_iowrt": f"""
        SELECT {_SERIES} AS series, {_SHIP_MONTH} AS ymd_date,
               CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS sales,
               SUM(l_quantity) AS volume,
               CAST(SUM(CAST(l_quantity * (1 - l_discount) AS DECIMAL(18,4))) AS DOUBLE)
                   AS volume_sa
        FROM lineitem GROUP BY 1, 2
    """,
    "raw_fuelprice": f"""
        SELECT {_SERIES_TYPE} AS series_type, epoch_ns(o_orderdate) AS ymd_date,
               o_totalprice AS ron95,
               CASE WHEN o_orderpriority <> '5-LOW' THEN o_totalprice END AS ron97,
               CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN o_totalprice END
                   AS diesel,
               CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice END AS diesel_eastmsia
        FROM orders
    """,
    "fuel_text": f"""
        SELECT {_SERIES_TYPE} AS series_type,
               CASE WHEN o_orderpriority = '5-LOW' THEN 'not a date'
                    WHEN o_orderpriority = '3-MEDIUM'
                        THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')
                    ELSE strftime(o_orderdate, '%Y-%m-%d') END AS text_date,
               o_totalprice AS ron95,
               CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN o_totalprice END AS ron97,
               CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN o_totalprice END
                   AS diesel,
               CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice END AS diesel_eastmsia
        FROM orders
    """,
    "fuel_parsed": """
        SELECT series_type, TRY_CAST(text_date AS TIMESTAMP) AS ymd_date,
               ron95, ron97, diesel, diesel_eastmsia
        FROM fuel_text
    """,
    "fuel_forms": """
        SELECT *, CASE o_orderpriority
                      WHEN '1-URGENT' THEN strftime(o_orderdate, '%Y/%m/%d')
                      WHEN '2-HIGH' THEN strftime(o_orderdate, '%Y%m%d')
                      WHEN '3-MEDIUM' THEN strftime(o_orderdate, '%d %b %Y')
                      WHEN '4-NOT SPECIFIED' THEN strftime(o_orderdate, '%m/%d/%Y')
                      ELSE '12:30' END AS text_date
        FROM orders
    """,
    "msic_lookup": f"""
        SELECT {_CODE} AS group_code, p_name AS desc_en, p_type AS desc_bm FROM part
    """,
    "incomplete_groups": f"""
        SELECT DISTINCT {_CODE} AS msic_group_code, md5({_CODE}) AS msic_group_key
        FROM part WHERE p_brand <> 'Brand#13' AND {_CODE} <> ''
    """,
    "fact_incomplete": """
        SELECT f.* REPLACE (COALESCE(g.msic_group_key, 'UNKNOWN') AS msic_group_key)
        FROM fact_lines f LEFT JOIN incomplete_groups g
            ON f.msic_group_code = g.msic_group_code
    """,
    "awkward_lines": """
        SELECT * REPLACE (CASE WHEN group_code = '' THEN '' ELSE
            group_code || ', "a"' || chr(10) || 'b' END AS group_code)
        FROM trade_lines
    """,
    "seed_rows": f"""
        SELECT CAST(p_size AS VARCHAR) AS digits, {_CODE} AS group_code,
               p_name || ', "' || p_type || '", other' AS desc_en,
               CASE WHEN p_size % 5 = 0 THEN p_type || chr(10) || p_name
                    WHEN p_size % 7 = 0 THEN '' END AS desc_bm
        FROM part
    """,
    "stg_iowrt": """
        SELECT ymd_date AS record_date, sales AS sales_value_rm_mil, volume AS volume_index,
               volume_sa AS volume_index_sa
        FROM raw_iowrt WHERE series = 'abs'
    """,
    "stg_iowrt_3d": _stg_trade("raw_iowrt_3d"),
    "stg_lines": _stg_trade("trade_lines"),
    "stg_fuelprice": """
        SELECT make_timestamp((ymd_date // 1000000000) * 1000000) AS record_date,
               ron95 AS ron95_price_rm, ron97 AS ron97_price_rm,
               diesel AS diesel_peninsular_price_rm,
               diesel_eastmsia AS diesel_eastmsia_price_rm
        FROM raw_fuelprice WHERE series_type = 'level'
    """,
    "stg_msic_lookup": """
        SELECT group_code AS msic_group_code, desc_en AS group_desc_en,
               desc_bm AS group_desc_bm
        FROM msic_lookup WHERE group_code IS NOT NULL AND group_code <> ''
    """,
    "int_fuelprice_monthly": """
        SELECT CAST(date_trunc('month', record_date) AS DATE) AS year_month_date,
               round(CAST(SUM(CAST(ron95_price_rm AS DECIMAL(28,4))) AS DOUBLE) / count(ron95_price_rm) * 100) / 100 AS avg_ron95_price_rm,
               round(CAST(SUM(CAST(ron97_price_rm AS DECIMAL(28,4))) AS DOUBLE) / count(ron97_price_rm) * 100) / 100 AS avg_ron97_price_rm,
               round(CAST(SUM(CAST(diesel_peninsular_price_rm AS DECIMAL(28,4))) AS DOUBLE) / count(diesel_peninsular_price_rm) * 100) / 100
                   AS avg_diesel_peninsular_price_rm,
               round(CAST(SUM(CAST(diesel_eastmsia_price_rm AS DECIMAL(28,4))) AS DOUBLE) / count(diesel_eastmsia_price_rm) * 100) / 100
                   AS avg_diesel_eastmsia_price_rm
        FROM stg_fuelprice GROUP BY 1
    """,
    "bounds": """
        SELECT CAST(date_trunc('year', min(o_orderdate)) AS DATE) AS start_date,
               CAST(date_trunc('month', max(o_orderdate)) + INTERVAL 1 MONTH AS DATE)
                   AS end_date
        FROM orders
    """,
    "spine": """
        SELECT CAST(unnest(generate_series(start_date, end_date - 1, INTERVAL 1 DAY)) AS DATE)
                   AS full_date
        FROM bounds
    """,
    "dim_date": calendar("spine"),
    "dim_msic_group": """
        SELECT md5(msic_group_code) AS msic_group_key, msic_group_code, group_desc_en,
               group_desc_bm
        FROM (
            SELECT *, row_number() OVER (
                PARTITION BY msic_group_code
                ORDER BY length(group_desc_en) DESC, length(group_desc_bm) DESC,
                         group_desc_en, group_desc_bm) AS pos
            FROM stg_msic_lookup)
        WHERE pos = 1
    """,
    "fact": _fact("stg_iowrt_3d"),
    "fact_lines": _fact("stg_lines"),
    "trade_unioned": """
        SELECT record_date, msic_group_code, sales_value_rm_mil, volume_index,
               CAST(NULL AS DOUBLE) AS volume_index_sa
        FROM stg_iowrt_3d
        UNION ALL
        SELECT record_date, 'Overall', sales_value_rm_mil, volume_index, volume_index_sa
        FROM stg_iowrt
    """,
    "ranges": """
        SELECT 'stg_iowrt' AS source, min(record_date) AS min_dt, max(record_date) AS max_dt
        FROM stg_iowrt
        UNION ALL
        SELECT 'stg_iowrt_3d', min(record_date), max(record_date) FROM stg_lines
        UNION ALL
        SELECT 'stg_fuelprice', CAST(min(record_date) AS DATE), CAST(max(record_date) AS DATE)
        FROM stg_fuelprice
    """,
}


def _named_in(sql: str) -> set[str]:
    return {word for word in re.findall(r"[a-z_0-9]+", sql) if word in RELATIONS}


def with_relations(sql: str) -> str:
    """Put every relation a query needs in front of it, inputs first."""
    ordered: list[str] = []

    def need(text: str, inside: str = "") -> None:
        for name in sorted(_named_in(text) - {inside}):
            if name not in ordered:
                need(RELATIONS[name], name)
                ordered.append(name)

    need(sql)
    ctes = ",\n".join(f"{name} AS ({RELATIONS[name].strip()})" for name in ordered)
    return f"WITH {ctes}\n{sql.strip()}" if ctes else sql.strip()
