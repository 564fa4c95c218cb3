"""One SQL query per registered Spark query."""

from __future__ import annotations

from oracle.relations import calendar

_PADDED = "strftime(ymd_date, '%Y') AS year, strftime(ymd_date, '%m') AS month"
_TRADE = "series, ymd_date, group_code, sales, volume"
_STORED = "series, CAST(ymd_date AS TIMESTAMP) AS ymd_date, group_code, sales, volume"

_OUTLETS = """CASE WHEN ymd_date < DATE '1997-01-01' THEN CAST(CAST(volume AS INTEGER) AS VARCHAR)
    WHEN ymd_date < DATE '1998-01-01' THEN CAST(volume / 4 AS VARCHAR)
    ELSE 'n' || CAST(CAST(volume AS INTEGER) AS VARCHAR) END"""


def _growth(months: int) -> str:
    def percent(column: str) -> str:
        return (
            f"CASE WHEN b.{column} <> 0 THEN "
            f"round((c.{column} - b.{column}) / b.{column} * 100 * 100) / 100 END"
        )

    return f"""
        SELECT c.msic_group_code, c.record_date,
               {percent('sales_value_rm_mil')} AS sales_growth,
               {percent('volume_index')} AS volume_growth
        FROM trade_unioned c
        LEFT JOIN trade_unioned b
            ON b.msic_group_code = c.msic_group_code
            AND b.record_date + INTERVAL {months} MONTH = c.record_date
    """


def _unique(relation: str, column: str, table: str | None = None) -> str:
    return f"""
        SELECT 'unique' AS test, '{table or relation}' AS table_name,
               '{column}' AS column_name, 'error' AS severity,
               (SELECT count(*) FROM (
                   SELECT {column} FROM {relation} WHERE {column} IS NOT NULL
                   GROUP BY 1 HAVING count(*) > 1)) AS failures
    """


def _unique_checked(relation: str, column: str) -> str:
    return f"""
        SELECT r.*, (SELECT count({column}) FROM {relation}) AS rows_checked
        FROM ({_unique(relation, column)}) r
    """


def _count(
    test: str, table: str, column: str, severity: str, relation: str, failed: str
) -> str:
    return f"""
        SELECT '{test}' AS test, '{table}' AS table_name, '{column}' AS column_name,
               '{severity}' AS severity, count(*) AS failures
        FROM {relation} WHERE {failed}
    """


def _not_null(table: str, column: str, relation: str, severity: str = "error") -> str:
    return _count("not_null", table, column, severity, relation, f"{column} IS NULL")


def _nonnegative(column: str, relation: str) -> str:
    table = "fct_retail_sales_monthly"
    return _count(
        "expression_is_true", table, column, "error", relation, f"NOT ({column} >= 0)"
    )


def _orphans(column: str, parent: str, fact: str = "fact_lines") -> str:
    return f"""
        SELECT {column}, count(*) AS n_rows FROM {fact}
        WHERE {column} IS NOT NULL AND {column} NOT IN (SELECT {column} FROM {parent})
        GROUP BY 1
    """


def _orphan_rows(column: str, parent: str) -> str:
    return _count(
        "relationships",
        "fct_retail_sales_monthly",
        column,
        "error",
        "fact_lines",
        f"{column} IS NOT NULL AND {column} NOT IN (SELECT {column} FROM {parent})",
    )


def _accepted(
    relation: str, table: str, column: str, values: str, severity: str = "error"
) -> str:
    return f"""
        SELECT 'accepted_values' AS test, '{table}' AS table_name, '{column}' AS column_name,
               '{severity}' AS severity, count(DISTINCT {column}) AS failures
        FROM {relation} WHERE {column} NOT IN ({values})
    """


def _status(*results: str) -> str:
    return f"""
        SELECT *, CASE WHEN failures = 0 THEN 'pass' WHEN severity = 'warn' THEN 'warn'
                       ELSE 'fail' END AS status
        FROM ({' UNION ALL '.join(results)})
    """


_FACT = "fct_retail_sales_monthly"
_DIMENSION_CHECKS = [
    _not_null("dim_date", "date_key", "dim_date"),
    _not_null("dim_date", "full_date", "dim_date"),
    _not_null("dim_msic_group", "msic_group_key", "dim_msic_group"),
    _not_null("dim_msic_group", "msic_group_code", "dim_msic_group"),
]
_FACT_NOT_NULL = [
    _not_null(_FACT, "date_key", "fact_lines"),
    _not_null(_FACT, "msic_group_key", "fact_lines"),
    _not_null(_FACT, "sales_value_rm_mil", "fact_lines", "warn"),
    _not_null(_FACT, "volume_index", "fact_lines", "warn"),
]
_FACT_EXPRESSIONS = [
    _nonnegative("sales_value_rm_mil", "fact_lines"),
    _nonnegative("volume_index", "fact_lines"),
]
_HEADLINE_CHECKS = [
    _not_null("stg_iowrt", "record_date", "stg_iowrt"),
    _unique("stg_iowrt", "record_date"),
]

_THREE_SERIES = "'abs', 'growth_yoy', 'growth_mom'"

_ACCEPTED = [
    _accepted("raw_iowrt", "iowrt", "series", _THREE_SERIES),
    _accepted("trade_lines", "iowrt_3d", "series", _THREE_SERIES),
    _accepted("raw_fuelprice", "fuelprice", "series_type", "'level', 'change_weekly'"),
]

_TREND = """
    SELECT year, month,
           round(sum(sales_value_rm_mil) * 100) / 100 AS total_sales_rm_mil,
           max(avg_ron95_price_rm) AS avg_ron95_price_rm,
           max(avg_ron97_price_rm) AS avg_ron97_price_rm,
           max(avg_diesel_peninsular_price_rm) AS avg_diesel_peninsular_price_rm
    FROM fact_lines GROUP BY year, month
"""

_CORRELATIONS = ", ".join(
    f"round(corr(sales_value_rm_mil, {p}) * 1e10) / 1e10 AS corr_{p}"
    for p in ("avg_ron95_price_rm", "avg_ron97_price_rm", "avg_diesel_peninsular_price_rm")
)

_DOUBLED_AVERAGES = ", ".join(
    f"round(CAST(SUM(CAST({p} * f AS DECIMAL(28,4))) AS DOUBLE) / count({p}) * 100) / 100 AS avg_{p}"
    for p in ("ron95_price_rm", "ron97_price_rm", "diesel_peninsular_price_rm", "diesel_eastmsia_price_rm")
)

QUERIES: dict[str, str] = {
    # sources
    "scan_landing": """
        SELECT series, ymd_date AS date, group_code AS "group", sales, volume
        FROM trade_lines
    """,
    "scan_landing_csv": """
        SELECT series, ymd_date AS date, group_code AS "group", sales, volume
        FROM awkward_lines
    """,
    "scan_raw_partitioned": f"""
        SELECT series, CAST(ymd_date AS TIMESTAMP) AS ymd_date, sales, volume, volume_sa, {_PADDED}
        FROM raw_iowrt
    """,
    "scan_raw_mixed_dates": """
        SELECT series_type, o.day AS ymd_date, ron95, ron97, diesel,
               diesel_eastmsia, strftime(o.day, '%Y') AS year, strftime(o.day, '%m') AS month,
               strftime(o.day, '%d') AS day
        FROM (SELECT *, make_timestamp(ymd_date // 1000) AS day FROM raw_fuelprice) o
    """,
    "scan_merge_schema": f"""
        SELECT series, CAST(ymd_date AS TIMESTAMP) AS ymd_date, group_code, sales,
               CASE WHEN ymd_date >= DATE '1998-01-01' THEN volume END AS volume, {_PADDED}
        FROM trade_lines
    """,
    "scan_raw_type_change": f"""
        SELECT series, CAST(ymd_date AS TIMESTAMP) AS ymd_date, group_code, sales, volume,
               {_OUTLETS} AS outlets, {_PADDED}
        FROM trade_lines
    """,
    "scan_landing_type_change": f"""
        SELECT series, ymd_date, group_code, sales, volume, {_OUTLETS} AS outlets FROM trade_lines
    """,
    "seed_csv": "SELECT * FROM seed_rows",
    # ingest
    "ingest_rename": f"SELECT {_TRADE} FROM trade_lines",
    "ingest_parse_dates": "SELECT * FROM fuel_parsed",
    "ingest_date_forms": """
        SELECT o_orderpriority AS series_type, text_date, o_totalprice AS ron95,
               CASE WHEN o_orderpriority <> '5-LOW' THEN date_trunc('day', o_orderdate) END AS ymd_date
        FROM (SELECT * REPLACE (CAST(o_orderdate AS TIMESTAMP) AS o_orderdate) FROM fuel_forms)
    """,
    "raw_write_instants": """
        SELECT event_type AS series_type, ts AS ymd_date, value AS ron95,
               CAST(event_id AS DOUBLE) AS ron97, strftime(ts, '%Y') AS year,
               strftime(ts, '%m') AS month, strftime(ts, '%d') AS day
        FROM events
    """,
    "ingest_audit_periods": """
        SELECT 'iowrt' AS dataset, strftime(ymd_date, '%Y-%m') AS period, count(*) AS n_rows
        FROM raw_iowrt GROUP BY 2
        UNION ALL
        SELECT 'iowrt_3d', strftime(ymd_date, '%Y-%m'), count(*) FROM trade_lines GROUP BY 2
    """,
    "raw_snapshot_readback": f"""
        SELECT series, CAST(ymd_date AS TIMESTAMP) AS ymd_date, group_code,
               CASE WHEN ymd_date = DATE '1997-03-01' THEN floor(sales) ELSE sales END AS sales,
               volume, {_PADDED}
        FROM trade_lines
    """,
    "ingest_period_outcomes": """
        SELECT 'iowrt_3d' AS dataset, strftime(ymd_date, '%Y-%m') AS period,
               CASE WHEN year(any_value(ymd_date)) = 1997 THEN 'failed' ELSE 'written' END AS status,
               count(*) AS n_rows,
               CASE WHEN year(any_value(ymd_date)) = 1997 THEN 3 ELSE 1 END AS attempts
        FROM trade_lines GROUP BY 2
    """,
    "raw_write_changed": """
        SELECT 'iowrt_3d' AS dataset, strftime(ymd_date, '%Y-%m') AS period,
               CASE WHEN strftime(ymd_date, '%Y-%m') = '1997-03' THEN 'written' ELSE 'unchanged' END
                   AS status,
               count(*) AS n_rows
        FROM trade_lines GROUP BY 2, 3
    """,
    "ingest_dropna": "SELECT * FROM fuel_parsed WHERE ymd_date IS NOT NULL",
    "distinct_periods": """
        SELECT DISTINCT 'iowrt' AS dataset, ymd_date AS period FROM raw_iowrt
        UNION ALL
        SELECT DISTINCT 'iowrt_3d', ymd_date FROM trade_lines
        UNION ALL
        SELECT DISTINCT 'fuelprice', CAST(o_orderdate AS DATE) FROM orders
    """,
    "period_subset": f"""
        SELECT {_STORED} FROM trade_lines
        WHERE date_trunc('month', ymd_date) = DATE '1998-07-01'
    """,
    "raw_write_monthly": f"SELECT {_STORED}, {_PADDED} FROM trade_lines",
    "raw_write_daily": """
        SELECT series_type, o.day AS ymd_date, ron95, ron97, diesel,
               diesel_eastmsia, strftime(o.day, '%Y') AS year, strftime(o.day, '%m') AS month,
               strftime(o.day, '%d') AS day
        FROM (SELECT *, make_timestamp(ymd_date // 1000) AS day FROM raw_fuelprice) o
    """,
    "raw_overwrite_dynamic": f"""
        SELECT series, CAST(ymd_date AS TIMESTAMP) AS ymd_date, group_code,
               CASE WHEN ymd_date = DATE '1997-03-01' THEN sales * 2 ELSE sales END AS sales,
               volume, {_PADDED}
        FROM trade_lines
    """,
    "ingest_audit": """
        SELECT 'iowrt' AS dataset, 'written' AS status, count(*) AS rows_read,
               count(*) AS rows_written, 0 AS rows_failed, 0 AS rows_dropped FROM raw_iowrt
        UNION ALL
        SELECT 'iowrt_3d', 'written', count(*), count(*), 0, 0 FROM trade_lines
        UNION ALL
        SELECT 'fuelprice', 'written', count(*), count(ymd_date), 0,
               count(*) - count(ymd_date)
        FROM fuel_parsed
    """,
    "ingest_status": """
        SELECT 'iowrt' AS dataset, 'skipped' AS status, count(*) AS rows_read,
               0 AS rows_written FROM raw_iowrt
        UNION ALL
        SELECT 'fuelprice', 'failed', 0, 0
        UNION ALL
        SELECT 'iowrt_3d', 'written', count(*), count(*) FROM trade_lines
    """,
    # staging
    "stg_iowrt": "SELECT * FROM stg_iowrt",
    "stg_iowrt_3d": "SELECT * FROM stg_iowrt_3d",
    "stg_iowrt_3d_lines": "SELECT * FROM stg_lines",
    "stg_stored_views": "SELECT * FROM stg_lines",
    "stg_fuelprice": "SELECT * FROM stg_fuelprice",
    "stg_msic_lookup": "SELECT * FROM stg_msic_lookup",
    "msic_three_digit": """
        SELECT * FROM (
            SELECT split_part(p_brand, '#', 2) || CAST(p_size AS VARCHAR) || ' '
                       AS msic_group_code,
                   p_name AS group_desc_en, p_type AS group_desc_bm
            FROM part)
        WHERE length(trim(msic_group_code)) = 3
    """,
    "ns_epoch_to_timestamp": """
        SELECT event_id, epoch_ns(ts) AS epoch_ns, date_trunc('second', ts) AS ts_second
        FROM events
    """,
    "surrogate_key": """
        SELECT p_partkey,
               md5(COALESCE(code, '_dbt_utils_surrogate_key_null_')) AS code_key,
               md5(COALESCE(code, '_dbt_utils_surrogate_key_null_') || '-'
                   || COALESCE(CAST(p_size AS VARCHAR), '_dbt_utils_surrogate_key_null_'))
                   AS code_size_key
        FROM (SELECT *, CASE WHEN p_size = 1 THEN '' WHEN p_size = 2 THEN NULL
                             ELSE p_brand END AS code FROM part)
    """,
    # intermediate and dimensions
    "fuel_month_state": f"""
        SELECT CAST(date_trunc('month', record_date) AS DATE) AS year_month_date, {_DOUBLED_AVERAGES}
        FROM (SELECT s.*, CASE WHEN CAST(record_date AS DATE) = first THEN 2 ELSE 1 END AS f
              FROM stg_fuelprice s, (SELECT CAST(min(o_orderdate) AS DATE) AS first FROM orders))
        GROUP BY 1
    """,
    "fuel_average_six_places": """
        SELECT month, total, total / n AS average, round(total / n * 100) / 100 AS average_cents
        FROM (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, count(*) AS n,
                     CAST(sum(CAST((CAST(round(o_totalprice * 100) AS BIGINT) * 7919 % 5000011) / 1e6
                         AS DECIMAL(18,6))) AS DOUBLE) AS total
              FROM orders GROUP BY 1)
    """,
    "int_fuelprice_monthly": """
        SELECT * FROM int_fuelprice_monthly ORDER BY year_month_date NULLS LAST
    """,
    "int_trade_unioned": "SELECT * FROM trade_unioned",
    "date_ranges": "SELECT * FROM ranges",
    "dim_date": "SELECT * FROM dim_date",
    "dim_date_default": calendar("""(
        SELECT CAST(unnest(generate_series(DATE '2017-01-01',
            CAST(CAST(max(ts) AS DATE) + INTERVAL 1 MONTH AS DATE) - 1, INTERVAL 1 DAY)) AS DATE)
            AS full_date
        FROM events)
    """),
    "dim_date_limited": calendar("""(
        SELECT full_date FROM (
            SELECT CAST(unnest(generate_series(
                CAST(start_date - INTERVAL 12 MONTH AS DATE),
                CAST(end_date + INTERVAL 12 MONTH AS DATE) - 1, INTERVAL 1 DAY)) AS DATE)
                AS full_date
            FROM bounds)
        WHERE full_date >= (SELECT min(min_dt) FROM ranges)
          AND full_date <= (SELECT max(max_dt) FROM ranges))
    """),
    "dim_msic_group": "SELECT * FROM dim_msic_group",
    "dim_msic_group_maxstruct": "SELECT * FROM dim_msic_group",
    # joins and fact
    "join_trade_fuel_month": """
        SELECT t.*, f.*
        FROM stg_lines t
        LEFT JOIN int_fuelprice_monthly f
            ON CAST(date_trunc('month', t.record_date) AS DATE) = f.year_month_date
    """,
    "join_trade_date": """
        SELECT t.*,
               COALESCE(d.date_key, CAST(strftime(t.record_date, '%Y%m%d') AS INTEGER))
                   AS date_key
        FROM stg_lines t LEFT JOIN dim_date d ON t.record_date = d.full_date
    """,
    "join_trade_group": """
        SELECT t.*, COALESCE(g.msic_group_key, 'UNKNOWN') AS msic_group_key
        FROM stg_lines t LEFT JOIN dim_msic_group g ON t.msic_group_code = g.msic_group_code
    """,
    "fct_retail_sales_monthly": "SELECT * FROM fact",
    "fct_line_grain": "SELECT * FROM fact_lines",
    "fct_unknown_member": "SELECT * FROM fact_incomplete WHERE msic_group_key = 'UNKNOWN'",
    "fct_since_fuel_start": """
        SELECT * FROM fact_lines
        WHERE record_date >= (
            SELECT CAST(date_trunc('month', min(record_date)) AS DATE) FROM stg_fuelprice
            WHERE diesel_eastmsia_price_rm IS NOT NULL)
    """,
    "fct_partitioned_readback": "SELECT * FROM fact_lines",
    # quality
    "dq_unique_date_key": _unique_checked("dim_date", "date_key"),
    "dq_unique_full_date": _unique_checked("dim_date", "full_date"),
    "dq_unique_group_key": _unique_checked("dim_msic_group", "msic_group_key"),
    "dq_unique_group_code": _unique_checked("dim_msic_group", "msic_group_code"),
    "dq_unique_lookup_code": """
        SELECT msic_group_code, count(*) AS n_rows FROM stg_msic_lookup
        GROUP BY 1 HAVING count(*) > 1
    """,
    "dq_not_null": _status(
        *_DIMENSION_CHECKS,
        *_FACT_NOT_NULL,
        *[
            _not_null(_FACT, p, "fact_lines", "warn")
            for p in (
                "avg_ron95_price_rm",
                "avg_ron97_price_rm",
                "avg_diesel_peninsular_price_rm",
            )
        ],
    ),
    "dq_relationships_date": _orphans("date_key", "dim_date"),
    "dq_relationships_group": _orphans("msic_group_key", "incomplete_groups", "fact_incomplete"),
    "dq_expression_true": _status(
        *_FACT_EXPRESSIONS,
        _count(
            "expression_is_true",
            _FACT,
            "volume_index",
            "warn",
            "fact_lines",
            "NOT (volume_index >= 10)",
        ),
    ),
    "dq_not_a_number": _status(
        _count("expression_is_true", "lineitem", "ratio", "error", "lineitem", "l_discount = 0")
    ),
    "dq_stg_iowrt_date": _status(*_HEADLINE_CHECKS),
    "dq_accepted_values": _status(
        *_ACCEPTED,
        _accepted("trade_lines", "short_list", "series", "'abs'", "warn"),
    ),
    "dq_summary": _status(
        *_DIMENSION_CHECKS,
        _unique("dim_date", "date_key"),
        _unique("dim_date", "full_date"),
        _unique("dim_msic_group", "msic_group_key"),
        _unique("dim_msic_group", "msic_group_code"),
        *_FACT_NOT_NULL,
        *_FACT_EXPRESSIONS,
        _orphan_rows("date_key", "dim_date"),
        _orphan_rows("msic_group_key", "dim_msic_group"),
        *_HEADLINE_CHECKS,
        *_ACCEPTED,
    ),
    # analyses
    "growth_mom": _growth(1),
    "growth_yoy": _growth(12),
    "fuel_change_weekly": """
        SELECT week_start, product, price_rm,
               round((price_rm - lag(price_rm) OVER (PARTITION BY product ORDER BY week_start))
                     * 100) / 100 AS change_rm
        FROM (
            SELECT CAST(date_trunc('week', record_date) AS DATE) AS week_start, product,
                   round(CAST(SUM(CAST(price AS DECIMAL(28,4))) AS DOUBLE) / count(price) * 100) / 100 AS price_rm
            FROM (
                SELECT record_date, 'ron95_price_rm' AS product, ron95_price_rm AS price
                FROM stg_fuelprice
                UNION ALL
                SELECT record_date, 'ron97_price_rm', ron97_price_rm FROM stg_fuelprice
                UNION ALL
                SELECT record_date, 'diesel_peninsular_price_rm', diesel_peninsular_price_rm
                FROM stg_fuelprice
                UNION ALL
                SELECT record_date, 'diesel_eastmsia_price_rm', diesel_eastmsia_price_rm
                FROM stg_fuelprice)
            WHERE price IS NOT NULL
            GROUP BY 1, 2)
    """,
    "kpi_recent_sales": """
        SELECT *,
               CASE WHEN previous_sales_rm_mil <> 0 THEN
                   round((sales_rm_mil - previous_sales_rm_mil) / previous_sales_rm_mil
                         * 100 * 100) / 100 END AS change_percent
        FROM (
            SELECT latest AS latest_month,
                   round(sum(CASE WHEN record_date = latest THEN sales_value_rm_mil END) * 100)
                       / 100 AS sales_rm_mil,
                   round(sum(CASE WHEN record_date = CAST(latest - INTERVAL 1 MONTH AS DATE)
                                  THEN sales_value_rm_mil END) * 100)
                       / 100 AS previous_sales_rm_mil
            FROM fact_lines, (SELECT max(record_date) AS latest FROM fact_lines)
            GROUP BY latest)
    """,
    "trend_monthly": _TREND,
    "combo_sales_fuel": f"""
        SELECT year, month, measure, value FROM (
            UNPIVOT ({_TREND})
            ON total_sales_rm_mil, avg_ron95_price_rm, avg_ron97_price_rm,
               avg_diesel_peninsular_price_rm
            INTO NAME measure VALUE value)
    """,
    "sales_by_group": """
        SELECT t.*, g.msic_group_code, g.group_desc_en
        FROM (
            SELECT msic_group_key,
                   round(sum(sales_value_rm_mil) * 100) / 100 AS total_sales_rm_mil,
                   count(DISTINCT year * 100 + month) AS n_months
            FROM fact_lines GROUP BY 1) t
        LEFT JOIN dim_msic_group g ON t.msic_group_key = g.msic_group_key
    """,
    "sales_filtered": """
        SELECT * FROM fact_lines
        WHERE record_date BETWEEN DATE '1997-11-01' AND DATE '1999-02-28'
          AND msic_group_code IN ('Brand#11', 'Brand#13', 'Brand#42')
    """,
    "sales_in_quarter": """
        SELECT year, month, round(sum(sales_value_rm_mil) * 100) / 100 AS total_sales_rm_mil,
               count(*) AS n_rows
        FROM fact_lines WHERE month IN (4, 5, 6) GROUP BY year, month
    """,
    "corr_sales_fuel": f"SELECT {_CORRELATIONS} FROM fact",
    "corr_by_group": f"SELECT msic_group_code, {_CORRELATIONS} FROM fact GROUP BY 1",
    "seasonality": """
        SELECT month, round(CAST(SUM(CAST(total AS DECIMAL(28,4))) AS DOUBLE) / count(total) * 100) / 100 AS avg_sales_rm_mil, count(*) AS n_years
        FROM (SELECT year, month, CAST(sum(CAST(sales_value_rm_mil AS DECIMAL(28,4))) AS DOUBLE) AS total
              FROM fact_lines GROUP BY 1, 2)
        GROUP BY 1
    """,
}
