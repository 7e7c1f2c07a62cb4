"""DuckDB SQL for the queries over whole runs."""

from __future__ import annotations

from tidemark.config import TABLES
from tidemark.plans.gold import GOLD
from verification import oracle_kpi, oracle_quality
from verification.oracle_base import ratio, ratio_units, with_tables
from verification.oracle_quality import CORE, EVERY, VIOLATION_HISTORY, standard_findings, statuses, strict_findings, union
from verification.settings import AS_OF, RUN_ID

_PRESENT = {
    "orders": ("order_id", "customer_id"), "order_items": ("price",), "order_payments": ("payment_value",),
    "customers": ("customer_id", "customer_unique_id"), "products": ("product_id",), "sellers": ("seller_id",),
    "order_reviews": ("review_id", "order_id"), "geolocation": ("geolocation_zip_code_prefix",),
}
_RANGES = {
    "order_reviews": [("review_score outside 1..5", "review_score BETWEEN 1 AND 5")],
    "geolocation": [
        ("latitude outside range", "geolocation_lat BETWEEN -35 AND 5"),
        ("longitude outside range", "geolocation_lng BETWEEN -74 AND -34"),
    ],
}


def _outcome(table: str) -> str:
    nulls = [(f"{c} is null", f"{c} IS NOT NULL") for c in _PRESENT[table]]
    rules = _RANGES.get(table, []) + nulls if table == "geolocation" else nulls + _RANGES.get(table, [])
    return "CASE " + " ".join(f"WHEN NOT coalesce({rule}, false) THEN '{name}'" for name, rule in rules) + " ELSE 'kept' END"


def _family(name: str, findings: str) -> str:
    return f"""
        SELECT '{RUN_ID}' AS run_id, '{name}' AS family, count(*) AS total_checks, count(*) FILTER (status = 'PASSED') AS passed,
               count(*) FILTER (status = 'FAILED') AS failed,
               CASE WHEN bool_and(status = 'PASSED') THEN 'PASSED' ELSE 'FAILED' END AS overall_status,
               CAST(sum(findings) AS BIGINT) AS violations FROM ({statuses(findings)})"""


_DROP = ratio("(past_rows - row_count * past_days) * 100", "past_rows", 2)
_LOADED = "TIMESTAMP '2024-01-30 06:00:00'"
_AGE = ratio_units(f"epoch_us(TIMESTAMP '{AS_OF}') - epoch_us({_LOADED})", "3600000000", 1)



def _samples(table: str) -> str:
    repeated = f"""
        SELECT 'duplicate_check' AS check_name, '{TABLES[table].bronze}' AS table_name, CAST(NULL AS VARCHAR) AS column_name, _row_hash AS row_hash
        FROM b_{table} WHERE _row_hash IN (SELECT _row_hash FROM b_{table} GROUP BY 1 HAVING count(*) > 1 ORDER BY 1 LIMIT 5)
        ORDER BY _row_hash LIMIT 5"""
    nulls = [
        f"""SELECT 'null_check', '{TABLES[table].bronze}', '{column}', _row_hash FROM b_{table} WHERE {column} IS NULL ORDER BY _row_hash LIMIT 5"""
        for column in TABLES[table].critical
    ]
    return union([repeated, *nulls])


def _registered(table: str) -> str:
    """Outcome rows of the registered checks of one table: a row per finding, or one without."""
    spec, name = TABLES[table], TABLES[table].bronze
    share = "0.4" if table == "orders" else "0"
    least = "1" if table == "sellers" else "(SELECT count(*) * 0.75 FROM orders)"
    hits = {"null_share": [(c, f"count(*) FILTER ({c} IS NULL)", f"100.0 * v / n > {share}") for c in spec.critical]}
    if spec.value_columns:
        hits["negative_share"] = [(c, f"count(*) FILTER ({c} < 0)", "100.0 * v / n > 0") for c in spec.value_columns]
    hits["least_rows"] = [(None, f"CAST(ceil({least}) AS BIGINT) - count(*)", f"n < {least}")]
    if table == "order_items":
        hits["free_freight"] = [("freight_value", "count(*) FILTER (freight_value = 0)", "v > 0")]
    parts = []
    for check, rows in hits.items():
        found = union([
            f"""SELECT {f"'{c}'" if c else "CAST(NULL AS VARCHAR)"} AS c, CAST(v AS BIGINT) AS v, {hit} AS hit
                FROM (SELECT count(*) AS n, {value} AS v FROM b_{table})""" for c, value, hit in rows
        ])
        parts.append(f"""
            SELECT '{check}' AS check_name, '{name}' AS table_name, 'FAILED' AS status, (SELECT count(*) FROM b_{table}) AS rows_scanned,
                   c AS column_name, v AS violation_count FROM ({found}) WHERE hit
            UNION ALL SELECT '{check}', '{name}', 'PASSED', (SELECT count(*) FROM b_{table}), NULL, NULL
            FROM (SELECT bool_or(hit) AS any_hit FROM ({found})) WHERE NOT any_hit""")
    return " UNION ALL ".join(f"SELECT * FROM ({p})" for p in parts)


QUERIES: dict[str, str] = {
    "registered_checks": with_tables(union([_registered(t) for t in TABLES]), bronze_tables=EVERY),
    "load_outcomes": f"""
        SELECT 'bronze_orders' AS table_name, 'FAILED' AS load_status, CAST(NULL AS BIGINT) AS rows_loaded, 'critical' AS reason,
               CAST(NULL AS VARCHAR) AS missing_columns, CAST(NULL AS VARCHAR) AS extra_columns, CAST(NULL AS VARCHAR) AS inferred_type
        UNION ALL SELECT 'bronze_products', 'FAILED', NULL, 'no file', NULL, NULL, NULL
        UNION ALL SELECT 'bronze_customers', CASE WHEN count(*) < 90000 THEN 'PARTIAL' ELSE 'SUCCESS' END, count(*), NULL, 'customer_city', 'town', NULL FROM customer
        UNION ALL SELECT 'bronze_sellers', CASE WHEN count(*) < 3000 THEN 'PARTIAL' ELSE 'SUCCESS' END, count(*), NULL, NULL, NULL, NULL FROM supplier
        UNION ALL SELECT 'bronze_coupons', 'SUCCESS', count(*), NULL, NULL, NULL, 'int' FROM supplier""",
    "sql_views": with_tables(
        """SELECT order_status, count(*) AS payments, CAST(count(*) FILTER (is_high_value) AS BIGINT) AS high_value
           FROM s_orders JOIN s_order_payments USING (order_id) GROUP BY 1""",
        silver_tables=("orders", "order_payments"),
    ),
    "isolated_failure": with_tables(
        f"""SELECT check_name, table_name, CASE WHEN broken THEN 'ERROR' ELSE status END AS status, CASE WHEN broken THEN 0 ELSE findings END AS findings
            FROM (SELECT *, check_name = 'duplicate_check' AND table_name = 'bronze_customers' AS broken FROM ({statuses(standard_findings())}))""",
        bronze_tables=CORE,
    ),
    "dq_sample_rows": with_tables(union([_samples(t) for t in CORE]), bronze_tables=CORE),
    "money_extremes": """
        SELECT l_returnflag, CAST(CAST(
                   count(*) FILTER (k = 0) * CAST('0.0000400' AS DECIMAL(38, 7)) + count(*) FILTER (k = 1) * CAST('12345678901234568' AS DECIMAL(38, 7))
                   + count(*) FILTER (k = 4) * CAST('0.1234567' AS DECIMAL(38, 7))
                   + coalesce(sum(CAST(l_extendedprice AS DECIMAL(38, 7))) FILTER (k > 4), 0) AS DECIMAL(38, 7)) AS VARCHAR) AS total,
               count(*) AS amounts, count(*) FILTER (k IN (2, 3)) AS left_out
        FROM (SELECT *, l_orderkey % 11 AS k FROM lineitem) GROUP BY 1""",
    "dq_outcomes_concurrent": oracle_quality.QUERIES["dq_outcomes"],
    "dq_run_records": with_tables(union([_family("standard", standard_findings()), _family("strict", strict_findings())]), bronze_tables=EVERY),
    "gold_partial_rebuild": oracle_kpi.QUERIES["gold_daily_revenue"],
    "quarantine_split": with_tables(
        union([f"SELECT 'silver_{t}' AS table_name, {_outcome(t)} AS outcome, count(*) AS row_count FROM b_{t} GROUP BY 2" for t in TABLES]),
        bronze_tables=EVERY,
    ),
    "layer_runs": f"""
        SELECT 'silver' AS layer, table_name, 'SUCCESS' AS status, rows_in, rows_kept, rows_rejected,
               CASE table_name WHEN 'silver_geolocation' THEN ({"SELECT count(*) FROM (" + oracle_kpi.QUERIES["silver_geolocation"] + ")"})
                    ELSE rows_kept END AS rows_out
        FROM ({oracle_kpi.QUERIES["silver_run_summary"]})
        UNION ALL """ + " UNION ALL ".join(
        f"SELECT 'gold', '{name}', 'SUCCESS', NULL, NULL, NULL, count(*) FROM ({oracle_kpi.QUERIES[name]})" for name in GOLD
    ),
    "rolling_volume_calendar": f"""
        WITH seen AS (SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM events WHERE day(ts) <> 9 GROUP BY 1),
        filled AS (
          SELECT CAST(d AS DATE) AS day, coalesce(n, 0) AS row_count
          FROM (SELECT unnest(generate_series((SELECT min(day) FROM seen), (SELECT max(day) FROM seen), INTERVAL 1 DAY)) AS d) AS s
          LEFT JOIN seen ON seen.day = CAST(s.d AS DATE))
        SELECT day, row_count, {ratio("past_rows", "past_days", 2)} AS rolling_mean, {_DROP} AS drop_pct,
               coalesce({_DROP} > 5, false) AS volume_drop, row_count = 0 AS missing
        FROM (SELECT *, sum(row_count) OVER w AS past_rows, count(row_count) OVER w AS past_days FROM filled
              WINDOW w AS (ORDER BY day ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING))""",
    "finding_spans": f"""
        WITH runs AS (SELECT t, row_number() OVER (ORDER BY t) AS run FROM (SELECT DISTINCT date_trunc('quarter', o_orderdate) AS t FROM orders)),
        seen AS (
          SELECT check_name, table_name, run, t, violation_count, run - row_number() OVER (PARTITION BY check_name, table_name ORDER BY run) AS island
          FROM ({VIOLATION_HISTORY}) JOIN runs ON t = check_timestamp WHERE severity = 'CRITICAL'),
        islands AS (
          SELECT check_name, table_name, min(t) AS since, max(t) AS last_seen, count(*) AS runs_in_a_row, max(run) AS last_run,
                 CAST(arg_max(violation_count, run) AS BIGINT) AS affected_rows FROM seen GROUP BY check_name, table_name, island)
        SELECT check_name, table_name, arg_max(since, last_run) AS since, max(last_seen) AS last_seen, arg_max(runs_in_a_row, last_run) AS runs_in_a_row,
               arg_max(affected_rows, last_run) AS affected_rows, CAST(sum(runs_in_a_row) AS BIGINT) AS runs_seen, count(*) - 1 AS reopenings,
               max(last_run) = (SELECT max(run) FROM runs) AS is_open
        FROM islands GROUP BY 1, 2""",
    "monthly_distinct_orders": """
        SELECT l_returnflag, CAST(date_trunc('month', l_shipdate) AS DATE) AS month, count(DISTINCT l_orderkey) AS distinct_ids
        FROM lineitem GROUP BY 1, 2""",
    "stream_checks": f"""
        WITH base AS (
          SELECT count(*) + 2 * count(*) FILTER (event_id % 30 = 0) AS n, 2 * count(*) FILTER (event_id % 30 = 0) AS extra,
                 count(*) FILTER (event_id % 97 = 0) + 2 * count(*) FILTER (event_id % 97 = 0 AND event_id % 30 = 0)
                   + count(*) FILTER (value IS NULL AND event_id % 97 <> 0) AS v, count(*) FILTER (user_id IS NULL) AS u FROM events),
        shares AS (SELECT *, {ratio_units("v * 100", "n", 2)} AS share, {ratio_units("(1000000 - n) * 100", "1000000", 1)} AS missing FROM base)
        SELECT 'duplicate_check' AS check_name, 'bronze_events' AS table_name, CASE WHEN extra > 0 THEN 'FAILED' ELSE 'PASSED' END AS status,
               n AS rows_scanned, CAST(NULL AS VARCHAR) AS column_name,
               CASE WHEN extra > 100 THEN 'CRITICAL' WHEN extra > 0 THEN 'WARNING' END AS severity, nullif(extra, 0) AS violation_count FROM shares
        UNION ALL SELECT 'null_check', 'bronze_events', CASE WHEN v > 0 THEN 'FAILED' ELSE 'PASSED' END, n, CASE WHEN v > 0 THEN 'value' END,
               CASE WHEN share > 100 THEN 'CRITICAL' WHEN v > 0 THEN 'WARNING' END, nullif(v, 0) FROM shares
        UNION ALL SELECT 'staleness_check', 'bronze_events', 'FAILED', n, NULL, CASE WHEN {_AGE} > 480 THEN 'CRITICAL' ELSE 'WARNING' END, 1 FROM shares
        UNION ALL SELECT 'volume_check', 'bronze_events', CASE WHEN n < 1000000 THEN 'FAILED' ELSE 'PASSED' END, n, NULL,
               CASE WHEN n < 1000000 THEN CASE WHEN missing > 200 THEN 'CRITICAL' ELSE 'WARNING' END END,
               CASE WHEN n < 1000000 THEN 1000000 - n END FROM shares""",
}
