"""DuckDB SQL for the quality checks, the load queries and the audit queries."""

from __future__ import annotations

from tidemark.config import CORE_TABLES, TABLES
from tidemark.sources.schemas import SOURCE_DDL, source_columns
from verification.oracle_base import SOURCE, bronze, cents, ratio, ratio_text, ratio_units, row_hash, with_tables
from verification.settings import AS_OF, ENVIRONMENT, PIPELINE, RUN_ID, SCALED_DOWN, STATUS_TABLES

NOW = f"TIMESTAMP '{AS_OF}'"


def union(parts: list[str]) -> str:
    return " UNION ALL ".join(f"({part})" for part in parts)


# ---- Standard checks: one SELECT of findings per check and table -------------------------

FIELDS = "check_name, table_name, rows_scanned, column_name, severity, violation_count, violation_detail"


def duplicate_findings(table: str, strict: bool = False) -> str:
    severity = "'CRITICAL'" if strict else "CASE WHEN extra > 100 THEN 'CRITICAL' ELSE 'WARNING' END"
    return f"""
        SELECT '{'strict_' if strict else ''}duplicate_check' AS check_name, '{TABLES[table].bronze}' AS table_name,
               total AS rows_scanned, CAST(NULL AS VARCHAR) AS column_name, {severity} AS severity, extra AS violation_count,
               groups || ' repeated rows, ' || extra || ' rows too many' AS violation_detail, extra > 0 AS hit
        FROM (SELECT CAST(coalesce(sum(n), 0) AS BIGINT) AS total, count(*) FILTER (n > 1) AS groups,
                     CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS extra
              FROM (SELECT count(*) AS n FROM b_{table} GROUP BY _row_hash))"""


def conflict_findings(table: str) -> str:
    keys = TABLES[table].business_key
    return f"""
        SELECT 'strict_duplicate_check' AS check_name, '{TABLES[table].bronze}' AS table_name,
               (SELECT count(*) FROM b_{table}) AS rows_scanned, '{",".join(keys)}' AS column_name,
               'WARNING' AS severity, n AS violation_count,
               n || ' keys have rows with different values' AS violation_detail, n > 0 AS hit
        FROM (SELECT count(*) AS n FROM (SELECT {", ".join(keys)} FROM b_{table} GROUP BY ALL
              HAVING count(*) > 1 AND count(DISTINCT _row_hash) > 1))"""


def null_findings(table: str, strict: bool = False) -> str:
    def one(column: str) -> str:
        share = ratio_units("nulls * 100", "total", 2)
        severity = (
            f"CASE WHEN {share} >= 1000 THEN 'CRITICAL' WHEN {share} >= 100 THEN 'WARNING' ELSE 'INFO' END"
            if strict
            else f"CASE WHEN {share} > 100 THEN 'CRITICAL' ELSE 'WARNING' END"
        )
        return f"""
            SELECT '{'strict_' if strict else ''}null_check' AS check_name, '{TABLES[table].bronze}' AS table_name,
                   total AS rows_scanned, '{column}' AS column_name, {severity} AS severity, nulls AS violation_count,
                   '{column} is null in ' || nulls || ' of ' || total || ' rows (' || {ratio_text("nulls * 100", "total", 2)}
                   || '%)' AS violation_detail, nulls > 0 AS hit
            FROM (SELECT count(*) AS total, count(*) - count({column}) AS nulls FROM b_{table})"""

    return union([one(column) for column in TABLES[table].critical])


def _age_micros() -> str:
    return f"(epoch_us({NOW}) - epoch_us(latest))"


def staleness_findings(table: str, strict: bool = False) -> str:
    age, hour = _age_micros(), 3_600_000_000
    name = TABLES[table].bronze
    if strict:
        text = f"""'data is ' || {ratio_text(age, str(hour), 1)} || ' hours old' ||
            CASE WHEN {age} > 72 * {hour} THEN ', nothing loaded for ' || ({age} // (24 * {hour})) || ' days'
                 WHEN {age} > 48 * {hour} THEN ', at least one daily load is missing' ELSE ', a load may be late' END"""
        body = f"""CASE WHEN {age} > 48 * {hour} THEN 'CRITICAL' ELSE 'WARNING' END AS severity,
            total AS violation_count, {text} AS violation_detail, {age} > 25 * {hour} AS hit"""
    else:
        tenths = ratio_units(age, str(hour), 1)
        body = f"""CASE WHEN {tenths} > 480 THEN 'CRITICAL' ELSE 'WARNING' END AS severity,
            CAST(1 AS BIGINT) AS violation_count,
            '{name} is ' || {ratio_text(age, str(hour), 1)} || ' hours old, last loaded ' ||
            strftime(latest, '%Y-%m-%d %H:%M:%S') || ', limit 24 hours' AS violation_detail, {tenths} > 240 AS hit"""
    return f"""
        SELECT '{'strict_' if strict else ''}staleness_check' AS check_name, '{name}' AS table_name,
               total AS rows_scanned, CAST(NULL AS VARCHAR) AS column_name, {body}
        FROM (SELECT count(*) AS total, max(_ingestion_timestamp) AS latest FROM b_{table})"""


def volume_findings(table: str) -> str:
    name, least = TABLES[table].bronze, TABLES[table].min_rows
    missing = f"({least} - total)"
    return f"""
        SELECT 'volume_check' AS check_name, '{name}' AS table_name, total AS rows_scanned,
               CAST(NULL AS VARCHAR) AS column_name,
               CASE WHEN {ratio_units(f"abs({missing}) * 100", str(least), 1)} > 200 THEN 'CRITICAL' ELSE 'WARNING' END AS severity,
               CAST({missing} AS BIGINT) AS violation_count,
               '{name} has ' || total || ' rows, ' || {missing} || ' fewer than the expected {least} ('
               || {ratio_text(f"abs({missing}) * 100", str(least), 1)} || '%)' AS violation_detail,
               total < {least} AS hit
        FROM (SELECT count(*) AS total FROM b_{table})"""


DAYS = f"""
    SELECT *, count(*) OVER () AS day_count, avg(daily_revenue) OVER () AS mean_revenue,
           greatest(coalesce(nullif(stddev_samp(daily_revenue) OVER (), 0), 1), 0.01) AS spread
    FROM (SELECT CAST(TRY_CAST(order_purchase_timestamp AS TIMESTAMP) AS DATE) AS order_date,
                 CAST(sum({cents("payment_value")}) AS DOUBLE) / 100 AS daily_revenue
          FROM b_order_payments JOIN b_orders USING (order_id) GROUP BY 1)"""

REVENUE = f"""
    SELECT 'revenue_anomaly_check' AS check_name, 'bronze_order_payments' AS table_name, day_count AS rows_scanned,
           CAST(NULL AS VARCHAR) AS column_name, CASE WHEN top_z > 5 THEN 'CRITICAL' ELSE 'WARNING' END AS severity,
           flagged AS violation_count,
           printf('%d unusual revenue days of %d, most unusual %s with revenue %.2f (z-score %.1f, limit 3.0), mean %.2f a day',
                  flagged, day_count, top_day, top_revenue, top_z, mean_revenue) AS violation_detail,
           day_count >= 7 AND flagged > 0 AS hit
    FROM (SELECT count(*) AS day_count, count(*) FILTER (z > 3) AS flagged, max(z) AS top_z,
                 coalesce(CAST(arg_max(struct_pack(d := order_date), z).d AS VARCHAR), 'unknown') AS top_day,
                 arg_max(daily_revenue, z) AS top_revenue, max(mean_revenue) AS mean_revenue
          FROM (SELECT *, abs((daily_revenue - mean_revenue) / spread) AS z FROM ({DAYS})))"""


def standard_findings(tables: tuple[str, ...] = CORE_TABLES) -> str:
    parts = [make(t) for t in tables for make in (duplicate_findings, null_findings, staleness_findings, volume_findings)]
    return union(parts + [REVENUE])


CORE = tuple(CORE_TABLES)
EVERY = tuple(TABLES)


def violations(findings: str) -> str:
    return f"""
        SELECT md5(concat_ws('|', '{RUN_ID}', check_name, table_name, coalesce(column_name, ''), violation_detail)) AS violation_id,
               '{RUN_ID}' AS run_id, check_name, table_name, column_name, severity, violation_count, violation_detail,
               {NOW} AS check_timestamp, '{ENVIRONMENT}' AS environment
        FROM ({findings}) WHERE hit"""


def statuses(findings: str) -> str:
    return f"""SELECT check_name, table_name, max(rows_scanned) AS rows_scanned,
                      CASE WHEN bool_or(hit) THEN 'FAILED' ELSE 'PASSED' END AS status,
                      count(*) FILTER (hit) AS findings FROM ({findings}) GROUP BY 1, 2"""


def check(findings: list[str], tables: tuple[str, ...]) -> str:
    return with_tables(f"SELECT {FIELDS} FROM ({union(findings)}) WHERE hit", bronze_tables=tables)


# ---- Value checks -------------------------------------------------------------------------


def value_row(table: str, column: str, source: str) -> str:
    return f"""
        SELECT '{table}' AS table_name, '{column}' AS column_name, value_count, mean, deviation, q1, q3,
               count(*) FILTER (deviation > 0 AND abs((x - mean) / deviation) > 3) AS z_outliers,
               count(*) FILTER (q3 > q1 AND (x > q3 + 3 * (q3 - q1) OR x < q1 - 3 * (q3 - q1))) AS iqr_outliers,
               count(*) FILTER (x = 0) AS zero_values, count(*) FILTER (x < 0) AS negative_values
        FROM (SELECT {column} AS x FROM {source} WHERE {column} IS NOT NULL),
             (SELECT count({column}) AS value_count, avg({column}) AS mean, stddev_samp({column}) AS deviation,
                     quantile_disc({column}, 0.25) AS q1, quantile_disc({column}, 0.75) AS q3 FROM {source})
        GROUP BY ALL"""


VALUES = union(
    [
        value_row("order_payments", "payment_value", "b_order_payments"),
        value_row("order_items", "price", "b_order_items"),
        value_row("order_items", "freight_value", "b_order_items"),
        value_row("events", "value", "events"),
        value_row("customer", "c_acctbal", "customer"),
    ]
)


def values(columns: str, where: str = "true") -> str:
    return with_tables(
        f"SELECT table_name, column_name, {columns} FROM ({VALUES}) WHERE {where}",
        bronze_tables=("order_payments", "order_items"),
    )


def strict_value_findings(table: str) -> str:
    kinds = {
        "z_outliers": ("WARNING", "printf('%d values with a z-score above 3.0 (mean %.2f, deviation %.2f)', z_outliers, mean, deviation)"),
        "iqr_outliers": (
            "WARNING",
            "printf('%d values outside [%.2f, %.2f] (Q1 %.2f, Q3 %.2f, IQR %.2f)', iqr_outliers, "
            "q1 - 3 * (q3 - q1), q3 + 3 * (q3 - q1), q1, q3, q3 - q1)",
        ),
        "zero_values": ("INFO", "zero_values || ' values are zero'"),
        "negative_values": ("WARNING", "negative_values || ' values are negative'"),
    }
    return union(
        [
            f"""SELECT 'strict_value_check' AS check_name, '{TABLES[table].bronze}' AS table_name,
                       value_count AS rows_scanned, column_name, '{severity}' AS severity, {field} AS violation_count,
                       {text} AS violation_detail, value_count >= 30 AND {field} > 0 AS hit
                FROM ({value_row(table, column, f"b_{table}")})"""
            for column in TABLES[table].value_columns
            for field, (severity, text) in kinds.items()
        ]
    )


def furthest_values(table: str, column: str, source: str) -> str:
    """The five furthest values of either kind of outlier, one row each."""
    stats = f"""(SELECT avg({column}) AS mean, stddev_samp({column}) AS deviation,
        quantile_disc({column}, 0.25) AS q1, quantile_disc({column}, 0.75) AS q3 FROM {source})"""
    kinds = {
        "z_outliers": ("abs(x - mean)", "deviation > 0 AND abs((x - mean) / deviation) > 3"),
        "iqr_outliers": (
            "greatest(x - (q3 + 3 * (q3 - q1)), q1 - 3 * (q3 - q1) - x)",
            "q3 > q1 AND (x > q3 + 3 * (q3 - q1) OR x < q1 - 3 * (q3 - q1))",
        ),
    }
    return union([
        f"""SELECT '{table}' AS table_name, '{column}' AS column_name, '{kind}' AS test, CAST(place AS INTEGER) AS place, x AS value
            FROM (SELECT x, row_number() OVER (ORDER BY {distance} DESC, x) AS place
                  FROM (SELECT {column} AS x FROM {source} WHERE {column} IS NOT NULL), {stats} WHERE {test}) WHERE place <= 5"""
        for kind, (distance, test) in kinds.items()
    ])


def strict_findings() -> str:
    parts = []
    for table, spec in TABLES.items():
        parts += [duplicate_findings(table, True), null_findings(table, True), staleness_findings(table, True)]
        if spec.business_key:
            parts.append(conflict_findings(table))
        if spec.value_columns:
            parts.append(strict_value_findings(table))
    return union(parts)


# ---- Loads and audit log ------------------------------------------------------------------

LOAD_STATUS = union(
    [
        f"""SELECT '{TABLES[t].bronze}' AS table_name, count(*) AS rows_loaded,
                   CAST({TABLES[t].min_rows // SCALED_DOWN} AS BIGINT) AS rows_expected_min,
                   CASE WHEN count(*) < {TABLES[t].min_rows // SCALED_DOWN} THEN 'PARTIAL' ELSE 'SUCCESS' END AS load_status
            FROM ({SOURCE[t]})"""
        for t in STATUS_TABLES
    ]
)

AUDIT = """
    SELECT event_type || '-' || CAST(CAST(ts AS DATE) AS VARCHAR) AS audit_id, event_type AS table_name,
           CASE WHEN count(*) FILTER (user_id % 97 = 0) * 50 > count(*) THEN 'FAILED' WHEN count(*) < 66 THEN 'PARTIAL' ELSE 'SUCCESS' END AS load_status,
           count(*) AS rows_loaded, CAST(66 AS BIGINT) AS rows_expected_min, max(ts) AS ingestion_timestamp,
           'load-' || strftime(CAST(ts AS DATE), '%Y%m%d') AS load_id,
           CASE WHEN day(CAST(ts AS DATE)) % 7 = 1 THEN 'overwrite' ELSE 'append' END AS write_mode
    FROM events GROUP BY event_type, CAST(ts AS DATE)"""

HISTORY = f"""
    SELECT table_name, CAST(row_number() OVER (PARTITION BY table_name ORDER BY ingestion_timestamp, audit_id) - 1 AS INTEGER) AS version,
           load_id, write_mode, load_status, rows_loaded, ingestion_timestamp
    FROM ({AUDIT}) WHERE load_status IN ('SUCCESS', 'PARTIAL')"""

DRIFTED = {
    "orders": ("true", "['order_status']", "['promo_code']", "[]::VARCHAR[]", "['order_status']"),
    "order_items": ("true", "[]::VARCHAR[]", "[]::VARCHAR[]",
                    "['price: expected DoubleType, got StringType']", "[]::VARCHAR[]"),
}


def drift_row(table: str) -> str:
    plain = ("false", *["[]::VARCHAR[]"] * 4)
    drifted, missing, extra, types, critical = DRIFTED.get(table, plain)
    text = lambda items: f"array_to_string({items}, ',')"
    return f"""SELECT '{table}' AS table_name, count(*) AS row_count, {drifted} AS has_drift,
                      {text(missing)} AS missing_columns, {text(extra)} AS extra_columns,
                      {text(types)} AS type_mismatches, {text(critical)} AS critical_missing
               FROM ({SOURCE[table]})"""


VIOLATION_HISTORY = """
    SELECT 'null_check' AS check_name, date_trunc('quarter', o_orderdate) AS check_timestamp,
           CASE WHEN nulls * 5 > total THEN 'CRITICAL' ELSE 'WARNING' END AS severity, nulls AS violation_count,
           o_orderpriority AS table_name
    FROM (SELECT date_trunc('quarter', o_orderdate) AS o_orderdate, o_orderpriority, count(*) AS total,
                 count(*) FILTER (o_orderkey % 5 = 3) AS nulls FROM orders GROUP BY 1, 2)
    WHERE nulls > 0"""

EVENTS_PER_DAY = "SELECT CAST(ts AS DATE) AS day, count(*) AS row_count FROM events GROUP BY 1"

REDELIVERED = f"""
    SELECT {row_hash("orders")} AS _row_hash, TIMESTAMP '2024-01-30 06:00:00' AS loaded FROM ({SOURCE["orders"]})
    UNION ALL
    SELECT {row_hash("orders")}, TIMESTAMP '2024-01-31 06:00:00' FROM ({SOURCE["orders"]}) WHERE CAST(order_id AS BIGINT) % 50 = 3"""


def null_sample(table: str) -> str:
    return union(
        [
            f"""SELECT '{table}' AS table_name, '{column}' AS column_name, _row_hash FROM b_{table}
                WHERE {column} IS NULL ORDER BY _row_hash LIMIT 5"""
            for column in TABLES[table].critical
        ]
    )


QUERIES: dict[str, str] = {
    "row_hash": f"SELECT order_id, {row_hash('orders')} AS _row_hash FROM ({SOURCE['orders']})",
    "load_metadata": f"""SELECT order_id, TIMESTAMP '{AS_OF}' AS _ingestion_timestamp,
                                'olist_order_payments_dataset.csv' AS _source_file, '1.0.0' AS _pipeline_version,
                                {row_hash('order_payments')} AS _row_hash FROM ({SOURCE['order_payments']})""",
    "schema_drift": union([drift_row(t) for t in TABLES]),
    "header_drift_counts": f"""
        SELECT 'bronze_order_items' AS table_name, c AS column_name, n AS row_count,
               CASE c WHEN 'price' THEN bad ELSE 0 END AS bad_values,
               'freight_value' AS missing_columns, 'freight' AS extra_columns
        FROM (SELECT count(*) AS n, count(*) FILTER (price IS NULL) AS bad FROM ({SOURCE['order_items']})),
             (VALUES ('order_item_id'), ('price')) AS v(c)""",
    "load_status": LOAD_STATUS,
    "load_status_by_outcome": f"""
        SELECT load_status, count(*) AS tables, string_agg(table_name, ',' ORDER BY table_name) AS table_names
        FROM ({LOAD_STATUS}) GROUP BY 1""",
    "bronze_load_audit": union(
        [
            f"""SELECT '{TABLES[t].bronze}' AS table_name, CASE WHEN count(*) < {TABLES[t].min_rows} THEN 'PARTIAL' ELSE 'SUCCESS' END AS load_status,
                       count(*) AS rows_loaded, CAST({TABLES[t].min_rows} AS BIGINT) AS rows_expected_min FROM ({SOURCE[t]})"""
            for t in TABLES
        ]
    ),
    "last_load_status": f"""
        SELECT table_name, arg_max(load_status, ingestion_timestamp) AS load_status,
               arg_max(rows_loaded, ingestion_timestamp) AS rows_loaded, max(ingestion_timestamp) AS loaded_at
        FROM ({AUDIT}) GROUP BY 1""",
    "audit_log_view": f"""SELECT table_name, load_status, rows_loaded, rows_expected_min, ingestion_timestamp FROM ({AUDIT})""",
    "load_history": HISTORY,
    "current_loads": f"""
        SELECT * EXCLUDE (base) FROM (
            SELECT *, coalesce(max(version) FILTER (write_mode = 'overwrite') OVER (PARTITION BY table_name), 0) AS base
            FROM ({HISTORY})) WHERE version >= base""",
    "snapshot_restore": f"""
        SELECT order_status, count(*) AS order_count, count(DISTINCT order_id) AS orders FROM ({SOURCE['orders']}) GROUP BY 1""",
    "incremental_append": f"""
        SELECT order_status, count(*) AS order_count FROM ({SOURCE['orders']}) GROUP BY 1""",
    "table_shapes": union(
        [
            f"""SELECT '{TABLES[t].bronze}' AS table_name, count(*) AS row_count,
                       CAST({len(source_columns(t)) + 4} AS INTEGER) AS column_count,
                       '_row_hash,_ingestion_timestamp,_source_file,_pipeline_version' AS metadata_columns FROM ({SOURCE[t]})"""
            for t in TABLES
        ]
    ),
    "table_preview": with_tables(
        "SELECT * FROM s_customers ORDER BY customer_id, customer_unique_id, customer_zip_code_prefix LIMIT 3",
        silver_tables=("customers",),
    ),
    "dup_rows": with_tables(
        union([f"SELECT {FIELDS} FROM ({duplicate_findings(t)})" for t in EVERY]), bronze_tables=EVERY
    ).replace(FIELDS, "table_name, rows_scanned AS row_count, violation_count AS extra_rows"),
    "dup_row_sample": with_tables(
        f"""SELECT {", ".join(source_columns("orders"))}, _row_hash FROM b_orders
            WHERE _row_hash IN (SELECT _row_hash FROM b_orders GROUP BY 1 HAVING count(*) > 1 ORDER BY 1 LIMIT 5)
            ORDER BY _row_hash LIMIT 5""",
        bronze_tables=("orders",),
    ),
    "dup_key_conflicts": with_tables(
        """SELECT order_id, payment_sequential, count(*) AS row_count FROM b_order_payments GROUP BY 1, 2
           HAVING count(*) > 1 AND count(DISTINCT _row_hash) > 1""",
        bronze_tables=("order_payments",),
    ),
    "duplicate_check": check([duplicate_findings(t) for t in EVERY], EVERY),
    "null_check_a": check([null_findings(t) for t in EVERY], EVERY),
    "null_check_b": check([null_findings(t, True) for t in EVERY], EVERY),
    "null_row_sample": with_tables(union([null_sample(t) for t in EVERY]), bronze_tables=EVERY),
    "staleness_a": check([staleness_findings(t) for t in EVERY], EVERY),
    "staleness_b": check([staleness_findings(t, True) for t in EVERY], EVERY),
    "volume_check": check([volume_findings(t) for t in EVERY], EVERY),
    "revenue_anomaly_days": with_tables(
        f"""SELECT order_date, daily_revenue, day_count, round(abs((daily_revenue - mean_revenue) / spread), 4) AS z_score
            FROM ({DAYS}) WHERE day_count >= 7 AND abs((daily_revenue - mean_revenue) / spread) > 3""",
        bronze_tables=("orders", "order_payments"),
    ),
    "value_outliers_z": values("value_count, z_outliers"),
    "value_outliers_iqr": values("q1, q3, iqr_outliers"),
    "outlier_values": with_tables(
        union([
            furthest_values("order_payments", "payment_value", "b_order_payments"),
            furthest_values("order_items", "price", "b_order_items"),
            furthest_values("order_items", "freight_value", "b_order_items"),
            furthest_values("events", "value", "events"),
            furthest_values("customer", "c_acctbal", "customer"),
        ]),
        bronze_tables=("order_payments", "order_items"),
    ),
    "zero_values": values("zero_values", "zero_values > 0"),
    "negative_values": values("negative_values", "negative_values > 0"),
    "dq_outcomes": with_tables(statuses(standard_findings()), bronze_tables=CORE),
    "dq_violations": with_tables(violations(standard_findings()), bronze_tables=CORE),
    "dq_summary": with_tables(
        f"""SELECT '{RUN_ID}' AS run_id, '{PIPELINE}' AS pipeline_name, count(*) AS total_checks,
                   count(*) FILTER (status = 'PASSED') AS passed, count(*) FILTER (status = 'FAILED') AS failed,
                   count(*) FILTER (status = 'ERROR') AS warnings,
                   CASE WHEN bool_and(status = 'PASSED') THEN 'PASSED' ELSE 'FAILED' END AS overall_status,
                   {NOW} AS run_timestamp, '{ENVIRONMENT}' AS environment FROM ({statuses(standard_findings())})""",
        bronze_tables=CORE,
    ),
    "dq_check_rollup": with_tables(
        f"""SELECT check_name, CASE WHEN bool_and(status = 'PASSED') THEN 'PASSED' ELSE 'FAILED' END AS overall,
                   CAST(sum(findings) AS BIGINT) AS violations, count(*) AS checks
            FROM ({statuses(standard_findings())}) GROUP BY 1""",
        bronze_tables=CORE,
    ),
    "dq_severity_counts": with_tables(
        f"SELECT severity, count(*) AS violations FROM ({standard_findings()}) WHERE hit GROUP BY 1", bronze_tables=CORE
    ),
    "dq_strict_violations": with_tables(violations(strict_findings()), bronze_tables=EVERY),
    "rolling_volume": f"""
        SELECT day, row_count, {ratio("past_rows", "past_days", 2)} AS rolling_mean,
               {ratio("(past_rows - row_count * past_days) * 100", "past_rows", 2)} AS drop_pct,
               coalesce({ratio("(past_rows - row_count * past_days) * 100", "past_rows", 2)} > 5, false) AS volume_drop
        FROM (SELECT *, sum(row_count) OVER w AS past_rows, count(row_count) OVER w AS past_days FROM ({EVENTS_PER_DAY})
              WINDOW w AS (ORDER BY day ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING))""",
    "cross_batch_duplicates": f"""
        SELECT first_loaded, last_loaded, count(*) AS repeated_rows, CAST(sum(n - 1) AS BIGINT) AS extra_rows
        FROM (SELECT count(*) AS n, min(loaded) AS first_loaded, max(loaded) AS last_loaded FROM ({REDELIVERED}) GROUP BY _row_hash)
        WHERE first_loaded < last_loaded GROUP BY 1, 2""",
    "violation_trend": f"""
        SELECT *, affected_rows - lag(affected_rows) OVER (PARTITION BY check_name, severity ORDER BY check_date) AS change
        FROM (SELECT CAST(check_timestamp AS DATE) AS check_date, check_name, severity, count(*) AS violations,
                     CAST(sum(violation_count) AS BIGINT) AS affected_rows FROM ({VIOLATION_HISTORY}) GROUP BY 1, 2, 3)""",
    "open_critical": f"""
        SELECT check_name, table_name, check_timestamp, violation_count FROM ({VIOLATION_HISTORY})
        WHERE severity = 'CRITICAL' AND check_timestamp = (SELECT date_trunc('quarter', max(o_orderdate)) FROM orders)""",
}
