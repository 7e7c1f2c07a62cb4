"""The driver's star-schema tables as the e-commerce source tables.

Only for tests, checks and benchmarks: a fixed, row-wise mapping that also plants the faults
the library looks for (nulls, unreadable dates, repeated rows, scores and coordinates out of
range). Each table is one scan; only the nation names are joined in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.config import LOADED_AT, ROW_HASH, SOURCE_FILE, TABLES, VERSION
from tidemark.functions.clean import row_hash
from tidemark.jobs import run_jobs
from tidemark.sources.files import write_csv
from tidemark.sources.schemas import source_columns

LOAD_INSTANT = "2024-01-31 06:00:00"
# Hours between the load instant and the newest batch of each table.
LOAD_LAG_HOURS = {
    "orders": 0, "order_items": 7, "order_payments": 31, "customers": 55,
    "products": 79, "sellers": 0, "order_reviews": 26, "geolocation": 0,
}

# Declared so that opening a table starts no job.
STAR_DDL = {
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "orders": """o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE,
        o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING""",
    "lineitem": """l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE,
        l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING,
        l_shipdate TIMESTAMP_NTZ""",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
}
_TIMES = {"orders": "o_orderdate", "lineitem": "l_shipdate", "events": "ts"}

STAMP, DAY = "'yyyy-MM-dd HH:mm:ss'", "'yyyy-MM-dd'"


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """A star table; its zone-less time is read as a session-zone timestamp."""
    df = spark.read.schema(STAR_DDL[table]).parquet(f"{folder}/{table}.parquet")
    time = _TIMES.get(table)
    return df.withColumn(time, F.col(time).cast("timestamp")) if time else df


def _later(start: str, days: str = "0", hours: str = "0") -> str:
    return f"{start} + make_dt_interval(cast({days} AS INT), cast({hours} AS INT))"


def _zip(nation: str, key: str) -> str:
    return f"concat(' ', cast({nation} * 40 + {key} % 40 AS STRING))"


_BOUGHT = _later("o_orderdate", hours="o_orderkey % 24")

# Source columns as SQL expressions over the star table.
COLUMNS: dict[str, tuple[str, dict[str, str]]] = {
    "orders": (
        "orders",
        {
            "order_id": "cast(o_orderkey AS STRING)",
            "customer_id": "CASE WHEN o_orderkey % 211 <> 0 THEN cast(o_custkey AS STRING) END",
            "order_status": """CASE o_orderstatus WHEN 'P' THEN 'canceled' WHEN 'F' THEN ' Delivered '
                ELSE 'SHIPPED' END""",
            "order_purchase_timestamp": f"CASE WHEN o_orderkey % 307 <> 0 THEN date_format({_BOUGHT}, {STAMP}) END",
            "order_approved_at": f"""CASE WHEN o_orderkey % 97 = 0 THEN 'bad'
                ELSE date_format({_later(_BOUGHT, hours="1")}, {STAMP}) END""",
            "order_delivered_carrier_date": f"date_format({_later('o_orderdate', '2')}, {DAY})",
            "order_delivered_customer_date": f"""CASE WHEN o_orderstatus <> 'P'
                THEN date_format({_later('o_orderdate', 'o_orderkey % 20', '10')}, {STAMP}) END""",
            "order_estimated_delivery_date": f"date_format({_later('o_orderdate', '12')}, {DAY})",
        },
    ),
    "order_items": (
        "lineitem",
        {
            "order_id": "cast(l_orderkey AS STRING)",
            "order_item_id": "l_linenumber",
            "product_id": "cast(l_partkey AS STRING)",
            "seller_id": "cast(l_suppkey AS STRING)",
            "shipping_limit_date": f"date_format(l_shipdate, {STAMP})",
            "price": "CASE WHEN l_orderkey % 101 <> 0 THEN l_extendedprice END",
            "freight_value": "CASE WHEN l_tax = 0 THEN 0D ELSE l_quantity END",
        },
    ),
    "order_payments": (
        "lineitem",
        {
            "order_id": "cast(l_orderkey AS STRING)",
            "payment_sequential": "l_linenumber",
            "payment_type": "CASE l_returnflag WHEN 'A' THEN ' Credit_Card' WHEN 'N' THEN 'BOLETO' ELSE 'voucher ' END",
            "payment_installments": "cast(l_partkey % 4 + 1 AS INT)",
            "payment_value": "CASE WHEN NOT (l_orderkey % 103 = 0 AND l_linenumber = 1) THEN l_extendedprice END",
        },
    ),
    "customers": (
        "customer",
        {
            "customer_id": "cast(c_custkey AS STRING)",
            "customer_unique_id": "CASE WHEN c_custkey % 113 <> 0 THEN c_name END",
            "customer_zip_code_prefix": _zip("c_nationkey", "c_custkey"),
            "customer_city": "concat('  ', c_mktsegment)",
            "customer_state": "concat(lower(n_name), ' ')",
        },
    ),
    "products": (
        "part",
        {
            "product_id": "cast(p_partkey AS STRING)",
            "product_category_name": "CASE WHEN p_partkey % 10 <> 0 THEN concat(' ', upper(p_type)) END",
            "product_name_lenght": "length(p_name)",
            "product_description_lenght": "p_size * 10",
            "product_photos_qty": "p_size % 5",
            "product_weight_g": "cast(p_size * 100 AS DOUBLE)",
            "product_length_cm": "cast(p_size AS DOUBLE)",
            "product_height_cm": "p_size / 2D",
            "product_width_cm": "p_size / 4D",
        },
    ),
    "sellers": (
        "supplier",
        {
            "seller_id": "cast(s_suppkey AS STRING)",
            "seller_zip_code_prefix": _zip("s_nationkey", "s_suppkey"),
            "seller_city": "concat(' City ', cast(s_suppkey % 37 AS STRING))",
            "seller_state": "concat(lower(n_name), ' ')",
        },
    ),
    "order_reviews": (
        "orders",
        {
            "review_id": "concat('r', cast(o_orderkey AS STRING), '-', cast(copy AS STRING))",
            "order_id": "cast(o_orderkey AS STRING)",
            "review_score": """cast(CASE WHEN copy = 2 THEN o_orderkey % 5 + 1
                WHEN o_orderkey % 13 <> 0 THEN o_orderkey % 7 END AS INT)""",
            "review_comment_title": "CASE WHEN o_orderkey % 3 <> 0 THEN concat(' Title ', cast(o_custkey AS STRING), ' ') END",
            "review_comment_message": """CASE o_orderpriority WHEN '1-URGENT' THEN NULL WHEN '2-HIGH' THEN '   '
                ELSE concat('  ', o_orderpriority, ' ok ') END""",
            "review_creation_date": f"date_format({_later('o_orderdate', '1')}, {DAY})",
            "review_answer_timestamp": f"""CASE WHEN o_orderkey % 89 = 0 THEN 'bad'
                ELSE date_format({_later('o_orderdate', 'o_orderkey % 4 + 1', '9')}, {STAMP}) END""",
        },
    ),
    "geolocation": (
        "customer",
        {
            "geolocation_zip_code_prefix": _zip("c_nationkey", "c_custkey"),
            "geolocation_lat": "(c_custkey % 8) / 8D - (c_custkey % 45)",
            "geolocation_lng": "-34D - (c_custkey % 45) + (c_custkey % 8) / 8D",
            "geolocation_city": "concat(c_mktsegment, ' ')",
            "geolocation_state": "' sp '",
        },
    ),
}

# One order in 500 arrives twice; one in 11 has a second review.
_COPIES = {
    "orders": "explode(CASE WHEN o_orderkey % 500 = 7 THEN array(1, 2) ELSE array(1) END) AS copy",
    "order_reviews": "explode(CASE WHEN o_orderkey % 11 = 0 THEN array(1, 2) ELSE array(1) END) AS copy",
}
_NATION_KEY = {"customers": "c_nationkey", "sellers": "s_nationkey"}


def source(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """One source table, as a file of it would be read."""
    star, columns = COLUMNS[table]
    df = read(spark, folder, star)
    if table in _COPIES:
        df = df.selectExpr("*", _COPIES[table])
    if table in _NATION_KEY:
        nation = read(spark, folder, "nation")
        df = df.join(nation, df[_NATION_KEY[table]] == nation["n_nationkey"], "left")
    return df.selectExpr(*[f"{expression} AS {name}" for name, expression in columns.items()])


def export(spark: SparkSession, folder: str, target: str) -> None:
    """All source tables as CSV files, written side by side."""
    writes = {
        table: lambda table=table, spec=spec: write_csv(source(spark, folder, table), f"{target}/{spec.source_file()}")
        for table, spec in TABLES.items()
    }
    for write in run_jobs(spark, writes):
        if write.failure is not None:
            raise write.failure


def bronze(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """One bronze table: the source table with load metadata from three daily batches."""
    first = source_columns(table)[0]
    newest = f"timestamp '{LOAD_INSTANT}' - interval '{LOAD_LAG_HOURS[table]}' hour"
    return source(spark, folder, table).withColumns(
        {
            ROW_HASH: row_hash(source_columns(table)),
            LOADED_AT: F.expr(f"{newest} - make_dt_interval(length({first}) % 3)"),
            SOURCE_FILE: F.lit(TABLES[table].source_file()),
            VERSION: F.lit("1.0.0"),
        }
    )


def all_bronze(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {table: bronze(spark, folder, table) for table in TABLES}
