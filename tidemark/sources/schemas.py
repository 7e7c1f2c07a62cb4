"""Declared schemas of the source tables and of the platform tables."""

from __future__ import annotations

from pyspark.sql.types import StructType

# ---- Fixed values: source columns and types, in file order ------------------------------
# (the spelling "lenght" is the spelling in the source files)
SOURCE_DDL: dict[str, str] = {
    "orders": """
        order_id STRING NOT NULL, customer_id STRING NOT NULL, order_status STRING,
        order_purchase_timestamp STRING, order_approved_at STRING,
        order_delivered_carrier_date STRING, order_delivered_customer_date STRING,
        order_estimated_delivery_date STRING""",
    "order_items": """
        order_id STRING NOT NULL, order_item_id INT, product_id STRING NOT NULL,
        seller_id STRING NOT NULL, shipping_limit_date STRING, price DOUBLE,
        freight_value DOUBLE""",
    "order_payments": """
        order_id STRING NOT NULL, payment_sequential INT, payment_type STRING,
        payment_installments INT, payment_value DOUBLE""",
    "customers": """
        customer_id STRING NOT NULL, customer_unique_id STRING NOT NULL,
        customer_zip_code_prefix STRING, customer_city STRING, customer_state STRING""",
    "products": """
        product_id STRING NOT NULL, product_category_name STRING, product_name_lenght INT,
        product_description_lenght INT, product_photos_qty INT, product_weight_g DOUBLE,
        product_length_cm DOUBLE, product_height_cm DOUBLE, product_width_cm DOUBLE""",
    "sellers": """
        seller_id STRING NOT NULL, seller_zip_code_prefix STRING, seller_city STRING,
        seller_state STRING""",
    "order_reviews": """
        review_id STRING NOT NULL, order_id STRING NOT NULL, review_score INT,
        review_comment_title STRING, review_comment_message STRING,
        review_creation_date STRING, review_answer_timestamp STRING""",
    "geolocation": """
        geolocation_zip_code_prefix STRING NOT NULL, geolocation_lat DOUBLE,
        geolocation_lng DOUBLE, geolocation_city STRING, geolocation_state STRING""",
}


def source_schema(table: str) -> StructType:
    return StructType.fromDDL(SOURCE_DDL[table])


def source_columns(table: str) -> list[str]:
    """Column names in file order; needs no session."""
    return [column.split()[0] for column in SOURCE_DDL[table].split(",")]


# One row per load attempt. The last three columns make the log the list of readable versions, in the
# order in which loads were committed; ingestion_timestamp is the time that the run reports.
AUDIT_DDL = """
    audit_id STRING NOT NULL, pipeline_name STRING, pipeline_version STRING,
    table_name STRING NOT NULL, source_file STRING, load_status STRING NOT NULL,
    rows_loaded BIGINT, rows_expected_min BIGINT, schema_drift_detected STRING,
    error_message STRING, ingestion_timestamp TIMESTAMP NOT NULL, environment STRING,
    load_id STRING, write_mode STRING, committed_at TIMESTAMP"""

# One row per violation, for both check families.
VIOLATION_DDL = """
    violation_id STRING, run_id STRING, check_name STRING, table_name STRING,
    column_name STRING, severity STRING, violation_count BIGINT, violation_detail STRING,
    sample_records STRING, check_timestamp TIMESTAMP, environment STRING, family STRING"""

SUMMARY_DDL = """
    run_id STRING, pipeline_name STRING, total_checks BIGINT, passed BIGINT, failed BIGINT,
    warnings BIGINT, overall_status STRING, run_timestamp TIMESTAMP, environment STRING,
    family STRING"""

#: Platform tables with a declared layout; they are opened without looking at their files.
PLATFORM_DDL = {"bronze_ingestion_audit": AUDIT_DDL, "dq_violations": VIOLATION_DDL, "dq_summary": SUMMARY_DDL}
