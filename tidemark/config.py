"""Table registry and thresholds. Everything that a deployment tunes lives here."""

from __future__ import annotations

from dataclasses import dataclass

# ---- Fixed values: load metadata column names -------------------------------------------
LOADED_AT = "_ingestion_timestamp"
SOURCE_FILE = "_source_file"
VERSION = "_pipeline_version"
ROW_HASH = "_row_hash"
METADATA_COLUMNS = (LOADED_AT, SOURCE_FILE, VERSION, ROW_HASH)

# ---- Fixed values: order states that count as revenue -----------------------------------
REVENUE_STATUSES = ("delivered", "shipped", "invoiced")


@dataclass(frozen=True)
class TableSpec:
    """What is known about one source table before any row is read."""

    name: str
    min_rows: int
    critical: tuple[str, ...]
    business_key: tuple[str, ...] = ()
    value_columns: tuple[str, ...] = ()
    # Quoted line breaks make a CSV file unsplittable, so only free-text tables pay for them.
    multiline: bool = False

    @property
    def bronze(self) -> str:
        return f"bronze_{self.name}"

    @property
    def silver(self) -> str:
        return f"silver_{self.name}"

    def source_file(self, prefix: str = "olist") -> str:
        """File name in the public e-commerce data set."""
        return f"{prefix}_{self.name}_dataset.csv"


# ---- Fixed values: minimum rows, critical columns, business keys, value columns ---------
TABLES: dict[str, TableSpec] = {
    spec.name: spec
    for spec in (
        TableSpec(
            "orders",
            90_000,
            ("order_id", "customer_id", "order_status", "order_purchase_timestamp"),
            business_key=("order_id",),
        ),
        TableSpec(
            "order_items",
            110_000,
            ("order_id", "product_id", "seller_id", "price"),
            value_columns=("price", "freight_value"),
        ),
        TableSpec(
            "order_payments",
            100_000,
            ("order_id", "payment_type", "payment_value"),
            business_key=("order_id", "payment_sequential"),
            value_columns=("payment_value",),
        ),
        TableSpec(
            "customers",
            90_000,
            ("customer_id", "customer_unique_id"),
            business_key=("customer_id",),
        ),
        TableSpec("products", 30_000, ("product_id",), business_key=("product_id",)),
        TableSpec("sellers", 3_000, ("seller_id",), business_key=("seller_id",)),
        TableSpec(
            "order_reviews",
            90_000,
            ("review_id", "order_id"),
            business_key=("review_id",),
            multiline=True,
        ),
        TableSpec("geolocation", 1_000_000, ("geolocation_zip_code_prefix",)),
    )
}

# Tables that a default quality run covers.
CORE_TABLES = ("orders", "order_items", "order_payments", "customers", "products")


@dataclass(frozen=True)
class QualityPolicy:
    """Thresholds of the wired check family ("standard")."""

    stale_after_hours: int = 24
    null_critical_pct: float = 1.0
    volume_critical_pct: float = 20.0
    duplicate_critical_rows: int = 100
    revenue_z: float = 3.0
    revenue_critical_z: float = 5.0
    min_history_days: int = 7


@dataclass(frozen=True)
class StrictPolicy:
    """Thresholds of the second check family ("strict")."""

    stale_after_hours: int = 25
    stale_critical_hours: int = 48
    stale_severe_hours: int = 72
    null_critical_pct: float = 10.0
    null_warning_pct: float = 1.0
    value_z: float = 3.0
    iqr_multiplier: float = 3.0
    min_values: int = 30


@dataclass(frozen=True)
class RunContext:
    """Identity of one run. Times are arguments so that a run can be repeated exactly."""

    run_id: str
    as_of: str
    environment: str = "development"
    pipeline_name: str = "tidemark"
    pipeline_version: str = "1.0.0"
