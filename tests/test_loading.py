from __future__ import annotations

import json
import threading
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, StructField, StructType

from tidemark.config import METADATA_COLUMNS, TABLES, RunContext
from tidemark.operators import drift
from tidemark.plans import audit, bronze, pipeline
from tidemark.sources import star
from tidemark.sources.files import TableStore, preview, read_csv, table_shape, write_csv
from tidemark.sources.schemas import SOURCE_DDL, source_columns, source_schema
from tidemark.streaming.incremental import load_new_files

ORDERS = TABLES["orders"]
SAMPLE = [
    ("A-17", "buyer-3", "delivered", "2022-03-01 08:15:00", "2022-03-01 08:40:00", "2022-03-02", "2022-03-05", "2022-03-06"),
    ("A-18", "buyer-9", "shipped", "2022-03-02 07:30:00", "2022-03-02 08:15:00", "2022-03-03", None, "2022-03-07"),
]


def ctx(at="2024-01-01 06:00:00"):
    return RunContext("r", at)


@pytest.fixture
def sample(spark):
    return spark.createDataFrame(SAMPLE, SOURCE_DDL["orders"].replace("NOT NULL", ""))


@pytest.fixture
def store(spark, tmp_path):
    return TableStore(spark, str(tmp_path / "store"))


def text_file(tmp_path, name, *lines):
    path = tmp_path / name
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(path)


# ---- drift --------------------------------------------------------------------------------


def test_matching_schema_has_no_drift(sample):
    assert not drift.compare("orders", sample.schema, source_schema("orders")).has_drift


def test_missing_and_extra_columns(sample):
    found = drift.compare("orders", sample.drop("order_status").withColumn("channel", F.lit("x")).schema,
                          source_schema("orders"), ("order_id",))
    assert found.has_drift and found.missing_columns == ("order_status",) and found.extra_columns == ("channel",)
    assert found.critical_missing == ()


def test_critical_columns(sample):
    found = drift.compare("orders", sample.select("order_status").schema, source_schema("orders"), ("order_id", "customer_id"))
    assert found.critical_missing == ("order_id", "customer_id")


def test_type_mismatch_text_and_parameters(sample):
    items = sample.selectExpr("order_id", "'1' AS price")
    found = drift.compare("order_items", items.schema, source_schema("order_items"))
    assert found.type_mismatches == ("price: expected DoubleType, got StringType",)
    one, two = (StructType([StructField("d", DecimalType(10 + i, 2 + i))]) for i in (0, 1))
    assert drift.compare("t", two, one).type_mismatches == ("d: expected decimal(10,2), got decimal(11,3)",)


def test_report_is_json(spark):
    found = drift.Drift("orders", ("carrier",), ("channel",), ("weight: expected DoubleType, got StringType",), ("parcel_id",))
    text = spark.range(1).select(found.json()).first()[0]
    assert json.loads(text) == {
        "has_drift": True, "missing_columns": ["carrier"], "extra_columns": ["channel"],
        "type_mismatches": ["weight: expected DoubleType, got StringType"], "critical_missing": ["parcel_id"]}
    assert "missing carrier" in found.summary() and "as declared" in drift.Drift("t").summary()


def test_drift_report_counts_rows(sample):
    row = drift.drift_report(sample.drop("order_status"), source_schema("orders"), "orders").first()
    assert row["row_count"] == 2 and row["missing_columns"] == ["order_status"]


# ---- metadata and CSV ---------------------------------------------------------------------


def test_metadata_columns(sample):
    rows = bronze.with_load_metadata(sample, "orders.csv", "2024-01-01 06:00:00").collect()
    assert set(METADATA_COLUMNS) <= set(rows[0].asDict())
    assert len({r["_row_hash"] for r in rows}) == 2 and {r["_source_file"] for r in rows} == {"orders.csv"}


def test_hash_ignores_the_load(sample):
    first = bronze.with_load_metadata(sample, "a.csv", "2024-01-01")
    again = bronze.with_load_metadata(first, "b.csv", "2024-01-02")
    assert [r[0] for r in first.select("_row_hash").collect()] == [r[0] for r in again.select("_row_hash").collect()]


def test_csv_dialect(spark, tmp_path):
    path = text_file(tmp_path, "r.csv", ",".join(source_columns("order_reviews")),
                     'r1,o1,5,,"said ""good""\nand left",2022-03-01,', "r2,o2,x,t,,,")
    rows = read_csv(spark, path, source_schema("order_reviews")).orderBy("review_id").collect()
    assert rows[0]["review_comment_message"] == 'said "good"\nand left' and rows[0]["review_comment_title"] is None
    assert rows[1]["review_score"] is None and len(rows) == 2


def test_inferred_schema(spark, tmp_path):
    path = text_file(tmp_path, "x.csv", "a,b", "1,x", "2,y")
    assert read_csv(spark, path, infer=True).dtypes == [("a", "int"), ("b", "string")]


def test_missing_file(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_csv(spark, str(tmp_path / "nothing.csv"))


def test_renamed_and_damaged_columns_are_mapped_by_name(spark, tmp_path):
    path = text_file(tmp_path, "i.csv", "price,order_id,order_item_id,product_id,seller_id,shipping_limit_date,freight",
                     "n/a,o1,1,p,s,,3.5", "12.5,o2,one,p,s,,4", ",o3,3,p,s,,")
    text, found = bronze.read_source(spark, TABLES["order_items"], path)
    assert found.missing_columns == ("freight_value",) and found.extra_columns == ("freight",)
    rows = {r["order_id"]: r for r in drift.conform(text, source_schema("order_items")).collect()}
    assert rows["o1"]["price"] is None and rows["o2"]["price"] == 12.5 and rows["o2"]["order_item_id"] is None
    assert rows["o1"]["freight"] == "3.5" and rows["o1"]["freight_value"] is None
    damage = {r["column_name"]: r["bad_values"] for r in drift.damage_report(text, source_schema("order_items"), "t").collect()}
    assert damage == {"order_item_id": 1, "price": 1}


# ---- loads --------------------------------------------------------------------------------


def orders_csv(tmp_path, name, *lines, header=None):
    return text_file(tmp_path, name, header or ",".join(source_columns("orders")), *lines)


def line(key, status="delivered"):
    return f"{key},c,{status},2022-03-01 08:15:00,,,,"


def test_load_statuses_and_audit(store, tmp_path):
    small = ORDERS.__class__("orders", 2, ORDERS.critical)
    good = orders_csv(tmp_path, "good.csv", line("a"), line("b"))
    assert bronze.load_table(store, small, good, ctx("2024-01-01")) == "SUCCESS"
    assert bronze.load_table(store, ORDERS, good, ctx("2024-01-02")) == "PARTIAL"
    assert bronze.load_table(store, ORDERS, str(tmp_path / "none.csv"), ctx("2024-01-03")) == "FAILED"
    bad = orders_csv(tmp_path, "bad.csv", "x,y", header="order_key,customer_id")
    assert bronze.load_table(store, ORDERS, bad, ctx("2024-01-04")) == "FAILED"
    log = audit.log_view(bronze.read_audit(store)).collect()
    assert [r["load_status"] for r in log] == ["SUCCESS", "PARTIAL", "FAILED", "FAILED"]
    assert [r["rows_loaded"] for r in log] == [2, 2, None, None]
    assert "not found" in log[2]["error_message"] and "order_id" in log[3]["error_message"]
    assert audit.last_status(bronze.read_audit(store), "bronze_orders").first()["load_status"] == "FAILED"
    assert audit.last_status(bronze.read_audit(store), "bronze_none").count() == 0
    # a failed load leaves the readable version alone
    assert bronze.read_bronze(store, "orders").count() == 2


def test_drift_and_damage_reach_the_audit_log(store, tmp_path):
    spec = TABLES["order_payments"]
    path = text_file(tmp_path, "p.csv", "order_id,payment_type,payment_value,payment_sequential,promo", "o,card,ten,1,x")
    bronze.load_table(store, spec, path, ctx())
    report = json.loads(bronze.read_audit(store).first()["schema_drift_detected"])
    assert report["missing_columns"] == ["payment_installments"] and report["extra_columns"] == ["promo"]
    assert report["type_mismatches"] == ["payment_value: 1 unreadable values"]


def test_versions_append_and_restore(store, tmp_path):
    def load(n, mode, *keys):
        path = orders_csv(tmp_path, f"{n}.csv", *[line(k) for k in keys])
        return bronze.load_table(store, ORDERS, path, ctx(f"2024-01-0{n}"), mode, f"load{n}")

    keys = lambda version=None: sorted(r["order_id"] for r in bronze.read_bronze(store, "orders", version).collect())
    load(1, "overwrite", "a", "b")
    load(2, "append", "c")
    load(3, "overwrite", "z")
    assert (keys(0), keys(1), keys(2), keys()) == (["a", "b"], ["a", "b", "c"], ["z"], ["z"])
    bronze.restore(store, "orders", 1, ctx("2024-01-04"))
    assert keys() == ["a", "b", "c"]
    load(5, "append", "d")
    assert keys() == ["a", "b", "c", "d"]
    history = audit.history(bronze.read_audit(store)).orderBy("version").collect()
    assert [r["rows_loaded"] for r in history] == [2, 1, 1, 3, 1] and [r["version"] for r in history] == [0, 1, 2, 3, 4]


def test_append_counts_the_batch_not_the_table(store, tmp_path):
    spec = ORDERS.__class__("orders", 2, ORDERS.critical)
    first = orders_csv(tmp_path, "1.csv", *[line(str(i)) for i in range(5)])
    second = orders_csv(tmp_path, "2.csv", line("x"))
    assert bronze.load_table(store, spec, first, ctx("2024-01-01")) == "SUCCESS"
    assert bronze.load_table(store, spec, second, ctx("2024-01-02"), "append") == "PARTIAL"


def test_undeclared_table_is_inferred(store, tmp_path):
    spec = ORDERS.__class__("coupons", 1, ("code",))
    path = text_file(tmp_path, "c.csv", "code,worth", "a,5", "b,7")
    assert bronze.load_table(store, spec, path, ctx()) == "SUCCESS"
    log = bronze.read_audit(store).first()
    loaded = store.read_loads("bronze_coupons", [log["load_id"]])
    assert dict(loaded.dtypes)["worth"] == "int" and loaded.count() == 2 and log["schema_drift_detected"] is None
    bad = ORDERS.__class__("coupons", 1, ("missing",))
    assert bronze.load_table(store, bad, path, ctx("2024-01-02")) == "FAILED"


def test_failed_audit_write_does_not_fail_the_load(store, tmp_path, monkeypatch):
    monkeypatch.setattr(TableStore, "append", lambda *a: 1 / 0)
    path = orders_csv(tmp_path, "1.csv", line("a"))
    assert bronze.load_table(store, ORDERS, path, ctx()) == "PARTIAL"


def test_new_files_load_once(store, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    orders_csv(folder, "1.csv", line("a"), line("b"))
    run = lambda: load_new_files(store, ORDERS, str(folder), ctx(), str(tmp_path / "seen"))
    keys = lambda: sorted(r["order_id"] for r in bronze.read_bronze(store, "orders").collect())
    assert run() == 1 and keys() == ["a", "b"]
    assert run() == 0
    orders_csv(folder, "2.csv", line("c"))
    assert run() == 1 and keys() == ["a", "b", "c"]
    assert bronze.read_audit(store).count() == 2


def test_views_preview_and_shape(store, spark, sample):
    store.overwrite(sample, "silver", "some_orders")
    store.register("silver", ["some_orders"])
    assert spark.sql("SELECT count(*) FROM some_orders").first()[0] == 2
    assert [r["order_id"] for r in preview(sample, 1, ["order_id"]).collect()] == ["A-17"]
    row = table_shape(bronze.with_load_metadata(sample, "f", "2024-01-01"), "orders").first()
    assert (row["row_count"], row["column_count"], len(row["metadata_columns"].split(","))) == (2, 12, 4)


def test_all_layers(spark, tmp_path, store):
    """Files to KPI tables, one write per table, then a clean second look at the results."""
    files = tmp_path / "raw"
    for table, spec in TABLES.items():
        write_csv(star.source(spark, "/root/testdata/sf0.001", table), f"{files}/{spec.source_file()}")
    statuses = bronze.load_all(store, str(files), ctx())
    assert len(statuses) == 8 and set(statuses.values()) <= {"SUCCESS", "PARTIAL"}
    outcome = pipeline.run_quality(store, ctx("2024-01-01 12:00:00"))
    assert outcome.count() == 21
    assert store.read("quality", "dq_summary").first()["total_checks"] == 21
    assert store.read("quality", "dq_violations").where("sample_records != '[]'").count() > 0
    strict = pipeline.run_strict_quality(store, ctx("2024-01-01 12:00:00"))
    assert strict.where("status = 'ERROR'").count() == 0 and strict.count() == 26
    silver_report = {r["table_name"]: r for r in pipeline.run_silver(store, quarantine=True).collect()}
    assert all(r["status"] == "SUCCESS" and r["rows_in"] == r["rows_kept"] + r["rows_rejected"] for r in silver_report.values())
    assert store.read("quarantine", "silver_order_reviews").count() == silver_report["silver_order_reviews"]["rows_rejected"]
    gold_report = {r["table_name"]: r for r in pipeline.run_gold(store).collect()}
    assert len(gold_report) == 5 and all(r["status"] == "SUCCESS" for r in gold_report.values())
    for name, report in gold_report.items():
        assert store.read("gold", name).count() == report["rows_out"] > 0


def test_a_failing_layer_table_does_not_stop_the_others(store):
    report = {r["table_name"]: r["status"] for r in pipeline.run_gold(store).collect()}
    assert set(report.values()) == {"FAILED"} and len(report) == 5


def test_equal_reported_times_are_ordered_by_commit(store, sample, tmp_path):
    for name, load in (("one", "zz"), ("two", "aa")):
        path = str(tmp_path / name)
        write_csv(sample.withColumn("order_status", F.lit(name)), path)
        assert bronze.load_table(store, ORDERS, path, ctx(), load_id=load) != "FAILED"
    assert {r["order_status"] for r in bronze.read_bronze(store, "orders").collect()} == {"two"}


def test_files_of_one_folder_with_other_headers_fail(store, tmp_path):
    folder = tmp_path / "mixed"
    folder.mkdir()
    names = source_columns("orders")
    swapped = [names[1], names[0], *names[2:]]
    for file, header in (("a.csv", names), ("b.csv", swapped)):
        text_file(folder, file, ",".join(header), ",".join(f"{name}-1" for name in header))
    assert bronze.load_table(store, ORDERS, str(folder), ctx()) == "FAILED"
    assert "/mixed/" in bronze.read_audit(store).first()["error_message"]  # names the file


def test_only_a_missing_path_is_a_missing_table(store, spark):
    assert not store.exists("quality", "dq_summary")
    rows = spark.createDataFrame([("a", 1), ("b", 2)], "k string, n int")
    store.append_new(rows, "quality", "things", "k")
    store.append_new(rows.unionByName(spark.createDataFrame([("c", 3)], "k string, n int")), "quality", "things", "k")
    assert sorted(r["k"] for r in store.read("quality", "things").collect()) == ["a", "b", "c"]


def test_stored_files_are_packed(spark, store, tmp_path):
    rows = spark.range(40_000).select(F.md5(F.col("id").cast("string")).alias("h"), F.concat(F.lit(" a,\"b\" "), F.col("id")).alias("t"))
    size = lambda path: sum(p.stat().st_size for p in Path(path).rglob("part-*"))
    hashes = rows.select("h").coalesce(1)
    store.write_load(hashes, "bronze_h", "l1")
    store.overwrite(hashes, "silver", "h")
    # 32 hexadecimal digits are 16 bytes
    assert size(store.path("bronze", "bronze_h")) < 24 * 40_000 and size(store.path("silver", "h")) < 24 * 40_000
    path = str(tmp_path / "packed.csv")
    write_csv(rows, path)
    assert size(path) < 36 * 40_000  # 50 bytes a row and more as plain text
    back = read_csv(spark, path, multiline=False)
    assert back.columns == rows.columns and back.exceptAll(rows).isEmpty() and back.count() == 40_000


def test_tables_load_side_by_side(spark, store, monkeypatch):
    met = threading.Barrier(2)

    def load(store, spec, path, ctx, write_mode):
        met.wait(20)  # breaks when tables wait for each other
        return "PARTIAL" if spec.name == "orders" else "SUCCESS"

    monkeypatch.setattr(bronze, "load_table", load)
    statuses = bronze.load_all(store, "/nowhere", ctx())
    assert list(statuses) == [spec.bronze for spec in TABLES.values()] and statuses["bronze_orders"] == "PARTIAL"
