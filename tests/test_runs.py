"""Whole runs: money without a cut, records of runs, side-by-side jobs, splits, rebuilds, streams."""

from __future__ import annotations

import time
from dataclasses import replace
from decimal import Decimal
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from tidemark.config import LOADED_AT, ROW_HASH, TABLES, RunContext, TableSpec
from tidemark.functions import exact
from tidemark.operators import distinct_bitmaps
from tidemark.plans import gold, pipeline, quality, rebuild, registry, silver
from tidemark.jobs import run_jobs
from tidemark.sources import star
from tidemark.sources.files import TableStore
from tidemark.streaming import checks

FOLDER = "/root/testdata/sf0.001"
CTX = RunContext(run_id="r1", as_of="2024-01-31 20:00:00")


@pytest.fixture
def store(spark, tmp_path):
    return TableStore(spark, str(tmp_path / "store"))


# ---- money

AMOUNTS = [0.00004, 0.1, 0.2, 0.1234567891, 1e-11, 21168.23, 999999999.99, 1e9 + 0.25, 9.99e15, 1.2345678901234568e16, -5e16, 1.5e22, -0.005, 123456.78901]


def test_money_keeps_the_digits(spark):
    df = spark.createDataFrame([(a,) for a in [*AMOUNTS, float("nan"), 1e24, float("-inf"), None]], "a double")
    row = df.agg(F.sum(exact.money("a")).alias("units"), exact.left_out("a").alias("left"), F.count(exact.money("a")).alias("n")).first()
    places = Decimal(1).scaleb(-exact.PLACES)
    assert row["units"] == sum(int(Decimal(repr(a)).quantize(places, "ROUND_HALF_UP") * exact.UNITS) for a in AMOUNTS if abs(a) < 1e16) + sum(
        int(Decimal(repr(a))) * exact.UNITS for a in AMOUNTS if abs(a) >= 1e16
    )
    assert (row["left"], row["n"]) == (3, len(AMOUNTS))


def test_small_amounts_add_up_and_large_totals_do_not_wrap(spark):
    many = spark.range(1_000_000).select(F.lit(0.00004).alias("a"))
    assert many.agg(exact.amount(F.sum(exact.money("a"))).alias("t")).first()["t"] == Decimal("40.00")
    large = spark.createDataFrame([(9e22,), (9e22,), (0.07,)], "a double")
    row = large.agg(exact.amount(F.sum(exact.money("a"))).alias("t"), exact.mean_amount(F.sum(exact.money("a")), F.count("a")).alias("m")).first()
    assert row["t"] == Decimal(int(Decimal(repr(9e22)))) * 2 + Decimal("0.07") and row["m"] == pytest.approx(6e22)


@pytest.mark.parametrize("n,d", [(1, 3), (-1, 8), (10**26, 7), (5, 0), (-(10**28) - 5, 10**10)])
def test_half_up_ratio(spark, n, d):
    row = spark.range(1).select(exact.half_up_ratio(F.lit(Decimal(n)), F.lit(Decimal(d)), 2).alias("x")).first()
    if not d:
        assert row["x"] is None
        return
    exactly = abs(Fraction(n, d)) * 100 + Fraction(1, 2)
    assert row["x"] == Decimal((1 if n >= 0 else -1) * (exactly.numerator // exactly.denominator)).scaleb(-2)


def test_large_totals_with_many_places(spark):
    rows = spark.range(600_000).select(F.when(F.col("id") % 2 == 0, F.lit(12345678901234568.0)).otherwise(F.lit(0.1234567)).alias("a"))
    total = rows.agg(exact.amount(F.sum(exact.money("a")), 7).alias("t")).first()["t"]
    assert Fraction(total) == 300_000 * (12345678901234568 + Fraction("0.1234567"))
    units = [10**33 + 7, -(10**36) - 1500, 10**38 - 10**20, 999_999_999_999, -499, -500]
    df = spark.createDataFrame([(Decimal(u),) for u in units], "u decimal(38,0)")
    for row in df.select("u", exact.amount(F.col("u"), 7).alias("x")).collect():
        u = int(row["u"])
        assert Fraction(row["x"]) == Fraction((1 if u > 0 else -1) * ((abs(u) + 500) // 1000), 10**7)


# ---- records of runs


def outcomes(spark, *statuses):
    finding = [(None, "INFO", 1, "x", None)]
    rows = [(f"c{i}", "t", s, 1, None, finding if s == "FAILED" else []) for i, s in enumerate(statuses)]
    return spark.createDataFrame(rows, quality.OUTCOME_DDL)


def test_families_and_repeated_runs(spark, store):
    pipeline.record_run(store, CTX, outcomes(spark, "FAILED", "FAILED"), None, pipeline.STANDARD)
    pipeline.record_run(store, CTX, outcomes(spark, "PASSED", "PASSED"), None, pipeline.STRICT)
    pipeline.record_run(store, replace(CTX, run_id="r2"), outcomes(spark, "FAILED"), None, pipeline.STANDARD)
    summary = lambda: {(r["run_id"], r["family"]): (r["passed"], r["failed"]) for r in store.read("quality", "dq_summary").collect()}
    found = lambda: sorted((r["run_id"], r["family"]) for r in store.read("quality", "dq_violations").collect())
    assert summary() == {("r1", "standard"): (0, 2), ("r1", "strict"): (2, 0), ("r2", "standard"): (0, 1)}
    assert found() == [("r1", "standard")] * 2 + [("r2", "standard")]
    pipeline.record_run(store, CTX, outcomes(spark, "PASSED", "PASSED"), None, pipeline.STANDARD)  # the data was mended
    assert summary()[("r1", "standard")] == (2, 0) and found() == [("r2", "standard")]


# ---- jobs side by side


def test_jobs_are_isolated_and_bounded(spark):
    slow = lambda: spark.range(0, 10**12, 1, 2).selectExpr("sum(cast(hash(id) AS bigint))").collect()
    def fails():
        raise ValueError("no such table")

    began = time.monotonic()
    jobs = {"slow": slow, "fails": fails, **{f"n{i}": lambda i=i: spark.range(i).count() for i in range(5)}}
    results = run_jobs(spark, jobs, workers=3, limit_s=6)
    assert [r.name for r in results] == list(jobs) and time.monotonic() - began < 60
    by = {r.name: r for r in results}
    assert by["slow"].error == "stopped after 6 seconds" and by["fails"].error == "no such table"
    assert [by[f"n{i}"].value for i in range(5)] == list(range(5)) and all(r.seconds >= 0 for r in results)


def test_a_failing_scan_is_an_error_outcome(spark):
    tables = {t: star.bronze(spark, FOLDER, t) for t in TABLES}
    tables["customers"] = tables["customers"].withColumn(ROW_HASH, F.expr("raise_error('broken file')").cast("string"))
    usual = {(r["check_name"], r["table_name"]): r["status"] for r in quality.outcomes({**tables, "customers": star.bronze(spark, FOLDER, "customers")}, CTX.as_of).collect()}
    found = {(r["check_name"], r["table_name"]): r for r in quality.isolated_outcomes(spark, tables, CTX.as_of).collect()}
    assert found.keys() == usual.keys() and len(found) == 21
    broken = found.pop(("duplicate_check", "bronze_customers"))
    assert broken["status"] == "ERROR" and "broken file" in broken["error_message"]
    assert {k: r["status"] for k, r in found.items()} == {k: v for k, v in usual.items() if k in found}


# ---- one write for kept and rejected rows


@pytest.mark.parametrize("table", list(TABLES))
def test_split_equals_the_two_plans(spark, store, table):
    source = star.bronze(spark, FOLDER, table)
    counts = pipeline.split_table(store, table, source)
    kept, rejected = store.read("silver", TABLES[table].silver), store.read("quarantine", TABLES[table].silver)
    rows = lambda df: sorted(map(str, df.select(sorted(df.columns)).collect()))
    assert rows(kept) == rows(silver.typed(table, source).where(silver.keep_condition(table)))
    assert rows(rejected.where("reject_reason IS NOT NULL")) == rows(silver.quarantine(table, source))
    assert counts[silver.KEPT] == kept.count() and sum(counts.values()) == source.count()


def test_split_without_kept_or_rejected_rows(spark, store):
    source = star.bronze(spark, FOLDER, "customers")
    pipeline.split_table(store, "customers", source.withColumn("customer_unique_id", F.lit("x")))
    assert store.read("quarantine", "silver_customers").count() == 0 and store.read("silver", "silver_customers").count() == source.count()
    pipeline.split_table(store, "customers", source.withColumn("customer_id", F.lit(None).cast("string")))
    assert store.read("silver", "silver_customers").count() == 0 and store.read("quarantine", "silver_customers").count() == source.count()


def test_split_scans_once(spark, store):
    plan = silver.with_outcome("order_reviews", star.bronze(spark, FOLDER, "order_reviews"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan


def test_a_failed_write_leaves_the_old_table(spark, store):
    store.overwrite(spark.range(5), "gold", "t")
    with pytest.raises(Exception, match="boom"):
        store.overwrite(spark.range(9).withColumn("x", F.expr("raise_error('boom')")), "gold", "t")
    assert store.read("gold", "t").count() == 5
    store.overwrite(store.read("gold", "t").where("id > 1"), "gold", "t")  # from the table itself
    assert store.read("gold", "t").count() == 3


# ---- partial rebuild


def test_rebuild_touches_only_the_months_of_a_load(spark, store, tmp_path):
    tables = silver.CleanTables(lambda table: star.bronze(spark, FOLDER, table))
    late = F.col("order_id").cast("bigint").isin(3, 7, 35, 96)
    rebuild.build(store, {"orders": tables["orders"], "order_items": tables["order_items"], "order_payments": tables["order_payments"].where(~late)})
    files = lambda: {str(p): p.stat().st_mtime_ns for p in (tmp_path / "store/gold").rglob("part-*.parquet")}
    before = files()
    rebuild.rebuild(store, tables, tables["order_payments"].where(late))
    after = files()
    months = rebuild.months_of(tables["orders"], tables["order_payments"].where(late)).count()
    assert 0 < len(after.keys() - before.keys()) <= months < len(before)
    rows = lambda df: sorted(map(str, df.collect()))
    assert rows(rebuild.daily_revenue(store)) == rows(gold.daily_revenue(tables).select(rebuild.daily_revenue(store).columns))


# ---- days, findings, distinct ids


def test_days_without_rows_are_seen(spark):
    days = [(f"2024-01-{d:02d}", 100) for d in range(1, 21) if d not in (12, 13)]
    df = spark.createDataFrame(days, "d string, row_count long").select(F.to_date("d").alias("day"), "row_count")
    rows = {r["day"].day: r for r in quality.rolling_volume_by_calendar(df).collect()}
    assert len(rows) == 20 and [d for d, r in rows.items() if r["volume_drop"]] == [12, 13] == [d for d, r in rows.items() if r["missing"]]
    assert rows[14]["rolling_mean"] == pytest.approx(500 / 7, abs=0.01)
    assert quality.rolling_volume_by_calendar(df.limit(0)).collect() == []


def test_findings_know_since_when(spark):
    seen = {"a": [1, 2, 3, 5, 6], "b": [2], "c": [6], "d": [1, 2, 3, 4, 5, 6]}
    history = spark.createDataFrame([(k, f"2024-01-0{r}", r * 10) for k, runs in seen.items() for r in runs], "check_name string, t string, violation_count long")
    history = history.withColumn("check_timestamp", F.col("t").cast("timestamp")).drop("t")
    runs = spark.createDataFrame([(f"2024-01-0{r}",) for r in range(1, 7)], "t string").select(F.col("t").cast("timestamp").alias("run_timestamp"))
    rows = {r["check_name"]: r for r in quality.finding_spans(history, runs, "check_name").collect()}
    got = {k: (r["since"].day, r["last_seen"].day, r["runs_in_a_row"], r["runs_seen"], r["reopenings"], r["is_open"], r["affected_rows"]) for k, r in rows.items()}
    assert got == {"a": (5, 6, 2, 5, 1, True, 60), "b": (2, 2, 1, 1, 0, False, 20), "c": (6, 6, 1, 1, 0, True, 60), "d": (1, 6, 6, 6, 0, True, 60)}


def test_bitmaps_merge_to_exact_counts(spark):
    df = spark.range(20_000).selectExpr(
        "CASE WHEN id % 50 = 0 THEN NULL ELSE (id * 7919) % 90001 - 30000 END AS k", "date_add(date'2024-01-01', cast(id % 60 AS int)) AS d"
    ).unionByName(spark.sql("SELECT 5L AS k, date'2024-01-03' AS d FROM range(3000)"))
    daily = distinct_bitmaps.daily_bitmaps(df, F.col("d"), "k")
    found = {r["period"]: r["distinct_ids"] for r in distinct_bitmaps.distinct_over(daily, F.trunc("day", "month")).collect()}
    assert found == {r[0]: r[1] for r in df.groupBy(F.trunc("d", "month")).agg(F.countDistinct("k")).collect()}


def test_bitmaps_of_far_ids_are_small_and_need_no_sort(spark):
    df = spark.range(4_000).selectExpr(
        "CASE WHEN id % 4 = 0 THEN 77 ELSE id * 1000003 - 2000000000 END AS k", "date_add(date'2024-01-01', cast(id % 50 AS int)) AS d",
        "CASE WHEN id % 3 > 0 THEN concat('f', id % 3) END AS f",
    )
    daily = distinct_bitmaps.daily_bitmaps(df, F.col("d"), "k", "f")
    over = distinct_bitmaps.distinct_over(daily, F.trunc("day", "month"), ["f"])
    # eight bytes a bitmap, and no more of them than there are ids; one of 32,768 numbers takes 4,096 bytes
    assert daily.schema["ids"].dataType.simpleString() == "bigint" and daily.count() <= df.distinct().count()
    assert "SortAggregate" not in over._jdf.queryExecution().executedPlan().toString()
    found = {(r["f"], r["period"]): r["distinct_ids"] for r in over.collect()}
    assert found == {(r[0], r[1]): r[2] for r in df.groupBy("f", F.trunc("d", "month")).agg(F.countDistinct("k")).collect()}


# ---- registered checks


def test_a_registered_check_shares_the_scan(spark, monkeypatch):
    monkeypatch.setattr(registry, "CHECKS", dict(registry.CHECKS))
    tables = {"order_items": star.bronze(spark, FOLDER, "order_items")}
    limits = spark.createDataFrame([("dear", None, 90_000.0), ("dear", "bronze_orders", 1.0)], registry.LIMITS_DDL)
    scans = lambda: registry.outcomes(tables, ["order_items"], limits)._jdf.queryExecution().optimizedPlan().toString().count("Relation [")
    before, names = scans(), set(registry.CHECKS)
    registry.register(
        registry.Check(
            "dear", lambda df, spec: {"price": F.max("price")} if "price" in df.columns else {},
            lambda values, limit: [(values["price"] > limit, quality.finding("price", "INFO", F.lit(1), F.format_string("%.0f above %.0f", values["price"], limit)))],
        )
    )
    assert scans() == before
    rows = {r["check_name"]: r for r in registry.outcomes(tables, ["order_items"], limits).collect()}
    assert set(rows) == names | {"dear"} and rows["dear"]["findings"][0]["violation_detail"].endswith("above 90000")
    with pytest.raises(ValueError, match="exists"):
        registry.register(registry.CHECKS["dear"])


# ---- checks in the stream


def test_repeats_are_seen_across_batches(spark, tmp_path):
    spec = TableSpec("things", 5, ("k",))
    schema = f"k string, {ROW_HASH} string, {LOADED_AT} timestamp"
    inbox, root = str(tmp_path / "inbox"), str(tmp_path / "checks")

    def arrive(day, keys):
        rows = spark.createDataFrame([(k, f"h{k}") for k in keys], "k string, h string")
        rows.select("k", F.col("h").alias(ROW_HASH), F.lit(f"2024-01-{day} 06:00:00").cast("timestamp").alias(LOADED_AT)).coalesce(1).write.mode("append").parquet(inbox)

    source = lambda: spark.readStream.schema(schema).option("maxFilesPerTrigger", "1").parquet(inbox)
    arrive(29, ["a", "b", "c"])
    arrive(30, ["b", "d", None])
    checks.check_stream(source, spec, root)
    got = lambda: {r["check_name"]: r for r in checks.outcomes(spark, spec, root, "2024-01-31 20:00:00").collect()}
    first = got()
    assert first["duplicate_check"]["findings"][0]["violation_count"] == 1 and first["duplicate_check"]["rows_scanned"] == 6
    assert first["null_check"]["findings"][0]["violation_count"] == 1 and first["volume_check"]["status"] == "PASSED"
    arrive(31, ["a", "a", "e"])
    checks.check_stream(source, spec, root)  # goes on from the checkpoint
    second = got()
    assert second["duplicate_check"]["findings"][0]["violation_count"] == 3 and second["duplicate_check"]["rows_scanned"] == 9
    assert first["staleness_check"]["status"] == "FAILED" and second["staleness_check"]["status"] == "PASSED"
