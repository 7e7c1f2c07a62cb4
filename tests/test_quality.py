from __future__ import annotations

import json
import random
import statistics
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tidemark.config import CORE_TABLES, LOADED_AT, ROW_HASH, TABLES, RunContext, TableSpec
from tidemark.operators import anomalies, duplicates, profile
from tidemark.plans import quality
from tidemark.plans.bronze import with_load_metadata
from tidemark.sources.schemas import SOURCE_DDL

NOW = "2024-01-31 20:00:00"
CTX = RunContext("r1", NOW)


def frame(spark, table, rows):
    return spark.createDataFrame(rows, SOURCE_DDL[table].replace("NOT NULL", ""))


def loaded(df, at="2024-01-31 10:00:00"):
    return with_load_metadata(df, "f.csv", at)


def orders(n, start=0):
    return [(f"o{i}", f"c{i}", "delivered", f"2021-01-{i % 28 + 1:02d} 10:00:00", None, None, None, None) for i in range(start, start + n)]


def findings(df):
    return {
        (r["check_name"], r["column_name"]): (r["status"], r["severity"], r["violation_count"])
        for r in df.select("check_name", "status", F.inline_outer("findings")).collect()
    }


@pytest.fixture
def small(monkeypatch):
    """Tables without a minimum number of rows, so that other checks stand alone."""
    for name, spec in list(TABLES.items()):
        monkeypatch.setitem(TABLES, name, replace(spec, min_rows=0))


# ---- duplicates ---------------------------------------------------------------------------


def test_injected_faults_give_exact_counts(spark, small):
    """142 orders delivered twice and 89 payments without a value."""
    rows = orders(1000)
    payments = [(f"o{i}", 1, "card", 1, None if i < 89 else 10.0 + i % 3) for i in range(1000)]
    tables = {
        "orders": loaded(frame(spark, "orders", rows + rows[:142])),
        "order_payments": loaded(frame(spark, "order_payments", payments)),
    }
    outcome = quality.outcomes(tables, NOW, core=("orders", "order_payments"))
    failed = {(r["check_name"], r["table_name"]) for r in outcome.where("status = 'FAILED'").collect()}
    assert failed == {("duplicate_check", "bronze_orders"), ("null_check", "bronze_order_payments")}
    found = {r["check_name"]: r for r in quality.violations(outcome, CTX).collect()}
    assert found["duplicate_check"]["violation_count"] == 142 and found["duplicate_check"]["severity"] == "CRITICAL"
    assert found["null_check"]["violation_count"] == 89 and found["null_check"]["severity"] == "CRITICAL"
    assert found["null_check"]["violation_detail"] == "payment_value is null in 89 of 1000 rows (8.90%)"
    row = quality.summary(outcome, CTX).first()
    assert (row["total_checks"], row["passed"], row["failed"], row["warnings"], row["overall_status"]) == (9, 7, 2, 0, "FAILED")


@pytest.mark.parametrize("extra,severity", [(100, "WARNING"), (101, "CRITICAL")])
def test_duplicate_severity_limit(spark, extra, severity):
    rows = orders(5)
    df = loaded(frame(spark, "orders", rows + [rows[0]] * extra))
    out = findings(quality.duplicate_outcomes({"orders": df}, ["orders"]))
    assert out == {("duplicate_check", None): ("FAILED", severity, extra)}
    assert findings(quality.strict_duplicate_outcomes({"orders": df}, ["orders"]))[("strict_duplicate_check", None)] == ("FAILED", "CRITICAL", extra)


def test_duplicates_add_up(spark):
    rng = random.Random(5)
    df = loaded(frame(spark, "orders", [rng.choice(orders(50)) for _ in range(400)]))
    row = duplicates.duplicate_summary(df).first()
    assert row["row_count"] == 400 and row["extra_rows"] == 400 - df.select(ROW_HASH).distinct().count()
    assert row["duplicate_groups"] == duplicates.repeated_rows(df).count()


def test_foreign_and_null_hashes(spark):
    df = spark.createDataFrame([("x",), ("x",), ("y",), (None,), (None,), ("zz",)], f"{ROW_HASH} string")
    assert tuple(duplicates.duplicate_summary(df).first()) == (6, 2, 2)


def test_key_conflicts_need_different_content(spark):
    a, b = orders(2)
    changed = (*b[:2], "shipped", *b[3:])
    df = loaded(frame(spark, "orders", [a, a, b, changed, changed]))
    assert [tuple(r) for r in duplicates.key_conflicts(df, ("order_id",)).collect()] == [("o1", 3)]
    out = findings(quality.strict_duplicate_outcomes({"orders": df}, ["orders"]))
    assert out[("strict_duplicate_check", "order_id")] == ("FAILED", "WARNING", 1)
    assert out[("strict_duplicate_check", None)] == ("FAILED", "CRITICAL", 2)


def test_duplicate_sample_is_limited_and_ordered(spark):
    rows = orders(9)
    df = loaded(frame(spark, "orders", rows * 3 + orders(5, start=100)))
    sample = duplicates.duplicate_sample(df, 5).collect()
    hashes = sorted(r[ROW_HASH] for r in df.where("order_id < 'o100' or length(order_id) = 2").select(ROW_HASH).distinct().collect())
    assert [r[ROW_HASH] for r in sample] == [hashes[0]] * 3 + [hashes[1]] * 2
    assert duplicates.duplicate_sample(loaded(frame(spark, "orders", rows))).count() == 0


def test_cross_batch(spark):
    df = frame(spark, "orders", orders(10))
    both = loaded(df, "2024-01-01").unionByName(loaded(df.limit(3), "2024-01-02")).unionByName(loaded(df.limit(1), "2024-01-02"))
    row = duplicates.cross_batch_duplicates(both).first()
    assert (row["repeated_rows"], row["extra_rows"]) == (3, 4)


# ---- nulls, staleness, volume -------------------------------------------------------------


@pytest.mark.parametrize("nulls,standard,strict", [(1, "WARNING", "INFO"), (10, "WARNING", "WARNING"), (11, "CRITICAL", "WARNING"),
                                                   (99, "CRITICAL", "WARNING"), (100, "CRITICAL", "CRITICAL")])
def test_null_severity_limits(spark, small, nulls, standard, strict):
    df = loaded(frame(spark, "sellers", [(None if i < nulls else f"s{i}", "1", "a", "SP") for i in range(1000)]))
    tables = {"sellers": df}
    assert findings(quality.profile_outcomes(tables, ["sellers"], NOW))[("null_check", "seller_id")] == ("FAILED", standard, nulls)
    assert findings(quality.strict_profile_outcomes(tables, ["sellers"], NOW))[("strict_null_check", "seller_id")] == ("FAILED", strict, nulls)


def test_empty_table(spark):
    tables = {"sellers": loaded(frame(spark, "sellers", []))}
    out = findings(quality.profile_outcomes(tables, ["sellers"], NOW))
    assert out[("null_check", None)] == ("PASSED", None, None)
    assert out[("staleness_check", None)] == ("FAILED", "CRITICAL", 1)
    assert out[("volume_check", None)] == ("FAILED", "CRITICAL", 3000)
    strict = findings(quality.strict_profile_outcomes(tables, ["sellers"], NOW))
    assert strict[("strict_null_check", None)] == ("FAILED", "CRITICAL", 0)
    assert strict[("strict_staleness_check", None)] == ("FAILED", "CRITICAL", 0)


def test_missing_columns(spark, small):
    """An absent critical column is skipped; an absent load time is an error, not a pass."""
    df = frame(spark, "orders", orders(3)).drop("order_status")
    out = findings(quality.profile_outcomes({"orders": df}, ["orders"], NOW))
    assert out == {("null_check", None): ("PASSED", None, None), ("staleness_check", None): ("ERROR", None, None),
                   ("volume_check", None): ("PASSED", None, None)}
    strict = findings(quality.strict_profile_outcomes({"orders": df}, ["orders"], NOW))
    assert strict[("strict_staleness_check", None)] == ("PASSED", None, None)
    assert findings(quality.strict_duplicate_outcomes({"orders": df}, ["orders"])) == {("strict_duplicate_check", None): ("PASSED", None, None)}


@pytest.mark.parametrize("at,standard,strict", [
    ("2024-01-30 20:00:00", None, None),            # 24 hours
    ("2024-01-30 19:30:00", "WARNING", None),       # 24.5
    ("2024-01-30 18:30:00", "WARNING", "WARNING"),  # 25.5
    ("2024-01-29 20:00:00", "WARNING", "WARNING"),  # 48
    ("2024-01-29 19:00:00", "CRITICAL", "CRITICAL"),
    ("2024-01-27 20:00:00", "CRITICAL", "CRITICAL"),
])
def test_staleness_limits(spark, small, at, standard, strict):
    tables = {"orders": loaded(frame(spark, "orders", orders(2)), at).unionByName(loaded(frame(spark, "orders", orders(1)), "2023-01-01"))}
    out = findings(quality.profile_outcomes(tables, ["orders"], NOW))[("staleness_check", None)]
    assert out == (("FAILED", standard, 1) if standard else ("PASSED", None, None))
    out = findings(quality.strict_profile_outcomes(tables, ["orders"], NOW))[("strict_staleness_check", None)]
    assert out == (("FAILED", strict, 3) if strict else ("PASSED", None, None))


@pytest.mark.parametrize("least,severity", [(10, None), (11, "WARNING"), (12, "WARNING"), (13, "CRITICAL")])
def test_volume_limits(spark, monkeypatch, least, severity):
    monkeypatch.setitem(TABLES, "orders", replace(TABLES["orders"], min_rows=least))
    out = findings(quality.profile_outcomes({"orders": loaded(frame(spark, "orders", orders(10)))}, ["orders"], NOW))
    assert out[("volume_check", None)] == (("FAILED", severity, least - 10) if severity else ("PASSED", None, None))


def test_null_rows_are_limited_per_column(spark):
    rows = [(None, None, "d", f"2021-01-01 10:00:{i % 60:02d}", str(i), None, None, None) for i in range(200)]
    df = loaded(frame(spark, "orders", rows))
    found = profile.null_rows(df, TABLES["orders"]).collect()
    first = sorted(r[ROW_HASH] for r in df.select(ROW_HASH).collect())[:5]
    for column in ("order_id", "customer_id"):
        assert sorted(r[ROW_HASH] for r in found if r["column_name"] == column) == first
    text = profile.null_rows(df, TABLES["orders"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in text and "Partial" in text


# ---- statistics ---------------------------------------------------------------------------


def day_frames(spark, amounts):
    rows = [(f"o{i}", "c", "d", f"2021-{i // 28 + 1:02d}-{i % 28 + 1:02d} 08:00:00", None, None, None, None) for i in range(len(amounts))]
    return (
        frame(spark, "order_payments", [(f"o{i}", 1, "x", 1, a) for i, a in enumerate(amounts)]),
        frame(spark, "orders", rows),
    )


@pytest.mark.parametrize("amounts,expected", [
    ([100.0] * 6 + [9000.0], ("PASSED", None, None)),         # z of a lone value among 7 stays below 3
    ([100.0] * 30, ("PASSED", None, None)),                   # constant series
    ([100.0, 101.0] * 10 + [500.0], ("FAILED", "WARNING", 1)),
    ([100.0, 101.0] * 20 + [500.0], ("FAILED", "CRITICAL", 1)),
    ([100.0] * 5 + [1e6], ("PASSED", None, None)),            # fewer than seven days
    ([], ("PASSED", None, None)),
])
def test_revenue_days(spark, amounts, expected):
    assert findings(quality.revenue_outcome(*day_frames(spark, amounts)))[("revenue_anomaly_check", None)] == expected


def test_repeated_orders_weigh_in(spark):
    payments, orders_df = day_frames(spark, [10.0, 20.0])
    twice = orders_df.unionByName(orders_df.where("order_id = 'o1'"))
    days = {str(r["order_date"]): r["daily_revenue"] for r in anomalies.revenue_days(payments, twice).collect()}
    assert days == {"2021-01-01": 10.0, "2021-01-02": 40.0}


def test_value_profile_against_python(spark):
    rng = random.Random(6)
    drawn = [round(rng.gauss(50, 5), 2) for _ in range(2000)] + [500.0, 900.0, 0.0, 0.0, -3.0, None]
    row = anomalies.value_profiles({"t": (spark.createDataFrame([(v,) for v in drawn], "v double"), ["v"])}).first()
    known = sorted(v for v in drawn if v is not None)
    mean, deviation = statistics.fmean(known), statistics.stdev(known)
    q1, q3 = known[-(-len(known) // 4) - 1], known[-(-3 * len(known) // 4) - 1]
    assert row["value_count"] == len(known) and (row["q1"], row["q3"]) == (q1, q3)
    assert row["mean"] == pytest.approx(mean) and row["deviation"] == pytest.approx(deviation)
    assert row["z_outliers"] == sum(abs((v - mean) / deviation) > 3 for v in known)
    assert row["iqr_outliers"] == sum(v > q3 + 3 * (q3 - q1) or v < q1 - 3 * (q3 - q1) for v in known)
    assert (row["zero_values"], row["negative_values"]) == (2, 1)


@pytest.mark.parametrize("drawn", [[], [None, None], [5.0], [5.0] * 40])
def test_value_profile_without_spread(spark, drawn):
    row = anomalies.value_profiles({"t": (spark.createDataFrame([(v,) for v in drawn], "v double"), ["v"])}).first()
    assert row["value_count"] == len([v for v in drawn if v is not None])
    assert (row["z_outliers"], row["iqr_outliers"], row["zero_values"]) == (0, 0, 0)


@pytest.mark.parametrize("rows,found", [(29, False), (30, True)])
def test_value_checks_need_thirty_values(spark, rows, found):
    df = frame(spark, "order_payments", [("o", i, "x", 1, 0.0) for i in range(rows)])
    out = findings(quality.strict_value_outcomes({"order_payments": df}, ["order_payments"]))
    key = ("strict_value_check", "payment_value" if found else None)
    assert out == {key: ("FAILED", "INFO", rows) if found else ("PASSED", None, None)}


# ---- runs ---------------------------------------------------------------------------------


def outcome_frame(spark, rows):
    return spark.createDataFrame([(c, "t", s, 1, None, [(None, "INFO", 1, "x", None)] * n) for c, s, n in rows], quality.OUTCOME_DDL)


def test_rollup_and_summary(spark):
    df = outcome_frame(spark, [("a", "PASSED", 0), ("a", "PASSED", 0), ("b", "FAILED", 2), ("b", "ERROR", 0), ("c", "FAILED", 1), ("c", "PASSED", 0), ("d", "WARNING", 0)])
    got = {r["check_name"]: (r["overall"], r["violations"], r["checks"]) for r in quality.rollup(df).collect()}
    assert got == {"a": ("PASSED", 0, 2), "b": ("ERROR", 2, 2), "c": ("FAILED", 1, 2), "d": ("WARNING", 0, 1)}
    row = quality.summary(df, CTX).first()
    assert (row["total_checks"], row["passed"], row["failed"], row["warnings"], row["overall_status"]) == (7, 3, 2, 1, "FAILED")
    assert {r["severity"]: r["violations"] for r in quality.severity_counts(quality.violations(df, CTX)).collect()} == {"INFO": 3}


def test_broken_table_is_an_error_and_the_rest_runs(spark, small):
    class Tables(dict):
        def __missing__(self, name):
            raise FileNotFoundError(name)

    bad = F.udf(lambda v: 1 // 0, "string")
    tables = Tables(
        orders=loaded(frame(spark, "orders", orders(3))),
        customers=loaded(frame(spark, "customers", [("c1", "u1", "1", "a", "SP")])).withColumn("customer_id", bad("customer_id")),
    )
    out = quality.isolated_outcomes(spark, tables, NOW, core=("orders", "customers", "products"))
    got = {(r["check_name"], r["table_name"]): r["status"] for r in out.collect()}
    assert {c for (c, t), s in got.items() if t == "bronze_products" and s == "ERROR"} == {"duplicate_check", "null_check", "staleness_check", "volume_check"}
    assert got[("null_check", "bronze_customers")] == "ERROR" and got[("null_check", "bronze_orders")] == "PASSED"
    assert got[("revenue_anomaly_check", "bronze_order_payments")] == "ERROR"
    assert quality.summary(out, CTX).first()["overall_status"] == "FAILED"


def test_samples_hold_rows_as_json(spark, small):
    rows = orders(4)
    df = loaded(frame(spark, "orders", rows + rows[:1] + [(None, "c", "d", None, None, None, None, None)]))
    outcome = quality.outcomes({"orders": df, "order_payments": loaded(frame(spark, "order_payments", []))}, NOW, core=("orders",))
    found = quality.violations(outcome, CTX, quality.samples({"orders": df}, ("orders",))).collect()
    texts = {(r["check_name"], r["column_name"]): [json.loads(t) for t in json.loads(r["sample_records"])] for r in found}
    assert [r["order_id"] for r in texts[("duplicate_check", None)]] == ["o0", "o0"]
    assert texts[("null_check", "order_id")][0]["customer_id"] == "c" and "order_id" not in texts[("null_check", "order_id")][0]
    again = quality.violations(outcome, CTX).collect()
    assert sorted(r["violation_id"] for r in again) == sorted(r["violation_id"] for r in found)


def test_strict_samples(spark):
    a, b = orders(2)
    df = loaded(frame(spark, "orders", [a, b, (*b[:2], "shipped", *b[3:])]))
    values = [("o", i, "x", 1, 10.0 + i % 3) for i in range(60)] + [("o", 99, "x", 1, 5000.0), ("o", 98, "x", 1, -4000.0)]
    tables = {"orders": df, "order_payments": loaded(frame(spark, "order_payments", values))}
    outcome = quality.strict_duplicate_outcomes(tables, ["orders"]).unionByName(quality.strict_value_outcomes(tables, ["order_payments"]))
    found = quality.violations(outcome, CTX, quality.samples(tables, ("orders",), "strict_")).collect()
    texts = {(r["column_name"], r["violation_detail"].split(" ", 1)[1]): json.loads(r["sample_records"]) for r in found}
    assert [json.loads(t) for t in texts[("order_id", "keys have rows with different values")]] == [{"order_id": "o1", "row_count": 2}]
    by_start = {(column, text.split(" (")[0]): sample for (column, text), sample in texts.items()}
    assert by_start[("payment_value", "values with a z-score above 3.0")] == [5000.0, -4000.0]
    assert texts[("payment_value", "values are negative")] == []


def test_default_run_has_twenty_one_checks(spark):
    tables = {t: loaded(frame(spark, t, [])) for t in CORE_TABLES}
    assert quality.outcomes(tables, NOW).count() == 21


def test_trend_and_open(spark):
    history = spark.createDataFrame(
        [("n", "t", "CRITICAL", 5, "2021-01-01 01:00:00"), ("n", "t", "CRITICAL", 1, "2021-01-01 02:00:00"), ("n", "t", "CRITICAL", 4, "2021-01-03 01:00:00"), ("n", "u", "WARNING", 4, "2021-01-03 01:00:00")],
        "check_name string, table_name string, severity string, violation_count bigint, at string",
    ).select("*", F.to_timestamp("at").alias("check_timestamp"))
    got = [(str(r["check_date"]), r["violations"], r["affected_rows"], r["change"]) for r in quality.violation_trend(history).where("severity = 'CRITICAL'").orderBy("check_date").collect()]
    assert got == [("2021-01-01", 2, 6, None), ("2021-01-03", 1, 4, -2)]
    runs = lambda *days: spark.createDataFrame([(d,) for d in days], "d string").select(F.to_timestamp("d").alias("run_timestamp"))
    assert quality.open_critical(history, runs("2021-01-01 01:00:00", "2021-01-03 01:00:00")).count() == 1
    assert quality.open_critical(history, runs("2021-01-04")).count() == 0


def test_rolling_volume(spark):
    df = spark.createDataFrame([(d, 100 if d < 9 else 30) for d in range(1, 11)], "d int, row_count bigint").select(
        F.make_date(F.lit(2021), F.lit(1), "d").alias("day"), "row_count")
    got = {r["day"].day: (r["rolling_mean"], r["drop_pct"], r["volume_drop"]) for r in quality.rolling_volume(df).collect()}
    assert got[1] == (None, None, False) and got[8] == (100.0, 0.0, False)
    assert got[9] == (100.0, 70.0, True) and got[10] == (90.0, 66.67, True)


def test_new_check_needs_only_a_spec(spark):
    spec = TableSpec("extra", 2, ("k",))
    row = profile.table_profile(spark.createDataFrame([(None,), ("a",)], "k string"), spec).first()
    assert (row["row_count"], row["nulls"][0]["null_count"], row["latest"]) == (2, 1, None)
    assert LOADED_AT not in row.asDict()
