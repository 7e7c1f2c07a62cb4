"""Quality runs: check outcomes, violations, summaries and trends as DataFrames.

A check produces one *outcome* row (status, rows scanned, an array of findings). Findings are
unrolled into violation rows, outcomes are counted into the run summary. Adding a check means
adding a function from a table to outcome rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.config import (
    CORE_TABLES,
    LOADED_AT,
    ROW_HASH,
    TABLES,
    QualityPolicy,
    RunContext,
    StrictPolicy,
    TableSpec,
)
from tidemark.functions.exact import half_up_ratio, percent
from tidemark.operators import anomalies, duplicates, profile
from tidemark.jobs import run_jobs
from tidemark.session import stage

FINDING = "struct<column_name:string,severity:string,violation_count:bigint,violation_detail:string,sample_records:string>"
OUTCOME_DDL = f"""check_name STRING, table_name STRING, status STRING, rows_scanned BIGINT,
    error_message STRING, findings array<{FINDING}>"""
MICROS_PER_HOUR = 3_600_000_000
SAMPLE_KEYS = 3
SAMPLE_DAYS = 5

Tables = Mapping[str, DataFrame]


def _union(parts: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _finding(
    column: Column | str | None, severity: Column | str, count: Column, detail: Column, sample: Column | None = None
) -> Column:
    name = F.lit(column) if column is None or isinstance(column, str) else column
    level = F.lit(severity) if isinstance(severity, str) else severity
    return F.struct(
        name.cast("string").alias("column_name"),
        level.alias("severity"),
        count.cast("bigint").alias("violation_count"),
        detail.alias("violation_detail"),
        (F.lit(None) if sample is None else sample).cast("string").alias("sample_records"),
    ).cast(FINDING)


def _findings(*pairs: tuple[Column, Column]) -> Column:
    """Array of the findings whose condition holds."""
    return F.array_compact(F.array(*[F.when(condition, finding) for condition, finding in pairs]))


def _outcome(check: str, table: Column | str, rows: Column, findings: Column, error: Column | None = None) -> Column:
    failure = F.lit(None).cast("string") if error is None else error
    status = (
        F.when(failure.isNotNull(), "ERROR").when(F.size(findings) > 0, "FAILED").otherwise("PASSED")
    )
    return F.struct(
        F.lit(check).alias("check_name"),
        (F.lit(table) if isinstance(table, str) else table).alias("table_name"),
        status.alias("status"),
        rows.cast("bigint").alias("rows_scanned"),
        failure.alias("error_message"),
        F.when(failure.isNull(), findings)
        .otherwise(F.array().cast(f"array<{FINDING}>"))
        .cast(f"array<{FINDING}>")
        .alias("findings"),
    )


# What checks outside this module are made of.
finding, findings, outcome = _finding, _findings, _outcome


def _age(as_of: str) -> Column:
    """Microseconds between the newest row of a profile and ``as_of``."""
    return F.unix_micros(F.lit(as_of).cast("timestamp")) - F.unix_micros("latest")


def _hours(as_of: str, places: int = 1) -> Column:
    return half_up_ratio(_age(as_of), F.lit(MICROS_PER_HOUR), places)


def _stamp(column: str) -> Column:
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss")


# ---- Standard family: outcomes over a profile row -----------------------------------------


def _null_outcome(policy: QualityPolicy) -> Column:
    rows = F.col("row_count")

    def finding(entry: Column) -> Column:
        count = entry["null_count"]
        share = percent(count, rows, 2)
        return _finding(
            entry["column_name"],
            F.when(share > F.lit(policy.null_critical_pct), "CRITICAL").otherwise("WARNING"),
            count,
            F.format_string(
                "%s is null in %d of %d rows (%s%%)", entry["column_name"], count, rows, share.cast("string")
            ),
        )

    hit = F.filter("nulls", lambda entry: entry["null_count"] > 0)
    return _outcome("null_check", F.col("table_name"), rows, F.transform(hit, finding))


def _staleness_outcome(policy: QualityPolicy, as_of: str) -> Column:
    limit, age = policy.stale_after_hours, _hours(as_of)
    unknown = F.col("latest").isNull()
    findings = _findings(
        (unknown, _finding(None, "CRITICAL", F.lit(1), F.format_string("%s has no load time", F.col("table_name")))),
        (
            ~unknown & (age > limit),
            _finding(
                None,
                F.when(age > 2 * limit, "CRITICAL").otherwise("WARNING"),
                F.lit(1),
                F.format_string(
                    "%s is %s hours old, last loaded %s, limit %d hours",
                    F.col("table_name"), age.cast("string"), _stamp("latest"), F.lit(limit),
                ),
            ),
        ),
    )
    error = F.when(~F.col("has_load_time"), F.lit(f"column {LOADED_AT} is missing"))
    return _outcome("staleness_check", F.col("table_name"), F.col("row_count"), findings, error)


def _volume_outcome(policy: QualityPolicy) -> Column:
    rows, least = F.col("row_count"), F.col("min_rows")
    missing = least - rows
    share = percent(missing, least, 1)
    findings = _findings(
        (
            rows < least,
            _finding(
                None,
                F.when(share > F.lit(policy.volume_critical_pct), "CRITICAL").otherwise("WARNING"),
                missing,
                F.format_string(
                    "%s has %d rows, %d fewer than the expected %d (%s%%)",
                    F.col("table_name"), rows, missing, least, share.cast("string"),
                ),
            ),
        )
    )
    return _outcome("volume_check", F.col("table_name"), F.when(least > 0, rows).otherwise(0), findings)


def _profiles(tables: Tables, names: Iterable[str]) -> DataFrame:
    """One profile row per table: each table is scanned once for all profile checks."""
    return _union([profile.table_profile(tables[name], TABLES[name]) for name in names])


def profile_outcomes(
    tables: Tables, names: Iterable[str], as_of: str, policy: QualityPolicy = QualityPolicy()
) -> DataFrame:
    """Null, staleness and volume outcomes, from one scan per table."""
    return outcomes_of_profiles(_profiles(tables, names), as_of, policy)


def outcomes_of_profiles(profiles: DataFrame, as_of: str, policy: QualityPolicy = QualityPolicy()) -> DataFrame:
    """Null, staleness and volume outcomes of profile rows, wherever they come from."""
    checks = F.array(_null_outcome(policy), _staleness_outcome(policy, as_of), _volume_outcome(policy))
    return profiles.select(F.inline(checks))


def repeat_outcomes(counts: DataFrame, policy: QualityPolicy = QualityPolicy()) -> DataFrame:
    """Duplicate outcomes from (table_name, row_count, extra_rows), where groups are not counted."""
    extra = F.col("extra_rows")
    severity = F.when(extra > policy.duplicate_critical_rows, "CRITICAL").otherwise("WARNING")
    found = _findings((extra > 0, _finding(None, severity, extra, F.format_string("%d rows too many", extra))))
    return counts.select(F.inline(F.array(_outcome("duplicate_check", F.col("table_name"), F.col("row_count"), found))))


def duplicate_outcomes(
    tables: Tables, names: Iterable[str], policy: QualityPolicy = QualityPolicy()
) -> DataFrame:
    summaries = [
        duplicates.duplicate_summary(tables[name]).withColumn("table_name", F.lit(TABLES[name].bronze))
        for name in names
    ]
    extra = F.col("extra_rows")
    finding = _finding(
        None,
        F.when(extra > policy.duplicate_critical_rows, "CRITICAL").otherwise("WARNING"),
        extra,
        F.format_string("%d repeated rows, %d rows too many", F.col("duplicate_groups"), extra),
    )
    found = _findings((extra > 0, finding))
    outcome = _outcome("duplicate_check", F.col("table_name"), F.col("row_count"), found)
    return _union(summaries).select(F.inline(F.array(outcome)))


def revenue_outcome(
    payments: DataFrame, orders: DataFrame, policy: QualityPolicy = QualityPolicy()
) -> DataFrame:
    """Unusual revenue days as one outcome."""
    days = anomalies.scored_days(anomalies.revenue_days(payments, orders))
    flagged = F.col("z_score") > policy.revenue_z
    top = F.struct("z_score", "order_date", "daily_revenue")
    seen = days.agg(
        F.count(F.lit(1)).alias("day_count"),
        F.count_if(flagged).alias("flagged"),
        F.max(F.when(flagged, top)).alias("top"),
        F.max("mean_revenue").alias("mean_revenue"),
        # at most one entry per calendar day
        F.slice(F.sort_array(F.collect_list(F.when(flagged, top)), asc=False), 1, SAMPLE_DAYS).alias("days"),
    )
    finding = _finding(
        None,
        F.when(F.col("top.z_score") > policy.revenue_critical_z, "CRITICAL").otherwise("WARNING"),
        F.col("flagged"),
        F.format_string(
            "%d unusual revenue days of %d, most unusual %s with revenue %.2f (z-score %.1f, limit %s), mean %.2f a day",
            F.col("flagged"), F.col("day_count"), F.coalesce(F.col("top.order_date").cast("string"), F.lit("unknown")),
            F.col("top.daily_revenue"), F.col("top.z_score"), F.lit(str(policy.revenue_z)), F.col("mean_revenue"),
        ),
        F.to_json("days"),
    )
    enough = F.col("day_count") >= policy.min_history_days
    findings = _findings((enough & (F.col("flagged") > 0), finding))
    outcome = _outcome("revenue_anomaly_check", TABLES["order_payments"].bronze, F.col("day_count"), findings)
    return seen.select(F.inline(F.array(outcome)))


def error_outcomes(spark: SparkSession, checks: Iterable[str], table: str, message: str) -> DataFrame:
    rows = [(check, table, "ERROR", None, message, []) for check in checks]
    return spark.createDataFrame(rows, OUTCOME_DDL)


# ---- Strict family ------------------------------------------------------------------------


def _strict_null_outcome(policy: StrictPolicy) -> Column:
    rows = F.col("row_count")

    def finding(entry: Column) -> Column:
        count = entry["null_count"]
        share = percent(count, rows, 2)
        return _finding(
            entry["column_name"],
            F.when(share >= F.lit(policy.null_critical_pct), "CRITICAL")
            .when(share >= F.lit(policy.null_warning_pct), "WARNING")
            .otherwise("INFO"),
            count,
            F.format_string(
                "%s is null in %d of %d rows (%s%%)", entry["column_name"], count, rows, share.cast("string")
            ),
        )

    hit = F.transform(F.filter("nulls", lambda entry: entry["null_count"] > 0), finding)
    empty = F.array(_finding(None, "CRITICAL", F.lit(0), F.lit("the table has no rows")))
    return _outcome("strict_null_check", F.col("table_name"), rows, F.when(rows == 0, empty).otherwise(hit))


def _strict_staleness_outcome(policy: StrictPolicy, as_of: str) -> Column:
    """Staleness by exact age; every row of a stale table is affected. No load time, no check."""
    age, rows = _age(as_of), F.col("row_count")
    beyond = lambda hours: age > F.lit(hours * MICROS_PER_HOUR)
    unknown = F.col("latest").isNull()
    text = F.format_string(
        "data is %s hours old%s",
        _hours(as_of).cast("string"),
        F.when(
            beyond(policy.stale_severe_hours),
            F.format_string(", nothing loaded for %d days", F.call_function("div", age, F.lit(24 * MICROS_PER_HOUR))),
        )
        .when(beyond(policy.stale_critical_hours), F.lit(", at least one daily load is missing"))
        .otherwise(F.lit(", a load may be late")),
    )
    findings = _findings(
        (F.col("has_load_time") & unknown, _finding(None, "CRITICAL", F.lit(0), F.lit("load time is null in all rows"))),
        (
            ~unknown & beyond(policy.stale_after_hours),
            _finding(None, F.when(beyond(policy.stale_critical_hours), "CRITICAL").otherwise("WARNING"), rows, text),
        ),
    )
    return _outcome("strict_staleness_check", F.col("table_name"), rows, findings)


def strict_profile_outcomes(
    tables: Tables, names: Iterable[str], as_of: str, policy: StrictPolicy = StrictPolicy()
) -> DataFrame:
    """Strict null and staleness outcomes, from one scan per table."""
    checks = F.array(_strict_null_outcome(policy), _strict_staleness_outcome(policy, as_of))
    return _profiles(tables, names).select(F.inline(checks))


def _strict_duplicate_row(df: DataFrame, spec: TableSpec) -> DataFrame:
    """row_count, duplicate_groups, extra_rows, conflicts and the key of one table.

    Without row hashes or without a complete business key there is nothing to compare.
    """
    none = F.lit(0).cast("bigint")
    if ROW_HASH not in df.columns:
        counted = df.agg(F.count(F.lit(1)).alias("row_count"))
        counted = counted.withColumns({"duplicate_groups": none, "extra_rows": none, "conflicts": none})
    else:
        keyed = bool(spec.business_key) and all(key in df.columns for key in spec.business_key)
        conflicts = (
            duplicates.key_conflicts(df, spec.business_key).agg(F.count(F.lit(1))).scalar() if keyed else none
        )
        counted = duplicates.duplicate_summary(df).withColumn("conflicts", conflicts)
    return counted.withColumns(
        {"table_name": F.lit(spec.bronze), "business_key": F.lit(",".join(spec.business_key))}
    )


def strict_duplicate_outcomes(tables: Tables, names: Iterable[str]) -> DataFrame:
    """Repeated rows and, where the table has a business key, keys with conflicting rows."""
    extra, groups, keys = F.col("extra_rows"), F.col("duplicate_groups"), F.col("conflicts")
    findings = _findings(
        (
            extra > 0,
            _finding(None, "CRITICAL", extra, F.format_string("%d repeated rows, %d rows too many", groups, extra)),
        ),
        (
            keys > 0,
            _finding(
                F.col("business_key"),
                "WARNING",
                keys,
                F.format_string("%d keys have rows with different values", keys),
            ),
        ),
    )
    outcome = _outcome("strict_duplicate_check", F.col("table_name"), F.col("row_count"), findings)
    rows = _union([_strict_duplicate_row(tables[name], TABLES[name]) for name in names])
    return rows.select(F.inline(F.array(outcome)))


# ---- Fixed values: value findings, their severity and text -------------------------------
VALUE_FINDINGS = {
    "z_outliers": ("WARNING", "%d values with a z-score above %s (mean %.2f, deviation %.2f)"),
    "iqr_outliers": ("WARNING", "%d values outside [%.2f, %.2f] (Q1 %.2f, Q3 %.2f, IQR %.2f)"),
    "zero_values": ("INFO", "%d values are zero"),
    "negative_values": ("WARNING", "%d values are negative"),
}


def _value_figures(field: str, policy: StrictPolicy) -> list[Column]:
    """What the text of a value finding shows beside the number of values."""
    q1, q3 = F.col("q1"), F.col("q3")
    fence = F.lit(policy.iqr_multiplier) * (q3 - q1)
    return {
        "z_outliers": [F.lit(str(policy.value_z)), F.col("mean"), F.col("deviation")],
        "iqr_outliers": [q1 - fence, q3 + fence, q1, q3, q3 - q1],
    }.get(field, [])


def strict_value_outcomes(
    tables: Tables, names: Iterable[str], policy: StrictPolicy = StrictPolicy()
) -> DataFrame:
    """Outliers, zeros and negatives in the value columns: one outcome per table that has any."""
    present = {
        TABLES[name].bronze: (tables[name], [c for c in TABLES[name].value_columns if c in tables[name].columns])
        for name in names
    }
    profiles = anomalies.value_profiles({name: pair for name, pair in present.items() if pair[1]}, policy)
    enough = F.col("value_count") >= policy.min_values

    def shown(field: str) -> Column | None:
        return F.to_json(F.col(f"{field}_top")) if field in anomalies.OUTLIERS else None

    findings = _findings(
        *[
            (
                enough & (F.col(field) > 0),
                _finding(
                    F.col("column_name"), severity, F.col(field),
                    F.format_string(text, F.col(field), *_value_figures(field, policy)), shown(field),
                ),
            )
            for field, (severity, text) in VALUE_FINDINGS.items()
        ]
    )
    # One row per value column of the configuration is grouped here, never data rows.
    per_table = (
        profiles.select("table_name", "value_count", findings.alias("found"))
        .groupBy("table_name")
        .agg(F.max("value_count").alias("value_count"), F.flatten(F.collect_list("found")).alias("found"))
    )
    outcome = _outcome("strict_value_check", F.col("table_name"), F.col("value_count"), F.col("found"))
    return per_table.select(F.inline(F.array(outcome)))


def with_value_columns(names: Iterable[str]) -> list[str]:
    return [name for name in names if TABLES[name].value_columns]


def strict_outcomes(
    tables: Tables, as_of: str, names: Iterable[str] = TABLES, policy: StrictPolicy = StrictPolicy()
) -> DataFrame:
    """All strict outcomes of the named tables."""
    names = tuple(names)
    return _union(
        [
            strict_duplicate_outcomes(tables, names),
            strict_profile_outcomes(tables, names, as_of, policy),
            strict_value_outcomes(tables, with_value_columns(names), policy),
        ]
    )


# ---- Runs ---------------------------------------------------------------------------------

def table_outcomes(
    tables: Tables, table: str, as_of: str, policy: QualityPolicy = QualityPolicy()
) -> dict[tuple[str, ...], Callable[[], DataFrame]]:
    """The standard checks of one table, grouped by the scan that answers them."""
    return {
        ("duplicate_check",): lambda: duplicate_outcomes(tables, [table], policy),
        ("null_check", "staleness_check", "volume_check"): lambda: profile_outcomes(tables, [table], as_of, policy),
    }


def outcomes(
    tables: Tables, as_of: str, core: Iterable[str] = CORE_TABLES, policy: QualityPolicy = QualityPolicy()
) -> DataFrame:
    """All standard outcomes as one lazy DataFrame: four per table and the revenue check."""
    core = tuple(core)
    return _union(
        [
            duplicate_outcomes(tables, core, policy),
            profile_outcomes(tables, core, as_of, policy),
            revenue_outcome(tables["order_payments"], tables["orders"], policy),
        ]
    )


def isolated_outcomes(
    spark: SparkSession,
    tables: Tables,
    as_of: str,
    core: Iterable[str] = CORE_TABLES,
    policy: QualityPolicy = QualityPolicy(),
    limit_s: float | None = None,
) -> DataFrame:
    """Like ``outcomes``, but every scan is a job of its own: what fails becomes an ERROR outcome.

    Jobs run side by side; one that takes longer than ``limit_s`` is stopped and is an ERROR.
    """
    jobs = {
        (checks, TABLES[table].bronze): make
        for table in core
        for checks, make in table_outcomes(tables, table, as_of, policy).items()
    }
    jobs[("revenue_anomaly_check",), TABLES["order_payments"].bronze] = lambda: revenue_outcome(
        tables["order_payments"], tables["orders"], policy
    )
    return concurrent_outcomes(spark, jobs, limit_s).drop("seconds")


def concurrent_outcomes(
    spark: SparkSession, jobs: Mapping[tuple[tuple[str, ...], str], Callable[[], DataFrame]], limit_s: float | None = None
) -> DataFrame:
    """Outcomes of jobs named by (checks, table), with the ``seconds`` that each job took."""
    named = {f"{table}: {', '.join(checks)}": (checks, table, make) for (checks, table), make in jobs.items()}
    results = run_jobs(spark, {name: lambda make=make: stage(make(), "outcomes") for name, (_, _, make) in named.items()}, limit_s=limit_s)
    parts = []
    for result in results:
        checks, table, _ = named[result.name]
        rows = result.value if result.error is None else error_outcomes(spark, checks, table, result.error)
        parts.append(rows.withColumn("seconds", F.lit(round(result.seconds, 3))))
    return _union(parts)


def samples(tables: Tables, core: Iterable[str] = CORE_TABLES, family: str = "") -> DataFrame:
    """Sample rows per (check, table, column) for the checks that point at rows.

    ``family="strict_"`` gives those of the strict checks, with sample keys for conflicts.
    """
    parts = []
    for table in core:
        df, spec = tables[table], TABLES[table]

        def add(check: str, rows: DataFrame) -> None:
            sample = profile.as_sample(rows, "column_name")
            label = [F.lit(f"{family}{check}").alias("check_name"), F.lit(spec.bronze).alias("table_name")]
            parts.append(sample.select(*label, "column_name", "sample_records"))

        no_column = F.lit(None).cast("string")
        add("duplicate_check", duplicates.duplicate_sample(df).withColumn("column_name", no_column))
        add("null_check", profile.null_rows(df, spec))
        if family and spec.business_key:
            keys = duplicates.key_conflicts(df, spec.business_key).orderBy(*spec.business_key).limit(SAMPLE_KEYS)
            add("duplicate_check", keys.withColumn("column_name", F.lit(",".join(spec.business_key))))
    return _union(parts)


def violations(outcome: DataFrame, ctx: RunContext, sample: DataFrame | None = None) -> DataFrame:
    """One row per finding, in the layout of the violations table."""
    found = outcome.select("check_name", "table_name", F.inline("findings"))
    if sample is not None:
        named = sample.select("check_name", "table_name", "column_name", F.col("sample_records").alias("rows"))
        same = (
            (found["check_name"] == named["check_name"])
            & (found["table_name"] == named["table_name"])
            & found["column_name"].eqNullSafe(named["column_name"])
        )
        found = found.join(named, same, "left").select(
            *[found[c] for c in found.columns if c != "sample_records"],
            F.coalesce(found["sample_records"], named["rows"]).alias("sample_records"),
        )
    # Derived, not random: a run that is repeated produces the same ids.
    identity = F.md5(
        F.concat_ws("|", F.lit(ctx.run_id), "check_name", "table_name", F.coalesce("column_name", F.lit("")),
                    "violation_detail")
    )
    return found.select(
        identity.alias("violation_id"),
        F.lit(ctx.run_id).alias("run_id"),
        "check_name",
        "table_name",
        "column_name",
        "severity",
        "violation_count",
        "violation_detail",
        F.coalesce("sample_records", F.lit("[]")).alias("sample_records"),
        F.lit(ctx.as_of).cast("timestamp").alias("check_timestamp"),
        F.lit(ctx.environment).alias("environment"),
    )


def summary(outcome: DataFrame, ctx: RunContext) -> DataFrame:
    """One row per run. ``warnings`` holds the number of checks that ended in ERROR."""
    status = F.col("status")
    counted = outcome.agg(
        F.count(F.lit(1)).alias("total_checks"),
        F.count_if(status == "PASSED").alias("passed"),
        F.count_if(status == "FAILED").alias("failed"),
        F.count_if(status == "ERROR").alias("warnings"),
    )
    clean = (F.col("failed") == 0) & (F.col("warnings") == 0)
    return counted.select(
        F.lit(ctx.run_id).alias("run_id"),
        F.lit(ctx.pipeline_name).alias("pipeline_name"),
        "total_checks",
        "passed",
        "failed",
        "warnings",
        F.when(clean, "PASSED").otherwise("FAILED").alias("overall_status"),
        F.lit(ctx.as_of).cast("timestamp").alias("run_timestamp"),
        F.lit(ctx.environment).alias("environment"),
    )


def rollup(outcome: DataFrame) -> DataFrame:
    """Worst status and number of violations per check."""
    status = F.col("status")
    return (
        outcome.groupBy("check_name")
        .agg(
            F.bool_and(status == "PASSED").alias("all_passed"),
            F.bool_or(status == "ERROR").alias("any_error"),
            F.bool_or(status == "FAILED").alias("any_failed"),
            F.sum(F.size("findings")).cast("bigint").alias("violations"),
            F.count(F.lit(1)).alias("checks"),
        )
        .select(
            "check_name",
            F.when(F.col("all_passed"), "PASSED")
            .when(F.col("any_error"), "ERROR")
            .when(F.col("any_failed"), "FAILED")
            .otherwise("WARNING")
            .alias("overall"),
            "violations",
            "checks",
        )
    )


def severity_counts(violation: DataFrame) -> DataFrame:
    return violation.groupBy("severity").agg(F.count(F.lit(1)).alias("violations"))


# ---- Over several runs --------------------------------------------------------------------


def violation_trend(history: DataFrame) -> DataFrame:
    """Violations per day, check and severity, with the change against the previous day seen."""
    per_day = history.groupBy(
        F.to_date("check_timestamp").alias("check_date"), "check_name", "severity"
    ).agg(F.count(F.lit(1)).alias("violations"), F.sum("violation_count").alias("affected_rows"))
    before = F.lag("affected_rows").over(Window.partitionBy("check_name", "severity").orderBy("check_date"))
    return per_day.withColumn("change", F.col("affected_rows") - before)


def open_critical(history: DataFrame, summaries: DataFrame) -> DataFrame:
    """CRITICAL violations of the newest run; a newer clean run closes all of them."""
    critical = history.where(F.col("severity") == "CRITICAL")
    if "run_id" in summaries.columns and "run_id" in history.columns:
        newest = summaries.agg(F.max_by("run_id", "run_timestamp").alias("id")).select("id").scalar()
        return critical.where(F.col("run_id") == newest)
    newest = summaries.agg(F.max("run_timestamp").alias("t")).select("t").scalar()
    return critical.where(F.col("check_timestamp") == newest)


def rolling_volume(per_day: DataFrame, drop_pct: float = 50.0, days: int = 7) -> DataFrame:
    """Daily row counts against the mean of the previous ``days`` days: (day, row_count) in.

    One row per calendar day, so the ordered window is bounded.
    """
    before = Window.orderBy("day").rowsBetween(-days, -1)
    expected = per_day.withColumns(
        {"past_rows": F.sum("row_count").over(before), "past_days": F.count("row_count").over(before)}
    )
    drop = half_up_ratio(
        (F.col("past_rows") - F.col("row_count") * F.col("past_days")) * F.lit(100), F.col("past_rows"), 2
    )
    return expected.select(
        "day",
        "row_count",
        half_up_ratio(F.col("past_rows"), F.col("past_days"), 2).cast("double").alias("rolling_mean"),
        drop.cast("double").alias("drop_pct"),
        F.coalesce(drop > F.lit(drop_pct), F.lit(False)).alias("volume_drop"),
    )


def rolling_volume_by_calendar(per_day: DataFrame, drop_pct: float = 50.0, days: int = 7) -> DataFrame:
    """Like ``rolling_volume``, but over calendar days: a day without rows counts as 0 and is flagged.

    The calendar runs from the first to the last day seen; one row per day, so the window is bounded.
    """
    known = per_day.where(F.col("day").isNotNull())
    spine = known.agg(F.min("day").alias("a"), F.max("day").alias("b")).where("a IS NOT NULL").select(
        F.explode(F.sequence("a", "b")).alias("day")
    )
    filled = spine.join(known, "day", "left").withColumn("row_count", F.coalesce("row_count", F.lit(0).cast("bigint")))
    return rolling_volume(filled, drop_pct, days).withColumn("missing", F.col("row_count") == 0)


def finding_spans(history: DataFrame, runs: DataFrame, *key: str) -> DataFrame:
    """For every finding ever seen: open since when, for how many runs, and how often it came back.

    ``history`` has the findings with their run's time ``check_timestamp``, ``runs`` every run's
    ``run_timestamp``, clean ones too. Runs are numbered; consecutive runs with the finding form an
    island. The result has, for each key, the newest island (``since``, ``last_seen``, ``runs_in_a_row``),
    all runs with it, the reopenings, and whether the newest run still has it.

    The list of runs is short, so numbering it takes one task; findings are reduced to one row per run.
    """
    numbered = runs.select("run_timestamp").distinct().withColumn("run", F.row_number().over(Window.orderBy("run_timestamp")))
    newest = numbered.agg(F.max("run").alias("newest")).select("newest").scalar()
    seen = (
        history.groupBy(*key, F.col("check_timestamp").alias("run_timestamp")).agg(F.sum("violation_count").alias("affected_rows"))
        .join(F.broadcast(numbered), "run_timestamp")
    )
    of = Window.partitionBy(*key)
    islands = seen.withColumn("island", F.col("run") - F.row_number().over(of.orderBy("run"))).groupBy(*key, "island").agg(
        F.min("run_timestamp").alias("since"), F.max("run_timestamp").alias("last_seen"), F.max("run").alias("last_run"),
        F.count(F.lit(1)).alias("runs_in_a_row"), F.max_by("affected_rows", "run").alias("affected_rows"),
    )
    last = F.struct("last_run", "since", "last_seen", "runs_in_a_row", "affected_rows")
    return (
        islands.groupBy(*key).agg(
            F.max(last).alias("l"), F.sum("runs_in_a_row").alias("runs_seen"), (F.count(F.lit(1)) - 1).alias("reopenings")
        )
        .select(*key, "l.since", "l.last_seen", "l.runs_in_a_row", "l.affected_rows", "runs_seen", "reopenings", (F.col("l.last_run") == newest).alias("is_open"))
    )
