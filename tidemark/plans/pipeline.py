"""Layer runs over a table store. Every table is written once and counted while it is written."""

from __future__ import annotations

import logging
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.config import CORE_TABLES, TABLES, RunContext
from tidemark.functions.clean import flag
from tidemark.plans import bronze, gold, quality, silver
from tidemark.plans.bucketed import GoldFacts
from tidemark.jobs import run_jobs
from tidemark.session import stage
from tidemark.sources.files import TableStore

log = logging.getLogger(__name__)
RUN_DDL = "table_name STRING, status STRING, rows_in BIGINT, rows_kept BIGINT, rows_rejected BIGINT, rows_out BIGINT, seconds DOUBLE, error STRING"


class BronzeTables(Mapping[str, DataFrame]):
    """Current bronze tables, opened on first use."""

    def __init__(self, store: TableStore) -> None:
        self._store, self._opened = store, {}

    def __getitem__(self, table: str) -> DataFrame:
        # Opened once: a load that commits during a run does not split it over two versions.
        if table not in self._opened:
            self._opened[table] = self._open(table)
        return self._opened[table]

    def _open(self, table: str) -> DataFrame:
        return bronze.read_bronze(self._store, table)

    def __iter__(self):
        return iter(TABLES)

    def __len__(self) -> int:
        return len(TABLES)


class StoredSilver(BronzeTables):
    """Written silver tables, opened on first use."""

    def _open(self, table: str) -> DataFrame:
        return self._store.read("silver", TABLES[table].silver)


def split_table(store: TableStore, table: str, source: DataFrame, kept_layer: str = "silver") -> dict[str, int]:
    """Kept and rejected rows in one write; returns the rows per outcome, counted by the same job."""
    seen = Observation()
    counts = silver.outcome_counts(table)
    rows = silver.with_outcome(table, source).observe(seen, *[count.alias(f"o{i}") for i, count in enumerate(counts.values())])
    store.write_split(rows, "reject_reason", silver.KEPT, kept_layer, "quarantine", TABLES[table].silver)
    return {outcome: seen.get[f"o{i}"] for i, outcome in enumerate(counts)}


def clean_table(store: TableStore, table: str, quarantine: bool = False) -> dict[str, int]:
    """Write one silver table; rows read, kept and rejected are counted in the same job.

    With ``quarantine`` the rejected rows are a table too, and both come from one scan. Counters
    inside a job are exact only in its last stage, where a task that is run again after a lost
    executor counts once. The one table that is regrouped before it is written therefore counts
    its input in a job of its own, or in the split.
    """
    source, name = BronzeTables(store)[table], TABLES[table].silver
    written = Observation()
    rows_out = F.count(F.lit(1)).alias("rows_out")
    regrouped = table in silver.REGROUPED
    if quarantine:
        found = split_table(store, table, source, "cleaned" if regrouped else "silver")
        total = sum(found.values())
        report = {"rows_in": total, "rows_kept": found[silver.KEPT], "rows_rejected": total - found[silver.KEPT]}
        if not regrouped:
            return {**report, "rows_out": report["rows_kept"]}
        store.overwrite(silver.REGROUPED[table](store.read("cleaned", name)).observe(written, rows_out), "silver", name)
        return {**report, **written.get}
    if regrouped:
        counted = silver.row_accounting(table, source).drop("table_name").first().asDict()
        store.overwrite(silver.clean(table, source).observe(written, rows_out), "silver", name)
        return {**counted, **written.get}
    keep = flag(silver.keep_condition(table))
    typed = silver.typed(table, source).observe(
        written,
        F.count(F.lit(1)).alias("rows_in"),
        F.count_if(keep).alias("rows_kept"),
        F.count_if(~keep).alias("rows_rejected"),
    )
    store.overwrite(typed.where(silver.keep_condition(table)), "silver", name)
    return {**written.get, "rows_out": written.get["rows_kept"]}


def _report(spark: SparkSession, results: list[dict]) -> DataFrame:
    names = [part.split()[0] for part in RUN_DDL.split(",")]
    return spark.createDataFrame([tuple(result.get(name) for name in names) for result in results], RUN_DDL)


def _each(spark: SparkSession, names: Iterable[str], run, limit_s: float | None = None) -> list[dict]:
    """Tables side by side, each with its time; one table must not stop the others."""
    results = []
    for job in run_jobs(spark, {name: lambda name=name: run(name) for name in names}, limit_s=limit_s):
        row = {"table_name": job.name, "seconds": round(job.seconds, 3)}
        if job.error is None:
            results.append({**row, "status": "SUCCESS", **job.value})
        else:
            log.error("%s: %s", job.name, job.error)
            results.append({**row, "status": "FAILED", "error": job.error})
    return results


def run_silver(
    store: TableStore, tables: Iterable[str] = TABLES, quarantine: bool = False, limit_s: float | None = None
) -> DataFrame:
    """Write the silver tables; returns one status row per table."""
    by_name = {TABLES[table].silver: table for table in tables}
    rows = _each(store.spark, by_name, lambda name: clean_table(store, by_name[name], quarantine), limit_s)
    return _report(store.spark, rows)


def run_gold(store: TableStore, limit_s: float | None = None) -> DataFrame:
    """Write the KPI tables; returns one status row per table. The facts they share are put in buckets once."""
    with GoldFacts(store.spark, StoredSilver(store)) as facts:

        def build(name: str) -> dict[str, int]:
            written = Observation()
            result = gold.GOLD[name](facts).observe(written, F.count(F.lit(1)).alias("rows_out"))
            store.overwrite(result, "gold", name)
            return written.get

        return _report(store.spark, _each(store.spark, gold.GOLD, build, limit_s))


def _samples(tables: quality.Tables, names: Iterable[str], family: str) -> DataFrame | None:
    try:
        return stage(quality.samples(tables, names, family), "samples")
    except Exception as failure:  # violations are worth having without samples
        log.error("no samples: %s", failure)
        return None


STANDARD, STRICT = "standard", "strict"


def record_run(store: TableStore, ctx: RunContext, outcomes: DataFrame, sample: DataFrame | None, family: str) -> None:
    """Store what a run of one check family found and its summary.

    Both replace what the run recorded for that family before, so a repeated run counts once and
    shows its newest state, and two families of one run do not touch each other.
    """
    of = F.lit(family)
    for table, rows in (("dq_violations", quality.violations(outcomes, ctx, sample)), ("dq_summary", quality.summary(outcomes, ctx))):
        if table == "dq_violations" and rows.isEmpty():  # a clean run also clears what an earlier one found
            store.remove_rows("quality", table, run_id=ctx.run_id, family=family)
        else:
            store.replace_rows(rows.withColumn("family", of), "quality", table, "run_id", "family")


def run_quality(
    store: TableStore, ctx: RunContext, core: Iterable[str] = CORE_TABLES, with_samples: bool = True
) -> DataFrame:
    """Run the standard checks on bronze, append violations and summary, return the outcomes."""
    core = tuple(core)
    tables = BronzeTables(store)
    outcomes = stage(quality.isolated_outcomes(store.spark, tables, ctx.as_of, core), "run")
    sample = _samples(tables, core, "") if with_samples else None
    record_run(store, ctx, outcomes, sample, STANDARD)
    return outcomes


def run_strict_quality(
    store: TableStore, ctx: RunContext, tables: Iterable[str] = TABLES, with_samples: bool = True
) -> DataFrame:
    """Run the strict checks on bronze, append their violations and summary, return the outcomes."""
    tables = tuple(tables)
    bronze_tables = BronzeTables(store)
    jobs = {}
    for table in tables:
        name = TABLES[table].bronze
        jobs[("strict_duplicate_check",), name] = lambda table=table: quality.strict_duplicate_outcomes(bronze_tables, [table])
        jobs[("strict_null_check", "strict_staleness_check"), name] = lambda table=table: quality.strict_profile_outcomes(
            bronze_tables, [table], ctx.as_of
        )
        if TABLES[table].value_columns:
            jobs[("strict_value_check",), name] = lambda table=table: quality.strict_value_outcomes(bronze_tables, [table])
    outcomes = quality.concurrent_outcomes(store.spark, jobs).drop("seconds")
    sample = _samples(bronze_tables, tables, "strict_") if with_samples else None
    record_run(store, ctx, outcomes, sample, STRICT)
    return outcomes
