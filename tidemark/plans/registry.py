"""Checks registered by name: each declares the aggregates it needs, and one scan answers all of them.

A check is a function from a table to named aggregates and one from their values to an outcome. All
checks that apply to a table are planned into a single aggregate row, so a further check costs a few
expressions, not a scan. Limits come from a table (check_name, table_name, limit_value) by join; a row
without a table name holds for every table, one with a name goes before it, and without any the
check's own default holds.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.config import TABLES, TableSpec
from tidemark.plans import quality

LIMITS_DDL = "check_name string, table_name string, limit_value double"
ROWS = "row_count"


@dataclass(frozen=True)
class Check:
    """``measures(df, spec)`` gives named aggregates, or none if the check does not apply to the table.

    ``findings(values, limit)`` gets those values as columns, with ``row_count``, and the limit; it
    returns (condition, finding) pairs made with ``quality.finding``.
    """

    name: str
    measures: Callable[[DataFrame, TableSpec], Mapping[str, Column]]
    findings: Callable[[Mapping[str, Column], Column], list[tuple[Column, Column]]]
    default_limit: float = 0.0


CHECKS: dict[str, Check] = {}


def register(check: Check) -> Check:
    """Add a check to the default set; a name can be taken once."""
    if check.name in CHECKS:
        raise ValueError(f"a check named {check.name} exists")
    CHECKS[check.name] = check
    return check


def _limits(limits: DataFrame, spec: TableSpec, checks: list[Check]) -> DataFrame:
    """One row with a limit per check, for one table."""
    mine = limits.where(F.col("table_name").isNull() | (F.col("table_name") == spec.bronze))
    of = lambda check, named: F.max(F.when((F.col("check_name") == check.name) & named, F.col("limit_value")))
    return mine.agg(*[
        F.coalesce(of(c, F.col("table_name").isNotNull()), of(c, F.col("table_name").isNull()), F.lit(c.default_limit)).alias(f"limit_{i}")
        for i, c in enumerate(checks)
    ])


def table_outcomes(df: DataFrame, spec: TableSpec, limits: DataFrame, checks: Iterable[Check] | None = None) -> DataFrame:
    """One outcome row per check that applies to the table, from one scan."""
    asked = [(c, dict(c.measures(df, spec))) for c in (CHECKS.values() if checks is None else checks)]
    asked = [(c, m) for c, m in asked if m]
    columns = [column.alias(f"m{i}_{name}") for i, (_, m) in enumerate(asked) for name, column in m.items()]
    seen = df.agg(F.count(F.lit(1)).alias(ROWS), *columns)
    known = _limits(limits, spec, [c for c, _ in asked])
    row = seen.withColumn("limits", known.select(F.struct("*").alias("l")).scalar())
    outcomes = []
    for i, (check, measures) in enumerate(asked):
        values = {name: F.col(f"m{i}_{name}") for name in measures} | {ROWS: F.col(ROWS)}
        outcomes.append(quality.outcome(check.name, spec.bronze, F.col(ROWS), quality.findings(*check.findings(values, F.col("limits")[f"limit_{i}"]))))
    return row.select(F.inline(F.array(*outcomes)))


def outcomes(tables: quality.Tables, names: Iterable[str], limits: DataFrame, checks: Iterable[Check] | None = None) -> DataFrame:
    """Outcomes of all registered checks, or of the given ones, over the named tables."""
    asked = None if checks is None else list(checks)
    return reduce(DataFrame.unionByName, [table_outcomes(tables[name], TABLES[name], limits, asked) for name in names])


# ---- Checks that come with the library ----------------------------------------------------


def _numbers(df: DataFrame, spec: TableSpec) -> list[str]:
    return [c for c in spec.value_columns if c in df.columns]


def _share(part: Column, whole: Column) -> Column:
    return F.try_divide(part * F.lit(100.0), whole)


register(
    Check(
        "null_share",
        lambda df, spec: {c: F.count_if(F.col(c).isNull()) for c in spec.critical if c in df.columns},
        lambda values, limit: [
            (_share(n, values[ROWS]) > limit, quality.finding(c, "WARNING", n, F.format_string("%d null values", n)))
            for c, n in values.items() if c != ROWS
        ],
    )
)
register(
    Check(
        "negative_share",
        lambda df, spec: {c: F.count_if(F.col(c) < 0) for c in _numbers(df, spec)},
        lambda values, limit: [
            (_share(n, values[ROWS]) > limit, quality.finding(c, "WARNING", n, F.format_string("%d negative values", n)))
            for c, n in values.items() if c != ROWS
        ],
    )
)
register(
    Check(
        "least_rows",
        lambda df, spec: {"rows": F.count(F.lit(1))},
        lambda values, limit: [
            (values[ROWS] < limit, quality.finding(None, "CRITICAL", F.ceil(limit) - values[ROWS], F.format_string("%d rows", values[ROWS])))
        ],
    )
)
