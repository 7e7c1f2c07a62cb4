"""Schema drift between a source and its declared schema."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType


@dataclass(frozen=True)
class Drift:
    """Result of a comparison; names are sorted, mismatches read ``name: expected X, got Y``."""

    table: str
    missing_columns: tuple[str, ...] = ()
    extra_columns: tuple[str, ...] = ()
    type_mismatches: tuple[str, ...] = ()
    critical_missing: tuple[str, ...] = ()

    @property
    def has_drift(self) -> bool:
        return bool(self.missing_columns or self.extra_columns or self.type_mismatches)

    def columns(self) -> dict[str, Column]:
        """The report as literal columns, for a DataFrame or for ``to_json``."""
        texts = lambda names: F.array(*[F.lit(n) for n in names]).cast("array<string>")
        return {
            "has_drift": F.lit(self.has_drift),
            "missing_columns": texts(self.missing_columns),
            "extra_columns": texts(self.extra_columns),
            "type_mismatches": texts(self.type_mismatches),
            "critical_missing": texts(self.critical_missing),
        }

    def json(self) -> Column:
        return F.to_json(F.struct(*[column.alias(name) for name, column in self.columns().items()]))

    def summary(self) -> str:
        if not self.has_drift:
            return f"{self.table}: schema as declared"
        parts = {
            "missing": self.missing_columns,
            "extra": self.extra_columns,
            "types": self.type_mismatches,
            "critical missing": self.critical_missing,
        }
        return f"{self.table}: drift, " + "; ".join(f"{k} {', '.join(v)}" for k, v in parts.items() if v)


def compare(table: str, actual: StructType, expected: StructType, critical: tuple[str, ...] = ()) -> Drift:
    """Compare schemas by column name. Types differ when their full text differs.

    The text names the class; parameters are added when only they differ, such as the
    precision of a decimal.
    """
    have = {field.name: field.dataType for field in actual.fields}
    want = {field.name: field.dataType for field in expected.fields}
    missing = tuple(sorted(want.keys() - have.keys()))

    def mismatch(name: str) -> str:
        ours, theirs = type(want[name]).__name__, type(have[name]).__name__
        if ours == theirs:
            ours, theirs = want[name].simpleString(), have[name].simpleString()
        return f"{name}: expected {ours}, got {theirs}"

    return Drift(
        table,
        missing_columns=missing,
        extra_columns=tuple(sorted(have.keys() - want.keys())),
        type_mismatches=tuple(
            mismatch(name)
            for name in sorted(want.keys() & have.keys())
            if want[name].simpleString() != have[name].simpleString()
        ),
        critical_missing=tuple(name for name in critical if name in missing),
    )


def drift_report(df: DataFrame, expected: StructType, table: str, critical: tuple[str, ...] = ()) -> DataFrame:
    """One row: the comparison and the number of rows it concerns."""
    found = compare(table, df.schema, expected, critical)
    rows = df.agg(F.count(F.lit(1)).alias("row_count"))
    return rows.select(
        F.lit(table).alias("table_name"),
        "row_count",
        *[column.alias(name) for name, column in found.columns().items()],
        found.json().alias("report"),
    )


def header_drift(text: DataFrame, expected: StructType, table: str, critical: tuple[str, ...] = ()) -> Drift:
    """Drift of a file read as text: names come from its header, types are not judged yet."""
    as_text = StructType([type(field)(field.name, StringType()) for field in expected.fields])
    return compare(table, text.schema, as_text, critical)


def conform(text: DataFrame, expected: StructType) -> DataFrame:
    """Map text columns to the declared schema by name.

    A missing column becomes null, an unreadable value becomes null, and an unexpected column
    stays at the end as text.
    """
    wanted = [
        (F.col(f.name).try_cast(f.dataType) if f.name in text.columns else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in expected.fields
    ]
    extra = [F.col(name) for name in text.columns if name not in expected.fieldNames()]
    return text.select(*wanted, *extra)


def damage_counts(text: DataFrame, expected: StructType) -> dict[str, Column]:
    """Aggregates: how many present values of each typed column cannot be read as its type."""
    return {
        field.name: F.count_if(F.col(field.name).isNotNull() & F.col(field.name).try_cast(field.dataType).isNull())
        for field in expected.fields
        if field.name in text.columns and not isinstance(field.dataType, StringType)
    }


def damage_report(text: DataFrame, expected: StructType, table: str) -> DataFrame:
    """One row per typed column: (table_name, column_name, row_count, bad_values)."""
    counts = damage_counts(text, expected)
    if not counts:
        return text.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(table).alias("table_name"), F.lit("").alias("column_name"), "row_count",
            F.lit(0).cast("bigint").alias("bad_values"),
        ).limit(0)
    one = text.agg(F.count(F.lit(1)).alias("row_count"), *[c.alias(n) for n, c in counts.items()])
    return one.unpivot(["row_count"], list(counts), "column_name", "bad_values").select(
        F.lit(table).alias("table_name"), "column_name", "row_count", "bad_values"
    )
