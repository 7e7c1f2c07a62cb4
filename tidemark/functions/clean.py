"""Scalar cleaning expressions shared by the cleaning plans and the checks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def lower_trim(name: str) -> Column:
    return F.lower(F.trim(F.col(name)))


def upper_trim(name: str) -> Column:
    return F.upper(F.trim(F.col(name)))


def parse_timestamp(name: str) -> Column:
    """Text to timestamp; unreadable text becomes null instead of failing the job."""
    return F.try_to_timestamp(F.col(name))


def parse_date(name: str) -> Column:
    return F.to_date(F.try_to_timestamp(F.col(name)))


def flag(condition: Column) -> Column:
    """A two-valued flag: an unknown condition counts as false."""
    return F.coalesce(condition, F.lit(False))


def row_hash(columns: list[str]) -> Column:
    """Fingerprint of a row over its source columns, in order.

    Fixed format: MD5 over the ``|``-joined text of the columns, with ``NULL`` for nulls.
    """
    parts = ", ".join(f"coalesce(cast(`{name}` AS STRING), 'NULL')" for name in columns)
    return F.expr(f"md5(concat_ws('|', {parts}))")


def row_hash_strict(columns: list[str]) -> Column:
    """Fingerprint that keeps a null apart from the text ``NULL`` and columns apart from ``|``."""
    return F.md5(
        F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in columns]), {"ignoreNullFields": "false"})
    )
