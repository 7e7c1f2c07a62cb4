"""Exact quantiles of large columns by selection: values are counted in place, never moved.

A first scan gives counts, bounds and a small sketch of each column. Every further scan counts the
values on both sides of two probes around the wanted rank, exactly, and sketches what lies between
them, so the range that holds the rank shrinks by about ``GRID / 3`` a scan; only rows inside the
open ranges are read, which reaches the file statistics. When a range holds at most ``SMALL`` values
they are sorted. A task sends one row of counts and sketches, whatever it has read.

The sketches only choose probes: the counts are exact, a wrong probe costs a scan. A range always
shrinks, as the probes themselves are either the answer or leave it, so many equal values, or all
values in one narrow range, need no more scans than others.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

GRID = 64
ACCURACY = 1_000
#: Values of one range that are sorted at the end.
SMALL = 1 << 16


@dataclass
class ColumnProfile:
    """Number, mean and sample deviation of a column's values and its quantiles."""

    count: int
    mean: float | None
    deviation: float | None
    quantiles: list[float | None] = field(default_factory=list)


@dataclass
class _Search:
    """The wanted rank lies among the ``inside`` values from ``lo`` to ``hi``; ``below`` are smaller."""

    column: str
    rank: int
    lo: float
    hi: float
    below: int
    inside: int
    grid: list[float] | None
    answer: float | None = None
    scans: int = 0

    @property
    def open(self) -> bool:
        return self.answer is None

    def probes(self) -> tuple[float, float]:
        if not self.grid:
            return self.lo, self.hi
        at = Fraction(self.rank - self.below, self.inside) * (len(self.grid) - 1)
        return self.grid[max(0, math.floor(at) - 1)], self.grid[min(len(self.grid) - 1, math.ceil(at) + 1)]

    def narrow(self, a: float, b: float, seen: dict) -> None:
        """Takes in the counts of one scan with the probes ``a`` and ``b``."""
        self.scans += 1
        k = self.rank - self.below
        if k <= seen["lt_a"]:
            self.hi, self.inside, self.grid = seen["prev_a"], seen["lt_a"], None
        elif k <= seen["le_a"]:
            self.answer = a
        elif k <= seen["lt_b"]:
            self.lo, self.hi, self.grid = seen["above"], seen["under"], seen["grid"]
            self.below, self.inside = self.below + seen["le_a"], seen["lt_b"] - seen["le_a"]
        elif k <= seen["le_b"]:
            self.answer = b
        else:
            self.lo, self.grid = seen["next_b"], None
            self.below, self.inside = self.below + seen["le_b"], self.inside - seen["le_b"]
        if self.open and self.lo == self.hi:
            self.answer = self.lo


def number(name: str) -> Column:
    """A column's values as doubles; NaN is no value."""
    return F.nanvl(F.col(name).cast("double"), F.lit(None).cast("double"))


def _sketch(value: Column) -> Column:
    steps = F.array(*[F.lit(i / GRID) for i in range(GRID + 1)])
    return F.percentile_approx(value, steps, F.lit(ACCURACY))


def _counts(search: _Search) -> Column:
    a, b = search.probes()
    x, lo, hi = F.col(search.column), F.lit(search.lo), F.lit(search.hi)
    here = (x >= lo) & (x <= hi)
    where = lambda condition: F.when(here & condition, x)
    return F.struct(
        F.count(where(x < a)).alias("lt_a"), F.count(where(x <= a)).alias("le_a"),
        F.count(where(x < b)).alias("lt_b"), F.count(where(x <= b)).alias("le_b"),
        F.max(where(x < a)).alias("prev_a"), F.min(where(x > b)).alias("next_b"),
        F.min(where(x > a)).alias("above"), F.max(where(x < b)).alias("under"),
        _sketch(where((x > a) & (x < b))).alias("grid"),
    )


def _sorted_ranges(values: DataFrame, searches: list[_Search]) -> None:
    """Answers the searches whose ranges are small, from the values inside them."""
    each = F.array(*[
        F.struct(F.lit(i).alias("search"), F.when(F.col(s.column).between(s.lo, s.hi), F.col(s.column)).alias("value"))
        for i, s in enumerate(searches)
    ])
    upto = Window.partitionBy("search").orderBy("value")
    wanted = F.element_at(F.array(*[F.lit(s.rank - s.below) for s in searches]), F.col("search") + 1)
    found = (
        values.where(_any_range(searches)).select(F.inline(each)).where("value IS NOT NULL")
        .groupBy("search", "value").agg(F.count(F.lit(1)).alias("n"))
        .withColumn("upto", F.sum("n").over(upto))
        .where(F.col("upto") >= wanted).groupBy("search").agg(F.min("value").alias("value"))
    )
    for row in found.collect():  # one row a search
        searches[row["search"]].answer = row["value"]


def _any_range(searches: list[_Search]) -> Column:
    inside = F.lit(False)
    for s in searches:
        inside = inside | F.col(s.column).between(s.lo, s.hi)
    return inside


def quantiles(df: DataFrame, columns: Sequence[str], fractions: Sequence[Fraction], small: int = SMALL) -> dict[str, ColumnProfile]:
    """Per column its number of values, mean, deviation and the smallest value covering each fraction.

    Nulls and NaN are no values; a column without any has null quantiles.
    """
    values = df.select(*[number(c).alias(c) for c in columns])
    first = values.agg(*[
        F.struct(
            F.count(c).alias("n"), F.avg(c).alias("mean"), F.stddev(c).alias("deviation"),
            F.min(c).alias("lo"), F.max(c).alias("hi"), _sketch(F.col(c)).alias("grid"),
        ).alias(f"c{i}")
        for i, c in enumerate(columns)
    ]).first()
    profiles, searches = {}, []
    for i, column in enumerate(columns):
        seen = first[f"c{i}"]
        profiles[column] = ColumnProfile(seen["n"], seen["mean"], seen["deviation"])
        for fraction in fractions:
            rank = max(1, -(-seen["n"] * fraction.numerator // fraction.denominator))
            searches.append(_Search(column, rank, seen["lo"], seen["hi"], 0, seen["n"], seen["grid"], seen["lo"] if seen["lo"] == seen["hi"] else None))
    asked = [s for s in searches if profiles[s.column].count]
    while wide := [s for s in asked if s.open and s.inside > small]:
        probes = [s.probes() for s in wide]
        row = values.where(_any_range(wide)).agg(*[_counts(s).alias(f"s{i}") for i, s in enumerate(wide)]).first()
        for i, (s, (a, b)) in enumerate(zip(wide, probes)):
            s.narrow(a, b, row[f"s{i}"].asDict())
    rest = [s for s in asked if s.open]
    if rest:
        _sorted_ranges(values, rest)
    for s in searches:
        profiles[s.column].quantiles.append(s.answer)
    return profiles
