"""Quantiles by selection and bounded top-n values against sorted lists."""

from __future__ import annotations

import random
from fractions import Fraction

import pytest

from tidemark.config import StrictPolicy
from tidemark.operators import anomalies, selection
from tidemark.operators.furthest import Limits, unusual

FRACTIONS = (Fraction(0), Fraction(1, 100), Fraction(1, 4), Fraction(1, 2), Fraction(3, 4), Fraction(999, 1000), Fraction(1))
rng = random.Random(11)
SHAPES = {
    "normal": [rng.gauss(0, 1) for _ in range(5000)],
    "narrow": [1e9 + rng.random() * 1e-5 for _ in range(5000)] + [-1e300, 1e300],
    "two values": [1.0] * 2500 + [2.0] * 2500,
    "few values": [float(rng.choice([0, 0, 0, 0, 1, 5])) for _ in range(4000)],
    "constant": [7.5] * 3000,
    "skewed": [10.0 ** rng.uniform(-300, 300) for _ in range(4000)],
    "signed": [rng.choice([-1, 1]) * 2.0 ** rng.randrange(900) for _ in range(3000)],
    "infinite": [float("inf")] * 50 + [float("-inf")] * 50 + [rng.random() for _ in range(900)],
    "one": [3.0],
}


def covering(values, fraction):
    ordered = sorted(values)
    return ordered[max(1, -(-len(ordered) * fraction.numerator // fraction.denominator)) - 1]


@pytest.mark.parametrize("shape", SHAPES)
@pytest.mark.parametrize("small", [0, 20])
def test_selection_equals_sorting(spark, shape, small):
    values = SHAPES[shape]
    df = spark.createDataFrame([(v, None if i % 3 else v) for i, v in enumerate([*values, None, float("nan")])], "a double, b double").repartition(5)
    found = selection.quantiles(df, ["a", "b"], FRACTIONS, small)
    for name, kept in (("a", values), ("b", values[::3])):
        assert found[name].count == len(kept)
        assert found[name].quantiles == [covering(kept, f) for f in FRACTIONS], (shape, name)


def test_columns_without_values(spark):
    df = spark.createDataFrame([(None, 1.0), (float("nan"), 2.0)], "a double, b double")
    found = selection.quantiles(df, ["a", "b"], [Fraction(1, 2)])
    assert found["a"].count == 0 and found["a"].quantiles == [None] and found["b"].quantiles == [1.0]


def test_ranges_shrink_fast(spark, monkeypatch):
    """A million values in one narrow range: a handful of scans, as the probes follow the values."""
    scans = []
    narrow = selection._Search.narrow
    monkeypatch.setattr(selection._Search, "narrow", lambda self, *a: (scans.append(self.inside), narrow(self, *a))[1])
    df = spark.range(1_000_000).selectExpr("1e9 + pmod(hash(id), 1000003) * 1e-6 AS v")
    found = selection.quantiles(df, ["v"], [Fraction(1, 4)], 1000)
    assert found["v"].quantiles[0] == covering([r[0] for r in df.collect()], Fraction(1, 4))
    assert len(scans) <= 4 and scans[1] < scans[0] / 10


def test_no_value_is_shuffled(spark):
    """Between scans only counts and sketches move: one row a task."""
    df = spark.range(200_000).selectExpr("cast(id AS double) AS v").repartition(4)
    search = selection._Search("v", 5, 0.0, 199_999.0, 0, 200_000, None)
    plan = df.agg(selection._counts(search).alias("s"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange SinglePartition") == 1 and "hashpartitioning" not in plan and "partial_" in plan


def test_furthest_values(spark):
    values = [float(v) for v in range(-50, 51)] + [400.0, 400.0, -300.0, 250.0, 0.0, float("nan"), None]
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(6)
    rows = {r["test"]: r for r in unusual(df, {"v": Limits(0.0, 50.0, 3.0, -100.0, 100.0)}, 3).collect()}
    assert (rows["z_outliers"]["n"], rows["z_outliers"]["top"]) == (4, [400.0, 400.0, -300.0])
    assert (rows["iqr_outliers"]["n"], rows["iqr_outliers"]["top"]) == (4, [400.0, 400.0, -300.0])
    assert rows["zero_values"]["n"] == 2 and rows["negative_values"]["n"] == 51


def test_profiles_show_the_furthest_values(spark):
    values = [10.0 + (i % 7) for i in range(1000)] + [900.0, 800.0, 700.0, -600.0, 650.0, 500.0]
    df = spark.createDataFrame([(v, None) for v in values], "v double, w double")
    rows = {r["column_name"]: r for r in anomalies.value_profiles({"t": (df, ["v", "w"])}, StrictPolicy()).collect()}
    assert rows["v"]["iqr_outliers_top"] == [900.0, 800.0, 700.0, 650.0, -600.0] and rows["v"]["iqr_outliers"] == 6
    assert rows["w"]["value_count"] == 0 and rows["w"]["z_outliers"] == 0
