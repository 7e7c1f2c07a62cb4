from __future__ import annotations

import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.functions.exact import money
from tidemark.operators import ordering
from tidemark.operators.ordering import at_fraction, rank_by_total, value_counts, value_positions


def values(seed):
    rng = random.Random(seed)
    drawn = [rng.choice([rng.gauss(0, 10), rng.lognormvariate(5, 4), float(rng.randrange(5)), None]) for _ in range(3000)]
    return drawn + [0.0, -0.0, 1e17, -1e17, 1e-9, -1e-9] + [7.5] * 1500


@pytest.mark.parametrize("low, high", [(0, 0.01), (1000, 1001)])
def test_values_in_a_narrow_range_are_split(spark, monkeypatch, low, high):
    kept = []

    def keep(df, label):
        kept.append(label)
        return stage(df, label)

    stage = ordering.stage
    monkeypatch.setattr(ordering, "stage", keep)
    df = spark.range(20_000).select((F.lit(float(low)) + F.col("id") * (high - low) / 20_000).alias("v"))
    out = value_positions(value_counts(df, "v"), "v")
    assert kept == ["ranges"]
    ranges = [r["n"] for r in spark.read.parquet(*out.inputFiles()).groupBy("bucket").agg(F.count("*").alias("n")).collect()]
    assert len(ranges) > 1 and max(ranges) < 2 * 20_000 / len(ranges)
    assert out.agg(F.countDistinct("before")).first()[0] == 20_000


@pytest.mark.parametrize("descending", [False, True])
def test_positions_count_the_rows_before(spark, descending):
    drawn = values(2)
    df = spark.createDataFrame([(v,) for v in drawn], "v double")
    known = sorted((v for v in drawn if v is not None), reverse=descending)
    out = value_positions(value_counts(df, "v"), "v", descending=descending).collect()
    assert sum(r["n"] for r in out) == len(known)
    for r in out:
        assert known.index(r["v"]) == r["before"] and r["total"] == len(known)


@pytest.mark.parametrize("fraction", [Fraction(1, 4), Fraction(1, 2), Fraction(3, 4), Fraction(1, 1000)])
def test_quantiles_are_exact(spark, fraction):
    drawn = values(3)
    df = spark.createDataFrame([(v,) for v in drawn], "v double")
    known = sorted(v for v in drawn if v is not None)
    got = value_positions(value_counts(df, "v"), "v").agg(at_fraction(fraction, "v").alias("q")).first()["q"]
    assert got == known[math.ceil(fraction * len(known)) - 1]


def test_rank_equals_a_single_window(spark):
    rng = random.Random(4)
    rows = [(i, rng.choice([None, rng.randrange(-300, 300), 5, 5])) for i in range(2000)]
    df = spark.createDataFrame(rows, "i int, t int").select("i", F.col("t").cast("decimal(22,2)").alias("t"))
    ranked = {r["i"]: r["r"] for r in rank_by_total(df, "t", "r").collect()}
    want = df.withColumn("w", F.rank().over(Window.orderBy(F.desc("t"))))
    assert ranked == {r["i"]: r["w"] for r in want.collect()}


def test_rank_of_nothing(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "i int, t decimal(22,2)")
    assert {r["r"] for r in rank_by_total(df, "t", "r").collect()} == {1}
    assert rank_by_total(df.limit(0), "t", "r").count() == 0


def test_money_keeps_a_run_alive(spark):
    df = spark.createDataFrame([(1.005,), (2e15,), (float("nan"),), (1e300,), (None,)], "v double")
    got = [r[0] for r in df.select(money("v")).collect()]
    assert got == [10_050_000_000, 2 * 10**25, None, None, None]
