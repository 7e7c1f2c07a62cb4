from __future__ import annotations

import random
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import functions as F

from tidemark.functions.clean import row_hash, row_hash_strict
from tidemark.functions.exact import amount, half_up_ratio, mean, money, percent


def test_ratio_rounds_half_up_exactly(spark):
    rng = random.Random(1)
    pairs = [(rng.randint(-10**12, 10**12), rng.randint(1, 10**6)) for _ in range(500)]
    pairs += [(1, 8), (-1, 8), (5, 1000), (15, 1000), (-5, 1000), (0, 7), (1005, 1000)]
    rows = spark.createDataFrame(pairs, "n bigint, d bigint").select(
        "n", "d", half_up_ratio(F.col("n"), F.col("d"), 2).alias("q")
    )
    for n, d, q in rows.collect():
        exact = Decimal(abs(n)) / Decimal(d)
        want = exact.quantize(Decimal("0.01"), ROUND_HALF_UP) * (-1 if n < 0 else 1)
        assert q == want, (n, d)


def test_ratio_of_nothing_is_null(spark):
    row = spark.range(1).select(
        half_up_ratio(F.lit(5), F.lit(0), 2).alias("zero"),
        mean(F.lit(None).cast("bigint"), F.lit(3), 1).alias("missing"),
        percent(F.lit(1), F.lit(3), 2).alias("third"),
        half_up_ratio(F.lit(5), F.lit(-2), 0).alias("negative"),
    ).first()
    assert (row["zero"], row["missing"], row["third"], row["negative"]) == (None, None, Decimal("33.33"), -3)


def test_money_sum_does_not_depend_on_order(spark):
    values = [0.1, 0.2, 0.3, 1e9 + 0.01, 1e-4, 33.335, -0.07] * 1000
    df = spark.createDataFrame([(v,) for v in values], "v double")
    exact = sum(Decimal(str(v)) for v in values)
    for parts in (1, 7):
        got = df.repartition(parts).agg(amount(F.sum(money("v")), 4).alias("s")).first()["s"]
        assert got == exact


def test_money_sum_does_not_overflow(spark):
    total = spark.range(200_000).select(F.lit(9.0e13).alias("v")).agg(F.sum(money("v")).alias("s")).first()["s"]
    assert total == Decimal("9e23") * 200_000


def test_row_hash_collisions_and_strict_variant(spark):
    df = spark.createDataFrame([("NULL", "a|b"), (None, "a|b"), ("a", "b|c"), ("a|b", "c")], "x string, y string")
    loose = [r[0] for r in df.select(row_hash(["x", "y"])).collect()]
    strict = [r[0] for r in df.select(row_hash_strict(["x", "y"])).collect()]
    assert loose[0] == loose[1] and loose[2] == loose[3]
    assert len(set(strict)) == 4
