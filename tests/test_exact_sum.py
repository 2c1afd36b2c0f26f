"""Sums of doubles with the same bits in any order."""

import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from ledgerlake.functions import money
from ledgerlake.functions.exact_sum import digits, exact_sum, fits, weight


def amounts(seed, n=400):
    r = random.Random(seed)
    own = [r.choice([-1, 1]) * r.random() * 10 ** r.randint(-12, 20) for _ in range(n)]
    return own + [0.0, -0.0, 0.1, 0.2, -0.3, 2.0 ** 71, -(2.0 ** 71), 4.7e21, 1e-30, 5e-324, None, 123.455, 1 / 3]


def test_digits_make_up_the_amount(spark):
    own = [x for x in amounts(1) if x is not None]
    df = spark.createDataFrame([(x,) for x in own], "x double")
    for x, row in zip(own, df.select(*digits(F.col("x"))).collect(), strict=True):
        exact = sum(Fraction(weight(k)) * d for k, d in enumerate(row))
        assert abs(exact - Fraction(x)) < Fraction(weight(0)) and all(abs(d) < 1 << 22 for d in row)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_any_order_gives_the_same_bits_and_the_exact_sum(spark, seed):
    own = amounts(seed)
    seen = set()
    for i in range(6):
        random.Random(i).shuffle(own)
        df = spark.createDataFrame([(x, j % 3) for j, x in enumerate(own)], "x double, k int").repartition(1 + 3 * i)
        seen.add(df.agg(exact_sum(F.col("x"))).first()[0].hex())
    assert len(seen) == 1
    want = math.fsum(x for x in own if x is not None)
    assert abs(float.fromhex(seen.pop()) - want) <= math.ulp(want)


def test_signs_and_cancelling(spark):
    def total(own):
        return spark.createDataFrame([(x,) for x in own], "x double").agg(exact_sum(F.col("x"))).first()[0]
    assert total([1e16, 1.0, -1e16]) == 1.0
    assert total([-0.1] * 10) == -1.0 and total([0.1] * 10) == 1.0
    assert total([1e20, -1e20, 2.0 ** -100]) == 2.0 ** -100
    assert total([-1e20, 1e-20]) == -1e20
    assert total([None, None]) is None


def test_what_has_no_digits(spark):
    df = spark.createDataFrame([(1, 1.0), (1, float("nan")), (2, 1.0), (2, float("inf")), (3, 1e22), (3, 0.005), (4, None), (5, 2.5)],
                               "k int, x double")
    assert [r[0] for r in df.orderBy("k").select(fits(F.col("x"))).where("k <> 4").collect()].count(False) == 3
    for mode in ("decimal", "exact", "double"):
        got = {r[0]: r[1:] for r in df.groupBy("k").agg(money.total("x", mode), money.average("x", mode)).collect()}
        assert math.isnan(got[1][0]) and math.isnan(got[1][1]) and got[2] == (math.inf, math.inf)
        assert got[3] == (1e22, 5e21) and got[4] == (None, None) and got[5] == (2.5, 2.5)


@pytest.mark.parametrize("mode", ["decimal", "exact"])
def test_money_of_any_amount_does_not_depend_on_the_layout(spark, mode):
    r = random.Random(7)
    rows = [(i % 4, r.choice([0.1, 10.05, 1 / 3, 1e17, -1e17, 0.005, 1234.565]) * r.randint(1, 99)) for i in range(2000)]
    seen = set()
    for n in (1, 3, 8):
        random.Random(n).shuffle(rows)
        df = spark.createDataFrame(rows, "k int, amount double").repartition(n)
        got = df.groupBy("k").agg(money.total(mode=mode).alias("t"), money.average(mode=mode).alias("a")).orderBy("k").collect()
        seen.add(tuple((x["t"].hex(), x["a"].hex()) for x in got))
    assert len(seen) == 1


def test_one_exchange_and_hash_aggregates(spark):
    df = spark.range(10).selectExpr("id % 2 as k", "id / 7 as amount")
    plan = df.groupBy("k").agg(money.total(), money.average())._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "ObjectHashAggregate" not in plan and "SortAggregate" not in plan


def test_an_unknown_mode_is_refused(spark):
    with pytest.raises(ValueError):
        money.total(mode="cents")
