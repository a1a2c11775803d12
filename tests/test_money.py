import random
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import functions as F

from starmart.functions.money import half_up_ratio, money_avg, money_sum

CENT = Decimal("0.01")


def _groups(spark, rows):
    df = spark.createDataFrame(rows, "k int, v decimal(14,2)")
    result = df.groupBy("k").agg(money_sum(F.col("v")).alias("s"), money_avg(F.col("v")).alias("a"))
    return {r.k: (r.s, r.a) for r in result.collect()}


def test_sums_and_averages_match_exact_arithmetic(spark):
    draw = random.Random(7)
    rows = []
    for k in range(200):
        for _ in range(draw.randint(1, 12)):
            sign = draw.choice([1, 1, -1]) if k % 3 == 0 else 1
            rows.append((k, sign * Decimal(draw.randint(0, 10 ** draw.randint(1, 14) - 1)) * CENT))
    found = _groups(spark, rows)
    for k in range(200):
        values = [v for key, v in rows if key == k]
        total = sum(values)
        average = (total / len(values)).quantize(CENT, ROUND_HALF_UP)
        assert found[k] == (total, float(average)), k


def test_nulls_are_ignored_and_empty_groups_are_null(spark):
    found = _groups(spark, [(1, None), (1, Decimal("1.00")), (1, Decimal("0.01")), (2, None)])
    assert found == {1: (Decimal("1.01"), 0.51), 2: (None, None)}


def test_doubles_are_rounded_before_they_are_added(spark):
    df = spark.createDataFrame([(1.005,), (0.285,)], "v double")
    assert df.agg(money_sum(F.col("v"))).first()[0] == Decimal("1.30")


def test_ratio_needs_a_positive_count(spark):
    df = spark.createDataFrame(
        [(Decimal("10.00"), 3), (Decimal("1.00"), 0), (Decimal("1.00"), -2), (Decimal("1.00"), None)],
        "t decimal(14,2), n bigint",
    )
    found = [r[0] for r in df.select(half_up_ratio(F.col("t"), F.col("n"))).collect()]
    assert found == [3.33, None, None, None]


def test_a_near_tie_is_not_rounded_twice(spark):
    # 0.00499999999999995 lies just under a tie
    total, count = Decimal("4999999999.99"), 10**12 - 1
    df = spark.createDataFrame([(total, count)], "t decimal(14,2), n bigint")
    exact = float((total / count).quantize(CENT, ROUND_HALF_UP))
    assert df.select(half_up_ratio(F.col("t"), F.col("n"))).first()[0] == exact
