import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F, types as T

from starmart.contracts import contract
from starmart.operators.quality import (
    check_dense,
    check_foreign_key,
    check_nulls,
    check_numeric_fit,
    check_unique,
    reconcile,
)


def _set(df):
    return {tuple(r) for r in df.collect()}


def test_unique(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (None, "c")], "k int, l string")
    assert _set(check_unique(df, ["k", "l"])) == {(1, "a", 2), (None, "c", 1)}


def test_foreign_key(spark):
    fact = spark.createDataFrame([(1,), (2,), (2,), (None,)], "k int")
    dim = spark.createDataFrame([(1, "x")], "k int, v string")
    assert _set(check_foreign_key(fact, "k", dim)) == {(2, 2)}


def test_numeric_fit(spark):
    df = spark.createDataFrame([(1, 99.994), (2, 99.995), (3, None), (4, -100.0)], "id int, v double")
    assert {r.id for r in check_numeric_fit(df, "v", T.DecimalType(4, 2)).collect()} == {2, 4}
    money = spark.createDataFrame([(Decimal("100.00"),)], "v decimal(14,2)")
    assert check_numeric_fit(money, "v", T.DecimalType(4, 2)).count() == 1


def test_nulls(spark):
    df = spark.createDataFrame([(1, None, None), (None, 2, None)], "a long, b long, c long")
    assert _set(check_nulls(df, contract("long: a! b! c"))) == {("a", 1), ("b", 1)}


def test_reconcile(spark):
    assert reconcile(spark.range(5), spark.range(3)).first()[:] == (5, 3, 2)


def _dense(spark, keys, parts=1):
    rows = spark.createDataFrame([(k,) for k in keys], "k long").coalesce(parts)
    return {tuple(r) for r in check_dense(rows, "k").collect()}


def test_dense_keys_pass_in_any_order(spark):
    assert _dense(spark, []) == set()
    assert _dense(spark, [1]) == set()
    assert _dense(spark, range(1, 5001), parts=7) == set()
    shuffled = list(range(1, 301))
    random.Random(3).shuffle(shuffled)
    assert _dense(spark, shuffled, parts=4) == set()


@pytest.mark.parametrize(
    "keys",
    [
        [1, 1, 4, 4, 6, 6, 7, 7, 9],  # count, ends, sum and sum of squares of 1 to 9
        [2],
        [0, 1, 2],
        [1, 2, 4],
        [1, 2, 2],
        [1, 3, 3, 2],
        [1, 2, 3, 4, 2, 3],
        [1, None],
        [None, None],
        [1, 2, 3, -5],
        [-(2**63), 2**63 - 1],
        [1, 2, 3, 5, 6, 7, 5, 6, 7, 8],
    ],
)
def test_other_keys_do_not(spark, keys):
    for parts in (1, 3):
        assert _dense(spark, keys, parts)


def test_any_multiset_of_small_keys_is_judged_rightly(spark):
    rnd = random.Random(9)
    for _ in range(25):
        keys = sorted(rnd.randint(0, 6) for _ in range(rnd.randint(1, 6)))
        rnd.random() < 0.5 and rnd.shuffle(keys)
        assert (not _dense(spark, keys, 2)) == (sorted(keys) == list(range(1, len(keys) + 1)))


def test_a_sorted_table_shuffles_a_row_per_run(spark, tmp_path):
    spark.range(1, 40_001, numPartitions=8).withColumnRenamed("id", "k").write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    runs = table.select(F.try_subtract("k", F.monotonically_increasing_id()).alias("run")).distinct().count()
    assert runs <= 16 and check_dense(table, "k").isEmpty()
