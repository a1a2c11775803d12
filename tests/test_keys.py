import random

import pytest
from pyspark.sql import Window, functions as F

from starmart.operators.dimensions import MEMBER_ROWS
from starmart.operators.keys import (
    assign_dense_key,
    composite_key,
    frequent_members,
    frequent_rows,
    lookup,
    with_spread,
)


def _rows(n, seed=3):
    draw = random.Random(seed)
    letters = [None, "", "a", "b", "ab", "B", "ä"]
    return [(draw.choice([None, 1, 2, 3]), draw.choice(letters), i) for i in range(n)]


@pytest.mark.parametrize("partitions", [1, 3, 16])
def test_dense_key_equals_one_global_numbering(spark, staging, partitions):
    df = spark.createDataFrame(_rows(2000), "a int, b string, c int").repartition(partitions)
    order = ["a", "b", "c"]
    found = assign_dense_key(df, order, "key", staging)
    plain = F.row_number().over(Window.orderBy(*[F.col(c).asc_nulls_first() for c in order]))
    expected = df.withColumn("key", plain.cast("bigint")).select("key", *order)
    assert found.columns == expected.columns
    assert found.exceptAll(expected).isEmpty() and expected.exceptAll(found).isEmpty()


def test_dense_key_of_nothing(spark, staging):
    df = spark.createDataFrame([], "a int")
    assert assign_dense_key(df, ["a"], "key", staging).count() == 0


def test_equal_rows_do_not_pile_up_in_one_range(no_broadcast, staging):
    """A third of the rows are copies of one row."""
    spark = no_broadcast
    copies = spark.range(20_000).select(F.lit(5).cast("bigint").alias("a"))
    df = copies.unionAll(spark.range(40_000).select(F.col("id").alias("a"))).repartition(16)
    found = assign_dense_key(df, ["a"], "key", staging)
    assert found.agg(F.min("key"), F.max("key"), F.count_distinct("key")).first()[:] == (1, 60_000, 60_000)
    assert found.where("a = 5").agg(F.max("key") - F.min("key")).first()[0] == 20_000
    files = spark.read.parquet(f"{staging.root}/key-*").where("_slot is not null")
    per_range = files.groupBy(F.shiftright("_slot", 33)).count().agg(F.max("count")).first()[0]
    assert per_range < 20_000


def test_frequent_members_are_few_and_exact(spark):
    counted = spark.createDataFrame([("a", 700), ("b", 199), ("c", 100), ("d", 1)], "k string, n int")
    found = {r.k for r in frequent_members(counted, "n", share=10).collect()}
    assert found == {"a", "b", "c"}


def _expected(left, table, null_safe):
    answers = []
    for key in left:
        if not null_safe and None in key:
            answers.append((*key, None, None))
        else:
            answers.append((*key, *table.get(key, (None, None))))
    return sorted(answers, key=repr)


@pytest.mark.parametrize("null_safe", [False, True])
@pytest.mark.parametrize("known", ["none", "members", "rows"])
def test_lookup_equals_a_dictionary(no_broadcast, null_safe, known):
    spark = no_broadcast
    draw = random.Random(5)
    values = [None, "a", "b", "c", "d"]
    left = [(draw.choice(values), draw.choice([None, 1, 2])) for _ in range(900)] + [("hot", 1)] * 450
    table = {(x, y): (f"{x}{y}", None if y == 2 else 7) for x in values for y in (None, 1) if x != "d"}
    table[("hot", 1)] = (None, 9)
    counts = {key: left.count(key) for key in table}
    left_df = spark.createDataFrame(left, "x string, y int").repartition(8)
    right = spark.createDataFrame(
        [(*k, *v, counts[k]) for k, v in table.items()], f"x string, y int, p string, q int, {MEMBER_ROWS} int"
    )
    frequent = {
        "none": None,
        "members": frequent_members(right, MEMBER_ROWS, share=5),
        "rows": frequent_rows(left_df, right, ["x", "y"], share=5),
    }[known]
    found = lookup(left_df, right, ["x", "y"], ["p", "q"], null_safe, frequent)
    assert found.columns == ["x", "y", "p", "q"]
    assert sorted([tuple(r) for r in found.collect()], key=repr) == _expected(left, table, null_safe)


def test_frequent_and_null_keys_spread_over_the_shuffle(no_broadcast):
    """Two thirds of the rows have one key or none; no task gets a big part of them."""
    spark = no_broadcast
    n = 24_000
    left = spark.range(0, n, 1, 24).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot"))
        .when(F.col("id") % 3 == 1, F.lit(None))
        .otherwise(F.col("id").cast("string"))
        .alias("k")
    )
    right = left.dropna().groupBy("k").agg(F.count("*").alias("n"), F.min("k").alias("v"))
    found = lookup(left, right, ["k"], ["v"], frequent=frequent_members(right, "n"))
    assert found.where("k <=> v").count() == n
    assert _largest_partition(found) < n / 4
    assert _largest_partition(left.join(right, "k", "left")) >= n / 3


def test_copies_from_one_partition_spread_too(no_broadcast, staging):
    spark = no_broadcast
    n = 12_000
    copies = spark.range(0, n, 1, 1).select(F.lit("hot").alias("k"))
    left = staging.keep(with_spread(copies), "copies")
    right = spark.createDataFrame([("hot", n, "hot"), ("cold", 1, "cold")], "k string, n int, v string")
    found = lookup(left, right, ["k"], ["v"], frequent=frequent_members(right, "n"))
    assert found.where("v = 'hot'").count() == n
    assert _largest_partition(found) < n / 4
    assert _largest_partition(lookup(left, right, ["k"], ["v"])) == n


def _largest_partition(df):
    sizes = df.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("rows"), F.max("v"))
    return max(r.rows for r in sizes.collect())


def test_composite_key_reads_null_as_empty(spark):
    df = spark.createDataFrame([("a", None, "c")], "x string, y string, z string")
    assert df.select(composite_key(["x", "y", "z"])).first()[0] == "a||||c"
