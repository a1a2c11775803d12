import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F, types as T

from starmart.contracts import contract, project_to, subset
from starmart.functions.cleaning import find_rejects, normalize_strings, parse_typed, tolerant_cast


def test_normalize_trims_spaces_only_and_blanks_become_null(spark):
    df = spark.createDataFrame([(" a ", 1), ("", 2), ("   ", 3), ("\ta\t", 4), (None, 5)], "t string, n int")
    assert [tuple(r) for r in normalize_strings(df).orderBy("n").collect()] == [
        ("a", 1),
        (None, 2),
        (None, 3),
        ("\ta\t", 4),
        (None, 5),
    ]


@pytest.mark.parametrize(
    ("text", "kind", "expected"),
    [
        ("3.7", T.IntegerType(), 3),
        ("-3.7", T.IntegerType(), -3),
        ("3000000000", T.IntegerType(), None),
        ("3000000000", T.LongType(), 3000000000),
        ("9" * 25, T.LongType(), None),
        ("x", T.LongType(), None),
        ("2.675", T.DecimalType(14, 2), Decimal("2.68")),
        ("1.005", T.DecimalType(14, 2), Decimal("1.01")),
        ("-1.005", T.DecimalType(14, 2), Decimal("-1.01")),
        ("NaN", T.DecimalType(14, 2), None),
        ("100.00", T.DecimalType(4, 2), None),
        ("99.994", T.DecimalType(4, 2), Decimal("99.99")),
        ("1/5/2021", T.DateType(), datetime.date(2021, 1, 5)),
        ("01/05/2021", T.DateType(), datetime.date(2021, 1, 5)),
        ("1/5/21", T.DateType(), None),
        ("2021-01-05", T.DateType(), None),
        ("13/45/2021", T.DateType(), None),
        ("as is", T.StringType(), "as is"),
    ],
)
def test_tolerant_cast(spark, text, kind, expected):
    df = spark.createDataFrame([(text,), (None,)], "t string")
    typed = {r[0] for r in df.select(tolerant_cast(F.col("t"), kind)).collect()}
    assert typed == {expected, None}


def test_tolerant_cast_refuses_other_types(spark):
    with pytest.raises(TypeError):
        tolerant_cast(F.col("t"), T.BooleanType())


def test_rejects_hold_each_lost_value_once(spark):
    schema = contract("long: id\nmoney: price\ndate: day\ntext: note")
    df = spark.createDataFrame(
        [("1", "x", "1/1/2020", "n"), ("2", "1.5", "nope", None), ("y", "z", None, ""), ("4", None, None, None)],
        "id string, price string, day string, note string",
    )
    lost = {tuple(r) for r in find_rejects(df, schema, ["id"]).collect()}
    assert lost == {("1", "price", "x"), ("2", "day", "nope"), ("y", "id", "y"), ("y", "price", "z")}
    assert parse_typed(df, schema).where("price = 1.5").count() == 1


def test_project_to_names_missing_columns(spark):
    schema = contract("long: a b!\ntext: c")
    assert [f.nullable for f in schema.fields] == [True, False, True]
    assert subset(schema, ["c", "a"]).names == ["a", "c"]
    with pytest.raises(ValueError, match="b, c"):
        project_to(spark.range(1).select(F.col("id").alias("a")), schema)
