"""Dimension builders.

Each takes the typed sales records and returns one row per key. All shuffle only
rows that were merged before the shuffle, so a key that holds a large part of
the sales costs no more than any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from starmart.operators.keys import assign_dense_key, blank_nulls, composite_key
from starmart.sources.staging import Staging

# Number of sales per member; used to find frequent members, not stored.
MEMBER_ROWS = "member_rows"


def natural_key_dim(
    df: DataFrame, source_key: str, key: str, attributes: Sequence[str], survivor_order: Sequence[str]
) -> DataFrame:
    """One row per non-null ``source_key``; the key appears under both names.

    Sales of one key may disagree about its attributes. The survivor is the row
    that is smallest by ``survivor_order`` and then by the attributes, NULLs first.
    """
    ranking = F.struct(*survivor_order, *attributes)
    return (
        df.dropna(subset=[source_key])
        .groupBy(source_key)
        .agg(F.min(ranking).alias("survivor"))
        .select(F.col(source_key).alias(key), source_key, *[f"survivor.{c}" for c in attributes])
    )


def composite_key_dim(
    df: DataFrame, key: str, natural_key: Sequence[str], attributes: Sequence[str], staging: Staging
) -> DataFrame:
    """One row per combination of ``natural_key``, numbered by the joined text.

    NULL parts count as empty text. Grouping uses the parts and not the joined
    text, so parts that contain the separator stay apart. The survivor is the
    smallest row of attributes, NULLs first. A hash leads the grouping, because
    the aggregate sorts by its keys and numbers sort faster than texts.
    """
    parts = [f"_part{i}" for i in range(len(natural_key))]
    split = [part.alias(name) for part, name in zip(blank_nulls(natural_key), parts)]
    members = (
        df.groupBy(F.xxhash64(*blank_nulls(natural_key)).alias("_hash"), *split)
        .agg(F.min(F.struct(*attributes)).alias("survivor"), F.count(F.lit(1)).alias(MEMBER_ROWS))
        .select(composite_key(parts).alias("_joined"), *parts, "survivor.*", MEMBER_ROWS)
    )
    numbered = assign_dense_key(members, ["_joined", *parts], key, staging)
    return numbered.select(key, *attributes, MEMBER_ROWS)


def distinct_row_dim(df: DataFrame, key: str, columns: Sequence[str], staging: Staging) -> DataFrame:
    """One row per distinct combination of ``columns``, numbered in their order, NULLs first."""
    members = df.groupBy(*columns).agg(F.count(F.lit(1)).alias(MEMBER_ROWS))
    return assign_dense_key(members, columns, key, staging).select(key, *columns, MEMBER_ROWS)


def date_key(day: Column) -> Column:
    """The ``yyyyMMdd`` number of a date."""
    return F.date_format(day, "yyyyMMdd").cast("int")


def date_dim(df: DataFrame, date_column: str) -> DataFrame:
    """One row per date that occurs, with its calendar attributes."""
    day = F.col("full_date")
    return (
        df.select(F.col(date_column).alias("full_date"))
        .dropna()
        .distinct()
        .select(
            date_key(day).alias("date_key"),
            day,
            F.dayofmonth(day).alias("day_num"),
            F.month(day).alias("month_num"),
            F.date_format(day, "MMMM").alias("month_name"),
            F.quarter(day).alias("quarter_num"),
            F.year(day).alias("year_num"),
        )
    )
