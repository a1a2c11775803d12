"""Table rules as Spark jobs: each returns the violations, none stops a job."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F, types as T


def check_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that repeat or have a NULL part, with ``row_count``."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count"))
    no_key = reduce(or_, [F.col(k).isNull() for k in keys])
    return counts.where((F.col("row_count") > 1) | no_key)


def check_dense(df: DataFrame, key: str) -> DataFrame:
    """What keeps the whole-number ``key`` from being 1..N over N rows: (``bound``, ``balance``), empty if it is.

    Rows that a scan reads one after the other with keys one apart make a run: key minus row number is the same for all of
    them, and since row numbers differ, so do the keys of a run. A run of keys ``low`` to ``high`` with as many rows is an
    interval from ``low`` to ``high + 1``. Intervals tile 1 to N + 1 without gap or overlap if each bound
    but these two begins as many intervals as it ends: an interval leads upwards, so no others can balance out.

    Where files are sorted by the key there are about as many runs as files, and only runs are shuffled. If some run has
    gaps, as on unsorted files, each row counts as an interval instead. A NULL key gives a row with NULL bound.
    """
    value, wide = F.col(key).cast("bigint"), "decimal(38,0)"
    keys = df.select(value.alias("low"))
    runs = (
        df.select(value.alias("key"), F.try_subtract(value, F.monotonically_increasing_id()).alias("run"))
        .groupBy("run")
        .agg(F.min("key").alias("low"), F.max("key").alias("high"), F.count(F.lit(1)).alias("rows"))
    )
    length = F.col("high").cast(wide) - F.col("low").cast(wide) + 1
    whole = F.col("run").isNotNull() & (length == F.col("rows"))
    totals = runs.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("n"), F.coalesce(F.bool_and(whole), F.lit(True)).alias("plain"))
    plain = totals.select("plain").scalar()

    def bounds(low: Column, end: Column) -> Column:
        """+1 where intervals begin, -1 where they end."""
        return F.explode(F.array(*[F.struct(at.cast(wide).alias("bound"), F.lit(n).alias("balance")) for at, n in ((low, 1), (end, -1))])).alias("b")

    low, high = (F.col(c).cast(wide) for c in ("low", "high"))
    parts = [
        runs.where(plain).select(bounds(low, high + 1)),
        keys.where(~plain).select(bounds(low, low + 1)),
        totals.where("n > 0").select(bounds(F.col("n") + 1, F.lit(1))),  # what the whole has to cancel
    ]
    balance = reduce(DataFrame.unionByName, parts).select("b.*").groupBy("bound").agg(F.sum("balance").alias("balance"))
    return balance.where((F.col("balance") != 0) | F.col("bound").isNull())


def check_foreign_key(df: DataFrame, key: str, dim: DataFrame) -> DataFrame:
    """Non-null keys the dimension lacks, with ``row_count``.

    Rows are counted per key before the join, so the join moves one row per key
    and no frequent key is heavier than another.
    """
    counts = df.dropna(subset=[key]).groupBy(key).agg(F.count(F.lit(1)).alias("row_count"))
    return counts.join(dim.select(key), key, "left_anti")


def check_numeric_fit(df: DataFrame, column: str, kind: T.DecimalType) -> DataFrame:
    """Rows whose number does not fit ``kind`` after rounding."""
    value = F.col(column)
    return df.where(value.isNotNull() & value.try_cast(kind).isNull())


def check_nulls(df: DataFrame, schema: T.StructType) -> DataFrame:
    """One row per not-null column of the contract: ``column_name``, ``null_count``.

    All columns are counted in one pass over the rows.
    """
    names = [f.name for f in schema.fields if not f.nullable]
    nulls = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in names])
    return nulls.unpivot([], names, "column_name", "null_count")


def reconcile(raw: DataFrame, fact: DataFrame) -> DataFrame:
    """One row: ``raw_rows``, ``fact_rows`` and their ``difference``."""
    counted = raw.agg(F.count(F.lit(1)).alias("raw_rows"))
    facts = fact.agg(F.count(F.lit(1)).alias("fact_rows"))
    both = counted.select("raw_rows", facts.scalar().alias("fact_rows"))
    return both.withColumn("difference", F.col("raw_rows") - F.col("fact_rows"))
