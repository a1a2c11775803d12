"""Key operators: dense surrogate keys and skew-proof key lookups."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from starmart.sources.staging import Staging

KEY_SEPARATOR = "||"  # fixed value: joins the parts of a composite natural key

# A key is frequent when it holds at least 1/FREQUENT of all rows. There can
# be no more than FREQUENT such keys, so a table of them is always small
# enough to broadcast, however large the data is.
FREQUENT = 1000
BUCKETS = 16  # buckets that keys are counted in, for each key that may be frequent

# monotonically_increasing_id: partition number above, row position below.
_POSITION_BITS = 33

# Column of numbers that scatter equal rows, see with_spread.
SPREAD = "_spread"
_SPREAD_BITS = 20


def with_spread(df: DataFrame) -> DataFrame:
    """Add numbers by which even equal rows can be scattered over a shuffle.

    The numbers are hashes of partition and position, so many small partitions spread as well
    as a few large ones. They depend on row positions, so the result has to be stored before a
    shuffle uses them: read back, a row has the same number on every attempt.
    """
    number = F.xxhash64(F.monotonically_increasing_id()).bitwiseAND(F.lit((1 << _SPREAD_BITS) - 1))
    return df.withColumn(SPREAD, number.cast("int"))


def blank_nulls(columns: Sequence[str]) -> list[Column]:
    """The columns with NULL read as empty text."""
    return [F.coalesce(F.col(c), F.lit("")).alias(c) for c in columns]


def composite_key(columns: Sequence[str]) -> Column:
    """One text made of several columns, NULL counting as empty text."""
    return F.concat_ws(KEY_SEPARATOR, *blank_nulls(columns))


def assign_dense_key(df: DataFrame, order: Sequence[str], out: str, staging: Staging) -> DataFrame:
    """Number the rows 1..N in ascending ``order``, NULLs first, on all executors.

    Rows are split into ranges, sorted inside each range and staged with their
    (range, position). Counting the staged ranges gives each range's offset; that
    table has one row per shuffle partition. ``order`` must tell apart all
    rows that differ, so that the numbers do not depend on the partitioning.

    Numbers that scatter rows take part in the split, after ``order``, so a mass of equal rows spreads over many
    ranges. If ``df`` brings stored ones (``SPREAD``), its rows are written once, placed; the offsets come from
    that. Otherwise the input is staged with new ones first.
    """
    slot, ranged = "_slot", "_range"
    ascending = [F.col(c).asc_nulls_first() for c in order]
    source = None if SPREAD in df.columns else staging.path(f"{out}-input")
    placed = (
        (staging.keep_at(with_spread(df), source) if source else df)
        .repartitionByRange(*ascending, SPREAD)
        .drop(SPREAD)
        .sortWithinPartitions(*ascending)
        .withColumn(slot, F.monotonically_increasing_id())
    )
    placed = staging.keep(placed, out, compression="zstd").withColumn(ranged, F.shiftright(slot, _POSITION_BITS))
    if source:
        staging.drop(source)
    before = Window.orderBy(ranged).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(ranged)
        .agg(F.count(F.lit(1)).alias("rows"))
        .select(ranged, F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"))
    )
    offsets = staging.keep(offsets, f"{out}-offsets")
    position = F.col(slot).bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    return placed.join(F.broadcast(offsets), ranged).select(
        (F.col("offset") + position + 1).alias(out), *[c for c in df.columns if c != SPREAD]
    )


def frequent_members(counted: DataFrame, rows: str, share: int = FREQUENT) -> DataFrame:
    """The rows of a table with row counts that hold at least ``1/share`` of the total."""
    total = counted.agg(F.sum(rows)).scalar()
    return counted.where(F.col(rows) * share >= total)


def frequent_rows(left: DataFrame, right: DataFrame, on: Sequence[str], share: int = FREQUENT) -> DataFrame:
    """The rows of ``right`` whose key holds at least ``1/share`` of the rows of ``left``.

    Buckets of keys are counted first, ``BUCKETS * share`` of them, whose total one task adds up. Only keys of buckets that hold
    as much, mostly none, are counted one by one, so next to nothing is shuffled however many keys there are.
    """
    keys = left.select(*on).dropna()
    bucket, rows = F.pmod(F.xxhash64(*on), F.lit(BUCKETS * share)), F.count(F.lit(1)).alias("_rows")
    counted = keys.groupBy(bucket.alias("_bucket")).agg(rows)
    full = counted.withColumn("_total", F.sum("_rows").over(Window.partitionBy())).where(F.col("_rows") * share >= F.col("_total"))
    some = keys.join(F.broadcast(full.drop("_rows")), bucket == F.col("_bucket"))
    frequent = some.groupBy(*on).agg(rows, F.max("_total").alias("_total")).where(F.col("_rows") * share >= F.col("_total"))
    return right.join(F.broadcast(frequent.select(*on)), list(on), "left_semi")


def lookup(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    take: Sequence[str],
    null_safe: bool = False,
    frequent: DataFrame | None = None,
    spread: str = SPREAD,
) -> DataFrame:
    """Add the columns ``take`` of ``right`` to every row of ``left``.

    ``right`` has at most one row per key. A row whose key has a NULL part finds
    nothing, unless ``null_safe`` makes NULL equal NULL.

    ``frequent`` holds the rows of ``right`` for keys with a large share of
    ``left``, as ``frequent_members`` or ``frequent_rows`` give them; it is
    broadcast. Rows it answers, and rows that cannot match, carry a scattering
    number in the join key where others carry the key's hash, so the shuffle
    spreads them evenly. The number is the stored column ``spread`` of ``left``, or
    else the source partition's number: both are the same on every attempt.

    One whole-number key stands for itself instead of its hash. So a ``right`` that is stored in buckets
    of the key stays where it is, and the key is not shuffled twice: it is told from what the row was routed by.
    """

    def renamed(mark: str, *columns: str) -> list[Column]:
        return [F.col(c).alias(mark + c) for c in columns]

    def same_key(mark: str) -> Column:
        pairs = [(F.col(c), F.col(mark + c)) for c in on]
        return reduce(and_, [a.eqNullSafe(b) if null_safe else a == b for a, b in pairs])

    rows, settled = left, F.lit(False)
    if not null_safe:
        settled = reduce(or_, [F.col(c).isNull() for c in on])
    if frequent is not None:  # one column, so that rows without an answer carry little
        few = frequent.select(*renamed("_few_", *on), F.struct(*on, *take).alias("_few"))
        rows = rows.join(F.broadcast(few), same_key("_few_"), "left")
        settled = settled | F.col("_few").isNotNull()

    scatter = F.col(spread) if spread in left.columns else F.spark_partition_id()
    kept = {c: F.col(c) for c in left.columns}
    kind = right.schema[on[0]].dataType
    if len(on) == 1 and not null_safe and kind == left.schema[on[0]].dataType and isinstance(kind, (T.IntegerType, T.LongType)):
        # a settled row may meet the key that its number happens to be, so it is kept from matching
        number = F.pmod(scatter.cast("long"), F.lit(2**31 - 1)).cast(kind)
        route, extra = F.when(settled, number).otherwise(F.col(on[0])), F.lit(None).alias("_all")
        matches = (F.col("_route") == F.col("_all_" + on[0])) & ~F.col("_settled")
        rows = rows.withColumn("_settled", settled)
        answered = F.lit(None) if frequent is None else F.col("_few")[on[0]]
        kept[on[0]] = F.when(F.col("_settled"), answered).otherwise(F.col("_route")).alias(on[0])
    else:
        route, extra = F.when(settled, scatter.cast("long")).otherwise(F.xxhash64(*on)), F.xxhash64(*on).alias("_all")
        matches = (F.col("_route") == F.col("_all")) & same_key("_all_")
    every = right.select(*renamed("_all_", *on, *take), extra)
    found = rows.withColumn("_route", route).join(every, matches, "left")
    taken = [F.col("_all_" + c) for c in take]
    if frequent is not None:
        taken = [F.when(F.col("_few").isNotNull(), F.col("_few")[c]).otherwise(a) for c, a in zip(take, taken)]
    return found.select(*kept.values(), *[value.alias(c) for c, value in zip(take, taken)])
