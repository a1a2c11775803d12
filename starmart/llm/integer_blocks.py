"""Whole-number vectors, and the best partners of some of them found block against block."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from starmart.llm.shared import Staging

SCALE = 256  # a component x counts as floor(SCALE * x)
BLOCK_BYTES = 32_000_000  # of the vectors of a block, at most about
LEAST_BLOCK = 1_024  # rows of a block, unless the table has fewer
TILE = (256, 2_048)  # asking and answering rows that are compared at a time
LONGEST = 2**63 - 1  # scores beyond count as this
EXACT = 2.0**52  # below, sums of products of doubles are exact


def finite(x: Column) -> Column:
    """Whether a vector is not NULL and has no NULL or non-finite component."""
    return F.coalesce(F.forall(x, lambda v: F.coalesce(F.abs(v.cast("double") * SCALE) < float("inf"), F.lit(False))), F.lit(False))


def _whole(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        made = [np.floor(SCALE * np.asarray(x, np.float64)).astype("<f8") for x in batch["x"]]
        yield batch.drop(columns="x").assign(dim=np.array([len(v) for v in made], np.int32), vector=[v.tobytes() for v in made])


def whole_vectors(table: DataFrame, number: str, vector: str, staging: Staging, **extra: Column) -> DataFrame:
    """(``row``, ``id``, ``dim``, ``vector``) and ``extra`` columns of the rows whose vector is ``finite``, stored once.

    ``row`` tells apart rows that share an id. ``vector`` holds the components as whole doubles.
    A component is not finite either if its multiple by ``SCALE`` is not.
    """
    x = F.col(vector)
    own = {"id": F.col(number).cast("long"), **extra}
    rows = table.where(finite(x)).select(
        F.monotonically_increasing_id().alias("row"), *[c.alias(n) for n, c in own.items()], F.transform(x, lambda v: v.cast("double")).alias("x")
    )
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields if f.name != "x")
    return staging.keep(rows.mapInPandas(_whole, f"{kinds}, dim int, vector binary"), "vectors")


def matrix(values: pd.Series, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(values), "<f8").reshape(len(values), dim)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of rows, as long; beyond its range they count as its ends."""
    top = [float(np.abs(m).max()) if m.size else 0.0 for m in (a, b)]
    if top[0] * top[1] * max(1, a.shape[1]) < EXACT:
        return (a @ b.T).astype(np.int64)
    left, right = ([[int(v) for v in row] for row in m] for m in (a, b))
    exact = [[max(-LONGEST, min(LONGEST, sum(map(int.__mul__, p, q)))) for q in right] for p in left]
    return np.array(exact, np.int64).reshape(len(a), len(b))


class Leaders:
    """For each of ``owners`` the ``most`` best of what was offered, by falling score and rising place."""

    def __init__(self, owners: int, most: int):
        self.most = most
        self.owner, self.score, self.place = (np.zeros(0, np.int64) for _ in range(3))
        self.least = np.full(owners, -LONGEST - 1, np.int64)  # what a later place has to exceed

    def offer(self, owner: np.ndarray, score: np.ndarray, place: np.ndarray) -> None:
        """Take in some candidates. Their places must come after all places offered to their owners before."""
        better = score > self.least[owner]
        owner, score, place = (np.concatenate([old, new[better]]) for old, new in ((self.owner, owner), (self.score, score), (self.place, place)))
        order = np.lexsort((place, -score, owner))
        owner, score, place = owner[order], score[order], place[order]
        rank = np.arange(len(owner)) - np.searchsorted(owner, owner)
        last = rank == self.most - 1
        self.least[owner[last]] = score[last]
        kept = rank < self.most
        self.owner, self.score, self.place = owner[kept], score[kept], place[kept]


def tiles(n: int, size: int) -> Iterator[slice]:
    return (slice(k, min(k + size, n)) for k in range(0, n, size))


def by_id(rows: pd.DataFrame) -> pd.DataFrame:
    """Rows in the order that ties are decided by: rising id, without id last, then by row."""
    return rows.sort_values(["id", "row"], na_position="last", kind="stable", ignore_index=True)


def block_pairs(
    asking: DataFrame, answering: DataFrame, work: Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame], schema: str
) -> DataFrame:
    """``work`` on every block of ``asking`` with every block of ``answering`` rows of the same ``dim``, each pair in a task.

    Both are stored tables with ``row``, ``id``, ``dim`` and ``vector``. Blocks are drawn by hash of the
    row, so they are even whatever the vectors are, and hold at most about ``BLOCK_BYTES``. Blocks of the answering rows are
    smaller where there would be fewer of them than the session has cores for.
    """
    spark = asking.sparkSession
    longest = answering.agg(F.max("dim")).first()[0] or 1
    most = max(1, BLOCK_BYTES // (8 * max(1, longest)))
    answers, asks = answering.count(), asking.count()
    wide = min(most, max(LEAST_BLOCK, -(-answers // (4 * spark.sparkContext.defaultParallelism))))
    n, m = max(1, -(-asks // most)), max(1, -(-answers // wide))

    def dealt(df: DataFrame, own: str, parts: int, other: str, others: int) -> DataFrame:
        block = F.pmod(F.xxhash64("row", F.lit(own)), F.lit(parts)).cast("int").alias(own)
        return df.select("*", block, F.explode(F.sequence(F.lit(0), F.lit(others - 1))).alias(other))

    left = dealt(asking, "ask", n, "answer", m).groupBy("dim", "ask", "answer")
    right = dealt(answering, "answer", m, "ask", n).groupBy("dim", "ask", "answer")
    return left.cogroup(right).applyInPandas(work, schema)
