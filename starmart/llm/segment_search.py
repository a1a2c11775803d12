"""Exact search for the rows with the largest inner products, pruned by statistics of segments."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from starmart.llm.integer_blocks import EXACT, SCALE, TILE, Leaders, block_pairs, by_id, matrix, products, tiles, whole_vectors
from starmart.llm.shared import Staging

BEST = 5
SEGMENTS = (64, 16, 4)  # components of a segment, from coarse to fine
SAMPLE = 1_024  # rows that give a first limit for each query; only the time depends on it
DENSE = 0.2  # share of a tile from which whole tiles are compared and not single pairs

RESULT = "row long, query_id long, vec_id long, score long"


def statistics(x: np.ndarray, length: int) -> np.ndarray:
    """Mean and deviation of every segment of every row, weighted so that a product of two such rows bounds that of the vectors.

    With d the distance of two vectors, their product is (|a|^2 + |b|^2 - d^2) / 2. In a segment of n
    components d^2 is at least n times the squared differences of the means and of the deviations, which
    leaves a product of at most n times (mean * mean + deviation * deviation).
    """
    out = []
    for k in range(0, x.shape[1], length):
        own = x[:, k : k + length]
        mean = own.mean(axis=1)
        out += [mean * np.sqrt(own.shape[1]), np.sqrt(np.square(own - mean[:, None]).sum(axis=1))]
    return np.stack(out, axis=1) if out else np.zeros((len(x), 0))


def survivors(q: list[np.ndarray], x: list[np.ndarray], need: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of a tile whose product reaches ``need`` of its row: (row, row, product).

    ``q`` and ``x`` hold the statistics, coarse to fine, and last the vectors themselves. While many pairs are left a whole tile is
    multiplied at a time, then only what is left.
    """
    mask, a, b, value = None, None, None, None
    slack = 1e-9 * max(1.0, *(np.sqrt(np.square(m[-1]).sum(axis=1).max(initial=0.0)) ** 2 for m in (q, x)))
    for level, (left, right) in enumerate(zip(q, x)):
        enough = need if level == len(q) - 1 else need - slack  # bounds are rounded, products are not
        if a is None:
            value = left @ right.T
            alive = value >= enough[:, None]
            mask = alive if mask is None else mask & alive
            if level == len(q) - 1 or np.count_nonzero(mask) < DENSE * mask.size:
                a, b = np.nonzero(mask)
                value = value[a, b]
        else:
            value = np.einsum("ij,ij->i", left[a], right[b])
            alive = value >= enough[a]
            a, b, value = a[alive], b[alive], value[alive]
    return a, b, value


def _searched(best: int) -> Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]:
    """The best rows of one block for each query of another."""

    def run(asking: pd.DataFrame, answering: pd.DataFrame) -> pd.DataFrame:
        if asking.empty or answering.empty:
            return pd.DataFrame({"row": [], "query_id": [], "vec_id": [], "score": []}, dtype="Int64")
        answering, dim = by_id(answering), int(asking["dim"].iloc[0])
        q, x = matrix(asking["vector"], dim), matrix(answering["vector"], dim)
        rows, own = answering["row"].to_numpy(), asking["row"].to_numpy()
        first = asking["least"].fillna(-np.inf).to_numpy(np.float64)
        top = [np.abs(m).max(initial=0.0) for m in (q, x)]
        plain = top[0] * top[1] * max(1, dim) < EXACT
        levels = SEGMENTS if plain else ()  # doubles cannot hold the others' products, nor bounds of them
        qs, xs = ([*(statistics(m, n) for n in levels), m] for m in (q, x))
        found = Leaders(len(q), best)
        for r in tiles(len(q), TILE[0]):
            for c in tiles(len(x), TILE[1]):
                if plain:
                    a, b, score = survivors([s[r] for s in qs], [s[c] for s in xs], np.maximum(first[r], found.least[r]))
                    score = score.astype(np.int64)
                else:
                    score = products(q[r], x[c])
                    a, b = (i.ravel() for i in np.indices(score.shape))
                    score = score.ravel()
                a, b = a + r.start, b + c.start
                other = own[a] != rows[b]
                found.offer(a[other], score[other], b[other])
        names = {"row": own[found.owner], "query_id": asking["id"].to_numpy()[found.owner], "score": found.score}
        return pd.DataFrame(names).assign(vec_id=answering["id"].astype("Int64").to_numpy()[found.place])

    return run


def _limited(sample: pd.DataFrame, best: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Add ``least``, the score that a query's last result has at least: the one it would have in the sample."""
    by_dim = {int(d): (own["row"].to_numpy(), matrix(own["vector"], int(d))) for d, own in sample.groupby("dim")}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for dim, own in batch.groupby("dim", sort=False):
                least = np.full(len(own), np.nan)
                if int(dim) in by_dim and len(by_dim[int(dim)][0]) > best:
                    rows, x = by_dim[int(dim)]
                    q = matrix(own["vector"], int(dim))
                    if np.abs(q).max(initial=0.0) * np.abs(x).max(initial=0.0) * max(1, int(dim)) < EXACT:
                        scores = np.where(own["row"].to_numpy()[:, None] == rows[None, :], -np.inf, q @ x.T)
                        least = np.partition(scores, -best, axis=1)[:, -best]
                yield own.assign(least=least)

    return run


def searched(table: DataFrame, asked: Column, best: int = BEST, number: str = "vec_id", vector: str = "embedding", staging: Staging | None = None) -> DataFrame:
    """(``query_id``, ``rank``, ``vec_id``, ``score``): the ``best`` other rows of each row for which ``asked`` holds.

    ``asked`` is a condition on ``id``, the number of a row. Vectors are made whole (``whole_vectors``) and compared by exact
    inner product, ties going to the smaller number. Rows whose vector is NULL or holds NULL or non-finite components take no part;
    vectors of other lengths are not compared with a query; empty vectors have the product 0.
    Rows that repeat a number are rows of their own: each is a query, and a result of the others. A row
    without number is no query, and comes last among ties. Scores beyond the range of long count as its
    ends. An empty table gives no rows, and a query without other rows gives none. Other columns are not looked at.

    Queries are compared with all rows block by block (``block_pairs``). In each tile the segments' means and deviations
    bound the products from coarse to fine, and only pairs whose bounds reach the last result so far are multiplied. No
    pair is left out otherwise, so the result is exact.
    """
    staging = staging or Staging(table.sparkSession)
    rows = whole_vectors(table, number, vector, staging)
    sample = rows.orderBy(F.xxhash64("row"), "row").limit(SAMPLE).select("row", "dim", "vector").toPandas()
    queries = rows.where(F.coalesce(asked, F.lit(False)))
    queries = staging.keep(queries.mapInPandas(_limited(sample, best), "row long, id long, dim int, vector binary, least double"), "queries")
    found = block_pairs(queries, rows, _searched(best), RESULT)
    order = Window.partitionBy("row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


# The same by comparing every query with every row.
ORACLE = f"""
WITH v AS (
  SELECT vec_id, [floor({SCALE} * CAST(x AS DOUBLE)) for x in embedding] AS c
  FROM embeddings
  WHERE embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
  SELECT q.vec_id AS query_id, r.vec_id, CAST(list_dot_product(q.c, r.c) AS BIGINT) AS score
  FROM v q JOIN v r ON q.vec_id % 50 = 0 AND q.vec_id <> r.vec_id
), o AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place, vec_id, score FROM s
)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM o WHERE place <= {BEST}
"""
