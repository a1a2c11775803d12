"""Connected components of a graph whose edges only the cluster can hold."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Observation, functions as F

from starmart.llm.shared import Staging

EDGE = "a long, b long"
BATCH_EDGES = 200_000  # edges that one task holds at a time to shorten paths


def _forests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Replace the edges of a batch by one edge from each vertex to the smallest it reaches there."""
    for batch in batches:
        parent: dict[int, int] = {}

        def root(v: int) -> int:
            while parent.setdefault(v, v) != v:
                parent[v] = parent[parent[v]]
                v = parent[v]
            return v

        for a, b in zip(batch["a"].tolist(), batch["b"].tolist()):
            x, y = root(a), root(b)
            if x != y:
                parent[max(x, y)] = min(x, y)
        pairs = [(v, root(v)) for v in parent]
        yield pd.DataFrame([p for p in pairs if p[0] != p[1]], columns=["a", "b"], dtype="int64")


def _kept(df: DataFrame, staging: Staging, old: str | None) -> tuple[DataFrame, str, tuple[int, int]]:
    """Store the edges; their number and a sum over them tell whether a round changed anything."""
    seen, path = Observation(), staging.path("edges")
    mark = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).cast("string")
    edges = staging.keep_at(df.observe(seen, F.count(F.lit(1)).alias("n"), mark.alias("mark")), path)
    if old:
        staging.drop(old)
    return edges, path, (seen.get["n"], seen.get["mark"])


def connected_components(edges: DataFrame, staging: Staging) -> DataFrame:
    """(``node``, ``root``): every vertex of ``edges`` (a, b) and the smallest it can reach.

    Rounds of two steps turn each component into a star around its smallest
    vertex: a vertex's larger neighbours are linked to the smallest it sees, then
    its smaller ones are. Rounds end when the edges stay the same, about the
    logarithm of the longest path later. Before the first, each task shortens
    the paths within its own batches. Every round is written to the shared folder.

    NULL ends and loops are left out; an empty graph gives no rows. A vertex with a
    very large share of all edges is aggregated before the shuffle, and its join
    back is a plain sort-merge join, which adaptive execution splits.
    """
    spark = edges.sparkSession
    clean = edges.select(F.col("a").cast("long"), F.col("b").cast("long")).where("a <> b")
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(BATCH_EDGES))
    try:
        now, path, mark = _kept(clean.mapInPandas(_forests, EDGE).distinct(), staging, None)
    finally:
        spark.conf.set(name, before)
    while True:
        last = mark
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large, _, _ = _kept(large.where("a <> b").distinct(), staging, path)
        smallest = large.groupBy("a").agg(F.min("b").alias("m"))
        near = large.join(smallest, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = near.union(smallest.select("a", F.col("m").alias("b"))).where("a <> b").distinct()
        now, path, mark = _kept(small, staging, None)
        if mark == last:
            return now.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root")).union(
                now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
