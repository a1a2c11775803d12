"""Hard negatives of labelled vectors, selected by slots between the positives' upper limits."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from starmart.llm.integer_blocks import LONGEST, SCALE, TILE, Leaders, block_pairs, by_id, matrix, products, tiles, whole_vectors
from starmart.llm.shared import Staging

POSITIVES = 5
NEGATIVES = 10
WINDOW = (30, 90)  # a negative's score in hundredths of the positive's, from and to

PARTNER = "row long, slot int, partner long, score long"


def _empty() -> pd.DataFrame:
    return pd.DataFrame({c.split()[0]: [] for c in PARTNER.split(", ")}, dtype="Int64")


def _partners(found: Leaders, anchors: pd.DataFrame, others: pd.DataFrame, slots: int) -> pd.DataFrame:
    names = {"row": anchors["row"].to_numpy()[found.owner // slots], "slot": (found.owner % slots).astype(np.int32), "score": found.score}
    return pd.DataFrame(names).assign(partner=others["id"].astype("Int64").to_numpy()[found.place])


def _nearest(most: int) -> Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]:
    """The best rows of the anchor's label in one block."""

    def run(anchors: pd.DataFrame, others: pd.DataFrame) -> pd.DataFrame:
        if anchors.empty or others.empty:
            return _empty()
        others, dim = by_id(others), int(anchors["dim"].iloc[0])
        x, y = matrix(anchors["vector"], dim), matrix(others["vector"], dim)
        found = Leaders(len(x), most)
        for r in tiles(len(x), TILE[0]):
            for c in tiles(len(y), TILE[1]):
                same = anchors["label"].to_numpy()[r][:, None] == others["label"].to_numpy()[c][None, :]
                same &= anchors["row"].to_numpy()[r][:, None] != others["row"].to_numpy()[c][None, :]
                a, b = np.nonzero(same)
                found.offer(a + r.start, products(x[r], y[c])[a, b], b + c.start)
        return _partners(found, anchors, others, 1)

    return run


def _slotted(slots: int, most: int) -> Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]:
    """The best rows of other labels in one block, for every slot of an anchor.

    ``limits`` holds an anchor's upper limits, falling. Slot k is what lies at or below
    limit k and above the next one; the last slot ends at ``bottom``.
    """

    def run(anchors: pd.DataFrame, others: pd.DataFrame) -> pd.DataFrame:
        if anchors.empty or others.empty:
            return _empty()
        others, dim = by_id(others), int(anchors["dim"].iloc[0])
        x, y = matrix(anchors["vector"], dim), matrix(others["vector"], dim)
        limits = np.full((len(x), slots), -LONGEST - 1, np.int64)
        for k, own in enumerate(anchors["limits"]):
            limits[k, : len(own)] = own
        bottom, found = anchors["bottom"].to_numpy(np.int64), Leaders(len(x) * slots, most)
        for r in tiles(len(x), TILE[0]):
            for c in tiles(len(y), TILE[1]):
                score = products(x[r], y[c])
                wanted = anchors["label"].to_numpy()[r][:, None] != others["label"].to_numpy()[c][None, :]
                wanted &= (score <= limits[r][:, :1]) & (score >= bottom[r][:, None])
                a, b = np.nonzero(wanted)
                score = score[a, b]
                slot = (limits[r][a] >= score[:, None]).sum(axis=1) - 1
                found.offer((a + r.start) * slots + slot, score, b + c.start)
        return _partners(found, anchors, others, slots)

    return run


def _share(score: Column, hundredths: int, up: bool) -> Column:
    """``hundredths`` of a score that is not negative, in whole numbers, without overflow."""
    part = F.pmod(score, F.lit(100)) * hundredths + (99 if up else 0)
    return F.expr("positive_score div 100") * hundredths + F.floor(part / 100).cast("long")


def _first(found: DataFrame, keys: list[str], most: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("partner"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def mined(
    table: DataFrame, anchor: Column, label: Column | None = None, positives: int = POSITIVES, negatives: int = NEGATIVES,
    number: str = "vec_id", vector: str = "embedding", staging: Staging | None = None,
) -> DataFrame:
    """(``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``).

    Anchors are the rows for which ``anchor``, a condition on ``id``, holds. ``label`` is the label to use, the column of
    that name if left out. Vectors are made whole (``whole_vectors``); scores are exact inner products. Higher scores come first,
    then smaller numbers. An anchor's positives are its first ``positives`` other rows of its label. For each,
    the first ``negatives`` rows of other labels whose score lies in the ``WINDOW`` of the
    positive's are returned; a positive below 0 has an empty window, one of 0 the window of 0 alone.

    Rows with a NULL label, a NULL vector or a NULL or non-finite component take no part; vectors of other lengths are
    not compared. Rows that repeat a number are rows of their own, as anchors, positives and negatives;
    rows without number are no anchors and come last among ties. Scores beyond the range of long
    count as its ends. An empty table, an anchor alone with its label, or a window without rows gives no
    rows. Other columns are not looked at.

    The windows of one anchor overlap. Their upper limits cut the scores into disjoint slots, and every block of rows returns the
    first ``negatives`` of each slot. Slots in falling order make one list of which each window needs no more than the
    first ``negatives`` from its own slot on; its lower limit then ends it.
    """
    staging = staging or Staging(table.sparkSession)
    label = F.col("label") if label is None else label
    rows = whole_vectors(table.where(label.isNotNull()), number, vector, staging, label=label.cast("string"))
    anchors = staging.keep(rows.where(F.coalesce(anchor, F.lit(False))), "anchors")

    near = _first(block_pairs(anchors, rows, _nearest(positives), PARTNER), ["row"], positives)
    near = near.select("row", F.col("partner").alias("positive_id"), F.col("score").alias("positive_score")).where("positive_score >= 0")
    score = F.col("positive_score")
    near = staging.keep(near.withColumns({"low": _share(score, WINDOW[0], True), "high": _share(score, WINDOW[1], False)}), "positives")
    bounds = near.groupBy("row").agg(F.sort_array(F.collect_set("high"), asc=False).alias("limits"), F.min("low").alias("bottom"))
    asking = staging.keep(anchors.join(bounds, "row"), "asking")

    slots = _first(block_pairs(asking, rows, _slotted(positives, negatives), PARTNER), ["row", "slot"], negatives)
    lists = slots.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("slot", "rank", "partner", "score"))).alias("list"))
    own = near.join(lists, "row").join(asking.select("row", F.col("id").alias("anchor_id"), "limits"), "row")
    suffix = F.filter("list", lambda e: e["slot"] >= F.array_position("limits", F.col("high")) - 1)
    own = own.withColumn("found", F.filter(F.slice(suffix, 1, negatives), lambda e: e["score"] >= F.col("low")))
    return own.select("anchor_id", "positive_id", "positive_score", F.posexplode("found").alias("at", "negative")).select(
        "anchor_id", "positive_id", (F.col("at") + 1).cast("int").alias("rank"),
        F.col("negative.partner").alias("negative_id"), "positive_score", F.col("negative.score").alias("negative_score"),
    )


# The same by comparing every anchor with every row.
ORACLE = f"""
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    [floor({SCALE} * CAST(x AS DOUBLE)) for x in embedding] AS c
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, r.vec_id, r.label = a.label AS same, CAST(list_dot_product(a.c, r.c) AS BIGINT) AS score
  FROM v a JOIN v r ON a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id
), o AS (
  SELECT *, row_number() OVER (PARTITION BY anchor_id, same ORDER BY score DESC, vec_id) AS place FROM s
), n AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, o.vec_id AS negative_id, p.score AS positive_score, o.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY o.place) AS place
  FROM o p JOIN o ON p.anchor_id = o.anchor_id AND p.same AND p.place <= {POSITIVES} AND NOT o.same
    AND {WINDOW[0]} * p.score <= 100 * o.score AND 100 * o.score <= {WINDOW[1]} * p.score
)
SELECT anchor_id, positive_id, CAST(place AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE place <= {NEGATIVES}
"""
