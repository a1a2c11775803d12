"""Language identification by n-gram filters that answer for all languages at once."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from starmart.llm.shared import Staging, fold, slices

FOLDS, HELD = 4, 2
SIZES = (3, 4)  # code points of an n-gram
SAMPLE = 3_000  # labelled documents per language at most that the filters are made from
PART_BITS = 12  # of a hash: a language's documents are dealt into 4096 parts
GRAMS = 20_000  # n-grams per language and size at most that are put into a filter
COVERAGE = 0.95  # share of the sample's n-grams that those put in have to cover
CELLS = 1 << 20  # of the filters; a cell has a bit per language
PROBES = 2
CHARS = 4_000_000
UNKNOWN = "und"

_SPREAD = np.uint64(0x9E3779B97F4A7C15)


def _letters() -> np.ndarray:
    """For each code point itself in lower case if it is a letter, and 0 if not."""
    out = np.zeros(0x110000, np.uint32)
    for c in range(0x110000):
        s = chr(c)
        if s.isalpha():
            low = s.lower()
            out[c] = ord(low) if len(low) == 1 else c
    return out


def grams(text: str, letters: np.ndarray) -> dict[int, np.ndarray]:
    """Hashes of the n-grams of a whole text by size. Words are runs of letters, with a mark at both ends."""
    points = letters[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
    points = np.concatenate([[0], points, [0]]).astype(np.uint64)
    points = points[np.concatenate([[True], (points[1:] > 0) | (points[:-1] > 0)])]
    out = {}
    for n in SIZES:
        if len(points) < max(n, 3):
            out[n] = np.zeros(0, np.uint64)
            continue
        h = np.full(len(points) - n + 1, n, np.uint64)
        for k in range(n):
            h = (h ^ points[k : len(points) - n + 1 + k]) * _SPREAD
            h ^= h >> np.uint64(29)
        out[n] = h[points[1 : len(points) - n + 2] > 0]
    return out


def _cells(h: np.ndarray) -> list[np.ndarray]:
    """The cells of each hash, one array per probe."""
    shift = np.uint64(64 - CELLS.bit_length() + 1)
    return [((h * np.uint64(2 * k + 1) * _SPREAD) >> shift).astype(np.int64) for k in range(1, PROBES + 1)]


def made_filters(members: dict[str, np.ndarray]) -> dict:
    """Bloom filters of all languages side by side: a cell holds a bit for each language.

    ``false`` is each language's rate of false positives, from how full its filter is.
    """
    languages = sorted(members)
    cells = np.zeros((CELLS, max(1, math.ceil(len(languages) / 8))), np.uint8)
    for i, language in enumerate(languages):
        for at in _cells(members[language]):
            cells[at, i // 8] |= np.uint8(1 << (i % 8))
    filled = [float((cells[:, i // 8] >> (i % 8) & 1).mean()) for i in range(len(languages))]
    return {"languages": languages, "cells": cells, "false": np.minimum(np.array(filled) ** PROBES, 0.99)}


def counts(filters: dict, h: np.ndarray) -> np.ndarray:
    """How many of the n-grams each language contains, less what false positives explain."""
    found = None
    for at in _cells(h):
        found = filters["cells"][at] if found is None else found & filters["cells"][at]
    bits = np.arange(256)[:, None] >> np.arange(8) & 1
    hits = np.concatenate([np.bincount(found[:, w], minlength=256) @ bits for w in range(found.shape[1])])
    false = filters["false"]
    return np.maximum(0.0, (hits[: len(false)] - len(h) * false) / (1 - false))


def _counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    letters = _letters()

    def work(part: pd.DataFrame) -> pd.DataFrame:
        frames = []
        for language, own in part.groupby("lang", sort=False):
            found = [grams(t, letters) for t in own["text"]]
            for n in SIZES:
                h, times = np.unique(np.concatenate([g[n] for g in found]), return_counts=True)
                frames.append(pd.DataFrame({"lang": language, "n": n, "gram": h.view(np.int64), "times": times}))
        return pd.concat(frames)

    yield from slices(work, "text", CHARS)(batches)


def learned(docs: DataFrame, sample: int = SAMPLE) -> dict:
    """Filters of the n-grams of each language in ``lang``, from whole texts.

    Hashes of ids deal a language's documents outside fold ``HELD`` into equal parts, of which as many are
    used as ``sample`` documents hold, and one at least. Put in are its most frequent n-grams, up to the
    ``COVERAGE`` of all that occur, and ``GRAMS`` of each size at most: so the driver gets a
    bounded number of them per language. Where a text is NULL or a language has
    no n-grams, nothing is learned.
    """
    rows = docs.select("doc_id", "lang", "text").where("lang IS NOT NULL AND text IS NOT NULL").where(fold(F.col("doc_id"), FOLDS) != HELD)
    part = F.shiftrightunsigned(F.xxhash64("doc_id"), 64 - PART_BITS)
    sizes = rows.groupBy("lang", part.alias("part")).agg(F.count(F.lit(1)).alias("n"))
    so_far = F.sum("n").over(Window.partitionBy("lang").orderBy("part"))
    taken = sizes.withColumn("so_far", so_far).where((F.col("so_far") <= sample) | (F.col("so_far") == F.col("n")))
    # Stored, so that Spark knows how small it is when it chooses the join.
    last = Staging(docs.sparkSession).keep(taken.groupBy("lang").agg(F.max("part").alias("last")), "sample")
    picked = rows.join(last, "lang").where(part <= F.col("last"))
    counted = picked.select(F.col("lang").cast("string").alias("lang"), "text").mapInPandas(
        _counted, "lang string, n int, gram long, times long"
    )
    total = counted.groupBy("lang", "n", "gram").agg(F.sum("times").alias("times"))
    order = Window.partitionBy("lang", "n").orderBy(F.desc("times"), "gram")
    ranked = total.select(
        "*",
        F.row_number().over(order).alias("place"),
        (F.sum("times").over(order.rowsBetween(Window.unboundedPreceding, -1))).alias("before"),
        F.sum("times").over(Window.partitionBy("lang", "n")).alias("all"),
    ).where((F.col("place") <= GRAMS) & (F.coalesce("before", F.lit(0)) < COVERAGE * F.col("all")))
    table = ranked.select("lang", "gram").toPandas()
    return made_filters({x: own["gram"].to_numpy().view(np.uint64) for x, own in table.groupby("lang")})


def identified(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(``doc_id``, ``held_out``, ``lang_pred``, ``score``), one row per row of ``docs``.

    The language whose filter contains most of the text's n-grams, after correction for
    false positives; of equals the first by name. ``score`` is the share it contains. The whole text is
    read. A NULL text or one without a letter is ``und`` with score 0, and so is
    every text if no language could be learned. ``lang`` is used for learning alone. Repeated rows stay, an
    empty table gives no rows, and other columns are not looked at.
    """
    spark = docs.sparkSession
    filters = spark.sparkContext.broadcast(learned(docs, sample))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        letters, known = _letters(), filters.value

        def one(text: str | None) -> tuple[str, float]:
            found = np.concatenate(list(grams(text or "", letters).values()))
            if not len(found) or not known["languages"]:
                return UNKNOWN, 0.0
            share = counts(known, found) / len(found)
            best = int(np.argmax(share))
            return known["languages"][best], float(min(1.0, share[best]))

        def work(part: pd.DataFrame) -> pd.DataFrame:
            found = [one(t) for t in part["text"]]
            return pd.DataFrame(
                {"doc_id": part["doc_id"].astype("Int64"), "lang_pred": [f[0] for f in found], "score": [f[1] for f in found]}
            )

        yield from slices(work, "text", CHARS)(batches)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = rows.mapInPandas(run, "doc_id long, lang_pred string, score double")
    return out.select("doc_id", (fold(F.col("doc_id"), FOLDS) == HELD).alias("held_out"), "lang_pred", "score")
