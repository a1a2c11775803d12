"""Quality scores by Bradley-Terry ranking of labelled pairs."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import add

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from starmart.llm.shared import Staging, fold, slices
from starmart.operators.keys import assign_dense_key

FOLDS = 5  # fold 0 is held out
BLOCK = 512  # rows of the larger label in a block, where all good and bad rows are compared
STEPS = 30  # Newton steps at most
STRENGTH = 200_000  # the ridge weighs as much as one of so many pairs, or of 20 a row if that is less
CUT = 0.3  # score at and above which a document is predicted good
CHARS = 8_000_000

# Kinds of characters; everything else counts as a mark.
_LOWER, _UPPER, _DIGIT, _SPACE, _COMMON, _SYMBOL, _MARK = range(7)
FEATURES = (
    "log_words", "word_length", "long_words", "upper", "digits", "common", "symbols", "marks",
    "repeated_next", "distinct_words", "repeated_lines", "line_length", "top_word",
)


def _kinds() -> np.ndarray:
    """For each code point the kind of character it is."""
    kind = np.full(0x110000, _MARK, np.uint8)
    for c in range(0x20000):
        s = chr(c)
        if s.isspace():
            kind[c] = _SPACE
        elif s.isalpha():
            kind[c] = _UPPER if s.isupper() else _LOWER
        elif s.isdigit():
            kind[c] = _DIGIT
    kind[0x20000:0x40000] = _LOWER
    for s in ".,;:'\"()-":
        kind[ord(s)] = _COMMON
    for s in "#*$%&|<>{}[]\\^~=+_@":
        kind[ord(s)] = _SYMBOL
    return kind


def measure(text: str, kinds: np.ndarray) -> list[float]:
    """The features of one whole text; shares are square roots, so that small ones count."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    n = np.bincount(kinds[points], minlength=7)
    solid = max(1, len(points) - n[_SPACE])
    words = text.split()
    count = max(1, len(words))
    seen: dict[str, int] = {}
    for w in words:
        seen[w] = seen.get(w, 0) + 1
    lines = [x for x in text.split("\n") if x and not x.isspace()]
    same = sum(a == b for a, b in zip(words, words[1:]))
    root = lambda x: float(np.sqrt(max(0.0, x)))
    return [
        float(np.log1p(len(words))),
        root(solid / count),
        root(sum(len(w) > 25 for w in words) / count),
        root(n[_UPPER] / solid),
        root(n[_DIGIT] / solid),
        root(n[_COMMON] / solid),
        root(n[_SYMBOL] / solid),
        root(n[_MARK] / solid),
        root(same / count),
        float(np.log1p(len(seen)) / np.log1p(count)),
        root((len(lines) - len(set(lines))) / max(1, len(lines))),
        float(np.log1p(len(points) / max(1, len(lines)))),
        root(max(seen.values(), default=0) / count),
    ]


def features(docs: DataFrame) -> DataFrame:
    """(``doc_id``, ``x``): one row per row, with the features of the whole text; NULL counts as empty.

    Nothing but the text is looked at.
    """

    def work(part: pd.DataFrame) -> pd.DataFrame:
        kinds = _kinds()
        return pd.DataFrame({"doc_id": part["doc_id"].astype("Int64"), "x": [measure(t or "", kinds) for t in part["text"]]})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInPandas(
        slices(work, "text", CHARS), "doc_id long, x array<double>"
    )


def blocks(labelled: DataFrame, bad: int, good: int, staging: Staging) -> DataFrame:
    """(``up``, ``down``): the good and the bad rows' features, block by block. Every labelled row is in a block.

    Rows are numbered by the hashes of their ids and each label is dealt out evenly in that order. A block has at most
    ``BLOCK`` rows of a label, and at least one: if a label has fewer rows than there are blocks, its rows are in several.
    """
    number = -(-max(bad, good) // BLOCK)
    hashed = labelled.withColumn("hash", F.xxhash64("doc_id"))
    numbered = assign_dense_key(hashed, ["good", "hash", "doc_id", "x"], "place", staging)
    rows = F.when(F.col("good"), F.lit(good)).otherwise(F.lit(bad))
    at = F.col("place") - 1 - F.when(F.col("good"), F.lit(bad)).otherwise(F.lit(0))
    first = lambda n: F.floor((n * number + rows - 1) / rows)  # noqa: E731  the first block of row n if rows are few
    several = F.sequence(first(at), first(at + 1) - 1)
    dealt = F.when(rows < number, several).otherwise(F.array(F.floor(at * number / rows)))
    mine = lambda label: F.array_sort(F.collect_list(F.when(label, F.col("x"))))
    dealt_out = numbered.select(F.explode(dealt).alias("block"), "good", "x")
    return staging.keep(dealt_out.groupBy("block").agg(mine(F.col("good")).alias("up"), mine(~F.col("good")).alias("down")), "blocks")


def slopes(up: np.ndarray, down: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Pairs, gradient and Hessian of the log-likelihood that each row of ``up`` is preferred to each of ``down``."""
    p = 1 / (1 + np.exp(-np.clip((up @ w)[:, None] - (down @ w)[None, :], -30, 30)))
    wrong, curve = 1 - p, p * (1 - p)
    cross = up.T @ curve @ down
    hessian = (up.T * curve.sum(1)) @ up + (down.T * curve.sum(0)) @ down - cross - cross.T
    return np.concatenate([[p.size], up.T @ wrong.sum(1) - down.T @ wrong.sum(0), hessian.ravel()])


def fitted(labelled: DataFrame, staging: Staging) -> dict:
    """Bradley-Terry weights from all labelled rows: P(a preferred to b) = logistic(w . (x_a - x_b)).

    Pairs are a good and a bad document each, all of a block (``blocks``), so up to ``BLOCK`` rows of a label it is all
    pairs there are. Executors add up the slopes of their blocks for each Newton step, one row per task comes to the driver. ``quantile``
    is the score below which as large a share of all labelled documents lies as is bad; without both labels all scores
    are equal.
    """
    size = len(FEATURES)
    totals = labelled.agg(
        F.count(F.lit(1)),
        F.count_if("good"),
        *[f(F.get("x", F.lit(i))) for f in (F.avg, F.stddev_pop) for i in range(size)],
    ).first()
    n, good = totals[0], totals[1]
    w = np.zeros(size)
    if not good or good == n:
        return {"weights": w, "quantile": 0.0}
    mean, spread = np.array(totals[2 : 2 + size]), np.array(totals[2 + size :])
    spread = np.where(spread > 1e-9, spread, 1.0)
    compared = blocks(labelled, n - good, good, staging)
    ridge = 1 / min(STRENGTH, 20 * max(good, n - good))

    def step(at: np.ndarray) -> np.ndarray:
        scaled = lambda x: (np.array(x.tolist(), float).reshape(-1, size) - mean) / spread

        def work(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total = np.zeros(1 + size + size * size)
            for part in parts:
                for up, down in zip(part["up"], part["down"]):
                    total += slopes(scaled(up), scaled(down), at)
            yield pd.DataFrame({"total": [total]})

        total = np.sum([r["total"] for r in compared.mapInPandas(work, "total array<double>").collect()], axis=0)
        rest = total[1:] / total[0]
        gradient, hessian = rest[:size] - ridge * at, rest[size:].reshape(size, size) + ridge * np.eye(size)
        return np.linalg.solve(hessian, gradient)

    for _ in range(STEPS):  # Newton steps of the logistic loss on differences
        move = step(w)
        w = w + move
        if np.abs(move).max() < 1e-6:
            break
    weights = w / spread
    return {"weights": weights, "quantile": quantile(labelled.select(weighted(F.col("x"), weights).alias("value")), n, 1 - good / n, staging)}


def quantile(values: DataFrame, n: int, share: float, staging: Staging) -> float:
    """The exact quantile of the ``n`` rows of ``value``, linear between neighbours; the rows are numbered on executors."""
    at = share * (n - 1)
    low = int(at)
    placed = assign_dense_key(values, ["value"], "place", staging)
    found = {r["place"]: r["value"] for r in placed.where(F.col("place").isin(low + 1, min(n, low + 2))).collect()}
    return found[low + 1] + (at - low) * (found[min(n, low + 2)] - found[low + 1])


def weighted(x: Column, weights: np.ndarray) -> Column:
    return reduce(add, [F.get(x, F.lit(i)) * float(w) for i, w in enumerate(weights)])


def score(x: Column, model: dict) -> Column:
    """0 to 1; ``CUT`` at the model's quantile. Half for all documents if there is no model."""
    if not np.any(model["weights"]):
        return F.lit(0.5)
    shift = float(np.log(CUT / (1 - CUT))) - model["quantile"]
    return 1 / (1 + F.exp(F.greatest(F.lit(-500.0), F.least(F.lit(500.0), -(weighted(x, model["weights"]) + shift)))))


def ranked(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(``doc_id``, ``held_out``, ``score``, ``predicted``), one row per row of ``docs``.

    Learns from all labelled documents outside fold 0 of ``FOLDS``. A
    document counts as good if none of its labels is 0; NULL labels do not count. Threshold
    by quantile: score ``CUT`` lies where as large a share of the labelled documents
    falls below as is labelled bad. Without good and bad labels every score is 0.5.
    Repeated rows and rows without an id stay and are scored like any other, and so are NULL texts, as empty ones.
    An empty table gives no rows. Columns other than id and text are not looked at.
    """
    held, staging = fold(F.col("doc_id"), FOLDS) == 0, Staging(docs.sparkSession)
    found = staging.keep(features(docs), "features")
    graded = labels.where("quality IS NOT NULL AND doc_id IS NOT NULL").groupBy(
        F.col("doc_id").cast("long").alias("doc_id")
    ).agg((F.min("quality") > 0).alias("good"))
    labelled = staging.keep(found.where(~held).join(graded, "doc_id").select("doc_id", "x", "good"), "labelled")
    model = fitted(labelled, staging)
    scored = found.select("doc_id", held.alias("held_out"), score(F.col("x"), model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= CUT).cast("int"))
