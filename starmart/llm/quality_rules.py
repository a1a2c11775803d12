"""Quality rules whose cutoffs are bought with a guarantee on false rejections.

DataFrame functions only. A document is measured, every rule is a number of which too
much is bad, and labelled documents decide how much is too much.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window, functions as F

from starmart.llm.shared import Staging, row_of

WINDOW = 5  # words
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20

ALPHA = 0.05  # share of good documents of a stratum that all rules together may reject
DELTA = 0.10  # chance that this fails for any stratum

WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

# Cutoffs tried for each rule, from lenient to strict.
CUTOFFS = {
    "symbols": [0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1, 0.07, 0.05, 0.03],
    "capitals": [0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.25, 0.2, 0.15],
    "marks": [0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1, 0.07, 0.05, 0.03],
    "repeated_lines": [0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.25, 0.2],
    "repeated_words": [0.2, 0.18, 0.16, 0.14, 0.12, 0.1, 0.08, 0.06],
}


# --- measures ---------------------------------------------------------------


def _windows(word_hashes: Column) -> Column:
    """(hash, position) of every window of words, sorted."""
    starts = F.when(
        F.size(word_hashes) >= WINDOW, F.sequence(F.lit(0), F.size(word_hashes) - WINDOW)
    ).otherwise(F.array().cast("array<int>"))
    return F.sort_array(
        F.transform(
            starts,
            lambda i: F.struct(
                F.xxhash64(*[F.get(word_hashes, i + k) for k in range(WINDOW)]).alias("h"), i.alias("i")
            ),
        )
    )


def _covered(positions: Column) -> Column:
    """Words in windows that start at the sorted ``positions``, each counted once."""
    gaps = F.transform(
        positions, lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get(positions, k + 1) - p, F.lit(WINDOW)))
    )
    return F.aggregate(gaps, F.lit(0).cast("long"), lambda total, g: total + g)


def measured(docs: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Every row as the struct ``_doc``, of all or some columns, with its measures beside it.

    ``n_words``, ``word_chars`` (code points in words), ``n_symbols``, ``n_dup_lines`` (lines with
    a word that equal an earlier line), ``n_repeat_words`` (words in windows of
    five found twice or more in the text), and, for the rules, ``n_lines`` with a
    word, ``n_capitals`` and ``n_marks`` (``!`` and ``?``). A NULL text has no words.
    Windows are compared by 64-bit hashes of their words.
    """
    text = F.col("_text")
    without = lambda drop: F.length(text) - F.length(F.translate(text, drop, ""))
    rows = docs.select(
        row_of(docs, columns), F.coalesce(docs["text"].cast("string"), F.lit("")).alias("_text")
    )
    rows = rows.select(
        "_doc",
        F.transform(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), lambda w: F.xxhash64(w)).alias("_words"),
        F.filter(F.split(text, "\n", -1), lambda line: line.rlike(WORD)).alias("_lines"),
        F.length(F.regexp_replace(text, r"[\x20\x09-\x0D]+", "")).cast("long").alias("word_chars"),
        without(SYMBOLS).cast("long").alias("n_symbols"),
        (F.length(text) - F.length(F.regexp_replace(text, r"\p{Lu}+", ""))).cast("long").alias("n_capitals"),
        without("!?").cast("long").alias("n_marks"),
    )
    rows = rows.withColumn("_windows", _windows(F.col("_words")))
    windows = F.col("_windows")
    twice = F.filter(
        windows,
        lambda w, k: w["h"].eqNullSafe(F.get(windows, k - 1)["h"]) | w["h"].eqNullSafe(F.get(windows, k + 1)["h"]),
    )
    rows = rows.withColumn("_twice", F.sort_array(F.transform(twice, lambda w: w["i"])))
    measures = F.struct(
        F.size("_words").cast("long").alias("n_words"),
        "word_chars",
        "n_symbols",
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        _covered(F.col("_twice")).alias("n_repeat_words"),
        F.size("_lines").cast("long").alias("n_lines"),
        "n_capitals",
        "n_marks",
    )
    # Out of an array of one: a later filter on a measure is not pushed below this, where
    # it would work out all windows again for each of them.
    return rows.select("_doc", F.inline(F.array(measures)))


def base_failed() -> Column:
    """The fixed rules: too few words, or too many of them in repeated windows."""
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )


def _scores() -> dict[str, Column]:
    """For each rule the number that is bad above its cutoff."""
    chars = F.greatest(F.col("word_chars"), F.lit(1))
    return {
        "symbols": F.col("n_symbols") / chars,
        "capitals": F.col("n_capitals") / chars,
        "marks": F.col("n_marks") / chars,
        "repeated_lines": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)),
        "repeated_words": F.col("n_repeat_words") / F.greatest(F.col("n_words"), F.lit(1)),
    }


def stratum() -> Column:
    """The group within which false rejections are limited: the document's ``lang``."""
    return F.coalesce(F.col("_doc.lang").cast("string"), F.lit(""))


# --- cutoffs ----------------------------------------------------------------


def binomial_at_most(k: Column, n: Column, p: Column) -> Column:
    """P(X <= k) for X binomial (n, p), summed exactly; 1 from the mean upwards, where it cannot matter.

    The terms follow from each other, as logarithms, so that large n do not underflow.
    """
    odds = F.log(p) - F.log1p(-p)
    first = n * F.log1p(-p)
    begin = F.struct(first.alias("term"), first.alias("total"))

    def add(state: Column, j: Column) -> Column:
        term = state["term"] + F.log(n - j + 1) - F.log(j.cast("double")) + odds
        high = F.greatest(term, state["total"])
        total = high + F.log1p(F.exp(F.least(term, state["total"]) - high))
        return F.struct(term.alias("term"), total.alias("total"))

    steps = F.when(k >= 1, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<long>"))
    summed = F.exp(F.aggregate(steps, begin, add, lambda state: state["total"]))
    return F.when((n == 0) | (k >= n * p), F.lit(1.0)).otherwise(F.least(summed, F.lit(1.0)))


def certified(found: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """Every stratum, rule and cutoff with its counts, p-value and whether it is certified.

    ``found`` comes from ``measured``. Labelled documents that pass the fixed rules are
    the holdout: nothing was fitted on them. A document is good if none of its labels has
    quality 0; NULL labels do not count.

    A cutoff is false for a stratum if it rejects more than ``alpha`` divided by the number
    of rules of its good documents. The p-value is the exact binomial chance of seeing so
    few rejections if it were. Cutoffs of a rule are tested from lenient to strict, up
    to the first that fails, so they need no correction among each other; rules
    and strata share ``delta`` equally (Bonferroni).
    """
    graded = labels.where("quality IS NOT NULL AND doc_id IS NOT NULL").groupBy(
        F.col("doc_id").alias("_id")
    ).agg((F.min("quality") > 0).alias("good"))
    scores = F.array(*[F.struct(F.lit(r).alias("rule"), s.alias("score")) for r, s in _scores().items()])
    held = (
        found.where(~base_failed())
        .select(F.col("_doc.doc_id").alias("_id"), stratum().alias("stratum"), scores.alias("scores"))
        .join(graded, "_id")
    )
    totals = held.groupBy("stratum").agg(
        F.count_if("good").alias("n_good"), F.count_if(~F.col("good")).alias("n_bad")
    )
    grid = F.array(
        *[
            F.struct(F.lit(r).alias("rule"), F.lit(k).alias("step"), F.lit(float(c)).alias("cutoff"))
            for r, values in CUTOFFS.items()
            for k, c in enumerate(values)
        ]
    )
    above = (
        held.select("stratum", "good", F.explode("scores").alias("s"))
        .select("stratum", "good", F.explode(F.filter(grid, lambda g: (g["rule"] == F.col("s.rule")) & (F.col("s.score") > g["cutoff"]))).alias("g"))
        .groupBy("stratum", "g.rule", "g.step")
        .agg(F.count_if("good").alias("k_good"), F.count_if(~F.col("good")).alias("k_bad"))
    )
    tried = totals.select("*", F.explode(grid).alias("g")).select("stratum", "n_good", "n_bad", "g.*")
    tried = tried.join(above, ["stratum", "rule", "step"], "left").fillna(0, ["k_good", "k_bad"])
    p = binomial_at_most(F.col("k_good"), F.col("n_good"), F.lit(alpha / len(CUTOFFS)))
    strata = F.count(F.lit(1)).over(Window.partitionBy("rule", "step"))
    tried = tried.withColumn("p_value", p).withColumn("level", F.lit(delta / len(CUTOFFS)) / strata)
    so_far = Window.partitionBy("stratum", "rule").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    return tried.withColumn("certified", F.max(F.col("p_value") > F.col("level")).over(so_far) == F.lit(False))


def cutoffs(tried: DataFrame) -> DataFrame:
    """(``stratum``, ``limits``): for each stratum a map from rule to the cutoff it uses.

    Of the certified cutoffs the one is used that best tells bad from good documents, by
    the share of bad ones rejected less that of good ones; the most
    lenient of equals. A rule that rejects no larger share of bad documents is not used.
    """
    gain = F.col("k_bad") / F.greatest(F.col("n_bad"), F.lit(1)) - F.col("k_good") / F.greatest(
        F.col("n_good"), F.lit(1)
    )
    best = tried.where("certified").withColumn("gain", gain).where("gain > 0").groupBy("stratum", "rule").agg(
        F.max(F.struct("gain", (-F.col("step")).alias("first"), "cutoff")).alias("best")
    )
    return best.groupBy("stratum").agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("rule", "best.cutoff")))).alias("limits")
    )


def _verdict(found: DataFrame, limits: DataFrame) -> DataFrame:
    """``found`` with ``base_failed`` and ``kept``, by the cutoffs of each row's stratum."""
    broken = [
        F.coalesce(score > F.element_at("limits", F.lit(rule)), F.lit(False)) for rule, score in _scores().items()
    ]
    rejected = reduce(or_, broken)
    rows = found.withColumn("_own", stratum()).join(limits, F.col("_own") == F.col("_stratum"), "left")
    return rows.select(
        "_doc", *MEASURES, base_failed().alias("base_failed"), (~base_failed() & ~rejected).alias("kept")
    )


def _calibrated(docs: DataFrame, labels: DataFrame, alpha: float, delta: float) -> tuple[DataFrame, DataFrame]:
    """The stored measures, without texts, and the stored cutoffs.

    The table of cutoffs has one row per stratum and is stored so that Spark knows
    its size when it chooses the join.
    """
    staging = Staging(docs.sparkSession)
    found = staging.keep(measured(docs, ["doc_id", "lang"]), "measures")
    limits = staging.keep(cutoffs(certified(found, labels, alpha, delta)), "cutoffs")
    return found, limits.withColumnRenamed("stratum", "_stratum")


def judged(docs: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """The measures of every row with ``base_failed`` and ``kept``; ``_doc`` has its ``doc_id`` and ``lang``.

    A document is kept if it passes the fixed rules and stays within the cutoffs of its
    stratum. Strata without enough labelled good documents, and all of them if there are no
    labels, get no cutoffs. Repeated rows stay, each with the same verdict; a NULL or
    empty text fails for its number of words. An empty table gives no rows, and columns but those named here are not looked at.
    """
    return _verdict(*_calibrated(docs, labels, alpha, delta))


def good_documents(docs: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """The rows that ``judged`` keeps, with all their columns. Texts are read twice: for cutoffs and for verdicts."""
    _, limits = _calibrated(docs, labels, alpha, delta)
    return _verdict(measured(docs), limits).where("kept").select("_doc.*")
