"""Runs of words that repeat with a period, found by occurrences of dyadic blocks near themselves."""

from __future__ import annotations

import re
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from starmart.llm.shared import slices

REPEATS = 4  # a run is at least so many periods long
LEAST = 6  # and so many words
CHARS = 1_000_000  # of texts that are searched together
WORD = re.compile("[^\x20\x09-\x0d]+")

RESULT = "n_words long, runs array<struct<start: long, length: long, period: long>>, best int, collapsed string"


class WaveletMatrix:
    """Values by position, for the next larger value within a range of positions."""

    def __init__(self, values: np.ndarray, bits: int):
        self.bits, self.zeros = bits, []  # per bit, from the highest: zeros before each position, and all
        for bit in range(bits - 1, -1, -1):
            zero = (values >> bit) & 1 == 0
            self.zeros.append(np.concatenate([[0], np.cumsum(zero)]).astype(np.int32))
            values = np.concatenate([values[zero], values[~zero]])

    def _steps(self, left: np.ndarray, right: np.ndarray):
        return ((bit, z[left], z[right], z[-1]) for bit, z in zip(range(self.bits - 1, -1, -1), self.zeros))

    def below(self, left: np.ndarray, right: np.ndarray, x: np.ndarray) -> np.ndarray:
        """How many values of each range are less than x."""
        count = np.zeros(len(left), np.int32)
        for bit, z in zip(range(self.bits - 1, -1, -1), self.zeros):
            a, b, one = z[left], z[right], (x >> bit) & 1 == 1
            count += np.where(one, b - a, 0)
            left, right = np.where(one, z[-1] + left - a, a), np.where(one, z[-1] + right - b, b)
        return count

    def nth(self, left: np.ndarray, right: np.ndarray, n: np.ndarray) -> np.ndarray:
        """The value of each range with ``n`` smaller ones before it in order."""
        value = np.zeros(len(left), np.int64)
        for bit, z in zip(range(self.bits - 1, -1, -1), self.zeros):
            a, b = z[left], z[right]
            one = n >= b - a
            n = np.where(one, n - (b - a), n)
            value |= one.astype(np.int64) << bit
            left, right = np.where(one, z[-1] + left - a, a), np.where(one, z[-1] + right - b, b)
        return value

    def successor(self, left: np.ndarray, right: np.ndarray, x: np.ndarray) -> np.ndarray:
        """The least value of each range that is x or more, or -1."""
        n = self.below(left, right, x)
        some = n < right - left
        found = np.full(len(left), -1, np.int64)
        found[some] = self.nth(left[some], right[some], n[some])
        return found


class Factors:
    """Names of all stretches of 2, 4, 8 ... words of several texts, and the suffix array that they sort.

    ``first`` is where the text of a word begins and ``end`` where it ends. A name is the first place in the
    suffix array of the suffixes that begin with the stretch, so equal names mean equal stretches
    of one text. A stretch that would pass the text's end is cut there and equals no other.
    """

    def __init__(self, words: np.ndarray, first: np.ndarray, end: np.ndarray):
        n = len(words)
        self.first, self.end = first, end
        key = first * (int(words.max(initial=0)) + 1) + words  # words of different texts are different
        self.suffixes = np.argsort(key, kind="stable")
        own = key[self.suffixes]
        fresh = np.concatenate([[True], own[1:] != own[:-1]])[:n]
        name = np.empty(n, np.int64)
        name[self.suffixes] = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
        self.names, self.sizes = [name], [np.bincount(name, minlength=n)]
        longest = int((end - first).max(initial=0))
        while 2 ** len(self.names) <= longest // REPEATS and self.sizes[-1].max(initial=0) > 1:
            self._double()

    def _double(self) -> None:
        """From the names of stretches of 2^k words those of twice as many."""
        name, sizes, step, n = self.names[-1], self.sizes[-1], 2 ** (len(self.names) - 1), len(self.first)
        slots = np.flatnonzero(sizes[name[self.suffixes]] > 1)  # what is alone keeps its place
        at = self.suffixes[slots]
        after = np.minimum(at + step, n - 1)
        key = name[at] * (n + 1) + np.where(at + step < self.end[at], name[after] + 1, 0)
        order = np.argsort(key, kind="stable")
        key, at = key[order], at[order]
        self.suffixes[slots] = at
        fresh = np.concatenate([[True], key[1:] != key[:-1]])
        name = name.copy()
        name[at] = slots[np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))]
        self.names.append(name)
        self.sizes.append(np.bincount(name, minlength=n))

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words from i on equal those from j on, i < j in one text."""
        return self._reach(i, j, 1)

    def common_before(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words before i equal those before j."""
        return self._reach(i, j, -1)

    def _reach(self, i: np.ndarray, j: np.ndarray, way: int) -> np.ndarray:
        """Longest stretches first. The longest is tried until it fits nowhere."""
        got, top = np.zeros(len(i), np.int64), len(self.names) - 1
        first, end = self.first[i], self.end[i]
        for level in range(top, -1, -1):
            step, open_ = 2**level, np.arange(len(i))
            while len(open_):
                a, b = i[open_] + way * got[open_], j[open_] + way * got[open_]
                if way < 0:
                    a, b = a - step, b - step
                fits = (a >= first[open_]) & (b + step <= end[open_])
                open_, a, b = open_[fits], a[fits], b[fits]
                open_ = open_[self.names[level][a] == self.names[level][b]]
                got[open_] += step
                if level < top:
                    break
        return got


def _candidates(found: Factors) -> tuple[np.ndarray, np.ndarray]:
    """(place, period) pairs among which is one for each run, at a place within it.

    A run with least period q has, in its first q words, the beginning of a block of L = 2^k <= q words at a
    multiple of L, for q < 2 L. The block occurs again q words further, and so L to 2 L - 1 words further. Occurrences that
    begin in so short a window are one, two, or a progression by the block's own period. Then
    the block and its occurrences lie in two stretches of that period, which end q apart.
    """
    start = np.arange(len(found.first)) - found.first  # word numbers within texts
    matrix = WaveletMatrix(start[found.suffixes], max(1, int(start.max(initial=0)).bit_length()))
    parts = []
    for level, (name, sizes) in enumerate(zip(found.names, found.sizes)):
        size = 2**level
        fewest = LEAST if level == 0 else REPEATS - 1  # occurrences of a block of a run
        block = np.flatnonzero((start % size == 0) & (start + 2 * size <= found.end - found.first) & (sizes[name] >= fewest))
        left, right = name[block], name[block] + sizes[name[block]]
        hits = []
        for _ in range(3):
            least = start[block] + size if not hits else hits[-1] + 1
            inside = (least > 0) & (least < start[block] + 2 * size)
            hit = np.full(len(block), -1, np.int64)
            hit[inside] = matrix.successor(left[inside], right[inside], least[inside])
            hits.append(np.where(hit < start[block] + 2 * size, hit, -1))
            if not hits[0].max(initial=-1) >= 0:
                break
            some = hits[0] >= 0
            block, left, right, hits = block[some], left[some], right[some], [h[some] for h in hits]
        if not len(block) or hits[0].max(initial=-1) < 0:
            continue
        one, two, three = hits
        few = three < 0
        parts += [(block[few], (one - start[block])[few]), (block[few & (two >= 0)], (two - start[block])[few & (two >= 0)])]
        many = np.flatnonzero(~few)
        here, there = block[many], found.first[block[many]] + one[many]
        own = two[many] - one[many]
        period = (there + found.common(there, there + own)) - (here + found.common(here, here + own))
        right_size = (period >= size) & (period < 2 * size)
        parts.append((here[right_size], period[right_size]))
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(p) for p in zip(*parts))


def found_runs(words: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all runs in word numbers from 0 over all texts; ``texts`` has the number of words of each."""
    ends = np.cumsum(texts)
    first, end = np.repeat(ends - texts, texts), np.repeat(ends, texts)
    if not len(words):
        return tuple(np.zeros(0, np.int64) for _ in range(3))
    found = Factors(words, first, end)
    at, period = _candidates(found)
    start = at - found.common_before(at, at + period)
    length = at + period + found.common(at, at + period) - start
    long = length >= np.maximum(LEAST, REPEATS * period)
    start, length, period = start[long], length[long], period[long]
    order = np.lexsort((period, length, start))  # a stretch may come with multiples of its period
    start, length, period = start[order], length[order], period[order]
    least = np.concatenate([[True], (start[1:] != start[:-1]) | (length[1:] != length[:-1])])[: len(start)]
    start, length, period = start[least], length[least], period[least]
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def _searched(part: pd.DataFrame) -> pd.DataFrame:
    split = [WORD.findall(t) if t else [] for t in part["text"]]
    sizes = np.array([len(w) for w in split], np.int64)
    ids = pd.factorize(np.array([w for words in split for w in words], object))[0].astype(np.int64)
    start, length, period = found_runs(ids, sizes)
    change = np.zeros(len(ids) + 1, np.int64)  # where words are dropped, from and to
    np.add.at(change, start + period, 1)
    np.add.at(change, start + length, -1)
    kept = np.cumsum(change)[:-1] == 0
    ends = np.cumsum(sizes)
    text = np.searchsorted(ends, start, side="right")
    bounds = np.searchsorted(text, np.arange(len(split) + 1))
    rows = []
    for k, words in enumerate(split):
        a, b, before = bounds[k], bounds[k + 1], ends[k] - sizes[k]
        runs = list(zip((start[a:b] - before).tolist(), length[a:b].tolist(), period[a:b].tolist()))
        best = min(range(len(runs)), key=lambda r: (-Fraction(runs[r][1], runs[r][2]), runs[r][0], runs[r][2]), default=None)
        left = words if not runs else [w for w, keep in zip(words, kept[before : ends[k]]) if keep]
        rows.append((len(words), [dict(zip(("start", "length", "period"), r)) for r in runs], best, " ".join(left)))
    made = pd.DataFrame(rows, columns=["n_words", "runs", "best", "collapsed"]).astype({"best": "Int32"})
    return made.assign(doc_id=part["doc_id"].astype("Int64"))


def collapsed(docs: DataFrame) -> DataFrame:
    """(``doc_id``, ``n_words``, ``runs``, ``best``, ``collapsed``) of every whole text of ``docs``.

    Words are what ``WORD`` finds, numbered from 0. A run is a stretch of words in which words ``period`` apart are the same, for no
    smaller period, which no neighbouring word extends, and which has ``LEAST`` words and ``REPEATS`` periods or more. ``runs``
    are in order of start and period; ``best`` is the place among them of the one with the greatest length by period, then the
    smallest start and period, or NULL. ``collapsed`` joins the words by a space, without those that a run
    contains after its first period.

    A NULL or empty text has no words, no runs and the collapsed text ''. Rows that repeat an id stay,
    as do rows without; an empty table gives no rows; other columns are not looked at. A text is never cut: one longer than ``CHARS`` is
    searched by itself, others together. Memory grows with the longest text.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from slices(_searched, "text", CHARS)(batches)

    return rows.mapInPandas(run, f"doc_id long, {RESULT}")


def planted(doc_id: Column, text: Column) -> Column:
    """The text with the repeats that the contract of the query plants in a tenth of the documents."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10).cast("long")
    words = F.regexp_extract_all(text, F.lit("([^\\x20\\x09-\\x0D]+)"), F.lit(1))

    def changed(w: Column) -> Column:
        n = F.size(w).cast("long")
        a = F.pmod(g, n)
        p = F.floor((n - a) / (F.pmod(g, F.lit(8)) + 3)).cast("long") + 1
        place = F.sequence(F.lit(0).cast("long"), n - 1)
        repeated = F.transform(place, lambda i: F.get(w, F.when(i < a, i).otherwise(a + F.pmod(i - a, p)).cast("int")))
        return F.array_join(repeated, " ")

    chosen = F.coalesce(h % 10 == 0, F.lit(False)) & F.coalesce(F.size(words) > 0, F.lit(False))
    return F.when(chosen, F.element_at(F.transform(F.array(words), changed), 1)).otherwise(text)


def digest(found: DataFrame) -> DataFrame:
    """The columns of the query, from ``collapsed``."""
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    best = F.get("runs", F.col("best"))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *[best[c].alias(c) for c in ("start", "length", "period")],
        F.expr("(1000 * get(runs, best).length) div get(runs, best).period").alias("exponent_milli"),
        F.sha2(F.concat(F.array_join(F.transform(lines, lambda s: F.concat(s, F.lit("\n"))), "")).cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
        "n_words",
    )
