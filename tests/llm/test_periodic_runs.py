"""Runs of words against brute force, with awkward rows."""

from __future__ import annotations

import hashlib
import random
import re
import time
import zlib
from fractions import Fraction

import numpy as np
import pandas as pd
import pytest

from starmart.llm import periodic_runs, queries

WORD = "[^\x20\x09-\x0d]+"


def runs_of(words) -> list[tuple]:
    """All runs by comparing words at every distance."""
    n, out = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            s, e = i, j + q
            if j > i and e - s >= max(6, 4 * q):
                if not any(q % d == 0 and all(words[t] == words[t + d] for t in range(s, e - d)) for d in range(1, q)):
                    out.append((s, e - s, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def kept_of(words, runs) -> str:
    dropped = {k for s, length, q in runs for k in range(s + q, s + length)}
    return " ".join(w for k, w in enumerate(words) if k not in dropped)


def draw_words(rnd: random.Random) -> list[str]:
    words: list[str] = []
    for _ in range(rnd.randint(0, 6)):
        base = [rnd.choice("abc"[: rnd.randint(1, 3)]) for _ in range(rnd.randint(1, 12))]
        words += (base * rnd.randint(1, 9))[: rnd.randint(1, 80)]
    return words


def test_runs_equal_brute_force():
    rnd = random.Random(11)
    for _ in range(400):
        texts = [draw_words(rnd) for _ in range(rnd.randint(1, 5))]
        flat = np.array([ord(w) for t in texts for w in t], np.int64)
        found = list(zip(*(v.tolist() for v in periodic_runs.found_runs(flat, np.array([len(t) for t in texts])))))
        expected, before = [], 0
        for t in texts:
            expected += [(s + before, length, q) for s, length, q in runs_of(t)]
            before += len(t)
        assert found == expected


def test_range_successors():
    rnd = np.random.default_rng(4)
    values = rnd.permutation(300)
    matrix = periodic_runs.WaveletMatrix(values, 9)
    left = rnd.integers(0, 300, 500)
    right = np.minimum(300, left + rnd.integers(0, 60, 500))
    x = rnd.integers(0, 300, 500)
    expected = [min((v for v in values[a:b] if v >= k), default=-1) for a, b, k in zip(left, right, x)]
    assert matrix.successor(left, right, x).tolist() == expected


SCHEMA = "doc_id long, text string, runs string, start int, best int, n_words long, `a.b` int"


@pytest.fixture(scope="module")
def docs(spark):
    rnd = random.Random(7)
    rows = [(k, rnd.choice([" ", "\n", "\t  "]).join(draw_words(rnd))) for k in range(120)]
    rows += [(200, None), (201, ""), (202, " \n "), (None, "x y " * 30), (203, "one"), (204, "same " * 9), (204, "same " * 9), (205, "é漢 🙂 " * 8 + " end")]
    rows += [(206, " ".join(rnd.choice("abcdefgh") for _ in range(3000))), (207, "the cat sat " * 2000)]
    return spark.createDataFrame([(i, t, "r", 1, 2, 3, 4) for i, t in rows], SCHEMA).repartition(3)


def test_texts_with_runs(docs):
    found = periodic_runs.collapsed(docs)
    assert found.columns == ["doc_id", "n_words", "runs", "best", "collapsed"]
    got, expected = [], []
    for r in found.collect():
        got.append((r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["best"], r["collapsed"]))
    for r in docs.collect():
        words = re.findall(WORD, r["text"] or "")
        runs = runs_of(words)
        best = min(range(len(runs)), key=lambda k: (-Fraction(runs[k][1], runs[k][2]), runs[k][0], runs[k][2]), default=None)
        expected.append((r["doc_id"], len(words), runs, best, kept_of(words, runs)))
    assert sorted(map(str, got)) == sorted(map(str, expected))


def test_no_texts(docs):
    assert periodic_runs.digest(periodic_runs.collapsed(docs.limit(0))).collect() == []


def planted(doc_id, text):
    words = re.findall(WORD, text or "")
    if doc_id is not None and words:
        h = zlib.crc32(str(doc_id).encode())
        g, n = h // 10, len(words)
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


def test_query_equals_brute_force(spark):
    """Every document of the smallest table, planted repeats included."""
    sf = "/root/testdata/sf0.001"
    expected = []
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        words = planted(r["doc_id"], r["text"])
        runs = runs_of(words)
        best = min(runs, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2]), default=None)
        lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
        expected.append(
            (r["doc_id"], len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None)
            + tuple(hashlib.sha256(t.encode()).hexdigest() for t in (lines, kept_of(words, runs)))
        )
    out = queries.op12_periodic_runs(spark, sf)
    names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted(tuple(r[n] for n in names) for r in out.collect()) == sorted(expected)
    assert sum(e[1] > 0 for e in expected) > 5


def test_long_texts_take_linear_time():
    rnd = random.Random(1)
    text = " ".join(["a b c"] * 50_000 + [rnd.choice("abcdefghij") for _ in range(150_000)])
    began = time.time()
    out = periodic_runs._searched(pd.DataFrame({"doc_id": [1], "text": [text]}))
    assert time.time() - began < 20 and out["runs"][0][0]["length"] >= 150_000
