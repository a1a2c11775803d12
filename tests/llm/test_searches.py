"""Exact search and hard negatives against brute force, with awkward rows, and against their SQL."""

from __future__ import annotations

import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from starmart.llm import hard_negatives, integer_blocks, queries, segment_search

SCHEMA = "vec_id long, embedding array<double>, label int, row long, id long, score double, `a.b` int, dim int, x string"
LONG = 2**63 - 1


def awkward() -> list[tuple]:
    draw = np.random.default_rng(3)
    groups = draw.normal(size=(6, 12))
    rows = [(k, (groups[k % 6] + draw.normal(size=12) * 0.3).tolist(), k % 6) for k in range(300)]
    same = rows[100][1]
    rows += [(400 + k, same, k % 2) for k in range(120)]  # ties
    rows += [
        (50, rows[7][1], 1),  # repeats an id
        (350, None, 1),
        (550, [0.0] * 12, 2),
        (600, [None, *same[1:]], 2),
        (650, [float("nan"), *same[1:]], 2),
        (700, [float("inf"), *same[1:]], 2),
        (750, [1.0, 2.0], 3),  # another length
        (751, [2.0, 1.0], 3),
        (752, [1.5, 1.0], 4),
        (800, [], 3),
        (801, [], 3),
        (900, [1e9] * 12, 5),
        (901, [-1e9] * 12, 5),
        (902, [1.7e308, *same[1:]], 5),  # its multiple is not finite
        (None, same, 1),
        (1000, same, None),
    ]
    return rows


@pytest.fixture(scope="module")
def vectors(spark):
    return spark.createDataFrame([(i, v, lab, 1, 2, 0.5, 3, 4, "x") for i, v, lab in awkward()], SCHEMA).repartition(5)


def usable(rows):
    return [(i, [math.floor(256 * x) for x in v], lab) for i, v, lab in rows if v is not None and all(x is not None and math.isfinite(256 * x) for x in v)]


def product(a, b):
    return max(-LONG, min(LONG, sum(p * q for p, q in zip(a, b))))


def ordered(row, rows):
    """All other rows of the same length: (score, id, label), best first."""
    found = [(product(row[1], r[1]), r[0], r[2]) for r in rows if r is not row and len(r[1]) == len(row[1])]
    return sorted(found, key=lambda f: (-f[0], f[1] is None, f[1] or 0))


def by_text(rows):
    return sorted(map(str, rows))


def test_search_equals_brute_force(vectors):
    rows = usable(awkward())
    out = segment_search.searched(vectors, F.col("id") % 50 == 0)
    expected = []
    for row in rows:
        if row[0] is not None and row[0] % 50 == 0:
            expected += [(row[0], k + 1, i, s) for k, (s, i, _) in enumerate(ordered(row, rows)[:5])]
    assert by_text(tuple(r) for r in out.collect()) == by_text(expected)
    assert out.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "bigint")]


def test_search_by_many_small_blocks(vectors, monkeypatch):
    """The same rows whatever the blocks, tiles and sample are."""
    whole = by_text(segment_search.searched(vectors, F.col("id") % 10 == 0, best=7).collect())
    monkeypatch.setattr(integer_blocks, "BLOCK_BYTES", 12 * 8 * 60)
    monkeypatch.setattr(integer_blocks, "LEAST_BLOCK", 1)
    monkeypatch.setattr(segment_search, "SAMPLE", 3)
    assert by_text(segment_search.searched(vectors, F.col("id") % 10 == 0, best=7).collect()) == whole


def test_segments_bound_products():
    draw = np.random.default_rng(1)
    for dim in (1, 2, 3, 7, 64):
        a, b = (np.floor(draw.normal(size=(40, dim)) * 300) for _ in range(2))
        exact = a @ b.T
        bounds = [segment_search.statistics(a, s) @ segment_search.statistics(b, s).T for s in segment_search.SEGMENTS]
        for coarse, fine in zip(bounds, bounds[1:]):
            assert (fine <= coarse + 1e-6 * np.abs(coarse)).all()
        assert (exact <= bounds[-1] + 1e-6 * np.abs(bounds[-1])).all()
    assert np.allclose(segment_search.statistics(a, 1) @ segment_search.statistics(b, 1).T, exact)


def test_bounds_spare_most_products():
    """Of near neighbours and far rows only few pairs are left to multiply."""
    draw = np.random.default_rng(2)
    x = np.floor(256 * (np.repeat(draw.normal(size=(40, 64)), 50, axis=0) + draw.normal(size=(2000, 64)) * 0.1))
    q, need = x[::50], np.sort(x[::50] @ x.T, axis=1)[:, -6]
    levels = [[segment_search.statistics(m, s) for s in segment_search.SEGMENTS] for m in (q, x)]
    bounds = [a @ b.T >= need[:, None] for a, b in zip(*levels)]
    assert bounds[-1].mean() < 0.1 and bounds[0].mean() < 0.9
    a, b, product = segment_search.survivors([*levels[0], q], [*levels[1], x], need)
    exact = q @ x.T
    assert sorted(zip(a, b)) == sorted(zip(*np.nonzero(exact >= need[:, None]))) and (product == exact[a, b]).all()


def test_negatives_equal_brute_force(vectors):
    rows = [r for r in usable(awkward()) if r[2] is not None]
    out = hard_negatives.mined(vectors, F.col("id") % 20 == 0)
    expected = []
    for row in rows:
        if row[0] is None or row[0] % 20:
            continue
        others = ordered(row, rows)
        for score, positive, _ in [f for f in others if f[2] == row[2]][:5]:
            window = [f for f in others if f[2] != row[2] and 30 * score <= 100 * f[0] <= 90 * score]
            expected += [(row[0], positive, k + 1, i, score, s) for k, (s, i, _) in enumerate(window[:10])]
    assert len(expected) > 500 and by_text(tuple(r) for r in out.collect()) == by_text(expected)


def test_negatives_by_many_small_blocks(vectors, monkeypatch):
    whole = by_text(hard_negatives.mined(vectors, F.col("id") % 20 == 0).collect())
    monkeypatch.setattr(integer_blocks, "BLOCK_BYTES", 12 * 8 * 60)
    monkeypatch.setattr(integer_blocks, "LEAST_BLOCK", 1)
    assert by_text(hard_negatives.mined(vectors, F.col("id") % 20 == 0).collect()) == whole


def test_nothing_to_search(spark, vectors):
    nothing = vectors.limit(0)
    assert segment_search.searched(nothing, F.col("id") % 50 == 0).collect() == []
    assert hard_negatives.mined(nothing, F.col("id") % 100 == 0).collect() == []
    alone = spark.createDataFrame([(100, [1.0, 2.0], 1)], "vec_id long, embedding array<float>, label int")
    assert segment_search.searched(alone, F.col("id") % 50 == 0).collect() == []
    assert hard_negatives.mined(alone, F.col("id") % 100 == 0).collect() == []


def test_window_of_a_positive_of_zero_or_less(spark):
    rows = [(100, [1.0, 0.0], 1), (1, [0.0, 1.0], 1), (2, [-1.0, 0.0], 1), (3, [0.0, 2.0], 2), (4, [-0.5, 0.0], 2), (5, [1.0, 0.0], 2)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    out = [tuple(r) for r in hard_negatives.mined(frame, F.col("id") % 100 == 0).collect()]
    assert out == [(100, 1, 1, 3, 0, 0)]


@pytest.mark.parametrize("name", ["op11_segment_search", "op13_hard_negatives"])
def test_searches_equal_their_sql(spark, name):
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf}/embeddings.parquet'")
    expected = con.execute(queries.ORACLES[name])
    columns = [c[0] for c in expected.description]
    found = queries.QUERIES[name](spark, sf)
    assert found.columns == columns
    assert sorted(tuple(r) for r in found.collect()) == sorted(expected.fetchall())
