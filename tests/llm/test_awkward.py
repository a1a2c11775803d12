"""Columns of any name, and texts of great length, in every operator on documents."""

from __future__ import annotations

import hashlib
import time

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from starmart.llm import bpe, language, licences, packing, periodic_runs, quality_ranker, quality_rules, secret_scan, shared, simhash, unit_dedup
from test_operators import docs, labels, prose  # noqa: F401

import public_tokenizers

NAMES = ["last", "part", "a.b", "_doc", "root", "value", "removed", "clean", "spans", "pieces", "order", "_text", "fp", "copy", "lang_pred", "a`b", "base"]
RANKS, TOKENIZER = (public_tokenizers.path(f"byte_bpe_50k.{x}") for x in ("tiktoken", "json"))

OPERATORS = {
    "op1": lambda d, q: quality_ranker.ranked(d, q),
    "op2": lambda d, q: unit_dedup.digest(unit_dedup.deduplicated(d)),
    "op3": lambda d, q: quality_rules.judged(d, q).select("_doc.doc_id", *quality_rules.MEASURES, "base_failed", "kept"),
    "op4": lambda d, q: simhash.near_duplicates(d),
    "op5": lambda d, q: licences.digest(licences.licensed(d)),
    "op6": lambda d, q: language.identified(d),
    "op7": lambda d, q: secret_scan.digest(secret_scan.scanned(d)),
    "op8": lambda d, q: packing.pieces(d, TOKENIZER, keep_ids=False),
    "op9": lambda d, q: bpe.digested(d, RANKS, public_tokenizers.PATTERN),
    "op12": lambda d, q: periodic_runs.digest(periodic_runs.collapsed(d)),
}
STAGES = {
    "quality": lambda d, q: quality_rules.good_documents(d, q),
    "near duplicates": lambda d, q: simhash.one_per_group(d),
    "repeats": lambda d, q: unit_dedup.cleaned(d),
    "secrets": lambda d, q: secret_scan.redacted(d),
}


@pytest.fixture(scope="module")
def odd(spark, docs, tmp_path_factory):  # noqa: F811
    """The documents with further columns, each named like something an operator works with."""
    own = ["doc_id", "text", "lang", "source", "n_chars"]
    path = str(tmp_path_factory.mktemp("odd"))
    docs.select(*own).write.parquet(f"{path}/plain")
    plain = spark.read.parquet(f"{path}/plain")
    extra = [F.lit(k).alias(n) if k % 2 else F.struct(F.lit("x").alias("start")).alias(n) for k, n in enumerate(NAMES)]
    plain.select(*own, *extra).write.parquet(f"{path}/odd")
    return plain, spark.read.parquet(f"{path}/odd")


def rows_of(df):
    return sorted(str(tuple(r)) for r in df.collect())


@pytest.mark.parametrize("name", OPERATORS)
def test_columns_of_any_name_change_nothing(odd, labels, name):  # noqa: F811
    plain, named = odd
    assert rows_of(OPERATORS[name](named, labels)) == rows_of(OPERATORS[name](plain, labels))


@pytest.mark.parametrize("name", STAGES)
def test_stages_return_the_columns_they_got(odd, labels, name):  # noqa: F811
    plain, named = odd
    out = STAGES[name](named, labels)
    assert out.dtypes == named.dtypes
    assert rows_of(out.select(*plain.columns)) == rows_of(STAGES[name](plain, labels))


def test_pipeline_with_columns_of_any_name(odd, labels, tmp_path, spark):  # noqa: F811
    plain, named = odd
    for folder, df in (("a", plain), ("b", named)):
        df.write.parquet(f"{tmp_path}/{folder}/documents.parquet")
        labels.write.parquet(f"{tmp_path}/{folder}/labels.parquet")
    a, b = (corpus_pipeline.run(spark, f"{tmp_path}/{x}").drop("sequence_id", "offset") for x in "ab")
    assert rows_of(a) == rows_of(b)


def test_running_sums_equal_plain_ones(spark, monkeypatch):
    values = [[], [3], list(range(-5, 20)), [7] * 299, [1] * 300, list(range(301)), [(k * 37) % 11 for k in range(2000)]]
    frame = spark.createDataFrame([(v,) for v in values], "v array<int>")
    for r in frame.select("v", shared.running_sums(F.col("v")).alias("s"), shared.running_most(F.col("v")).alias("m")).collect():
        assert r["s"] == [sum(r["v"][: k + 1]) for k in range(len(r["v"]))]
        assert r["m"] == [max([0, *r["v"][: k + 1]]) for k in range(len(r["v"]))]


def timed(work):
    began = time.time()
    return work(), time.time() - began


@pytest.fixture(scope="module")
def long_text():
    """100 000 lines, of which every tenth repeats one of a hundred."""
    common = [prose(k, 9).replace("\n", " ") for k in range(100)]
    return "\n".join(common[k // 10 % 100] if k % 10 == 0 else f"line {k} with its own words and number {k * 7} here." for k in range(100_000))


def test_long_texts_lose_their_repeats_in_time(spark, long_text):
    lines = long_text.split("\n")
    frame = spark.createDataFrame([(1, long_text)], "doc_id long, text string").coalesce(1)
    unit_dedup.deduplicated(frame.limit(0)).collect()
    (row,), took = timed(lambda: unit_dedup.deduplicated(frame).select("removed", "clean").collect())
    assert took < 60
    seen, kept = set(), []
    for line in lines:
        again = line in seen and len(unit_words(line)) >= 8
        kept.append("" if again else line)
        seen.add(line)
    assert row["clean"] == "\n".join(kept)
    assert all(long_text[s["start"] : s["end"]] in seen for s in row["removed"][:200])


def unit_words(line):
    return "".join(c.lower() if c.isalnum() else " " for c in line).split()


def test_long_texts_are_searched_for_licences_in_time(spark, long_text):
    text = long_text + "\nReleased under the MIT License."
    frame = spark.createDataFrame([(1, text)], "doc_id long, text string").coalesce(1)
    (row,), took = timed(lambda: licences.digest(licences.licensed(frame)).collect())
    assert took < 60 and row["licences"] == "MIT" and row["n_matches"] == 1
    assert text[int(row["spans"].split(":")[1]) :] == "Released under the MIT License."


def test_many_secrets_in_one_text_in_time(spark):
    parts = [f"line {k} password = {hashlib.md5(str(k).encode()).hexdigest()[:12]} and" for k in range(20_000)]
    text = "\n".join(parts)
    frame = spark.createDataFrame([(1, text, 0)], "doc_id long, text string, n_chars long").coalesce(1)
    (row,), took = timed(lambda: secret_scan.digest(secret_scan.scanned(frame)).collect())
    assert row["n_assign"] == 20_000 and took < 60
    (clean,), took = timed(lambda: secret_scan.redacted(frame).collect())
    assert clean["text"] == "\n".join(f"line {k} [SECRET] and" for k in range(20_000)) and took < 60
    assert clean["n_chars"] == len(clean["text"])


def test_spans_that_overlap_or_cross_pieces_are_redacted_once(spark, monkeypatch):
    monkeypatch.setattr(secret_scan, "PIECE", 7)
    spans = [(0, 3), (2, 5), (5, 6), (9, 30), (12, 14), (40, 41)]
    text = "".join(chr(97 + k % 26) if k % 5 else "é" for k in range(50)) + "🙂"
    schema = "text string, spans array<struct<start:int,kind:int,end:int>>"
    frame = spark.createDataFrame([(text, [(a, 0, b) for a, b in spans])], schema)
    out = frame.select(secret_scan._marked(F.col("text"), secret_scan._joined(F.col("spans")), "#").alias("t")).first()["t"]
    assert out == "#" + "#" + text[6:9] + "#" + text[30:40] + "#" + text[41:]
