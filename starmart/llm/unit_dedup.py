"""Repeated passages: lines and sentences whose text occurred earlier are taken out."""

from __future__ import annotations

from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from starmart.llm.shared import Staging, let, row_of, running_most, running_sums

MIN_WORDS = 8  # of a unit; shorter ones are never taken out
SENTENCE = r"[^.!?\n]*[.!?]+|[^.!?\n]+|\n"  # together these cover every text
LEVELS = ("line", "sentence")


def normalised(unit: Column) -> Column:
    """Lower case, one space for each run of what is neither letter nor digit."""
    return F.trim(F.regexp_replace(F.lower(unit), r"[^\p{L}\p{N}]+", " "))


def _placed(pieces: Column, level: str, gap: int) -> Column:
    """Pieces of a text, one after the other with ``gap`` characters between, as (level, start, end, plain)."""

    def place(ps: Column) -> Column:
        return F.zip_with(
            ps,
            running_sums(F.transform(ps, lambda p: F.length(p) + gap)),
            lambda p, e: F.struct(
                F.lit(level).alias("level"), (e - F.length(p) - gap).alias("start"), (e - gap).alias("end"), normalised(p).alias("plain")
            ),
        )

    return let(pieces, place)


def units(docs: DataFrame) -> DataFrame:
    """(``doc_id``, ``copy``, ``level``, ``start``, ``end``, ``digest``) of all lines and sentences with enough words.

    Offsets count code points, ends are exclusive. ``copy`` is a hash of the text: with
    the id it names a document, so rows that repeat both are one document. The
    digest is 128 bits of the normalised text and the level.
    """
    text = F.col("text")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("copy", F.xxhash64("text"))
    lines = _placed(F.split(text, "\n", -1), "line", 1)
    sentences = _placed(F.regexp_extract_all(text, F.lit(SENTENCE), F.lit(0)), "sentence", 0)
    each = rows.select("doc_id", "copy", F.explode(F.concat(lines, sentences)).alias("u")).select("doc_id", "copy", "u.*")
    each = each.where(F.size(F.split("plain", " ")) >= MIN_WORDS)
    digest = F.substring(F.unhex(F.sha2(F.concat_ws(":", "level", "plain").cast("binary"), 256)), 1, 16)
    return each.select("doc_id", "copy", "level", "start", "end", digest.alias("digest"))


def repeats(docs: DataFrame, staging: Staging | None = None) -> DataFrame:
    """The units that are not the earliest with their digest, as ``units`` gives them.

    The earliest has the smallest doc_id (NULL first), then the smallest ``copy``, then the
    smallest offset. Digests are grouped over the whole corpus after each task has
    merged its own; most units are unique and go no further. A digest that
    very many documents share is one row per task in the grouping, and in the
    join back its units are on the side that adaptive execution splits. Places and digests are
    stored, about half the size of the texts, so that texts are cut up and hashed once.
    """
    staging = staging or Staging(docs.sparkSession)
    place = F.struct("doc_id", "copy", "start")
    every = staging.keep(units(docs), "units")
    seen = every.groupBy("digest").agg(F.min(place).alias("first"), F.max(place).alias("last"))
    again = staging.keep(seen.where(~F.col("first").eqNullSafe(F.col("last"))).select("digest", "first"), "repeated")
    found = every.join(again, "digest").where(~place.eqNullSafe(F.col("first")))
    return staging.keep(found.drop("first"), "repeats")


def _merged(spans: Column) -> Column:
    """(start, end) of spans (start, -end) in order, without those that lie in an earlier one."""

    def outer(ss: Column) -> Column:
        ends = running_most(F.transform(ss, lambda s: -s["back"]))
        first = lambda tops: lambda s, i: -s["back"] > F.coalesce(F.get(tops, i - 1), F.lit(0))
        return let(ends, lambda tops: F.filter(ss, first(tops)))

    return F.transform(let(spans, outer), lambda s: F.struct(s["start"].alias("start"), (-s["back"]).alias("end")))


@F.pandas_udf(T.StringType())
def _without(text: pd.Series, starts: pd.Series, ends: pd.Series) -> pd.Series:
    """The texts outside of sorted spans that do not overlap. The end of a line that is taken out stays."""

    def left(t: str, a: Iterable[int], b: Iterable[int]) -> str:
        return "".join(t[x:y] for x, y in zip([0, *b], [*a, len(t)]))

    return pd.Series([None if t is None else left(t, a, b) for t, a, b in zip(text, starts, ends)], dtype=object)


def deduplicated(docs: DataFrame) -> DataFrame:
    """Every row as the struct ``_doc``, with ``removed`` and ``clean``.

    ``removed`` lists (start, end) of what was taken out of the original text, in
    order and without overlap; ``clean`` is the text that is left. A unit is a line, or a
    sentence within one, of ``MIN_WORDS`` words or more after normalisation; it is taken out if an
    earlier document, or an earlier place of the same one, has it. So the first copy of
    a passage stays whole. A NULL text stays NULL, rows that repeat both id and
    text are one document and get the same result, other columns stay inside ``_doc``. An empty table gives no rows.
    """
    spans = repeats(docs).groupBy("doc_id", "copy").agg(
        F.sort_array(F.collect_set(F.struct("start", (-F.col("end")).alias("back")))).alias("spans")
    )
    spans = spans.select(F.col("doc_id").alias("_id"), F.col("copy").alias("_copy"), _merged(F.col("spans")).alias("removed"))
    rows = docs.select(row_of(docs))
    rows = rows.withColumn("_text", F.col("_doc.text").cast("string"))
    here = F.col("_doc.doc_id").cast("long").eqNullSafe(F.col("_id")) & (
        F.xxhash64(F.coalesce("_text", F.lit(""))) == F.col("_copy")
    )
    none = F.array().cast("array<struct<start:int,end:int>>")
    some = F.col("removed").isNotNull()  # only texts that change go to Python
    cut = _without(F.when(some, F.col("_text")), F.col("removed.start"), F.col("removed.end"))
    clean = F.when(some, cut).otherwise(F.col("_text"))
    return rows.join(spans, here, "left").select("_doc", F.coalesce("removed", none).alias("removed"), clean.alias("clean"))


def digest(found: DataFrame) -> DataFrame:
    """One row per row of ``deduplicated``: what was removed, as ``start:end`` joined by commas, and what is left."""
    named = F.transform("removed", lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string")))
    return found.select(
        F.col("_doc.doc_id").alias("doc_id"),
        F.size("removed").cast("long").alias("n_removed"),
        F.array_join(named, ",").alias("removed"),
        F.length("clean").cast("long").alias("n_chars_left"),
        F.sha2(F.col("clean").cast("binary"), 256).alias("clean_sha256"),
    )


def cleaned(docs: DataFrame) -> DataFrame:
    """``docs`` with what is left of ``text``; ``n_chars`` follows if there is such a column. All rows stay.

    A NULL text stays NULL. An empty table gives no rows.
    """
    size = F.when(F.size("removed") > 0, F.length("clean").cast("long"))
    new = {"text": F.col("clean")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.coalesce(size, F.col("_doc.n_chars"))
    return deduplicated(docs).select(*[new.get(c, F.col("_doc")[c]).alias(c) for c in docs.columns])


ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
lines AS (
  SELECT doc_id, 'line' AS level, p, unit, 1 AS gap
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS unit, generate_subscripts(string_split(text, chr(10)), 1) AS p FROM d)),
sentences AS (
  SELECT doc_id, 'sentence' AS level, p, unit, 0 AS gap
  FROM (SELECT doc_id, unnest(s) AS unit, generate_subscripts(s, 1) AS p
    FROM (SELECT doc_id, regexp_extract_all(text, '[^.!?\n]*[.!?]+|[^.!?\n]+|\n') AS s FROM d))),
placed AS (
  SELECT doc_id, level, unit, CAST(sum(length(unit) + gap) OVER (PARTITION BY doc_id, level ORDER BY p) AS BIGINT) AS stop, gap
  FROM (SELECT * FROM lines UNION ALL SELECT * FROM sentences)),
units AS (
  SELECT doc_id, level, stop - gap - length(unit) AS first, stop - gap AS last,
    trim(regexp_replace(lower(unit), '[^\p{L}\p{N}]+', ' ', 'g')) AS plain FROM placed),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY level, plain ORDER BY doc_id, first) AS place
  FROM units WHERE len(string_split(plain, ' ')) >= 8),
spans AS (SELECT DISTINCT doc_id, first, last FROM ranked WHERE place > 1),
outer_spans AS (
  SELECT doc_id, first, last, coalesce(before, 0) AS before FROM (
    SELECT *, max(last) OVER (PARTITION BY doc_id ORDER BY first, last DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before
    FROM spans) WHERE before IS NULL OR last > before),
parts AS (
  SELECT doc_id, count(*) AS n, string_agg(first || ':' || last, ',' ORDER BY first) AS removed, max(last) AS stop,
    string_agg(substr(text, before + 1, first - before), '' ORDER BY first) AS kept
  FROM outer_spans JOIN d USING (doc_id) GROUP BY doc_id),
joined AS (
  SELECT t.doc_id, coalesce(n, 0) AS n_removed, coalesce(removed, '') AS removed,
    CASE WHEN n IS NULL THEN t.text ELSE kept || substr(t.text, stop + 1) END AS clean
  FROM documents t LEFT JOIN parts p ON t.doc_id = p.doc_id)
SELECT doc_id, CAST(n_removed AS BIGINT) AS n_removed, removed, CAST(length(clean) AS BIGINT) AS n_chars_left,
  sha256(clean) AS clean_sha256 FROM joined
"""
