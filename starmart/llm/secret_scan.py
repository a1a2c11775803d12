"""Secrets: fixed patterns, and tokens that pass a battery of randomness tests.

DataFrame functions only.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window, functions as F

from starmart.llm.shared import RUN, let, row_of, running_most, running_sums

KINDS = ("assign", "access", "hex", "random")
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{32,}"
ASSIGN_VALUE = 8  # characters of a value, at least

TOKEN = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}"  # what the battery looks at
FALSE_DISCOVERY = 0.1  # share of reported tokens that may be ordinary text
BINS = 100  # of p-values
PIECE = 4_096  # characters of a text that are redacted at a time
CLASSES = (4, 7)  # least and largest length class; a class doubles the length

# Letters from frequent to rare in European prose, so that cells of
# neighbours tell prose from noise; digits and the rest follow.
_LETTERS = "etaoinsrhldcumfpgwybvkxjqz"
_DIGITS = "0123456789"
ALPHABETS = {
    "decimal": (r"^[0-9]+$", _DIGITS),
    "hex": (r"^(?:[0-9a-f]+|[0-9A-F]+)$", _DIGITS + "abcdef"),
    "base32": (r"^[A-Z2-7]+$", _LETTERS.upper() + "234567"),
    "upper": (r"^[A-Z0-9]+$", _LETTERS.upper() + _DIGITS),
    "lower": (r"^[a-z0-9]+$", _LETTERS + _DIGITS),
    "base64": (r".", _LETTERS + _LETTERS.upper() + _DIGITS + "+/"),
}


# --- spans ------------------------------------------------------------------


def spans_of(text: Column, pattern: str, needs: Sequence[str] = ()) -> Column:
    """Leftmost non-overlapping matches as an array of (start, end, value), in code points.

    ``needs`` holds texts of which every match has one; looking for them is much cheaper.
    """

    def placed(found: Column) -> Column:
        gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found))
        ends = running_sums(F.zip_with(gaps, found, lambda gap, value: F.length(gap) + F.length(value)))
        span = lambda v, e: F.struct((e - F.length(v)).alias("start"), e.alias("end"), v.alias("value"))
        return F.zip_with(found, ends, span)

    none = F.array().cast("array<struct<start:int,end:int,value:string>>")
    likely = reduce(or_, [F.contains(text, F.lit(n)) for n in needs], F.lit(not needs))
    found = let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), placed)
    return F.when(likely & text.rlike(pattern), found).otherwise(none)


def _apart(tokens: Column, base: Column) -> Column:
    """The tokens that overlap no span of ``base``. A block of tokens is held against the spans near it alone."""

    def block(own: Column) -> Column:
        low, high = F.get(own, F.lit(0))["start"], F.get(own, F.size(own) - 1)["end"]
        near = F.filter(base, lambda b: (b["start"] < high) & (low < b["end"]))
        return let(near, lambda bs: F.filter(own, lambda s: ~F.exists(bs, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))))

    numbers = F.sequence(F.lit(0), F.floor((F.size(tokens) - 1) / RUN).cast("int"))
    blocks = F.transform(numbers, lambda k: let(F.slice(tokens, k * RUN + 1, F.lit(RUN)), block))
    return F.when((F.size(tokens) == 0) | (F.size(base) == 0), tokens).otherwise(F.flatten(blocks))


def _of_kind(spans: Column, kind: str) -> Column:
    order = F.lit(KINDS.index(kind)).alias("kind")
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), order, s["end"].alias("end")))


def _named(spans: Column) -> Column:
    """``kind:start:end`` for each span, joined by commas."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )


# --- randomness tests -------------------------------------------------------


def _normal_upper(z: Column) -> Column:
    """P(Z > z) of the standard normal, to about 0.0002, by a logistic fit."""
    return let(z, lambda v: 1 / (1 + F.exp(F.greatest(F.least(1.5976 * v + 0.070566 * v * v * v, F.lit(700.0)), F.lit(-700.0)))))


def _chi2_upper(x: Column, df: Column) -> Column:
    """P(X > x) of chi-squared, by the cube root (Wilson and Hilferty)."""
    spread = 2 / (9 * df)
    return _normal_upper((F.pow(x / df, F.lit(1 / 3)) - (1 - spread)) / F.sqrt(spread))


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def _ratio(a: Column, b: Column) -> Column:
    """a / b; far beyond any critical value where b is zero, as in a token of one letter."""
    return let(b, lambda v: F.when(v > 0, a / v).otherwise(F.lit(40.0)))


def battery(token: Column) -> Column:
    """A struct of ``class``, the length class, and ``p``, the chance that noise looks like ``token``.

    The encoding is inferred as the first alphabet that holds the token. Chi-squared
    compares cells of neighbouring letters with their share of the alphabet,
    about five characters to a cell; runs are those above and below the middle of the
    alphabet; serial correlation is that of a character with the next. Fisher's
    sum of logarithms combines the three p-values. Ordinary words are far from
    uniform over an alphabet, so their p is close to zero; for noise it is uniform.
    """
    letters, hexadecimal = F.lit(None).cast("string"), ALPHABETS["hex"]
    for pattern, alphabet in reversed(ALPHABETS.values()):
        letters = F.when(token.rlike(pattern), F.lit(alphabet)).otherwise(letters)
    plain = F.when(token.rlike(hexadecimal[0]), F.lower(token)).otherwise(F.translate(token, "-_", "+/"))
    return let(letters, lambda a: let(_places(plain, a), lambda x: _battery(x, F.length(a).cast("double"))))


def _places(plain: Column, alphabet: Column) -> Column:
    return F.transform(F.split(plain, ""), lambda c: (F.position(c, alphabet) - 1).cast("double"))


def _battery(x: Column, k: Column) -> Column:
    n = F.size(x).cast("double")
    tests = let(
        _total(x) / n,
        lambda mean: F.array(_uniformity(x, k, n), _runs(x, k, n), _correlation(x, n, mean)),
    )
    logs = F.aggregate(tests, F.lit(0.0), lambda total, p: total + F.log(F.greatest(p, F.lit(1e-12))))
    size_class = F.greatest(F.lit(CLASSES[0]), F.least(F.lit(CLASSES[1]), F.floor(F.log2(n)).cast("int")))
    return F.struct(size_class.alias("class"), _chi2_upper(-2 * logs, F.lit(6.0)).alias("p"))


def _uniformity(x: Column, k: Column, n: Column) -> Column:
    def over(cells: Column) -> Column:
        def part(j: Column) -> Column:
            expected = n * (F.ceil((j + 1) * k / cells) - F.ceil(j * k / cells)) / k
            seen = F.size(F.filter(x, lambda v: F.floor(v * cells / k) == j))
            return F.pow(seen - expected, F.lit(2.0)) / expected

        chi2 = _total(F.transform(F.sequence(F.lit(0), cells.cast("int") - 1), part))
        return _chi2_upper(chi2, cells - 1)

    return let(F.least(k, F.greatest(F.lit(2.0), F.floor(n / 5).cast("double"))), over)


def _runs(x: Column, k: Column, n: Column) -> Column:
    def over(above: Column) -> Column:
        steps = F.sequence(F.lit(1), F.size(above) - 1)
        runs = 1 + F.size(F.filter(steps, lambda i: F.get(above, i) != F.get(above, i - 1)))
        ones = F.size(F.filter(above, lambda v: v))
        mean = 2 * ones * (n - ones) / n + 1
        return 2 * _normal_upper(_ratio(F.abs(runs - mean), F.sqrt(F.greatest((mean - 1) * (mean - 2) / (n - 1), F.lit(0.0)))))

    return let(F.transform(x, lambda v: v * 2 >= k), over)


def _correlation(x: Column, n: Column, mean: Column) -> Column:
    steps = F.sequence(F.lit(1), F.size(x) - 1)
    serial = _total(F.transform(steps, lambda i: (F.get(x, i) - mean) * (F.get(x, i - 1) - mean)))
    square = _total(F.transform(x, lambda v: (v - mean) * (v - mean)))
    return 2 * _normal_upper(_ratio(F.abs(serial) * F.sqrt(n), square))


def least_p(tokens: DataFrame, rate: float = FALSE_DISCOVERY) -> dict[int, float]:
    """For each length class the least p from which a token (``value``) is reported.

    Noise has uniform p-values, so twice the number of different tokens with p of
    one half or more estimates how many are noise. Reporting all from p on, the rest
    of those reported are false discoveries; the least p that keeps their share
    within ``rate`` is taken, if there is one. Classes are judged apart because short prose looks
    more like noise than long prose does. What comes to the driver is a row per class.
    """
    found = tokens.distinct().select(battery(F.col("value")).alias("t"))
    bins = F.least(F.floor(F.col("t.p") * BINS), F.lit(BINS - 1)).cast("int")
    counts = found.groupBy("t.class", bins.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    upper = Window.partitionBy("class").orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, 0)
    half = F.when(F.col("bin") * 2 >= BINS, F.col("n")).otherwise(0)
    counts = counts.withColumn("reported", F.sum("n").over(upper))
    counts = counts.withColumn("noise", 2 * F.sum(half).over(Window.partitionBy("class")))
    false = 1 - F.col("noise") * (1 - F.col("bin") / BINS) / F.col("reported")
    chosen = counts.where(false <= rate).groupBy("class").agg(F.min("bin").alias("bin"))
    return {row["class"]: row["bin"] / BINS for row in chosen.collect()}


# --- scan -------------------------------------------------------------------


def _text(of: str) -> Column:
    return F.coalesce(F.col(of).cast("string"), F.lit(""))


def scanned(docs: DataFrame, rate: float = FALSE_DISCOVERY) -> DataFrame:
    """Every row as the struct ``_doc``, with ``_text`` and the arrays ``base`` and ``spans`` of (start, kind, end).

    ``base`` holds the matches of the fixed patterns, ``spans`` also the tokens that the
    randomness tests find where no fixed pattern matches. Both are sorted; ``kind``
    is a place in ``KINDS``. Offsets count code points, ends are exclusive. A NULL text
    counts as empty. Repeated rows stay, extra columns stay inside ``_doc``; an empty table gives no rows.

    Texts are read twice: once for the p-values of the corpus's different tokens, once
    for the spans. The tests run inside a document's row, so the shuffle moves
    nothing but tokens, merged within each task first.
    """
    tokens = docs.select(F.explode(F.regexp_extract_all(_text("text"), F.lit(TOKEN), F.lit(0))).alias("value"))
    least = least_p(tokens, rate)

    rows = docs.select(row_of(docs))
    rows = rows.withColumn("_text", _text("_doc.text"))
    text = F.col("_text")
    long_enough = lambda s: F.length(F.regexp_extract(s["value"], ASSIGN, 2)) >= ASSIGN_VALUE
    base = F.concat(
        _of_kind(F.filter(spans_of(text, ASSIGN, [":", "="]), long_enough), "assign"),
        _of_kind(spans_of(text, ACCESS, ["AKIA"]), "access"),
        _of_kind(spans_of(text, HEX), "hex"),
    )
    rows = rows.select("_doc", "_text", F.sort_array(base).alias("base"), spans_of(text, TOKEN).alias("_tokens"))

    def random(s: Column) -> Column:
        limit = F.create_map(*[F.lit(x) for pair in least.items() for x in pair])
        return let(battery(s["value"]), lambda t: t["p"] >= F.coalesce(F.element_at(limit, t["class"]), F.lit(2.0)))

    tokens = F.filter(_apart(F.col("_tokens"), F.col("base")), random) if least else F.slice("_tokens", 1, 0)
    extra = _of_kind(tokens, "random")
    return rows.select("_doc", "_text", "base", F.sort_array(F.concat("base", extra)).alias("spans"))


def digest(found: DataFrame) -> DataFrame:
    """One row per row of ``scanned``: counts of the fixed patterns, a digest of their spans, and all spans."""
    number = lambda k: F.size(F.filter("base", lambda s: s["kind"] == KINDS.index(k))).cast("long")
    return found.select(
        "_doc.doc_id",
        *[number(k).alias(f"n_{k}") for k in KINDS[:3]],
        F.sha2(_named(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        _named(F.col("spans")).alias("spans"),
    )


def _joined(spans: Column) -> Column:
    """(start, end) of sorted spans, those that overlap made one."""

    def groups(ss: Column, tops: Column) -> Column:
        begins = lambda i: F.get(ss, i)["start"] >= F.coalesce(F.get(tops, i - 1), F.lit(0))
        first = F.filter(F.sequence(F.lit(0), F.size(ss) - 1), begins)
        end = lambda fs, j: F.get(tops, F.coalesce(F.get(fs, j + 1), F.size(ss)) - 1)
        return let(first, lambda fs: F.transform(fs, lambda i, j: F.struct(F.get(ss, i)["start"].alias("start"), end(fs, j).alias("end"))))

    return let(running_most(F.transform(spans, lambda s: s["end"])), lambda tops: groups(spans, tops))


def _marked(text: Column, spans: Column, mark: str) -> Column:
    """The text with ``mark`` in place of sorted spans that do not overlap.

    It is worked in pieces of ``PIECE`` characters, because finding a place in a text takes as long as the text before it.
    """

    def piece(spans: Column, own: Column, k: Column) -> Column:
        at = k * PIECE
        here = F.filter(spans, lambda s: (s["start"] < at + PIECE) & (s["end"] > at))
        begin = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

        def add(state: Column, s: Column) -> Column:
            gap = F.substring(own, state["at"] + 1, F.greatest(s["start"] - at, F.lit(0)) - state["at"])
            new = F.when(s["start"] >= at, F.lit(mark)).otherwise(F.lit(""))
            return F.struct((s["end"] - at).alias("at"), F.concat(state["out"], gap, new).alias("out"))

        rest = lambda state: F.concat(state["out"], F.substring(own, state["at"] + 1, F.lit(PIECE)))
        return F.aggregate(here, begin, add, rest)

    pieces = F.regexp_extract_all(text, F.lit(rf"(?s).{{1,{PIECE}}}"), F.lit(0))
    return let(spans, lambda ss: F.array_join(F.transform(pieces, lambda own, k: piece(ss, own, k)), ""))


def redacted(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with each secret in ``text`` replaced by ``mark``; a span that overlaps an earlier one joins it.

    ``n_chars`` follows the text if there is such a column. Rows without secrets are unchanged.
    """
    clean = F.when(F.size("spans") > 0, _marked(F.col("_text"), _joined(F.col("spans")), mark)).otherwise(F.col("_doc.text").cast("string"))
    rows = scanned(docs).select("_doc", clean.alias("_clean"))
    size = F.when(F.col("_doc.text").isNotNull(), F.length("_clean").cast("long"))
    new = {"text": F.col("_clean"), "n_chars": F.coalesce(size, F.col("_doc.n_chars") if "n_chars" in docs.columns else size)}
    return rows.select(*[new.get(c, F.col("_doc")[c]).alias(c) for c in docs.columns])
