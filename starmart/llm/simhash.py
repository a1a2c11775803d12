"""SimHash near duplicates by meet-in-the-middle ball hashing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from starmart.llm.components import connected_components
from starmart.llm.shared import Staging, slices

SHINGLE = 3
DISTANCE = 3  # at most; the balls below are made for it
SEED = 42
BITS = 64
CHARS = 8_000_000  # of text that a task holds at a time
SLICE = 4_000  # fingerprints whose variants a task holds at a time

MIN_ROUTE_BITS = 8  # of a variant that choose its group in the shuffle, at least
ROUTE_ROWS = 2_000  # fingerprints for each value of those bits, at most
LARGE = 3  # a group of more than this times the mean is split,
LARGE_ROWS = 1_000  # if it has more rows than this,
SPLIT_BITS = 6  # by so many more bits


# --- fingerprints -----------------------------------------------------------


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """A bit is 1 if it is set in over half of the hashes of the text's shingles."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: only A-Z, only ASCII space
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    if len(words) <= shingle:
        hashes = np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    else:
        starts = np.concatenate([[0], ends[:-1] + 1])
        cuts = zip(starts[: len(words) - shingle + 1].tolist(), ends[shingle - 1 :].tolist())
        hashes = np.fromiter((xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in cuts), np.uint64)
    votes = np.zeros(BITS, np.int64)
    for k in range(0, len(hashes), 65_536):
        bits = np.unpackbits(hashes[k : k + 65_536].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        votes += bits.sum(axis=0, dtype=np.int64)
    return int("".join("1" if v * 2 > len(hashes) else "0" for v in votes), 2)


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(``doc_id``, ``fp``) with the 64 bits as a signed long, one row per row of ``docs``."""

    def work(part: pd.DataFrame) -> pd.DataFrame:
        values = np.array([fingerprint(t, shingle) for t in part["text"]], np.uint64).view(np.int64)
        return pd.DataFrame({"doc_id": part["doc_id"].astype("Int64"), "fp": values})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInPandas(
        slices(work, "text", CHARS), "doc_id long, fp long"
    )


# --- balls ------------------------------------------------------------------


def _grow(start: np.ndarray, fp: np.ndarray, bits: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Variants of ``fp`` begun as ``start``, with what may be flipped of ``bits`` flipped too.

    A variant flips one bit, or two in the same half of the word if ``fp`` has an even
    number of ones.
    """
    begun, even = start ^ fp, np.bitwise_count(fp) % 2 == 0
    flips, upper = np.bitwise_count(begun), begun >> np.uint64(32) != 0
    todo = [(np.ones(len(fp), bool), [0]), (flips == 0, [1 << b for b in bits])]
    for half in (False, True):
        own = [1 << b for b in bits if (b >= 32) == half]
        todo.append(((flips == 0) & even, [x | y for x in own for y in own if x < y]))
        todo.append(((flips == 1) & even & (upper == half), own))
    parts = [
        ((start[rows][:, None] ^ np.array(masks, np.uint64)[None, :]).ravel(), np.repeat(fp[rows], len(masks)))
        for rows, masks in todo
    ]
    return tuple(np.concatenate(x) for x in zip(*parts))


def _bits(mask: int) -> list[int]:
    return [b for b in range(BITS) if mask >> b & 1]


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def _spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Flip the bits in ``more`` and add them to ``mask``, the bits that choose the group."""
    for batch in batches:
        for (mask, more), part in batch.groupby(["mask", "more"], sort=False):
            start, fp = (part[c].to_numpy().view(np.uint64) for c in ("start", "fp"))
            if more:
                start, fp = _grow(start, fp, _bits(int(more) % (1 << BITS)))
            frame = pd.DataFrame({"start": start.view(np.int64), "fp": fp.view(np.int64)})
            yield frame.assign(mask=np.int64(mask | more))[["mask", "start", "fp"]]


def _volatile(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """For each large group, the bits outside ``mask`` that differ most among its rows."""
    for batch in batches:
        more = []
        for row in batch.itertuples(index=False):
            share = np.array(row.ones)
            share[_bits(int(row.mask) % (1 << BITS))] = -1
            order = np.argsort(-share * (1 - share), kind="stable")[:SPLIT_BITS]
            more.append(_signed(sum(1 << int(b) for b in order if share[b] >= 0)))
        yield pd.DataFrame({"mask": batch["mask"], "at": batch["at"], "more": np.array(more, np.int64)})


def _collisions(variant: np.ndarray, fp: np.ndarray) -> pd.DataFrame:
    """A link from the hub of each variant, the least fingerprint within one bit, to all others there."""
    far = np.bitwise_count(variant ^ fp) > 1
    order = np.lexsort((fp, far, variant))
    variant, fp, far = variant[order], fp[order], far[order]
    first = np.flatnonzero(np.concatenate([[True], variant[1:] != variant[:-1]]))
    hub = np.repeat(first, np.diff(np.append(first, len(variant))))
    linked = ~far[hub] & (fp[hub] != fp)
    a, b = fp[hub][linked], fp[linked]
    close = np.bitwise_count(a ^ b) <= DISTANCE
    return pd.DataFrame({"a": a[close].view(np.int64), "b": b[close].view(np.int64)}).drop_duplicates()


def _links_of_group(group: pd.DataFrame) -> pd.DataFrame:
    """The links of one group: all variants over the bits that its shuffle left, sorted.

    They are made in two turns over slices of the rows. The first marks cells of
    a table that more than one variant falls into; the second keeps only those.
    """
    start, fp = (group[c].to_numpy().view(np.uint64) for c in ("start", "fp"))
    bits = _bits(~int(group["mask"].iat[0]) % (1 << BITS))
    size = min(max(16, (len(start) * 400).bit_length()), 28)
    cells = np.zeros(1 << size, np.uint8)
    runs = range(0, len(start), SLICE)

    def cell(v: np.ndarray) -> np.ndarray:
        return (v * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(BITS - size)

    if len(runs) <= 1:
        return _collisions(*_grow(start, fp, bits))
    for k in runs:
        at = np.sort(cell(_grow(start[k : k + SLICE], fp[k : k + SLICE], bits)[0]))
        again = at[1:][at[1:] == at[:-1]]
        cells[at] += cells[at] < 2
        cells[again] = 2
    kept = []
    for k in runs:
        variant, of = _grow(start[k : k + SLICE], fp[k : k + SLICE], bits)
        shared = cells[cell(variant)] > 1
        kept.append((variant[shared], of[shared]))
    return _collisions(*[np.concatenate(x) for x in zip(*kept)])


def fingerprint_links(distinct: DataFrame, staging: Staging) -> DataFrame:
    """Links (``a``, ``b``) that connect all fingerprints (``fp``) at 3 or fewer differing bits.

    Two fingerprints at distance d meet at a variant that flips some of the
    differing bits of one and the rest of the other. All emit their ball of one bit;
    those with an even number of ones also emit the variants of two flips
    within one half of the word. That is enough: an even distance within 3 is
    2, where both flip one bit, and an odd one joins an even with an odd
    fingerprint; of three differing bits two lie in the same half.

    The shuffle is on some bits of the variants; the task that gets them makes
    the variants over the other bits, so a fingerprint costs some 25 shuffled
    rows and not 560. These are leading bits, more of them for more fingerprints. A
    group much larger than the mean, such as the variants of a mass of near
    copies, is split by the bits in which its own rows differ most, again
    and again until it is not.

    Fingerprints within one bit of a variant are within 3 of all that meet there, so
    one of them is linked to each other: links grow with the emitted rows
    and not with their square.
    """
    n = distinct.count()
    lead = max(MIN_ROUTE_BITS, (n // ROUTE_ROWS).bit_length())
    top = _signed(((1 << lead) - 1) << (BITS - lead))
    rows = distinct.select(F.lit(0).cast("long").alias("mask"), F.col("fp").alias("start"), "fp", F.lit(top).alias("more"))
    at = F.col("start").bitwiseAND(F.col("mask")).alias("at")
    done = None
    while True:
        made = staging.keep(rows.mapInPandas(_spread, "mask long, start long, fp long"), "variants").withColumn("at", at)
        sizes = staging.keep(made.groupBy("mask", "at").agg(F.count(F.lit(1)).alias("rows")), "sizes")
        mean = sizes.agg(F.avg("rows")).first()[0] or 0
        limit = max(LARGE_ROWS, LARGE * mean)
        # Stored, as the splits below are, so that Spark knows their size when it chooses the joins.
        large = staging.keep(sizes.where((F.col("rows") > limit) & (F.col("mask") != -1)).select("mask", "at"), "large")
        if large.isEmpty():
            return (made if done is None else done.unionByName(made)).groupBy("mask", "at").applyInPandas(
                _links_of_group, "a long, b long"
            )
        members = made.join(large, ["mask", "at"], "left_semi")
        ones = F.array(*[F.avg(F.shiftrightunsigned("start", b).bitwiseAND(F.lit(1))) for b in range(BITS)])
        split = members.groupBy("mask", "at").agg(ones.alias("ones")).mapInPandas(_volatile, "mask long, at long, more long")
        split = staging.keep(split, "split")
        rest = made.join(large, ["mask", "at"], "left_anti")
        done = rest if done is None else done.unionByName(rest)
        rows = made.join(split, ["mask", "at"]).select("mask", "start", "fp", "more")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, staging: Staging | None = None) -> DataFrame:
    """(``doc_id``, ``fingerprint``, ``component_id``), one row per row of ``docs``.

    Words are separated by ASCII space and lower-cased in A-Z. A text of fewer words
    than a shingle is hashed whole; NULL, empty and blank texts have
    fingerprint zero and are linked like any other. ``component_id`` is the smallest
    doc_id reachable over links of 3 or fewer bits. Repeated rows stay, each with the same
    result; a NULL doc_id counts as no id, and is a component of its own
    (NULL) unless it is linked to rows with one. An empty table gives no rows. Other columns of ``docs`` are
    not looked at.
    """
    staging = staging or Staging(docs.sparkSession)
    hashed = staging.keep(fingerprints(docs, shingle), "fingerprints")
    groups = staging.keep(hashed.groupBy("fp").agg(F.min("doc_id").alias("least")), "groups")
    linked = connected_components(fingerprint_links(groups.select("fp"), staging), staging)
    rooted = groups.join(linked.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    wanted = staging.keep(rooted.join(named, "root").select("fp", "component_id"), "components")
    return hashed.join(wanted, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def one_per_group(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """The document with the smallest id of each component, with all its columns.

    Rows with the same id are one document, of which one row stays. Rows without
    an id all stay: nothing tells which of them is which. Texts without a word, NULL too, are alike. An empty table gives no rows.
    """
    found = near_duplicates(docs, shingle)
    kept = found.where("doc_id = component_id").select("doc_id").distinct()
    named = docs.where("doc_id IS NOT NULL").join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return named.unionByName(docs.where("doc_id IS NULL"))
