"""Byte-level BPE of a corpus: every distinct word is encoded once, for all documents."""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, functions as F

from starmart.llm.shared import Staging, gathered, shipped, slices, spaced, stored_by

BLOCK_CHARS = 16_000_000  # of text whose words get numbers of their own
BUCKET_DOCS = 4_000  # documents for each group of distinct words, about
MIN_BUCKETS = 256
MIN_GROUPS, MOST_GROUPS = 64, 50_000  # groups that the blocks are stored in; a group can hold many blocks
LEVEL = 3  # of compression

BLOCK = "block long, bucket int, doc_ids array<long>, sizes binary, data binary, heads binary, tails binary"


# --- vocabulary -------------------------------------------------------------


def ranks(content: bytes) -> dict[bytes, int]:
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, content.splitlines()) if token}


def encoding(content: bytes, pattern: str):
    import tiktoken

    return tiktoken.Encoding("corpus", pat_str=pattern, mergeable_ranks=ranks(content), special_tokens={})


# --- words and their places -------------------------------------------------


def _packed(numbers: np.ndarray) -> bytes:
    """32-bit numbers, byte by byte of all of them, so that the high bytes compress."""
    return zstandard.compress(np.asarray(numbers, np.int64).astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), LEVEL)


def _unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64)


def _chunks(text: str, find) -> list[str]:
    """A text as pieces that the pattern splits one by one as it does the whole.

    No match reaches past a space that follows other text and starts a word, so the text is
    cut before those. Beside other white space the matches themselves are the pieces.
    """
    words = spaced(text)
    return find(text) if words is None else [*words[:1], *[" " + w for w in words[1:]]]


def _block(doc_ids: list, texts: list[str], number: int, buckets: int, find) -> pd.DataFrame:
    """One row with the places of words in the block's documents, and one per bucket with its distinct words."""
    seen: dict[str, int] = {}
    places, sizes = [], []
    for text in texts:
        found = [seen.setdefault(c, len(seen)) for c in _chunks(text, find)]
        sizes.append(len(found))
        places.append(np.array(found, np.int64))
    places = np.concatenate(places) if places else np.zeros(0, np.int64)
    order = np.argsort(-np.bincount(places, minlength=len(seen)), kind="stable")  # frequent chunks get small numbers
    rank = np.empty(len(seen), np.int64)
    rank[order] = np.arange(len(seen))
    chunks = list(seen)
    words: dict[str, int] = {}
    heads, parts = np.zeros(len(seen), np.int32), []
    for k, at in enumerate(order.tolist()):
        found = [words.setdefault(w, len(words)) for w in find(chunks[at])]
        heads[k] = len(found)
        parts.extend(found)
    rows = [(number, -1, doc_ids, _packed(np.array(sizes)), _packed(rank[places]), _packed(heads), _packed(np.array(parts)))]
    raw = [w.encode("utf-8", "surrogatepass") for w in words]
    chosen = np.array([zlib.crc32(w) % buckets for w in raw], np.int64)
    by_bucket = np.argsort(chosen, kind="stable")
    edges = np.flatnonzero(np.diff(chosen[by_bucket], prepend=-1))
    for own in np.split(by_bucket, edges[1:]) if len(raw) else []:
        kept = [raw[i] for i in own.tolist()]
        steps = np.diff(own, prepend=0)  # the numbers rise, so their steps are small
        lengths = _packed(np.array([len(w) for w in kept]))
        rows.append((number, int(chosen[own[0]]), None, lengths, zstandard.compress(b"".join(kept), LEVEL), _packed(steps), None))
    return pd.DataFrame(rows, columns=["block", "bucket", "doc_ids", "sizes", "data", "heads", "tails"])


def blocks(docs: DataFrame, pattern: str, buckets: int, chars: int = BLOCK_CHARS) -> DataFrame:
    """Blocks of whole documents: a row for their word places, and a row per bucket of distinct words.

    The matches of ``pattern`` in a block's texts are numbered. A place row holds the numbers
    in text order; a bucket row holds the words whose hash falls into the bucket, each
    once, and their numbers. So a word is moved once per block, and never per occurrence.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import regex

        find = regex.compile(pattern).findall
        first, made = TaskContext.get().partitionId() << 33, 0

        def work(part: pd.DataFrame) -> pd.DataFrame:
            nonlocal made
            made += 1
            ids = [None if pd.isna(i) else int(i) for i in part["doc_id"].astype("Int64")]
            return _block(ids, [t or "" for t in part["text"]], first + made, buckets, find)

        yield from slices(work, "text", chars)(batches)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInPandas(run, BLOCK)


def encoded_words(words: DataFrame, vocabulary: Broadcast, pattern: str) -> DataFrame:
    """(``block``, ``numbers``, ``sizes``, ``ids``) for each bucket row: the ids of its words, one after the other.

    All rows of a bucket meet in one task and follow each other there, so each distinct word is encoded once.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder, bucket, known = encoding(vocabulary.value, pattern), None, {}
        for batch in batches:
            out = []
            for row in batch.itertuples(index=False):
                if row.bucket != bucket:
                    bucket, known = row.bucket, {}
                lengths, data = _unpacked(row.sizes), zstandard.decompress(row.data)
                words = [data[e - n : e] for n, e in zip(lengths.tolist(), np.cumsum(lengths).tolist())]
                for w in words:
                    if w not in known:
                        known[w] = encoder.encode_ordinary(w.decode("utf-8", "surrogatepass"))
                ids = [known[w] for w in words]
                flat = np.array([i for found in ids for i in found], np.int64)
                out.append((row.block, row.heads, _packed(np.array([len(i) for i in ids])), _packed(flat)))
            yield pd.DataFrame(out, columns=["block", "numbers", "sizes", "ids"])

    met = words.repartition("bucket").sortWithinPartitions("bucket")
    return met.mapInPandas(run, "block long, numbers binary, sizes binary, ids binary")


def _document_ids(place: pd.Series, found: pd.DataFrame) -> Iterator[tuple[int | None, np.ndarray]]:
    """(doc_id, ids) of a block's documents, put together by position."""
    numbers = np.concatenate([np.zeros(0, np.int64), *[np.cumsum(_unpacked(n)) for n in found["numbers"]]])
    sizes = np.concatenate([np.zeros(0, np.int64), *[_unpacked(n) for n in found["sizes"]]])
    ids = np.concatenate([np.zeros(0, np.int64), *[_unpacked(d) for d in found["ids"]]])
    start, size = np.zeros(len(numbers), np.int64), np.zeros(len(numbers), np.int64)
    start[numbers], size[numbers] = np.cumsum(sizes) - sizes, sizes
    heads, parts, counts = (_unpacked(place[c]) for c in ("heads", "tails", "sizes"))
    first = np.cumsum(heads) - heads
    at, end = _unpacked(place["data"]), np.cumsum(counts)
    for doc_id, n, e in zip(place["doc_ids"], counts, end):
        chunk = at[e - n : e]
        words = gathered(parts, first[chunk], heads[chunk])
        yield doc_id, gathered(ids, start[words], size[words])


def encoded(docs: DataFrame, path: str, pattern: str, finish=None, kind: str = "doc_id long, ids array<int>") -> DataFrame:
    """The ids of every document's whole text: one row (``doc_id``, ``ids``) per row of ``docs``.

    Pre-tokens are the matches of ``pattern``; each is encoded by the ranks in the file
    ``path``, without special tokens. The corpus's distinct pre-tokens are shuffled, encoded once
    each, joined back by block and put together by position (see ``blocks``). The places are stored
    grouped by block, so that only words and their ids move.
    ``finish`` maps (doc_id, ids) to another row of type ``kind`` where the ids lie.

    A NULL or empty text has no ids. Repeated rows and rows without an id stay. A hot word
    is one entry per block. Blocks are bounded in size (one longer text is a
    block alone), and so are buckets, whose number follows the number of rows. An empty table gives no
    rows. Columns other than id and text are not looked at.
    """
    spark, staging = docs.sparkSession, Staging(docs.sparkSession)
    vocabulary = shipped(spark, path)
    shares = docs.count() // BUCKET_DOCS
    buckets = max(MIN_BUCKETS, shares)
    groups = min(max(MIN_GROUPS, shares), MOST_GROUPS)
    made = stored_by(blocks(docs, pattern, buckets), "block", groups, "blocks", staging)
    found = encoded_words(made.where("bucket >= 0").select("block", "bucket", "sizes", "data", "heads"), vocabulary, pattern)
    names = [part.split()[0] for part in kind.split(", ")]

    def together(place: pd.DataFrame, words: pd.DataFrame) -> pd.DataFrame:
        own = finish(vocabulary.value) if finish else lambda doc_id, ids: (doc_id, ids.astype(np.int32))
        rows = [own(*row) for _, p in place.iterrows() for row in _document_ids(p, words)]
        return pd.DataFrame(rows, columns=names).astype({"doc_id": "Int64"})

    places = made.where("bucket < 0").drop("bucket")
    return places.groupBy("block").cogroup(found.groupBy("block")).applyInPandas(together, kind)


# --- decoding ---------------------------------------------------------------


def token_bytes(content: bytes) -> list[bytes]:
    """The token-byte table: the bytes of each id."""
    table = ranks(content)
    out = [b""] * (max(table.values(), default=-1) + 1)
    for token, rank in table.items():
        out[rank] = token
    return out


def decoded(documents: DataFrame, path: str) -> DataFrame:
    """(``doc_id``, ``decoded``): the bytes of ``ids``, which are joined to the token-byte table in each task.

    The table has a row per id of the vocabulary and is sent to all tasks.
    """
    vocabulary = shipped(documents.sparkSession, path)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = token_bytes(vocabulary.value)
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "decoded": [b"".join([table[i] for i in ids]) for ids in batch["ids"]]})

    return documents.select("doc_id", "ids").mapInPandas(run, "doc_id long, decoded binary")


def digested(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Encode and decode: ``doc_id``, ``n_tokens`` and digests of the ids and of the decoded bytes.

    The digests are made where the ids are put together, so neither ids nor bytes are shuffled again.
    """

    def finish(content: bytes):
        table = token_bytes(content)

        def row(doc_id, ids: np.ndarray):
            plain = b"".join([table[i] for i in ids.tolist()])
            return doc_id, len(ids), hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest(), hashlib.sha256(plain).hexdigest()

        return row

    kind = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return encoded(docs, path, pattern, finish, kind)
