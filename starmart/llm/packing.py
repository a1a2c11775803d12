"""Best-fit packing of tokenised documents into sequences of fixed length."""

from __future__ import annotations

import functools
import itertools
import json
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Observation, functions as F

from starmart.llm.shared import Staging, few_at_once, returned

LENGTH = 2048  # tokens of a sequence
END = 0  # id that ends a document
OPEN_BINS = 8_192  # sequences that a task keeps open at most
TASK_PIECES = 20_000  # pieces that a packing task gets, about
CHARS = 1_000_000  # of texts whose pieces are returned together, about
TEXTS = 256  # that Spark reads and sends to a worker together at most
TOGETHER = 1_000  # words that the slower library encodes in one text
GAP = 10_000  # white space in a row that tiktoken's split is not trusted with
# Letters that all libraries have known for long, so that they agree what a letter is.
SETTLED = "\u0000-\u04ff\u4e00-\u9fa5\uac00-\ud7a3"


# --- tokens -----------------------------------------------------------------

# What the byte-level split of such files stands for, and the settings of files without extras.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PLAIN = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
PLAIN_MODEL = {"type": "BPE", "dropout": None, "continuing_subword_prefix": None, "end_of_word_suffix": None, "ignore_merges": False}


def by_ranks(content: str) -> dict[bytes, int] | None:
    """The same vocabulary as ranks of byte strings, as tiktoken takes them, or None where the two could differ.

    They agree if merges make the ids after the bytes' own in rising order, if nothing else but the byte-level
    split is done, and if the merges make every token from its own bytes: then two neighbours that spell
    a token can only be the pair of its merge.
    """
    from tokenizers import Tokenizer

    held = json.loads(content)
    model = held["model"]
    if held["normalizer"] or held["pre_tokenizer"] != PLAIN or any(model.get(k) != v for k, v in PLAIN_MODEL.items()):
        return None
    vocabulary = model["vocab"]
    made = [vocabulary.get("".join(m.split(" ") if isinstance(m, str) else m)) for m in model["merges"]]
    letters = sorted(t for t in vocabulary if len(t) == 1)
    if sorted(vocabulary.values()) != list(range(len(vocabulary))) or made != list(range(len(letters), len(vocabulary))):
        return None
    printed = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    other = [b for b in range(256) if b not in printed]
    of = {chr(b): b for b in printed} | {chr(256 + k): b for k, b in enumerate(other)}  # bytes without a sign get the next free code points
    by_merges = Tokenizer.from_str(content).model.tokenize
    if letters != sorted(of) or any([found.id for found in by_merges(t)] != [i] for t, i in vocabulary.items()):
        return None
    return {bytes(of[c] for c in token): i for token, i in vocabulary.items()}


class Vocabulary:
    """A tokenizer file, looked through once by the driver, and the libraries' objects, made in a process when they are first needed.

    Nothing else is kept between tasks, and the objects do not travel with the rest.
    """

    def __init__(self, file: bytes):
        from tokenizers import Tokenizer

        self.file, content = file, file.decode("utf-8")
        self.ranks = by_ranks(content)
        self.added = [t.content for t in Tokenizer.from_str(content).get_added_tokens_decoder().values()]

    def __getstate__(self) -> dict:
        return {name: self.__dict__[name] for name in ("file", "ranks", "added")}

    @functools.cached_property
    def fast(self):
        """tiktoken's encoder, or None if it could give other ids."""
        import tiktoken

        return self.ranks and tiktoken.Encoding("packing", pat_str=SPLIT, mergeable_ranks=self.ranks, special_tokens={})

    @functools.cached_property
    def exact(self):
        """The tokenizer as the file defines it."""
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        return Tokenizer.from_str(self.file.decode("utf-8"))


# A space between two characters that are no white space begins a word, whatever stands elsewhere.
_CUT = re.compile(r"(?<=\S) (?=\S)")
_UNSETTLED = re.compile(f"[^{SETTLED}]")
_GAP = re.compile(rf"\s{{{GAP}}}")


class Encoder:
    """Ids of whole texts by a byte-level BPE of the tokenizers library.

    Where ``by_ranks`` has found that tiktoken gives the same ids, texts go through that, which is several times faster; words
    with letters that the two may tell apart are cut out at spaces, where the split cannot change, and go through tokenizers. So does a
    whole text that holds an added token, such as the end of a document, or very much white space in a row. Nothing
    is remembered between texts, so memory is that of the longest text.
    """

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary

    def _slowly(self, text: str) -> np.ndarray:
        return np.array(self.vocabulary.exact.encode(text, add_special_tokens=False).ids, "<u4")

    def ids(self, text: str) -> np.ndarray:
        """What one call of the tokenizer on the text gives."""
        fast = self.vocabulary.fast
        if not fast or any(a in text for a in self.vocabulary.added) or (len(text) >= GAP and _GAP.search(text)):
            return self._slowly(text)
        if text.isascii() or not _UNSETTLED.search(text):
            return np.array(fast.encode_ordinary(text), "<u4")
        out, before = [], ""
        for odd, run in itertools.groupby(_CUT.split(text), lambda w: bool(_UNSETTLED.search(w))):
            words = list(run)
            for k in range(0, len(words), TOGETHER if odd else len(words)):
                part = before + " ".join(words[k : k + TOGETHER] if odd else words)
                out.append(self._slowly(part) if odd else np.array(fast.encode_ordinary(part), "<u4"))
                before = " "
        return np.concatenate(out)


def cut(size: int, length: int = LENGTH) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: all full but the first, which has the rest."""
    rest = size % length
    starts = ([0] if rest else []) + list(range(rest, size, length))
    return [(s, e - s) for s, e in zip(starts, [*starts[1:], size])]


def pieces(docs: DataFrame, tokenizer: str, keep_ids: bool = True, length: int = LENGTH) -> DataFrame:
    """(``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32``) and ``ids``, if wanted, of every piece of every row.

    A document's ids are those of its whole text, NULL counting as empty, and ``END``.
    ``tokenizer`` is the path of a file that the driver reads and sends to the tasks.
    """
    with open(tokenizer, "rb") as file:
        vocabulary = docs.sparkSession.sparkContext.broadcast(Vocabulary(file.read()))

    kind = "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids array<int>" if keep_ids else "")

    def batch_of(doc_ids: list[int | None], found: list[np.ndarray]) -> pa.RecordBatch:
        """The pieces of some documents. Texts come one by one, so no more of them is unpacked than is worked on."""
        cuts = [cut(len(ids), length) for ids in found]
        owner = np.repeat(np.arange(len(found)), [len(c) for c in cuts])
        starts, sizes = (np.array([c[k] for own in cuts for c in own], np.int64) for k in (0, 1))
        own = [found[k][a : a + n] for k, a, n in zip(owner, starts, sizes)]
        columns = {
            "doc_id": pa.array([doc_ids[k] for k in owner], pa.int64()),
            "piece": pa.array(np.concatenate([np.arange(len(c), dtype=np.int32) for c in cuts])),
            "start": pa.array(starts),
            "length": pa.array(sizes),
            "ids_crc32": pa.array([zlib.crc32(ids.tobytes()) for ids in own], pa.int64()),
        }
        if keep_ids:
            edges = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            columns["ids"] = pa.ListArray.from_arrays(edges, np.concatenate(own).astype(np.int32))
        return pa.RecordBatch.from_pydict(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary.value)
        for batch in batches:
            doc_ids, found, chars = [], [], 0
            for doc_id, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = value.as_py() or ""
                doc_ids.append(doc_id)
                found.append(np.append(encoder.ids(text), np.uint32(END)).astype("<u4"))
                chars += len(text)
                if chars >= CHARS:
                    yield batch_of(doc_ids, found)
                    doc_ids, found, chars = [], [], 0
            if found:
                yield batch_of(doc_ids, found)
        returned()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, kind)


# --- bins -------------------------------------------------------------------


class OpenBins:
    """Open sequences in a bitset keyed by free space; a piece goes where it leaves least."""

    def __init__(self, length: int = LENGTH, most: int = OPEN_BINS):
        self.length, self.most = length, most
        self.free = 0  # bit f: some open sequence has f tokens free
        self.bins: list[list[int]] = [[] for _ in range(length + 1)]
        self.open = self.made = 0

    def _take(self, space: int) -> int:
        found = self.bins[space].pop()
        if not self.bins[space]:
            self.free &= ~(1 << space)
        self.open -= 1
        return found

    def place(self, size: int) -> tuple[int, int]:
        """The sequence and the place in it for a piece of ``size`` tokens."""
        fits = self.free >> size
        if fits:
            space = size + (fits & -fits).bit_length() - 1
            found = self._take(space)
        else:
            found, space = self.made, self.length
            self.made += 1
        left = space - size
        if left:
            if self.open >= self.most:  # the fullest closes
                self._take((self.free & -self.free).bit_length() - 1)
            self.bins[left].append(found)
            self.free |= 1 << left
            self.open += 1
        return found, self.length - space


def _pack(length: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bins, first = OpenBins(length), TaskContext.get().partitionId() << 40
        for batch in batches:
            placed = [bins.place(int(n)) for n in batch["length"]]
            yield batch.assign(
                sequence_id=np.array([first + p[0] for p in placed], np.int64), offset=np.array([p[1] for p in placed], np.int64)
            )

    return run


def packed(found: DataFrame, staging: Staging, length: int = LENGTH) -> DataFrame:
    """``found`` from ``pieces`` with the ``sequence_id`` and ``offset`` of each piece.

    The pieces are stored with a number, dealt out evenly by it, and sorted by
    falling length in each task, which best fit packs most tightly. Every task packs its
    share online with ``OPEN_BINS`` open sequences, so its memory is bounded however much it
    gets. A share ends with one part-filled sequence or a few: of some thousands.
    """
    rows = Observation()
    numbered = found.withColumn("_row", F.monotonically_increasing_id()).observe(rows, F.count(F.lit(1)).alias("n"))
    with few_at_once(found.sparkSession, TEXTS):
        stored = staging.keep(numbered, "pieces")
    tasks = max(1, -(-rows.get["n"] // TASK_PIECES))
    names = [f for f in stored.schema.fields if f.name not in ("_row", "ids")]
    kind = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in names) + ", _row long, sequence_id long, offset long"
    dealt = stored.drop("ids").repartition(tasks, F.xxhash64("_row")).sortWithinPartitions(F.desc("length"), "_row")
    places = dealt.mapInPandas(_pack(length), kind)
    if "ids" not in stored.columns:
        return places.drop("_row")
    places = staging.keep(places.select("_row", "sequence_id", "offset"), "places")
    return stored.join(places, "_row").drop("_row")


def pack_documents(docs: DataFrame, tokenizer: str, keep_ids: bool = True, length: int = LENGTH) -> DataFrame:
    """All documents cut into pieces and packed: one row per piece, see ``pieces`` and ``packed``.

    A sequence holds at most ``length`` tokens, without gaps from offset 0. Documents are cut only if
    they are longer. Sequence numbers are unique but not dense. Repeated rows are packed
    like different ones; a NULL or empty text is one piece of the end id alone; an
    empty table gives no rows; other columns are not looked at.
    """
    return packed(pieces(docs, tokenizer, keep_ids, length), Staging(docs.sparkSession), length)
