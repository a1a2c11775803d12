"""What several operators of this folder need: tables, held-out folds, batches of whole texts."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from starmart.sources.staging import Staging


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; a NULL id is in fold 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts, F.lit(0))


def named(column: str) -> Column:
    """A column by its exact name, whatever characters that has."""
    return F.col("`" + column.replace("`", "``") + "`")


def row_of(docs: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """All columns of ``docs``, or some, as the struct ``_doc``, so that none of them meets a working column of the same name."""
    return F.struct(*[named(c).alias(c) for c in (docs.columns if columns is None else columns)]).alias("_doc")


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with ``value`` worked out once for all its uses."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


RUN = 300  # values that are added up one by one


def running(values: Column, combine: Callable[[Column, Column], Column]) -> Column:
    """For each place of an array of int the result of ``combine`` over all values so far, beginning with 0.

    A step copies what was built before it, so long arrays are worked in blocks of ``RUN`` values, and the blocks' results
    are combined likewise: some hundred copies for a value and not as many as there are values.
    """

    def short(xs: Column) -> Column:
        begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))

        def add(s: Column, x: Column) -> Column:
            return let(combine(s["at"], x), lambda n: F.struct(n.alias("at"), F.concat(s["out"], F.array(n)).alias("out")))

        return F.aggregate(xs, begin, add, lambda s: s["out"])

    def long(xs: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.floor((F.size(xs) - 1) / RUN).cast("int"))
        blocks = F.transform(numbers, lambda b: short(F.slice(xs, b * RUN + 1, F.lit(RUN))))
        last = lambda block: F.get(block, F.size(block) - 1)
        before = lambda ends, b: F.coalesce(F.get(ends, b - 1), F.lit(0))
        moved = lambda ends: lambda block, b: F.transform(block, lambda x: combine(before(ends, b), x))
        return let(blocks, lambda bs: let(short(F.transform(bs, last)), lambda ends: F.flatten(F.transform(bs, moved(ends)))))

    return let(values, lambda xs: F.when(F.size(xs) <= RUN, short(xs)).otherwise(long(xs)))


def running_sums(values: Column) -> Column:
    return running(values, lambda a, b: a + b)


def running_most(values: Column) -> Column:
    """The largest value so far, 0 at least."""
    return running(values, lambda a, b: F.greatest(a, b))


def stored(df: DataFrame, name: str, staging: Staging | None = None) -> DataFrame:
    """``df`` written once to the shared folder and read back from there."""
    return (staging or Staging(df.sparkSession)).keep(df, name)


def stored_by(df: DataFrame, key: str, groups: int, name: str, staging: Staging) -> DataFrame:
    """``df`` written once to the shared folder in ``groups`` buckets of ``key``, and read back from there.

    Joins on ``key`` leave these rows where they are. The catalog entry is dropped again at
    once; the reader that is returned knows the files.
    """
    spark, entry = df.sparkSession, f"stored_{uuid.uuid4().hex}"
    df.write.format("parquet").bucketBy(groups, key).option("path", staging.path(name)).saveAsTable(entry)
    read = spark.table(entry)
    spark.sql(f"DROP TABLE {entry}")
    return read


def shipped(spark: SparkSession, path: str) -> Broadcast:
    """A vocabulary file's content, read by the driver; it is as large as the vocabulary, whatever the corpus."""
    with open(path, "rb") as file:
        return spark.sparkContext.broadcast(file.read())


def slices(
    work: Callable[[pd.DataFrame], pd.DataFrame], text: str, chars: int
) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Apply ``work`` to runs of rows of about ``chars`` characters, so that memory is bounded.

    A text is never cut: one longer than ``chars`` is a run of its own.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sizes = batch[text].str.len().fillna(0).cumsum()
            for _, part in batch.groupby((sizes // chars).to_numpy(), sort=False):
                yield work(part.reset_index(drop=True))

    return run


def returned() -> None:
    """Give free memory back to the system. A Python worker lives on after its task, and others run beside it."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only some C libraries have it
    if trim:
        trim(0)


_BATCHES = ("spark.sql.parquet.columnarReaderBatchSize", "spark.sql.execution.arrow.maxRecordsPerBatch")


@contextmanager
def few_at_once(spark: SparkSession, rows: int) -> Iterator[None]:
    """What runs meanwhile reads files and sends rows to Python workers in batches of ``rows`` at most.

    Spark keeps a task's batch in one piece, as read and as sent, whatever its texts have. A smaller batch that the session asks for stays.
    """
    before = {name: spark.conf.get(name, None) for name in _BATCHES}
    try:
        for name in _BATCHES:
            asked = int(spark.conf.get(name))
            spark.conf.set(name, str(rows if asked <= 0 else min(rows, asked)))
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


_SPACES = [chr(c) for c in range(0x3001) if chr(c).isspace()]


def spaced(text: str) -> list[str] | None:
    """A text cut at its spaces, if every space stands between two words' characters, else None.

    The usual byte-level patterns match no further than to such a space, which
    begins the next word. So the parts after the first, with a space before each, can be split and
    encoded one by one. White space at the ends or beside a space is not that simple.
    """
    if not text:
        return []
    if text[0].isspace() or text[-1].isspace() or any(c in text and (" " + c in text or c + " " in text) for c in _SPACES):
        return None
    return text.split(" ")


def gathered(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """``values[start:start + size]`` for each start and size, one after the other."""
    before = np.cumsum(sizes) - sizes
    return values[np.repeat(starts - before, sizes) + np.arange(int(sizes.sum()))]
