"""Flat sales files: many headered CSVs below one folder, read as one frame."""

from __future__ import annotations

import csv
import re
from collections.abc import Iterator
from urllib.parse import unquote

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from starmart.contracts import RAW
from starmart.functions.cleaning import normalize_strings, parse_with_rejects

# Which files count as sales files, and the one renamed column.
SALES_FILES = "*MOCK_DATA*.csv"
SOURCE_ID = "id"
SALE_ID = "sale_id"

REJECTED = "rejected_values"
MALFORMED = "malformed_row"  # struct of the file and the text of a row with too many or too few cells
_ROW_TEXT = "_malformed_text"

SMALL_FILE = 256 * 1024  # bytes up to which a whole file is read for its first line
HEADERS = 1_000  # different first lines that the driver takes
COMPRESSED = r"\.(gz|bz2|lz4|snappy|zst)$"  # names of files that only a text scan unpacks
_WHOLE = str(1 << 40)  # bytes of a scan's task, so that a file is a task


def find_sales_files(spark: SparkSession, root: str, name_glob: str = SALES_FILES) -> list[str]:
    """All matching files at any depth, sorted; an error if there is none."""
    found = _below(spark, root, name_glob).text(root).inputFiles()
    if not found:
        raise FileNotFoundError(f"no file matching {name_glob} below {root}")
    return sorted(unquote(path) for path in found)


def read_sales_csv(
    spark: SparkSession,
    root: str,
    name_glob: str = SALES_FILES,
    schema: T.StructType = RAW,
    multi_line: bool = True,
    same_header: bool = False,
) -> DataFrame:
    """The columns of ``schema`` as cleaned text, from all matching files.

    A headered scan takes its names from one file and reads the others by
    position. So executors look at the first line of every file (``header_groups``), files with the same
    header are scanned together, and the scans are joined by name.

    ``multi_line`` allows line ends inside quotes. Spark cannot split such a
    file, so very large input should come as many files; without line ends in
    cells, turn it off and any file is split.

    ``same_header`` promises one header for all files, so that only one of very
    many files is looked at. A file that breaks the promise stops the job.
    """
    return _cleaned(spark, root, name_glob, schema, multi_line, same_header).drop(MALFORMED)


def _cleaned(
    spark: SparkSession, root: str, name_glob: str, schema: T.StructType, multi_line: bool, same_header: bool
) -> DataFrame:
    """What ``read_sales_csv`` returns, and ``MALFORMED``."""
    groups = header_groups(spark, root, name_glob, same_header)
    files = file_names(spark, root, name_glob) if len(groups) > 1 else {}

    frame = None
    for header, example in groups.items():
        names = [SALE_ID if name == SOURCE_ID else name for name in header]
        missing = [name for name in schema.names if name not in names]
        if missing:
            raise ValueError(f"{example} lacks columns: {', '.join(missing)}")
        text = T.StructType([T.StructField(name, T.StringType()) for name in [*header, _ROW_TEXT]])
        reader = spark.read if len(groups) > 1 else _below(spark, root, name_glob)
        scan = (
            reader.schema(text)
            .options(header=True, multiLine=multi_line, quote='"', escape='"', mode="PERMISSIVE")
            .option("enforceSchema", False)  # a header that differs after all stops the job
            .option("columnNameOfCorruptRecord", _ROW_TEXT)
            .csv([_literal(path) for path in files[header]] if len(groups) > 1 else root)
        )
        source = F.struct(F.col("_metadata.file_path").alias("source_file"), F.col(_ROW_TEXT).alias("source_text"))
        malformed = F.when(F.col(_ROW_TEXT).isNotNull(), source).alias(MALFORMED)
        part = normalize_strings(scan.withColumnRenamed(SOURCE_ID, SALE_ID).select(*schema.names, malformed))
        frame = part if frame is None else frame.unionByName(part)
    return frame


def load_sales(
    spark: SparkSession,
    root: str,
    name_glob: str = SALES_FILES,
    schema: T.StructType = RAW,
    multi_line: bool = True,
    same_header: bool = False,
    malformed: bool = False,
) -> DataFrame:
    """Typed sales records, with the values that typing lost in ``REJECTED``.

    ``malformed`` adds ``MALFORMED``, the file and text of a row with too many or too few
    cells, else NULL. Such a row stays a record of the cells that it has. All
    come from one parse; ``explode_rejects`` and ``malformed_rows`` make tables of the losses.
    """
    text = _cleaned(spark, root, name_glob, schema, multi_line, same_header)
    return parse_with_rejects(text, schema, [SALE_ID], REJECTED, *([MALFORMED] if malformed else []))


def malformed_rows(df: DataFrame) -> DataFrame:
    """(``sale_id``, ``source_file``, ``source_text``) of the records whose row had too many or too few cells."""
    return df.where(F.col(MALFORMED).isNotNull()).select(SALE_ID, f"{MALFORMED}.*")


def _below(spark: SparkSession, root: str, name_glob: str):
    return spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", name_glob)


def _literal(path: str) -> str:
    """A path in which no character acts as a pattern."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


# --- headers ----------------------------------------------------------------


def small_first_lines(spark: SparkSession, root: str, name_glob: str) -> DataFrame:
    """(``path``, ``line``) of the files of up to ``SMALL_FILE`` bytes, many of them to a task. None that is compressed."""
    files = _below(spark, root, name_glob).format("binaryFile").load(root).where(F.col("length") <= SMALL_FILE)
    files = files.where(~F.col("path").rlike(COMPRESSED))
    line = F.regexp_extract(F.col("content").cast("string"), r"^\x{FEFF}?([^\r\n]*)", 1)
    return files.select("path", line.alias("line"))


def large_first_lines(spark: SparkSession, root: str, name_glob: str) -> DataFrame:
    """The same of the larger and the compressed files, each a task that stops after the first rows.

    The scan belongs to a session of its own, in which a file is not split or joined with others.
    """
    session = spark.newSession()
    for name in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"):
        session.conf.set(name, _WHOLE)
    session.conf.unset("spark.sql.files.maxPartitionNum")
    large = (F.col("_metadata.file_size") > SMALL_FILE) | F.col("_metadata.file_path").rlike(COMPRESSED)
    scan = _below(session, root, name_glob).text(root).where(large)

    def first(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                if batch["start"].iloc[0] == 0:
                    yield pd.DataFrame({"path": [unquote(batch["path"].iloc[0])], "line": [batch["value"].iloc[0]]})
                return

    rows = scan.select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"))
    return rows.mapInPandas(first, "path string, line string")


def _names(line: str, path: str) -> tuple[str, ...]:
    names = tuple(next(csv.reader([line.lstrip("\ufeff")]), []))
    repeated = sorted({n for n in names if names.count(n) > 1})
    if repeated:
        raise ValueError(f"{path} repeats columns: {', '.join(repeated)}")
    return names


def header_groups(spark: SparkSession, root: str, name_glob: str = SALES_FILES, same_header: bool = False) -> dict[tuple[str, ...], str]:
    """The different headers of all matching files, each with the first file that has it; an error if there is no file.

    First lines are read and grouped by executors, and only the different ones come to the driver, ``HEADERS`` of them at
    most. Files without a byte have no records and are passed over. ``same_header`` looks at one file only.
    """
    listed = _below(spark, root, name_glob).format("binaryFile").load(root)
    files, first = listed.agg(F.count(F.lit(1)), F.min("path")).first()
    if not files:
        raise FileNotFoundError(f"no file matching {name_glob} below {root}")
    if same_header:
        line = spark.read.text(_literal(first)).first()
        return {_names(line[0] if line else "", first): first}
    found = []
    for lines in (small_first_lines(spark, root, name_glob), large_first_lines(spark, root, name_glob)):
        grouped = lines.groupBy("line").agg(F.min("path").alias("path"), F.count(F.lit(1)).alias("files"))
        found += grouped.limit(HEADERS + 1).collect()
    seen = sum(r["files"] for r in found)
    if len(found) > HEADERS:
        raise ValueError(f"the files below {root} have more than {HEADERS} different first lines")
    if seen != files:
        raise OSError(f"{files} files below {root}, first lines of {seen}: they changed meanwhile")
    groups: dict[tuple[str, ...], str] = {}
    for r in sorted(found, key=lambda r: r["path"]):
        groups.setdefault(_names(r["line"], r["path"]), r["path"])
    return groups


def file_names(spark: SparkSession, root: str, name_glob: str = SALES_FILES) -> dict[tuple[str, ...], list[str]]:
    """The files of each header. Only needed where headers differ, since a scan of some files has to be told which."""
    found = [r for read in (small_first_lines, large_first_lines) for r in read(spark, root, name_glob).collect()]
    groups: dict[tuple[str, ...], list[str]] = {}
    for r in sorted(found, key=lambda r: r["path"]):
        groups.setdefault(_names(r["line"], r["path"]), []).append(r["path"])
    return groups
