"""The batch jobs: ``python -m starmart.plans.jobs star|marts|all [options]``.

Without a folder the job uses the database that the environment describes. Folders hold published versions
(``VersionedStore``); ``all`` publishes star and marts together.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from starmart.contracts import RAW, STAR
from starmart.functions.cleaning import explode_rejects
from starmart.operators.enrich import DIMENSION_KEYS
from starmart.operators.quality import check_dense, check_foreign_key, check_unique
from starmart.plans.marts import store_marts
from starmart.plans.star import DIMENSIONS, STAR_TABLES, Star, stage_records
from starmart.sources.sales_csv import REJECTED, SALES_FILES, load_sales, malformed_rows
from starmart.sources.settings import driver_jars, mart_database, source_root, star_database
from starmart.sources.staging import Staging
from starmart.sources.tables import JdbcStore, ParquetStore, at_once, count_tables
from starmart.sources.versions import VersionedStore

RAW_TABLE = "mock_data"  # fixed value: name of the stored raw records
REJECTS_TABLE = "rejects"
MALFORMED_TABLE = "malformed_rows"

NUMBERED = ("dim_stores", "dim_suppliers", "fact_sales")  # tables whose key is 1..N

Target = ParquetStore | VersionedStore | JdbcStore


def draft_star(
    spark: SparkSession,
    root: str,
    draft: ParquetStore,
    staging: Staging,
    name_glob: str = SALES_FILES,
    multi_line: bool = True,
    same_header: bool = False,
) -> tuple[DataFrame, dict[str, int], dict[str, DataFrame]]:
    """CSV files to a checked star in ``draft``: the typed records, the rows per star table, and the frames of losses.

    The files are parsed once. All parts of the star then read the staged,
    typed records, of which each part scans only its own columns.
    """
    raw = stage_records(load_sales(spark, root, name_glob, RAW, multi_line, same_header, malformed=True), staging)
    stored = Star(raw, staging).store(draft)
    check_star(draft, raw.count())
    lost = {REJECTS_TABLE: explode_rejects(raw, REJECTED), MALFORMED_TABLE: malformed_rows(raw)}
    return raw, {name: stored[name] for name in STAR_TABLES}, lost


def run_star_job(
    spark: SparkSession,
    root: str,
    target: Target,
    name_glob: str = SALES_FILES,
    multi_line: bool = True,
    same_header: bool = False,
    rejects_to: ParquetStore | VersionedStore | None = None,
    with_marts: bool = False,
) -> dict[str, int]:
    """CSV files to raw table, star tables and rejects; the rows written per table.

    Rejects go to ``rejects_to``, or beside the star tables if those are files; a
    database target needs ``rejects_to``, so that no value is lost unseen. Rows with too many or too few cells are kept as
    records and listed with file and text beside the rejects.

    The star is complete and checked in a draft before any target table changes. A versioned folder then shows all tables
    in one step, together with the marts if ``with_marts`` builds them too. In a plain folder the draft's tables are moved to
    their places; a database gets them one after the other.
    """
    losses = rejects_to or (None if isinstance(target, JdbcStore) else target)
    if losses is None:
        raise ValueError("a database target needs a folder for rejects (--rejects)")
    if with_marts and not isinstance(target, VersionedStore):
        raise ValueError("star and marts can only be published together in a versioned folder")
    staging = Staging(spark)
    drafts = Staging(spark, f"{target.root}/_draft") if isinstance(target, ParquetStore) else staging
    draft = target.draft() if isinstance(target, VersionedStore) else ParquetStore(spark, f"{drafts.root}/star")
    published = False
    try:
        raw, stored, lost = draft_star(spark, root, draft, staging, name_glob, multi_line, same_header)
        if isinstance(target, JdbcStore):
            written = {RAW_TABLE: target.write(raw, RAW_TABLE, RAW)}
            for name in STAR_TABLES:
                written[name] = target.write(draft.read(name), name, STAR[name])
            return written | {name: losses.write(df, name, df.schema) for name, df in lost.items()}
        written = {RAW_TABLE: draft.write(raw, RAW_TABLE, RAW), **stored}
        losses_here = draft if losses is target else losses
        written |= {name: losses_here.write(df, name, df.schema) for name, df in lost.items()}
        if with_marts:
            written |= store_marts(draft, draft, staging)
        names = [name for name in written if name not in lost or losses is target]
        if isinstance(target, VersionedStore):
            target.publish(draft, names)
        else:
            target.replace(draft, names)
        published = True
        return written
    finally:
        if isinstance(target, VersionedStore) and not published:
            target.discard(draft)
        staging.drop()
        if drafts is not staging:
            drafts.drop()


def check_star(store: ParquetStore, raw_rows: int | None = None) -> None:
    """Stop before publishing a star with repeated, missing or unresolved keys, or with lost sales.

    Keys that number the rows 1..N are checked by ``check_dense``, which shuffles next to nothing of a table sorted by
    its key; the others by counting.
    """
    fact = store.read("fact_sales")
    checks = {f"key of {name}": check_dense(store.read(name), STAR[name].names[0]) for name in NUMBERED}
    for name in DIMENSIONS:
        key = DIMENSION_KEYS[name]
        if name not in NUMBERED:
            checks[f"key of {name}"] = check_unique(store.read(name), [key])
        checks[f"{key} of fact_sales"] = check_foreign_key(fact, key, store.read(name))
    clean = at_once({what: violations.isEmpty for what, violations in checks.items()})
    broken = [what for what, passed in clean.items() if not passed]

    n, storeless = fact.agg(F.count(F.lit(1)), F.count_if(F.col("store_key").isNull())).first()
    if storeless:
        broken.append(f"store_key of fact_sales is NULL in {storeless} rows")
    if raw_rows is not None and raw_rows != n:
        broken.append(f"fact_sales has {n} of {raw_rows} raw records")
    if broken:
        raise ValueError(f"star not published, rules broken: {', '.join(broken)}")


def run_marts_job(spark: SparkSession, star: Target, target: Target, connections: int = 32) -> dict[str, int]:
    """Stored star to stored marts. A database is read once, into staging.

    A versioned star is read from one version of it. A versioned target shows all marts in one step, and none if
    it is the star's folder too and the star has changed meanwhile.
    """
    staging = Staging(spark)
    made_from, draft = None, None
    try:
        if isinstance(star, JdbcStore):
            copy = ParquetStore(spark, f"{staging.root}/star")
            for name in STAR_TABLES:
                split = star.key_split(name, STAR[name].names[0], connections)
                copy.write(star.read(name, STAR[name], split), name, STAR[name])
            star = copy
        if isinstance(star, VersionedStore):
            read = star.snapshot()
            if isinstance(target, VersionedStore) and target.root == star.root:
                made_from = read
            star = read
        if not isinstance(target, VersionedStore):
            return store_marts(star, target, staging)
        draft = target.draft()
        written = store_marts(star, draft, staging)
        target.publish(draft, list(written), made_from)
        draft = None
        return written
    finally:
        if draft is not None:
            target.discard(draft)
        staging.drop()


def main(arguments: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="starmart")
    parser.add_argument("job", choices=["star", "marts", "all"])
    parser.add_argument("--source", help="folder of sales files (star, all) or of star tables (marts)")
    parser.add_argument("--target", help="folder for the tables; a database if left out")
    parser.add_argument("--same-header", action="store_true", help="all sales files have one header (star)")
    parser.add_argument("--single-line", action="store_true", help="no line ends inside cells (star)")
    parser.add_argument("--rejects", help="folder for values that could not be typed (star)")
    parser.add_argument("--buckets", type=int, default=0, help="buckets of dimensions in a target folder (star, all); none if left out")
    chosen = parser.parse_args(arguments)

    builder = SparkSession.builder.appName(f"starmart-{chosen.job}")
    if driver_jars():
        builder = builder.config("spark.jars", driver_jars())
    spark = builder.getOrCreate()
    try:
        if chosen.job != "marts":
            target = VersionedStore(spark, chosen.target, buckets=chosen.buckets) if chosen.target else star_database(spark)
            losses = VersionedStore(spark, chosen.rejects) if chosen.rejects else None
            written = run_star_job(
                spark,
                chosen.source or source_root(),
                target,
                multi_line=not chosen.single_line,
                same_header=chosen.same_header,
                rejects_to=losses,
                with_marts=chosen.job == "all",
            )
            tables = [name for name in written if name not in (REJECTS_TABLE, MALFORMED_TABLE)]
        else:
            source = VersionedStore(spark, chosen.source) if chosen.source else star_database(spark)
            target = VersionedStore(spark, chosen.target) if chosen.target else mart_database(spark)
            tables = list(run_marts_job(spark, source, target))
        count_tables(target, tables).orderBy(F.col("table_name")).show(truncate=False)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
