"""One query per operator, over the test tables in ``sf_dir``."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from starmart.contracts import MARTS as MART_CONTRACTS, RAW, STAR, contract, project_to, subset
from starmart.functions.cleaning import find_rejects, normalize_strings, parse_typed
from starmart.operators.enrich import enrich
from starmart.operators.fact import resolve_store_key, resolve_supplier_key
from starmart.operators.keys import SPREAD
from starmart.operators.marts import MARTS
from starmart.operators.quality import (
    check_dense,
    check_foreign_key,
    check_nulls,
    check_numeric_fit,
    check_unique,
    reconcile,
)
from starmart.plans.jobs import check_star
from starmart.plans.layout import FULL
from starmart.plans.marts import MART_DIMENSIONS, mart_of, store_marts
from starmart.plans.star import DIMENSIONS, STAR_TABLES, Star, stage_records, stored_dims
from starmart.plans.wide import table, wide_sales
from starmart.sources.sales_csv import SOURCE_ID, load_sales, malformed_rows
from starmart.sources.staging import Staging, side_by_side
from starmart.sources.tables import ParquetStore, count_tables
from starmart.sources.versions import VersionedStore

Query = Callable[[SparkSession, str], DataFrame]


def plain(df: DataFrame) -> DataFrame:
    """Money as double and dates as ISO text, so that engines print them alike."""

    def shown(f: T.StructField):
        if isinstance(f.dataType, T.DecimalType):
            return F.col(f.name).cast("double").alias(f.name)
        if isinstance(f.dataType, T.DateType):
            return F.col(f.name).cast("string").alias(f.name)
        return F.col(f.name)

    return df.select(*[shown(f) for f in df.schema.fields])


def _star(spark: SparkSession, sf_dir: str, columns: Iterable[str] | None = None) -> Star:
    """A star over the sales records, or over some columns of them, stored once."""
    staging = Staging(spark)
    wide = wide_sales(spark, sf_dir)
    wanted = [c for c in wide.columns if columns is None or c in columns]
    return Star(stage_records(wide.select(*wanted), staging), staging)


def _stored_star(spark: SparkSession, sf_dir: str, buckets: int = 0) -> ParquetStore:
    """A star that is stored; what it was made from is deleted."""
    star = _star(spark, sf_dir)
    store = ParquetStore(spark, Staging(spark).path("star"), buckets)
    star.store(store)
    star.staging.drop()
    return store


# --- ingest -----------------------------------------------------------------


def csv_ingest_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sales records as compressed CSV text in nested folders, beside a file that is not theirs."""
    wide = wide_sales(spark, sf_dir)
    layout = subset(RAW, wide.columns)
    root = Staging(spark).path("csv")
    text = wide.select(
        F.col("sale_id").cast("string").alias(SOURCE_ID),
        *[
            (F.date_format(c, "M/d/yyyy") if c == "sale_date" else F.col(c).cast("string")).alias(c)
            for c in wide.columns
            if c != "sale_id"
        ],
        F.year("sale_date").alias("folder"),
    )
    with side_by_side(spark):
        text.write.partitionBy("folder").options(header=True, quote='"', escape='"', compression="lz4").csv(root)
    spark.range(1).select(F.lit("not a sales file").alias("value")).write.text(f"{root}/notes")
    return plain(load_sales(spark, root, "part-*.csv.lz4", layout).select(*layout.names))


def normalize_strings_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    blank = F.col("c_custkey") % 10 == 0
    padded = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.concat(F.lit("  "), F.col("c_name"), F.lit(" ")).alias("c_name"),
        F.when(blank, F.lit("   ")).otherwise(F.concat(F.col("c_mktsegment"), F.lit("  "))).alias("c_mktsegment"),
    )
    return normalize_strings(padded)


NUMBER_TEXT = contract(
    """
    long: part_number
    int: quantity
    money: price
    rating: rating
    """
)


def _number_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers as text, some with letters, fractions or too many digits."""
    line = F.col("l_linenumber")
    part = F.col("l_partkey")
    price = F.col("l_extendedprice").cast("decimal(14,2)").cast("string")
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.concat(part.cast("string"), F.when(line == 3, F.lit("x")).otherwise(F.lit(""))).alias("part_number"),
        F.concat(
            F.when(line == 5, F.lit("-")).otherwise(F.lit("")),
            F.col("l_quantity").cast("int").cast("string"),
            F.when(line == 2, F.lit(".7")).when(line == 4, F.lit("0000000000")).otherwise(F.lit("")),
        ).alias("quantity"),
        F.concat(price, F.when(line == 1, F.lit("5")).when(line == 6, F.lit(" EUR")).otherwise(F.lit(""))).alias(
            "price"
        ),
        F.when(line == 7, F.lit(None).cast("string")).otherwise((part % 120).cast("string")).alias("rating"),
    )


def typed_casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = _number_text(spark, sf_dir)
    return plain(parse_typed(text, NUMBER_TEXT, F.col("l_orderkey"), F.col("l_linenumber")))


def rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_rejects(_number_text(spark, sf_dir), NUMBER_TEXT, ["l_orderkey", "l_linenumber"])


def rejects_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV text in which the first line of each order has a cell too many and the second one too few."""
    line = F.col("l_linenumber")
    layout = subset(RAW, ["sale_id", "sale_quantity", "sale_total_price"])
    cells = F.concat_ws(
        ",",
        F.col("l_orderkey").cast("string"),
        F.col("l_quantity").cast("int").cast("string"),
        F.when(line != 2, F.col("l_partkey").cast("string")),
        F.when(line == 1, F.col("l_returnflag")),
    )
    root = Staging(spark).path("csv")
    lines = table(spark, sf_dir, "lineitem").select(cells.alias("id,sale_quantity,sale_total_price"))
    lines.write.options(header=True, sep="\u0001").csv(root)
    found = malformed_rows(load_sales(spark, root, "part-*.csv", layout, malformed=True))
    return found.select("sale_id", "source_text", F.col("source_file").contains("part-").alias("has_file"))


DATE_TEXT = contract("date: order_date")


def parse_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    day = F.col("o_orderdate").cast("date")
    text = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(key % 10 == 0, day.cast("string"))
        .when(key % 10 == 1, F.date_format(day, "MM/dd/yyyy"))
        .when(key % 10 == 2, F.date_format(day, "M/d/yy"))
        .when(key % 10 == 3, F.concat(F.lit("13/"), F.date_format(day, "d/yyyy")))
        .otherwise(F.date_format(day, "M/d/yyyy"))
        .alias("order_date"),
    )
    return plain(parse_typed(text, DATE_TEXT, F.col("o_orderkey")))


# --- star -------------------------------------------------------------------


def _dimension(name: str) -> Query:
    """A dimension is one pass over the records, so nothing is stored first."""
    return lambda spark, sf_dir: plain(Star(wide_sales(spark, sf_dir), Staging(spark)).dim(name))


def _with_store_columns(spark: SparkSession, sf_dir: str) -> Star:
    return _star(spark, sf_dir, ["sale_id", *FULL.store_key[:4], "store_state"])


def lookup_store_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = _with_store_columns(spark, sf_dir)
    return resolve_store_key(star.raw, star.members("dim_stores"), star.layout.store_key).drop(SPREAD)


def lookup_store_key_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same where some sales lack the store's location, its city or both."""
    wide = wide_sales(spark, sf_dir).select("sale_id", *FULL.store_key[:4])
    lacking = {
        c: F.when(F.col("sale_id") % every != 0, F.col(c)) for c, every in (("store_location", 5), ("store_city", 7))
    }
    staging = Staging(spark)
    star = Star(stage_records(wide.withColumns(lacking), staging), staging)
    return resolve_store_key(star.raw, star.members("dim_stores"), star.layout.store_key).drop(SPREAD)


def _supplier_lookup(null_safe: bool) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        star = _star(spark, sf_dir, ["sale_id", "supplier_name", "supplier_city", "supplier_country"])
        suppliers = star.members("dim_suppliers")
        return resolve_supplier_key(star.raw, suppliers, star.layout.suppliers, null_safe).drop(SPREAD)

    return run


def fact_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(_star(spark, sf_dir).fact())


def enriched_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = _stored_star(spark, sf_dir)
    return plain(enrich(store.read("fact_sales"), stored_dims(store)))


def enriched_sales_large_dims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with every dimension joined as if it were too large to broadcast."""
    store = _stored_star(spark, sf_dir)
    return plain(enrich(store.read("fact_sales"), stored_dims(store), broadcast_bytes=0))


def enriched_sales_clustered_dims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with dimensions in buckets of their keys, which their joins leave in place."""
    store = _stored_star(spark, sf_dir, buckets=int(spark.conf.get("spark.sql.shuffle.partitions")))
    return plain(enrich(store.read("fact_sales"), stored_dims(store), broadcast_bytes=0))


# --- marts ------------------------------------------------------------------

# Raw columns behind each dimension a mart reads.
_MART_SOURCES = {
    "dim_products": ("sale_product_id", *FULL.products),
    "dim_customers": ("sale_customer_id", *FULL.customers),
    "dim_stores": FULL.stores,
    "dim_suppliers": FULL.suppliers,
    "dim_dates": ("sale_date",),
}


def mart_star(spark: SparkSession, sf_dir: str, mart: str) -> Star:
    """A star over just the raw columns that one mart needs."""
    needed = {"sale_id", "sale_quantity", "sale_total_price"}
    for dimension in MART_DIMENSIONS[mart]:
        needed.update(_MART_SOURCES[dimension])
    return _star(spark, sf_dir, needed)


def _mart(name: str) -> Query:
    return lambda spark, sf_dir: mart_of(mart_star(spark, sf_dir, name), name)


# --- rules, counts, refresh -------------------------------------------------


def dq_pk_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return check_unique(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def dq_dense_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order numbers of which every tenth is missing and every seventh of the rest comes twice."""
    key = F.col("o_orderkey")
    orders = table(spark, sf_dir, "orders").select("o_orderkey").where(key % 10 != 0)
    found = check_dense(orders.unionAll(orders.where(key % 7 == 0)), "o_orderkey")
    return found.select(F.col("bound").cast("bigint").alias("bound"), F.col("balance").cast("bigint").alias("balance"))


def dq_fk_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = Star(wide_sales(spark, sf_dir), Staging(spark))
    incomplete = star.dim("dim_products").where(F.col("product_key") % 10 != 0)
    return check_foreign_key(star.fact(["product_key"]), "product_key", incomplete)


def dq_numeric_overflow(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return check_numeric_fit(lines, "l_extendedprice", T.DecimalType(6, 2))


def dq_null_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    mart = "mart_sales_suppliers"
    return check_nulls(mart_of(mart_star(spark, sf_dir, mart), mart, limit=False), MART_CONTRACTS[mart])


def dq_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = _star(spark, sf_dir)
    return reconcile(star.raw, star.fact())


def table_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = _stored_star(spark, sf_dir)
    store_marts(store, store, Staging(spark))
    return count_tables(store, [*STAR_TABLES, *MARTS])


def full_refresh_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customer mart, published twice in one folder."""
    mart = "mart_sales_customers"
    store = VersionedStore(spark, Staging(spark).path("marts"))
    star = mart_star(spark, sf_dir, mart)
    for _ in range(2):
        store.write(mart_of(star, mart), mart, MART_CONTRACTS[mart])
    return project_to(store.read(mart), MART_CONTRACTS[mart])


def full_refresh_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All star tables, published from half of the sales and again from all: rows and keys of each."""
    wide = wide_sales(spark, sf_dir)
    store = VersionedStore(spark, Staging(spark).path("star"))
    for sales in (wide.where(F.col("sale_id") % 2 == 0), wide):
        staging, draft = Staging(spark), store.draft()
        raw = stage_records(sales, staging)
        Star(raw, staging).store(draft)
        check_star(draft, raw.count())
        store.publish(draft, STAR_TABLES)
        staging.drop()
    target = store.snapshot()

    def keys(name: str) -> DataFrame:
        key = F.col(STAR[name].names[0]).cast("long")
        return target.read(name).select(key.alias("key")).agg(
            F.lit(name).alias("table_name"),
            F.count(F.lit(1)).alias("row_count"),
            F.count_distinct("key").alias("key_count"),
            F.min("key").alias("first_key"),
            F.max("key").alias("last_key"),
        )

    return reduce(DataFrame.unionByName, map(keys, STAR_TABLES))


QUERIES: dict[str, Query] = {
    "csv_ingest_typed": csv_ingest_typed,
    "normalize_strings": normalize_strings_query,
    "typed_casts": typed_casts,
    "parse_dates": parse_dates,
    "rejects": rejects,
    "rejects_malformed": rejects_malformed,
    **{name: _dimension(name) for name in DIMENSIONS},
    "lookup_store_key": lookup_store_key,
    "lookup_store_key_nulls": lookup_store_key_nulls,
    "lookup_supplier_key": _supplier_lookup(null_safe=False),
    "lookup_supplier_key_nullsafe": _supplier_lookup(null_safe=True),
    "fact_sales": fact_sales,
    "enriched_sales": enriched_sales,
    "enriched_sales_large_dims": enriched_sales_large_dims,
    "enriched_sales_clustered_dims": enriched_sales_clustered_dims,
    **{name: _mart(name) for name in MARTS},
    "dq_pk_violations": dq_pk_violations,
    "dq_dense_key": dq_dense_key,
    "dq_fk_violations": dq_fk_violations,
    "dq_numeric_overflow": dq_numeric_overflow,
    "dq_null_contract": dq_null_contract,
    "dq_reconcile": dq_reconcile,
    "table_counts": table_counts,
    "full_refresh_idempotent": full_refresh_idempotent,
    "full_refresh_star": full_refresh_star,
}
