"""What a stored star and its joins leave on disk and move over it."""

import os
import time

import pytest
from pyspark.sql import functions as F

from conftest import typed_sales
from starmart import queries
from starmart.operators.enrich import enrich
from starmart.operators.keys import frequent_rows
from starmart.plans.star import STAR_TABLES, Star, stage_records
from starmart.sources.staging import shared_folder, shuffles_freed
from starmart.sources.tables import ParquetStore

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _sales(spark, n):
    return typed_sales(spark, *[{"sale_id": i, "sale_customer_id": i % 40, "sale_product_id": i % 30, "supplier_name": f"s{i % 7}"} for i in range(n)])


def _shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = [files.apply(i).getName() for i in range(files.size())]
    return {n for n in names if n.startswith("shuffle_") and n.endswith(".data")}


def _stored(spark):
    return {os.path.join(at, n) for at, _, names in os.walk(shared_folder(spark).removeprefix("file:")) for n in names if n.endswith(".parquet")}


def _walk(plan):
    yield plan
    children = plan.children()
    for i in range(children.size()):
        yield from _walk(children.apply(i))


def test_storing_a_star_leaves_no_shuffle_files(spark, staging):
    sales = _sales(spark, 300)
    before, setting = _shuffle_files(spark), spark.conf.get(_CLEANUP)
    store = ParquetStore(spark, staging.path("star"))
    Star(stage_records(sales.repartition(3, "sale_id"), staging), staging).store(store)
    until = time.time() + 10
    while _shuffle_files(spark) - before and time.time() < until:  # deleted in the background
        time.sleep(0.2)
    assert _shuffle_files(spark) - before == set()
    assert store.read("fact_sales").count() == 300 and spark.conf.get(_CLEANUP) == setting


def test_cleanup_ends_with_its_block(spark):
    before = spark.conf.get(_CLEANUP)
    with pytest.raises(RuntimeError), shuffles_freed(spark):
        assert spark.conf.get(_CLEANUP) == "true"
        raise RuntimeError
    assert spark.conf.get(_CLEANUP) == before


def test_a_stored_star_is_all_that_stays(spark, monkeypatch):
    monkeypatch.setattr(queries, "wide_sales", lambda spark, sf_dir: _sales(spark, 200))
    before = _stored(spark)
    for query in (queries.enriched_sales, queries.enriched_sales_large_dims):
        assert query(spark, "").where("customer_name = 'Ann Lee'").count() == 200
    tables = [os.path.dirname(f) for f in _stored(spark) - before]
    assert tables and {os.path.basename(t) for t in tables} == set(STAR_TABLES)


def test_a_large_join_moves_each_column_once(no_broadcast, staging):
    spark = no_broadcast
    store = ParquetStore(spark, staging.path("star"))
    Star(_sales(spark, 200), staging).store(store)
    dims = {"dim_customers": store.read("dim_customers")}
    rows = enrich(store.read("fact_sales"), dims, broadcast_bytes=0)
    moved = [p for p in _walk(rows._jdf.queryExecution().executedPlan()) if "hashpartitioning(_route" in p.simpleString(1000)]
    assert len(moved) == 1
    names = [moved[0].output().apply(i).name() for i in range(moved[0].output().size())]
    assert {"sale_key", "_route"} <= set(names) and not {"customer_key", "_spread"} & set(names)
    assert len(names) == len(store.read("fact_sales").columns) + 2
    assert rows.where("customer_key = source_sale_id % 40 AND customer_first_name = 'Ann'").count() == 200


@pytest.mark.parametrize("on", [["k"], ["k", "l"]])
def test_frequent_rows_are_exact_without_a_row_per_key(no_broadcast, on):
    spark = no_broadcast
    n = 30_000
    hot = F.when(F.col("id") % 10 < 3, F.lit(7)).when(F.col("id") % 10 == 3, F.lit(None)).when(F.col("id") % 1000 == 4, F.lit(11))
    left = spark.range(0, n, 1, 4).select(hot.otherwise(F.col("id")).cast("long").alias("k"), (F.col("id") % 2).alias("l"))
    right = left.dropna().distinct().withColumn("v", F.lit(1)) if len(on) == 2 else left.select("k").dropna().distinct()
    total = left.dropna().count()
    expected = {tuple(r)[:-1] for r in left.dropna().groupBy(*on).count().collect() if r["count"] * 100 >= total}
    found = frequent_rows(left, right, on, share=100)
    keys = found.select(*on)
    assert {tuple(r) for r in keys.collect()} == expected and expected
    few = [p for p in _walk(keys._jdf.queryExecution().executedPlan()) if p.nodeName() == "BroadcastExchange"][0]
    written = [p.metrics().apply("shuffleRecordsWritten").value() for p in _walk(few) if p.nodeName() == "Exchange"]
    assert written and sum(written) < n / 2
