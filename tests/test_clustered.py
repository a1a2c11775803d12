"""Dimensions in buckets of their key: the same rows, and joins that leave them where they are."""

import json

import pytest
from pyspark.sql import functions as F, types as T

from conftest import write_sales
from starmart.contracts import DIMENSION_KEYS, MARTS, STAR, contract
from starmart.operators.enrich import enrich
from starmart.operators.keys import SPREAD, lookup
from starmart.plans.jobs import run_marts_job, run_star_job
from starmart.plans.star import STAR_TABLES, stored_dims
from starmart.sources.clustered import read_clustered, write_clustered
from starmart.sources.tables import ParquetStore
from starmart.sources.versions import VersionedStore

CUSTOMERS = STAR["dim_customers"]


def _customers(spark, n):
    text = F.concat(F.lit("x"), F.col("id").cast("string"))
    return spark.range(n).select(*[text.alias(f.name) if f.dataType == T.StringType() else F.col("id").cast(f.dataType).alias(f.name) for f in CUSTOMERS])


def _shuffles(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def _sorted(df):
    return sorted(map(repr, df.collect()))


def _entries(spark):
    return [t.name for t in spark.catalog.listTables() if t.name.startswith("clustered_")]


def test_rows_are_stored_once_per_bucket(spark, tmp_path):
    path = str(tmp_path / "it's a folder")
    rows = spark.range(100).select(F.col("id").alias("a.key"), F.col("id").cast("string").alias("v"))
    write_clustered(rows, path, "a.key", 16)
    read = read_clustered(spark, path, "a.key", 16)
    assert _sorted(read) == _sorted(rows) == _sorted(spark.read.parquet(path))
    assert 1 < len(list((tmp_path / "it's a folder").glob("*.parquet"))) <= 16
    write_clustered(rows.limit(5), path, "a.key", 16, refresh=False)
    assert read_clustered(spark, path, "a.key", 16).count() == 105
    write_clustered(rows.where("v > '97'"), path, "a.key", 16)
    assert read_clustered(spark, path, "a.key", 16).count() == 2
    write_clustered(rows.limit(0), path, "a.key", 16)
    assert read_clustered(spark, path, "a.key", 16, rows.schema).count() == 0
    assert _entries(spark) == []


def test_no_entry_stays_after_a_failure(spark, tmp_path):
    bad = spark.range(3).select(F.raise_error(F.lit("lost")).cast("long").alias("k"))
    with pytest.raises(Exception, match="lost"):
        write_clustered(bad, str(tmp_path / "t"), "k", 4)
    with pytest.raises(Exception):
        read_clustered(spark, str(tmp_path / "absent"), "k", 4)
    assert _entries(spark) == []


def test_a_large_dimension_is_not_shuffled(no_broadcast, tmp_path):
    spark = no_broadcast
    n = 4_000
    keys = F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 3 == 1, F.lit(None)).otherwise(F.col("id") - 100)
    fact = ParquetStore(spark, str(tmp_path / "fact"))
    fact.write(spark.range(n).select(keys.cast("long").alias("customer_key"), F.col("id").alias("sale_key")), "t", contract("long: customer_key sale_key"))
    sales, found = fact.read("t"), {}
    for buckets in (0, 8):
        store = ParquetStore(spark, str(tmp_path / f"dims{buckets}"), buckets)
        assert store.write(_customers(spark, n // 2), "dim_customers", CUSTOMERS) == n // 2
        found[buckets] = enrich(sales, {"dim_customers": store.read("dim_customers")}, broadcast_bytes=0)
    assert _sorted(found[0]) == _sorted(found[8])
    assert found[8].where("customer_first_name = 'x7'").count() >= n // 3
    assert _shuffles(found[0]) - _shuffles(found[8]) == 1
    plan = found[8]._jdf.queryExecution().executedPlan().toString()
    assert "SelectedBucketsCount: 8 out of 8" in plan and "Exchange hashpartitioning(_route" in plan


def test_scattered_rows_do_not_meet_keys(no_broadcast):
    """Rows without a key carry numbers in its place, which other rows have as keys."""
    spark = no_broadcast
    for kind in ("int", "long"):
        left = spark.range(200).select(F.when(F.col("id") % 2 == 0, F.col("id")).cast(kind).alias("k"), (F.lit(2**40) + F.col("id")).alias(SPREAD))
        right = spark.range(-50, 2_000).select(F.col("id").cast(kind).alias("k"), F.col("id").alias("v"), F.lit(1).alias("n"))
        frequent = right.where("k < 20")
        left = left.withColumn(SPREAD, F.pmod(F.col(SPREAD), F.lit(2_000)))
        for few in (None, frequent):
            rows = lookup(left, right, ["k"], ["v"], frequent=few).collect()
            assert len(rows) == 200 and all(r.v == r.k for r in rows)


def test_versions_say_how_a_table_is_stored(spark, tmp_path):
    store, plain = VersionedStore(spark, str(tmp_path), buckets=4), VersionedStore(spark, str(tmp_path))
    store.write(_customers(spark, 10), "dim_customers", CUSTOMERS)
    store.write(spark.range(3).toDF("k"), "other", contract("long: k"))
    assert dict(plain.snapshot().buckets) == {"dim_customers": 4}
    assert plain.read("dim_customers").count() == 10
    plain.write(_customers(spark, 2), "dim_customers", CUSTOMERS, refresh=False)  # two folders are no buckets
    assert plain.read("dim_customers").count() == 12 and dict(plain.snapshot().buckets) == {}
    store.write(_customers(spark, 5), "dim_customers", CUSTOMERS)
    older = store.snapshot()
    plain.write(_customers(spark, 6), "dim_customers", CUSTOMERS)
    assert older.read("dim_customers").count() == 5 and dict(plain.snapshot().buckets) == {}
    assert plain.read("dim_customers").count() == 6


def test_versions_written_before_buckets_are_read(spark, tmp_path):
    store = VersionedStore(spark, str(tmp_path))
    store.write(_customers(spark, 10), "dim_customers", CUSTOMERS)
    file = max((tmp_path / "versions").glob("*.json"))
    held = json.loads(file.read_text())
    file.write_text(json.dumps({"tables": held["tables"]}))
    for checksum in (tmp_path / "versions").glob(".*.crc"):
        checksum.write_bytes(b"")
        checksum.unlink()
    assert store.read("dim_customers").count() == 10


def test_jobs_on_clustered_dimensions(spark, tmp_path):
    """Star and marts are the same whether dimensions lie in buckets or not."""
    write_sales(tmp_path / "sales" / "a.csv", *[{"id": str(k), "sale_customer_id": str(k % 5), "sale_product_id": str(k % 3)} for k in range(1, 30)])
    stores = [VersionedStore(spark, str(tmp_path / f"to{n}"), buckets=n) for n in (0, 8)]
    written = [run_star_job(spark, str(tmp_path / "sales"), store, name_glob="*.csv") for store in stores]
    assert written[0] == written[1]
    assert set(stores[1].snapshot().buckets) == set(DIMENSION_KEYS)
    marts = [run_marts_job(spark, store, store) for store in stores]
    assert marts[0] == marts[1]
    for name in [*STAR_TABLES, *MARTS]:
        assert _sorted(stores[0].read(name)) == _sorted(stores[1].read(name)), name
    enriched = [enrich(s.read("fact_sales"), stored_dims(s.snapshot()), broadcast_bytes=0) for s in stores]
    assert _sorted(enriched[0]) == _sorted(enriched[1])
