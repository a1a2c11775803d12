import datetime
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import typed_sales
from starmart.contracts import STAR
from starmart.operators.fact import resolve_supplier_key
from starmart.plans.star import DIMENSIONS, STAR_TABLES, Star
from starmart.sources.staging import Staging
from starmart.sources.tables import ParquetStore


def _same(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def _sales(seed, n):
    """Records with every awkwardness: NULLs, repeats, copies and hot keys."""
    draw = random.Random(seed)
    changes = []
    for i in range(n):
        hot = draw.random() < 0.35
        changes.append(
            {
                "sale_id": draw.choice([None, i // 3, i]),
                "sale_date": draw.choice([None, datetime.date(2021, 1 + i % 12, 1 + i % 28)]),
                "sale_customer_id": 1 if hot else draw.choice([None, i % 40]),
                "customer_first_name": draw.choice(["Ann", "Al", None]),
                "sale_product_id": 5 if hot else i % 30,
                "product_price": Decimal(draw.randint(0, 5000)) / 100,
                "store_name": "Hot" if hot else draw.choice([None, "", f"s{i % 25}"]),
                "store_state": draw.choice([None, "A", "B"]),
                "supplier_name": "Hot" if hot else f"p{i % 20}",
                "supplier_city": draw.choice(["Quito", None]),
                "sale_total_price": Decimal(draw.randint(0, 99999)) / 100,
            }
        )
    return changes + changes[: n // 3]  # a third comes twice


def test_natural_key_dimension(spark, staging):
    raw = typed_sales(
        spark,
        {"sale_id": 2, "sale_customer_id": 7, "customer_first_name": "Late"},
        {"sale_id": 1, "sale_customer_id": 7, "customer_first_name": "Zed"},
        {"sale_id": 1, "sale_customer_id": 7, "customer_first_name": "Amy"},
        {"sale_id": 3, "sale_customer_id": None},
        {"sale_id": 4, "sale_customer_id": 8, "customer_age": None},
    )
    rows = {r.customer_key: r for r in Star(raw, staging).dim("dim_customers").collect()}
    assert set(rows) == {7, 8}
    assert (rows[7].customer_first_name, rows[7].sale_customer_id) == ("Amy", 7)
    assert rows[8].customer_age is None


def test_store_keys(spark, staging):
    raw = typed_sales(
        spark,
        {"store_name": "a||b", "store_location": "c"},
        {"store_name": "a", "store_location": "b||c"},
        {"store_name": "0", "store_state": "Z"},
        {"store_name": "0", "store_state": "B"},
        {"store_name": "0", "store_state": None, "store_phone": "556"},
        {"store_name": None},
        {"store_name": ""},
    )
    star = Star(raw, staging)
    stores = star.dim("dim_stores").orderBy("store_key").collect()
    assert [r.store_key for r in stores] == [1, 2, 3, 4, 5]
    # An empty name makes the joined text start with the separator, which sorts last.
    assert [r.store_name for r in stores] == ["0", "0", "a", "a||b", None]
    assert [r.store_state for r in stores][:2] == ["B", None]
    keys = [r[0] for r in star.fact().select("store_key").collect()]
    assert sorted(keys) == [1, 1, 2, 3, 4, 5, 5]


def test_supplier_with_a_null_part(spark, staging):
    raw = typed_sales(spark, {"supplier_city": None}, {}, {})
    star = Star(raw, staging)
    assert [r.supplier_city for r in star.dim("dim_suppliers").orderBy("supplier_key").collect()] == [None, "Quito"]
    assert sorted(str(r[0]) for r in star.fact().select("supplier_key").collect()) == ["2", "2", "None"]
    found = resolve_supplier_key(raw, star.members("dim_suppliers"), star.layout.suppliers, null_safe=True)
    assert sorted(r.supplier_key for r in found.collect()) == [1, 2, 2]


def test_dates(spark, staging):
    raw = typed_sales(spark, {}, {}, {"sale_date": None}, {"sale_date": datetime.date(2020, 12, 31)})
    star = Star(raw, staging)
    assert [tuple(r) for r in star.dim("dim_dates").orderBy("date_key").collect()] == [
        (20201231, datetime.date(2020, 12, 31), 31, 12, "December", 4, 2020),
        (20210105, datetime.date(2021, 1, 5), 5, 1, "January", 1, 2021),
    ]
    assert star.fact().where("date_key is null").count() == 1


def test_fact_keeps_every_record_and_numbers_them(spark, staging):
    raw = typed_sales(spark, *_sales(1, 300))
    fact = Star(raw, staging).fact()
    assert fact.schema.simpleString() == STAR["fact_sales"].simpleString()
    assert fact.agg(F.count("*"), F.min("sale_key"), F.max("sale_key"), F.count_distinct("sale_key")).first()[:] == (
        400,
        1,
        400,
        400,
    )
    ids = [r[0] for r in fact.orderBy("sale_key").select("source_sale_id").collect()]
    assert ids == sorted(ids, key=lambda v: (v is not None, v))


@pytest.mark.parametrize("columns", [["product_key"], ["store_key", "sale_quantity"], ["supplier_key"]])
def test_part_of_the_fact_equals_the_whole(spark, staging, columns):
    star = Star(typed_sales(spark, *_sales(2, 150)), staging)
    assert _same(star.fact(columns), star.fact().select(*columns))


def test_star_does_not_depend_on_partitioning(spark):
    raw = typed_sales(spark, *_sales(3, 250))
    setting = "spark.sql.shuffle.partitions"
    before = spark.conf.get(setting)
    stars = []
    for parts, shuffles in ((1, "2"), (13, "11")):
        spark.conf.set(setting, shuffles)
        staging = Staging(spark)
        store = ParquetStore(spark, staging.path("star"))
        Star(staging.keep(raw.repartition(parts), "raw"), staging).store(store)
        stars.append(store)
    spark.conf.set(setting, before)
    for name in STAR_TABLES:
        assert _same(stars[0].read(name), stars[1].read(name)), name


def test_shuffled_lookups_equal_broadcast_ones(spark, no_broadcast):
    """The same star with joins as they run on large tables."""
    raw = typed_sales(spark, *_sales(4, 250))
    large = Star(raw, Staging(spark)).fact().collect()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    small = Star(raw, Staging(spark)).fact().collect()
    assert sorted(large, key=lambda r: r.sale_key) == sorted(small, key=lambda r: r.sale_key)


def test_keys_are_unique_and_resolve(spark, staging):
    star = Star(typed_sales(spark, *_sales(5, 200)), staging)
    fact = star.fact()
    for name in DIMENSIONS:
        dim = star.dim(name)
        key = STAR[name].names[0]
        assert dim.count() == dim.select(key).distinct().count(), name
        assert fact.dropna(subset=[key]).join(dim, key, "left_anti").isEmpty(), name
