import datetime
from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from conftest import typed_sales
from starmart.contracts import MARTS as CONTRACTS
from starmart.operators import enrich as enrich_module
from starmart.operators.enrich import DIMENSION_KEYS, enrich
from starmart.operators.marts import MARTS, mart_from_star, sales_mart
from starmart.plans.marts import mart_of, shared_groups
from starmart.plans.star import Star, stored_dims
from starmart.sources.staging import Staging
from starmart.sources.tables import ParquetStore
from test_star import _sales


@pytest.fixture(scope="module")
def star(spark):
    staging = Staging(spark)
    return Star(staging.keep(typed_sales(spark, *_sales(11, 400)), "raw"), staging)


@pytest.fixture(scope="module")
def stored(spark, star):
    store = ParquetStore(spark, star.staging.path("star"))
    star.store(store)
    return store


def _rows(df):
    return [tuple(r) for r in df.collect()]


@pytest.mark.parametrize("name", list(MARTS))
def test_all_ways_to_a_mart_agree(star, stored, name):
    joined = enrich(stored.read("fact_sales"), stored_dims(stored))
    expected = _rows(sales_mart(joined, name))
    assert expected
    assert _rows(mart_from_star(name, stored.read("fact_sales"), stored_dims(stored))) == expected
    assert _rows(mart_of(star, name)) == expected
    fact, dims = stored.read("fact_sales"), stored_dims(stored)
    groups = shared_groups(fact, star.staging)
    assert set(groups) == {"mart_sales_products", "mart_product_quality"}
    assert _rows(mart_from_star(name, fact, dims, groups=groups.get(name), staging=star.staging)) == expected


@pytest.mark.parametrize("name", list(MARTS))
def test_large_dimensions_give_the_same_marts(stored, name, no_broadcast, monkeypatch):
    """As above, with every dimension too large to broadcast."""
    fact, dims = stored.read("fact_sales"), stored_dims(stored)
    expected = _rows(mart_from_star(name, fact, dims))
    monkeypatch.setattr(enrich_module, "estimated_bytes", lambda df: 1 << 60)
    assert _rows(mart_from_star(name, fact, dims)) == expected
    measured = ["source_sale_id", "sale_quantity", "sale_total_price"]
    needed = [*MARTS[name].keys, *measured, "product_price", "product_rating", "product_reviews"]
    assert _rows(sales_mart(enrich(fact, dims, needed), name)) == expected


@pytest.mark.parametrize("name", list(MARTS))
def test_contract_and_limit(star, name):
    df = mart_of(star, name)
    assert df.schema.simpleString() == CONTRACTS[name].simpleString()
    if MARTS[name].limit:
        assert df.count() == MARTS[name].limit
        assert mart_of(star, name, limit=False).count() > MARTS[name].limit


def test_time_mart_by_hand(star):
    groups = defaultdict(list)
    for r in star.raw.collect():
        d = r.sale_date
        key = (d.year, (d.month + 2) // 3, d.month, d.strftime("%B")) if d else (None,) * 4
        groups[key].append(r)
    expected = []
    for key, rows in groups.items():
        money = sum(r.sale_total_price for r in rows)
        average = (money / len(rows)).quantize(Decimal("0.01"), ROUND_HALF_UP)
        orders = {r.sale_id for r in rows} - {None}
        expected.append((*key, len(orders), sum(r.sale_quantity for r in rows), float(money), float(average)))
    expected.sort(key=lambda r: (r[0] or 0, r[2] or 0))
    assert _rows(mart_of(star, "mart_sales_time")) == expected


def test_measures_add_up(star, stored):
    revenue = stored.read("fact_sales").agg(F.sum("sale_total_price")).first()[0]
    for name in MARTS:
        total = mart_of(star, name, limit=False).agg(F.sum(F.col("total_revenue").cast("decimal(20,2)"))).first()[0]
        assert total == revenue, name


def test_averages_are_per_line_and_price_is_weighted(spark, staging):
    raw = typed_sales(
        spark,
        {"sale_id": 1, "sale_total_price": Decimal("1.00"), "product_price": Decimal("2.00")},
        {"sale_id": 1, "sale_total_price": Decimal("2.00"), "product_price": Decimal("2.00")},
        {"sale_id": 2, "sale_total_price": Decimal("2.00"), "sale_product_id": 31, "product_price": Decimal("9.00")},
    )
    star = Star(raw, staging)
    customer = mart_of(star, "mart_sales_customers").first()
    assert (customer.customer_name, customer.total_orders, customer.avg_check) == ("Ann Lee", 2, 1.67)
    assert mart_of(star, "mart_sales_suppliers").first().avg_product_price == 4.33


def test_missing_keys_and_names(spark, staging):
    raw = typed_sales(
        spark,
        {"sale_customer_id": None, "sale_product_id": None, "sale_date": None, "supplier_city": None},
        {"customer_last_name": None, "sale_total_price": Decimal("1.00"), "product_reviews": 0},
    )
    star = Star(raw, staging)
    customers = _rows(mart_of(star, "mart_sales_customers"))
    assert [c[:3] for c in customers] == [(None, "", None), (10, "Ann", "Peru")]
    assert _rows(mart_of(star, "mart_sales_time"))[0][:4] == (None,) * 4
    assert mart_of(star, "mart_sales_suppliers").first().supplier_key is None
    quality = {r.product_key: r for r in mart_of(star, "mart_product_quality").collect()}
    assert quality[None].product_rating is None and quality[None].revenue_per_review is None
    assert (quality[30].product_reviews, quality[30].revenue_per_review) == (0, None)


def test_equal_measures_are_ranked_by_key(spark, staging):
    raw = typed_sales(spark, *[{"sale_id": i, "sale_product_id": 100 - i} for i in range(30)])
    keys = [r.product_key for r in mart_of(Star(raw, staging), "mart_sales_products").collect()]
    assert keys == list(range(71, 81))


def test_quality_ratio_uses_rounded_revenue(spark, staging):
    raw = typed_sales(spark, {"product_reviews": 8, "sale_total_price": Decimal("0.36")})
    row = mart_of(Star(raw, staging), "mart_product_quality").first()
    assert (row.total_revenue, row.product_reviews, row.revenue_per_review) == (0.36, 8, 0.05)


def test_enrich_joins_only_what_is_needed(stored):
    fact, dims = stored.read("fact_sales"), stored_dims(stored)
    slim = enrich(fact, dims, ["month_num", "sale_total_price"])
    assert slim.columns == ["month_num", "sale_total_price"]
    plan = slim._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1
    whole = enrich(fact, dims)
    assert whole.count() == fact.count()
    types = dict(whole.dtypes)
    assert (types["sale_total_price"], types["sale_quantity"], types["product_reviews"]) == (
        "double",
        "bigint",
        "bigint",
    )
    assert {"customer_name", "seller_name", "full_date"} <= set(whole.columns)
    assert whole.where(F.col("full_date") == datetime.date(2021, 1, 1)).where("day_num != 1").isEmpty()


def test_large_dimensions_add_the_same_to_the_plan(spark, tmp_path):
    """Reads of the fact in the optimised plan, for one to six dimensions beyond the bound."""
    fact = spark.range(100).select(
        F.col("id").alias("sale_key"), *[(F.col("id") % 10).alias(k) for k in DIMENSION_KEYS.values()]
    )
    fact.write.parquet(str(tmp_path / "the_fact"))
    fact, dims, reads = spark.read.parquet(str(tmp_path / "the_fact")), {}, []
    for name, key in DIMENSION_KEYS.items():
        dim = spark.range(10).select(F.col("id").alias(key), F.concat(F.lit(name), "id").alias(f"of_{name}"))
        dim.write.parquet(str(tmp_path / name))
        dims[name] = spark.read.parquet(str(tmp_path / name))
        joined = enrich(fact, dims, broadcast_bytes=0)
        plan = joined._jdf.queryExecution().optimizedPlan().toString()
        reads.append(sum("Relation" in line and "sale_key" in line for line in plan.splitlines()))
    steps = {b - a for a, b in zip(reads, reads[1:])}
    assert len(steps) == 1 and max(steps) <= 2
    assert joined.count() == 100 and joined.where("of_dim_dates IS NULL").isEmpty()


def test_wide_joins_come_last(spark, staging, no_broadcast):
    """A join that shuffles gets narrow rows, a broadcast needs none, and the order changes no row."""
    tables = "/root/testdata/sf0.001"
    from starmart.plans.wide import TABLES, WIDE_SQL, table, wide_sales

    plain = spark.sql(WIDE_SQL, **{name: table(spark, tables, name) for name in TABLES})
    wide = wide_sales(spark, tables)
    assert wide.columns == plain.columns and wide.exceptAll(plain).isEmpty() and plain.exceptAll(wide).isEmpty()
    steps = wide._jdf.queryExecution().executedPlan().toString()
    line = lambda word: next(i for i, x in enumerate(steps.splitlines()) if word in x)
    assert line("Join [l_suppkey") < line("Join [l_partkey") < line("Join [l_orderkey") < line("Join [o_custkey")  # outermost first


def test_large_dimensions_are_joined_before_rows_grow(spark, staging):
    """Those too large for Spark's size check first, so that their shuffles carry no text of the others."""
    rows = [(i, i, 20200101, 1) for i in range(4000)]
    fact = staging.keep(spark.createDataFrame(rows, "sale_key long, customer_key long, date_key int, store_key long"), "fact")
    text = F.sha2(F.col("customer_key").cast("string"), 256)
    dims = {
        "dim_customers": staging.keep(fact.select("customer_key", *[text.alias(f"customer_{c}_name") for c in ("first", "last")]), "c"),
        "dim_stores": staging.keep(spark.createDataFrame([(1, "a")], "store_key long, store_name string"), "s"),
        "dim_dates": staging.keep(spark.createDataFrame([(20200101, 2020)], "date_key int, year_num int"), "d"),
    }
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "20000")
    try:
        joined = enrich(fact, dims, broadcast_bytes=0)
        steps = joined._jdf.queryExecution().optimizedPlan().toString().splitlines()
    finally:
        spark.conf.set(name, before)
    at = [next(i for i, x in enumerate(steps) if x.count(f"{c}#") and "Join LeftOuter" in x and "_few_" in x) for c in ("store_key", "date_key", "customer_key")]
    assert at == sorted(at)  # outermost first
    assert joined.count() == 4000 and joined.where("store_name = 'a' AND year_num = 2020 AND customer_last_name IS NOT NULL").count() == 4000


def test_lookups_do_not_shuffle_sales_for_small_tables(spark, staging):
    star = Star(typed_sales(spark, *_sales(3, 40)), staging)
    plan = star.fact(["store_key", "supplier_key"])._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "hashpartitioning" not in plan
