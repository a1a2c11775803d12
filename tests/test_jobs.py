import pytest
from pyspark.sql import functions as F

from conftest import write_sales
from starmart.contracts import MARTS, RAW, STAR
from starmart.plans.jobs import RAW_TABLE, REJECTS_TABLE, check_star, run_marts_job, run_star_job
from starmart.plans.star import STAR_TABLES
from starmart.sources.tables import JdbcStore, ParquetStore, count_tables


def _files(root, files=10, rows=30):
    for i in range(files):
        write_sales(
            root / "data" / f"MOCK_DATA_{i}.csv",
            *[
                {
                    "id": str(j),
                    "sale_date": f"{1 + j % 12}/{1 + j % 28}/2021",
                    "sale_customer_id": str(j % 7),
                    "sale_product_id": str(j % 9),
                    "store_name": f"store {i}",
                    "supplier_name": f"supplier {j}",
                    "supplier_city": "" if j % 5 == 0 else "Quito",
                    "sale_total_price": f"{i}.{j:02d}",
                    "product_weight": "heavy" if j == 3 else "1",
                }
                for j in range(rows)
            ],
        )


def test_files_to_star_to_marts(spark, tmp_path):
    _files(tmp_path)
    store = ParquetStore(spark, str(tmp_path / "tables"))
    first = run_star_job(spark, str(tmp_path), store)
    assert first[RAW_TABLE] == first["fact_sales"] == 300
    assert first["dim_stores"] == 10 and first["dim_suppliers"] == 30 and first[REJECTS_TABLE] == 10
    assert store.read(RAW_TABLE).schema.simpleString() == RAW.simpleString()
    check_star(store)
    before = {name: store.read(name).collect() for name in STAR_TABLES}

    again = run_star_job(spark, str(tmp_path), store)
    assert again == first
    for name in STAR_TABLES:
        key = STAR[name].names[0]
        assert sorted(before[name], key=lambda r: r[key]) == store.read(name).orderBy(key).collect()

    marts = run_marts_job(spark, store, store)
    counted = {r.table_name: r.row_count for r in count_tables(store, list(marts)).collect()}
    assert counted == marts and set(marts) == set(MARTS)
    assert marts["mart_sales_time"] == 12 and marts["mart_sales_stores"] == 5
    revenue = store.read("mart_sales_time").agg(F.sum("total_revenue")).first()[0]
    assert round(revenue, 2) == float(store.read("fact_sales").agg(F.sum("sale_total_price")).first()[0])


def test_a_broken_star_is_not_published(spark, tmp_path):
    _files(tmp_path, files=1)
    store = ParquetStore(spark, str(tmp_path / "tables"))
    run_star_job(spark, str(tmp_path), store)
    broken = ParquetStore(spark, str(tmp_path / "broken"))
    for name in STAR_TABLES:
        df = store.read(name)
        if name == "dim_stores":
            df = df.unionAll(df)
        if name == "dim_products":
            df = df.where("product_key > 2")
        broken.write(df, name, STAR[name])
    with pytest.raises(ValueError, match="key of dim_stores, product_key of fact_sales"):
        check_star(broken)


def test_lost_sales_and_stores_are_not_published(spark, tmp_path):
    _files(tmp_path, files=1)
    store = ParquetStore(spark, str(tmp_path / "tables"))
    written = run_star_job(spark, str(tmp_path), store)
    check_star(store, written[RAW_TABLE])
    broken = ParquetStore(spark, str(tmp_path / "broken"))
    for name in STAR_TABLES:
        df = store.read(name)
        if name == "fact_sales":
            df = df.where("sale_key <= 15").withColumn("store_key", F.lit(None).cast("bigint"))
        broken.write(df, name, STAR[name])
    with pytest.raises(ValueError, match="store_key of fact_sales is NULL in 15 rows, fact_sales has 15 of 30"):
        check_star(broken, written[RAW_TABLE])
    twice = ParquetStore(spark, str(tmp_path / "twice"))
    for name in STAR_TABLES:
        df = store.read(name)
        if name == "fact_sales":
            df = df.withColumn("sale_key", F.when(F.col("sale_key") == 7, 8).otherwise(F.col("sale_key")))
        twice.write(df, name, STAR[name])
    with pytest.raises(ValueError, match="key of fact_sales"):
        check_star(twice)


def test_a_load_that_fails_half_way_leaves_the_old_star(spark, tmp_path, monkeypatch):
    _files(tmp_path, files=1)
    store = ParquetStore(spark, str(tmp_path / "tables"))
    before = run_star_job(spark, str(tmp_path), store)
    write_sales(tmp_path / "data" / "MOCK_DATA_9.csv", {"id": "77"})
    draft = ParquetStore(spark, str(tmp_path / "tables" / "_draft"))
    draft.write(store.read(RAW_TABLE).limit(1), RAW_TABLE, RAW)
    (tmp_path / "tables" / "_draft" / "dim_dates").mkdir()
    (tmp_path / "tables" / "_draft" / "no" / "such").mkdir(parents=True)
    with pytest.raises(FileNotFoundError, match="fact_sales"):
        store.replace(draft, [RAW_TABLE, "dim_dates", "fact_sales"])
    (tmp_path / "tables" / "no").write_text("a file, so the last move cannot work")
    with pytest.raises(Exception):
        store.replace(draft, [RAW_TABLE, "dim_dates", "no/such"])
    assert {t: store.read(t).count() for t in before} == before
    with monkeypatch.context() as broken:
        broken.setattr("starmart.plans.jobs.check_star", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            run_star_job(spark, str(tmp_path), store)
    assert {t: store.read(t).count() for t in before} == before
    after = run_star_job(spark, str(tmp_path), store)
    assert after[RAW_TABLE] == store.read("fact_sales").count() == before[RAW_TABLE] + 1
    assert not [p for p in (tmp_path / "tables").iterdir() if p.name.startswith("_old")]


def test_a_database_needs_a_place_for_rejects(spark, tmp_path):
    with pytest.raises(ValueError, match="rejects"):
        run_star_job(spark, str(tmp_path), JdbcStore(spark, "jdbc:none", {}))
