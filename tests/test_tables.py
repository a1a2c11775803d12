import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from starmart.contracts import MARTS, RAW, STAR, contract
from starmart.sources import staging as staging_module
from starmart.sources.settings import mart_database, source_root, star_database
from starmart.sources.staging import FOLDERS, Staging, shared_folder, side_by_side
from starmart.sources.tables import JdbcStore, ParquetStore, at_once, count_tables

SCHEMA = contract("long: product_key\ntext: product_name")


def test_refresh_replaces_and_append_adds(spark, tmp_path):
    store = ParquetStore(spark, str(tmp_path))
    df = spark.range(10).select(F.lit("n").alias("product_name"), F.col("id").cast("int").alias("product_key"))
    assert store.write(df, "mart_product_quality", SCHEMA) == 10
    assert store.write(df, "mart_product_quality", SCHEMA) == 10
    assert store.read("mart_product_quality").count() == 10
    assert store.write(df, "mart_product_quality", SCHEMA, refresh=False) == 10
    assert store.read("mart_product_quality").schema.simpleString() == SCHEMA.simpleString()
    assert {tuple(r) for r in count_tables(store, ["mart_product_quality"]).collect()} == {
        ("mart_product_quality", 20)
    }


def test_files_are_sorted_by_the_table_key(spark, tmp_path):
    store = ParquetStore(spark, str(tmp_path))
    df = spark.range(1000).select((999 - F.col("id")).alias("product_key"), F.lit("n").alias("product_name"))
    store.write(df.repartition(4), "mart_product_quality", SCHEMA)
    for file in (tmp_path / "mart_product_quality").glob("*.parquet"):
        keys = pq.read_table(file).column("product_key").to_pylist()
        assert keys == sorted(keys)


def test_at_once_keeps_names_and_errors():
    assert at_once({"a": lambda: 1, "b": lambda: 2}) == {"a": 1, "b": 2}
    with pytest.raises(ZeroDivisionError):
        at_once({"a": lambda: 1 / 0})


def test_staging_uses_the_shared_folder_of_the_session(spark):
    assert Staging(spark).root.startswith(spark.conf.get("spark.checkpoint.dir"))


def test_staging_drop_removes_only_its_own_folder(spark, tmp_path):
    first, second = Staging(spark, str(tmp_path)), Staging(spark, str(tmp_path))
    first.keep(spark.range(3), "x")
    kept = second.keep(spark.range(4), "x")
    first.drop()
    assert kept.count() == 4 and len(list(tmp_path.iterdir())) == 1


class _Reader:
    """Stands in for a session and its reader, and notes what is asked of a database."""

    def __init__(self):
        self.read = self
        self.calls = []

    def jdbc(self, *arguments, properties):
        self.calls.append((arguments, properties))
        return self

    def first(self):
        return (3, 40)


def test_database_reads_are_split_and_counts_run_in_the_database():
    session = _Reader()
    store = JdbcStore(session, "jdbc:x", {"user": "u"}, schema_name="public")
    store.read("dim_stores")
    split = store.key_split("fact_sales", "sale_key", 8)
    store.read("fact_sales", split=split)
    store.count("fact_sales")
    assert [c[0][1:] for c in session.calls] == [
        ("public.dim_stores",),
        ("(SELECT MIN(sale_key) AS low, MAX(sale_key) AS high FROM public.fact_sales) t",),
        ("public.fact_sales", "sale_key", 3, 41, 8),
        ("(SELECT COUNT(*) AS row_count FROM public.fact_sales) t",),
    ]
    assert all(c == (("jdbc:x", *c[0][1:]), {"user": "u"}) for c in session.calls)


class _Session:
    """A session without a checkpoint folder."""

    def __init__(self, master):
        self.conf = self
        self.sparkContext = self
        self.master = master
        self.folder = None

    def get(self, name, default):
        return default

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = f"{folder}/one"


def test_a_cluster_without_a_shared_folder_is_an_error(monkeypatch, tmp_path):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(_Session("yarn"))
    monkeypatch.setattr(staging_module.tempfile, "mkdtemp", lambda prefix: str(tmp_path))
    session = _Session("local[2]")
    assert shared_folder(session) == shared_folder(session) == f"{tmp_path}/one"


def test_database_settings_come_from_the_environment():
    star = star_database(None, {"POSTGRES_HOST": "h", "POSTGRES_PORT": "1", "POSTGRES_DB": "d", "POSTGRES_USER": "u"})
    assert star.url == "jdbc:postgresql://h:1/d"
    assert star.properties["user"] == "u" and star.properties["password"] == "postgres"
    assert star.properties["stringtype"] == "unspecified"
    assert star.qualified("fact_sales") == "public.fact_sales"
    assert star.options("fact_sales", refresh=True)["truncate"] == "true"
    assert "truncate" not in star.options("fact_sales", refresh=False)

    marts = mart_database(None, {})
    assert marts.url == "jdbc:clickhouse://clickhouse:8123/marts"
    assert marts.qualified("mart_sales_time") == "mart_sales_time"
    for name in MARTS:
        assert "ORDER BY (" in marts.options(name, refresh=True)["createTableOptions"]
    assert source_root({}) == "/opt/project" and source_root({"PROJECT_ROOT": "/x"}) == "/x"


class _Database:
    """Stands in for the driver classes behind a session, and notes what a connection is told."""

    def __init__(self):
        self.told = []
        self.sparkContext = self._jvm = self.java = self.util = self.lang = self.Thread = self

    def __getattr__(self, name):
        if name in ("currentThread", "getContextClassLoader", "getDeclaredConstructor", "newInstance", "createStatement"):
            return lambda: self
        raise AttributeError(name)

    def Properties(self):
        self.settings = {}
        return self

    def setProperty(self, name, value):
        self.settings[name] = value

    def loadClass(self, name):
        self.told.append(name)
        return self

    def connect(self, url, settings):
        self.told.append((url, dict(settings.settings)))
        return self

    def execute(self, statement):
        self.told.append(statement)

    def close(self):
        self.told.append("closed")


def test_marts_are_created_as_their_contract_says():
    database = _Database()
    store = mart_database(database, {"CLICKHOUSE_PASSWORD": "p"})
    store.send(store.create_statement("mart_product_quality", MARTS["mart_product_quality"]))
    assert database.told == [
        "com.clickhouse.jdbc.ClickHouseDriver",
        (store.url, dict(store.properties)),
        "CREATE TABLE IF NOT EXISTS mart_product_quality (product_key UInt64, product_name Nullable(String), "
        "product_rating Nullable(Float64), product_reviews Nullable(Int64), total_units_sold Int64, total_orders UInt64, "
        "total_revenue Float64, revenue_per_review Nullable(Float64)) ENGINE = MergeTree() ORDER BY (product_key)",
        "closed",
    ]
    for name, schema in MARTS.items():
        sent = store.create_statement(name, schema)
        assert [f.name for f in schema.fields if f"{f.name} Nullable(" in sent] == [f.name for f in schema.fields if f.nullable]
    assert "year_num Int32, quarter_num Int32" in store.create_statement("mart_sales_time", MARTS["mart_sales_time"])


def test_star_tables_are_created_with_keys_and_references():
    store = star_database(None, {})
    assert store.create_statement("dim_dates", STAR["dim_dates"]).startswith(
        "CREATE TABLE IF NOT EXISTS public.dim_dates (date_key INT PRIMARY KEY, full_date DATE, day_num INT"
    )
    fact = store.create_statement("fact_sales", STAR["fact_sales"])
    assert "sale_key BIGINT PRIMARY KEY" in fact and "supplier_key BIGINT REFERENCES dim_suppliers(supplier_key)" in fact
    assert fact.count("REFERENCES") == 6 and fact.endswith("sale_total_price NUMERIC(14,2))")
    assert "product_rating NUMERIC(4,2)" in store.create_statement("dim_products", STAR["dim_products"])
    assert store.create_statement("mock_data", RAW).startswith("CREATE TABLE IF NOT EXISTS public.mock_data (sale_id BIGINT, sale_date DATE")


def test_a_table_is_created_before_it_is_written(spark, monkeypatch):
    """The statement goes first; rows then follow into a table that exists."""
    done = []
    monkeypatch.setattr(JdbcStore, "send", lambda self, statement: done.append(statement.split(" (")[0]))

    def jdbc(writer, url, table, properties):
        done.append((table, properties.get("truncate")))
        writer.format("noop").save()

    monkeypatch.setattr("pyspark.sql.readwriter.DataFrameWriter.jdbc", jdbc)
    monkeypatch.setattr("pyspark.sql.classic.dataframe.DataFrameWriter.jdbc", jdbc, raising=False)
    df = spark.range(4).select(F.col("id").alias("product_key"), *[F.lit(None).alias(n) for n in MARTS["mart_product_quality"].names[1:]])
    assert mart_database(spark, {}).write(df, "mart_product_quality", MARTS["mart_product_quality"]) == 4
    assert done == ["CREATE TABLE IF NOT EXISTS mart_product_quality", ("mart_product_quality", "true")]


def test_partitioned_writes_keep_their_files_open(spark, tmp_path):
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    with pytest.raises(RuntimeError), side_by_side(spark):
        assert spark.conf.get(name) == str(FOLDERS)
        raise RuntimeError
    assert spark.conf.get(name) == before
    rows = [(i, i % (2 * FOLDERS)) for i in range(500)]
    with side_by_side(spark):  # more folders than files may be open
        spark.createDataFrame(rows, "id long, folder int").write.partitionBy("folder").parquet(str(tmp_path / "out"))
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "out")).select("id", "folder").collect())) == rows
