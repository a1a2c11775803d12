from __future__ import annotations

import csv
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from starmart.contracts import RAW  # noqa: E402
from starmart.sources.staging import Staging  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("starmart-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def staging(spark):
    return Staging(spark)


@pytest.fixture
def no_broadcast(spark):
    """Joins as they run on large tables: shuffled, unless a broadcast is asked for."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    adaptive = "spark.sql.adaptive.enabled"
    spark.conf.set(adaptive, "false")
    yield spark
    spark.conf.set(name, before)
    spark.conf.set(adaptive, "true")


# One plain sales record, as text, in file order.
SALE = {
    "id": "1",
    "sale_date": "1/5/2021",
    "sale_customer_id": "10",
    "customer_first_name": "Ann",
    "customer_last_name": "Lee",
    "customer_age": "31",
    "customer_email": "ann@example.org",
    "customer_country": "Peru",
    "customer_postal_code": "100",
    "customer_pet_type": "cat",
    "customer_pet_name": "Tom",
    "customer_pet_breed": "tabby",
    "sale_seller_id": "20",
    "seller_first_name": "Bo",
    "seller_last_name": "Ray",
    "seller_email": "bo@example.org",
    "seller_country": "Chile",
    "seller_postal_code": "200",
    "sale_product_id": "30",
    "product_name": "Ball",
    "product_category": "Toy",
    "product_price": "9.99",
    "product_quantity": "5",
    "pet_category": "Cats",
    "product_weight": "1.5",
    "product_color": "red",
    "product_size": "S",
    "product_brand": "Acme",
    "product_material": "wool",
    "product_description": "A ball",
    "product_rating": "4.5",
    "product_reviews": "8",
    "product_release_date": "1/1/2020",
    "product_expiry_date": "1/1/2030",
    "sale_quantity": "2",
    "sale_total_price": "19.98",
    "store_name": "North",
    "store_location": "Mall",
    "store_city": "Lima",
    "store_state": "LI",
    "store_country": "Peru",
    "store_phone": "555",
    "store_email": "n@example.org",
    "supplier_name": "Sup",
    "supplier_contact": "Kim",
    "supplier_email": "s@example.org",
    "supplier_phone": "777",
    "supplier_address": "Road 1",
    "supplier_city": "Quito",
    "supplier_country": "Ecuador",
}


def write_sales(path: Path, *changes: dict, columns=None) -> None:
    """A sales file with one record per change to the plain record."""
    path.parent.mkdir(parents=True, exist_ok=True)
    columns = columns or list(SALE)
    with path.open("w", newline="", encoding="utf-8") as file:
        writer = csv.DictWriter(file, columns, extrasaction="ignore")
        writer.writeheader()
        for change in changes:
            writer.writerow({**SALE, **change})


def typed_sales(spark, *changes: dict):
    """Typed records without a file; the changes hold typed values."""
    import datetime
    from decimal import Decimal

    plain = {
        "long": int,
        "bigint": int,
        "int": int,
        "date": lambda text: datetime.datetime.strptime(text, "%m/%d/%Y").date(),
        "string": str,
    }
    base = {}
    for f in RAW.fields:
        text = SALE["id" if f.name == "sale_id" else f.name]
        base[f.name] = plain.get(f.dataType.simpleString(), Decimal)(text)
    return spark.createDataFrame([tuple({**base, **c}[n] for n in RAW.names) for c in changes], RAW)
