import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import SALE, write_sales
from starmart.contracts import RAW, subset
from starmart.functions.cleaning import explode_rejects
from starmart.sources import sales_csv
from starmart.sources.sales_csv import (
    REJECTED,
    find_sales_files,
    header_groups,
    large_first_lines,
    load_sales,
    malformed_rows,
    read_sales_csv,
    small_first_lines,
)


def _load(spark, root, **options):
    return {r.sale_id: r for r in load_sales(spark, str(root), **options).collect()}


def test_plain_record(spark, tmp_path):
    write_sales(tmp_path / "MOCK_DATA.csv", {})
    df = load_sales(spark, str(tmp_path))
    assert df.drop(REJECTED).schema.simpleString() == RAW.simpleString()
    row = df.first()
    assert (row.sale_id, row.sale_date, row.product_price) == (1, datetime.date(2021, 1, 5), Decimal("9.99"))
    assert row[REJECTED] == []


def test_cells(spark, tmp_path):
    write_sales(
        tmp_path / "MOCK_DATA.csv",
        {"id": "1", "sale_date": "01/05/2021", "customer_first_name": "  Ann ", "store_city": "   "},
        {"id": "2", "product_description": "two\nlines", "product_name": 'a "quoted" x'},
        {"id": "3", "sale_quantity": "3.7", "product_price": "2.675", "sale_total_price": "1.005"},
        {"id": "4", "store_name": "\ta\t", "supplier_city": "", "sale_customer_id": "", "sale_date": ""},
    )
    rows = _load(spark, tmp_path)
    assert (rows[1].sale_date, rows[1].customer_first_name) == (datetime.date(2021, 1, 5), "Ann")
    assert rows[1].store_city is None
    assert (rows[2].product_description, rows[2].product_name) == ("two\nlines", 'a "quoted" x')
    assert (rows[3].sale_quantity, rows[3].product_price) == (3, Decimal("2.68"))
    assert rows[3].sale_total_price == Decimal("1.01")
    assert (rows[4].store_name, rows[4].supplier_city, rows[4].sale_customer_id) == ("\ta\t", None, None)
    assert all(r[REJECTED] == [] for r in rows.values())


def test_bad_values_become_null_and_rejects(spark, tmp_path):
    write_sales(
        tmp_path / "MOCK_DATA.csv",
        {"id": "1", "product_price": "abc", "sale_date": "1/5/21"},
        {"id": "2", "sale_date": "2021-01-05", "product_rating": "100.00"},
        {"id": "3", "sale_date": "13/45/2021"},
        {"id": "x"},
    )
    df = load_sales(spark, str(tmp_path))
    lost = {tuple(r) for r in explode_rejects(df, REJECTED).collect()}
    assert lost == {
        ("1", "product_price", "abc"),
        ("1", "sale_date", "1/5/21"),
        ("2", "sale_date", "2021-01-05"),
        ("2", "product_rating", "100.00"),
        ("3", "sale_date", "13/45/2021"),
        ("x", "sale_id", "x"),
    }
    assert df.where("sale_date is null").count() == 3


def test_rows_with_other_cells_are_listed(spark, tmp_path):
    header = ",".join(SALE)
    plain = ["1" if c in ("id", "sale_quantity") else "" for c in SALE]
    lines = [header, ",".join(plain), ",".join(["2", *plain[1:], "more", "cells"]), "3,1/5/2021", ""]
    (tmp_path / "MOCK_DATA.csv").write_text("\n".join(lines))
    write_sales(tmp_path / "MOCK_DATA_2.csv", {"id": "4", "product_description": "two\nlines"}, columns=list(reversed(SALE)))
    df = load_sales(spark, str(tmp_path), malformed=True)
    assert df.count() == 4
    found = {r.sale_id: (r.source_file.split("/")[-1], r.source_text) for r in malformed_rows(df).collect()}
    assert found == {2: ("MOCK_DATA.csv", lines[2]), 3: ("MOCK_DATA.csv", lines[3])}


def test_ten_files_in_nested_folders(spark, tmp_path):
    for i in range(10):
        folder = tmp_path / "data" if i % 2 else tmp_path / "data" / "more" / str(i)
        write_sales(folder / f"MOCK_DATA ({i}).csv", *[{"id": str(i * 100 + j)} for j in range(20)])
    write_sales(tmp_path / "data" / "other.csv", {"id": "9999"})
    assert len(find_sales_files(spark, str(tmp_path))) == 10
    df = read_sales_csv(spark, str(tmp_path))
    assert df.agg(F.count("*"), F.count_distinct("sale_id")).first()[:] == (200, 200)


def test_no_file(spark, tmp_path):
    (tmp_path / "notes.csv").write_text("a\n1\n")
    with pytest.raises(FileNotFoundError, match="MOCK_DATA"):
        read_sales_csv(spark, str(tmp_path))


def test_columns_in_another_order_keep_their_names(spark, tmp_path):
    write_sales(tmp_path / "MOCK_DATA_1.csv", {"id": "1"})
    write_sales(tmp_path / "MOCK_DATA [2] 50%.csv", {"id": "2"}, columns=list(reversed(SALE)))
    write_sales(tmp_path / "MOCK_DATA_3.csv", {"id": "3", "extra": "e"}, columns=["extra", *SALE])
    rows = _load(spark, tmp_path)
    assert set(rows) == {1, 2, 3}
    assert {(r.store_city, r.product_color, r.sale_total_price) for r in rows.values()} == {
        ("Lima", "red", Decimal("19.98"))
    }


def test_missing_and_repeated_columns_are_named(spark, tmp_path):
    write_sales(tmp_path / "a" / "MOCK_DATA.csv", {}, columns=[c for c in SALE if c != "store_city"])
    with pytest.raises(ValueError, match="store_city"):
        read_sales_csv(spark, str(tmp_path / "a"))
    write_sales(tmp_path / "b" / "MOCK_DATA.csv", {}, columns=[*SALE, "id"])
    with pytest.raises(ValueError, match="repeats columns: id"):
        read_sales_csv(spark, str(tmp_path / "b"))


def test_split_files_without_line_ends_in_cells(spark, tmp_path):
    write_sales(tmp_path / "MOCK_DATA.csv", *[{"id": str(i)} for i in range(50)])
    whole = load_sales(spark, str(tmp_path)).drop(REJECTED)
    split = load_sales(spark, str(tmp_path), multi_line=False).drop(REJECTED)
    assert whole.exceptAll(split).isEmpty() and split.count() == 50


def test_part_of_the_contract(spark, tmp_path):
    write_sales(tmp_path / "MOCK_DATA.csv", {}, columns=["id", "sale_date", "store_city"])
    layout = subset(RAW, ["sale_id", "sale_date", "store_city"])
    df = load_sales(spark, str(tmp_path), schema=layout)
    assert df.columns == [*layout.names, REJECTED] and df.first().store_city == "Lima"


def test_a_broken_promise_of_one_header_stops_the_job(spark, tmp_path):
    write_sales(tmp_path / "MOCK_DATA_1.csv", {"id": "1"})
    write_sales(tmp_path / "MOCK_DATA_2.csv", {"id": "2"})
    assert load_sales(spark, str(tmp_path), same_header=True).count() == 2
    write_sales(tmp_path / "MOCK_DATA_3.csv", {"id": "3"}, columns=list(reversed(SALE)))
    with pytest.raises(Exception, match="(?i)header"):
        load_sales(spark, str(tmp_path), same_header=True).collect()
    assert load_sales(spark, str(tmp_path)).count() == 3


@pytest.mark.parametrize("multi_line", [True, False])
def test_a_byte_order_mark_is_not_part_of_the_first_name(spark, tmp_path, multi_line):
    write_sales(tmp_path / "MOCK_DATA.csv", {"id": "1"}, {"id": "2"})
    plain = (tmp_path / "MOCK_DATA.csv").read_bytes()
    (tmp_path / "MOCK_DATA.csv").write_bytes(b"\xef\xbb\xbf" + plain)
    assert set(_load(spark, tmp_path, multi_line=multi_line)) == {1, 2}


def test_headers_of_many_small_files_are_read_by_executors(spark, tmp_path, monkeypatch):
    """Of 5 000 files only the two different headers come to the driver, and no file is opened there."""
    layout = subset(RAW, ["sale_id", "sale_quantity", "store_city"])
    for i in range(5000):
        folder = tmp_path / f"part {i % 20}"
        folder.mkdir(exist_ok=True)
        text = f"store_city,extra,id,sale_quantity\nLima,x,{i},2\n" if i % 1000 == 7 else f"id,sale_quantity,store_city\n{i},2,Lima\n"
        (folder / f"MOCK_DATA_{i}.csv").write_text(text)
    collected, collect = [], type(spark.range(0)).collect
    with monkeypatch.context() as watched:
        watched.setattr(type(spark.range(0)), "collect", lambda df: collected.append(collect(df)) or collected[-1])
        groups = header_groups(spark, str(tmp_path))
    assert [h for h in groups] == [("id", "sale_quantity", "store_city"), ("store_city", "extra", "id", "sale_quantity")]
    assert sum(map(len, collected)) <= 4
    assert small_first_lines(spark, str(tmp_path), sales_csv.SALES_FILES).rdd.getNumPartitions() < 500
    df = load_sales(spark, str(tmp_path), schema=layout)
    assert df.agg(F.count("*"), F.count_distinct("sale_id"), F.sum("sale_quantity")).first()[:] == (5000, 5000, 10000)
    assert df.where("store_city = 'Lima'").count() == 5000


def test_large_files_are_opened_and_not_read(spark, tmp_path, monkeypatch):
    """Whatever counts as large, the same headers and rows; one task looks at the beginning of each large file."""
    write_sales(tmp_path / "MOCK_DATA_1 %20+é.csv", *[{"id": str(i)} for i in range(3000)])
    write_sales(tmp_path / "b" / "MOCK_DATA_2.csv", {"id": "9000"}, columns=list(reversed(SALE)))
    (tmp_path / "b" / "MOCK_DATA_2.csv").write_bytes(b"\xef\xbb\xbf" + (tmp_path / "b" / "MOCK_DATA_2.csv").read_bytes())
    found = header_groups(spark, str(tmp_path))
    rows = load_sales(spark, str(tmp_path)).count()
    assert rows == 3001 and len(found) == 2
    assert [r["path"][-20:] for r in large_first_lines(spark, str(tmp_path), sales_csv.SALES_FILES).collect()] == ["OCK_DATA_1 %20+é.csv"]
    for size in (-1, 10**9):
        monkeypatch.setattr(sales_csv, "SMALL_FILE", size)
        assert header_groups(spark, str(tmp_path)) == found
        assert load_sales(spark, str(tmp_path)).count() == rows
    monkeypatch.setattr(sales_csv, "SMALL_FILE", -1)
    assert large_first_lines(spark, str(tmp_path), sales_csv.SALES_FILES).rdd.getNumPartitions() == 2


def test_empty_files_and_too_many_headers(spark, tmp_path, monkeypatch):
    """A file without a byte has no records and no header to be missed."""
    (tmp_path / "MOCK_DATA_1.csv").write_text("")
    with pytest.raises(FileNotFoundError, match="MOCK_DATA"):
        read_sales_csv(spark, str(tmp_path))
    write_sales(tmp_path / "MOCK_DATA_2.csv", {})
    assert read_sales_csv(spark, str(tmp_path)).count() == 1
    (tmp_path / "MOCK_DATA_3.csv").write_text("\n")
    with pytest.raises(ValueError, match="MOCK_DATA_3.csv lacks columns"):
        read_sales_csv(spark, str(tmp_path))
    monkeypatch.setattr(sales_csv, "HEADERS", 1)
    with pytest.raises(ValueError, match="more than 1 different"):
        read_sales_csv(spark, str(tmp_path))


def test_compressed_files_are_read_like_others(spark, tmp_path):
    rows = [(i, i % 7) for i in range(200)]
    frame = spark.createDataFrame(rows, "id long, sale_quantity int").repartition(2)
    frame.write.options(header=True, compression="lz4").csv(str(tmp_path / "in"))
    layout = subset(RAW, ["sale_id", "sale_quantity"])
    found = load_sales(spark, str(tmp_path / "in"), "part-*.csv.lz4", layout)
    assert sorted(map(tuple, found.select(*layout.names).collect())) == rows
