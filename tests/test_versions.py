"""Publishing by version: what readers see before, during and after a load, whatever happens to it."""

import json
import os
import time

import pytest
from pyspark.sql import functions as F

from conftest import write_sales
from starmart.contracts import MARTS, contract
from starmart.plans import jobs
from starmart.plans.jobs import RAW_TABLE, REJECTS_TABLE, run_marts_job, run_star_job
from starmart.plans.star import STAR_TABLES
from starmart.sources.tables import ParquetStore, count_tables
from starmart.sources.versions import Conflict, VersionedStore

SCHEMA = contract("long: k")


def _rows(n):
    return lambda spark: spark.range(n).withColumnRenamed("id", "k")


def _counts(snapshot):
    return {t: snapshot.read(t).count() for t in snapshot.tables}


def _load(spark, store, **rows):
    draft = store.draft()
    for table, n in rows.items():
        draft.write(_rows(n)(spark), table, SCHEMA)
    return store.publish(draft, list(rows))


def test_a_load_appears_in_one_step(spark, tmp_path):
    store = VersionedStore(spark, str(tmp_path))
    assert store.snapshot().number == 0 and store.snapshot().tables == {}
    with pytest.raises(FileNotFoundError, match="no table a"):
        store.read("a")
    _load(spark, store, a=3, b=4)
    before = store.snapshot()
    draft = store.draft()
    draft.write(_rows(5)(spark), "a", SCHEMA)
    assert _counts(store.snapshot()) == _counts(before) == {"a": 3, "b": 4}
    draft.write(_rows(6)(spark), "c", SCHEMA)
    store.publish(draft, ["a", "c"])
    assert _counts(store.snapshot()) == {"a": 5, "b": 4, "c": 6}
    assert _counts(before) == {"a": 3, "b": 4}  # who has begun to read goes on undisturbed


def test_one_table_by_itself(spark, tmp_path):
    store = VersionedStore(spark, str(tmp_path))
    assert store.write(_rows(3)(spark), "a", SCHEMA) == 3
    assert store.write(_rows(4)(spark), "a", SCHEMA, refresh=False) == 4
    assert store.read("a", SCHEMA).count() == 7 and store.count("a").first()[0] == 7
    assert store.write(_rows(2)(spark), "a", SCHEMA) == 2
    assert store.read("a").count() == 2
    with pytest.raises(Exception):
        store.write(spark.range(3).select(F.raise_error(F.lit("lost")).cast("long").alias("k")), "a", SCHEMA)
    assert store.read("a").count() == 2 and len(list((tmp_path / "loads").iterdir())) == 3


def test_a_driver_that_dies_leaves_the_last_version(spark, tmp_path):
    store = VersionedStore(spark, str(tmp_path))
    _load(spark, store, a=3, b=4)
    store.draft().write(_rows(9)(spark), "a", SCHEMA)  # died before it published
    (tmp_path / "versions" / "000000000002.json").write_text('{"tables": {"a": ["loads/')  # died while it did
    (tmp_path / "versions" / "000000000003.json").write_text("")
    assert _counts(store.snapshot()) == {"a": 3, "b": 4}
    assert _load(spark, store, a=5).number == 4
    assert _counts(store.snapshot()) == {"a": 5, "b": 4}


def test_a_draft_without_its_tables_is_not_published(spark, tmp_path):
    store = VersionedStore(spark, str(tmp_path))
    draft = store.draft()
    draft.write(_rows(1)(spark), "a", SCHEMA)
    with pytest.raises(FileNotFoundError, match="b"):
        store.publish(draft, ["a", "b"])
    assert store.snapshot().number == 0


def test_two_loads_at_once(spark, tmp_path, monkeypatch):
    """A number that is taken meanwhile is not overwritten, and nothing of either load is lost."""
    store, other = VersionedStore(spark, str(tmp_path)), VersionedStore(spark, str(tmp_path))
    name, raced = VersionedStore._name, []

    def late(self, number, *content):
        if not raced:
            raced.append(number)
            _load(spark, other, b=7)
        return name(self, number, *content)

    monkeypatch.setattr(VersionedStore, "_name", late)
    assert _load(spark, store, a=3).number == 2
    assert _counts(store.snapshot()) == {"a": 3, "b": 7}


def test_what_was_made_from_an_old_version_is_refused(spark, tmp_path):
    store = VersionedStore(spark, str(tmp_path))
    _load(spark, store, star=3)
    read, draft = store.snapshot(), store.draft()
    draft.write(_rows(1)(spark), "mart", SCHEMA)
    _load(spark, store, star=4)
    with pytest.raises(Conflict, match="star"):
        store.publish(draft, ["mart"], made_from=read)
    store.publish(draft, ["mart"], made_from=store.snapshot())
    assert _counts(store.snapshot()) == {"star": 4, "mart": 1}


def test_old_versions_go_and_dead_loads_can_be_cleared(spark, tmp_path):
    store = VersionedStore(spark, str(tmp_path), kept=2)
    _load(spark, store, a=1, b=1)
    for n in range(2, 6):
        _load(spark, store, a=n)
    assert len(list((tmp_path / "versions").glob("*.json"))) == 2
    folders = {f"{p.parent.name}/{p.name}" for p in (tmp_path / "loads").glob("*/*")}
    named = json.loads(sorted((tmp_path / "versions").glob("*.json"))[-1].read_text())["tables"]
    assert len(folders) == 3 and {f.removeprefix("loads/") for v in named.values() for f in v} < folders
    assert _counts(store.snapshot()) == {"a": 5, "b": 1}
    dead = store.draft()
    dead.write(_rows(1)(spark), "a", SCHEMA)
    assert not [x for x in store.clear_dead_loads(3600) if x in dead.root]
    os.utime(dead.root, (time.time() - 7200,) * 2)
    assert f"{store.root}/{store.clear_dead_loads(3600)[-1]}" == dead.root
    assert _counts(store.snapshot()) == {"a": 5, "b": 1}


def _files(root, n):
    for i in range(n):
        sales = [{"id": str(100 * i + j), "sale_date": f"{1 + j}/1/2021", "product_weight": "x" if j == 3 else "1"} for j in range(9)]
        write_sales(root / "data" / f"MOCK_DATA_{i}.csv", *sales)


def test_jobs_publish_star_and_marts(spark, tmp_path, monkeypatch):
    _files(tmp_path, 2)
    store = VersionedStore(spark, str(tmp_path / "tables"))
    first = run_star_job(spark, str(tmp_path), store, with_marts=True)
    assert store.snapshot().number == 1 and set(first) == {RAW_TABLE, *STAR_TABLES, *MARTS, REJECTS_TABLE, jobs.MALFORMED_TABLE}
    assert _counts(store.snapshot()) == first and first["fact_sales"] == 18 and first[REJECTS_TABLE] == 2

    _files(tmp_path, 3)
    seen = []
    with monkeypatch.context() as watched:
        check = jobs.check_star
        watched.setattr(jobs, "check_star", lambda *a: (seen.append(_counts(store.snapshot())), check(*a)))
        second = run_star_job(spark, str(tmp_path), store, with_marts=True)
    assert seen == [first] and second["fact_sales"] == 27 and _counts(store.snapshot()) == second

    before = store.snapshot()
    with monkeypatch.context() as broken:
        broken.setattr(jobs, "check_star", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            run_star_job(spark, str(tmp_path), store)
    assert store.snapshot() == before and len(list((tmp_path / "tables" / "loads").iterdir())) == 2

    marts = run_marts_job(spark, store, store)
    assert {r.table_name: r.row_count for r in count_tables(store, list(marts)).collect()} == marts
    assert store.snapshot().number == 3 and store.snapshot().tables["fact_sales"] == before.tables["fact_sales"]
    elsewhere = VersionedStore(spark, str(tmp_path / "marts"))
    assert run_marts_job(spark, store, elsewhere) == marts and set(elsewhere.snapshot().tables) == set(MARTS)


def test_marts_of_a_star_that_changes_meanwhile_are_refused(spark, tmp_path, monkeypatch):
    _files(tmp_path, 1)
    store = VersionedStore(spark, str(tmp_path / "tables"))
    run_star_job(spark, str(tmp_path), store)
    made = jobs.store_marts

    def slow(*arguments):
        run_star_job(spark, str(tmp_path), store)
        return made(*arguments)

    monkeypatch.setattr(jobs, "store_marts", slow)
    with pytest.raises(Conflict, match="fact_sales"):
        run_marts_job(spark, store, store)
    assert set(store.snapshot().tables).isdisjoint(MARTS)


def test_only_versions_publish_star_and_marts_together(spark, tmp_path):
    with pytest.raises(ValueError, match="versioned"):
        run_star_job(spark, str(tmp_path), ParquetStore(spark, str(tmp_path)), with_marts=True)
