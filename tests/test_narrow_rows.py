"""Rows move as numbers, and text is made of them where they end up."""

import os

import pytest
from pyspark.sql import functions as F

from cartwright.catalog import ENTITIES
from cartwright.operators import merge, narrow, skew
from cartwright.operators import validate as V
from cartwright.operators.parted import Keyed
from cartwright.operators.store import Store
from cartwright.plans import transforms
from cartwright.plans.hourly import HourlyRun
from cartwright.plans.warehouse import BUILDERS, Warehouse, ts, warehouse
from cartwright.registry import star
from cartwright.session import shared_dir
from cartwright.sources import files, retail
from cartwright.streaming import loads
from conftest import SMALL
from test_files import write
from test_streaming import line

needs_tables = pytest.mark.skipif(not os.path.isdir(SMALL), reason="test tables not present")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def below_exchanges(df):
    """The part of a plan from its first exchange on."""
    text = plan(df)
    assert "Exchange" in text
    return text[text.index("Exchange"):]


@needs_tables
@pytest.mark.parametrize("entity, key", [("orders", "order_id"), ("returns", "return_id")])
def test_latest_rows_are_chosen_before_they_have_identifiers(spark, entity, key):
    found = BUILDERS[f"stg_{entity}"](warehouse(spark, SMALL))
    assert "md5(" in plan(found) and "md5(" not in below_exchanges(found)
    slow = merge.latest_per_key(retail.TYPED[entity](spark, SMALL), [key], list(retail.LINE_ORDER)).select(*found.columns)
    assert slow.count() == found.count() and found.exceptAll(slow).isEmpty()


@needs_tables
def test_latest_orders_before_a_time(spark):
    cut = ts(retail.SECOND_LOAD)
    lines = retail.orders(spark, SMALL).filter(F.col("_loaded_at") < cut)
    slow = merge.latest_per_key(lines, ["order_id"], list(retail.LINE_ORDER))
    found = retail.latest_orders(spark, SMALL, before=retail.SECOND_LOAD).select(*slow.columns)
    assert slow.count() == found.count() > 0 and found.exceptAll(slow).isEmpty()


@needs_tables
@pytest.mark.parametrize("entity", sorted(retail.NARROW))
def test_landed_rows_become_text_after_they_are_brought_together(spark, entity):
    found, slow = retail.raw_by_file(spark, SMALL, entity), retail.raw(spark, SMALL, entity)
    assert "md5(" not in below_exchanges(found)
    columns = [*ENTITIES[entity].columns, "_source_file"]
    assert slow.count() == found.count() and found.select(*columns).exceptAll(slow.select(*columns)).isEmpty()


@needs_tables
def test_small_dimensions_are_broadcast_to_the_orders(spark, monkeypatch):
    w = warehouse(spark, SMALL)
    w["stg_orders"], w["dim_customers"], w["dim_products"]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        near = transforms.order_rows(w["stg_orders"], w["dim_customers"], w["dim_products"])
        assert plan(near).count("BroadcastHashJoin") == 2 and "hashpartitioning" not in plan(near)
        monkeypatch.setattr(skew, "LOOKUP_ROWS", 0)
        far = transforms.order_rows(w["stg_orders"], w["dim_customers"], w["dim_products"])
        assert "BroadcastHashJoin" not in plan(far)
        assert near.exceptAll(far).isEmpty() and near.count() == far.count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_first_lines_are_found_without_sorting_or_moving_rows(spark, tmp_path):
    for day in ("2024-01-01", "2024-01-02"):
        write(tmp_path, "customers", day, "a,2024-01-15,US,Organic,New", "b,2024-01-15,US,Organic,New")
    rows = files.read_raw(spark, str(tmp_path), "customers")
    assert "SortAggregate" not in plan(rows) and "SortMergeJoin" not in plan(rows)
    assert sorted(r.customer_id for r in rows.collect()) == ["a", "a", "b", "b"]


def test_repeats_are_exact_where_hashes_are_equal(spark, monkeypatch):
    df = spark.createDataFrame([("f", "a"), ("f", "a"), ("f", "b"), ("g", "a")], "_source_file string, key string")
    monkeypatch.setattr(V.F, "xxhash64", lambda *_: F.lit(1).cast("bigint"))
    assert [(r.key, r._n) for r in V.repeated(df, ["_source_file", "key"]).collect()] == [("a", 2)]


def test_a_load_caches_nothing_and_leaves_no_copies(spark, tmp_path, monkeypatch):
    load = loads.EntityLoad(Store(spark, str(tmp_path / "store")), str(tmp_path / "landing"), "orders")
    write(tmp_path / "landing", "orders", "2024-01-01", line("1"), line("2", quantity="-1"))
    from pyspark.sql import DataFrame

    def refuse(*_, **__):
        raise AssertionError("a cache of the rows")

    monkeypatch.setattr(DataFrame, "persist", refuse)
    load.run(ts("2024-07-01"))
    assert load.store.read("stg_orders").count() == 1
    left = os.listdir(shared_dir(spark).removeprefix("file:"))
    assert not [n for n in left if n.startswith(("landed-", "checked-"))]


ODD_IDS = ["0f8fad5b-d9cb-469f-a165-70867728950e", "0F8FAD5B-d9cb-469f-a165-70867728950e",
           "0f8fad5b-d9cb-469f-a165-70867728950e\n", "0f8fad5bd9cb469fa16570867728950e", "", "a", "x" * 16, "ä" * 16,
           "-" * 36, "not-a-uuid", None]


def test_packed_identifiers_are_the_same_text_again(spark):
    df = spark.createDataFrame([(i, c, "k") for i, c in enumerate(ODD_IDS)], "n int, order_id string, other string")
    packed = narrow.with_packed_ids(df)
    assert dict(packed.dtypes) == {"n": "int", "order_id": "binary", "other": "string"}
    got = {r.n: bytes(r.order_id) if r.order_id is not None else None for r in packed.collect()}
    assert len(got[0]) == 16 and len(set(got.values())) == len(ODD_IDS)
    assert all(len(b) > 16 for n, b in got.items() if n and b is not None)
    back = narrow.with_plain_ids(narrow.with_packed_ids(packed), df.schema)
    assert [r.order_id for r in back.orderBy("n").collect()] == ODD_IDS
    # Bytes that were no text before stay bytes.
    raw = spark.createDataFrame([(bytearray(16),)], "order_id binary")
    assert narrow.with_plain_ids(narrow.with_packed_ids(raw), raw.schema).dtypes == raw.dtypes


def test_a_table_in_parts_moves_packed_identifiers(spark, tmp_path):
    rows = spark.createDataFrame([(c, i) for i, c in enumerate(ODD_IDS[:-1])], "order_id string, n int")
    table = Keyed(spark, str(tmp_path / "t"), "order_id")
    table.adopt(rows)
    table.upsert(rows.filter("n > 2").withColumn("n", F.col("n") + 100).unionByName(
        spark.createDataFrame([("new", 7)], rows.schema)), ["n"])
    want = {c: i + 100 * (i > 2) for i, c in enumerate(ODD_IDS[:-1])} | {"new": 7}
    assert {r.order_id: r.n for r in table.read().collect()} == want and table.read().count() == len(want)
    assert [r.order_id for r in table.unknown(spark.createDataFrame([("a", 1), ("b", 1)], rows.schema)).collect()] == ["b"]


@needs_tables
@pytest.mark.parametrize("binding", ["current", "asof"])
def test_orders_that_move_have_packed_identifiers(spark, monkeypatch, binding):
    w = warehouse(spark, SMALL)
    monkeypatch.setattr(skew, "LOOKUP_ROWS", 0)
    rows = transforms.order_rows(w["stg_orders"], w["dim_customers"], w["dim_products"], binding)
    assert "unhex(" in below_exchanges(rows) and dict(rows.dtypes)["order_id"] == "string"


def test_batches_of_a_run_leave_no_copies(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    run = HourlyRun(store, str(tmp_path / "landing"))
    write(tmp_path / "landing", "orders", "2024-01-01", line("1"), line("2"))
    run.run("2024-07-01", "2024-07-01 01:00:00")
    assert run.fact_orders().count() == 2
    kept = os.listdir(store.root) + os.listdir(shared_dir(spark).removeprefix("file:"))
    assert not [n for n in kept if "batch" in n or "-sound" in n or n.startswith("newest-")]


@needs_tables
@pytest.mark.parametrize("fact, binding", [("fact_orders", "current"), ("fact_orders_asof", "asof")])
def test_order_facts_need_no_stored_orders(spark, fact, binding):
    w = Warehouse(spark, SMALL)
    found = w[fact].drop("order_month")
    assert not os.path.exists(f"{w.root.removeprefix('file:')}/stg_orders")
    slow = transforms.order_rows(w["stg_orders"], w["dim_customers"], w["dim_products"], binding)
    assert slow.count() == found.count() > 0 and found.exceptAll(slow.select(*found.columns)).isEmpty()
    # Once they are stored, they are read.
    assert "stg_orders" in plan(transforms.order_rows(w.rows("stg_orders"), w["dim_customers"], w["dim_products"]))


@needs_tables
def test_the_daily_aggregate_needs_no_stored_orders(spark):
    w = Warehouse(spark, SMALL)
    found = star.daily_revenue(w)
    assert found.count() > 0 and not os.path.exists(f"{w.root.removeprefix('file:')}/stg_orders")
    slow = transforms.agg_revenue(star.stale_aggregate(w), w["stg_revenue"], w["stg_orders"], ts(star.AGG_AT))
    assert slow.count() == found.count() and found.exceptAll(slow).isEmpty()
