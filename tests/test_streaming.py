import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from cartwright.operators.store import Store
from cartwright.plans import staging
from cartwright.plans.warehouse import ts
from cartwright.sources import files
from cartwright.streaming import loads
from conftest import ROWS
from test_files import write

AT = "2024-07-01"


@pytest.fixture
def load(spark, tmp_path):
    return loads.EntityLoad(Store(spark, str(tmp_path / "store")), str(tmp_path / "landing"), "orders")


def line(key="4", **changes):
    row = dict(ROWS["orders"][0], order_id=f"d4e5f6a7-b8c9-0123-defa-23456789012{key}")
    return ",".join({**row, **changes}.values())


def state(load):
    rows = load.store.read("stg_orders").collect()
    return {r.order_id[-1]: (r.order_status, r.quantity) for r in rows}


def test_files_stream_in_once_and_later_ones_win(load, tmp_path):
    write(tmp_path / "landing", "orders", "2024-01-01", line("1"), line("2", order_status="Pending"))
    load.run(ts(AT))
    assert state(load) == {"1": ("Completed", 2), "2": ("Pending", 2)}
    write(tmp_path / "landing", "orders", "2024-01-02", line("2", order_status="Refunded"), line("3", quantity="-1"))
    load.run(ts(AT))
    load.run(ts(AT))
    assert state(load) == {"1": ("Completed", 2), "2": ("Refunded", 2)}
    ledger = load.store.read("processed_files_orders")
    assert {(r.object_path[-12:], r.row_count, r.status) for r in ledger.collect()} == {
        ("20240101.csv", 2, "success"), ("20240102.csv", 1, "success")}


def test_stream_equals_batch(spark, load, tmp_path):
    for day in ("2024-01-01", "2024-01-02"):
        write(tmp_path / "landing", "orders", day, *[line(str(i), quantity=str(i)) for i in range(1, 9)],
              line("9", order_status="Lost"), line("9"))
    load.run(ts(AT))
    raw = files.read_raw(spark, load.landing, "orders")
    batch = staging.check("orders", raw)
    columns = load.store.read("stg_orders").columns
    assert sorted(map(str, load.store.read("stg_orders").collect())) == sorted(
        map(str, batch.newest(ts(AT)).select(*columns).collect()))
    reader = spark.read.option("header", True).option("recursiveFileLookup", True)
    quarantined = reader.csv(load.quarantine)
    assert quarantined.count() == batch.rejected.count() == 4
    assert {r._reasons for r in quarantined.collect()} == {"enum:order_status|unique:order_id", "unique:order_id"}


def test_a_repeated_batch_changes_nothing(spark, load, tmp_path):
    write(tmp_path / "landing", "orders", "2024-01-01", line("1"), line("2", quantity="-1"))
    load.run(ts(AT))
    before = state(load)
    frame = spark.read.schema(files.ENTITIES["orders"].raw_schema).option("header", True).option(
        "recursiveFileLookup", True).csv(f"{load.landing}/entity=orders").select("*", *files.file_columns())
    load._apply(frame, 1, ts(AT))
    assert state(load) == before
    assert load.store.read("processed_files_orders").count() == 1
    # Delivered again before the ledger was written: the same batch number.
    load.store.publish("processed_files_orders", load.store.read("processed_files_orders").limit(0))
    load._apply(frame, 0, ts(AT))
    assert state(load) == before
    rejected = spark.read.option("header", True).option("recursiveFileLookup", True).csv(load.quarantine)
    assert rejected.count() == 1


FEED = "order_id string, order_timestamp timestamp, order_status string, total_amount decimal(12,2), seq int"


def feed_rows(*rows):
    return [(o, dt.datetime(2024, m, d), s, D(a), q) for o, m, d, s, a, q in rows]


def totals(store):
    return {str(r.record_date): (r.total_revenue, r.total_orders) for r in store.read("totals").collect()}


def test_late_changes_reopen_their_days(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    store.ensure("totals", "record_date date, total_revenue decimal(15,2), total_orders bigint, updated_at timestamp")
    load = loads.DailyTotals(store, "orders", "totals", ["seq"])
    folder = str(tmp_path / "feed")

    def arrive(*rows):
        spark.createDataFrame(feed_rows(*rows), FEED).coalesce(1).write.mode("append").parquet(folder)
        load.run(loads.stream_parquet(spark, folder, spark.createDataFrame([], FEED).schema), ts(AT))

    arrive(("a", 1, 1, "Completed", "10.00", 1), ("b", 1, 1, "Pending", "5.00", 1), ("c", 2, 1, "Completed", "1.00", 1))
    assert totals(store) == {"2024-01-01": (D("10.00"), 1), "2024-02-01": (D("1.00"), 1)}
    # b completes, c moves to another month and leaves its old day empty
    arrive(("b", 1, 1, "Completed", "5.00", 2), ("c", 3, 1, "Completed", "1.00", 2))
    assert totals(store) == {"2024-01-01": (D("15.00"), 2), "2024-03-01": (D("1.00"), 1)}
    # a is cancelled
    arrive(("a", 1, 1, "Cancelled", "10.00", 3))
    assert totals(store) == {"2024-01-01": (D("5.00"), 1), "2024-03-01": (D("1.00"), 1)}


def test_late_rebuild_survives_a_repeated_batch(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    store.ensure("totals", "record_date date, total_revenue decimal(15,2), total_orders bigint, updated_at timestamp")
    load = loads.DailyTotals(store, "orders", "totals", ["seq"])
    load._apply(spark.createDataFrame(feed_rows(("a", 1, 1, "Completed", "10.00", 1)), FEED), 0, ts(AT))
    old = store.read("totals")
    move = spark.createDataFrame(feed_rows(("a", 2, 1, "Completed", "10.00", 2)), FEED)
    load._apply(move, 1, ts(AT))
    # As if the totals of batch 1 had not been written before the failure.
    store.publish("totals", old)
    load._apply(move, 1, ts(AT))
    assert totals(store) == {"2024-02-01": (D("10.00"), 1)}
