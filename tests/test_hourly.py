"""The scheduled run on a few files, run after run."""

from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from cartwright.operators.store import Store
from cartwright.plans.hourly import HourlyRun
from conftest import CUSTOMER, ORDER, PRODUCT, ROWS
from test_files import write


def line(entity, **changes):
    return ",".join(f'"{v}"' for v in {**ROWS[entity][0], **changes}.values())


def facts(run):
    return {r.order_id[-2:]: r for r in run.fact_orders().collect()}


def test_three_runs(spark, tmp_path):
    run = HourlyRun(Store(spark, str(tmp_path / "store")), str(tmp_path / "landing"))
    land = tmp_path / "landing"
    other = ORDER[:-2] + "99"

    # First run: a customer and two orders, one of them old; no product yet.
    write(land, "customers", "2024-06-15", line("customers"))
    write(land, "orders", "2024-06-15", line("orders"), line("orders", order_id=other, order_timestamp="2020-01-01T00:00:00Z"))
    write(land, "revenue", "2024-06-15", line("revenue"), line("revenue", revenue_id=CUSTOMER, total_profit="-1"))
    write(land, "payments", "2024-06-15", line("payments", payment_date="2019-01-01T00:00:00Z"))
    write(land, "returns", "2024-06-20", line("returns"))
    report = run.run("2024-06-30", "2024-06-30 01:00:00")
    assert report == {
        "entities": ["customers", "orders", "payments", "revenue", "returns"],
        "orphans_cleared": 2, "violations": 0, "default_partition_rows": 1, "views_refreshed": 6,
    }
    first = facts(run)
    assert (first["23"].customer_sk, first["23"].product_sk, first["23"].profit) == (1, None, D("179.98"))
    assert first["99"].date_key is None and run.tables()["fact_payments"].first().date_key is None
    agg = run.tables()["agg_revenue"].collect()
    assert [(str(r.record_date), r.total_revenue, r.total_orders) for r in agg] == [("2024-06-15", D("12500.00"), 1)]

    # Second run: the product arrives and the customer changes; both orders are bound again.
    write(land, "products", "2024-06-16", line("products"))
    write(land, "customers", "2024-06-16", line("customers", country="DE"))
    write(land, "inventory", "2024-06-16", line("inventory"))
    run.run("2024-06-30", "2024-06-30 02:00:00")
    second = facts(run)
    assert {r.customer_sk for r in second.values()} == {2} and {r.product_sk for r in second.values()} == {1}
    assert second["23"].profit == D("89.98")
    history = run.tables()["dim_customers"].orderBy("customer_sk").collect()
    assert [(r.country, r.is_current) for r in history] == [("US", False), ("DE", True)]
    assert history[0].valid_to == history[1].valid_from
    assert run.store.read("mv_revenue_by_category").first().total_orders == 2

    # Third run: nothing new; nothing changes.
    run.run("2024-06-30", "2024-06-30 03:00:00")
    assert facts(run) == second
    assert run.tables()["dim_customers"].count() == 2 and run.tables()["dim_inventory"].count() == 1
    assert spark.table("v_kpi_summary").first().total_orders == 2
    assert PRODUCT in {r.product_id for r in run.tables()["dim_products"].collect()}


def test_a_stopped_run_loses_no_order(spark, tmp_path):
    """Stopped after staging, then after the dimensions, then before the marker: the next run binds all."""
    land = tmp_path / "landing"
    run = HourlyRun(Store(spark, str(tmp_path / "store")), str(land))
    ids = [f"{ORDER[:-2]}{n}" for n in (41, 42, 43, 44)]
    write(land, "customers", "2024-06-15", line("customers"))
    write(land, "products", "2024-06-15", line("products"))
    write(land, "orders", "2024-06-15", line("orders", order_id=ids[0]))
    run.run("2024-06-30", "2024-06-30 01:00:00")
    at = F.lit("2024-06-30 02:00:00").cast("timestamp")
    write(land, "orders", "2024-06-16", line("orders", order_id=ids[1]))
    run.load(at)
    at = F.lit("2024-06-30 03:00:00").cast("timestamp")
    write(land, "orders", "2024-06-17", line("orders", order_id=ids[2]))
    run.load(at)
    run.dimensions(at)
    write(land, "orders", "2024-06-18", line("orders", order_id=ids[3]))
    publish = run.store.publish

    def stop(table, df):
        if table == "facts_marker":
            raise RuntimeError("stopped")
        return publish(table, df)

    run.store.publish = stop
    with pytest.raises(RuntimeError):
        run.run("2024-06-30", "2024-06-30 04:00:00")
    run.store.publish = publish
    run.run("2024-06-30", "2024-06-30 05:00:00")
    assert sorted(r.order_id for r in run.fact_orders().collect()) == ids
    # A run at an earlier time is not lost either.
    write(land, "orders", "2024-06-19", line("orders", order_id=ORDER))
    run.run("2024-06-30", "2024-06-30 01:30:00")
    assert run.fact_orders().count() == 5


def test_old_versions_go(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    for n in range(5):
        store.publish("t", spark.range(n))
    store.publish("u", spark.range(1))
    store.retain(2)
    assert store._versions("t") == [4, 5] and store._versions("u") == [1] and store.read("t").count() == 4
