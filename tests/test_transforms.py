import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from cartwright.catalog import ANALYTICS
from cartwright.functions.numbering import number_by_digest, number_by_integer
from cartwright.operators import partitions, quality
from cartwright.plans import transforms
from cartwright.plans.warehouse import ts
from cartwright.sources.series import repeat_rows

T0, T1, T2 = (dt.datetime(2024, m, 1) for m in (1, 2, 3))
ORDERS = "order_id string, customer_id string, product_id string, quantity int, unit_price decimal(12,2), " \
         "total_amount decimal(12,2), order_timestamp timestamp, payment_method string, order_status string"


def empty(spark, table):
    return spark.createDataFrame([], ANALYTICS[table])


@pytest.fixture
def dims(spark):
    customers = spark.createDataFrame(
        [(1, "c", dt.date(2024, 1, 1), "US", "Email", "New", T0, T1, False),
         (2, "c", dt.date(2024, 1, 1), "US", "Email", "VIP", T1, None, True)], ANALYTICS["dim_customers"])
    products = spark.createDataFrame(
        [(1, "p", "P", "X", D("2.00"), D("5.00"), T0, T1, False),
         (2, "p", "P", "X", D("3.00"), D("5.00"), T1, None, True)], ANALYTICS["dim_products"])
    return customers, products


def staged(spark, *rows):
    return spark.createDataFrame(
        [(o, c, p, q, D("5.00"), D(total), t, "Card", status) for o, c, p, q, total, t, status in rows], ORDERS)


def test_orders_bind_to_current_or_to_their_time(spark, dims):
    s = staged(spark, ("o1", "c", "p", 2, "10.00", T0, "Completed"), ("o2", "x", "y", 1, "4.00", T2, "Pending"))
    now = {r.order_id: r for r in transforms.order_rows(s, *dims).collect()}
    assert (now["o1"].customer_sk, now["o1"].product_sk, now["o1"].profit) == (2, 2, D("4.00"))
    assert (now["o2"].customer_sk, now["o2"].product_sk, now["o2"].profit) == (None, None, D("4.00"))
    then = {r.order_id: r for r in transforms.order_rows(s, *dims, binding="asof").collect()}
    assert (then["o1"].customer_sk, then["o1"].product_sk, then["o1"].profit) == (1, 1, D("6.00"))
    assert now["o1"].date_key == 20240101
    with pytest.raises(ValueError):
        transforms.order_rows(s, *dims, binding="tomorrow")


def test_fact_orders_replaces_staged_orders_only(spark, dims):
    first = transforms.order_rows(
        staged(spark, ("o1", "c", "p", 1, "10.00", T0, "Pending"), ("o2", "c", "p", 1, "7.00", T0, "Pending")), *dims)
    out = transforms.fact_orders(first, staged(spark, ("o1", "c", "p", 1, "10.00", T1, "Completed")), *dims)
    assert {r.order_id: r.order_status for r in out.collect()} == {"o1": "Completed", "o2": "Pending"}


def test_inventory_freezes_product_and_warehouse(spark):
    ddl = "inventory_id string, product_id string, warehouse_location string, quantity_on_hand int, last_restock_date date"
    day = dt.date(2024, 1, 1)
    first = transforms.dim_inventory(
        empty(spark, "dim_inventory"), spark.createDataFrame([("i", "p", "Here", 5, day)], ddl), ts(str(T0)))
    out = transforms.dim_inventory(
        first, spark.createDataFrame([("i", "q", "There", 0, day), ("j", "q", "There", 9, day)], ddl), ts(str(T1)))
    got = {r.inventory_id: r for r in out.collect()}
    assert (got["i"].inventory_sk, got["i"].product_id, got["i"].warehouse_location) == (1, "p", "Here")
    assert (got["i"].quantity_on_hand, got["i"].updated_at) == (0, T1)
    assert got["j"].inventory_sk == 2


def revenue_case(spark):
    revenue = spark.createDataFrame(
        [("r1", dt.date(2024, 1, 1), D("10.00"), D("1.00"), T2), ("r2", dt.date(2024, 1, 1), D("5.00"), D("2.00"), T0),
         ("r3", dt.date(2024, 1, 2), D("7.00"), D("3.00"), T2), ("r4", dt.date(2024, 1, 3), D("9.00"), D("4.00"), T0)],
        "revenue_id string, record_date date, total_revenue decimal(15,2), total_profit decimal(15,2), _loaded_at timestamp")
    noon = dt.datetime(2024, 1, 1, 12)
    orders = staged(spark, *[(f"o{i}", "c", "p", 1, "1.00", noon, "Completed") for i in range(3)],
                    ("o9", "c", "p", 1, "1.00", noon, "Pending"))
    return revenue, orders


def test_agg_revenue_equals_the_join_before_the_sum(spark):
    revenue, orders = revenue_case(spark)
    at = ts(str(T2 + dt.timedelta(hours=1)))
    out = {r.record_date.day: r for r in transforms.agg_revenue(empty(spark, "agg_revenue"), revenue, orders, at).collect()}
    joined = revenue.join(orders.filter("order_status = 'Completed'"),
                          F.to_date("order_timestamp") == F.col("record_date"), "left")
    brute = {r.record_date.day: r for r in joined.groupBy("record_date").agg(
        F.sum("total_revenue").alias("r"), F.sum("total_profit").alias("p"), F.countDistinct("order_id").alias("n")).collect()}
    assert set(out) == {1, 2}
    for day in out:
        assert (out[day].total_revenue, out[day].total_profit, out[day].total_orders) == (
            brute[day].r, brute[day].p, brute[day].n)
    assert out[1].total_revenue == D("45.00") and out[2].total_orders == 0


def test_agg_revenue_once_and_other_days_stay(spark):
    revenue, orders = revenue_case(spark)
    old = spark.createDataFrame([(dt.date(2024, 1, d), D("0.00"), D("0.00"), 0, T0) for d in (1, 3)], ANALYTICS["agg_revenue"])
    out = transforms.agg_revenue(old, revenue, orders, ts(str(T2)), repeat_per_order=False)
    got = {r.record_date.day: (r.total_revenue, r.total_orders) for r in out.collect()}
    assert got == {1: (D("15.00"), 3), 2: (D("7.00"), 0), 3: (D("0.00"), 0)}


def test_calendar(spark):
    as_of = spark.createDataFrame([(dt.date(2024, 2, 29),)], "d date")
    days = transforms.rolling_calendar(as_of)
    assert days.count() == 1462 and days.select("date_key").distinct().count() == 1462
    r = days.filter("date_key = 20240229").first()
    assert (r.day_name, r.month_name, r.day_of_week, r.week_of_year, r.is_weekend) == ("Thursday ", "February ", 4, 9, False)
    known = days.limit(3).withColumn("day_name", F.lit("kept"))
    again = transforms.dim_date(known, as_of)
    assert again.count() == 1462 and again.filter("day_name = 'kept'").count() == 3


def test_numbering_matches_a_global_window(spark):
    ids = spark.range(5000).selectExpr("md5(cast(id as string)) as k")
    got = [(r.n, r.k) for r in number_by_digest(ids, "k", "n").orderBy("n").collect()]
    assert [n for n, _ in got] == list(range(1, 5001))
    import hashlib

    assert [k for _, k in got] == sorted((k for _, k in got), key=lambda k: (hashlib.md5(k.encode()).hexdigest(), k))
    gaps = spark.range(0, 1_000_000, 37).select((F.col("id") + 1).alias("sk"))
    rows = [(r.sk, r.n) for r in number_by_integer(gaps, "sk", "n").orderBy("sk").collect()]
    assert [n for _, n in rows] == list(range(1, len(rows) + 1))
    assert number_by_digest(ids.limit(0), "k", "n").count() == 0


def test_repeat_rows(spark):
    df = spark.createDataFrame([("a", 25), ("b", 0), ("c", 1)], "k string, n long")
    got = sorted((r.k, r.i) for r in repeat_rows(df, "n", "i", block=10).collect())
    assert got == [("a", i) for i in range(1, 26)] + [("c", 1)]


def test_partition_names(spark):
    as_of = F.lit("2024-03-15").cast("date")
    cases = {"2023-02-28 23:59:59": "fact_orders_default", "2023-03-01 00:00:00": "fact_orders_2023_03",
             "2026-03-31 23:59:59": "fact_orders_2026_03", "2026-04-01 00:00:00": "fact_orders_default"}
    df = spark.createDataFrame([(t,) for t in cases], "t string").withColumn("ts", F.col("t").cast("timestamp"))
    got = {r.t: r.p for r in df.select("t", partitions.partition_name(F.col("ts"), as_of).alias("p")).collect()}
    assert got == cases


def test_replacing_rows_moves_them_between_months(spark, tmp_path):
    path = str(tmp_path / "facts")
    ddl = "order_id string, order_timestamp timestamp, v int"
    partitions.replace_rows(spark, path, spark.createDataFrame([("a", T0, 1), ("b", T0, 1), ("c", T1, 1)], ddl))
    moved = spark.createDataFrame([("c", T2, 2), ("a", T0, 2), ("n", T2, 2)], ddl)
    assert partitions.replace_rows(spark, path, moved) == ["2024-01", "2024-02", "2024-03"]
    got = sorted((r.order_id, r.order_month, r.v) for r in partitions.read_months(spark, path, moved.schema).collect())
    assert got == [("a", "2024-01", 2), ("b", "2024-01", 1), ("c", "2024-03", 2), ("n", "2024-03", 2)]


def test_orphans(spark):
    fact = spark.createDataFrame([(1, 10), (2, 20), (3, None)], "id int, sk long")
    dim = spark.createDataFrame([(10,)], "sk long")
    assert [r.id for r in quality.orphans(fact, "sk", dim).collect()] == [2]
    assert sorted((r.id, r.sk) for r in quality.clear_orphans(fact, "sk", dim).collect()) == [(1, 10), (2, None), (3, None)]


def test_all_orphans_are_cleared(spark):
    tables = {name: empty(spark, name) for name in ANALYTICS}
    tables["fact_payments"] = spark.createDataFrame(
        [("p", "o", 20240101, T0, "Card", D("1.00"), "Paid"), ("q", "o", 20240102, T0, "Card", D("1.00"), "Paid")],
        ANALYTICS["fact_payments"])
    as_of = spark.createDataFrame([(dt.date(2022, 1, 1),)], "d date")
    tables["dim_date"] = transforms.rolling_calendar(as_of)
    assert quality.orphan_total(tables).first()[0] == 1
    assert {r.reference: r.violations for r in quality.constraint_violations(tables).collect()} == {
        "fact_payments.date_key": 1, "fact_returns.date_key": 0}
    repaired = {**tables, **quality.clear_all_orphans(tables)}
    assert quality.orphan_total(repaired).first()[0] == 0


def test_repeats(spark):
    dim = spark.createDataFrame([("a", True), ("a", True), ("b", True), ("b", False)], "id string, is_current boolean")
    assert [tuple(r) for r in quality.repeated_current_rows(dim, "id").collect()] == [("a", 2)]
