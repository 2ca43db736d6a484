"""Every registered query against its check SQL, on the smallest tables."""

import importlib.util
import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from cartwright.registry import QUERIES
from cartwright.plans.cards import CARDS, RANGED
from cartwright.plans.warehouse import warehouse
from conftest import SMALL

_spec = importlib.util.spec_from_file_location(
    "check", os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools", "check.py")
)
check = importlib.util.module_from_spec(_spec)
_spec.loader.exec_module(check)

pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="test tables not present")


@pytest.fixture(scope="module")
def duck():
    return check.connect(SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    assert check.compare(spark, duck, SMALL, name)[0] == "ok"


def test_entry(spark):
    rows = driver.entry(spark).collect()
    assert rows and abs(sum(r.revenue_share_pct for r in rows) - 100) < 0.1


def as_of():
    return F.lit("2001-08-01").cast("date")


def test_there_are_24_cards_and_13_take_a_range():
    assert len(CARDS) == 24 and len(RANGED) == 13


@pytest.mark.parametrize("name", sorted(RANGED))
def test_a_range_over_everything_changes_nothing(spark, name):
    w = warehouse(spark, SMALL)
    whole = CARDS[name](w, as_of(), None).collect()
    assert CARDS[name](w, as_of(), ("1990-01-01", "2010-12-31")).collect() == whole


@pytest.mark.parametrize("name", sorted(RANGED - {"repeat_rate", "avg_items"}))
def test_a_range_without_rows_is_empty(spark, name):
    assert CARDS[name](warehouse(spark, SMALL), as_of(), ("1990-01-01", "1990-12-31")).collect() == []


def test_a_range_reads_only_its_months(spark):
    w = warehouse(spark, SMALL)
    df = CARDS["payment_method"](w, as_of(), ("2001-01-01", "2001-03-31"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(order_month" in plan
    assert "EqualTo(order_status,Completed)" in plan


def test_no_view_needs_the_whole_fact_row(spark):
    w = warehouse(spark, SMALL)
    plan = driver.queries()["view_kpi_summary"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<order_id:string,revenue:decimal(12,2),profit:decimal(12,2),order_status:string>" in plan
    assert w is warehouse(spark, SMALL)


def test_no_query_plan_has_a_cross_join_or_python(spark):
    for name in ("view_kpi_summary", "join_cross_scalar", "join_cross_series", "val_orders",
                 "stg_orders", "win_total_count", "join_hash_bucket"):
        plan = driver.queries()[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
        for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas"):
            assert word not in plan, (name, word)


STORED = ("total_revenue", "total_orders", "aov", "gross_profit", "customer_growth", "revenue_trend", "revenue_category",
          "revenue_channel", "top_products", "retention", "monthly_rev_profit", "margin_category")


@pytest.mark.parametrize("name", STORED)
def test_cards_on_stored_views_read_no_fact(spark, name):
    w = warehouse(spark, SMALL)
    plan = CARDS[name](w, as_of(), None)._jdf.queryExecution().executedPlan().toString()
    assert "fact_orders" not in plan and "mv_" in plan
