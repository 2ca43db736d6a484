"""The 24 dashboard queries.

``card(tables, as_of, date_range)`` returns the rows of one card. The range is a
pair of days, both included, or None for no filter; cards on precomputed totals
(key figures, category, channel, top products, retention, status) ignore it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbers import percent, safe_ratio
from ..functions.times import month_start, quarter_start, sunday_based_weekday
from . import views
from .views import COMPLETED, Tables

DateRange = tuple[str, str] | None
Card = Callable[[Tables, Column, DateRange], DataFrame]

CARDS: dict[str, Card] = {}
RANGED: set[str] = set()


def card(name: str, ranged: bool = False) -> Callable[[Card], Card]:
    def register(fn: Card) -> Card:
        CARDS[name] = fn
        if ranged:
            RANGED.add(name)
        return fn

    return register


def in_range(df: DataFrame, column: str, date_range: DateRange) -> DataFrame:
    """Keep rows whose day lies in the range.

    A table partitioned by month gets the matching predicate on the partition
    column too, so months outside the range are not listed or read.
    """
    if date_range is None:
        return df
    first, last = (F.lit(d).cast("date") for d in date_range)
    kept = df.filter((F.col(column) >= first) & (F.col(column) < F.date_add(last, 1)))
    if "order_month" in df.columns and column == "order_timestamp":
        kept = kept.filter(F.col("order_month").between(F.date_format(first, "yyyy-MM"), F.date_format(last, "yyyy-MM")))
    return kept


def _sales(tables: Tables, date_range: DateRange) -> DataFrame:
    return in_range(tables["fact_orders"], "order_timestamp", date_range).filter(COMPLETED)


def _money(c: str) -> Column:
    return F.round(F.col(c), 2)


@card("total_revenue")
def total_revenue(tables, as_of, date_range=None):
    return views.stored_or_computed(tables, "kpi_summary", as_of).select(_money("total_revenue").alias("total_revenue"))


@card("total_orders")
def total_orders(tables, as_of, date_range=None):
    return views.stored_or_computed(tables, "kpi_summary", as_of).select("total_orders")


@card("aov")
def average_order_value(tables, as_of, date_range=None):
    return views.stored_or_computed(tables, "kpi_summary", as_of).select("avg_order_value")


@card("gross_profit")
def gross_profit(tables, as_of, date_range=None):
    return views.stored_or_computed(tables, "kpi_summary", as_of).select(_money("total_profit").alias("gross_profit"))


@card("customer_growth")
def customer_growth(tables, as_of, date_range=None):
    return views.stored_or_computed(tables, "kpi_summary", as_of).select("customer_growth_rate_pct")


def with_change(quarters: DataFrame, value: str) -> DataFrame:
    """Add the previous quarter's value and the change in percent.

    The window spans all rows, of which there is one per quarter.
    """
    before = F.lag(value).over(Window.orderBy("quarter_start"))
    wide = F.col(value).cast("decimal(24,2)")
    earlier = F.col("previous").cast("decimal(24,2)")
    change = F.round(safe_ratio((wide - earlier) * F.lit(100).cast("decimal(3,0)"), earlier), 2)
    return quarters.withColumn("previous", before).withColumn("change_pct", change).orderBy("quarter_start")


def _per_quarter(tables: Tables, date_range: DateRange, value: Column, name: str) -> DataFrame:
    quarters = _sales(tables, date_range).groupBy(quarter_start(F.col("order_timestamp")).alias("quarter_start"))
    return with_change(quarters.agg(value.alias(name)), name)


@card("revenue_qoq", ranged=True)
def revenue_per_quarter(tables, as_of, date_range=None):
    return _per_quarter(tables, date_range, F.round(F.sum("revenue"), 2), "revenue")


@card("orders_qoq", ranged=True)
def orders_per_quarter(tables, as_of, date_range=None):
    return _per_quarter(tables, date_range, F.countDistinct("order_id"), "total_orders")


@card("profit_qoq", ranged=True)
def profit_per_quarter(tables, as_of, date_range=None):
    return _per_quarter(tables, date_range, F.round(F.sum("profit"), 2), "gross_profit")


@card("revenue_trend", ranged=True)
def revenue_trend(tables, as_of, date_range=None):
    trend = views.stored_or_computed(tables, "revenue_trend_daily", as_of)
    return in_range(trend, "date", date_range).select("date", "daily_revenue").orderBy("date")


@card("revenue_category")
def revenue_by_category(tables, as_of, date_range=None):
    rows = views.stored_or_computed(tables, "revenue_by_category", as_of)
    return rows.select("category", "total_revenue").orderBy(F.col("total_revenue").desc(), "category")


@card("revenue_channel")
def revenue_by_channel(tables, as_of, date_range=None):
    rows = views.stored_or_computed(tables, "revenue_by_channel", as_of)
    return rows.select("acquisition_channel", "total_revenue").orderBy(F.col("total_revenue").desc(), "acquisition_channel")


@card("top_products")
def top_products(tables, as_of, date_range=None):
    rows = views.stored_or_computed(tables, "top_products_profit", as_of)
    best = rows.orderBy(F.col("total_profit").desc(), "product_name", "category")
    return best.select("product_name", "category", "total_profit", "units_sold")


@card("retention")
def retention(tables, as_of, date_range=None):
    rows = views.stored_or_computed(tables, "customer_retention", as_of)
    return rows.select("customer_segment", "total_orders").orderBy(F.col("total_orders").desc(), "customer_segment")


@card("order_status")
def order_status(tables, as_of, date_range=None):
    return views.order_status_distribution(tables).select("order_status", "order_count")


@card("monthly_rev_profit", ranged=True)
def monthly_revenue_profit(tables, as_of, date_range=None):
    trend = in_range(views.stored_or_computed(tables, "revenue_trend_daily", as_of), "date", date_range)
    months = trend.groupBy(month_start(F.col("date")).alias("month"))
    return months.agg(
        F.sum("daily_revenue").alias("monthly_revenue"), F.sum("daily_profit").alias("monthly_profit")
    ).orderBy("month")


@card("margin_category")
def margin_by_category(tables, as_of, date_range=None):
    margin = percent(F.col("total_profit"), F.col("total_revenue")).alias("profit_margin_pct")
    by_category = views.stored_or_computed(tables, "revenue_by_category", as_of).select("category", margin)
    return by_category.orderBy(F.col("profit_margin_pct").desc_nulls_first(), "category")


@card("payment_method", ranged=True)
def orders_by_payment_method(tables, as_of, date_range=None):
    return (
        _sales(tables, date_range)
        .groupBy("payment_method")
        .agg(F.countDistinct("order_id").alias("total_orders"), F.round(F.sum("revenue"), 2).alias("total_revenue"))
        .orderBy(F.col("total_orders").desc(), "payment_method")
    )


@card("returns_status", ranged=True)
def returns_by_status(tables, as_of, date_range=None):
    rows = in_range(tables["fact_returns"], "return_date", date_range)
    counts = rows.groupBy("return_status").agg(F.count("*").alias("return_count"))
    return counts.orderBy(F.col("return_count").desc(), "return_status")


@card("mac", ranged=True)
def monthly_active_customers(tables, as_of, date_range=None):
    months = _sales(tables, date_range).groupBy(month_start(F.col("order_timestamp")).alias("month"))
    return months.agg(F.countDistinct("customer_sk").alias("active_customers")).orderBy("month")


@card("weekday", ranged=True)
def sales_by_weekday(tables, as_of, date_range=None):
    placed = F.col("order_timestamp")
    days = _sales(tables, date_range).groupBy(
        F.date_format(placed, "E").alias("weekday"), sunday_based_weekday(placed).alias("weekday_order")
    )
    return days.agg(
        F.countDistinct("order_id").alias("total_orders"), F.round(F.sum("revenue"), 2).alias("total_revenue")
    ).orderBy("weekday_order")


@card("top_countries", ranged=True)
def top_countries(tables, as_of, date_range=None, n: int = 10):
    dc = tables["dim_customers"].select("customer_sk", "country")
    sold = _sales(tables, date_range).join(dc, "customer_sk")
    countries = sold.groupBy(F.coalesce("country", F.lit("Unknown")).alias("country")).agg(
        F.round(F.sum("revenue"), 2).alias("total_revenue"), F.countDistinct("order_id").alias("total_orders")
    )
    return countries.orderBy(F.col("total_revenue").desc_nulls_first(), "country").limit(n)


@card("refund_trend", ranged=True)
def monthly_refunds(tables, as_of, date_range=None):
    rows = in_range(tables["fact_returns"], "return_date", date_range)
    months = rows.groupBy(month_start(F.col("return_date")).alias("month"))
    return months.agg(F.round(F.sum("refund_amount"), 2).alias("total_refund_amount")).orderBy("month")


@card("repeat_rate", ranged=True)
def repeat_customer_rate(tables, as_of, date_range=None):
    """Orders without a customer form one group of their own."""
    per_customer = _sales(tables, date_range).groupBy("customer_sk").agg(F.countDistinct("order_id").alias("n"))
    totals = per_customer.agg(F.count("*").alias("everyone"), F.count_if(F.col("n") > 1).alias("repeat"))
    return totals.select(percent(F.col("repeat"), F.col("everyone")).alias("repeat_customer_rate_pct"))


@card("avg_items", ranged=True)
def average_items(tables, as_of, date_range=None):
    totals = _sales(tables, date_range).agg(F.sum("quantity").alias("items"), F.countDistinct("order_id").alias("n"))
    items = F.col("items").cast("decimal(20,0)")
    return totals.select(F.round(safe_ratio(items, F.col("n")), 2).alias("avg_items_per_order"))
