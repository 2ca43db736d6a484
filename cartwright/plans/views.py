"""The seven analytic views.

Each takes the star schema's tables by name and the date "today" stands for.
Rounded shares are decimals; ordering is part of the result.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbers import growth_percent, percent, safe_ratio, sum_or_zero

Tables = Mapping[str, DataFrame]

COMPLETED = "order_status = 'Completed'"


def over_groups(total: Column) -> Column:
    """A total over group rows: by then there is one row per group, not per order."""
    return total.over(Window.partitionBy())


def _signups(customers: DataFrame, first: Column, before: Column, out: str) -> DataFrame:
    fresh = customers.filter("is_current").filter((F.col("signup_date") >= first) & (F.col("signup_date") < before))
    return fresh.agg(F.countDistinct("customer_id").alias(out))


def kpi_summary(tables: Tables, as_of: Column) -> DataFrame:
    """One row of key figures; the two signup counts are one-row subqueries."""
    dc = tables["dim_customers"]
    month, earlier = F.date_sub(as_of, 30), F.date_sub(as_of, 60)
    last = _signups(dc, month, as_of, "n").scalar()
    prior = _signups(dc, earlier, month, "n").scalar()
    totals = tables["fact_orders"].filter(COMPLETED).agg(
        sum_or_zero(F.col("revenue")).alias("total_revenue"),
        sum_or_zero(F.col("profit")).alias("total_profit"),
        F.countDistinct("order_id").alias("total_orders"),
    )
    average = F.coalesce(safe_ratio(F.col("total_revenue"), F.col("total_orders")), F.lit(0).cast("decimal(12,2)"))
    return totals.select(
        "total_revenue",
        "total_profit",
        "total_orders",
        F.round(average, 2).alias("avg_order_value"),
        growth_percent(last, prior).alias("customer_growth_rate_pct"),
    )


def revenue_trend_daily(tables: Tables, as_of: Column) -> DataFrame:
    """Completed sales per calendar day up to today, with zeros for empty days.

    Orders are reduced to one row per day before they meet the calendar, so the
    join moves one row per day whatever the number of orders.
    """
    per_day = (
        tables["fact_orders"]
        .filter(COMPLETED)
        .groupBy("date_key")
        .agg(
            F.sum("revenue").alias("r"),
            F.sum("profit").alias("p"),
            F.countDistinct("order_id").alias("n"),
        )
    )
    days = tables["dim_date"].filter(F.col("full_date") <= as_of)
    zero = F.lit(0).cast("decimal(12,2)")
    return (
        days.join(per_day, "date_key", "left")
        .select(
            F.col("full_date").alias("date"),
            "year",
            "month_number",
            "month_name",
            F.coalesce("r", zero).alias("daily_revenue"),
            F.coalesce("p", zero).alias("daily_profit"),
            F.coalesce("n", F.lit(0)).alias("daily_orders"),
        )
        .orderBy("date")
    )


def revenue_by_category(tables: Tables, as_of: Column | None = None) -> DataFrame:
    fo = tables["fact_orders"].filter(COMPLETED)
    dp = tables["dim_products"].select("product_sk", "category")
    groups = fo.join(dp, "product_sk").groupBy("category").agg(
        sum_or_zero(F.col("revenue")).alias("total_revenue"),
        sum_or_zero(F.col("profit")).alias("total_profit"),
        F.countDistinct("order_id").alias("total_orders"),
    )
    share = percent(F.col("total_revenue"), over_groups(F.sum("total_revenue")))
    return groups.withColumn("revenue_share_pct", share).orderBy(F.col("total_revenue").desc(), "category")


def _customers_per(fo: DataFrame, dc: DataFrame, group: str) -> DataFrame:
    """Distinct dimension rows with an order, per group.

    A second narrow scan instead of a second distinct in one aggregate, which
    would copy every order row for each distinct column.
    """
    buyers = fo.select("customer_sk").distinct()
    return buyers.join(dc, "customer_sk").groupBy(group).agg(F.count("*").alias("unique_customers"))


def _orders_per_customer_group(fo: DataFrame, dc: DataFrame, group: str) -> DataFrame:
    sums = fo.join(dc, "customer_sk").groupBy(group).agg(
        sum_or_zero(F.col("revenue")).alias("total_revenue"), F.countDistinct("order_id").alias("total_orders")
    )
    buyers = _customers_per(fo, dc, group).withColumnRenamed(group, "_group")
    return sums.join(buyers, sums[group].eqNullSafe(buyers["_group"])).drop("_group")


def revenue_by_channel(tables: Tables, as_of: Column | None = None) -> DataFrame:
    fo = tables["fact_orders"].filter(COMPLETED)
    dc = tables["dim_customers"].select("customer_sk", "acquisition_channel")
    groups = _orders_per_customer_group(fo, dc, "acquisition_channel")
    share = percent(F.col("total_revenue"), over_groups(F.sum("total_revenue")))
    return groups.select(
        "acquisition_channel", "total_revenue", "total_orders", "unique_customers", share.alias("revenue_share_pct")
    ).orderBy(F.col("total_revenue").desc(), "acquisition_channel")


def top_products_profit(tables: Tables, as_of: Column | None = None, n: int = 10) -> DataFrame:
    """Most profitable products; equal profits are ordered by name and category.

    Orders are summed per surrogate key first, so names are looked up once per
    product and not once per order.
    """
    fo = tables["fact_orders"].filter(COMPLETED)
    dp = tables["dim_products"].select("product_sk", "product_name", "category")
    per_key = fo.groupBy("product_sk").agg(
        F.sum("profit").alias("p"), F.sum("revenue").alias("r"), F.sum("quantity").alias("q")
    )
    groups = per_key.join(dp, "product_sk").groupBy("product_name", "category").agg(
        sum_or_zero(F.col("p")).alias("total_profit"),
        sum_or_zero(F.col("r")).alias("total_revenue"),
        F.sum("q").alias("units_sold"),
    )
    return groups.orderBy(F.col("total_profit").desc(), "product_name", "category").limit(n)


def customer_retention(tables: Tables, as_of: Column | None = None) -> DataFrame:
    """Orders of every status per customer segment."""
    dc = tables["dim_customers"].select("customer_sk", "customer_segment")
    groups = _orders_per_customer_group(tables["fact_orders"], dc, "customer_segment")
    share = percent(F.col("total_orders"), over_groups(F.sum("total_orders")))
    return groups.select(
        "customer_segment", "total_orders", "unique_customers", "total_revenue", share.alias("order_share_pct")
    ).orderBy(F.col("total_orders").desc(), "customer_segment")


def order_status_distribution(tables: Tables, as_of: Column | None = None) -> DataFrame:
    groups = tables["fact_orders"].groupBy("order_status").agg(
        F.countDistinct("order_id").alias("order_count"), sum_or_zero(F.col("revenue")).alias("total_revenue")
    )
    share = percent(F.col("order_count"), over_groups(F.sum("order_count")))
    return groups.withColumn("pct_of_total", share).orderBy(F.col("order_count").desc(), "order_status")


# Stored on refresh; the status distribution is always computed live.
MATERIALIZED = {
    "kpi_summary": kpi_summary,
    "revenue_trend_daily": revenue_trend_daily,
    "revenue_by_category": revenue_by_category,
    "revenue_by_channel": revenue_by_channel,
    "top_products_profit": top_products_profit,
    "customer_retention": customer_retention,
}
LIVE = {"order_status_distribution": order_status_distribution}


def stored_or_computed(tables: Tables, name: str, as_of: Column) -> DataFrame:
    """A view as its last refresh stored it; computed where ``tables`` has no stored one."""
    if f"mv_{name}" in tables:
        return tables[f"mv_{name}"]
    return MATERIALIZED[name](tables, as_of)
