"""Staging tables into dimensions, facts and the daily aggregate.

Every function returns the target's new content; ``at`` is the batch's time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import MONEY, WIDE_MONEY, line_profit
from ..functions.times import calendar_columns, date_key
from ..operators.history import assign_keys, current_rows, join_as_of, merge_history
from ..operators.merge import delete_insert, insert_ignore, latest_per_key, upsert
from ..operators.narrow import with_packed_ids, with_plain_ids
from ..operators.skew import near
from ..sources.series import every

CUSTOMER_TRACKED = ("country", "acquisition_channel", "customer_segment")
PRODUCT_TRACKED = ("cost_price", "selling_price", "category")


def newest_customers(staging: DataFrame) -> DataFrame:
    rows = staging.select("customer_id", "signup_date", *CUSTOMER_TRACKED, "_loaded_at")
    return latest_per_key(rows, ["customer_id"], ["_loaded_at"]).drop("_loaded_at")


def newest_products(staging: DataFrame) -> DataFrame:
    rows = staging.select("product_id", "product_name", "category", "cost_price", "selling_price", "_loaded_at")
    return latest_per_key(rows, ["product_id"], ["_loaded_at"]).drop("_loaded_at")


def dim_customers(dim: DataFrame, staging: DataFrame, at: Column) -> DataFrame:
    return merge_history(dim, newest_customers(staging), "customer_id", "customer_sk", CUSTOMER_TRACKED, at)


def dim_products(dim: DataFrame, staging: DataFrame, at: Column) -> DataFrame:
    return merge_history(dim, newest_products(staging), "product_id", "product_sk", PRODUCT_TRACKED, at)


def dim_inventory(dim: DataFrame, staging: DataFrame, at: Column) -> DataFrame:
    """Current stock per inventory row; product and warehouse stay as first seen."""
    columns = ("inventory_id", "product_id", "warehouse_location", "quantity_on_hand", "last_restock_date")
    known = dim.select("inventory_id")
    fresh = staging.select(*columns).join(known, "inventory_id", "left_anti")
    inserted = assign_keys(fresh, "inventory_id", "inventory_sk", dim).withColumn("updated_at", at)
    seen = staging.select(*columns).withColumn("updated_at", at).withColumn("inventory_sk", F.lit(None).cast("bigint"))
    touched = seen.join(known, "inventory_id", "left_semi").select(*dim.columns)
    kept = upsert(dim, touched, ["inventory_id"], ["quantity_on_hand", "last_restock_date", "updated_at"])
    return kept.unionByName(inserted.select(*dim.columns))


def calendar(bounds: DataFrame, pad: bool = True) -> DataFrame:
    """Date dimension rows for a one-row frame holding ``first`` and ``last``."""
    days = every(bounds, F.col("first"), F.col("last"), "1 day", "day")
    return days.select(*[c.alias(n) for n, c in calendar_columns(F.col("day"), pad).items()])


def rolling_calendar(as_of: DataFrame, pad: bool = True) -> DataFrame:
    """Two years either side of ``as_of``, a one-row frame with one date column."""
    day = F.col(as_of.columns[0])
    return calendar(as_of.select(F.add_months(day, -24).alias("first"), F.add_months(day, 24).alias("last")), pad)


def dim_date(dim: DataFrame, as_of: DataFrame, pad: bool = True) -> DataFrame:
    return insert_ignore(dim, rolling_calendar(as_of, pad), ["date_key"])


def order_rows(staging: DataFrame, customers: DataFrame, products: DataFrame, binding: str = "current") -> DataFrame:
    """Staged orders bound to dimension rows.

    ``current`` binds every order, old ones too, to the dimension row that is
    current now. ``asof`` binds to the row valid when the order was placed.
    A dimension of up to ``LOOKUP_ROWS`` rows is broadcast, so that orders do not move;
    a larger one is sort-merged with skewed customers or products split. Orders that move
    do so with packed identifiers.
    """
    if binding == "current":
        c = current_rows(customers).select("customer_id", "customer_sk")
        p = current_rows(products).select("product_id", "product_sk", "cost_price")
        small = {"customer_id": near(c), "product_id": near(p)}
        bound = staging if all(small.values()) else with_packed_ids(staging)
        # First the dimension that is broadcast, if one is.
        for key, dim in sorted((("customer_id", c), ("product_id", p)), key=lambda d: not small[d[0]]):
            dim = dim if all(small.values()) else with_packed_ids(dim)
            bound = bound.join(F.broadcast(dim) if small[key] else dim, key, "left")
    elif binding == "asof":
        c = with_packed_ids(customers.select("customer_id", "customer_sk", "valid_from", "valid_to"))
        p = with_packed_ids(products.select("product_id", "product_sk", "cost_price", "valid_from", "valid_to"))
        bound = join_as_of(with_packed_ids(staging), c, "customer_id", "order_timestamp").drop("valid_from", "valid_to")
        bound = join_as_of(bound, p, "product_id", "order_timestamp").drop("valid_from", "valid_to")
    else:
        raise ValueError(f"unknown binding: {binding!r}")
    return with_plain_ids(bound, staging.schema).select(
        "order_id",
        "customer_sk",
        "product_sk",
        date_key(F.col("order_timestamp")).alias("date_key"),
        "order_timestamp",
        "quantity",
        F.col("total_amount").alias("revenue"),
        line_profit(F.col("total_amount"), F.col("cost_price"), F.col("quantity")).cast(MONEY).alias("profit"),
        "order_status",
        "payment_method",
    )


def fact_orders(
    fact: DataFrame, staging: DataFrame, customers: DataFrame, products: DataFrame, binding: str = "current"
) -> DataFrame:
    """Replace every order that is staged; orders that are not staged stay as they are."""
    rows = order_rows(staging, customers, products, binding)
    gone = with_packed_ids(staging.select("order_id"))
    content = delete_insert(with_packed_ids(fact), with_packed_ids(rows), ["order_id"], deleted=gone)
    return with_plain_ids(content, fact.schema)


def payment_rows(staging: DataFrame) -> DataFrame:
    return staging.select(
        "payment_id", "order_id", date_key(F.col("payment_date")).alias("date_key"), "payment_date",
        "payment_method", "amount", "payment_status",
    )


PAYMENT_UPDATED, RETURN_UPDATED = ("payment_status", "amount"), ("return_status", "refund_amount")


def fact_payments(fact: DataFrame, staging: DataFrame) -> DataFrame:
    return upsert(fact, payment_rows(staging), ["payment_id"], PAYMENT_UPDATED)


def return_rows(staging: DataFrame) -> DataFrame:
    return staging.select(
        "return_id", "order_id", date_key(F.col("return_date")).alias("date_key"), "return_date",
        "refund_amount", "return_reason", "return_status",
    )


def fact_returns(fact: DataFrame, staging: DataFrame) -> DataFrame:
    return upsert(fact, return_rows(staging), ["return_id"], RETURN_UPDATED)


def recently_loaded(staging: DataFrame, at: Column, window: str = "2 hours") -> DataFrame:
    return staging.filter(F.col("_loaded_at") >= at - F.expr(f"interval {window}"))


def _completed_per_day(orders: DataFrame) -> DataFrame:
    """Completed orders per day: joined rows and distinct orders.

    Reduced to (day, order) first, so one busy day is spread over many tasks.
    """
    done = orders.filter("order_status = 'Completed'").select(F.to_date("order_timestamp").alias("record_date"), "order_id")
    per_order = with_packed_ids(done).groupBy("record_date", "order_id").agg(F.count("*").alias("n"))
    return per_order.groupBy("record_date").agg(F.sum("n").alias("order_rows"), F.count("*").alias("total_orders"))


def revenue_days(revenue: DataFrame, orders: DataFrame, at: Column, repeat_per_order: bool) -> DataFrame:
    """Totals of the dates that had revenue rows loaded recently.

    With ``repeat_per_order`` a revenue row counts once per completed order of
    its date (once if there is none), which is what joining revenue rows to
    order rows before summing gives. The product of the two per-day aggregates
    yields those sums without building the joined rows. Without it a revenue
    row counts once.
    """
    # The days to do again, from two columns; then only their rows are summed.
    reopened = recently_loaded(revenue.select("record_date", "_loaded_at"), at).select("record_date").distinct()
    sums = revenue.join(reopened, "record_date", "left_semi").groupBy("record_date").agg(
        F.sum("total_revenue").alias("r"), F.sum("total_profit").alias("p"))
    day = F.to_date("order_timestamp")
    orders = orders.join(reopened, day == F.col("record_date"), "left_semi")
    times = F.coalesce("order_rows", F.lit(1)) if repeat_per_order else F.lit(1)
    times = times.cast("decimal(12,0)")
    return sums.join(_completed_per_day(orders), "record_date", "left").select(
        "record_date",
        (F.col("r") * times).cast(WIDE_MONEY).alias("total_revenue"),
        (F.col("p") * times).cast(WIDE_MONEY).alias("total_profit"),
        F.coalesce("total_orders", F.lit(0)).cast("int").alias("total_orders"),
        at.alias("updated_at"),
    )


def agg_revenue(
    agg: DataFrame, revenue: DataFrame, orders: DataFrame, at: Column, repeat_per_order: bool = True
) -> DataFrame:
    """Replace the days whose revenue was loaded in the last two hours."""
    return delete_insert(agg, revenue_days(revenue, orders, at, repeat_per_order), ["record_date"])


def agg_revenue_from_facts(agg: DataFrame, fact: DataFrame, at: Column) -> DataFrame:
    """Daily totals of completed orders, upserted by day."""
    done = fact.filter("order_status = 'Completed'").withColumn("record_date", F.to_date("order_timestamp"))
    per_order = done.groupBy("record_date", "order_id").agg(F.sum("revenue").alias("r"), F.sum("profit").alias("p"))
    days = per_order.groupBy("record_date").agg(
        F.sum("r").cast(WIDE_MONEY).alias("total_revenue"),
        F.sum("p").cast(WIDE_MONEY).alias("total_profit"),
        F.count("*").cast("int").alias("total_orders"),
    )
    return upsert(agg, days.withColumn("updated_at", at), ["record_date"])
