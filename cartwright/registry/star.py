"""Dimensions, facts and the daily aggregate."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.numbering import number_by_digest
from ..functions.times import calendar_columns
from ..plans import transforms
from ..plans.warehouse import Warehouse, ts
from ..sources import retail
from .base import query

DIM_CUSTOMER = (
    "customer_sk, customer_id, signup_date, country, acquisition_channel, customer_segment, valid_from, valid_to, "
    "is_current"
)
FACT = (
    "order_id, customer_sk, product_sk, date_key, order_timestamp, quantity, CAST(revenue AS DOUBLE) AS revenue, "
    "CAST(profit AS DOUBLE) AS profit, order_status, payment_method"
)


@query("dim_customers_scd2", f"SELECT {DIM_CUSTOMER} FROM d_customers")
def customers_history(w: Warehouse):
    return transforms.dim_customers(w["dim_customers_v1"], w["stg_customer_changes"], ts(retail.SECOND_LOAD))


@query(
    "dim_products_scd2",
    "SELECT product_sk, product_id, product_name, category, CAST(cost_price AS DOUBLE) AS cost_price, "
    "CAST(selling_price AS DOUBLE) AS selling_price, valid_from, valid_to, is_current FROM d_products",
)
def products_history(w: Warehouse):
    return transforms.dim_products(w["dim_products_v1"], w["stg_product_changes"], ts(retail.SECOND_LOAD))


def earlier_stock(w: Warehouse):
    """Stock as loaded before 15 June 2001, counted at zero."""
    return w["stg_inventory"].filter("last_restock_date < DATE '2001-06-15'").withColumn(
        "quantity_on_hand", F.lit(0)
    )


def moved_stock(w: Warehouse):
    """All stock as loaded later, every row now naming another warehouse."""
    return w["stg_inventory"].withColumn("warehouse_location", F.upper("warehouse_location"))


@query(
    "dim_inventory_snapshot",
    """
    WITH first_load AS (
        SELECT *, row_number() OVER (ORDER BY md5(inventory_id), inventory_id) AS sk
        FROM t_inventory WHERE last_restock_date < DATE '2001-06-15')
    SELECT sk AS inventory_sk, inventory_id, product_id, warehouse_location, quantity_on_hand, last_restock_date,
           TIMESTAMP '2000-01-01' AS updated_at
    FROM first_load
    UNION ALL
    SELECT (SELECT count(*) FROM first_load) + row_number() OVER (ORDER BY md5(inventory_id), inventory_id),
           inventory_id, product_id, upper(warehouse_location), quantity_on_hand, last_restock_date,
           TIMESTAMP '2000-01-01'
    FROM t_inventory WHERE last_restock_date >= DATE '2001-06-15'""",
)
def inventory_snapshot(w: Warehouse):
    """The second load sets stock and date of known rows but never their warehouse."""
    first = transforms.dim_inventory(w.empty("dim_inventory"), earlier_stock(w), ts(retail.FIRST_LOAD))
    return transforms.dim_inventory(first, moved_stock(w), ts(retail.SECOND_LOAD))


DATE_COLUMNS = (
    "date_key, full_date, day_of_week, day_name, day_of_month, day_of_year, week_of_year, month_number, month_name, "
    "quarter, year, is_weekend"
)


@query(
    "dim_date",
    """
    WITH days AS (SELECT full_date AS d FROM d_date UNION SELECT CAST(o_orderdate AS DATE) FROM orders)
    SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS full_date,
           CAST(dayofweek(d) AS INTEGER) AS day_of_week, rpad(strftime(d, '%A'), 9, ' ') AS day_name,
           CAST(day(d) AS INTEGER) AS day_of_month, CAST(dayofyear(d) AS INTEGER) AS day_of_year,
           CAST(weekofyear(d) AS INTEGER) AS week_of_year, CAST(month(d) AS INTEGER) AS month_number,
           rpad(strftime(d, '%B'), 9, ' ') AS month_name, CAST(quarter(d) AS INTEGER) AS quarter,
           CAST(year(d) AS INTEGER) AS year, dayofweek(d) IN (0, 6) AS is_weekend
    FROM days""",
)
def date_dimension(w: Warehouse):
    """Days of the rolling window added to days already known: those with an order."""
    day = F.col("day")
    ordered = retail.read(w.spark, w.sf_dir, "orders").select(F.to_date("o_orderdate").alias("day")).distinct()
    known = ordered.select(*[c.alias(n) for n, c in calendar_columns(day).items()])
    return transforms.dim_date(known, w.as_of())


@query(
    "dim_surrogate_keys",
    """
    SELECT order_id, row_number() OVER (ORDER BY md5(order_id), order_id) AS sk FROM s_orders""",
)
def surrogate_keys(w: Warehouse):
    """Dense keys for the largest table there is, without a single-partition window."""
    return number_by_digest(w["stg_orders"].select("order_id"), "order_id", "sk")


@query(
    "fact_orders",
    f"""
    WITH earlier AS (SELECT * FROM s_orders WHERE _loaded_at < TIMESTAMP '2000-01-01'),
    kept AS (
        SELECT o.order_id, c.customer_sk, p.product_sk, CAST(strftime(order_timestamp, '%Y%m%d') AS INTEGER) AS date_key,
               order_timestamp, quantity, total_amount AS revenue,
               CAST(total_amount - coalesce(p.cost_price, 0) * quantity AS DECIMAL(12,2)) AS profit,
               order_status, payment_method
        FROM t_orders o LEFT JOIN d_customers_v1 c USING (customer_id) LEFT JOIN d_products_v1 p USING (product_id)
        WHERE order_id NOT IN (SELECT order_id FROM s_orders WHERE _loaded_at >= TIMESTAMP '2000-01-01')
          AND _loaded_at < TIMESTAMP '2000-01-01'
        QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY _loaded_at DESC, l_partkey DESC, l_suppkey DESC,
                                   l_extendedprice DESC) = 1)
    SELECT {FACT} FROM kept
    UNION ALL
    SELECT {FACT} FROM f_orders WHERE order_id IN (
        SELECT order_id FROM s_orders WHERE _loaded_at >= TIMESTAMP '2000-01-01')""",
)
def order_facts(w: Warehouse):
    """A second load on top of a first: staged orders are replaced, the others keep their old keys.

    The first load holds the lines shipped before 2000, bound to the dimension
    rows of that time. The second stages the rest, bound to the current rows.
    """
    cut = ts(retail.SECOND_LOAD)
    before = retail.latest_orders(w.spark, w.sf_dir, before=retail.SECOND_LOAD)
    after = w["stg_orders"].filter(F.col("_loaded_at") >= cut)
    first = transforms.order_rows(before, w["dim_customers_v1"], w["dim_products_v1"])
    return transforms.fact_orders(first, after, w["dim_customers"], w["dim_products"])


PAYMENT_CUT = "2000-01-01"


@query(
    "fact_payments",
    """
    SELECT payment_id, order_id, date_key, payment_date,
           CASE WHEN payment_date < TIMESTAMP '2000-01-01' THEN payment_method ELSE upper(payment_method) END
               AS payment_method,
           CAST(amount AS DOUBLE) AS amount, payment_status
    FROM f_payments""",
)
def payment_facts(w: Warehouse):
    """The second load sets status and amount of known payments and adds new ones.

    It spells payment methods differently, which must not reach known rows.
    """
    all_rows = w["stg_payments"]
    early = all_rows.filter(F.col("payment_date") < ts(PAYMENT_CUT)).withColumns(
        {"payment_status": F.lit("Pending"), "amount": F.lit(0).cast("decimal(12,2)")}
    )
    later = all_rows.withColumn("payment_method", F.upper("payment_method"))
    return transforms.fact_payments(transforms.payment_rows(early), later)


@query(
    "fact_returns",
    """
    SELECT return_id, order_id, date_key, return_date, CAST(refund_amount AS DOUBLE) AS refund_amount,
           CASE WHEN return_date < TIMESTAMP '2000-01-01' THEN return_reason ELSE upper(return_reason) END
               AS return_reason, return_status
    FROM f_returns""",
)
def return_facts(w: Warehouse):
    all_rows = w["stg_returns"]
    early = all_rows.filter(F.col("return_date") < ts(PAYMENT_CUT)).withColumns(
        {"return_status": F.lit("Pending"), "refund_amount": F.lit(0).cast("decimal(12,2)")}
    )
    later = all_rows.withColumn("return_reason", F.upper("return_reason"))
    return transforms.fact_returns(transforms.return_rows(early), later)


# The load clock of the daily aggregate: every revenue row is stamped with its
# day, so two hours before the first of July 2000 reopens the days since then.
AGG_AT = "2000-07-01 01:00:00"


def stale_aggregate(w: Warehouse):
    """Daily rows as an earlier run left them: every revenue day at zero."""
    zero = F.lit(0).cast("decimal(38,2)")
    return w["stg_revenue"].select(
        "record_date", zero.alias("total_revenue"), zero.alias("total_profit"), F.lit(0).alias("total_orders"),
        ts(retail.FIRST_LOAD).alias("updated_at"),
    )


def _aggregate_sql(times: str) -> str:
    return f"""
    SELECT r.record_date,
           CAST(CASE WHEN fresh THEN total_revenue * {times} ELSE 0 END AS DOUBLE) AS total_revenue,
           CAST(CASE WHEN fresh THEN total_profit * {times} ELSE 0 END AS DOUBLE) AS total_profit,
           CAST(CASE WHEN fresh THEN coalesce(n, 0) ELSE 0 END AS INTEGER) AS total_orders,
           CASE WHEN fresh THEN TIMESTAMP '{AGG_AT}' ELSE TIMESTAMP '1995-01-01' END AS updated_at
    FROM (SELECT *, _loaded_at >= TIMESTAMP '{AGG_AT}' - INTERVAL 2 HOUR AS fresh FROM t_revenue) r
    LEFT JOIN (SELECT CAST(order_timestamp AS DATE) AS record_date, count(DISTINCT order_id) AS n, count(*) AS c
               FROM s_orders WHERE order_status = 'Completed' GROUP BY 1) o ON o.record_date = r.record_date"""


@query("agg_revenue", _aggregate_sql("greatest(coalesce(c, 1), 1)"))
def daily_revenue(w: Warehouse):
    """Revenue counted once per completed order of its day, as a join before summing counts it."""
    return transforms.agg_revenue(stale_aggregate(w), w["stg_revenue"], w.rows("stg_orders"), ts(AGG_AT))


@query("agg_revenue_prejoin", _aggregate_sql("1"))
def daily_revenue_once(w: Warehouse):
    """Revenue counted once."""
    return transforms.agg_revenue(
        stale_aggregate(w), w["stg_revenue"], w.rows("stg_orders"), ts(AGG_AT), repeat_per_order=False
    )


@query(
    "agg_revenue_from_facts",
    """
    SELECT coalesce(r.record_date, f.d) AS record_date, CAST(coalesce(rev, 0) AS DOUBLE) AS total_revenue,
           CAST(coalesce(prof, 0) AS DOUBLE) AS total_profit, CAST(coalesce(n, 0) AS INTEGER) AS total_orders,
           CASE WHEN f.d IS NULL THEN TIMESTAMP '1995-01-01' ELSE TIMESTAMP '2000-01-01' END AS updated_at
    FROM t_revenue r FULL JOIN (
        SELECT CAST(order_timestamp AS DATE) AS d, sum(revenue) AS rev, sum(profit) AS prof,
               count(DISTINCT order_id) AS n
        FROM f_done GROUP BY 1) f ON f.d = r.record_date""",
)
def daily_revenue_from_facts(w: Warehouse):
    return transforms.agg_revenue_from_facts(stale_aggregate(w), w["fact_orders"], ts(retail.SECOND_LOAD))
