"""Scalar functions, each over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.numbers import MONEY, growth_percent, line_profit, percent
from ..functions.text import hash_mod, name_uuid, pick, zero_padded
from ..functions.times import date_key, month_start, padded_name, quarter_start, sunday_based_weekday
from ..oracle.ctes import choose, h, uid
from ..plans.warehouse import Warehouse
from ..sources import retail
from .base import query


def orders(w: Warehouse):
    return retail.read(w.spark, w.sf_dir, "orders")


def lines(w: Warehouse):
    return retail.read(w.spark, w.sf_dir, "lineitem")


@query(
    "fn_f1",
    """
    SELECT o_orderkey, coalesce(nullif(o_orderstatus, 'F'), 'done') AS state, nullif(o_custkey, 0) AS customer
    FROM orders""",
)
def coalesce_nullif(w: Warehouse):
    return orders(w).select(
        "o_orderkey",
        F.coalesce(F.nullif(F.col("o_orderstatus"), F.lit("F")), F.lit("done")).alias("state"),
        F.nullif(F.col("o_custkey"), F.lit(0)).alias("customer"),
    )


@query(
    "fn_f2",
    """
    SELECT l_orderkey, l_linenumber, l_extendedprice,
           CAST(round(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(0.125 AS DECIMAL(4,3)), 2) AS DOUBLE) AS rounded
    FROM lineitem""",
)
def round_half_up(w: Warehouse):
    """Halves round away from zero, on exact decimals."""
    eighth = F.col("l_extendedprice").cast(MONEY) * F.lit("0.125").cast("decimal(4,3)")
    return lines(w).select("l_orderkey", "l_linenumber", "l_extendedprice", F.round(eighth, 2).alias("rounded"))


@query(
    "fn_f3",
    f"""
    SELECT o_orderkey, CASE WHEN {h("CAST(o_orderkey AS VARCHAR) || ':slot'", 64)} < 40 THEN 'low'
                            WHEN {h("CAST(o_orderkey AS VARCHAR) || ':slot'", 64)} < 60 THEN 'middle'
                            ELSE 'high' END AS band
    FROM orders""",
)
def weighted_case(w: Warehouse):
    slot = hash_mod(F.concat(F.col("o_orderkey").cast("string"), F.lit(":slot")), 64)
    return orders(w).select(
        "o_orderkey", F.when(slot < 40, "low").when(slot < 60, "middle").otherwise("high").alias("band")
    )


@query(
    "fn_f4",
    """
    SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, CAST(o_totalprice AS INTEGER) AS whole,
           CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) AS price,
           try_cast(o_orderpriority AS INTEGER) AS bad, try_cast(substr(o_orderpriority, 1, 1) AS INTEGER) AS priority
    FROM orders""",
)
def casts(w: Warehouse):
    return orders(w).select(
        "o_orderkey",
        F.to_date("o_orderdate").alias("day"),
        F.rint("o_totalprice").cast("int").alias("whole"),
        F.col("o_totalprice").cast(MONEY).cast("string").alias("price"),
        F.col("o_orderpriority").try_cast("int").alias("bad"),
        F.substring("o_orderpriority", 1, 1).try_cast("int").alias("priority"),
    )


@query("fn_f5", "SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_key FROM orders")
def date_keys(w: Warehouse):
    return orders(w).select("o_orderkey", date_key(F.col("o_orderdate")).alias("date_key"))


@query(
    "fn_f6",
    """
    SELECT o_orderkey, rpad(strftime(o_orderdate, '%A'), 9, ' ') AS padded_day, strftime(o_orderdate, '%A') AS day,
           rpad(strftime(o_orderdate, '%B'), 9, ' ') AS padded_month, strftime(o_orderdate, '%B') AS month
    FROM orders""",
)
def padded_names(w: Warehouse):
    d = F.col("o_orderdate")
    return orders(w).select(
        "o_orderkey",
        padded_name(d, "EEEE").alias("padded_day"),
        padded_name(d, "EEEE", pad=False).alias("day"),
        padded_name(d, "MMMM").alias("padded_month"),
        padded_name(d, "MMMM", pad=False).alias("month"),
    )


@query("fn_f7", "SELECT o_orderkey, strftime(o_orderdate, '%a') AS weekday FROM orders")
def short_weekday(w: Warehouse):
    return orders(w).select("o_orderkey", F.trim(F.date_format("o_orderdate", "E")).alias("weekday"))


@query("fn_f8", "SELECT o_orderkey, CAST(dayofweek(o_orderdate) AS INTEGER) AS weekday FROM orders")
def weekday_number(w: Warehouse):
    return orders(w).select("o_orderkey", sunday_based_weekday(F.col("o_orderdate")).alias("weekday"))


@query(
    "fn_f9",
    """
    SELECT o_orderkey, CAST(day(o_orderdate) AS INTEGER) AS d, CAST(dayofyear(o_orderdate) AS INTEGER) AS doy,
           CAST(weekofyear(o_orderdate) AS INTEGER) AS week, CAST(month(o_orderdate) AS INTEGER) AS m,
           CAST(quarter(o_orderdate) AS INTEGER) AS q, CAST(year(o_orderdate) AS INTEGER) AS y
    FROM orders""",
)
def date_parts(w: Warehouse):
    d = "o_orderdate"
    return orders(w).select(
        "o_orderkey", F.dayofmonth(d).alias("d"), F.dayofyear(d).alias("doy"), F.weekofyear(d).alias("week"),
        F.month(d).alias("m"), F.quarter(d).alias("q"), F.year(d).alias("y"),
    )


@query("fn_f10", "SELECT o_orderkey, dayofweek(o_orderdate) IN (0, 6) AS is_weekend FROM orders")
def weekend(w: Warehouse):
    return orders(w).select("o_orderkey", sunday_based_weekday(F.col("o_orderdate")).isin(0, 6).alias("is_weekend"))


@query(
    "fn_f11",
    """
    SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
           CAST(date_trunc('quarter', o_orderdate) AS DATE) AS quarter
    FROM orders""",
)
def truncation(w: Warehouse):
    d = F.col("o_orderdate")
    return orders(w).select("o_orderkey", month_start(d).alias("month"), quarter_start(d).alias("quarter"))


@query(
    "fn_f12",
    """
    SELECT o_orderkey, o_orderdate + INTERVAL 2 HOUR AS paid, o_orderdate + INTERVAL 7 DAY AS back,
           o_orderdate + to_seconds(o_custkey % 86400) AS placed, CAST(o_orderdate AS DATE) - 30 AS month_ago
    FROM orders""",
)
def intervals(w: Warehouse):
    placed = F.col("o_orderdate").cast("timestamp")
    seconds = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (F.col("o_custkey") % 86400).cast("decimal(18,6)"))
    return orders(w).select(
        "o_orderkey",
        (placed + F.expr("interval 2 hours")).alias("paid"),
        (placed + F.expr("interval 7 days")).alias("back"),
        (placed + seconds).alias("placed"),
        F.date_sub(F.to_date("o_orderdate"), 30).alias("month_ago"),
    )


@query(
    "fn_f13",
    """
    SELECT o_orderkey, date_diff('day', CAST(o_orderdate AS DATE),
                                 (SELECT CAST(max(o_orderdate) AS DATE) FROM orders)) AS age_days
    FROM orders""",
)
def clock(w: Warehouse):
    """Today is an input: here the last day with an order, as a one-row subquery."""
    today = w.as_of().scalar()
    age = F.datediff(today, F.to_date("o_orderdate")).cast("bigint")
    return orders(w).select("o_orderkey", age.alias("age_days"))


@query("fn_f14", f"SELECT c_custkey, {h('c_name', 365)} AS bucket FROM customer")
def hashing(w: Warehouse):
    c = retail.read(w.spark, w.sf_dir, "customer")
    return c.select("c_custkey", hash_mod(F.col("c_name"), 365).alias("bucket"))


@query("fn_f15", f"SELECT l_orderkey, l_linenumber, {uid('order', 'l_orderkey', 'l_linenumber')} AS id FROM lineitem")
def deterministic_ids(w: Warehouse):
    return lines(w).select(
        "l_orderkey", "l_linenumber", name_uuid("order", F.col("l_orderkey"), F.col("l_linenumber")).alias("id")
    )


@query(
    "fn_f16",
    f"""
    SELECT c_custkey, {choose(h('c_name', 4), ('north', 'east', 'south', 'west'))} AS region
    FROM customer""",
)
def array_choice(w: Warehouse):
    c = retail.read(w.spark, w.sf_dir, "customer")
    regions = ("north", "east", "south", "west")
    return c.select("c_custkey", pick(regions, hash_mod(F.col("c_name"), 4)).alias("region"))


@query(
    "fn_f17",
    """
    SELECT p_partkey, 'Product ' || CASE WHEN p_partkey < 1000 THEN lpad(CAST(p_partkey AS VARCHAR), 3, '0')
                                         ELSE CAST(p_partkey AS VARCHAR) END AS name,
           format('{} ({}, {})', p_name, p_brand, p_type) AS label
    FROM part""",
)
def text_building(w: Warehouse):
    p = retail.read(w.spark, w.sf_dir, "part")
    return p.select(
        "p_partkey",
        F.concat(F.lit("Product "), zero_padded(F.col("p_partkey"), 3)).alias("name"),
        F.format_string("%s (%s, %s)", "p_name", "p_brand", "p_type").alias("label"),
    )


@query(
    "fn_f18",
    """
    SELECT order_id, CAST(profit AS DOUBLE) AS profit, round(profit * 100.0 / nullif(revenue, 0), 2) AS margin_pct,
           round(CASE WHEN date_key % 100 = 0 THEN 0 ELSE (quantity - date_key % 100) * 100.0 / (date_key % 100) END, 2)
               AS growth_pct
    FROM f_orders""",
)
def arithmetic(w: Warehouse):
    """Profit, margin, and growth of the quantity over the day of the month."""
    cost = w["dim_products"].filter("is_current").select("product_id", "cost_price")
    o = w["stg_orders"].join(cost, "product_id", "left")
    profit = line_profit(F.col("total_amount"), F.col("cost_price"), F.col("quantity"))
    return o.select(
        "order_id",
        profit.cast(MONEY).alias("profit"),
        percent(profit.cast(MONEY), F.col("total_amount")).alias("margin_pct"),
        growth_percent(F.col("quantity"), F.dayofmonth("order_timestamp")).alias("growth_pct"),
    )
