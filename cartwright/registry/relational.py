"""Joins, aggregates, windows, sorts, set operations and filters, one query each."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numbering import number_by_integer, numbered_current
from ..functions.numbers import safe_ratio, sum_or_zero
from ..functions.text import hash_mod
from ..operators import history, merge
from ..operators.narrow import with_packed_ids, with_plain_ids
from ..oracle.ctes import AS_OF as SQL_AS_OF
from ..oracle.ctes import LATEST_LINE, h
from ..plans import transforms
from ..plans.cards import with_change
from ..plans.views import COMPLETED, over_groups
from ..plans.warehouse import Warehouse, ts
from ..sources import retail
from .base import query
from .dashboards import as_of, trend
from .star import AGG_AT

# --- table merges -------------------------------------------------------------------------------------


@query(
    "op_upsert",
    """
    SELECT t.customer_id, t.country AS country, coalesce(s.acquisition_channel, t.acquisition_channel)
           AS acquisition_channel, coalesce(s.customer_segment, t.customer_segment) AS customer_segment
    FROM t_customers t LEFT JOIN s_changes s USING (customer_id)
    UNION ALL
    SELECT customer_id, upper(country), acquisition_channel, customer_segment FROM s_changes
    WHERE customer_id NOT IN (SELECT customer_id FROM t_customers)""",
)
def upsert_query(w: Warehouse):
    """Changes overwrite channel and segment; the country of a known customer stays."""
    columns = ("customer_id", "country", "acquisition_channel", "customer_segment")
    target = w["stg_customers"].select(*columns)
    source = w["stg_customer_changes"].select(*columns).withColumn("country", F.upper("country"))
    return merge.upsert(target, source, ["customer_id"], ["acquisition_channel", "customer_segment"])


@query(
    "op_insert_ignore",
    """
    SELECT order_id, order_status, 'first' AS load FROM s_orders WHERE _loaded_at < TIMESTAMP '2000-01-01'
    UNION ALL
    SELECT order_id, order_status, 'second' FROM s_orders WHERE _loaded_at >= TIMESTAMP '2000-01-01'""",
)
def insert_ignore_query(w: Warehouse):
    """All orders offered to a table that holds those loaded before 2000."""
    rows = w["stg_orders"].select("order_id", "order_status", "_loaded_at")
    target = rows.filter(F.col("_loaded_at") < ts(retail.SECOND_LOAD)).select(
        "order_id", "order_status", F.lit("first").alias("load")
    )
    source = rows.select("order_id", "order_status", F.lit("second").alias("load"))
    return merge.insert_ignore(target, source, ["order_id"])


@query(
    "op_delete_insert",
    """
    SELECT record_date, CAST(total_revenue AS DOUBLE) AS total_revenue,
           CASE WHEN record_date IN (SELECT CAST(order_timestamp AS DATE) FROM s_orders
                                     WHERE order_status = 'Completed') THEN 'new' ELSE 'old' END AS load
    FROM t_revenue""",
)
def delete_insert_query(w: Warehouse):
    """Days with a completed order are deleted and inserted again."""
    old = w["stg_revenue"].select("record_date", "total_revenue", F.lit("old").alias("load"))
    days = w["stg_orders"].filter(COMPLETED).select(F.to_date("order_timestamp").alias("record_date")).distinct()
    new = old.join(days, "record_date", "left_semi").withColumn("load", F.lit("new"))
    return merge.delete_insert(old, new, ["record_date"], deleted=days)


@query(
    "op_update_from",
    """
    SELECT customer_sk, customer_id,
           CASE WHEN customer_id IN (SELECT customer_id FROM x_customers) THEN TIMESTAMP '2000-01-01' END AS valid_to,
           customer_id NOT IN (SELECT customer_id FROM x_customers) AS is_current
    FROM d_customers_v1""",
)
def update_from_query(w: Warehouse):
    """Close current rows whose tracked attributes differ from a change."""
    tracked = transforms.CUSTOMER_TRACKED
    changed = history.differs([F.col(c) for c in tracked], [F.col(f"s_{c}") for c in tracked])
    updated = merge.update_from(
        w["dim_customers_v1"],
        w["stg_customer_changes"].select("customer_id", *tracked),
        ["customer_id"],
        {"valid_to": ts(retail.SECOND_LOAD), "is_current": F.lit(False)},
        where=F.col("is_current") & changed,
    )
    return updated.select("customer_sk", "customer_id", "valid_to", "is_current")


# --- joins -----------------------------------------------------------------------------------------------


@query("join_left_current_dim", "SELECT order_id, customer_sk, product_sk FROM f_orders")
def left_current(w: Warehouse):
    rows = transforms.order_rows(w["stg_orders"], w["dim_customers"], w["dim_products"])
    return rows.select("order_id", "customer_sk", "product_sk")


@query(
    "join_inner_sk",
    "SELECT order_id, product_name, category, is_current FROM f_orders_asof JOIN d_products USING (product_sk)",
)
def inner_sk(w: Warehouse):
    dp = w["dim_products"].select("product_sk", "product_name", "category", "is_current")
    return w["fact_orders_asof"].join(dp, "product_sk").select("order_id", "product_name", "category", "is_current")


@query(
    "join_left_spine",
    """
    SELECT full_date, d_date.date_key, order_id FROM d_date
    LEFT JOIN f_orders ON f_orders.date_key = d_date.date_key AND order_status = 'Completed'""",
)
def left_spine(w: Warehouse):
    done = w["fact_orders"].filter(COMPLETED).select("date_key", "order_id")
    spine = w["dim_date"].select("full_date", "date_key")
    return merge.left_join_fanout(spine, done, ["date_key"]).select("full_date", "date_key", "order_id")


@query(
    "join_expr_date",
    """
    SELECT r.record_date, r.revenue_id, o.order_id FROM t_revenue r
    LEFT JOIN s_orders o ON CAST(o.order_timestamp AS DATE) = r.record_date AND o.order_status = 'Completed'""",
)
def expr_date(w: Warehouse):
    """Revenue rows meet every completed order of their day."""
    done = w["stg_orders"].filter(COMPLETED).select("order_id", F.to_date("order_timestamp").alias("record_date"))
    r = w["stg_revenue"].select("record_date", "revenue_id")
    return merge.left_join_fanout(r, done, ["record_date"]).select("record_date", "revenue_id", "order_id")


@query(
    "join_cross_scalar",
    """
    SELECT CAST((SELECT sum(revenue) FROM f_orders) AS DOUBLE) AS revenue,
           CAST((SELECT sum(amount) FROM f_payments) AS DOUBLE) AS paid,
           CAST((SELECT sum(refund_amount) FROM f_returns) AS DOUBLE) AS refunded""",
)
def cross_scalar(w: Warehouse):
    """One-row totals of three tables side by side, as subqueries of the first."""
    paid = w["fact_payments"].agg(F.sum("amount").alias("x")).scalar()
    refunded = w["fact_returns"].agg(F.sum("refund_amount").alias("x")).scalar()
    totals = w["fact_orders"].agg(F.sum("revenue").alias("revenue"))
    return totals.select("revenue", paid.alias("paid"), refunded.alias("refunded"))


@query(
    "join_cross_series",
    """
    SELECT d AS order_date, n, strftime(d, '%Y%m%d') || '-' || lpad(CAST(n AS VARCHAR), 3, '0') AS order_seed
    FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders), range(1, 25) r(n)""",
)
def cross_series(w: Warehouse):
    """24 numbered slots for each day that has an order; exploded, no product of two inputs."""
    days = retail.read(w.spark, w.sf_dir, "orders").select(F.to_date("o_orderdate").alias("order_date")).distinct()
    slots = days.withColumn("n", F.explode(F.sequence(F.lit(1).cast("bigint"), F.lit(24).cast("bigint"))))
    seed = F.concat_ws("-", F.date_format("order_date", "yyyyMMdd"), F.lpad(F.col("n").cast("string"), 3, "0"))
    return slots.withColumn("order_seed", seed)


@query(
    "join_hash_bucket",
    f"""
    WITH p AS (SELECT customer_sk, row_number() OVER (ORDER BY customer_sk) AS rn FROM d_customers WHERE is_current)
    SELECT order_id, p.customer_sk FROM s_orders
    JOIN p ON p.rn = 1 + {h('order_id', '(SELECT count(*) FROM p)')}""",
)
def hash_bucket(w: Warehouse):
    """Each order picks a current customer by the hash of its identifier."""
    people = numbered_current(w["dim_customers"], "customer_sk")
    size = people.agg(F.count("*").alias("n")).scalar()
    drawn = w["stg_orders"].select("order_id", (hash_mod(F.col("order_id"), size) + 1).alias("rn"))
    return drawn.join(people, "rn").select("order_id", "customer_sk")


@query(
    "join_semi_in",
    """
    SELECT order_id, order_status FROM f_orders WHERE order_id IN (SELECT order_id FROM f_returns)""",
)
def semi_in(w: Warehouse):
    returned = w["fact_returns"].select("order_id")
    return w["fact_orders"].join(returned, "order_id", "left_semi").select("order_id", "order_status")


@query(
    "join_anti_not_exists",
    """
    SELECT payment_id, order_id FROM f_payments p
    WHERE NOT EXISTS (SELECT 1 FROM f_orders o WHERE o.order_id = p.order_id)""",
)
def anti_not_exists(w: Warehouse):
    """Payments of orders that do not exist."""
    known = w["fact_orders"].select("order_id")
    return w["fact_payments"].join(known, "order_id", "left_anti").select("payment_id", "order_id")


@query(
    "join_semi_or_anti",
    """
    SELECT payment_id, order_id FROM f_payments p
    WHERE NOT EXISTS (SELECT 1 FROM f_orders o WHERE o.order_id = p.order_id)
       OR p.order_id IN (SELECT order_id FROM f_returns)""",
)
def semi_or_anti(w: Warehouse):
    """A disjunction of the two, as flags from left joins against distinct keys."""
    payments = w["fact_payments"].select("payment_id", "order_id")
    placed = with_packed_ids(w["fact_orders"].select("order_id")).distinct().withColumn("placed", F.lit(True))
    back = with_packed_ids(w["fact_returns"].select("order_id")).distinct().withColumn("back", F.lit(True))
    joined = with_packed_ids(payments).join(placed, "order_id", "left").join(back, "order_id", "left")
    found = joined.filter(F.col("placed").isNull() | F.col("back")).select("payment_id", "order_id")
    return with_plain_ids(found, payments.schema)


@query(
    "join_scd2_asof",
    """
    SELECT order_id, c.customer_sk, c.customer_segment, c.valid_from
    FROM s_orders o LEFT JOIN d_customers c
      ON c.customer_id = o.customer_id AND c.valid_from <= o.order_timestamp
     AND (c.valid_to > o.order_timestamp OR c.valid_to IS NULL)""",
)
def scd2_asof(w: Warehouse):
    orders = w["stg_orders"].select("order_id", "customer_id", "order_timestamp")
    joined = history.join_as_of(orders, w["dim_customers"], "customer_id", "order_timestamp")
    return joined.select("order_id", "customer_sk", "customer_segment", "valid_from")


# --- aggregates -----------------------------------------------------------------------------------------------


@query(
    "agg_sum_coalesce",
    """
    SELECT coalesce(CAST(sum(revenue) AS DOUBLE), 0) AS total_revenue,
           coalesce(CAST(sum(CASE WHEN order_status = 'Lost' THEN revenue END) AS DOUBLE), 0) AS lost_revenue
    FROM f_orders""",
)
def sum_coalesce(w: Warehouse):
    """A sum without any contributing row is zero, not null."""
    lost = F.when(F.col("order_status") == "Lost", F.col("revenue"))
    return w["fact_orders"].agg(
        sum_or_zero(F.col("revenue")).alias("total_revenue"), sum_or_zero(lost).alias("lost_revenue")
    )


@query(
    "agg_count_distinct",
    """
    SELECT payment_method, count(DISTINCT customer_sk) AS customers FROM f_orders GROUP BY 1
    UNION ALL SELECT 'any', count(DISTINCT customer_sk) FROM f_orders""",
)
def count_distinct(w: Warehouse):
    fo = w["fact_orders"]
    per = fo.groupBy("payment_method").agg(F.countDistinct("customer_sk").alias("customers"))
    every_method = fo.agg(F.countDistinct("customer_sk").alias("customers"))
    return per.unionByName(every_method.select(F.lit("any").alias("payment_method"), "customers"))


@query("agg_count", "SELECT count(*) AS n, count(customer_sk) AS with_customer FROM f_orders")
def count_rows(w: Warehouse):
    return w["fact_orders"].agg(F.count("*").alias("n"), F.count("customer_sk").alias("with_customer"))


@query(
    "agg_filter",
    """
    SELECT count(*) AS all_orders, count(*) FILTER (WHERE quantity > 25) AS large_orders,
           CAST(sum(revenue) FILTER (WHERE order_status = 'Refunded') AS DOUBLE) AS refunded_revenue
    FROM f_orders""",
)
def filtered(w: Warehouse):
    refunded = F.when(F.col("order_status") == "Refunded", F.col("revenue"))
    return w["fact_orders"].agg(
        F.count("*").alias("all_orders"),
        F.count_if(F.col("quantity") > 25).alias("large_orders"),
        F.sum(refunded).alias("refunded_revenue"),
    )


@query(
    "agg_group_by",
    """
    SELECT order_status, payment_method, count(*) AS n, CAST(sum(revenue) AS DOUBLE) AS revenue,
           min(quantity) AS smallest, max(quantity) AS largest
    FROM f_orders GROUP BY 1, 2""",
)
def group_by(w: Warehouse):
    return w["fact_orders"].groupBy("order_status", "payment_method").agg(
        F.count("*").alias("n"), F.sum("revenue").alias("revenue"), F.min("quantity").alias("smallest"),
        F.max("quantity").alias("largest"),
    )


@query(
    "agg_group_expr",
    """
    SELECT CAST(date_trunc('quarter', order_timestamp) AS DATE) AS quarter_start, CAST(sum(profit) AS DOUBLE) AS profit
    FROM f_orders GROUP BY 1""",
)
def group_expr(w: Warehouse):
    quarter = F.date_trunc("quarter", "order_timestamp").cast("date")
    return w["fact_orders"].groupBy(quarter.alias("quarter_start")).agg(F.sum("profit").alias("profit"))


@query(
    "agg_safe_ratio",
    """
    SELECT order_status, round(CAST(sum(revenue) AS DOUBLE) / nullif(count(DISTINCT order_id), 0), 2) AS per_order,
           CAST(sum(revenue) AS DOUBLE) / nullif(count(*) FILTER (WHERE quantity < 0), 0) AS per_negative
    FROM f_orders GROUP BY 1""",
)
def safe_ratio_query(w: Warehouse):
    """A ratio over zero orders is null instead of an error."""
    sums = w["fact_orders"].groupBy("order_status").agg(
        F.sum("revenue").alias("r"),
        F.countDistinct("order_id").alias("n"),
        F.count_if(F.col("quantity") < 0).alias("z"),
    )
    return sums.select(
        "order_status",
        F.round(safe_ratio(F.col("r"), F.col("n")), 2).alias("per_order"),
        safe_ratio(F.col("r"), F.col("z")).cast("double").alias("per_negative"),
    )


@query(
    "agg_distinct_on",
    f"""
    SELECT order_id, _loaded_at, CAST(total_amount AS DOUBLE) AS total_amount FROM (
        SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY {LATEST_LINE}) AS rn FROM t_orders) WHERE rn = 1""",
)
def distinct_on(w: Warehouse):
    """The latest row of every order among all its lines."""
    latest = merge.latest_per_key(w.typed("orders"), ["order_id"], retail.LINE_ORDER)
    return latest.select("order_id", "_loaded_at", "total_amount")


@query("agg_distinct", "SELECT DISTINCT customer_id, payment_method FROM t_orders")
def distinct(w: Warehouse):
    return w.typed("orders").select("customer_id", "payment_method").distinct()


@query(
    "agg_two_level",
    """
    SELECT orders_placed, count(*) AS customers
    FROM (SELECT customer_sk, count(DISTINCT order_id) AS orders_placed FROM f_orders GROUP BY 1) GROUP BY 1""",
)
def two_level(w: Warehouse):
    per_customer = w["fact_orders"].groupBy("customer_sk").agg(F.countDistinct("order_id").alias("orders_placed"))
    return per_customer.groupBy("orders_placed").agg(F.count("*").alias("customers"))


# --- windows ----------------------------------------------------------------------------------------------------


@query(
    "win_share_sum",
    """
    SELECT payment_method, CAST(sum(revenue) AS DOUBLE) AS revenue,
           round(sum(revenue) * 100.0 / sum(sum(revenue)) OVER (), 2) AS share_pct
    FROM f_orders GROUP BY 1""",
)
def share_sum(w: Warehouse):
    groups = w["fact_orders"].groupBy("payment_method").agg(F.sum("revenue").alias("revenue"))
    share = F.round(F.col("revenue") * 100 / over_groups(F.sum("revenue")), 2)
    return groups.withColumn("share_pct", share)


@query(
    "win_share_count",
    """
    SELECT payment_method, count(DISTINCT customer_sk) AS customers,
           round(count(DISTINCT customer_sk) * 100.0 / sum(count(DISTINCT customer_sk)) OVER (), 2) AS share_pct
    FROM f_orders GROUP BY 1""",
)
def share_count(w: Warehouse):
    groups = w["fact_orders"].groupBy("payment_method").agg(F.countDistinct("customer_sk").alias("customers"))
    counted = F.col("customers").cast("decimal(20,0)")
    return groups.withColumn("share_pct", F.round(counted * 100 / over_groups(F.sum("customers")), 2))


@query(
    "win_row_number",
    """
    SELECT customer_sk, row_number() OVER (ORDER BY customer_sk) AS rn FROM d_customers WHERE is_current""",
)
def row_number(w: Warehouse):
    """Dense numbers for the current rows, in parallel although the order is global."""
    current = w["dim_customers"].filter("is_current").select("customer_sk")
    return number_by_integer(current, "customer_sk", "rn")


@query("win_total_count", "SELECT order_id, count(*) OVER () AS total FROM f_orders")
def total_count(w: Warehouse):
    """The table's size on every row, from a one-row subquery instead of a global window."""
    rows = w["fact_orders"].select("order_id")
    return rows.withColumn("total", rows.agg(F.count("*").alias("n")).scalar())


@query("win_qoq_change", trend("count(DISTINCT customer_sk)", "customers"))
def quarter_change(w: Warehouse):
    quarters = w["fact_orders"].filter(COMPLETED).groupBy(F.trunc("order_timestamp", "quarter").alias("quarter_start"))
    return with_change(quarters.agg(F.countDistinct("customer_sk").alias("customers")), "customers")


# --- sorting, top-k, sets ------------------------------------------------------------------------------------------


@query(
    "sort_nulls_first",
    "SELECT customer_sk, customer_id, valid_to FROM d_customers ORDER BY valid_to DESC NULLS FIRST, customer_sk",
)
def nulls_first(w: Warehouse):
    """Descending with nulls in front."""
    rows = w["dim_customers"].select("customer_sk", "customer_id", "valid_to")
    return rows.orderBy(F.col("valid_to").desc_nulls_first(), "customer_sk")


@query(
    "topk_limit",
    """
    SELECT order_id, CAST(profit AS DOUBLE) AS profit FROM f_orders ORDER BY f_orders.profit DESC, order_id LIMIT 10""",
)
def top_k(w: Warehouse):
    """The ten most profitable orders; each task keeps ten."""
    return w["fact_orders"].select("order_id", "profit").orderBy(F.col("profit").desc(), "order_id").limit(10)


@query(
    "sort_multi",
    """
    SELECT order_status, payment_method, order_id FROM f_orders ORDER BY order_status, payment_method DESC, order_id""",
)
def sort_multi(w: Warehouse):
    return w["fact_orders"].select("order_status", "payment_method", "order_id").orderBy(
        "order_status", F.col("payment_method").desc(), "order_id"
    )


def _counts(tables: dict[str, DataFrame]) -> DataFrame:
    parts = [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n") for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts).orderBy("name")


@query(
    "set_union_all",
    """
    SELECT * FROM (
        SELECT 'fact_orders' AS name, count(*) AS n FROM f_orders
        UNION ALL SELECT 'fact_payments', count(*) FROM f_payments
        UNION ALL SELECT 'fact_returns', count(*) FROM f_returns) ORDER BY name""",
)
def union_all(w: Warehouse):
    return _counts({name: w[name] for name in ("fact_orders", "fact_payments", "fact_returns")})


# --- filters ---------------------------------------------------------------------------------------------------------


@query("flt_equality", "SELECT order_id, product_sk FROM f_orders WHERE order_status = 'Completed'")
def equality(w: Warehouse):
    return w["fact_orders"].filter(COMPLETED).select("order_id", "product_sk")


@query(
    "flt_date_window",
    f"""
    SELECT customer_id, signup_date FROM d_customers
    WHERE is_current AND signup_date >= {SQL_AS_OF} - 30 AND signup_date < {SQL_AS_OF}""",
)
def date_window(w: Warehouse):
    recent = (F.col("signup_date") >= F.date_sub(as_of(), 30)) & (F.col("signup_date") < as_of())
    return w["dim_customers"].filter("is_current").filter(recent).select("customer_id", "signup_date")


@query(
    "flt_null_safe_neq",
    """
    WITH v AS (SELECT customer_id, customer_sk, nullif(country, 'CHINA') AS country, acquisition_channel, customer_segment
               FROM d_customers)
    SELECT a.customer_sk, b.customer_sk AS next_sk,
           a.country IS DISTINCT FROM b.country OR a.acquisition_channel IS DISTINCT FROM b.acquisition_channel
               OR a.customer_segment IS DISTINCT FROM b.customer_segment AS differ,
           a.country IS DISTINCT FROM b.country OR a.customer_segment IS DISTINCT FROM 'VIP' AS vip_differs
    FROM v a JOIN v b ON a.customer_id = b.customer_id AND a.customer_sk <= b.customer_sk""",
)
def null_safe_neq(w: Warehouse):
    """Every two versions of a customer, one with itself too: whether the tracked columns differ, nulls included."""
    tracked = ("country", "acquisition_channel", "customer_segment")
    dc = w["dim_customers"].select("customer_id", "customer_sk", *tracked).withColumn(
        "country", F.nullif(F.col("country"), F.lit("CHINA")))
    b = dc.select("customer_id", *[F.col(c).alias(f"next_{c}") for c in ("customer_sk", *tracked)])
    both = dc.join(b, "customer_id").filter("customer_sk <= next_customer_sk")
    differ = history.differs([F.col(c) for c in tracked], [F.col(f"next_{c}") for c in tracked])
    vip = history.differs([F.col("country"), F.col("customer_segment")], [F.col("next_country"), F.lit("VIP")])
    return both.select(
        "customer_sk", F.col("next_customer_sk").alias("next_sk"), differ.alias("differ"), vip.alias("vip_differs"))


@query(
    "flt_recent_load",
    f"""
    SELECT revenue_id, record_date FROM t_revenue
    WHERE _loaded_at >= TIMESTAMP '{AGG_AT}' - INTERVAL 2 HOUR""",
)
def recent_load(w: Warehouse):
    return transforms.recently_loaded(w["stg_revenue"], ts(AGG_AT)).select("revenue_id", "record_date")


SAMPLED, SAMPLED_OF = 3, 64


@query(
    "flt_hash_sample",
    f"""
    SELECT order_id, order_status FROM f_orders WHERE {h("'sample:' || order_id", SAMPLED_OF)} < {SAMPLED}""",
)
def hash_sample(w: Warehouse):
    """A repeatable sample: the hash of the identifier decides."""
    slot = hash_mod(F.concat(F.lit("sample:"), F.col("order_id")), SAMPLED_OF)
    return w["fact_orders"].filter(slot < SAMPLED).select("order_id", "order_status")
