"""Named subqueries the check queries are put together from.

``compose`` puts in front of a query the subqueries it names, and those they
name in turn. The rules are written out here again, in SQL, and are not read
from the package's own catalog, so that a wrong rule there shows as a mismatch.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

T1, T2 = "TIMESTAMP '1995-01-01'", "TIMESTAMP '2000-01-01'"
AS_OF = "DATE '2001-08-01'"
UUID = "^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"


def uid(prefix: str, *parts: str) -> str:
    named = " || '-' || ".join([f"'{prefix}'", *[f"CAST({p} AS VARCHAR)" for p in parts]])
    return rf"regexp_replace(md5({named}), '(.{{8}})(.{{4}})(.{{4}})(.{{4}})(.{{12}})', '\1-\2-\3-\4-\5')"


def file(entity: str, day: str) -> str:
    return (
        f"'{entity}/' || strftime({day}, '%Y/%m/%d') || '/{entity}_' || strftime({day}, '%Y%m%d') || '.csv'"
    )


def choose(index: str, values: tuple[str, ...]) -> str:
    return "CASE " + index + " " + " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values)) + " END"


def title(c: str) -> str:
    words = f"regexp_extract_all({c}, '[A-Za-z]+|[^A-Za-z]+')"
    return f"array_to_string(list_transform({words}, lambda w: upper(w[1]) || lower(w[2:])), '')"


def h(named: str, n: str | int) -> str:
    """The md5-based bucket of a name."""
    return f"(('0x' || substr(md5({named}), 1, 15))::BIGINT % {n})"


METHOD = (
    "CASE o_orderpriority WHEN '1-URGENT' THEN 'Credit Card' WHEN '2-HIGH' THEN 'PayPal' "
    "WHEN '3-MEDIUM' THEN 'Stripe' WHEN '4-NOT SPECIFIED' THEN 'Bank Transfer' WHEN '5-LOW' THEN 'Crypto' END"
)
WAREHOUSE = choose(
    "p_partkey % 10",
    ("New York, US", "Los Angeles, US", "London, UK", "Berlin, DE", "Paris, FR", "Toronto, CA", "Sydney, AU",
     "Tokyo, JP", "Mumbai, IN", "Sao Paulo, BR"),
)
SIGNUP = "(DATE '1999-01-01' + CAST(c_custkey * 37 % 940 AS INTEGER))"
RESTOCK = "(DATE '2001-05-01' + CAST(p_partkey % 90 AS INTEGER))"
PRICE = "CAST(p_retailprice AS DECIMAL(12,2))"
LATEST_LINE = "_loaded_at DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC"

CTES: dict[str, str] = {
    # --- the given tables as typed entities -------------------------------------------------
    "t_customers": f"""
        SELECT {uid('customer', 'c_custkey')} AS customer_id, {SIGNUP} AS signup_date, n_name AS country,
               {choose('c_custkey % 4', ('Organic', 'Facebook', 'Google', 'Email'))} AS acquisition_channel,
               CASE WHEN c_mktsegment IN ('BUILDING', 'AUTOMOBILE') THEN 'New'
                    WHEN c_mktsegment IN ('HOUSEHOLD', 'MACHINERY') THEN 'Returning'
                    WHEN c_mktsegment = 'FURNITURE' THEN 'VIP' END AS customer_segment,
               {T1} AS _loaded_at, {file('customers', f"date_trunc('month', {SIGNUP})")} AS _source_file,
               c_custkey AS _k
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "t_changes": f"""
        SELECT t.customer_id, t.signup_date, t.country,
               CASE event_type WHEN 'signup' THEN 'Organic' WHEN 'view' THEN 'Google' WHEN 'click' THEN 'Facebook'
                    WHEN 'purchase' THEN 'Email' WHEN 'error' THEN 'Organic' END AS acquisition_channel,
               CASE event_type WHEN 'signup' THEN 'New' WHEN 'view' THEN 'Returning' WHEN 'click' THEN 'Returning'
                    WHEN 'purchase' THEN 'VIP' WHEN 'error' THEN 'New' END AS customer_segment,
               ts AS _loaded_at, {file('customers', 'ts')} AS _source_file, event_id AS _k
        FROM events JOIN t_customers t ON t._k = user_id""",
    "t_products": f"""
        SELECT {uid('product', 'p_partkey')} AS product_id, p_name AS product_name, p_type AS category,
               CAST({PRICE} * CAST(0.70 AS DECIMAL(3,2)) AS DECIMAL(12,2)) AS cost_price, {PRICE} AS selling_price,
               p_size AS inventory_quantity, {T1} AS _loaded_at,
               'products/2001/08/01/products_' || regexp_replace(p_brand, '[^0-9]', '', 'g') || '.csv' AS _source_file,
               p_partkey AS _k
        FROM part""",
    "t_product_changes": f"""
        SELECT product_id, upper(product_name) AS product_name, category, cost_price,
               CASE WHEN inventory_quantity > 25
                    THEN CAST(selling_price * CAST(1.10 AS DECIMAL(3,2)) AS DECIMAL(12,2))
                    ELSE selling_price END AS selling_price,
               inventory_quantity, {T2} AS _loaded_at, _source_file, _k
        FROM t_products""",
    "t_orders": f"""
        SELECT {uid('order', 'l_orderkey', 'l_linenumber')} AS order_id, {uid('customer', 'o_custkey')} AS customer_id,
               {uid('product', 'l_partkey')} AS product_id, CAST(l_quantity AS INTEGER) AS quantity,
               CAST(CAST((2 * CAST(round(l_extendedprice * 100) AS BIGINT) + CAST(l_quantity AS BIGINT))
                         // (2 * CAST(l_quantity AS BIGINT)) AS DECIMAL(14,0)) * CAST(0.01 AS DECIMAL(3,2))
                    AS DECIMAL(12,2)) AS unit_price,
               CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(3,2)))
                    AS DECIMAL(12,2)) AS total_amount,
               o_orderdate AS order_timestamp, {METHOD} AS payment_method,
               CASE WHEN o_orderstatus = 'O' THEN 'Pending' WHEN o_orderstatus = 'P' THEN 'Cancelled'
                    WHEN l_returnflag = 'R' THEN 'Refunded' ELSE 'Completed' END AS order_status,
               l_shipdate AS _loaded_at, {file('orders', "date_trunc('month', l_shipdate)")} AS _source_file,
               l_orderkey * 8 + l_linenumber AS _k, l_partkey, l_suppkey, l_extendedprice
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "t_payments": f"""
        SELECT {uid('payment', 'o_orderkey')} AS payment_id, {uid('order', 'o_orderkey', '1')} AS order_id,
               o_orderdate + INTERVAL 2 HOUR AS payment_date, {METHOD} AS payment_method,
               CAST(o_totalprice AS DECIMAL(12,2)) AS amount,
               CASE WHEN o_orderkey % 20 < 17 THEN 'Successful' WHEN o_orderkey % 20 < 19 THEN 'Failed'
                    ELSE 'Pending' END AS payment_status,
               o_orderdate + INTERVAL 2 HOUR AS _loaded_at,
               {file('payments', "date_trunc('month', o_orderdate)")} AS _source_file, o_orderkey AS _k
        FROM orders""",
    "t_inventory": f"""
        SELECT {uid('inventory', 'p_partkey')} AS inventory_id, {uid('product', 'p_partkey')} AS product_id,
               {WAREHOUSE} AS warehouse_location, p_size * 100 AS quantity_on_hand, {RESTOCK} AS last_restock_date,
               CAST({RESTOCK} AS TIMESTAMP) AS _loaded_at, {file('inventory', RESTOCK)} AS _source_file,
               p_partkey AS _k
        FROM part""",
    "t_revenue": f"""
        SELECT {uid('revenue', 'd')} AS revenue_id, d AS record_date, CAST(s AS DECIMAL(15,2)) AS total_revenue,
               CAST(CAST(s AS DECIMAL(22,2)) * CAST(0.25 AS DECIMAL(3,2)) AS DECIMAL(15,2)) AS total_profit,
               CAST(d AS TIMESTAMP) AS _loaded_at, {file('revenue', "date_trunc('month', d)")} AS _source_file,
               date_diff('day', DATE '1995-01-01', d) AS _k
        FROM (SELECT CAST(o_orderdate AS DATE) AS d, sum(CAST(o_totalprice AS DECIMAL(12,2))) AS s
              FROM orders GROUP BY 1)""",
    "t_returns": f"""
        SELECT {uid('return', 'l_orderkey', 'l_linenumber')} AS return_id,
               {uid('order', 'l_orderkey', 'l_linenumber')} AS order_id, l_shipdate AS return_date,
               {choose('l_linenumber % 3', ('Defective', 'Wrong Item', 'Changed Mind'))} AS return_reason,
               CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(0.50 AS DECIMAL(3,2)) AS DECIMAL(12,2))
                   AS refund_amount,
               {choose('l_suppkey % 3', ('Processed', 'Pending', 'Rejected'))} AS return_status,
               l_shipdate AS _loaded_at, {file('returns', "date_trunc('month', l_shipdate)")} AS _source_file,
               l_orderkey * 8 + l_linenumber AS _k, l_partkey, l_suppkey, l_extendedprice
        FROM lineitem WHERE l_returnflag = 'R'""",
    # --- staging: the latest row per key ----------------------------------------------------
    "s_changes": """
        SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (
            PARTITION BY customer_id ORDER BY _loaded_at DESC, _k DESC) AS rn FROM t_changes) WHERE rn = 1""",
    "s_orders": f"""
        SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (
            PARTITION BY order_id ORDER BY {LATEST_LINE}) AS rn FROM t_orders) WHERE rn = 1""",
    "s_returns": f"""
        SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (
            PARTITION BY return_id ORDER BY {LATEST_LINE}) AS rn FROM t_returns) WHERE rn = 1""",
    # --- dimensions -------------------------------------------------------------------------
    "d_customers_v1": f"""
        SELECT row_number() OVER (ORDER BY md5(customer_id), customer_id) AS customer_sk, customer_id, signup_date,
               country, acquisition_channel, customer_segment, {T1} AS valid_from,
               CAST(NULL AS TIMESTAMP) AS valid_to, TRUE AS is_current
        FROM t_customers""",
    "x_customers": """
        SELECT s.* FROM s_changes s LEFT JOIN d_customers_v1 d ON d.customer_id = s.customer_id
        WHERE d.customer_id IS NULL OR d.country IS DISTINCT FROM s.country
           OR d.acquisition_channel IS DISTINCT FROM s.acquisition_channel
           OR d.customer_segment IS DISTINCT FROM s.customer_segment""",
    "d_customers": f"""
        SELECT customer_sk, customer_id, signup_date, country, acquisition_channel, customer_segment, valid_from,
               CASE WHEN customer_id IN (SELECT customer_id FROM x_customers) THEN {T2} END AS valid_to,
               customer_id NOT IN (SELECT customer_id FROM x_customers) AS is_current
        FROM d_customers_v1
        UNION ALL
        SELECT (SELECT max(customer_sk) FROM d_customers_v1)
                   + row_number() OVER (ORDER BY md5(customer_id), customer_id),
               customer_id, signup_date, country, acquisition_channel, customer_segment, {T2}, NULL, TRUE
        FROM x_customers""",
    "d_products_v1": f"""
        SELECT row_number() OVER (ORDER BY md5(product_id), product_id) AS product_sk, product_id, product_name,
               category, cost_price, selling_price, {T1} AS valid_from, CAST(NULL AS TIMESTAMP) AS valid_to,
               TRUE AS is_current
        FROM t_products""",
    "x_products": """
        SELECT s.* FROM t_product_changes s JOIN d_products_v1 d ON d.product_id = s.product_id
        WHERE d.cost_price IS DISTINCT FROM s.cost_price OR d.selling_price IS DISTINCT FROM s.selling_price
           OR d.category IS DISTINCT FROM s.category""",
    "d_products": f"""
        SELECT product_sk, product_id, product_name, category, cost_price, selling_price, valid_from,
               CASE WHEN product_id IN (SELECT product_id FROM x_products) THEN {T2} END AS valid_to,
               product_id NOT IN (SELECT product_id FROM x_products) AS is_current
        FROM d_products_v1
        UNION ALL
        SELECT (SELECT max(product_sk) FROM d_products_v1) + row_number() OVER (ORDER BY md5(product_id), product_id),
               product_id, product_name, category, cost_price, selling_price, {T2}, NULL, TRUE
        FROM x_products""",
    "d_date": """
        SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS full_date,
               CAST(dayofweek(d) AS INTEGER) AS day_of_week, strftime(d, '%A') AS day_name,
               CAST(day(d) AS INTEGER) AS day_of_month, CAST(dayofyear(d) AS INTEGER) AS day_of_year,
               CAST(weekofyear(d) AS INTEGER) AS week_of_year, CAST(month(d) AS INTEGER) AS month_number,
               strftime(d, '%B') AS month_name, CAST(quarter(d) AS INTEGER) AS quarter,
               CAST(year(d) AS INTEGER) AS year, dayofweek(d) IN (0, 6) AS is_weekend
        FROM (SELECT CAST(unnest(generate_series(
                  (SELECT CAST(max(o_orderdate) AS DATE) FROM orders) - INTERVAL 2 YEAR,
                  (SELECT CAST(max(o_orderdate) AS DATE) FROM orders) + INTERVAL 2 YEAR,
                  INTERVAL 1 DAY)) AS DATE) AS d)""",
    # --- facts ------------------------------------------------------------------------------
    "f_orders": """
        SELECT o.order_id, c.customer_sk, p.product_sk, CAST(strftime(order_timestamp, '%Y%m%d') AS INTEGER) AS date_key,
               order_timestamp, quantity, total_amount AS revenue,
               CAST(total_amount - coalesce(p.cost_price, 0) * quantity AS DECIMAL(12,2)) AS profit,
               order_status, payment_method
        FROM s_orders o LEFT JOIN d_customers c ON c.customer_id = o.customer_id AND c.is_current
                        LEFT JOIN d_products p ON p.product_id = o.product_id AND p.is_current""",
    "f_orders_asof": """
        SELECT o.order_id, c.customer_sk, p.product_sk, CAST(strftime(order_timestamp, '%Y%m%d') AS INTEGER) AS date_key,
               order_timestamp, quantity, total_amount AS revenue,
               CAST(total_amount - coalesce(p.cost_price, 0) * quantity AS DECIMAL(12,2)) AS profit,
               order_status, payment_method
        FROM s_orders o
        LEFT JOIN d_customers c ON c.customer_id = o.customer_id AND c.valid_from <= order_timestamp
                               AND (c.valid_to IS NULL OR c.valid_to > order_timestamp)
        LEFT JOIN d_products p ON p.product_id = o.product_id AND p.valid_from <= order_timestamp
                              AND (p.valid_to IS NULL OR p.valid_to > order_timestamp)""",
    "f_done": "SELECT * FROM f_orders WHERE order_status = 'Completed'",
    "f_payments": """
        SELECT payment_id, order_id, CAST(strftime(payment_date, '%Y%m%d') AS INTEGER) AS date_key, payment_date,
               payment_method, amount, payment_status
        FROM t_payments""",
    "f_returns": """
        SELECT return_id, order_id, CAST(strftime(return_date, '%Y%m%d') AS INTEGER) AS date_key, return_date,
               refund_amount, return_reason, return_status
        FROM s_returns""",
    # --- views ------------------------------------------------------------------------------
    "v_kpi": f"""
        SELECT CAST((SELECT sum(revenue) FROM f_done) AS DOUBLE) AS total_revenue,
               CAST((SELECT sum(profit) FROM f_done) AS DOUBLE) AS total_profit,
               (SELECT count(DISTINCT order_id) FROM f_done) AS total_orders,
               round((SELECT CAST(sum(revenue) AS DOUBLE) / count(DISTINCT order_id) FROM f_done), 2)
                   AS avg_order_value,
               round(CASE WHEN b = 0 THEN 0 ELSE (a - b) * 100.0 / b END, 2) AS customer_growth_rate_pct
        FROM (SELECT count(DISTINCT CASE WHEN signup_date >= {AS_OF} - 30 AND signup_date < {AS_OF}
                                         THEN customer_id END) AS a,
                     count(DISTINCT CASE WHEN signup_date >= {AS_OF} - 60 AND signup_date < {AS_OF} - 30
                                         THEN customer_id END) AS b
              FROM d_customers WHERE is_current)""",
    "v_trend": f"""
        SELECT full_date AS date, year, month_number, month_name, coalesce(sum(revenue), 0) AS daily_revenue,
               coalesce(sum(profit), 0) AS daily_profit, count(DISTINCT order_id) AS daily_orders
        FROM d_date LEFT JOIN f_orders ON f_orders.date_key = d_date.date_key AND order_status = 'Completed'
        WHERE full_date <= {AS_OF} GROUP BY ALL""",
    "v_category": """
        SELECT g.*, CASE WHEN whole <> 0 THEN round(total_revenue * 100.0 / whole, 2) END AS revenue_share_pct
        FROM (SELECT category, sum(revenue) AS total_revenue, sum(profit) AS total_profit,
                     count(DISTINCT order_id) AS total_orders
              FROM f_done, d_products WHERE f_done.product_sk = d_products.product_sk GROUP BY 1) g,
             (SELECT sum(revenue) AS whole FROM f_done WHERE product_sk IN (SELECT product_sk FROM d_products))""",
    "v_channel": """
        SELECT g.*, CASE WHEN whole <> 0 THEN round(total_revenue * 100.0 / whole, 2) END AS revenue_share_pct
        FROM (SELECT acquisition_channel, sum(revenue) AS total_revenue, count(DISTINCT order_id) AS total_orders,
                     count(DISTINCT f_done.customer_sk) AS unique_customers
              FROM f_done, d_customers WHERE f_done.customer_sk = d_customers.customer_sk GROUP BY 1) g,
             (SELECT sum(revenue) AS whole FROM f_done WHERE customer_sk IN (SELECT customer_sk FROM d_customers))""",
    "v_top": """
        SELECT product_name, category, sum(profit) AS total_profit, sum(revenue) AS total_revenue,
               CAST(sum(quantity) AS BIGINT) AS units_sold
        FROM f_done JOIN d_products USING (product_sk) GROUP BY product_name, category
        ORDER BY total_profit DESC, product_name, category LIMIT 10""",
    "v_retention": """
        SELECT g.*, CASE WHEN whole <> 0 THEN round(total_orders * 100.0 / whole, 2) END AS order_share_pct
        FROM (SELECT customer_segment, count(DISTINCT order_id) AS total_orders,
                     count(DISTINCT f_orders.customer_sk) AS unique_customers, sum(revenue) AS total_revenue
              FROM f_orders, d_customers WHERE f_orders.customer_sk = d_customers.customer_sk GROUP BY 1) g,
             (SELECT count(DISTINCT order_id) AS whole FROM f_orders
              WHERE customer_sk IN (SELECT customer_sk FROM d_customers))""",
    "v_status": """
        SELECT g.*, CASE WHEN whole <> 0 THEN round(order_count * 100.0 / whole, 2) END AS pct_of_total
        FROM (SELECT order_status, count(DISTINCT order_id) AS order_count, sum(revenue) AS total_revenue
              FROM f_orders GROUP BY 1) g,
             (SELECT count(DISTINCT order_id) AS whole FROM f_orders)""",
}

# --- raw rows with faults, checked and cleaned --------------------------------------------------

# Per entity its key and its other columns in order, each with the kind of its text and how it is cleaned.
_COLUMNS = {
    "customers": ("customer_id", [
        ("signup_date", "plain", "date"), ("country", "plain", "upper"), ("acquisition_channel", "plain", "title"),
        ("customer_segment", "plain", "title")]),
    "products": ("product_id", [
        ("product_name", "plain", "text"), ("category", "plain", "title"), ("cost_price", "plain", "money"),
        ("selling_price", "plain", "money"), ("inventory_quantity", "plain", "int")]),
    "orders": ("order_id", [
        ("customer_id", "plain", "text"), ("product_id", "plain", "text"), ("quantity", "plain", "int"),
        ("unit_price", "plain", "money"), ("total_amount", "plain", "money"), ("order_timestamp", "moment", "time"),
        ("payment_method", "plain", "text"), ("order_status", "plain", "title")]),
    "payments": ("payment_id", [
        ("order_id", "plain", "text"), ("payment_date", "moment", "time"), ("payment_method", "plain", "text"),
        ("amount", "plain", "money"), ("payment_status", "plain", "title")]),
    "inventory": ("inventory_id", [
        ("product_id", "plain", "text"), ("warehouse_location", "plain", "text"), ("quantity_on_hand", "plain", "int"),
        ("last_restock_date", "plain", "date")]),
    "revenue": ("revenue_id", [
        ("record_date", "plain", "date"), ("total_revenue", "plain", "daily"), ("total_profit", "plain", "daily")]),
    "returns": ("return_id", [
        ("order_id", "plain", "text"), ("return_date", "moment", "time"), ("return_reason", "plain", "title"),
        ("refund_amount", "plain", "money"), ("return_status", "plain", "title")]),
}

# Faults of the raw rows: in every row whose number a modulus divides, a column gets a bad value; the last one wins.
PADDED = "padded"
_FAULTS = {
    "customers": {
        "country": [(131, PADDED), (103, "NULL")], "acquisition_channel": [(107, "'Twitter'")],
        "signup_date": [(127, "'not-a-date'")]},
    "products": {
        "category": [(131, PADDED)], "selling_price": [(113, "'free'")], "cost_price": [(109, "'-1'")],
        "product_name": [(103, "NULL")]},
    "orders": {
        "payment_method": [(131, PADDED)], "order_timestamp": [(127, "'not-a-date'")], "unit_price": [(113, "'free'")],
        "quantity": [(97, "'99999999999'"), (109, "'-1'")], "order_status": [(107, "'InProgress'")],
        "total_amount": [(103, "NULL")]},
    "payments": {
        "payment_method": [(131, PADDED), (103, "NULL")], "payment_date": [(127, "'not-a-date'")],
        "amount": [(113, "'free'"), (109, "'-1'")], "payment_status": [(107, "'Twitter'")]},
    "inventory": {
        "warehouse_location": [(131, PADDED), (103, "NULL")], "last_restock_date": [(127, "'not-a-date'")],
        "quantity_on_hand": [(113, "'free'"), (109, "'-1'")]},
    "revenue": {
        "record_date": [(127, "'not-a-date'")], "total_revenue": [(113, "'free'"), (103, "NULL")],
        "total_profit": [(109, "'-1'")]},
    "returns": {
        "return_status": [(131, PADDED)], "return_date": [(127, "'not-a-date'")],
        "refund_amount": [(113, "'free'"), (109, "'-1'"), (103, "NULL")], "return_reason": [(107, "'Twitter'")]},
}


def _raw(entity: str) -> str:
    key, columns = _COLUMNS[entity]
    out = [f"CASE WHEN _k % 101 = 0 THEN 'not-a-uuid' ELSE {key} END AS {key}"]
    for name, kind, _ in columns:
        value = f"strftime({name}, '%Y-%m-%dT%H:%M:%SZ')" if kind == "moment" else f"CAST({name} AS VARCHAR)"
        for modulus, bad in _FAULTS[entity].get(name, []):
            bad = f"'  ' || {value} || ' '" if bad == PADDED else bad
            value = f"CASE WHEN _k % {modulus} = 0 THEN {bad} ELSE {value} END"
        out.append(f"{value} AS {name}")
    place = ", l_partkey, l_suppkey, l_extendedprice" if entity in ("orders", "returns") else ""
    return f"SELECT {', '.join(out)}, _loaded_at, _source_file, _k{place} FROM t_{entity}"


@dataclass(frozen=True)
class _Rules:
    """What the rows of an entity have to meet; every identifier is also unique."""

    required: tuple[str, ...]
    identifier: str
    decimals: tuple[str, ...] = ()
    integers: tuple[str, ...] = ()
    allowed: dict[str, tuple[str, ...]] = field(default_factory=dict)
    references: tuple[str, ...] = ()
    moments: tuple[str, ...] = ()


_RULES = {
    "customers": _Rules(
        ("customer_id", "signup_date", "country", "acquisition_channel", "customer_segment"), "customer_id",
        allowed={"acquisition_channel": ("Organic", "Facebook", "Google", "Email"),
                 "customer_segment": ("New", "Returning", "VIP")}),
    "products": _Rules(
        ("product_id", "product_name", "category", "cost_price", "selling_price", "inventory_quantity"), "product_id",
        decimals=("cost_price", "selling_price"), integers=("inventory_quantity",)),
    "orders": _Rules(
        ("order_id", "customer_id", "product_id", "quantity", "unit_price", "total_amount", "order_timestamp"), "order_id",
        decimals=("unit_price", "total_amount"), integers=("quantity",),
        allowed={"order_status": ("Pending", "Completed", "Cancelled", "Refunded")},
        references=("customer_id", "product_id"), moments=("order_timestamp",)),
    "payments": _Rules(
        ("payment_id", "order_id", "payment_date", "payment_method", "amount", "payment_status"), "payment_id",
        decimals=("amount",), allowed={"payment_status": ("Successful", "Failed", "Pending")}, references=("order_id",)),
    "inventory": _Rules(
        ("inventory_id", "product_id", "warehouse_location", "quantity_on_hand", "last_restock_date"), "inventory_id",
        integers=("quantity_on_hand",), references=("product_id",)),
    "revenue": _Rules(
        ("revenue_id", "record_date", "total_revenue", "total_profit"), "revenue_id",
        decimals=("total_revenue", "total_profit")),
    "returns": _Rules(
        ("return_id", "order_id", "return_date", "return_reason", "refund_amount", "return_status"), "return_id",
        decimals=("refund_amount",),
        allowed={"return_reason": ("Defective", "Wrong Item", "Changed Mind"),
                 "return_status": ("Processed", "Pending", "Rejected")},
        references=("order_id",)),
}


def _reasons(entity: str, guard: bool, scope: str = "_source_file") -> str:
    rules = _RULES[entity]
    found = {f"null:{c}": f"{c} IS NULL" for c in rules.required}
    found[f"uuid:{rules.identifier}"] = f"NOT regexp_matches({rules.identifier}, '{UUID}')"
    found[f"unique:{rules.identifier}"] = (
        f"{rules.identifier} IS NOT NULL AND count(*) OVER (PARTITION BY {scope}, {rules.identifier}) > 1")
    for c in rules.decimals:
        found[f"number:{c}"] = rf"NOT regexp_matches({c}, '^\d+(\.\d+)?$')"
    for c in rules.integers:
        found[f"number:{c}"] = rf"NOT regexp_matches({c}, '^\d+$')"
    for c, allowed in rules.allowed.items():
        found[f"enum:{c}"] = f"{c} NOT IN {allowed}"
    if guard:
        for c in rules.integers:
            found[f"overflow:{c}"] = f"coalesce(abs(try_cast(trim({c}) AS DOUBLE)) >= 2147483648, FALSE)"
        for c in rules.references:
            found[f"uuid:{c}"] = f"NOT regexp_matches({c}, '{UUID}')"
        for c in rules.moments:
            found[f"unparseable:{c}"] = f"{c} IS NOT NULL AND try_cast({c} AS TIMESTAMP) IS NULL"
    cases = ", ".join(f"CASE WHEN {found[n]} THEN '{n}' END" for n in sorted(found))
    return f"concat_ws('|', {cases})"


# column: how it is cleaned
_CLEAN = {
    "date": "try_cast({} AS DATE)",
    "time": "try_cast({} AS TIMESTAMP)",
    "money": "try_cast({} AS DECIMAL(12,2))",
    "daily": "try_cast({} AS DECIMAL(15,2))",
    "int": "coalesce(try_cast({} AS INTEGER), 0)",
    "upper": "upper({})",
    "title": title("{}"),
    "text": "{}",
}


def strip(c: str) -> str:
    return rf"regexp_replace({c}, '^\s+|\s+$', '', 'g')"


def columns_of(entity: str) -> list[str]:
    key, columns = _COLUMNS[entity]
    return [key, *[name for name, _, _ in columns]]


def _cleaned(entity: str) -> str:
    key, columns = _COLUMNS[entity]
    kinds = [(key, "text"), *[(name, clean) for name, _, clean in columns]]
    return ", ".join(f"{_CLEAN[kind].replace('{}', strip(name))} AS {name}" for name, kind in kinds)


for _e in _COLUMNS:
    _order = ", l_partkey DESC, l_suppkey DESC, l_extendedprice DESC" if _e in ("orders", "returns") else ""
    _key = _COLUMNS[_e][0]
    CTES[f"raw_{_e}"] = _raw(_e)
    CTES[f"chk_{_e}"] = f"SELECT *, {_reasons(_e, False)} AS reasons FROM raw_{_e}"
    CTES[f"grd_{_e}"] = f"SELECT *, {_reasons(_e, True)} AS reasons FROM raw_{_e}"
    CTES[f"cln_{_e}"] = (
        f"SELECT {_cleaned(_e)}, _loaded_at, _source_file, _k{_order.replace(' DESC', '')} "
        f"FROM grd_{_e} WHERE reasons = ''"
    )
    CTES[f"new_{_e}"] = (
        f"SELECT {', '.join(columns_of(_e))}, _source_file FROM (SELECT *, row_number() OVER (PARTITION BY {_key} "
        f"ORDER BY _source_file DESC, _loaded_at DESC{_order}, _k DESC) AS rn FROM cln_{_e}) WHERE rn = 1"
    )


def compose(body: str) -> str:
    """Prefix a query with the subqueries it names, in dependency order."""
    ordered: list[str] = []

    def visit(text: str) -> None:
        for name in re.findall(r"\b[a-z]+_[a-z0-9_]+\b", text):
            if name in CTES and name not in ordered:
                visit(CTES[name])
                if name not in ordered:
                    ordered.append(name)

    visit(body)
    if not ordered:
        return body
    lead = ", ".join(f"{name} AS ({CTES[name].strip()})" for name in ordered)
    if body.lstrip().upper().startswith("WITH "):
        return f"WITH {lead}, {body.lstrip()[5:]}"
    return f"WITH {lead} {body}"
