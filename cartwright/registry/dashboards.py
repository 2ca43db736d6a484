"""The seven views and the 24 dashboard cards."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..oracle.ctes import AS_OF as SQL_AS_OF
from ..plans import views
from ..plans.cards import CARDS
from ..sources.retail import AS_OF
from .base import query


def as_of():
    return F.lit(AS_OF).cast("date")


def money(*names: str) -> str:
    return ", ".join(f"CAST({n} AS DOUBLE) AS {n}" for n in names)


VIEW_SQL = {
    "view_kpi_summary": (views.kpi_summary, "SELECT * FROM v_kpi"),
    "view_revenue_trend_daily": (
        views.revenue_trend_daily,
        f"SELECT date, year, month_number, month_name, {money('daily_revenue', 'daily_profit')}, daily_orders "
        "FROM v_trend ORDER BY date",
    ),
    "view_revenue_by_category": (
        views.revenue_by_category,
        f"SELECT category, {money('total_revenue', 'total_profit')}, total_orders, revenue_share_pct "
        "FROM v_category ORDER BY total_revenue DESC",
    ),
    "view_revenue_by_channel": (
        views.revenue_by_channel,
        f"SELECT acquisition_channel, {money('total_revenue')}, total_orders, unique_customers, revenue_share_pct "
        "FROM v_channel ORDER BY total_revenue DESC",
    ),
    "view_top_products_profit": (
        views.top_products_profit,
        f"SELECT product_name, category, {money('total_profit', 'total_revenue')}, units_sold FROM v_top",
    ),
    "view_customer_retention": (
        views.customer_retention,
        f"SELECT customer_segment, total_orders, unique_customers, {money('total_revenue')}, order_share_pct "
        "FROM v_retention ORDER BY total_orders DESC",
    ),
    "view_order_status": (
        views.order_status_distribution,
        f"SELECT order_status, order_count, {money('total_revenue')}, pct_of_total "
        "FROM v_status ORDER BY order_count DESC",
    ),
}


def _view(fn):
    return lambda w: fn(w, as_of())


for _name, (_fn, _sql) in VIEW_SQL.items():
    query(_name, _sql)(_view(_fn))


def trend(value: str, name: str) -> str:
    """A value per quarter with the previous one and the change in percent."""
    return f"""
        SELECT q AS quarter_start, v AS {name}, lag(v) OVER (ORDER BY q) AS previous,
               round((v - lag(v) OVER (ORDER BY q)) * 100.0 / nullif(lag(v) OVER (ORDER BY q), 0), 2) AS change_pct
        FROM (SELECT CAST(date_trunc('quarter', order_timestamp) AS DATE) AS q, {value} AS v FROM f_done GROUP BY 1)
        ORDER BY 1"""


CARD_SQL = {
    "total_revenue": "SELECT round(total_revenue, 2) AS total_revenue FROM v_kpi",
    "total_orders": "SELECT total_orders FROM v_kpi",
    "aov": "SELECT avg_order_value FROM v_kpi",
    "gross_profit": "SELECT round(total_profit, 2) AS gross_profit FROM v_kpi",
    "customer_growth": "SELECT customer_growth_rate_pct FROM v_kpi",
    "revenue_qoq": trend("CAST(sum(revenue) AS DOUBLE)", "revenue"),
    "orders_qoq": trend("count(DISTINCT order_id)", "total_orders"),
    "profit_qoq": trend("CAST(sum(profit) AS DOUBLE)", "gross_profit"),
    "revenue_trend": f"SELECT date, {money('daily_revenue')} FROM v_trend ORDER BY date",
    "revenue_category": f"SELECT category, {money('total_revenue')} FROM v_category ORDER BY total_revenue DESC",
    "revenue_channel":
        f"SELECT acquisition_channel, {money('total_revenue')} FROM v_channel ORDER BY total_revenue DESC",
    "top_products": f"SELECT product_name, category, {money('total_profit')}, units_sold FROM v_top",
    "retention": "SELECT customer_segment, total_orders FROM v_retention",
    "order_status": "SELECT order_status, order_count FROM v_status",
    "monthly_rev_profit": """
        SELECT CAST(date_trunc('month', date) AS DATE) AS month, CAST(sum(daily_revenue) AS DOUBLE) AS monthly_revenue,
               CAST(sum(daily_profit) AS DOUBLE) AS monthly_profit
        FROM v_trend GROUP BY 1 ORDER BY 1""",
    "margin_category": """
        SELECT category, round(total_profit * 100.0 / nullif(total_revenue, 0), 2) AS profit_margin_pct
        FROM v_category ORDER BY 2 DESC""",
    "payment_method": """
        SELECT payment_method, count(DISTINCT order_id) AS total_orders, CAST(sum(revenue) AS DOUBLE) AS total_revenue
        FROM f_done GROUP BY 1 ORDER BY 2 DESC""",
    "returns_status": "SELECT return_status, count(*) AS return_count FROM f_returns GROUP BY 1 ORDER BY 2 DESC",
    "mac": """
        SELECT CAST(date_trunc('month', order_timestamp) AS DATE) AS month,
               count(DISTINCT customer_sk) AS active_customers
        FROM f_done GROUP BY 1 ORDER BY 1""",
    "weekday": """
        SELECT strftime(order_timestamp, '%a') AS weekday, CAST(dayofweek(order_timestamp) AS INTEGER) AS weekday_order,
               count(DISTINCT order_id) AS total_orders, CAST(sum(revenue) AS DOUBLE) AS total_revenue
        FROM f_done GROUP BY 1, 2 ORDER BY 2""",
    "top_countries": """
        SELECT coalesce(country, 'Unknown') AS country, CAST(sum(revenue) AS DOUBLE) AS total_revenue,
               count(DISTINCT order_id) AS total_orders
        FROM f_done JOIN d_customers USING (customer_sk) GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""",
    "refund_trend": """
        SELECT CAST(date_trunc('month', return_date) AS DATE) AS month,
               CAST(sum(refund_amount) AS DOUBLE) AS total_refund_amount
        FROM f_returns GROUP BY 1 ORDER BY 1""",
    "repeat_rate": """
        SELECT round(count(*) FILTER (WHERE n > 1) * 100.0 / nullif(count(*), 0), 2) AS repeat_customer_rate_pct
        FROM (SELECT customer_sk, count(DISTINCT order_id) AS n FROM f_done GROUP BY customer_sk)""",
    "avg_items": """
        SELECT round(CAST(sum(quantity) AS DOUBLE) / nullif(count(DISTINCT order_id), 0), 2) AS avg_items_per_order
        FROM f_done""",
}


def _card(fn):
    return lambda w: fn(w, as_of(), None)


for _name, _sql in CARD_SQL.items():
    query(f"card_{_name}", _sql)(_card(CARDS[_name]))


@query(
    "flt_optional_range",
    f"""
    SELECT CASE WHEN order_timestamp >= {SQL_AS_OF} - 365 AND order_timestamp < {SQL_AS_OF} + 1 THEN 'range'
           END AS scope, payment_method, count(DISTINCT order_id) AS total_orders,
           CAST(sum(revenue) AS DOUBLE) AS total_revenue
    FROM f_done WHERE order_timestamp >= {SQL_AS_OF} - 365 AND order_timestamp < {SQL_AS_OF} + 1 GROUP BY 1, 2
    UNION ALL
    SELECT 'all', payment_method, count(DISTINCT order_id), CAST(sum(revenue) AS DOUBLE) FROM f_done GROUP BY 1, 2""",
)
def optional_range(w):
    """One card with the last year as its date range, and without a range."""
    ranged = CARDS["payment_method"](w, as_of(), ("2000-08-01", AS_OF))
    whole = CARDS["payment_method"](w, as_of(), None)
    return ranged.select(F.lit("range").alias("scope"), "*").unionByName(whole.select(F.lit("all").alias("scope"), "*"))
