"""Post-load checks, on facts that really have orphans and repeats.

Orphans arise from binding facts to dimension rows that are then purged (closed
versions) and from dates older than the rolling calendar.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..catalog import ENTITIES
from ..operators import quality
from ..operators.narrow import with_packed_ids, with_plain_ids
from ..operators.skew import lookup
from ..plans.warehouse import Warehouse
from .base import query
from .dashboards import as_of
from .sources import COUNTED


# Facts bound at order time, next to dimensions that kept only their current rows.
PURGED = {
    "fact_orders": lambda w: w["fact_orders_asof"].drop("order_month"),
    "fact_payments": lambda w: w["fact_payments"],
    "fact_returns": lambda w: w["fact_returns"],
    "dim_customers": lambda w: w["dim_customers"].filter("is_current"),
    "dim_products": lambda w: w["dim_products"].filter("is_current"),
    "dim_date": lambda w: w["dim_date"],
}


def purged(w: Warehouse) -> dict[str, DataFrame]:
    return {name: table(w) for name, table in PURGED.items()}


def read_once(w: Warehouse, fact: str) -> DataFrame:
    """A fact table of ``purged`` for one step that reads two columns of it once, so that no other has to move or be stored."""
    return w.rows("fact_orders_asof") if fact == "fact_orders" else w.rows(fact)


CUSTOMER_GONE = "customer_sk NOT IN (SELECT customer_sk FROM d_customers WHERE is_current)"
PRODUCT_GONE = "product_sk NOT IN (SELECT product_sk FROM d_products WHERE is_current)"
DATE_GONE = "date_key NOT IN (SELECT date_key FROM d_date)"


def _cleared(w: Warehouse, fact: str, column: str, dim: str, key: str) -> DataFrame:
    known = lookup(PURGED[dim](w).select(column))
    rows = read_once(w, fact).select(key, column)
    cleared = quality.clear_orphans(with_packed_ids(rows), column, known)
    return with_plain_ids(cleared, rows.schema)


@query(
    "qc_orphan_customer",
    f"SELECT order_id, CASE WHEN NOT ({CUSTOMER_GONE}) THEN customer_sk END AS customer_sk FROM f_orders_asof",
)
def orphan_customer(w: Warehouse):
    return _cleared(w, "fact_orders", "customer_sk", "dim_customers", "order_id")


@query(
    "qc_orphan_product",
    f"SELECT order_id, CASE WHEN NOT ({PRODUCT_GONE}) THEN product_sk END AS product_sk FROM f_orders_asof",
)
def orphan_product(w: Warehouse):
    return _cleared(w, "fact_orders", "product_sk", "dim_products", "order_id")


@query(
    "qc_orphan_order_date",
    f"SELECT order_id, CASE WHEN NOT ({DATE_GONE}) THEN date_key END AS date_key FROM f_orders_asof",
)
def orphan_order_date(w: Warehouse):
    return _cleared(w, "fact_orders", "date_key", "dim_date", "order_id")


@query(
    "qc_orphan_payment_date",
    f"SELECT payment_id, CASE WHEN NOT ({DATE_GONE}) THEN date_key END AS date_key FROM f_payments",
)
def orphan_payment_date(w: Warehouse):
    return _cleared(w, "fact_payments", "date_key", "dim_date", "payment_id")


@query(
    "qc_orphan_return_date",
    f"SELECT return_id, CASE WHEN NOT ({DATE_GONE}) THEN date_key END AS date_key FROM f_returns",
)
def orphan_return_date(w: Warehouse):
    return _cleared(w, "fact_returns", "date_key", "dim_date", "return_id")


@query(
    "qc_orphan_total",
    f"""
    SELECT CAST((SELECT count(*) FROM f_orders_asof WHERE {CUSTOMER_GONE})
              + (SELECT count(*) FROM f_orders_asof WHERE {PRODUCT_GONE})
              + (SELECT count(*) FROM f_orders_asof WHERE {DATE_GONE})
              + (SELECT count(*) FROM f_payments WHERE {DATE_GONE})
              + (SELECT count(*) FROM f_returns WHERE {DATE_GONE}) AS BIGINT) AS orphans_cleaned""",
)
def orphan_total(w: Warehouse):
    return quality.orphan_total(purged(w))


@query(
    "qc_fk_violations",
    f"""
    SELECT 'fact_payments.date_key' AS reference, count(*) AS violations FROM f_payments WHERE {DATE_GONE}
    UNION ALL
    SELECT 'fact_returns.date_key', count(*) FROM f_returns WHERE {DATE_GONE}""",
)
def fk_violations(w: Warehouse):
    return quality.constraint_violations(w)


@query(
    "qc_default_partition",
    """
    SELECT count(*) AS default_partition_rows FROM f_orders
    WHERE NOT (order_timestamp >= TIMESTAMP '2000-08-01' AND order_timestamp < TIMESTAMP '2003-09-01')""",
)
def default_partition(w: Warehouse):
    return quality.default_partition_rows(w["fact_orders"], as_of())


@query(
    "qc_one_current_row",
    """
    SELECT 'dim_customers' AS dim, count(*) AS natural_keys, count(*) FILTER (WHERE n > 1) AS violations
    FROM (SELECT customer_id, count(*) AS n FROM d_customers WHERE is_current GROUP BY 1)
    UNION ALL
    SELECT 'dim_products', count(*), count(*) FILTER (WHERE n > 1)
    FROM (SELECT product_id, count(*) AS n FROM d_products WHERE is_current GROUP BY 1)""",
)
def one_current_row(w: Warehouse):
    def check(dim: str, key: str) -> DataFrame:
        keys = w[dim].filter("is_current").agg(F.countDistinct(key).alias("natural_keys"))
        bad = quality.repeated_current_rows(w[dim], key).agg(F.count("*").alias("n")).scalar()
        return keys.select(F.lit(dim).alias("dim"), "natural_keys", bad.alias("violations"))

    return check("dim_customers", "customer_id").unionByName(check("dim_products", "product_id"))


def _repeats_sql(entity: str, key: str) -> str:
    return (
        f"SELECT '{entity}' AS entity, count(*) AS repeated_keys, CAST(coalesce(sum(n), 0) AS BIGINT) AS row_count "
        f"FROM (SELECT {key}, count(*) AS n FROM t_{entity} GROUP BY 1 HAVING count(*) > 1)"
    )


@query("qc_key_unique", " UNION ALL ".join(_repeats_sql(n, s.key) for n, s in ENTITIES.items()))
def key_unique(w: Warehouse):
    """Repeated keys among the rows that arrive for each entity."""

    def check(entity: str) -> DataFrame:
        repeats = quality.key_repeats(w.typed(entity), [ENTITIES[entity].key])
        return repeats.agg(
            F.count("*").alias("repeated_keys"), F.coalesce(F.sum("n"), F.lit(0)).alias("row_count")
        ).select(F.lit(entity).alias("entity"), "repeated_keys", "row_count")

    return reduce(DataFrame.unionByName, [check(e) for e in ENTITIES])


# Beside the keys of the stored tables three that do repeat: natural keys over all versions, and a part of a key.
CHECKED_KEYS = (
    *quality.STORED_KEYS, ("dim_customers", ("customer_id",)), ("dim_products", ("product_id",)),
    ("fact_orders", ("order_timestamp",)),
)


@query("qc_stored_key_unique", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{','.join(key)}' AS key, count(*) AS repeated_keys, "
    f"CAST(coalesce(sum(n), 0) AS BIGINT) AS row_count "
    f"FROM (SELECT count(*) AS n FROM {COUNTED[t]} GROUP BY {', '.join(key)} HAVING count(*) > 1)"
    for t, key in CHECKED_KEYS))
def stored_key_unique(w: Warehouse):
    """Repeated keys of the stored tables: none for those that identify a row."""
    return quality.stored_key_repeats(w, CHECKED_KEYS)
