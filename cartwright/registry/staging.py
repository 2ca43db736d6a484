"""Loading checked rows into staging tables that already hold an earlier load."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..catalog import ENTITIES
from ..plans import staging
from ..plans.warehouse import Warehouse, ts
from ..sources import retail
from .base import query
from .rows import raw, selected

LOADED = retail.SECOND_LOAD
LOADED_SQL = f"TIMESTAMP '{LOADED} 00:00:00'"

# What the table held before: rows of an earlier time, with other values in some
# columns. Entity: (condition, column, earlier value), the same in both dialects.
EARLIER = {
    "customers": ("signup_date < DATE '2000-06-01'", "country", "'ELSEWHERE'"),
    "products": ("inventory_quantity < 30", "product_name", "'unnamed'"),
    "orders": ("_loaded_at < TIMESTAMP '2000-01-01 00:00:00'", "order_status", "'Pending'"),
    "payments": ("payment_date < TIMESTAMP '2000-01-01 00:00:00'", "payment_status", "'Pending'"),
    "inventory": ("last_restock_date < DATE '2001-06-15'", "warehouse_location", "'Nowhere'"),
    "revenue": ("record_date < DATE '2000-01-01'", "total_revenue", "CAST(0 AS DECIMAL(15,2))"),
    "returns": ("return_date < TIMESTAMP '2000-01-01 00:00:00'", "return_status", "'Pending'"),
}
# Columns a known row keeps when it is loaded again.
KEPT = {"inventory": ("product_id", "warehouse_location"), "revenue": ("record_date",)}


def earlier(w: Warehouse, entity: str) -> DataFrame:
    condition, column, value = EARLIER[entity]
    table = w.rows(f"stg_{entity}").filter(condition)
    return table.withColumn(column, F.expr(value))


def _load(entity: str):
    def run(w: Warehouse) -> DataFrame:
        return staging.load(entity, earlier(w, entity), staging.check(entity, raw(w, entity)).newest_packed(ts(LOADED)))

    return run


def _load_sql(entity: str) -> str:
    condition, column, value = EARLIER[entity]
    key = ENTITIES[entity].key
    source = f"s_{entity}" if entity in ("orders", "returns") else f"t_{entity}"
    names = [key, *[c for c in ENTITIES[entity].columns if c != key]]
    old = ", ".join(f"{value} AS {c}" if c == column else c for c in names)
    merged = ", ".join(
        f"CASE WHEN n.{key} IS NULL OR (t.{key} IS NOT NULL AND {c in KEPT.get(entity, ())}) THEN t.{c} ELSE n.{c} END AS {c}"
        if c != key
        else f"coalesce(n.{key}, t.{key}) AS {key}"
        for c in names
    )
    return f"""
        WITH before AS (SELECT {old}, _loaded_at, _source_file FROM {source} WHERE {condition}),
        merged AS (
            SELECT {merged},
                   CASE WHEN n.{key} IS NULL THEN t._loaded_at ELSE {LOADED_SQL} END AS _loaded_at,
                   coalesce(n._source_file, t._source_file) AS _source_file
            FROM before t FULL JOIN new_{entity} n ON n.{key} = t.{key})
        SELECT {selected(entity)}, _loaded_at, _source_file FROM merged"""


for _entity in ENTITIES:
    query(f"stg_{_entity}", _load_sql(_entity))(_load(_entity))


@query(
    "stg_load_summary",
    " UNION ALL ".join(
        f"SELECT '{e}' AS entity, count(*) FILTER (WHERE reasons = '') AS loaded_rows, "
        f"count(*) FILTER (WHERE reasons <> '') AS quarantined_rows, "
        f"count(DISTINCT _source_file) AS files FROM grd_{e}"
        for e in ENTITIES
    ),
)
def load_summary(w: Warehouse):
    """Rows loaded and quarantined, and files, for each entity."""

    def count(entity: str) -> DataFrame:
        per_file = staging.V.summary(staging.check(entity, raw(w, entity)).annotated)
        return per_file.agg(
            F.sum("valid_rows").alias("loaded_rows"),
            F.sum("invalid_rows").alias("quarantined_rows"),
            F.count("*").alias("files"),
        ).select(F.lit(entity).alias("entity"), "loaded_rows", "quarantined_rows", "files")

    return reduce(DataFrame.unionByName, [count(e) for e in ENTITIES])
