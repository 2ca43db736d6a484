"""Writing and table maintenance; each query reads back what it wrote."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..catalog import ENTITIES, LEDGER
from ..operators import partitions
from ..operators.store import Store
from ..plans import bootstrap, staging
from ..plans.warehouse import Warehouse, ts
from ..session import fresh_dir, together
from ..sources import files, retail, sinks
from .base import query
from .dashboards import as_of
from .rows import raw
from .sources import COUNTED, FOLDER_SQL, each_entity


@query(
    "sink_partitioned_csv",
    each_entity(f"SELECT '$e' AS entity, {FOLDER_SQL} AS folder, count(*) AS row_count FROM raw_$e GROUP BY 2"),
)
def partitioned_csv(w: Warehouse):
    """All raw entities written below dated folders, counted per folder from the files."""
    root = w.land(fresh_dir(w.spark, "sink"))

    def count(entity: str) -> DataFrame:
        rows = files.read_raw(w.spark, root, entity)
        per_folder = rows.groupBy(files.folder_day(F.col("_source_file")).alias("folder"))
        return per_folder.agg(F.count("*").alias("row_count")).select(F.lit(entity).alias("entity"), "folder", "row_count")

    return reduce(DataFrame.unionByName, [count(e) for e in ENTITIES])


@query(
    "sink_quarantine",
    """
    SELECT DATE '2001-08-01' AS folder, order_id, payment_method, quantity, _source_file, reasons AS _reasons
    FROM grd_orders WHERE reasons <> ''""",
)
def quarantine(w: Warehouse):
    """Rejected orders with their original text, in the folder of the day of rejection."""
    root = fresh_dir(w.spark, "quarantine")
    sinks.write_quarantine(staging.check("orders", raw(w, "orders")).rejected, root, "orders", ts(retail.AS_OF))
    schema = ", ".join(f"{c} string" for c in (*ENTITIES["orders"].columns, "_source_file", "_reasons"))
    back = w.spark.read.schema(schema).option("header", True).option("recursiveFileLookup", True).csv(root)
    return back.select(
        files.folder_day(F.col("_metadata.file_path")).alias("folder"), "order_id", "payment_method", "quantity",
        "_source_file", "_reasons",
    )


@query(
    "sink_ledger",
    """
    SELECT _source_file AS object_path,
           CASE WHEN _source_file < 'orders/2000' THEN 'archive' ELSE 'orders' END AS entity,
           TIMESTAMP '2000-01-01' AS processed_at, count(*) FILTER (WHERE reasons = '') AS row_count,
           CAST(0 AS BIGINT) AS quarantine_count,
           CASE WHEN count(*) FILTER (WHERE reasons = '') > 0 THEN 'success' ELSE 'empty' END AS status
    FROM grd_orders GROUP BY _source_file""",
)
def ledger(w: Warehouse):
    """Files processed twice: counts and time are renewed, the entity is not."""
    store = Store(w.spark, fresh_dir(w.spark, "ledger"))
    store.ensure("processed_files", LEDGER)
    rows = staging.ledger_rows(staging.check("orders", raw(w, "orders")), ts(retail.SECOND_LOAD))
    early = rows.filter("object_path < 'orders/2000'").withColumns(
        {"entity": F.lit("archive"), "row_count": F.lit(0).cast("bigint"), "processed_at": ts(retail.FIRST_LOAD)}
    )
    store.publish("processed_files", staging.write_ledger(store.read("processed_files"), early))
    return store.publish("processed_files", staging.write_ledger(store.read("processed_files"), rows))


ROUTED = """
    CASE WHEN order_timestamp >= TIMESTAMP '2000-08-01' AND order_timestamp < TIMESTAMP '2003-09-01'
         THEN 'fact_orders_' || strftime(order_timestamp, '%Y_%m') ELSE 'fact_orders_default' END"""


@query(
    "part_monthly_routing",
    f"SELECT {ROUTED} AS partition_name, count(*) AS row_count, CAST(sum(revenue) AS DOUBLE) AS revenue "
    "FROM f_orders GROUP BY 1",
)
def monthly_routing(w: Warehouse):
    routed = partitions.partition_name(F.col("order_timestamp"), as_of())
    return w["fact_orders"].groupBy(routed.alias("partition_name")).agg(
        F.count("*").alias("row_count"), F.sum("revenue").alias("revenue")
    )


@query("part_default_routing", f"SELECT order_id, order_timestamp FROM f_orders WHERE {ROUTED} = 'fact_orders_default'")
def default_routing(w: Warehouse):
    routed = partitions.partition_name(F.col("order_timestamp"), as_of())
    rows = w["fact_orders"].filter(routed == "fact_orders_default")
    return rows.select("order_id", "order_timestamp")


@query(
    "part_replace_months",
    """
    SELECT strftime(month, '%Y-%m') AS order_month, count(*) AS row_count, CAST(sum(revenue) AS DOUBLE) AS revenue
    FROM (SELECT CASE WHEN order_status = 'Cancelled' THEN order_timestamp + INTERVAL 400 DAY ELSE order_timestamp END
                     AS month, revenue FROM f_orders) GROUP BY 1""",
)
def replace_months(w: Warehouse):
    """Stored orders of which the cancelled ones move 400 days on, leaving their old month."""
    path = fresh_dir(w.spark, "facts")
    rows = w["fact_orders"].drop("order_month")
    partitions.write_months(rows, path)
    moved = rows.filter("order_status = 'Cancelled'").withColumn(
        "order_timestamp", F.col("order_timestamp") + F.expr("interval 400 days")
    )
    partitions.replace_rows(w.spark, path, moved)
    stored = partitions.read_months(w.spark, path, rows.schema)
    return stored.groupBy("order_month").agg(F.count("*").alias("row_count"), F.sum("revenue").alias("revenue"))


ENTITY_TABLES = {f"stg_{e}": COUNTED[f"stg_{e}"] for e in ENTITIES}


@query(
    "boot_schema",
    " UNION ALL ".join(
        [f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {c}" for t, c in ENTITY_TABLES.items()]
        + ["SELECT 'dim_date', count(*) FROM d_date"]
        + [
            f"SELECT '{t}', 0"
            for t in ("dim_customers", "dim_products", "dim_inventory", "fact_orders", "fact_payments",
                      "fact_returns", "agg_revenue", "processed_files")
        ]
    ),
)
def boot(w: Warehouse):
    """Tables created, twice, and the staging tables loaded into what was created."""
    store = Store(w.spark, fresh_dir(w.spark, "boot"))
    created = bootstrap.ensure_schema(store, w.as_of())
    if bootstrap.ensure_schema(store, w.as_of()):
        raise AssertionError("a second bootstrap created tables")
    together([lambda e=e: staging.load_into(store, e, w[f"stg_{e}"]) for e in ENTITIES])
    parts = [
        store.read(t).agg(F.count("*").alias("row_count")).select(F.lit(t).alias("table_name"), "row_count")
        for t in created
    ]
    return reduce(DataFrame.unionByName, parts)


STORED_VIEWS = {
    "kpi_summary": "v_kpi", "revenue_trend_daily": "v_trend", "revenue_by_category": "v_category",
    "revenue_by_channel": "v_channel", "top_products_profit": "v_top", "customer_retention": "v_retention",
    "order_status_distribution": "v_status",
}


def _view_counts(w: Warehouse, present: int) -> DataFrame:
    parts = [
        w.spark.table(f"v_{name}").agg(F.count("*").alias("row_count")).select(F.lit(name).alias("view"), "row_count")
        for name in STORED_VIEWS
    ]
    return reduce(DataFrame.unionByName, parts).withColumn("objects", F.lit(present))


def _view_counts_sql(present: int) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS view, count(*) AS row_count, {present} AS objects FROM {c}"
        for name, c in STORED_VIEWS.items()
    )


@query("mv_ensure", _view_counts_sql(13))
def ensure(w: Warehouse):
    """Views created where missing; the second call finds them all."""
    store = Store(w.spark, fresh_dir(w.spark, "views"))
    bootstrap.ensure_views(store, w, as_of())
    return _view_counts(w, bootstrap.ensure_views(store, w, as_of()))


@query(
    "mv_refresh",
    "SELECT category, CAST(total_revenue AS DOUBLE) AS total_revenue, total_orders, 6 AS refreshed FROM v_category",
)
def refresh(w: Warehouse):
    """A view stored from the first load only, then refreshed to the current facts."""
    store = Store(w.spark, fresh_dir(w.spark, "views"))
    first = {name: w[name] for name in ("dim_date", "dim_customers", "dim_products")}
    first["fact_orders"] = w["fact_orders"].filter("order_timestamp < DATE '2000-01-01'")
    bootstrap.ensure_views(store, first, as_of())
    refreshed = bootstrap.refresh_views(store, w, as_of())
    return store.read("mv_revenue_by_category").select(
        "category", "total_revenue", "total_orders", F.lit(refreshed).alias("refreshed")
    )
