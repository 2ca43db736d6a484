"""Reading: files, listings, series, row counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..catalog import ENTITIES
from ..operators import merge
from ..oracle.ctes import columns_of
from ..plans.warehouse import Warehouse, ts
from ..sources import files, retail, series
from .base import query

FOLDER_SQL = r"CAST(replace(regexp_extract(_source_file, '[0-9]{4}/[0-9]{2}/[0-9]{2}'), '/', '-') AS DATE)"


def each_entity(select: str, joiner: str = " UNION ALL ") -> str:
    return joiner.join(select.replace("$e", e) for e in ENTITIES)


@query("src_list_objects", each_entity(f"SELECT DISTINCT '$e' AS entity, {FOLDER_SQL} AS folder FROM raw_$e"))
def list_objects(w: Warehouse):
    """The folders of all files; file names carry a random part."""
    listing = files.list_objects(w.spark, w.landing())
    return listing.select("entity", files.folder_day(F.col("object_path")).alias("folder")).distinct()


@query("src_csv_all_string", f"SELECT {', '.join(columns_of('orders'))}, {FOLDER_SQL} AS folder FROM raw_orders")
def csv_all_string(w: Warehouse):
    """Raw orders written to CSV and read back: every column text, missing values null."""
    rows = files.read_raw(w.spark, w.landing(), "orders")
    return rows.select(*ENTITIES["orders"].columns, files.folder_day(F.col("_source_file")).alias("folder"))


@query(
    "src_discover_new_files",
    "SELECT * FROM ("
    + each_entity(f"SELECT DISTINCT '$e' AS entity, {FOLDER_SQL} AS folder FROM raw_$e")
    + ") WHERE folder >= DATE '2000-01-01'",
)
def discover_new_files(w: Warehouse):
    """Files not in a ledger that knows the files of before 2000."""
    listing = files.list_objects(w.spark, w.landing())
    day = files.folder_day(F.col("object_path"))
    ledger = listing.filter(day < F.lit(retail.SECOND_LOAD).cast("date"))
    return files.discover(listing, ledger).select("entity", day.alias("folder")).distinct()


@query("src_lineage", f"SELECT {FOLDER_SQL} AS folder, count(*) AS row_count FROM raw_orders GROUP BY 1")
def lineage(w: Warehouse):
    """Rows per source file's folder."""
    rows = files.read_raw(w.spark, w.landing(), "orders")
    return rows.groupBy(files.folder_day(F.col("_source_file")).alias("folder")).agg(F.count("*").alias("row_count"))


@query(
    "src_loaded_at",
    """
    SELECT customer_id, CASE WHEN customer_id IN (SELECT customer_id FROM s_changes) THEN TIMESTAMP '2000-01-01'
                             ELSE TIMESTAMP '1995-01-01' END AS _loaded_at
    FROM t_customers""",
)
def loaded_at(w: Warehouse):
    """The load time is one value per batch and is renewed when a row is updated."""
    first = w["stg_customers"].withColumn("_loaded_at", ts(retail.FIRST_LOAD))
    second = w["stg_customer_changes"].withColumn("_loaded_at", ts(retail.SECOND_LOAD))
    return merge.upsert(first, second, ["customer_id"]).select("customer_id", "_loaded_at")


@query(
    "src_series_date",
    """
    SELECT o_custkey, CAST(unnest(generate_series(date_trunc('month', min(o_orderdate)),
                                                  date_trunc('month', max(o_orderdate)), INTERVAL 1 MONTH)) AS DATE)
               AS month
    FROM orders GROUP BY o_custkey""",
)
def series_date(w: Warehouse):
    """Every month between each customer's first and last order."""
    spans = retail.read(w.spark, w.sf_dir, "orders").groupBy("o_custkey").agg(
        F.trunc(F.min("o_orderdate"), "month").alias("first"), F.trunc(F.max("o_orderdate"), "month").alias("last")
    )
    return series.every(spans, F.col("first"), F.col("last"), "1 month", "month").select("o_custkey", "month")


@query(
    "src_positional_extract",
    """
    SELECT 'orders' AS entity, trim(order_id) AS id, try_cast(total_amount AS DOUBLE) AS number FROM raw_orders
    WHERE try_cast(total_amount AS DOUBLE) IS NOT NULL
    UNION ALL
    SELECT 'products', trim(product_id), try_cast(selling_price AS DOUBLE) FROM raw_products
    WHERE try_cast(selling_price AS DOUBLE) IS NOT NULL
    UNION ALL
    SELECT 'customers', trim(customer_id), NULL FROM raw_customers""",
)
def positional_extract(w: Warehouse):
    """Identifiers and amounts taken from CSV lines by position; lines without a number are skipped."""

    def pairs(entity: str, at: int) -> DataFrame:
        lines = files.read_lines(w.spark, f"{w.landing()}/entity={entity}")
        found = files.positional(lines, 0, at)
        return found.select(F.lit(entity).alias("entity"), "id", F.col(f"number_{at}").alias("number"))

    ids = files.positional(files.read_lines(w.spark, f"{w.landing()}/entity=customers"), 0)
    customers = ids.select(F.lit("customers").alias("entity"), "id", F.lit(None).cast("double").alias("number"))
    return pairs("orders", 5).unionByName(pairs("products", 4)).unionByName(customers)


COUNTED = {
    "stg_customers": "t_customers", "stg_products": "t_products", "stg_orders": "s_orders",
    "stg_payments": "t_payments", "stg_inventory": "t_inventory", "stg_revenue": "t_revenue",
    "stg_returns": "s_returns", "dim_customers": "d_customers", "dim_products": "d_products",
    "dim_date": "d_date", "fact_orders": "f_orders", "fact_payments": "f_payments", "fact_returns": "f_returns",
}


@query(
    "src_row_counts",
    " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {c}" for t, c in COUNTED.items()),
)
def row_counts(w: Warehouse):
    parts = [w[t].agg(F.count("*").alias("row_count")).select(F.lit(t).alias("table_name"), "row_count") for t in COUNTED]
    return reduce(DataFrame.unionByName, parts).orderBy("table_name")
