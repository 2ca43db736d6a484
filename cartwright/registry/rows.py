"""Validation and cleaning of raw rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..catalog import ENTITIES
from ..functions.numbers import to_int, to_money
from ..functions.text import DECIMAL_PATTERN, INTEGER_PATTERN, UUID_PATTERN, strip, title_case
from ..functions.times import to_day, to_utc
from ..operators import validate as V
from ..operators.clean import clean
from ..oracle.ctes import UUID, columns_of, title
from ..plans.staging import check
from ..plans.warehouse import Warehouse
from ..sources import retail
from .base import query


def raw(w: Warehouse, entity: str) -> DataFrame:
    return retail.raw(w.spark, w.sf_dir, entity)


def reasons():
    return F.col(V.REASONS)


# --- single rules over raw orders ----------------------------------------------------------------


@query(
    "val_not_null",
    "SELECT _k, total_amount, total_amount IS NULL AS failed FROM raw_orders",
)
def not_null(w: Warehouse):
    df = raw(w, "orders")
    return df.select(F.col("_row._k").alias("_k"), "total_amount",
                     V.fails_not_null(F.col("total_amount")).alias("failed"))


@query(
    "val_uuid_regex",
    f"SELECT _k, order_id, order_id IS NOT NULL AND NOT regexp_matches(order_id, '{UUID}') AS failed FROM raw_orders",
)
def uuid_regex(w: Warehouse):
    df = raw(w, "orders")
    return df.select(F.col("_row._k").alias("_k"), "order_id",
                     V.fails_pattern(F.col("order_id"), UUID_PATTERN).alias("failed"))


@query(
    "val_numeric_regex",
    r"""
    SELECT _k, unit_price, quantity,
           unit_price IS NOT NULL AND NOT regexp_matches(unit_price, '^[0-9]+([.][0-9]+)?$') AS bad_price,
           quantity IS NOT NULL AND NOT regexp_matches(quantity, '^[0-9]+$') AS bad_quantity
    FROM raw_orders""",
)
def numeric_regex(w: Warehouse):
    df = raw(w, "orders")
    return df.select(
        F.col("_row._k").alias("_k"),
        "unit_price",
        "quantity",
        V.fails_pattern(F.col("unit_price"), DECIMAL_PATTERN).alias("bad_price"),
        V.fails_pattern(F.col("quantity"), INTEGER_PATTERN).alias("bad_quantity"),
    )


@query(
    "val_in_set",
    """
    SELECT _k, order_status,
           order_status IS NOT NULL AND order_status NOT IN ('Pending', 'Completed', 'Cancelled', 'Refunded') AS failed
    FROM raw_orders""",
)
def in_set(w: Warehouse):
    allowed = ENTITIES["orders"].allowed["order_status"]
    return raw(w, "orders").select(
        F.col("_row._k").alias("_k"), "order_status",
        V.fails_in_set(F.col("order_status"), allowed).alias("failed"),
    )


@query(
    "val_unique",
    """
    SELECT _k, _source_file, order_id,
           order_id IS NOT NULL AND count(*) OVER (PARTITION BY _source_file, order_id) > 1 AS failed
    FROM raw_orders""",
)
def unique(w: Warehouse):
    """Every occurrence of an identifier repeated within its file."""
    flagged = V.flag_repeated(raw(w, "orders"), "order_id", "failed")
    return flagged.select(F.col("_row._k").alias("_k"), "_source_file", "order_id", "failed")


# --- whole suites ----------------------------------------------------------------------------------


@query(
    "val_split",
    """
    SELECT 'valid' AS part, '' AS reasons, count(*) AS row_count FROM chk_orders WHERE reasons = ''
    UNION ALL
    SELECT 'invalid', reasons, count(*) FROM chk_orders WHERE reasons <> '' GROUP BY reasons""",
)
def split(w: Warehouse):
    """The two halves of the raw orders; together they are the input."""
    valid, invalid = V.validate("orders", raw(w, "orders"))
    counted = valid.agg(F.count("*").alias("row_count"))
    rejected = invalid.groupBy(reasons().alias("reasons")).agg(F.count("*").alias("row_count"))
    return counted.select(F.lit("valid").alias("part"), F.lit("").alias("reasons"), "row_count").unionByName(
        rejected.select(F.lit("invalid").alias("part"), "reasons", "row_count")
    )


def _suite(entity: str):
    key = ENTITIES[entity].key

    def run(w: Warehouse) -> DataFrame:
        marked = V.annotate(entity, raw(w, entity))
        return marked.select(F.col("_row._k").alias("_k"), key, "_source_file", reasons().alias("reasons"))

    return run


for _entity, _spec in ENTITIES.items():
    query(f"val_{_entity}", f"SELECT _k, {_spec.key}, _source_file, reasons FROM chk_{_entity}")(_suite(_entity))


@query(
    "val_summary",
    """
    SELECT _source_file, count(*) FILTER (WHERE reasons = '') AS valid_rows,
           count(*) FILTER (WHERE reasons <> '') AS invalid_rows,
           CAST(count(*) FILTER (WHERE reasons <> '') > 0 AS BIGINT) AS quarantined_files
    FROM chk_orders GROUP BY _source_file""",
)
def summary(w: Warehouse):
    return V.summary(V.annotate("orders", raw(w, "orders")))


# --- cleaning expressions ---------------------------------------------------------------------------


@query(
    "cln_strip",
    r"""
    SELECT _k, payment_method AS raw_value, regexp_replace(payment_method, '^\s+|\s+$', '', 'g') AS payment_method
    FROM raw_orders""",
)
def strip_query(w: Warehouse):
    df = raw(w, "orders")
    return df.select(F.col("_row._k").alias("_k"), F.col("payment_method").alias("raw_value"),
                     strip(F.col("payment_method")).alias("payment_method"))


@query(
    "cln_utc_ts",
    "SELECT _k, order_timestamp AS raw_value, try_cast(order_timestamp AS TIMESTAMP) AS order_timestamp FROM raw_orders",
)
def utc_query(w: Warehouse):
    df = raw(w, "orders")
    return df.select(F.col("_row._k").alias("_k"), F.col("order_timestamp").alias("raw_value"),
                     to_utc(F.col("order_timestamp")).alias("order_timestamp"))


@query(
    "cln_date",
    "SELECT _k, last_restock_date AS raw_value, try_cast(last_restock_date AS DATE) AS last_restock_date "
    "FROM raw_inventory",
)
def date_query(w: Warehouse):
    df = raw(w, "inventory")
    return df.select(F.col("_row._k").alias("_k"), F.col("last_restock_date").alias("raw_value"),
                     to_day(F.col("last_restock_date")).alias("last_restock_date"))


@query(
    "cln_numeric",
    "SELECT _k, unit_price AS raw_value, CAST(try_cast(unit_price AS DECIMAL(12,2)) AS DOUBLE) AS unit_price "
    "FROM raw_orders",
)
def numeric_query(w: Warehouse):
    df = raw(w, "orders")
    return df.select(F.col("_row._k").alias("_k"), F.col("unit_price").alias("raw_value"),
                     to_money(F.col("unit_price")).alias("unit_price"))


@query(
    "cln_int",
    "SELECT _k, quantity_on_hand AS raw_value, coalesce(try_cast(quantity_on_hand AS INTEGER), 0) AS quantity_on_hand "
    "FROM raw_inventory",
)
def int_query(w: Warehouse):
    df = raw(w, "inventory")
    return df.select(F.col("_row._k").alias("_k"), F.col("quantity_on_hand").alias("raw_value"),
                     to_int(F.col("quantity_on_hand")).alias("quantity_on_hand"))


@query("cln_upper", "SELECT p_partkey, upper(p_name) AS product_name FROM part")
def upper_query(w: Warehouse):
    return retail.read(w.spark, w.sf_dir, "part").select("p_partkey", F.upper("p_name").alias("product_name"))


@query(
    "cln_title",
    f"SELECT o_orderkey, {title('o_orderpriority')} AS priority, {title('c_name')} AS customer, "
    f"{title('c_mktsegment')} AS segment FROM orders JOIN customer ON o_custkey = c_custkey",
)
def title_query(w: Warehouse):
    o, c = (retail.read(w.spark, w.sf_dir, t) for t in ("orders", "customer"))
    return o.join(c, o.o_custkey == c.c_custkey).select(
        "o_orderkey",
        title_case(F.col("o_orderpriority")).alias("priority"),
        title_case(F.col("c_name")).alias("customer"),
        title_case(F.col("c_mktsegment")).alias("segment"),
    )


@query(
    "cln_null_safe",
    """
    SELECT _k, try_cast(record_date AS DATE) AS record_date,
           CAST(CASE WHEN isnan(x) THEN NULL ELSE x END AS DOUBLE) AS total_revenue
    FROM (SELECT *, coalesce(try_cast(total_revenue AS DOUBLE), 'nan'::DOUBLE) AS x FROM raw_revenue)""",
)
def null_safe_query(w: Warehouse):
    """Not-a-number becomes null before a load."""
    df = raw(w, "revenue")
    number = F.coalesce(F.col("total_revenue").try_cast("double"), F.lit(float("nan")))
    return df.select(
        F.col("_row._k").alias("_k"), to_day(F.col("record_date")).alias("record_date"),
        F.when(~F.isnan(number), number).alias("total_revenue"),
    )


# --- cleaning suites ----------------------------------------------------------------------------------

_MONEY = {c for s in ENTITIES.values() for c, kind in s.columns.items() if kind.endswith("money")}


def selected(entity: str) -> str:
    return ", ".join(f"CAST({c} AS DOUBLE) AS {c}" if c in _MONEY else c for c in columns_of(entity))


def _cleaner(entity: str):
    def run(w: Warehouse) -> DataFrame:
        accepted = check(entity, raw(w, entity)).accepted
        return accepted.select(F.col("_row._k").alias("_k"), *ENTITIES[entity].columns, "_source_file")

    return run


for _entity in ENTITIES:
    query(f"cln_{_entity}", f"SELECT _k, {selected(_entity)}, _source_file FROM cln_{_entity}")(_cleaner(_entity))


@query(
    "cln_summary",
    "SELECT _source_file, count(*) FILTER (WHERE reasons = '') AS cleaned_rows FROM chk_orders GROUP BY 1",
)
def clean_summary(w: Warehouse):
    """Cleaned rows per file, counted in the plan that cleans them."""
    marked = V.annotate("orders", raw(w, "orders"))
    rows = clean("orders", marked)
    return rows.groupBy("_source_file").agg(F.count_if(V.is_valid()).alias("cleaned_rows"))
