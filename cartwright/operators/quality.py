"""Checks and repairs after a load."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .narrow import with_packed_ids
from .partitions import in_window
from .validate import repeated

# fact table, its key column, the dimension it points to
REFERENCES = (
    ("fact_orders", "customer_sk", "dim_customers"),
    ("fact_orders", "product_sk", "dim_products"),
    ("fact_orders", "date_key", "dim_date"),
    ("fact_payments", "date_key", "dim_date"),
    ("fact_returns", "date_key", "dim_date"),
)
# The two that can be validated as constraints: fact_orders is partitioned.
CONSTRAINTS = REFERENCES[3:]


def orphans(fact: DataFrame, column: str, dim: DataFrame) -> DataFrame:
    """Rows whose reference is set but missing from the dimension."""
    return fact.filter(F.col(column).isNotNull()).join(dim.select(column), column, "left_anti")


def clear_orphans(fact: DataFrame, column: str, dim: DataFrame) -> DataFrame:
    """Set references that the dimension lacks to null.

    The dimension's key is unique, so the join keeps one row per fact.
    """
    known = dim.select(F.col(column).alias("_key"), F.lit(True).alias("_found"))
    joined = fact.join(known, fact[column] == F.col("_key"), "left")
    return joined.select(
        *[F.when(F.col("_found"), F.col(c)).alias(c) if c == column else F.col(c) for c in fact.columns]
    )


def clear_all_orphans(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    repaired = {name: tables[name] for name, _, _ in REFERENCES}
    for name, column, dim in REFERENCES:
        repaired[name] = clear_orphans(repaired[name], column, tables[dim])
    return repaired


def _per_reference(
    tables: Mapping[str, DataFrame], references: Sequence[tuple[str, str, str]], out: str
) -> DataFrame:
    """Orphans per reference.

    Facts are counted per key value before they meet the dimension, so a key
    that many rows share is one row in the join.
    """

    def count(fact: str, column: str, dim: str) -> DataFrame:
        keys = tables[fact].filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
        missing = keys.join(tables[dim].select(column), column, "left_anti")
        return missing.agg(F.coalesce(F.sum("n"), F.lit(0)).alias(out)).select(
            F.lit(f"{fact}.{column}").alias("reference"), out
        )

    return reduce(DataFrame.unionByName, [count(*r) for r in references])


def orphan_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    return _per_reference(tables, REFERENCES, "orphans")


def orphan_total(tables: Mapping[str, DataFrame]) -> DataFrame:
    return orphan_counts(tables).agg(F.sum("orphans").alias("orphans_cleaned"))


def constraint_violations(tables: Mapping[str, DataFrame]) -> DataFrame:
    return _per_reference(tables, CONSTRAINTS, "violations")


def default_partition_rows(fact: DataFrame, as_of: Column) -> DataFrame:
    """Orders outside the window of monthly partitions."""
    return fact.filter(~in_window(F.col("order_timestamp"), as_of)).agg(F.count("*").alias("default_partition_rows"))


def repeated_current_rows(dim: DataFrame, key: str) -> DataFrame:
    """Natural keys with more than one current row; empty when the dimension is sound."""
    return key_repeats(dim.filter("is_current"), [key])


def key_repeats(table: DataFrame, key: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with how often."""
    return table.groupBy(*key).agg(F.count("*").alias("n")).filter("n > 1")


# Stored tables and the columns that identify a row of theirs.
STORED_KEYS = (
    ("stg_customers", ("customer_id",)), ("stg_products", ("product_id",)), ("stg_orders", ("order_id",)),
    ("stg_payments", ("payment_id",)), ("stg_inventory", ("inventory_id",)), ("stg_revenue", ("revenue_id",)),
    ("stg_returns", ("return_id",)), ("dim_customers", ("customer_sk",)), ("dim_products", ("product_sk",)),
    ("dim_date", ("date_key",)), ("dim_date", ("full_date",)), ("fact_orders", ("order_id", "order_timestamp")),
    ("fact_payments", ("payment_id",)), ("fact_returns", ("return_id",)),
    # Valid from a moment on: a natural key repeats with every version, but never with the same start.
    ("dim_customers", ("customer_id", "valid_from")), ("dim_products", ("product_id", "valid_from")),
)


def stored_key_repeats(tables: Mapping[str, DataFrame], keys: Sequence[tuple[str, Sequence[str]]] = STORED_KEYS) -> DataFrame:
    """Per table and key: how many values occur more than once, and in how many rows.

    Of keys that identify a row only hashes are counted and moved; the others are counted themselves.
    """

    def count(table: str, key: Sequence[str]) -> DataFrame:
        repeats = repeated(with_packed_ids(tables[table].select(*key)), list(key))
        return repeats.agg(F.count("*").alias("repeated_keys"), F.coalesce(F.sum("_n"), F.lit(0)).alias("row_count")).select(
            F.lit(table).alias("table_name"), F.lit(",".join(key)).alias("key"), "repeated_keys", "row_count")

    return reduce(DataFrame.unionByName, [count(*k) for k in keys])
