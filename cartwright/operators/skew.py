"""Keys that hold a large part of a table.

Adaptive execution splits a skewed partition when both sides of a join are
plain shuffles. It cannot when one side is an aggregate on the join key, whose
partitioning the join takes over. The functions here serve those joins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A key is hot if it holds more than one part in this many of the rows. There
# can never be as many hot keys as this, whatever the size of the table, which
# is what allows broadcasting them.
PARTS = 1000
# Rows of a narrow lookup table that may be broadcast: an identifier and two numbers each, about 150 MB.
LOOKUP_ROWS = 1_500_000


def key_counts(df: DataFrame, by: Sequence[str], out: str = "_n") -> DataFrame:
    """Rows per key, combined on the map side."""
    return df.groupBy(*by).agg(F.count("*").alias(out))


def hot_only(counts: DataFrame, n: str = "_n") -> DataFrame:
    """The keys that hold more than one part in ``PARTS`` of all rows."""
    total = counts.agg(F.coalesce(F.sum(n), F.lit(0)).alias("total")).scalar()
    return counts.filter(F.col(n) * PARTS > total)


def mark_hot(df: DataFrame, hot: DataFrame, by: Sequence[str], flag: str = "_hot") -> DataFrame:
    """Flag the rows whose key is hot; the hot keys are few by definition."""
    known = F.broadcast(hot.select(*by, F.lit(True).alias(flag)))
    return df.join(known, list(by), "left").withColumn(flag, F.coalesce(flag, F.lit(False)))


def scattered(key: Column, apart: Column) -> Column:
    """The key, or for rows set ``apart`` a value that matches no key.

    The value follows the input partition, so these rows spread over all tasks
    of a join they take no part in, copies of one row included.
    """
    return F.when(apart, F.concat(F.lit("\u0000"), F.spark_partition_id().cast("string"))).otherwise(key)


def lookup(table: DataFrame) -> DataFrame:
    """A narrow table to look keys up in: broadcast while it has few rows, so that the wide side does not move.

    The optimizer's size check goes by the bytes of files and gives up far earlier. A larger
    table is returned as it is, and adaptive execution splits what is skewed.
    """
    return F.broadcast(table) if near(table) else table


def near(table: DataFrame) -> bool:
    """Whether :func:`lookup` broadcasts a table."""
    return table.count() <= LOOKUP_ROWS
