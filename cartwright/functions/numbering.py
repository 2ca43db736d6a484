"""Dense numbering of many rows without a single-partition window.

Rows are cut into buckets that follow the wanted order, numbered inside their
bucket, and shifted by the rows in the buckets before. The bucket is a function
of the row alone, so re-running a lost task gives the same numbers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HEX_DIGITS = 4
BUCKETS = 16**HEX_DIGITS


def number_rows(df: DataFrame, bucket: Column, order: list[Column], out: str) -> DataFrame:
    """Number rows 1..n by ``order``.

    ``bucket`` must not decrease along the order and must take at most
    ``BUCKETS`` values; the table of bucket sizes then has a fixed bound, which
    is what allows broadcasting it and running one window over all of it.
    """
    placed = df.withColumn("_bucket", bucket)
    running = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy("_bucket")
        .agg(F.count("*").alias("_n"))
        .select("_bucket", F.coalesce(F.sum("_n").over(running), F.lit(0)).alias("_before"))
    )
    inside = Window.partitionBy("_bucket").orderBy(*order)
    return (
        placed.withColumn("_at", F.row_number().over(inside))
        .join(F.broadcast(starts), "_bucket")
        .withColumn(out, (F.col("_before") + F.col("_at")).cast("bigint"))
        .select(*df.columns, out)
    )


def number_by_digest(df: DataFrame, key: str, out: str) -> DataFrame:
    """Number rows by the md5 of a unique key: evenly filled buckets for any key."""
    digest = F.md5(F.col(key).cast("binary"))
    return number_rows(df, F.substring(digest, 1, HEX_DIGITS), [digest, F.col(key)], out)


def numbered_current(dim: DataFrame, surrogate: str) -> DataFrame:
    """The current rows of a dimension as (surrogate, rn), numbered 1..n."""
    return number_by_integer(dim.filter("is_current").select(surrogate), surrogate, "rn")


def number_by_integer(df: DataFrame, key: str, out: str) -> DataFrame:
    """Number rows by a unique non-negative integer, cut into equal value ranges.

    The largest key comes from a one-row subquery.
    """
    top = df.agg(F.coalesce(F.max(key), F.lit(0)).alias("top")).scalar()
    width = F.floor(top / F.lit(BUCKETS)) + 1
    return number_rows(df, F.floor(F.col(key) / width).cast("int"), [F.col(key)], out)
