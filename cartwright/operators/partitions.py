"""Monthly partitions of the order facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .parted import Monthly, values

# How far the window of monthly partitions reaches around today.
MONTHS_BACK = 12
MONTHS_AHEAD = 24


def in_window(moment: Column, as_of: Column) -> Column:
    """Whether a moment falls into one of the monthly partitions; null does not."""
    first = F.trunc(F.add_months(as_of, -MONTHS_BACK), "month")
    end = F.add_months(F.trunc(F.add_months(as_of, MONTHS_AHEAD), "month"), 1)
    return F.coalesce((moment >= first) & (moment < end), F.lit(False))


def partition_name(moment: Column, as_of: Column, table: str = "fact_orders") -> Column:
    """The partition a row is routed to; everything outside the window shares the default one."""
    monthly = F.concat(F.lit(table + "_"), F.date_format(moment, "yyyy_MM"))
    return F.when(in_window(moment, as_of), monthly).otherwise(table + "_default")


def with_month(rows: DataFrame, moment: str = "order_timestamp") -> DataFrame:
    """Add the column a stored table is partitioned by.

    Storage uses the true month for every row, also outside the window, so old
    orders can still be pruned; the default partition is a question asked of
    the rows (``in_window``), not a folder all of them share.
    """
    return rows.withColumn("order_month", F.date_format(moment, "yyyy-MM"))


def write_months(rows: DataFrame, path: str, moment: str = "order_timestamp", indexed: bool = True) -> None:
    """Write a table by month; ``indexed`` lists the month of every order next to it, for later changes."""
    Monthly(rows.sparkSession, path).write(with_month(rows, moment), indexed)


def read_months(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A table stored by month, empty if nothing was written; month names are text."""
    table = Monthly(spark, path)
    if not table.exists():
        return spark.createDataFrame([], T.StructType([*schema, T.StructField("order_month", T.StringType())]))
    return table.read().select(*schema.names, "order_month")


def replace_rows(
    spark: SparkSession, path: str, rows: DataFrame, key: str = "order_id", moment: str = "order_timestamp"
) -> list[str]:
    """Replace rows of a table stored by month, rewriting only the months involved.

    A month is involved if it receives a row or if it now holds a row that is
    being replaced. ``rows`` are read several times, so pass a stored table.
    Returns the months; only their names reach the driver.
    """
    table = Monthly(spark, path, key)
    placed = with_month(rows, moment)
    if not table.exists():
        table.write(placed)
        return values(placed, "order_month")
    return table.replace(placed)


def exists(spark: SparkSession, path: str) -> bool:
    fs, folder = _fs(spark, path)
    return fs.exists(folder)


def _fs(spark: SparkSession, path: str):
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jpath
