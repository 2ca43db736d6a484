"""Generated series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def integers(spark: SparkSession, n: int) -> DataFrame:
    """1..n, generated in parallel."""
    return spark.range(1, n + 1).withColumnRenamed("id", "i")


def every(df: DataFrame, first: Column, last: Column, step: str, out: str) -> DataFrame:
    """One row per step from ``first`` to ``last``, both included, per input row."""
    return df.withColumn(out, F.explode(F.sequence(first, last, F.expr(f"interval {step}"))))


def repeat_rows(df: DataFrame, times: str, out: str, block: int = 10_000) -> DataFrame:
    """Each row ``times`` times, numbered from 1 in ``out``.

    Long runs are cut into blocks which are dealt out to the tasks before they
    are expanded, so one row with a huge count is not expanded by one task.
    """
    starts = F.sequence(F.lit(0).cast("bigint"), F.col(times) - 1, F.lit(block).cast("bigint"))
    blocks = df.filter(F.col(times) > 0).withColumn("_start", F.explode(starts))
    spread = blocks.repartition(F.col("_start"), *[F.col(c) for c in df.columns])
    last = F.least(F.col("_start") + block, F.col(times))
    return spread.withColumn(out, F.explode(F.sequence(F.col("_start") + 1, last))).drop("_start")
