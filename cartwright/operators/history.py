"""Type-2 dimension history: merging a batch in, and looking a moment up."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbering import number_by_digest
from .skew import hot_only, key_counts, mark_hot


def differs(left: Sequence[Column], right: Sequence[Column]) -> Column:
    """Null-safe: true when any pair of values is distinct."""
    return reduce(lambda a, b: a | b, [~l.eqNullSafe(r) for l, r in zip(left, right)])


def assign_keys(rows: DataFrame, key: str, surrogate: str, existing: DataFrame) -> DataFrame:
    """Number new rows upwards from the largest surrogate key in use."""
    last = existing.agg(F.coalesce(F.max(surrogate), F.lit(0)).alias("last")).scalar()
    return number_by_digest(rows, key, surrogate).withColumn(surrogate, F.col(surrogate) + last)


def merge_history(
    dim: DataFrame, staged: DataFrame, key: str, surrogate: str, tracked: Sequence[str], at: Column
) -> DataFrame:
    """The dimension after a batch of one row per key.

    A current row whose tracked columns differ is closed at ``at``; its key, and
    every key the dimension has never held, gets a new current row from the
    same instant. Untracked columns are written on insert only. Rows that were
    already closed pass through without taking part in any join, and a key that
    has only closed rows stays closed.
    """
    attributes = [c for c in staged.columns if c != key]
    closed = dim.filter(~F.col("is_current"))
    current = dim.filter("is_current")

    batch = staged.select(key, *[F.col(c).alias(f"_new_{c}") for c in tracked], F.lit(True).alias("_hit"))
    joined = current.join(batch, key, "left")
    change = F.coalesce(
        F.col("_hit") & differs([F.col(c) for c in tracked], [F.col(f"_new_{c}") for c in tracked]), F.lit(False)
    )
    kept = joined.select(
        *[
            F.when(change, at).alias(c) if c == "valid_to" else (~change).alias(c) if c == "is_current" else F.col(c)
            for c in dim.columns
        ]
    )

    state = F.max(F.when(F.col("is_current"), F.struct(*tracked))).alias("_state")
    known = dim.groupBy(key).agg(state, F.lit(True).alias("_known"))
    matched = staged.join(known, key, "left")
    reopened = F.col("_state").isNotNull() & differs(
        [F.col(c) for c in tracked], [F.col(f"_state.{c}") for c in tracked]
    )
    opened = (
        matched.filter(F.col("_known").isNull() | reopened)
        .select(key, *attributes)
        .withColumns(
            {
                "valid_from": at,
                "valid_to": F.lit(None).cast("timestamp"),
                "is_current": F.lit(True),
            }
        )
    )
    numbered = assign_keys(opened, key, surrogate, dim)
    return closed.unionByName(kept).unionByName(numbered.select(*dim.columns))


def current_rows(dim: DataFrame) -> DataFrame:
    return dim.filter("is_current")


def valid_at(moment: Column) -> Column:
    """Half-open validity: a row starts at its first instant and ends before its last."""
    return (F.col("valid_from") <= moment) & (F.col("valid_to").isNull() | (F.col("valid_to") > moment))


def _month_number(moment: Column) -> Column:
    return F.year(moment) * 12 + F.month(moment)


def join_as_of(facts: DataFrame, dim: DataFrame, key: str, moment: str, how: str = "left") -> DataFrame:
    """Join each fact to the dimension row valid at the fact's own time.

    The natural key is an equi-join key, so this is a hash or sort-merge join
    with the interval as a residual condition on the versions of one key. A key
    that holds a large part of all versions would compare each of its facts with
    each of them; for such keys the month joins the equi-join key: a version
    appears once per month it covers, a fact looks into its own month only.
    Months outside the dimension's own span count as the nearest one inside.
    """
    hot = hot_only(key_counts(dim, [key]))
    end = F.coalesce("valid_to", "valid_from")
    first = dim.agg(_month_number(F.min("valid_from")).alias("m")).scalar()
    last = dim.agg(_month_number(F.max(F.greatest("valid_from", end))).alias("m")).scalar()

    until = F.when(F.col("valid_to").isNull(), last).otherwise(_month_number(F.col("valid_to")))
    months = F.sequence(_month_number(F.col("valid_from")), F.greatest(until, _month_number(F.col("valid_from"))))
    versions = (
        mark_hot(dim, hot, [key])
        .withColumn("_slot", F.explode(F.when(F.col("_hot"), months).otherwise(F.array(F.lit(0)))))
        .drop("_hot")
        .withColumnRenamed(key, "_dim_key")
    )
    own = F.least(F.greatest(_month_number(F.col(moment)), first), last)
    looked_up = mark_hot(facts, hot, [key]).withColumn("_slot", F.when(F.col("_hot"), own).otherwise(0)).drop("_hot")

    f, d = looked_up.alias("f"), versions.alias("d")
    on = (
        (F.col(f"f.{key}") == F.col("d._dim_key"))
        & (F.col("f._slot") == F.col("d._slot"))
        & valid_at(F.col(f"f.{moment}"))
    )
    carried = [F.col(f"f.{c}") for c in facts.columns] + [F.col(f"d.{c}") for c in dim.columns if c != key]
    return f.join(d, on, how).select(*carried)
