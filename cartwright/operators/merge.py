"""Merges on immutable tables: each returns the new content of the target.

Parquet tables have no MERGE, UPDATE or DELETE, so these are joins. They are
shaped so that a small batch can be broadcast by the optimizer (the batch is
always on the side that may be), leaving the large target unshuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], newest: Sequence[str]) -> DataFrame:
    """The row with the greatest ``newest`` values per key.

    An aggregate, not a row-number window: every task reduces its rows to one
    per key before the shuffle, so a hot key costs one row per task. Remaining
    ties fall to the other columns, which makes the choice deterministic.
    """
    rest = [c for c in df.columns if c not in keys and c not in newest]
    best = F.max(F.struct(*newest, *rest)).alias("_best")
    return df.groupBy(*keys).agg(best).select(
        *[F.col(c) if c in keys else F.col(f"_best.{c}").alias(c) for c in df.columns]
    )


def insert_ignore(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add the source rows whose key the target lacks."""
    fresh = source.join(target.select(*keys), list(keys), "left_anti")
    return target.unionByName(fresh)


def delete_insert(
    target: DataFrame, source: DataFrame, keys: Sequence[str], deleted: DataFrame | None = None
) -> DataFrame:
    """Drop the target rows whose key occurs in ``deleted`` (by default the source), add the source."""
    gone = (source if deleted is None else deleted).select(*keys)
    return target.join(gone, list(keys), "left_anti").unionByName(source)


def upsert(
    target: DataFrame, source: DataFrame, keys: Sequence[str], updated: Sequence[str] | None = None
) -> DataFrame:
    """Insert new keys; on known keys overwrite only the ``updated`` columns.

    Both sides hold one row per key. Overwriting every column is the same as
    replacing the row, which needs one join instead of two.
    """
    values = [c for c in target.columns if c not in keys]
    updated = values if updated is None else list(updated)
    if set(updated) >= set(values):
        return delete_insert(target, source, keys)
    batch = source.select(
        *keys, *[F.col(c).alias(f"_new_{c}") for c in updated], F.lit(True).alias("_hit")
    )
    kept = target.join(batch, list(keys), "left").select(
        *[
            F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in updated else F.col(c)
            for c in target.columns
        ]
    )
    return kept.unionByName(source.join(target.select(*keys), list(keys), "left_anti"))


def upsert_in_one_join(
    target: DataFrame, source: DataFrame, keys: Sequence[str], updated: Sequence[str] | None = None
) -> DataFrame:
    """The same rows as ``upsert``, for a source that is costly to compute: each side is read once.

    Neither side can be broadcast, but a source grouped by the keys lies as the join needs it and does not move again.
    """
    values = [c for c in target.columns if c not in keys]
    updated = values if updated is None else list(updated)
    old = target.select(*keys, *[F.col(c).alias(f"_old_{c}") for c in values], F.lit(True).alias("_held"))
    new = source.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in values], F.lit(True).alias("_hit"))

    def merged(c: str) -> Column:
        if c in keys:
            return F.col(c)
        first = F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(f"_old_{c}"))
        return (first if c in updated else F.when(F.col("_held"), F.col(f"_old_{c}")).otherwise(F.col(f"_new_{c}"))).alias(c)

    return old.join(new, list(keys), "full").select(*[merged(c) for c in target.columns])


def update_from(
    target: DataFrame, source: DataFrame, keys: Sequence[str], changes: dict[str, Column], where: Column | None = None
) -> DataFrame:
    """Set columns of the target rows that match a source row on the keys.

    ``changes`` and ``where`` may use the target's columns and, as ``s_<name>``,
    the source's. The source holds one row per key.
    """
    named = source.select(
        *keys, *[F.col(c).alias(f"s_{c}") for c in source.columns if c not in keys], F.lit(True).alias("_match")
    )
    hit = F.col("_match") if where is None else F.col("_match") & where
    return target.join(named, list(keys), "left").select(
        *[F.when(hit, changes[c]).otherwise(F.col(c)).alias(c) if c in changes else F.col(c) for c in target.columns]
    )


def left_join_fanout(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """A left join whose right side may hold any number of rows per key.

    An outer join can split a skewed left side only. Written as an inner join,
    which can split either, plus the left rows without a match, it stays
    balanced when most of the right side falls on one key.
    """
    matched = left.join(right, list(on))
    alone = left.join(right.select(*on).distinct(), list(on), "left_anti")
    return matched.unionByName(alone, allowMissingColumns=True)
