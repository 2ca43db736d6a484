"""Raw rows into staging tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..catalog import ENTITIES, spec_for
from ..operators import validate as V
from ..operators.clean import clean
from ..operators.merge import latest_per_key, upsert, upsert_in_one_join
from ..operators.narrow import with_packed_ids, with_plain_ids
from ..operators.store import Store
from .tables import keyed


@dataclass(frozen=True)
class Batch:
    """A checked batch: all rows with their reasons, and its two halves."""

    entity: str
    annotated: DataFrame

    @property
    def rejected(self) -> DataFrame:
        return self.annotated.filter(~V.is_valid())

    @property
    def accepted(self) -> DataFrame:
        return clean(self.entity, self.annotated.filter(V.is_valid()).drop(V.REASONS))

    def newest(self, at: Column) -> DataFrame:
        """One cleaned row per key: the later file wins, then the later row."""
        return with_plain_ids(self.newest_packed(at), ENTITIES[self.entity].staging_schema)

    def newest_packed(self, at: Column) -> DataFrame:
        """The same with packed identifiers, as they lie after the rows of a key were brought together."""
        spec = ENTITIES[self.entity]
        rows = self.accepted.select(*spec.columns, "_source_file", "_row")
        # Identifiers of accepted rows are of one form, so their bytes are in the order of their text.
        best = latest_per_key(with_packed_ids(rows), [spec.key], ["_source_file", "_row"])
        return best.select(*spec.columns, at.alias("_loaded_at"), "_source_file")


def check(entity: str, raw: DataFrame) -> Batch:
    return Batch(entity, V.annotate(entity, raw, guard_load=True))


def load(entity: str, target: DataFrame, source: DataFrame) -> DataFrame:
    """Upsert cleaned rows, refreshing the two lineage columns of every row touched; the source is read once."""
    try:
        spec = spec_for(entity)
    except ValueError:
        raise ValueError(f"No loader defined for entity: {entity!r}") from None
    updated = [*spec.updated, "_loaded_at", "_source_file"]
    merged = upsert_in_one_join(with_packed_ids(target), with_packed_ids(source), [spec.key], updated)
    return with_plain_ids(merged, target.schema)


def load_into(store: Store, entity: str, source: DataFrame, stream: str | None = None, batch: int | None = None) -> bool:
    """The same on the stored table, of which only the buckets that the rows fall into are read and written."""
    updated = [*ENTITIES[entity].updated, "_loaded_at", "_source_file"]
    return keyed(store, f"stg_{entity}").upsert(source, updated, stream, batch)


def ledger_rows(batch: Batch, at: Column) -> DataFrame:
    """One row per file of a batch, for the ledger of processed files."""
    per_file = V.summary(batch.annotated)
    return per_file.select(
        F.col("_source_file").alias("object_path"),
        F.lit(batch.entity).alias("entity"),
        at.alias("processed_at"),
        F.col("valid_rows").alias("row_count"),
        F.lit(0).cast("bigint").alias("quarantine_count"),
        F.when(F.col("valid_rows") > 0, "success").otherwise("empty").alias("status"),
    )


LEDGER_UPDATED = ("processed_at", "row_count", "quarantine_count", "status")


def write_ledger(ledger: DataFrame, rows: DataFrame) -> DataFrame:
    """The ledger after a batch; a path seen before keeps its entity."""
    return upsert(ledger, rows, ["object_path"], LEDGER_UPDATED)
