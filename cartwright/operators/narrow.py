"""Identifiers as bytes while rows move.

The text of an identifier is 36 characters that no codec of a shuffle shortens;
packed it is 16 bytes. Packing loses nothing, also of texts that are no
identifiers, so packed columns may be joined, grouped and counted as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import packed_id, plain_id


def with_packed_ids(df: DataFrame) -> DataFrame:
    """Text columns named ``…_id`` packed; all others, and those packed already, as they are."""
    texts = [f.name for f in df.schema if f.name.endswith("_id") and isinstance(f.dataType, T.StringType)]
    return df.select(*[packed_id(F.col(c)).alias(c) if c in texts else F.col(c) for c in df.columns])


def with_plain_ids(df: DataFrame, like: T.StructType) -> DataFrame:
    """Packed columns as text again: those that are text in the schema before packing."""
    texts = {f.name for f in like if isinstance(f.dataType, T.StringType)}
    packed = [f.name for f in df.schema if f.name in texts and isinstance(f.dataType, T.BinaryType)]
    return df.select(*[plain_id(F.col(c)).alias(c) if c in packed else F.col(c) for c in df.columns])
