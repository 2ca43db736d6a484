"""Words, tables and row packing that the operators of this package share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The six characters that separate words: space and U+0009 to U+000D.
SPACE = " \t\n\x0b\x0c\r"
SPACE_CLASS = r"[\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The named columns of a given table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet").select(*columns)


def text_of(column: str = "text") -> Column:
    """A text column with null read as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def words(text: Column) -> Column:
    """The words of a text in order: an array, empty when there is none."""
    inner = F.btrim(text, F.lit(SPACE))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, SPACE_CLASS + "+", -1))


def bind(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def packed(docs: DataFrame) -> DataFrame:
    """All columns of a table in one struct ``row``: helper columns beside it cannot clash."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
