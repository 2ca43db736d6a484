"""Raw CSV files and the ledger of files already loaded."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..catalog import ENTITIES
from ..functions.text import na_to_null

# Fields of a CSV line before they have names, and how many more than an entity's a file may have.
FIELD, SPARE = "_field", 16


def list_objects(spark: SparkSession, root: str) -> DataFrame:
    """Every file below a folder, as ``object_path`` and ``entity``.

    Only the path column is read, so no file content is loaded. ``object_path``
    is relative to the folder: ``entity=orders/yyyy=2001/mm=08/dd=01/file``.
    """
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path")
    )
    relative = object_path(F.col("path"), root)
    return files.select(relative.alias("object_path"), F.regexp_extract(relative, "^entity=([^/]+)/", 1).alias("entity"))


def object_path(uri: Column, root: str) -> Column:
    """The part of a file's URI below a root folder."""
    tail = root.rstrip("/").split(":")[-1].lstrip("/")
    return F.substring_index(uri, tail + "/", -1)


def folder_day(path: Column) -> Column:
    """The date a file's folder stands for."""
    parts = [F.regexp_extract(path, f"{name}=([0-9]+)", 1) for name in ("yyyy", "mm", "dd")]
    return F.concat_ws("-", *parts).cast("date")


def discover(listing: DataFrame, ledger: DataFrame) -> DataFrame:
    """Files the ledger does not know yet."""
    return listing.join(ledger.select("object_path"), "object_path", "left_anti")


def read_raw(spark: SparkSession, root: str, entity: str) -> DataFrame:
    """An entity's CSV files with every column as text and missing tokens as null.

    Adds ``_source_file`` and ``_row``, the row's place in its file.
    """
    scan = _csv(spark.read, root, entity)
    return with_lineage(bound(scan.select("*", *file_columns()), entity), root)


def stream_raw(spark: SparkSession, root: str, entity: str) -> DataFrame:
    """The same files as a stream; apply ``bound`` and ``with_lineage`` to each of its batches."""
    return _csv(spark.readStream, root, entity).select("*", *file_columns())


def numbered(rows: DataFrame) -> DataFrame:
    """The rows with ``_at``, a number that follows their order in their file, which one task reads front to back."""
    return rows if "_at" in rows.columns else rows.withColumn("_at", F.monotonically_increasing_id())


def field_names(columns: list[str]) -> list[str]:
    return [c for c in columns if re.fullmatch(FIELD + r"\d+", c)]


def bound(rows: DataFrame, entity: str) -> DataFrame:
    """Fields of files as the entity's columns, each by its name in its file's own first line.

    The order of columns may differ from file to file; a column that a file
    lacks is null, one that is not the entity's is left out. Rows whose columns
    already have names pass through. First lines are one row per file of a list
    the driver holds anyway: they are found by number and broadcast, so that no
    row is sorted or moved.
    """
    fields = field_names(rows.columns)
    if not fields:
        return rows
    placed = numbered(rows)
    first = placed.groupBy(F.col("_uri").alias("of")).agg(F.min("_at").alias("first"))
    heads = placed.join(F.broadcast(first), (F.col("_uri") == F.col("of")) & (F.col("_at") == F.col("first")))
    # Where a file has its columns is found once per file, not once per row.
    named = heads.select("of", F.array(*fields).alias("header")).withColumn("names", F.transform("header", lambda c: F.trim(c)))
    place = {c: F.array_position("names", c).cast("int") - 1 for c in ENTITIES[entity].columns}
    heads = named.select("of", "header", *[at.alias(f"_at_{c}") for c, at in place.items()])
    values = placed.select(F.array(*fields).alias("values"), "_uri", "_block", "_at")
    body = values.join(F.broadcast(heads), F.col("_uri") == F.col("of")).filter(~F.col("values").eqNullSafe(F.col("header")))
    return body.select(*[F.when(F.col(f"_at_{c}") >= 0, F.get("values", F.col(f"_at_{c}"))).alias(c) for c in place],
                       "_uri", "_block", "_at")


def _csv(reader, root: str, entity: str) -> DataFrame:
    width = len(ENTITIES[entity].columns) + SPARE
    fields = ", ".join(f"{FIELD}{i} string" for i in range(width))
    options = reader.schema(fields).option("header", False).option("recursiveFileLookup", True)
    # Quotes inside a quoted field are doubled, line breaks are part of it, a backslash is a character.
    # A file is then read by one task: files are batches of minutes, and there are many.
    options = options.option("escape", '"').option("multiLine", True)
    return options.csv(f"{root}/entity={entity}")


def file_columns() -> list[Column]:
    return [F.col("_metadata.file_path").alias("_uri"), F.col("_metadata.file_block_start").alias("_block")]


def with_lineage(rows: DataFrame, root: str) -> DataFrame:
    """Null out missing-value tokens and turn the file columns into path and position.

    A split of a file is read front to back by one task, so the split's offset
    and the running id inside the task order the rows of a file.
    """
    values = [c for c in rows.columns if c not in ("_uri", "_block", "_at")]
    at = F.col("_at") if "_at" in rows.columns else F.monotonically_increasing_id()
    position = F.struct(F.col("_block").alias("block"), at.alias("at"))
    return rows.select(
        *[na_to_null(F.col(c)).alias(c) for c in values],
        object_path(F.col("_uri"), root).alias("_source_file"),
        position.alias("_row"),
    )


def positional(lines: DataFrame, *at: int) -> DataFrame:
    """Columns of plain comma-separated lines by position, header lines excluded.

    The first position is an identifier; any further one a number. Lines that
    are too short or whose number does not parse are left out.
    """
    parts = F.split("value", ",")
    fields = [F.trim(F.get(parts, F.lit(i))) for i in at]
    out = [fields[0].alias("id")] + [f.try_cast("double").alias(f"number_{i}") for i, f in zip(at[1:], fields[1:])]
    body = lines.filter(~F.col("is_header")).filter(F.size(parts) > max(at))
    return body.select(*out).dropna("any", subset=[f"number_{i}" for i in at[1:]] or ["id"])


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """CSV files as plain lines; a line at the start of its file is its header."""
    scan = spark.read.option("recursiveFileLookup", True).text(path)
    first_field = F.element_at(F.split("value", ","), 1)
    keys = [spec.key for spec in ENTITIES.values()]
    return scan.select("value", first_field.isin(*keys).alias("is_header"))
