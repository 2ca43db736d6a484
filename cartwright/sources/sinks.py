"""Writing CSV files below dated folders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_dated_csv(
    df: DataFrame, root: str, entity: str, day: str, mode: str = "append", together: bool = False, compression: str = "none"
) -> None:
    """Write to ``root/entity=…/yyyy=…/mm=…/dd=…/``, keeping blanks around values.

    ``day`` names the date column that decides the folder; it is not written.
    Rows are brought together by day first so that a day gets few files; the
    rebalance may split a day that is far larger than the others. Rows that are
    ``together`` already are written as they lie. Each entity is written as a
    table of its own, so several can be written at the same time.
    """
    parts = {"yyyy": F.date_format(day, "yyyy"), "mm": F.date_format(day, "MM"), "dd": F.date_format(day, "dd")}
    dated = df.withColumns(parts).drop(day)
    (
        (dated if together else dated.hint("rebalance", *parts))
        .write.mode(mode)
        .partitionBy(*parts)
        .option("header", True)
        .option("compression", compression)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("escape", '"')
        .csv(f"{root}/entity={entity}")
    )


def write_quarantine(rejected: DataFrame, root: str, entity: str, at: Column, mode: str = "append") -> None:
    """Append rejected rows in their original text, with reasons and source file.

    The folder date is the time of rejection, not the date of the source file.
    """
    internal = [c for c in rejected.columns if c in ("_row", "_loaded_at")]
    flat = rejected.drop(*internal).withColumn("_day", F.to_date(at))
    write_dated_csv(flat, root, entity, "_day", mode)
