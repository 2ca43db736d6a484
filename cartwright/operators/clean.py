"""Cleaning: one projection per entity, driven by the entity's description."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..catalog import EntitySpec, spec_for
from ..functions.numbers import DAILY_MONEY, MONEY, to_int, to_money
from ..functions.text import strip, title_case
from ..functions.times import to_day, to_utc

MONEY_OF = {"money": MONEY, "daily_money": DAILY_MONEY}

# How a stripped text column becomes a staging column.
KINDS = {
    "text": lambda c: c,
    "upper": F.upper,
    "title": title_case,
    "day": to_day,
    "utc": to_utc,
    "int": to_int,
    "money": lambda c: to_money(c, MONEY),
    "daily_money": lambda c: to_money(c, DAILY_MONEY),
}


def cleaned(spec: EntitySpec, column: str) -> Column:
    return KINDS[spec.columns[column]](strip(F.col(column)))


def clean(entity: str, df: DataFrame) -> DataFrame:
    """Strip, type and standardise the entity's columns; other columns pass through."""
    try:
        spec = spec_for(entity)
    except ValueError:
        raise ValueError(f"No cleaner defined for entity: {entity!r}") from None
    return df.select(
        *[cleaned(spec, c).alias(c) if c in spec.columns else F.col(c) for c in df.columns]
    )
