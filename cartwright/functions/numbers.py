"""Number expressions: tolerant parsing, money, guarded ratios."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(12,2)"
DAILY_MONEY = "decimal(15,2)"
WIDE_MONEY = "decimal(38,2)"



def _plain(c: Column) -> Column:
    """The text if it holds only characters of a plain number.

    The cast alone would also take suffixes such as "1.5f" and names such as "NaN".
    """
    return F.when(F.translate(c, "0123456789+-.eE", "") == "", c)


def to_money(c: Column, kind: str = MONEY) -> Column:
    """Parse to a two-digit decimal; text that is no number becomes null."""
    return _plain(c).try_cast(kind)


def to_int(c: Column) -> Column:
    """Parse to an integer, dropping a fraction; null or bad text becomes 0."""
    return F.coalesce(_plain(c).try_cast("double").try_cast("int"), F.lit(0))


def sum_or_zero(c: Column) -> Column:
    return F.coalesce(F.sum(c), F.lit(0).cast(MONEY))


def safe_ratio(top: Column, bottom: Column) -> Column:
    """``top / bottom``, null where ``bottom`` is zero."""
    return top / F.nullif(bottom, F.lit(0).cast("decimal(1,0)"))


def percent(part: Column, whole: Column) -> Column:
    """A share in percent with two digits, null where the whole is zero."""
    return F.round(safe_ratio(part * F.lit(100).cast("decimal(3,0)"), whole), 2)


def growth_percent(now: Column, before: Column) -> Column:
    """Change in percent with two digits, 0 where the earlier value is zero."""
    change = safe_ratio((now - before).cast("decimal(20,0)"), before.cast("decimal(20,0)"))
    return F.round(F.coalesce(change * 100, F.lit(0).cast("decimal(20,6)")), 2)


def line_profit(total: Column, unit_cost: Column, quantity: Column) -> Column:
    """Line total less cost; an unknown cost counts as zero."""
    cost = F.coalesce(unit_cost, F.lit(0).cast(MONEY)) * quantity.cast("decimal(10,0)")
    return (total - cost).cast(WIDE_MONEY)
