"""Text expressions: missing-value tokens, trimming, letter case, identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The tokens a CSV reader with default settings takes as missing.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

# The identifier and number formats a row must match.
UUID_PATTERN = "^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"
DECIMAL_PATTERN = r"^\d+(\.\d+)?$"
INTEGER_PATTERN = r"^\d+$"

# The characters that count as white space at the ends of a value.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

_MARK = "\u001f "


def na_to_null(c: Column) -> Column:
    """Null where the text is one of the missing-value tokens."""
    return F.when(~c.isin(*NA_TOKENS), c)


def strip(c: Column) -> Column:
    """Remove leading and trailing white space of any kind, not only blanks.

    Trimming looks both ends up in the whole list; most values begin and end with a printable ASCII character
    and are taken as they are.
    """
    ends = [F.ascii(c), F.ascii(F.substring(c, -1, 1))]
    return F.when(ends[0].between(33, 126) & ends[1].between(33, 126), c).otherwise(F.btrim(c, F.lit(WHITE_SPACE)))


def title_case(c: Column) -> Column:
    """Upper-case each letter that follows a non-letter and lower-case the rest.

    ``initcap`` starts a new word only after a blank, so a marked blank is put
    in front of every letter that follows a non-letter and removed afterwards.
    """
    marked = F.regexp_replace(c, r"(\P{L})(?=\p{L})", "$1" + _MARK)
    return F.replace(F.initcap(marked), F.lit(_MARK), F.lit(""))


def name_uuid(prefix: str, *parts: Column) -> Column:
    """A deterministic lower-case 8-4-4-4-12 identifier for a name.

    The hyphens are put into one digest; cutting it up would compute it per cut.
    """
    named = F.concat_ws("-", F.lit(prefix), *[p.cast("string") for p in parts])
    out = F.md5(named.cast("binary"))
    for at in (9, 14, 19, 24):
        out = F.overlay(out, F.lit("-"), at, 0)
    return out


# Before any other text, so that it is longer than the bytes of an identifier.
_OTHER = bytes(17)


def packed_id(c: Column) -> Column:
    """An identifier as its 16 bytes, fewer than half of its text's; any other text after a mark of its own."""
    known = (F.length(c) == 36) & c.rlike(UUID_PATTERN)
    return F.when(known, F.unhex(F.replace(c, F.lit("-"), F.lit("")))).otherwise(
        F.concat(F.lit(_OTHER), c.cast("binary")))


def plain_id(c: Column) -> Column:
    """The text that was packed."""
    parts = [F.hex(F.substring(c, at, n)) for at, n in ((1, 4), (5, 2), (7, 2), (9, 2), (11, 6))]
    return F.when(F.length(c) == 16, F.lower(F.concat_ws("-", *parts))).otherwise(F.substring(c, len(_OTHER) + 1, 2**31 - 1).cast("string"))


def pick(choices: tuple[str, ...] | list[str], index: Column) -> Column:
    """The choice at a zero-based index."""
    return F.element_at(F.array(*[F.lit(x) for x in choices]), index.cast("int") + 1)


def hash_mod(c: Column, n: int | Column) -> Column:
    """A bucket in ``[0, n)`` from the text's md5, equal on every engine and run.

    Fifteen hex digits stay below 2**60, so the number is never negative.
    """
    head = F.conv(F.substring(F.md5(c.cast("binary")), 1, 15), 16, 10).cast("bigint")
    return F.pmod(head, n if isinstance(n, Column) else F.lit(n).cast("bigint"))


def zero_padded(i: Column, width: int) -> Column:
    """A number with leading zeros; a longer one is kept whole, where ``lpad`` would cut it."""
    digits = i.cast("string")
    return F.when(F.length(digits) < width, F.lpad(digits, width, "0")).otherwise(digits)
