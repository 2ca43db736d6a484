"""Small tables that the tests of this folder share."""

import re

WORD = re.compile("[^\x20\x09-\x0d]+")

# Nulls everywhere, empty and blank texts, repeated rows, one long text.
AWKWARD = [
    (1, "", "s"),
    (2, None, None),
    (3, " \t\n\x0b\x0c\r ", "s"),
    (4, "one", "s"),
    (4, "one", "s"),
    (None, "a null id with a text of its own", None),
    (5, " no break spaces are words \u0001 too \U0001f600", ""),
    (6, "long " * 30000 + "end", "t"),
    (7, "x" * 60000, "t"),
]


def docs(spark, rows, more=""):
    """(doc_id, text, source) rows; ``more`` adds columns."""
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    return df.selectExpr("*", *[x for x in more.split("; ") if x])
