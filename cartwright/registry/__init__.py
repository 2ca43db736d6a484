"""The registered queries and the SQL each is checked against."""

from . import (  # noqa: F401  (importing registers)
    dashboards,
    expressions,
    quality,
    relational,
    rows,
    sinks,
    sources,
    staging,
    star,
    streams,
)
from .base import ORACLE, QUERIES  # noqa: F401
