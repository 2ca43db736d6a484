"""Independent SQL for the same results, run by another engine over the same tables."""

from .ctes import compose  # noqa: F401
