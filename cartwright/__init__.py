"""cartwright: e-commerce batch and streaming analytics on PySpark."""

__version__ = "0.1.0"
