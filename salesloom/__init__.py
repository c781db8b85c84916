"""Sales analytics for a shop, written as PySpark DataFrame jobs."""

__version__ = "0.1.0"
