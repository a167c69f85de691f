"""Property-valuation analytics expressed as Spark DataFrame and Spark ML jobs."""

__version__ = "0.1.0"
