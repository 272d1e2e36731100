"""brightledger: sales analytics operators and data jobs, written for Spark."""

__version__ = "0.1.0"
