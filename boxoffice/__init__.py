"""Layered sales analytics on Spark: raw records in, clean silver tables and gold reports out."""

__version__ = "0.1.0"
