"""Warehouse ETL, data quality and table comparison as PySpark DataFrame operators."""

__version__ = "0.1.0"
