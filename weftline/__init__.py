"""weftline: SQL column lineage, impact analysis and training-data operators on PySpark."""

__version__ = "0.1.0"
