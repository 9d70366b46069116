"""lakeops: layered table work, data quality and linear models as Spark DataFrame functions."""

__version__ = "0.1.0"
