"""brindle: analytics on PySpark's DataFrame and SQL APIs."""

__version__ = "0.1.0"
