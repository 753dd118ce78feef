"""Scientific frame archives and their catalog on PySpark."""

__version__ = "0.2.0"
