"""User tagging and event-stream analytics on PySpark."""

__version__ = "0.1.0"
