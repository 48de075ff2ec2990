"""Event and change-data ETL as Spark DataFrame, SQL and Structured Streaming programs."""

__version__ = "0.1.0"
