"""SQL over tables, schemas and query plans."""

from __future__ import annotations

import contextlib
import io

from pyspark.sql import DataFrame, SparkSession


def sql_query(spark: SparkSession, statement: str, **tables: DataFrame) -> DataFrame:
    """Run SQL in which ``{name}`` stands for the table passed as ``name``."""
    return spark.sql(statement, **tables)


def schema_lines(df: DataFrame) -> list[str]:
    """Column names and types, one text line each."""
    return [f"`{f.name}` {f.dataType.simpleString().upper()}" for f in df.schema]


def print_schema(df: DataFrame) -> None:
    print("(\n  " + ",\n  ".join(schema_lines(df)) + "\n)")


def explain(df: DataFrame, mode: str = "extended") -> str:
    """Logical, optimised and physical plan as text."""
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain(mode=mode)
    return text.getvalue()


def explain_sql(spark: SparkSession, statement: str, **tables: DataFrame) -> str:
    return explain(spark.sql(statement, **tables))
