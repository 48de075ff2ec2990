"""Column operations with name checks.

Spark replaces, ignores or skips silently where these raise, so a typo in a
job fails when it is built, not in its output.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame


def _have(df: DataFrame) -> set[str]:
    return {c.lower() for c in df.columns}


def _require(df: DataFrame, names) -> None:
    missing = [n for n in names if n.lower() not in _have(df)]
    if missing:
        raise ValueError(f"no such columns: {missing}; have {df.columns}")


def select_columns(df: DataFrame, *columns: str | Column) -> DataFrame:
    return df.select(*columns)


def add_columns(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Append columns; a name already present is an error."""
    taken = [n for n in columns if n.lower() in _have(df)]
    if taken:
        raise ValueError(f"columns exist already: {taken}")
    return df.withColumns(dict(columns))


def add_or_replace_columns(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Append columns, or replace those present where they stand."""
    return df.withColumns(dict(columns))


def drop_columns(df: DataFrame, *names: str) -> DataFrame:
    _require(df, names)
    return df.drop(*names)


def rename_columns(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename in place; old names must exist and new ones must be free."""
    _require(df, names)
    kept = _have(df) - {n.lower() for n in names}
    new = [n.lower() for n in names.values()]
    if len(set(new)) < len(new) or kept & set(new):
        raise ValueError(f"new names clash: {list(names.values())}")
    renamed = {old.lower(): new for old, new in names.items()}
    return df.toDF(*[renamed.get(c.lower(), c) for c in df.columns])
