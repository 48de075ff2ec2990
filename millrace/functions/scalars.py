"""Casts, text and time expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss"


def to_bigint(value: Column, strict: bool = True) -> Column:
    """Integer from text. Strict raises on bad text; otherwise it gives NULL."""
    return value.cast("bigint") if strict else value.try_cast("bigint")


def to_text(value: Column) -> Column:
    return value.cast("string")


def to_timestamp(value: Column, strict: bool = False) -> Column:
    """Timestamp from text. Strict raises on bad text; otherwise it gives NULL."""
    return value.cast("timestamp") if strict else value.try_cast("timestamp")


def parse_iso_seconds(value: Column, strict: bool = True) -> Column:
    """``2024-02-19T08:00:00`` as an instant in the session time zone."""
    parse = F.to_timestamp if strict else F.try_to_timestamp
    return parse(value, F.lit(ISO_SECONDS)) if not strict else parse(value, ISO_SECONDS)


def event_time_from_millis(value: Column) -> Column:
    return F.timestamp_millis(value.cast("bigint"))


def minus_millis(ts: Column, millis: int) -> Column:
    return ts - F.expr(f"INTERVAL '{millis / 1000}' SECOND")


def concat(*parts: Column) -> Column:
    """Joined text, NULL as soon as one part is."""
    return F.concat(*parts)


def split_text(value: Column, separator: str) -> Column:
    """Pieces between literal separators, empty ones kept."""
    if not separator:
        raise ValueError("empty separator")
    return F.split(value, "".join(re.escape(c) for c in separator))


def not_equal(left: Column, right: Column) -> Column:
    return left != right


def equal(left: Column, right: Column) -> Column:
    return left == right
