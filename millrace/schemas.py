"""Event schemas. Names and types are fixed by the events themselves."""

from pyspark.sql import types as T

CDC_SOURCE = (
    "version STRING, connector STRING, name STRING, ts_ms BIGINT, snapshot STRING, db STRING, `schema` STRING, "
    "table_name STRING, change_lsn STRING, commit_lsn STRING, event_serial_no INT"
)
CUSTOMER_ROW = "id BIGINT, first_name STRING, last_name STRING, email STRING"


def cdc_envelope(row: str = CUSTOMER_ROW) -> str:
    """Change envelope around a row schema given as DDL."""
    fields = T.DataType.fromDDL(row).simpleString()
    source = T.DataType.fromDDL(CDC_SOURCE).simpleString()
    return f"source {source}, op STRING, ts_ms BIGINT, before {fields}, after {fields}"
