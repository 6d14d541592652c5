"""Rows as JSON payloads, and payload fields as columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from estrato.functions.text import blank_to_null


def _timestamp_text(c: Column) -> Column:
    """``2025-11-05 10:20:00``, with six fraction digits where there are any."""
    s = c.cast("string")
    return F.when(F.contains(s, F.lit(".")), F.rpad(s, 26, "0")).otherwise(s)


def _json_value(field: T.StructField) -> Column:
    c = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
        return _timestamp_text(c).alias(field.name)
    if isinstance(field.dataType, (T.DecimalType, T.DateType, T.BinaryType)):
        return c.cast("string").alias(field.name)
    return c.alias(field.name)


def payload_of(df: DataFrame, columns: list[str] | None = None) -> Column:
    """One JSON object of the row.

    NULL fields are kept; dates, timestamps and decimals are text, so no digit of
    them is lost on the way.
    """
    wanted = columns or df.columns
    values = [_json_value(df.schema[name]) for name in wanted]
    return F.to_json(F.struct(*values), {"ignoreNullFields": "false"})


def payload_fields(payload: Column, names: list[str]) -> Column:
    """All named top-level fields as a struct of texts, read in one JSON pass."""
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    return F.from_json(payload, schema)


def field_or_null(parsed: str, name: str) -> Column:
    """``nullif(payload ->> name, '')`` on a column made by :func:`payload_fields`."""
    return blank_to_null(F.col(f"{parsed}.`{name}`"))
