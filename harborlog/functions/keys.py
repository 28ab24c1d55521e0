"""Binary keys and values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def time_key(millis: Column) -> Column:
    """A BIGINT of epoch milliseconds as eight big-endian bytes."""
    return F.unhex(F.lpad(F.hex(millis.cast("bigint")), 16, "0"))


def raw_bytes(column: Column) -> Column:
    """Pass a key or a value through as bytes: text becomes its UTF-8 bytes, null stays null."""
    return column.cast("binary")
