"""Partitioners: from a frame of records to the directory token of each record.

A partitioner is any callable from the frame to a string column, so users pass their own the same way.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Partitioner = Callable[[DataFrame], Column]

UNKNOWN = "unknown"


def by_kafka_partition() -> Partitioner:
    """``partition=<n>``"""
    return lambda records: F.concat(F.lit("partition="), records["kafka_partition"].cast("string"))


def by_payload_field(field: str = "payload.protocol", unknown: str = UNKNOWN) -> Partitioner:
    """The bare value of a decoded payload field; ``unknown`` when unset or undecodable.

    An empty string is a value, not an unset field.
    """
    return lambda records: F.coalesce(F.col(field).cast("string"), F.lit(unknown))


def by_field(field: str) -> Partitioner:
    """``<field>=<value>``; a null value is written ``null``."""
    if not field:
        raise ValueError("a field partitioner needs a field name")
    label = field.rsplit(".", 1)[-1]
    return lambda records: F.concat(F.lit(f"{label}="), F.coalesce(F.col(field).cast("string"), F.lit("null")))


def by_time(
    millis: Column | None,
    duration_ms: int,
    path_format: str,
    timezone: str = "UTC",
    locale: str = "en",
) -> Partitioner:
    """Ingest time floored to ``duration_ms`` and formatted as a path.

    ``millis`` defaults to the clock of the query. The week-year letter ``Y`` is read as the calendar year, which
    is what path formats written for older formatters mean by it. The zone and the language of the path are those given
    here, whatever the session's are; a null time gives ``null``.
    """
    if duration_ms <= 0:
        raise ValueError("a time partitioner needs a positive duration")
    if not path_format:
        raise ValueError("a time partitioner needs a path format")
    pattern = _calendar_years(path_format).rstrip("/")
    options = {"timestampFormat": pattern, "timeZone": timezone, "locale": locale.replace("_", "-")}

    def token(records: DataFrame) -> Column:
        moment = millis if millis is not None else F.unix_millis(F.current_timestamp())
        floored = F.floor(moment / F.lit(duration_ms)).cast("bigint") * F.lit(duration_ms)
        # date_format() knows no zone but the session's; the JSON writer takes one, and a language.
        written = F.to_json(F.struct(F.timestamp_millis(floored).alias("at")), options)
        return F.coalesce(F.get_json_object(written, "$.at"), F.lit("null"))

    return token


def partitioner_for(
    name: str | Partitioner,
    field: str = "",
    duration_ms: int = -1,
    path_format: str = "",
    timezone: str = "",
    locale: str = "",
    millis: Column | None = None,
) -> Partitioner:
    """Look up a partitioner by name; a callable is taken as it is."""
    if callable(name):
        return name
    if name == "default":
        return by_kafka_partition()
    if name == "protocol":
        return by_payload_field()
    if name == "field":
        return by_field(field)
    if name == "time":
        return by_time(millis, duration_ms, path_format, timezone or "UTC", locale or "en")
    raise ValueError(f"unknown partitioner {name!r}")


def _unquoted(pattern: str, rewrite: Callable[[str], str]) -> str:
    pieces = re.split(r"('[^']*')", pattern)
    return "".join(piece if piece.startswith("'") else rewrite(piece) for piece in pieces)


def _calendar_years(pattern: str) -> str:
    return _unquoted(pattern, lambda piece: piece.replace("Y", "y"))
