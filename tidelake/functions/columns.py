"""Scalar expressions used by the jobs.  All run inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts, patterns and formats that results must match exactly.
MASK = "****"
LINE_FORMAT = "Arquivo texto linha %d"
DONE_SUFFIX = " - Processado com sucesso!"
TAG_PATTERN = "<[^>]+>"
PAYLOAD_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss"
OFFSET_LENGTH = 6
PAYLOAD_SCHEMA = "results STRUCT<sunrise: STRING, sunset: STRING>"


def masked() -> Column:
    return F.lit(MASK)


def numbered_line(number: Column) -> Column:
    return F.format_string(LINE_FORMAT, number)


def with_done_suffix(line: Column) -> Column:
    return F.concat(line, F.lit(DONE_SUFFIX))


def without_tags(html: Column) -> Column:
    return F.regexp_replace(html, TAG_PATTERN, "")


def utc_now() -> Column:
    """Current time as a zone-less UTC timestamp, whatever the session zone is."""
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.localtimestamp())


def payload_time(text: Column, apply_offset: bool = False) -> Column:
    """Parse ``2025-01-01T06:00:00+00:00`` to a zone-less UTC timestamp.

    The offset is cut off and the rest is read as UTC.  ``apply_offset=True``
    honours it instead.
    """
    wall = F.to_timestamp_ntz(
        F.left(text, F.length(text) - F.lit(OFFSET_LENGTH)), F.lit(PAYLOAD_TIME_FORMAT)
    )
    if not apply_offset:
        return wall
    offset = F.right(text, F.lit(OFFSET_LENGTH))
    return F.convert_timezone(offset, F.lit("UTC"), wall)


def is_night(sunrise: Column, sunset: Column, now: Column) -> Column:
    """True unless ``now`` lies strictly between sunrise and sunset."""
    return ~((sunrise < now) & (now < sunset))


def payload_is_night(body: Column, now: Column, apply_offset: bool = False) -> Column:
    """Day/night check on a JSON body ``{"results": {"sunrise", "sunset"}}``."""
    results = F.from_json(body, PAYLOAD_SCHEMA)["results"]
    return is_night(
        payload_time(results["sunrise"], apply_offset),
        payload_time(results["sunset"], apply_offset),
        now,
    )
