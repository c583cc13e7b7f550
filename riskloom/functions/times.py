"""Tolerant and strict timestamp handling, lateness, ISO text."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

# ISO-8601 text: date, optional time, optional offset; separators between digits are optional.
ISO_TEXT = (
    r"^(\d{4})-?(\d{2})-?(\d{2})"
    r"(?:[^0-9](\d{2})(?::?(\d{2}))?(?::?(\d{2}))?(?:[.,](\d+))?(Z|[+-]\d{2}(?::?\d{2})?)?)?$"
)
ISO_USUAL = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?(Z|[+-]\d{2}:\d{2})?)?$"
ISO_PLAIN = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(?::\d{2}(?:\.\d{1,6})?)?(?:Z|[+-]\d{2}:\d{2})$"
ISO_WITH_OFFSET = (
    r"^\d{4}-?\d{2}-?\d{2}[^0-9]\d{2}(:?\d{2}){0,2}([.,]\d+)?(Z|[+-]\d{2}(:?\d{2})?)$"
)


def parse_instant(text: Column | str) -> Column:
    """Timestamp, or null for text that is none (never an error)."""
    return F.try_to_timestamp(F.col(text) if isinstance(text, str) else text)


def _part(text: Column, group: int) -> Column:
    return F.regexp_extract(text, ISO_TEXT, group)


def has_offset(text: Column) -> Column:
    """The ISO text names its offset from UTC."""
    return F.coalesce(text.rlike(ISO_WITH_OFFSET), F.lit(False))


def parse_iso(text: Column) -> Column:
    """Timestamp of an ISO-8601 text, read as UTC without an offset; null for other text.

    Text in the usual layout is parsed as it stands; only the rarer spellings (no
    separators, hour-only times, short offsets) are taken apart first.
    """
    return F.coalesce(
        F.when(text.rlike(ISO_USUAL), F.try_to_timestamp(text)),
        F.when(text.rlike(ISO_TEXT), F.try_to_timestamp(_usual_layout(text))),
    )


def _usual_layout(text: Column) -> Column:
    def two(group: int) -> Column:
        return F.when(_part(text, group) == "", "00").otherwise(_part(text, group))

    digits = F.regexp_replace(_part(text, 8), "[Z:]", "")  # "", +hh or +hhmm
    offset = F.rpad(F.when(digits == "", "+").otherwise(digits), 5, "0")
    fraction = F.when(_part(text, 7) == "", "").otherwise(
        F.concat(F.lit("."), F.substring(_part(text, 7), 1, 6))
    )
    return F.concat(
        _part(text, 1), F.lit("-"), _part(text, 2), F.lit("-"), _part(text, 3), F.lit("T"),
        two(4), F.lit(":"), two(5), F.lit(":"), two(6), fraction,
        F.substring(offset, 1, 3), F.lit(":"), F.substring(offset, 4, 2),
    )


def is_plain_instant(text: Column) -> Column:
    """The text is an instant in the usual layout, with its offset."""
    return F.coalesce(text.rlike(ISO_PLAIN), F.lit(False))


def parse_instant_strict(text: Column, plain: Column | None = None) -> Column:
    """Timestamp of an ISO-8601 text that names its offset, otherwise null; `plain` is `is_plain_instant`, if known."""
    rare = F.when(has_offset(text), parse_iso(text))
    return F.when(is_plain_instant(text) if plain is None else plain, F.try_to_timestamp(text)).otherwise(rare)


def local_date(text: Column, plain: Column | None = None) -> Column:
    """Calendar date written in the text, in its own offset."""
    usual = text.rlike(ISO_USUAL) if plain is None else plain
    spelled = F.when(usual, F.substring(text, 1, 10)).otherwise(
        F.concat_ws("-", *[_part(text, g) for g in (1, 2, 3)])
    )
    return F.try_to_date(spelled)


def local_hour(text: Column, plain: Column | None = None) -> Column:
    """Hour written in the text, in its own offset."""
    usual = text.rlike(ISO_USUAL) if plain is None else plain
    spelled = F.when(usual, F.substring(text, 12, 2)).otherwise(_part(text, 4))
    return spelled.try_cast("int")


def is_late(hours: int = 24, event: str = "event_timestamp", arrival: str = "ingestion_timestamp") -> Column:
    """Event older than its arrival by more than the given hours, to the microsecond."""
    return F.col(event) < F.col(arrival) - F.make_dt_interval(F.lit(0), F.lit(hours))


def is_late_whole_hours(
    hours: int = 24, event: str = "event_timestamp", arrival: str = "ingestion_timestamp"
) -> Column:
    """Same test on whole elapsed hours: fires one hour later than `is_late`."""
    return F.timestamp_diff("HOUR", F.col(event), F.col(arrival)) > hours


def delay_seconds(event: str = "event_timestamp", arrival: str = "ingestion_timestamp") -> Column:
    return F.timestamp_diff("SECOND", F.col(event), F.col(arrival))


def iso_utc(instant: Column) -> Column:
    """Text such as 2026-01-31T10:20:30Z."""
    return F.date_format(instant, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def epoch_seconds(text: Column | str) -> Column:
    """Seconds since the epoch of an ISO text, 0 when it is none."""
    return F.coalesce(F.unix_timestamp(parse_instant(text)), F.lit(0).cast("long"))


def iso_date(value: str) -> str:
    """Check a date parameter on the driver; raises ValueError for anything but YYYY-MM-DD."""
    parsed = date.fromisoformat(value)
    if parsed.isoformat() != value:
        raise ValueError(f"date must be YYYY-MM-DD: {value!r}")
    return value
