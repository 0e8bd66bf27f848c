"""Timestamp text: parsing, format classes, reformatting, durations."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The accepted timestamp patterns and their profile labels.
ISO_Z = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d{3})?Z$"
ISO_NO_ZONE = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d{3})?$"
DIGITS_14 = r"^\d{14}$"
DIGITS_12 = r"^\d{12}$"
DIGITS_8 = r"^\d{8}$"
ISO_MIDNIGHT = r"T00:00:00(\.000)?Z$"


def _digits(text: Column, start: int, length: int) -> Column:
    return F.substring(text, start, length)


def parse_timestamp(raw: Column) -> Column:
    """TS1: ISO-8601 with Z, or 14 digits; anything else is NULL (always UTC).

    Both formats end in a string-to-timestamp cast, which Spark does without
    building a formatter per value; an impossible date gives NULL.
    """
    text = F.trim(raw)
    compact = F.concat(
        _digits(text, 1, 4), F.lit("-"), _digits(text, 5, 2), F.lit("-"), _digits(text, 7, 2),
        F.lit("T"), _digits(text, 9, 2), F.lit(":"), _digits(text, 11, 2), F.lit(":"),
        _digits(text, 13, 2), F.lit("Z"),
    )
    return (
        F.when(text.rlike(ISO_Z), text.try_cast("timestamp"))
        .when(text.rlike(DIGITS_14), compact.try_cast("timestamp"))
    )


def format_class(raw: Column) -> Column:
    """TS2/RX9: which of seven patterns a raw value follows."""
    text = F.trim(raw)
    return (
        F.when(text.isNull() | (text == ""), "vazio/NA")
        .when(text.rlike(ISO_Z), "iso8601_Z")
        .when(text.rlike(ISO_NO_ZONE), "iso8601_semZ")
        .when(text.rlike(DIGITS_14), "num_yyyymmddhhmmss")
        .when(text.rlike(DIGITS_12), "num_yyyymmddhhmm")
        .when(text.rlike(DIGITS_8), "num_yyyymmdd")
        .otherwise("outro")
    )


def parse_iso_prefix(raw: Column) -> Column:
    """TS10: the first 19 characters as date and time, any suffix ignored (UTC)."""
    return F.concat(F.substring(raw, 1, 19), F.lit("Z")).try_cast("timestamp")


def parse_date_prefix(raw: Column) -> Column:
    """TS10: the first 10 characters as a date."""
    return F.substring(raw, 1, 10).try_cast("date")


def compact_to_display(raw: Column) -> Column:
    """TS7: 14 characters to dd/MM/yyyy HH:mm:ss by position; others pass through."""
    display = F.concat(
        _digits(raw, 7, 2), F.lit("/"), _digits(raw, 5, 2), F.lit("/"), _digits(raw, 1, 4),
        F.lit(" "), _digits(raw, 9, 2), F.lit(":"), _digits(raw, 11, 2), F.lit(":"),
        _digits(raw, 13, 2),
    )
    return F.when(F.length(raw) == 14, display).otherwise(raw)


def query_time_to_display(raw: Column) -> Column:
    """TS11: yyyyMMdd_HHmmss, really parsed, to dd/MM/yyyy HH:mm:ss."""
    return F.date_format(
        F.try_to_timestamp(raw, F.lit("yyyyMMdd_HHmmss")), "dd/MM/yyyy HH:mm:ss"
    )


def is_midnight(ts: Column) -> Column:
    """TS12: the UTC time of day is 00:00:00, to the second."""
    return F.pmod(F.unix_seconds(ts), F.lit(86_400)) == 0


def month_start(ts: Column) -> Column:
    """TS3: first day of the month, as a date."""
    return F.trunc(F.to_date(ts), "month")


def days_between(start: Column, end: Column) -> Column:
    """TS8: fractional days from ``start`` to ``end``."""
    return (F.unix_micros(end) - F.unix_micros(start)) / F.lit(86400e6)


def years_since(origin: str, ts: Column) -> Column:
    """TS8: fractional years of 365.25 days since a UTC date."""
    start = F.lit(f"{origin}T00:00:00Z").cast("timestamp")
    return days_between(start, ts) / F.lit(365.25)


def month_sequence(first: Column | str, last: Column | str) -> Column:
    """TS9: array of month starts, both ends included."""
    first = F.lit(first).cast("date") if isinstance(first, str) else first
    last = F.lit(last).cast("date") if isinstance(last, str) else last
    return F.sequence(first, last, F.expr("interval 1 month"))
