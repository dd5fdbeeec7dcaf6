"""Calendar helpers as column expressions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

# The two text formats dates are kept in.
LONG_FORMAT = "yyyy-MM-dd HH:mm:ss"
SHORT_FORMAT = "yyyy-MM-dd"

AsOf = dt.date | dt.datetime | str | Column | None


def as_of_column(as_of: AsOf) -> Column:
    """Reference moment of a run; the clock only when nothing is given."""
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, str):
        return F.lit(as_of).cast("timestamp_ntz")
    return F.lit(as_of)


def date_text(value: Column, fmt: str = SHORT_FORMAT) -> Column:
    """Moment as text. The short format is how a date prints, which needs no pattern."""
    if fmt == SHORT_FORMAT:
        return F.to_date(value).cast("string")
    return F.date_format(value, fmt)


def now_text(as_of: AsOf = None, fmt: str = SHORT_FORMAT) -> Column:
    return date_text(as_of_column(as_of), fmt)


def parse_date(text: Column, fmt: str = SHORT_FORMAT, *, strict: bool = True) -> Column:
    """Text to timestamp by pattern; malformed text fails, or is null when not ``strict``."""
    parse = F.to_timestamp if strict else F.try_to_timestamp
    return parse(text, F.lit(fmt) if not strict else fmt)


def shift_date(text: Column, days: Column | int, fmt: str = SHORT_FORMAT) -> Column:
    """Date text moved by ``days`` calendar days, in the same format.

    The time of day is kept when the format has one.
    """
    days = F.lit(days) if isinstance(days, int) else days
    if fmt == SHORT_FORMAT:
        return F.date_add(text.cast("date"), days).cast("string")
    clock = F.to_timestamp(text, fmt).cast("timestamp_ntz") + F.make_dt_interval(days)
    return F.date_format(clock, fmt)


def unix_moment(seconds: Column) -> Column:
    """Unix seconds to timestamp."""
    return F.timestamp_seconds(seconds)
