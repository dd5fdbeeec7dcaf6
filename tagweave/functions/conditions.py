"""Filter text: ``field[OP]value`` comparisons and ``field#unit#n`` relative windows."""

from __future__ import annotations

import datetime as dt
import functools
import operator
import re
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DataType, DateType, StringType, StructType, TimestampNTZType, TimestampType

COMPARISONS = {
    "eq": operator.eq,
    "ne": operator.ne,
    "gt": operator.gt,
    "lt": operator.lt,
    "ge": operator.ge,
    "le": operator.le,
}

# Length of a window unit in days.
UNIT_DAYS = {"day": 1, "month": 30, "year": 365}

CONDITION_TEXT = re.compile(r"^([^\[]*)\[([^\]]*)\](.*)$")
DATE_ONLY = re.compile(r"^\d{4}-\d{2}-\d{2}$")
NUMBER = re.compile(r"^[+-]?\d+(\.\d+)?$")


class Condition(NamedTuple):
    field: str
    compare: str
    value: str


class Window(NamedTuple):
    """Inclusive range of calendar days on one field."""

    field: str
    first: dt.date
    last: dt.date


def parse_condition(text: str) -> Condition:
    match = CONDITION_TEXT.match(text)
    if match is None:
        raise ValueError(f"not a condition: {text!r}")
    field, compare, value = match.groups()
    if compare.lower() not in COMPARISONS:
        raise ValueError(f"unknown comparison {compare!r} in {text!r}")
    return Condition(field, compare.lower(), value)


def parse_conditions(text: str) -> list[Condition]:
    """Comma-joined conditions; all of them have to hold."""
    return [parse_condition(part) for part in text.split(",")]


def condition_parts(text: Column) -> Column:
    """Condition text held in a column, as ``struct<field, compare, value>``."""
    pattern = CONDITION_TEXT.pattern
    field, compare, value = (F.regexp_extract(text, pattern, i) for i in (1, 2, 3))
    known = F.lower(compare).isin(*COMPARISONS)
    return F.when(
        known, F.struct(field.alias("field"), F.lower(compare).alias("compare"), value.alias("value"))
    ).otherwise(F.raise_error(F.concat(F.lit("not a condition: "), text)))


def condition_column(condition: Condition, data_type: DataType) -> Column:
    """Predicate on a column of the given type.

    The value is cast to the column's type, never the other way round, so the
    comparison reaches the file scan. A bare date against a timestamp means the
    whole day. Text is compared with a number as a number and with a bare date by
    its day; text that is neither does not fit such a condition.
    """
    column = F.col(condition.field)
    if isinstance(data_type, StringType):
        if NUMBER.match(condition.value):
            wide = "decimal(38,10)"
            return COMPARISONS[condition.compare](column.try_cast(wide), F.lit(condition.value).cast(wide))
        if DATE_ONLY.match(condition.value):
            day = F.lit(dt.date.fromisoformat(condition.value))
            return COMPARISONS[condition.compare](column.try_cast("date"), day)
    is_moment = isinstance(data_type, (TimestampType, TimestampNTZType))
    if is_moment and DATE_ONLY.match(condition.value):
        day = dt.date.fromisoformat(condition.value)
        start, end = F.lit(day), F.lit(day + dt.timedelta(days=1))
        return {
            "eq": (column >= start) & (column < end),
            "ne": (column < start) | (column >= end),
            "gt": column >= end,
            "lt": column < start,
            "ge": column >= start,
            "le": column < end,
        }[condition.compare]
    return COMPARISONS[condition.compare](column, F.lit(condition.value).cast(data_type))


def conditions_column(text: str, schema: StructType) -> Column:
    """Predicate: every condition in ``text`` holds."""
    parts = [condition_column(c, schema[c.field].dataType) for c in parse_conditions(text)]
    return functools.reduce(operator.and_, parts)


def filter_by(df: DataFrame, text: str) -> DataFrame:
    """Rows of ``df`` for which every condition in ``text`` holds."""
    return df.filter(conditions_column(text, df.schema))


def parse_window(text: str, as_of: dt.date) -> Window:
    """``field#unit#n``: the ``n`` units before yesterday, yesterday included."""
    parts = text.split("#")
    if len(parts) != 3:
        raise ValueError(f"not field#unit#amount: {text!r}")
    field, unit, amount = parts
    if unit not in UNIT_DAYS:
        raise ValueError(f"unknown unit {unit!r} in {text!r}")
    yesterday = as_of - dt.timedelta(days=1)
    return Window(field, yesterday - dt.timedelta(days=int(amount) * UNIT_DAYS[unit]), yesterday)


def window_text(window: Window) -> str:
    """The window as condition text."""
    return f"{window.field}[GE]{window.first},{window.field}[LE]{window.last}"


def may_be_in_years(text: Column, first: int, last: int) -> Column:
    """Whether date text can be in a range of years, by comparing text with constants.

    Date text starts with its year; what is put before a year (blanks, a sign,
    zeros) sorts below '1'. True for every date in the range, and for some others.
    """
    return ((text >= F.lit(str(first))) & (text < F.lit(str(last + 1)))) | (text < F.lit("1"))


def window_column(text: str, as_of: dt.date, data_type: DataType) -> Column:
    """Predicate on a column of the given type: its day falls into the relative window.

    Timestamps are compared with constants and so pushed to the scan. Text has
    to be read as a date; only the years of the window are pushed for it.
    """
    window = parse_window(text, as_of)
    column = F.col(window.field)
    if isinstance(data_type, StringType):
        inside = column.try_cast("date").between(F.lit(window.first), F.lit(window.last))
        years = window.first.year, window.last.year
        return may_be_in_years(column, *years) & inside if years[0] >= 1000 and years[1] < 9999 else inside
    if isinstance(data_type, DateType):
        return column.between(F.lit(window.first), F.lit(window.last))
    after = window.last + dt.timedelta(days=1)
    return (column >= F.lit(window.first)) & (column < F.lit(after))


def filter_window(df: DataFrame, text: str, as_of: dt.date) -> DataFrame:
    """Rows whose day falls into the relative window."""
    return df.filter(window_column(text, as_of, df.schema[text.split("#")[0]].dataType))
