"""Business tables named by a level-4 rule."""

from __future__ import annotations

import datetime as dt
import functools
import operator
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructType

from tagweave.functions.conditions import conditions_column, parse_conditions, window_column
from tagweave.sources.catalog import source_rule
from tagweave.sources.cells import CELL_COLUMNS, VERSION_COLUMNS, cells_to_rows
from tagweave.sources.layouts import text_schema

TableResolver = Callable[[str], DataFrame]


class SourceDescriptor(NamedTuple):
    """Where the rows of a tag come from."""

    kind: str
    location: str
    fields: list[str]
    family: str | None
    window: str | None
    conditions: str | None
    options: dict[str, str]


# Rule keys handed on to a database read; the last five split it into parallel ranges.
JDBC_KEYS = (
    "url", "driver", "user", "password",
    "fetchsize", "partitionColumn", "lowerBound", "upperBound", "numPartitions",
)

# Key that names the input, by kind of source.
LOCATION_KEY = {"hbase": "hbaseTable", "table": "table", "parquet": "path", "jdbc": "dbtable"}


def describe_source(rule: dict[str, str]) -> SourceDescriptor:
    """Check a parsed rule and turn it into a source descriptor."""

    def required(key: str) -> str:
        if not rule.get(key):
            raise ValueError(f"rule has no {key!r}")
        return rule[key]

    kind = required("inType").lower()
    if kind not in LOCATION_KEY:
        raise ValueError(f"unknown inType {kind!r}, expected one of {sorted(LOCATION_KEY)}")
    return SourceDescriptor(
        kind=kind,
        location=required(LOCATION_KEY[kind]),
        fields=required("selectFieldNames").split(","),
        family=rule.get("family"),
        window=rule.get("whereCondition"),
        conditions=rule.get("filterConditions"),
        options={k: v for k, v in rule.items() if k in JDBC_KEYS},
    )


def open_rows(
    spark: SparkSession, sources: list[SourceDescriptor], tables: TableResolver | None = None
) -> DataFrame:
    """All rows of the one place that ``sources`` name, with the types they have there.

    Named tables come from ``tables`` (``spark.table`` by default). A table of
    cells is put together into rows of the fields that the sources ask for.
    """
    source = sources[0]
    if source.kind == "parquet":
        return spark.read.parquet(source.location)
    if source.kind == "jdbc":
        return spark.read.format("jdbc").options(dbtable=source.location, **source.options).load()
    df = (tables or spark.table)(source.location)
    if not (source.family and set(CELL_COLUMNS) <= set(df.columns)):
        return df
    asked: list[str] = []
    for each in sources:
        asked += each.fields
        asked += [each.window.split("#")[0]] if each.window else []
        asked += [c.field for c in parse_conditions(each.conditions)] if each.conditions else []
    newest = [F.col(c) for c in VERSION_COLUMNS if c in df.columns]
    version = F.struct(*newest) if newest else None
    return cells_to_rows(df, source.family, list(dict.fromkeys(asked)), version=version)


def source_filter(source: SourceDescriptor, schema: StructType, as_of: dt.date | None = None) -> Column | None:
    """The window and the conditions of a source on its typed columns; None where it has neither."""
    parts = []
    if source.window:
        parts.append(window_column(source.window, as_of or dt.date.today(), schema[source.window.split("#")[0]].dataType))
    if source.conditions:
        parts.append(conditions_column(source.conditions, schema))
    return functools.reduce(operator.and_, parts) if parts else None


def unreadable_window(source: SourceDescriptor, schema: StructType) -> Column | None:
    """Rows whose window field is text that is no date; None unless that can happen."""
    field = source.window and source.window.split("#")[0]
    if not field or not isinstance(schema[field].dataType, StringType):
        return None
    return F.col(field).isNotNull() & F.col(field).try_cast("date").isNull()


def read_source(
    spark: SparkSession,
    source: SourceDescriptor,
    *,
    as_of: dt.date | None = None,
    tables: TableResolver | None = None,
    as_text: bool = True,
) -> DataFrame:
    """The fields of a source, as text or with their own types, filtered by its conditions.

    Filters are applied to the typed columns, below the projection, so that they
    reach the scan.
    """
    df = open_rows(spark, [source], tables)
    chosen = source_filter(source, df.schema, as_of)
    if chosen is not None:
        df = df.filter(chosen)
    if not as_text:
        return df.select(*source.fields)
    declared = text_schema(source.fields)
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in declared])


def read_business(
    spark: SparkSession,
    tags: DataFrame,
    *,
    as_of: dt.date | None = None,
    tables: TableResolver | None = None,
) -> DataFrame:
    """The business table that the level-4 row of ``tags`` names."""
    return read_source(spark, describe_source(source_rule(tags)), as_of=as_of, tables=tables)
