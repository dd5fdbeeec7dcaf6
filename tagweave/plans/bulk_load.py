"""Load of tab-separated files into a sorted table of cells."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tagweave.sinks.bulk import write_sorted
from tagweave.sources.layouts import layout
from tagweave.storage import stage


def bulk_load(
    spark: SparkSession,
    data_type: int | str | list[str],
    family: str,
    source: str,
    target: str,
    *,
    replace: bool = False,
) -> DataFrame:
    """Add the files at ``source`` to the cell table at ``target``, or put them in its place.

    ``data_type`` is the number of a known layout or a list of field names, the
    key first. The text is read and taken apart once and staged; good lines and
    the rejected ones, which are returned, come from there.
    """
    fields = data_type if isinstance(data_type, list) else layout(data_type)
    parts = F.split("value", "\t", -1)
    lines = spark.read.text(source).select("value", parts.alias("parts"), F.monotonically_increasing_id().alias("_place"))
    good = F.size("parts") == len(fields)
    lines = stage(lines.select(F.when(~good, F.col("value")).alias("value"), "parts", "_place"), "lines")
    rows = lines.filter(good).select(*[F.get("parts", i).alias(f) for i, f in enumerate(fields)], "_place")
    write_sorted(rows, fields[0], family, target, place="_place", replace=replace)
    return lines.filter(~good).select("value", F.size("parts").alias("found"))
