"""Positions and running totals over a whole table, without bringing its rows together.

The rows are range-partitioned and sorted, written once with the number of their
partition and their place in it, and each partition gets the totals of those
before it: one small row per partition. Ties in the order columns are broken by
where the rows come from, so name enough columns to make the order total when
equal rows must get the same numbers in every run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tagweave.storage import stage

_PART, _PLACE = "__part", "__place"


def in_order(df: DataFrame, *order: Column | str, label: str = "ordered") -> DataFrame:
    """The rows range-partitioned and sorted by ``order``, staged with partition and place."""
    df = df.repartitionByRange(*order).sortWithinPartitions(*order)
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return stage(df.withColumns({_PART: F.spark_partition_id(), _PLACE: place}), label)


def number_rows(
    df: DataFrame,
    name: str,
    *order: Column | str,
    running: dict[str, Column] | None = None,
) -> DataFrame:
    """Add the position of each row in ``order``, from 0, and exclusive running sums.

    ``running`` maps new columns to long expressions over columns of ``df``; each
    row gets the sum over all rows before it. The result has no null in the added
    columns; a null expression counts as 0.
    """
    running = running or {}
    staged = in_order(df, *order)
    sums = {f"__sum_{c}": F.coalesce(e, F.lit(0)).cast("long") for c, e in running.items()}
    staged = staged.withColumns(sums)
    totals = staged.groupBy(_PART).agg(
        F.count(F.lit(1)).alias("__rows"), *[F.sum(c).alias(c) for c in sums]
    )
    # One row per partition.
    before = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    starts = totals.select(
        F.col(_PART).alias("__of"),
        F.coalesce(F.sum("__rows").over(before), zero).alias("__start"),
        *[F.coalesce(F.sum(c).over(before), zero).alias(f"{c}_start") for c in sums],
    )
    joined = staged.join(F.broadcast(starts), F.col(_PART) == F.col("__of"))
    columns = {name: F.col("__start") + F.col(_PLACE)}
    if sums:
        inside = Window.partitionBy(_PART).orderBy(_PLACE).rowsBetween(Window.unboundedPreceding, -1)
        for c in running:
            own = F.coalesce(F.sum(f"__sum_{c}").over(inside), zero)
            columns[c] = F.col(f"__sum_{c}_start") + own
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], *[e.alias(c) for c, e in columns.items()])


def number_small(df: DataFrame, name: str, *order: Column | str) -> DataFrame:
    """The same positions for a table of known small size, in one task and without staging it."""
    return df.withColumn(name, F.row_number().over(Window.orderBy(*order)).cast("long") - 1)
