"""Joining many rows to a lookup with one row per value."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, StringType

from tagweave.storage import local_copy, stage

# A lookup is sent to every executor only when it is no larger than this.
BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 16 * 1024 * 1024
# With a larger lookup a value is dealt to several tasks from this part of a task's even share on.
SPLIT = 16


def row_bytes(lookup: DataFrame) -> Column:
    """Rough size of a row: the length of its texts, 16 bytes for anything else of fixed width."""
    texts = [f.name for f in lookup.schema if isinstance(f.dataType, StringType)]
    arrays = [f.name for f in lookup.schema if isinstance(f.dataType, ArrayType)]
    width = F.lit(16 * len(lookup.columns))
    for name in texts:
        width = width + F.coalesce(F.octet_length(name), F.lit(0))
    for name in arrays:
        width = width + 16 * F.coalesce(F.size(name), F.lit(0))
    return width


def fits_broadcast(rows: int | None, size: int | None) -> bool:
    return (rows or 0) <= BROADCAST_ROWS and (size or 0) <= BROADCAST_BYTES


def is_small(lookup: DataFrame) -> bool:
    """Whether a lookup may be broadcast, by counting it."""
    found = lookup.agg(F.count(F.lit(1)).alias("n"), F.sum(row_bytes(lookup)).alias("size")).first()
    return fits_broadcast(found.n, found.size)


def frequent_values(rows: DataFrame, value: str) -> DataFrame:
    """Values (null among them) with more rows than a ``SPLIT``-th of a task's share, and their number of salts.

    There are fewer than ``SPLIT`` times the shuffle partitions of them, whatever
    the rows look like.
    """
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = stage(rows.groupBy(F.col(value).alias("_hot")).agg(F.count(F.lit(1)).alias("n")), "counts")
    total = counts.agg(F.sum("n")).first()[0] or 0
    share = max(1, total // (SPLIT * tasks))
    return counts.filter(F.col("n") > share).select("_hot", F.ceil(F.col("n") / share).cast("int").alias("_salts"))


def join_lookup(
    rows: DataFrame, value: Column, lookup: DataFrame, key: str, how: str, small: bool
) -> DataFrame:
    """Inner or left join of ``rows`` to ``lookup``, which has one row per ``key``.

    A small lookup is broadcast. With a larger one the rows are staged, so that
    their source is read once, and values are counted there. Rows of a frequent
    value are dealt to tasks by a salt, in proportion to their number, and meet a
    copy of their lookup row in each; rows without a value are dealt in the same
    way. So no task gets many rows of one value, and no value is treated apart.
    """
    if small:
        return rows.join(F.broadcast(lookup), value == F.col(key), how)
    marked = rows.withColumn("_value", value)
    staged = stage(marked.filter(F.col("_value").isNotNull()) if how == "inner" else marked, "rows")
    # Fewer than SPLIT rows for each shuffle partition.
    hot = F.broadcast(local_copy(frequent_values(staged, "_value")))
    dealt = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.col("_salts"))
    salted = staged.join(hot, F.col("_value").eqNullSafe(F.col("_hot")), "left")
    salted = salted.withColumn("_salt", F.coalesce(dealt, F.lit(0)).cast("int")).drop("_hot", "_salts")
    copies = lookup.join(hot, F.col(key) == F.col("_hot"), "left")
    salts = F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)
    copies = copies.withColumn("_copy", F.explode(salts)).drop("_hot", "_salts")
    joined = salted.join(copies, (F.col("_value") == F.col(key)) & (F.col("_salt") == F.col("_copy")), how)
    return joined.drop("_value", "_salt", "_copy")
