"""Bulk load of wide rows into a table of cells kept in row-key order.

A table of cells is a folder with one folder for each load, ``load=1``,
``load=2``, ...: a load adds to what is there. Its files are written under a
hidden name first and appear all at once by a rename, so a load that fails
leaves the table as it was. Cells carry their ``place`` in the loaded lines;
of several cells for one field the latest load counts, and in it the last line.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from tagweave.sources.cells import rows_to_cells
from tagweave.storage import file_system

LOAD = "load="


def sorted_cells(rows: DataFrame, key: str, family: str, place: str | None = None) -> DataFrame:
    """Cells of ``rows``, range-partitioned by row key and sorted in each partition.

    Whole rows are moved and only then taken apart, so a row is shuffled once
    and not once per field. The source partition is part of the range: rows that
    share a key, copies included, can be spread over several partitions. A column
    ``place`` is no field; it goes with every cell of its row.
    """
    fields = [c for c in rows.columns if c != place]
    ranged = rows.withColumn("_from", F.spark_partition_id()).repartitionByRange(
        F.col(key).cast("string"), F.xxhash64(*fields), "_from"
    )
    cells = rows_to_cells(ranged.drop("_from"), key, family, fields, [place] if place else [])
    return cells.sortWithinPartitions("rowkey", "qualifier")


def loads(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the complete loads of a table."""
    fs, folder = file_system(spark, path)
    if not fs.exists(folder):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(folder)]
    return sorted(int(n[len(LOAD) :]) for n in names if n.startswith(LOAD))


def write_sorted(
    rows: DataFrame, key: str, family: str, path: str, *, place: str | None = None, replace: bool = False
) -> int:
    """Add the sorted cells of ``rows`` to the table at ``path`` and return the number of the load.

    With ``replace`` the earlier loads are removed once the new one is there.
    """
    spark = rows.sparkSession
    fs, hidden = file_system(spark, f"{path}/_loading-{uuid.uuid4().hex}")
    sorted_cells(rows, key, family, place).write.parquet(hidden.toString())
    before = loads(spark, path)
    number = (before or [0])[-1] + 1
    # A load that was published meanwhile has the number: its folder is never renamed into.
    while not _publish(spark, hidden.toString(), f"{path}/{LOAD}{number}"):
        number += 1
    for old in before if replace else []:
        fs.delete(file_system(spark, f"{path}/{LOAD}{old}")[1], True)
    return number


def _publish(spark: SparkSession, hidden: str, final: str) -> bool:
    """Claim a load number by creating a marker that can be made once only, then rename."""
    fs, target = file_system(spark, final)
    claim = file_system(spark, final.replace(f"/{LOAD}", "/_claim-"))[1]
    if fs.exists(target) or not fs.createNewFile(claim):
        return False
    if fs.exists(target) or not fs.rename(file_system(spark, hidden)[1], target):
        raise OSError(f"the load could not be published as {final}")
    return True
