"""Wide-column tables as rows of cells: ``rowkey, family, qualifier, value``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

CELL_COLUMNS = ["rowkey", "family", "qualifier", "value"]
# Which cell is newer, where a table says so: the load, then the place of the line in it.
VERSION_COLUMNS = ["load", "_place"]


def rows_to_cells(
    rows: DataFrame, key: str, family: str, fields: list[str] | None = None, extra: list[str] | None = None
) -> DataFrame:
    """One cell per non-null field, fields in dictionary order; the key is a field too.

    ``extra`` columns are repeated with every cell of their row.
    """
    cells = F.array(
        *[
            F.struct(F.lit(f).alias("qualifier"), F.col(f).cast("string").alias("value"))
            for f in sorted(fields or rows.columns)
        ]
    )
    return rows.select(
        F.col(key).cast("string").alias("rowkey"), F.lit(family).alias("family"), F.inline(cells), *(extra or [])
    ).filter(F.col("value").isNotNull())


def cells_to_rows(
    cells: DataFrame, family: str, fields: list[str], key: str = "rowkey", version: str | Column | None = None
) -> DataFrame:
    """One row per row key with the listed fields as text; a missing cell is null.

    A row key without any of the fields gives no row, as in a scan of those columns.
    Of several cells for one field the one with the highest ``version`` counts,
    without versions the greatest value. Cells of a key are folded where they
    are read, before the one shuffle on the key.
    """
    wanted = cells.filter((F.col("family") == family) & F.col("qualifier").isin(fields))

    def cell(field: str):
        mine = F.col("qualifier") == field
        if version is None:
            return F.max(F.when(mine, F.col("value")))
        at = F.col(version) if isinstance(version, str) else version
        return F.max(F.when(mine, F.struct(at.alias("at"), "value")))["value"]

    return wanted.groupBy(F.col("rowkey").alias(key)).agg(*[cell(f).alias(f) for f in fields])
