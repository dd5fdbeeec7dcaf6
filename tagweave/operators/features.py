"""Feature columns and the split into training and test rows."""

from __future__ import annotations

from pyspark.ml.feature import (
    Normalizer,
    VectorAssembler,
    VectorIndexer,
    VectorIndexerModel,
)
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window, functions as F

from tagweave.operators.lookup import is_small, join_lookup
from tagweave.operators.numbering import number_rows, number_small
from tagweave.storage import stage

#: Rows numbered together among equal ones.
LOT = 4096


def label_counts(df: DataFrame, column: str) -> DataFrame:
    """Values of a column as text with their number of rows."""
    value = F.col(column).cast("string").alias("value")
    return df.groupBy(value).agg(F.count(F.lit(1)).alias("n")).filter(F.col("value").isNotNull())


def string_index(df: DataFrame, column: str, index: str) -> DataFrame:
    """Add the rank of each value by frequency as a double, equal counts by value.

    The values are counted and numbered where they are, and joined back. A null
    value is an error.
    """
    counts = stage(label_counts(df, column), "labels")
    small = is_small(counts)
    places = (number_small if small else number_rows)(counts, "place", F.desc("n"), "value")
    numbered = places.select(F.col("value").alias("_text"), F.col("place").cast("double").alias(index))
    value = F.col(column).cast("string")
    joined = join_lookup(df, value, numbered, "_text", "left", small).drop("_text")
    unknown = F.raise_error(F.lit(f"null label in {column}")).cast("double")
    return joined.withColumn(index, F.coalesce(F.col(index), unknown))


def assemble_features(
    df: DataFrame, columns: list[str], features: str = "features", handle_invalid: str = "error"
) -> DataFrame:
    """Numeric columns as one vector; a null is an error unless skipped or kept."""
    assembler = VectorAssembler(
        inputCols=columns, outputCol=features, handleInvalid=handle_invalid
    )
    return assembler.transform(df)


def vector_from_array(df: DataFrame, column: str, features: str = "features") -> DataFrame:
    return df.withColumn(features, array_to_vector(F.col(column).cast("array<double>")))


def l2_normalize(df: DataFrame, column: str, features: str = "features") -> DataFrame:
    return Normalizer(inputCol=column, outputCol=features, p=2.0).transform(df)


def fit_vector_index(
    df: DataFrame, column: str, features: str, max_categories: int = 4
) -> VectorIndexerModel:
    """Find the vector slots with at most ``max_categories`` values and index those."""
    return VectorIndexer(inputCol=column, outputCol=features, maxCategories=max_categories).fit(df)


def in_training(key: str, fraction: float = 0.8) -> Column:
    """Whether a row is a training row, by a hash of its key: the same on every run and partitioning."""
    head = F.substring(F.md5(F.col(key).cast("string")), 1, 8)
    return F.conv(head, 16, 10).cast("bigint") < int(fraction * 2**32)


def numbered_copies(df: DataFrame, columns: list[str], key: str, copy: str) -> DataFrame:
    """Add a digest of each row's content in ``columns`` and the number of the copy among equal rows, from 1.

    The pairs are the same however the rows are partitioned: equal rows cannot be
    told apart, so it does not matter which of them has which number. Rows are
    numbered in lots of ``LOT`` rows that lie next to each other, and a lot goes
    on from the counts of the lots before, so equal rows never come together.
    """
    content = F.md5(F.to_json(F.struct(*columns)))
    lot = F.floor(F.monotonically_increasing_id() / LOT)
    marked = stage(df.withColumns({key: content, "_lot": lot}), "copies")
    counts = marked.groupBy(key, "_lot").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy(key).orderBy("_lot").rowsBetween(Window.unboundedPreceding, -1)
    earlier = F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_earlier")
    starts = counts.select(F.col(key).alias("_of"), F.col("_lot").alias("_in"), earlier)
    inside = F.row_number().over(Window.partitionBy(key, "_lot").orderBy(key))
    joined = marked.join(starts, (F.col(key) == F.col("_of")) & (F.col("_lot") == F.col("_in")))
    return joined.withColumn(copy, (F.col("_earlier") + inside).cast("int")).drop("_lot", "_of", "_in", "_earlier")


def stable_split(df: DataFrame, key: str, fraction: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """Training and test rows."""
    inside = in_training(key, fraction)
    return df.filter(inside), df.filter(~inside)
