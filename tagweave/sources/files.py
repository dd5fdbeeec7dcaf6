"""Text inputs: CSV with a declared schema, LibSVM, tab-separated lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType


def read_csv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Comma-separated UTF-8 text without a header; the schema is never inferred."""
    return spark.read.schema(schema).csv(
        path, sep=",", encoding="UTF-8", header=False, inferSchema=False
    )


def read_libsvm(spark: SparkSession, path: str, num_features: int | None = None) -> DataFrame:
    """LibSVM text as ``label double, features vector``.

    Without ``num_features`` Spark scans the input once more to find the width.
    """
    reader = spark.read.format("libsvm")
    if num_features is not None:
        reader = reader.option("numFeatures", num_features)
    return reader.load(path)


def _split(line: Column) -> Column:
    return F.split(line, "\t", -1)


def parse_tsv(lines: DataFrame, fields: list[str], line: str = "value") -> DataFrame:
    """Tab-separated lines as text columns; empty fields are kept, other arities are left out."""
    parts = _split(F.col(line))
    named = [F.get(F.col("parts"), i).alias(name) for i, name in enumerate(fields)]
    return (
        lines.filter(F.col(line).isNotNull())
        .select(parts.alias("parts"))
        .filter(F.size("parts") == len(fields))
        .select(*named)
    )


def rejected_lines(lines: DataFrame, fields: list[str], line: str = "value") -> DataFrame:
    """The lines ``parse_tsv`` leaves out, with the number of fields found."""
    found = F.size(_split(F.col(line)))
    return (
        lines.filter(F.col(line).isNotNull())
        .select(F.col(line), found.alias("found"))
        .filter(F.col("found") != len(fields))
    )


def read_tsv(spark: SparkSession, path: str, fields: list[str]) -> DataFrame:
    return parse_tsv(spark.read.text(path), fields)
