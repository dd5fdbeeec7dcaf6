"""What several corpus operators share: reading a table's columns, equal texts by bytes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: A word is a longest run of characters outside this class.
SPACE = r"\x20\x09-\x0D"
WORD = rf"[^{SPACE}]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def with_plain_names(docs: DataFrame, *names: str) -> tuple[DataFrame, ...]:
    """``docs`` with its columns called c0, c1, ..., and what some are called now: no name of theirs can clash with others.

    ``toDF(*docs.columns)`` gives the old names back.
    """
    known = [c.lower() for c in docs.columns]
    return docs.toDF(*[f"c{i}" for i in range(len(known))]), *[f"c{known.index(n.lower())}" for n in names]


def content_hash(text: Column) -> Column:
    """128 bits of a text's UTF-8 bytes, as 16 bytes."""
    return F.unhex(F.md5(text))


def equal_texts(rows: DataFrame, id_col: str, text_col: str, hashed=content_hash, largest: bool = True) -> DataFrame:
    """Classes of rows with equal bytes: ``h, text, n, keep``.

    Rows are grouped by hash and, inside a hash, by the bytes themselves, so texts
    that only share a hash are two classes. Copies collapse
    in the task that reads them, before anything is moved: a text that makes up a
    third of all rows arrives as one row per task. ``keep`` is the largest (or
    smallest) id, null only when no row of the class has one.
    """
    keep = F.max("id") if largest else F.min("id")
    texts = rows.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    classes = (
        texts.withColumn("h", hashed(F.col("text")))
        .groupBy("h", "text")
        .agg(F.count(F.lit(1)).alias("n"), keep.alias("keep"))
    )
    return classes
