"""The tag catalogue: ``id, pid, name, rule, level``.

A level-4 row is a tag and says where its input is; its level-5 children are the
values the tag can take.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tagweave.functions.rules import rule_map

# Name and columns of the catalogue table in a database.
CATALOG_TABLE = "tbl_basic_tag"
CATALOG_COLUMNS = ["id", "name", "rule", "level"]


def tag_subtree(catalog: DataFrame, tag_id: int) -> DataFrame:
    """A tag and its values, by level and id."""
    mine = (F.col("id") == tag_id) | (F.col("pid") == tag_id)
    return catalog.filter(mine).select(*CATALOG_COLUMNS).distinct().orderBy("level", "id")


def subtree_query(tag_id: int, table: str = CATALOG_TABLE) -> str:
    """The same subtree as a derived table a database can evaluate."""
    columns = ", ".join(CATALOG_COLUMNS)
    tag = int(tag_id)
    return f"(SELECT DISTINCT {columns} FROM {table} WHERE id = {tag} OR pid = {tag}) basic_tag"


def read_catalog_jdbc(
    spark: SparkSession, url: str, tag_id: int, table: str = CATALOG_TABLE, **properties: str
) -> DataFrame:
    """The subtree of a tag, read from a database table."""
    found = spark.read.jdbc(url, subtree_query(tag_id, table), properties=properties)
    return found.orderBy("level", "id")


def read_catalog_rows(spark: SparkSession, url: str, table: str = CATALOG_TABLE, **properties: str) -> DataFrame:
    """The catalogue of a database table; conditions on ``id`` and ``pid`` are evaluated there."""
    return spark.read.jdbc(url, table, properties=properties).select("pid", *CATALOG_COLUMNS)


def value_rules(tags: DataFrame) -> DataFrame:
    """Level-5 rows: what a value is matched by, and the tag it stands for."""
    return tags.filter(F.col("level") == 5).select(
        "rule", F.col("id").alias("tag_id"), F.col("name").alias("tag_name")
    )


def source_rule(tags: DataFrame) -> dict[str, str]:
    """The parsed rule of the level-4 row; an error when there is none."""
    rows = tags.filter(F.col("level") == 4).orderBy("id").select(rule_map("rule").alias("rule"))
    first = rows.first()
    if first is None or first.rule is None:
        raise ValueError("the tag has no level-4 row with a rule")
    return first.rule
