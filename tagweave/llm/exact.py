"""Exact deduplication: a 128-bit content hash, bytes compared inside each group.

Nulls count as empty texts. Equal texts form one group whatever their other
columns say; of a group the row with the largest id stays (or the smallest).
Rows without an id stay only if no row of their group has one. Rows that repeat
an id and its text carry the same verdict; ``deduplicate`` keeps one of them.
Texts are hashed and compared whole, however long. An empty table gives an empty
result. Columns other than the two named ones are never read by ``duplicates`` and
are kept as they are by ``deduplicate``, whatever they are called.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tagweave.llm.common import content_hash, equal_texts, text_or_empty, with_plain_names
from tagweave.storage import stage


def duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", largest: bool = True, hashed=content_hash
) -> DataFrame:
    """One row per input row: ``id, keep_id, group_size, kept, text_sha256``.

    The texts are moved once, to be compared, and after the copies in each task
    have collapsed. What is joined back holds hashes and ids only, and only of
    groups of two or more.
    """
    found = equal_texts(docs, id_col, text_col, hashed, largest).filter("n > 1 or keep is null")
    groups = stage(found.withColumn("sha", F.sha2("text", 256)).drop("text"), "groups")
    # Different texts under one hash: told apart by their second digest as well.
    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    slim = rows.select("id", hashed(F.col("text")).alias("h"), F.sha2("text", 256).alias("sha"))
    joined = slim.join(groups, ["h", "sha"], "left")
    keep = F.coalesce("keep", "id")
    return joined.select(
        "id",
        keep.alias("keep_id"),
        F.coalesce("n", F.lit(1).cast("long")).alias("group_size"),
        F.col("id").eqNullSafe(keep).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", largest: bool = True) -> DataFrame:
    """The rows that stay, with all their columns: one for each different text."""
    verdicts = stage(duplicates(docs, id_col, text_col, largest), "verdicts")
    rows, row_id, text = with_plain_names(docs, id_col, text_col)
    key = [F.col("id").alias("of"), F.col("text_sha256").alias("sha")]
    leaving = verdicts.filter("not kept").select(*key).distinct()
    twice = verdicts.filter("kept and group_size > 1").groupBy(*key).count().filter("count > 1").drop("count")
    marked = rows.withColumn("own", F.sha2(text_or_empty(text), 256))
    here = F.col(row_id).eqNullSafe(F.col("of")) & (F.col("own") == F.col("sha"))
    staying = marked.join(leaving, here, "left_anti")
    if not twice.isEmpty():
        repeated = staying.join(twice, here, "left_semi").dropDuplicates([row_id, "own"])
        staying = staying.join(twice, here, "left_anti").unionByName(repeated)
    return staying.drop("own").toDF(*docs.columns)
