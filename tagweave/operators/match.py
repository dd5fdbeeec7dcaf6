"""Rule matching: an attribute of a user against the values of a tag."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tagweave.operators.lookup import fits_broadcast, join_lookup, row_bytes


def checked_rules(rules: DataFrame) -> tuple[DataFrame, bool]:
    """Rules that have a value, and whether they are small enough to broadcast.

    A value that occurs twice would tag a user twice: that is an error.
    """
    present = rules.filter(F.col("rule").isNotNull())
    size = (
        present.groupBy("rule")
        .agg(F.count(F.lit(1)).alias("n"), F.sum(row_bytes(present)).alias("bytes"))
        .agg(
            F.sum("n").alias("rows"),
            F.sum("bytes").alias("bytes"),
            F.min(F.when(F.col("n") > 1, F.col("rule"))).alias("repeated"),
        )
        .first()
    )
    if size.repeated is not None:
        raise ValueError(f"rule value {size.repeated!r} belongs to more than one tag")
    return present, fits_broadcast(size.rows, size.bytes)


def match_rules(
    rows: DataFrame, attribute: str, rules: DataFrame, how: str = "inner", on_missing: str = "null"
) -> DataFrame:
    """Add ``tag_id`` and ``tag_name`` of the rule equal to ``attribute``.

    ``inner`` drops rows without a rule, ``left`` keeps them with a null tag or,
    with ``on_missing="error"``, fails on them.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"unknown join {how!r}")
    if on_missing not in ("null", "error"):
        raise ValueError(f"unknown on_missing {on_missing!r}")
    rules, small = checked_rules(rules)
    value = F.col(attribute).cast("string")
    lookup = rules.select(F.col("rule").alias("_rule"), "tag_id", "tag_name")
    joined = join_lookup(rows, value, lookup, "_rule", how, small)
    name = F.col("tag_name")
    if on_missing == "error":
        message = F.concat(F.lit("no rule for value: "), F.coalesce(value, F.lit("null")))
        name = F.when(F.col("_rule").isNull(), F.raise_error(message)).otherwise(name)
    return joined.select(*rows.columns, "tag_id", name.alias("tag_name"))


def unmatched_values(rows: DataFrame, attribute: str, rules: DataFrame) -> DataFrame:
    """Attribute values no rule names, with their number of rows.

    Rows are counted per value first, so the join sees one row per value.
    """
    value = F.col(attribute).cast("string")
    counts = rows.groupBy(value.alias("value")).agg(F.count(F.lit(1)).alias("n"))
    return counts.join(rules, F.col("value") == F.col("rule"), "left_anti")
