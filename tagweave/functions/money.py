"""Money kept as text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

MONEY = "decimal(10,2)"


def money(amount: Column) -> Column:
    """Amount as decimal(10,2); unreadable or overflowing text is null."""
    return amount.try_cast(MONEY)


def bad_money(amount: Column) -> Column:
    """True where there is an amount that cannot be read."""
    return amount.isNotNull() & money(amount).isNull()


def clean_sum(df: DataFrame, key: str, amount: str) -> DataFrame:
    """Sum of the readable amounts per key, and how many were not readable."""
    return df.groupBy(key).agg(
        F.sum(money(F.col(amount))).alias("total"),
        F.count_if(bad_money(F.col(amount))).alias("bad_amounts"),
    )
