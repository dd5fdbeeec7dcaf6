"""Per-user measures: recency, frequency, money, engagement.

Each is one grouped aggregation. Values are folded where they are read, so a
user with a third of all rows sends no more to the shuffle than any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import NumericType, StringType

from tagweave.functions.dates import AsOf, as_of_column, unix_moment
from tagweave.functions.money import bad_money, money


#: Unix seconds of the years 1 to 9999.
SECONDS = (-62135596800, 253402300799)
#: All that a cast to a whole number may take: ``try_cast`` raises and catches an error for each text it cannot read.
MAYBE_NUMBER = r"^[\x00-\x20\x7F]*[+-]?[0-9]*(\.[0-9]*)?[\x00-\x20\x7F]*$"


def read_time(df: DataFrame, time: str, text_time: str) -> Column:
    """The time of a row so that times compare: unix seconds, or a date or timestamp.

    Text is read before it is compared, since '999' sorts after '1562000000':
    as unix seconds (``text_time="unix"``), as a date and time (``"datetime"``),
    or as whichever of the two it is (``"any"``). Text that is neither is null.
    Numbers are unix seconds.
    """
    kind = df.schema[time].dataType
    if isinstance(kind, NumericType):
        return F.col(time).cast("bigint")
    if not isinstance(kind, StringType):
        return F.col(time)
    # Date text would cost an error a row; only what may be a number is cast.
    number, seconds, moment = F.col(time).rlike(MAYBE_NUMBER), F.col(time).try_cast("bigint"), F.col(time).try_cast("timestamp")
    if text_time == "unix":
        return F.when(number, seconds)
    if text_time == "datetime":
        return moment
    if text_time == "any":
        counted = F.when(seconds.between(*SECONDS), unix_moment(seconds))
        return F.when(number, F.coalesce(counted, F.when(seconds.isNull(), moment))).otherwise(moment)
    raise ValueError(f"unknown text_time {text_time!r}")


def latest(df: DataFrame, time: str, text_time: str) -> tuple[Column, Column]:
    """The time of a row, and the day of the latest one of a group, as an aggregate."""
    newest = F.max(F.col("last_time"))
    kind = df.schema[time].dataType
    seconds = isinstance(kind, NumericType) or (isinstance(kind, StringType) and text_time == "unix")
    return read_time(df, time, text_time), F.to_date(unix_moment(newest) if seconds else newest)


def last_activity(df: DataFrame, user: str, time: str, text_time: str = "unix") -> DataFrame:
    """``userId`` and the latest time, as seconds or as a timestamp."""
    read, _ = latest(df, time, text_time)
    return df.select(F.col(user).alias("userId"), read.alias("last_time")).groupBy("userId").agg(
        F.max("last_time").alias("last_time")
    )


def event_frequency(df: DataFrame, user: str, counted: str) -> DataFrame:
    """``userId`` and the number of rows where ``counted`` is not null."""
    return df.groupBy(F.col(user).alias("userId")).agg(F.count(counted).alias("frequency"))


def distinct_engagement(df: DataFrame, user: str, counted: str) -> DataFrame:
    """``userId`` and the exact number of distinct ``counted`` values."""
    return df.groupBy(F.col(user).alias("userId")).agg(
        F.count_distinct(counted).alias("engagements")
    )


def days_between(end: Column, start: Column) -> Column:
    return F.datediff(end, start).cast("bigint")


def rfm(
    orders: DataFrame,
    as_of: AsOf = None,
    *,
    user: str = "memberid",
    time: str = "finishtime",
    order: str = "ordersn",
    amount: str = "orderamount",
    text_time: str = "unix",
    count_bad_amounts: bool = False,
) -> DataFrame:
    """Days since the last order, number of orders and money spent, per user."""
    read, day = latest(orders, time, text_time)
    columns = orders.select(
        F.col(user).alias("userId"),
        read.alias("last_time"),
        F.col(order).alias("order"),
        money(F.col(amount)).alias("amount"),
        bad_money(F.col(amount)).alias("bad_amount"),
    )
    measures = [
        days_between(as_of_column(as_of), day).alias("recency"),
        F.count("order").alias("frequency"),
        F.sum("amount").alias("monetary"),
    ]
    if count_bad_amounts:
        measures.append(F.count_if("bad_amount").alias("bad_amounts"))
    return columns.groupBy("userId").agg(*measures)


def rfe(
    log: DataFrame,
    as_of: AsOf = None,
    *,
    user: str = "global_user_id",
    time: str = "log_time",
    page: str = "loc_url",
    text_time: str = "datetime",
    shift_days: int = 100,
) -> DataFrame:
    """Days since the last visit, page views and distinct pages, per user.

    Recency is taken at ``shift_days`` before ``as_of``. The distinct count is
    planned per (user, page) first, which splits a user with very many views.
    """
    read, day = latest(log, time, text_time)
    columns = log.select(
        F.col(user).alias("userId"), read.alias("last_time"), F.col(page).alias("page")
    )
    return columns.groupBy("userId").agg(
        days_between(F.date_sub(as_of_column(as_of), shift_days), day).alias("recency"),
        F.count("page").alias("frequency"),
        F.count_distinct("page").alias("engagements"),
    )
