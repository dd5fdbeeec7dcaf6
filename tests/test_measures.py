"""Recency, frequency, money and engagement."""

import datetime as dt
from decimal import Decimal

import pytest

from tagweave.operators import measures

ORDERS = "memberid string, finishtime string, ordersn string, orderamount string"


def test_last_activity_is_numeric(spark):
    df = spark.createDataFrame([("u", "999999999"), ("u", "1562000000"), ("v", "x")], "u string, t string")
    assert sorted(map(tuple, measures.last_activity(df, "u", "t").collect())) == [("u", 1562000000), ("v", None)]
    texts = spark.createDataFrame([("u", "2019-6-9 01:00:00"), ("u", "2019-06-10 00:00:00")], "u string, t string")
    found = measures.last_activity(texts, "u", "t", "datetime").first()
    assert found.last_time == dt.datetime(2019, 6, 10)
    with pytest.raises(ValueError, match="julian"):
        measures.last_activity(df, "u", "t", "julian")


def test_rfm(spark):
    day = 86400
    rows = [
        ("a", str(10 * day), "1", "10.50"), ("a", str(9 * day + 5), None, "1"), ("a", "3", "3", "bad"),
        ("b", str(12 * day + 86399), "4", None),
    ]
    found = measures.rfm(spark.createDataFrame(rows, ORDERS), dt.date(1970, 1, 15), count_bad_amounts=True)
    assert {r.userId: tuple(r)[1:] for r in found.collect()} == {
        "a": (4, 2, Decimal("11.50"), 1), "b": (2, 1, None, 0),
    }
    assert dict(found.dtypes)["monetary"] == "decimal(20,2)"


def test_rfe(spark):
    rows = [
        ("a", "2024-01-10 23:00:00", "/x"), ("a", "2024-01-02 00:00:00", "/x"), ("a", "2024-01-03 00:00:00", None),
        ("b", "2024-01-31 00:00:00", "/y"),
    ]
    df = spark.createDataFrame(rows, "global_user_id string, log_time string, loc_url string")
    found = measures.rfe(df, dt.date(2024, 5, 10))
    assert {r.userId: tuple(r)[1:] for r in found.collect()} == {"a": (21, 2, 1), "b": (0, 1, 1)}


def test_as_of_defaults_to_now(spark):
    df = spark.createDataFrame([("a", "0", "1", "1")], ORDERS)
    days = (dt.datetime.now(dt.timezone.utc).date() - dt.date(1970, 1, 1)).days
    assert measures.rfm(df).first().recency in (days, days + 1)


def test_counts(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "x"), ("a", None), ("b", None)], "u string, p string")
    assert {tuple(r) for r in measures.event_frequency(df, "u", "p").collect()} == {("a", 2), ("b", 0)}
    assert {tuple(r) for r in measures.distinct_engagement(df, "u", "p").collect()} == {("a", 1), ("b", 0)}


def test_values_are_folded_before_the_shuffle(spark, plan_of):
    df = spark.range(3).selectExpr("id % 2 global_user_id", "timestamp_seconds(id) log_time", "id % 3 loc_url")
    plan = plan_of(measures.rfe(df, dt.date(2024, 5, 10)))
    assert plan.count("hashpartitioning(") == 2 and "hashpartitioning(userId" in plan
    assert "SortAggregate" not in plan and "Python" not in plan


def test_date_text_is_not_cast_to_a_number(spark):
    """A cast that fails costs an error a row: texts that cannot be numbers are told apart before it."""
    texts = ["5", " 7\t", "+8", "-9", "\n1562000000 ", "1.5", ".", "", " ", "+", "12x", "1 2", "2019", "2019-06-10", "2019-06-10 01:02:03",
             "never", "99999999999999999999", "253402300800", "9223372036854775807", "\x7f3\x00", " 4", "٣", "1e3", "--1", "5.", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string").repartition(1)
    seconds = "try_cast(t as bigint)"
    moment = f"if({seconds} between {measures.SECONDS[0]} and {measures.SECONDS[1]}, timestamp_seconds({seconds}), null)"
    plain = {"unix": seconds, "any": f"if({seconds} is null, try_cast(t as timestamp), {moment})"}
    for kind, sql in plain.items():
        read = measures.read_time(df, "t", kind)
        found = df.select("t", read.alias("found"), measures.F.expr(sql).alias("plain")).collect()
        assert [r for r in found if r.found != r.plain] == []
        plan = df.select(read)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.index("RLIKE") < plan.index("as bigint")
