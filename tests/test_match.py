"""Rule matching, with a broadcast and with a spread lookup."""

import pytest
from pyspark.sql import functions as F

from tagweave.operators import lookup, match

RULES = "rule string, tag_id bigint, tag_name string"


@pytest.fixture
def rules(spark):
    return spark.createDataFrame([("1", 319, "male"), ("2", 320, "female"), (None, 1, "none")], RULES)


@pytest.fixture
def users(spark):
    return spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "3"), ("d", None)], "id string, gender string")


@pytest.fixture(params=["broadcast", "spread"])
def strategy(request, monkeypatch):
    if request.param == "spread":
        monkeypatch.setattr(lookup, "BROADCAST_ROWS", 0)
    return request.param


def test_inner_drops_unmatched(users, rules, strategy):
    found = match.match_rules(users, "gender", rules, "inner")
    assert found.columns == ["id", "gender", "tag_id", "tag_name"]
    assert sorted(map(tuple, found.collect())) == [("a", "1", 319, "male"), ("b", "2", 320, "female")]


def test_left_keeps_unmatched(users, rules, strategy):
    found = match.match_rules(users, "gender", rules, "left")
    assert {r.id: r.tag_name for r in found.collect()} == {"a": "male", "b": "female", "c": None, "d": None}


def test_strict_match_fails_on_unmatched(users, rules, strategy, failing):
    failing(match.match_rules(users, "gender", rules, "left", on_missing="error"), "no rule for value: (3|null)")
    known = users.filter("gender in ('1', '2')")
    assert match.match_rules(known, "gender", rules, "left", on_missing="error").count() == 2


def test_repeated_rule_is_an_error(spark, users):
    rules = spark.createDataFrame([("1", 1, "x"), ("1", 2, "y")], RULES)
    with pytest.raises(ValueError, match="'1'"):
        match.match_rules(users, "gender", rules)


def test_wrong_options(users, rules):
    with pytest.raises(ValueError, match="outer"):
        match.match_rules(users, "gender", rules, "outer")
    with pytest.raises(ValueError, match="drop"):
        match.match_rules(users, "gender", rules, "left", on_missing="drop")


def test_numeric_attribute_and_like_named_columns(spark, rules, strategy):
    users = spark.createDataFrame([(1, "r", "n"), (2, "r", "n")], "gender int, rule string, name string")
    found = match.match_rules(users, "gender", rules)
    assert sorted(map(tuple, found.collect())) == [(1, "r", "n", 319, "male"), (2, "r", "n", 320, "female")]


def test_plan_by_size(spark, users, rules, strategy, plan_of):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(match.match_rules(users, "gender", rules))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert ("SortMergeJoin" in plan) == (strategy == "spread")


@pytest.fixture
def fixed_tasks(spark):
    for key, value in (("autoBroadcastJoinThreshold", "-1"), ("adaptive.enabled", "false")):
        spark.conf.set(f"spark.sql.{key}", value)
    yield
    for key in ("autoBroadcastJoinThreshold", "adaptive.enabled"):
        spark.conf.unset(f"spark.sql.{key}")


@pytest.mark.parametrize("how", ["inner", "left"])
def test_hot_values_are_dealt_to_many_tasks(spark, monkeypatch, fixed_tasks, how):
    """A third of the rows has one value and a third none."""
    monkeypatch.setattr(lookup, "BROADCAST_ROWS", 0)
    rules = spark.range(0, 400, 2).selectExpr("cast(id as string) rule", "id tag_id", "concat('t', id) tag_name")
    users = spark.range(6000, numPartitions=8).selectExpr(
        "id", "case id % 3 when 0 then '2' when 1 then cast(id % 400 as string) end v"
    )
    joined = match.match_rules(users, "v", rules, how)
    found = {r.id: (r.v, r.tag_name) for r in joined.collect()}
    expected = {}
    for i in range(6000):
        v = {0: "2", 1: str(i % 400), 2: None}[i % 3]
        name = f"t{v}" if v and int(v) % 2 == 0 else None
        if name or how == "left":
            expected[i] = (v, name)
    assert found == expected and joined.count() == len(expected)
    sizes = sorted(r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect())
    assert sizes[-1] < 2 * len(expected) / 8


def test_any_number_of_frequent_values(spark, monkeypatch, fixed_tasks, tmp_path):
    """5,000 values that all count as frequent, against 6,000 rules; the source is read once."""
    monkeypatch.setattr(lookup, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(lookup, "SPLIT", 1000)
    folder, staged, stage = str(tmp_path / "users"), {}, lookup.stage
    monkeypatch.setattr(lookup, "stage", lambda df, label: staged.setdefault(label, stage(df, label)))
    spark.range(55_000).selectExpr("id", "cast(id % 5000 as string) v").write.parquet(folder)
    rules = spark.range(6000).selectExpr("cast(id as string) rule", "id tag_id", "concat('t', id) tag_name")
    joined = match.match_rules(spark.read.parquet(folder), "v", rules)
    assert joined.count() == 55_000 and joined.filter("tag_id <> id % 5000 or tag_name <> concat('t', v)").isEmpty()
    assert lookup.frequent_values(staged["rows"], "_value").count() == 5000
    assert not any(folder in f for f in joined.inputFiles())


def test_no_rows_against_a_large_table(spark, monkeypatch):
    monkeypatch.setattr(lookup, "BROADCAST_ROWS", 0)
    rules = spark.range(4).selectExpr("cast(id as string) rule", "id tag_id", "'t' tag_name")
    assert match.match_rules(spark.range(0).selectExpr("id", "'1' v"), "v", rules, "left").collect() == []


def test_unmatched_values(users, rules):
    found = match.unmatched_values(users, "gender", rules)
    assert sorted(map(tuple, found.collect()), key=str) == [("3", 1), (None, 1)]
