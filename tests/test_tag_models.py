"""Whole tag models, from the catalogue to the stored profile."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tagweave.__main__ import run
from tagweave.plans import tag_models
from tagweave.sinks.profile import read_profile, versions

AS_OF = dt.date(2024, 6, 1)


@pytest.fixture
def catalog(spark):
    rule = "inType=hbase\nzkHosts=h\nhbaseTable={}\nfamily=detail\nselectFieldNames={}"
    rows = [
        (318, 1, "gender", rule.format("users", "id,gender"), 4),
        (319, 318, "male", "1", 5), (320, 318, "female", "2", 5),
        (321, 1, "job", rule.format("users", "id,job"), 4),
        (322, 321, "student", "1", 5), (323, 321, "teacher", "2", 5),
        (361, 1, "value", rule.format("orders", "memberid,finishtime,ordersn,orderamount"), 4),
        *[(362 + i, 361, n, str(i), 5) for i, n in enumerate(["high", "upper", "middle", "lower", "low"])],
        (367, 1, "activity", rule.format("logs", "global_user_id,log_time,loc_url"), 4),
        *[(368 + i, 367, n, str(i), 5) for i, n in enumerate(["very active", "active", "inactive", "very inactive"])],
    ]
    return spark.createDataFrame(rows, "id bigint, pid bigint, name string, rule string, level int")


@pytest.fixture
def tables(spark):
    """20 users, the higher the number the better: more, larger and later orders, more pages."""
    users = spark.range(20).select(
        "id", (F.col("id") % 3).alias("gender"), (F.col("id") % 4).alias("job")
    )
    numbers = spark.range(20).select("id", F.explode(F.sequence(F.lit(1), F.col("id").cast("int") * 15 + 1)).alias("n"))
    last = F.lit(dt.date(2024, 5, 31)) - F.make_dt_interval((F.lit(19) - F.col("id")).cast("int"))
    orders = numbers.select(
        F.col("id").alias("memberid"),
        F.unix_timestamp(last).alias("finishtime"),
        F.concat_ws("-", "id", "n").alias("ordersn"),
        (F.col("id") * 100 + 1).alias("orderamount"),
    )
    seen = F.lit(dt.date(2024, 2, 20)) - F.make_dt_interval((F.lit(19) - F.col("id")).cast("int") * 4)
    logs = numbers.select(
        F.col("id").alias("global_user_id"),
        F.date_format(seen, "yyyy-MM-dd HH:mm:ss").alias("log_time"),
        F.concat(F.lit("/"), "n").alias("loc_url"),
    )
    return {"users": users, "orders": orders, "logs": logs}.__getitem__


def test_all_models_fill_one_profile(spark, catalog, tables, tmp_path):
    base = str(tmp_path / "profile")
    for tag_id in tag_models.TAG_MODELS:
        tag_models.run_tag(catalog, tag_id, base, as_of=AS_OF, tables=tables)
    found = {int(r.userId): r for r in read_profile(spark, base).collect()}
    assert sorted(found) == list(range(20))
    for i, row in found.items():
        assert row.gender == {1: "male", 2: "female"}.get(i % 3)
        assert row.job == {1: "student", 2: "teacher"}.get(i % 4)
    order = ["high", "upper", "middle", "lower", "low"]
    ranks = [order.index(found[i].rfm) for i in range(20)]
    assert ranks == sorted(ranks, reverse=True) and ranks[0] == 4 and ranks[-1] == 0
    activity = ["very active", "active", "inactive", "very inactive"]
    ranks = [activity.index(found[i].rfe) for i in range(20)]
    assert ranks == sorted(ranks, reverse=True) and ranks[0] == 3 and ranks[-1] == 0


def test_gender_drops_and_job_keeps_users_without_a_tag(catalog, tables):
    rows = tables("users").selectExpr("id", "cast(gender as string) gender", "cast(job as string) job")
    tags = catalog.filter("pid = 318 or id = 318")
    assert tag_models.tag_gender(rows, tags).count() == 13
    jobs = tag_models.tag_job(rows, catalog.filter("pid = 321 or id = 321"))
    assert jobs.columns == ["userId", "tag_id", "tag_name"]
    assert jobs.count() == 20 and jobs.filter("tag_name is null").count() == 10


def test_errors_are_not_swallowed(catalog, tables, tmp_path):
    with pytest.raises(ValueError, match="level-4"):
        tag_models.run_tag(catalog.filter("level = 5"), 318, str(tmp_path / "p"), tables=tables)
    with pytest.raises(KeyError):
        tag_models.run_tag(catalog, 999, str(tmp_path / "p"), tables=tables)
    assert not (tmp_path / "p").exists()


def test_command_line(spark, catalog, tables, tmp_path):
    tables("users").write.parquet(str(tmp_path / "tables" / "users"))
    catalog.createOrReplaceTempView("tag_catalog")
    stored = run(spark, ["tag", "318", "tag_catalog", str(tmp_path / "p"), "--tables", str(tmp_path / "tables"), "--as-of", "2024-06-01"])
    assert stored.count() == 13 and stored.columns == ["userId", "gender"]
    both = run(spark, ["tag", "318,321", "tag_catalog", str(tmp_path / "both"), "--tables", str(tmp_path / "tables"), "--handle-invalid", "skip"])
    assert both.count() == 20 and both.columns == ["userId", "gender", "job"]
    (tmp_path / "log.tsv").write_text("\t".join(map(str, range(11))) + "\nshort\n")
    rejected = run(spark, ["load", "1", "detail", str(tmp_path / "log.tsv"), str(tmp_path / "cells")])
    assert [r.value for r in rejected.collect()] == ["short"]
    cells = {r.qualifier: r.value for r in spark.read.parquet(str(tmp_path / "cells")).collect()}
    assert len(cells) == 11 and cells["log_time"] == "10" and cells["global_user_id"] == "5"
    for wrong in (["load", "9", "f", "a", "b"], ["load", "1"], ["tag", "1", "c", "p"]):
        with pytest.raises(SystemExit):
            run(spark, wrong)


def orders_of(spark, kind):
    """60 users in five groups by number of orders; user 'bad' has a time that cannot be read, or none."""
    numbers = spark.range(60).select(F.col("id").cast("string").alias("memberid"), F.explode(F.sequence(F.lit(1), (F.col("id") % 5).cast("int") * 50 + 1)).alias("n"))
    last = F.timestamp_seconds(F.lit(1717113600) - (4 - F.col("memberid") % 5) * 86400)
    written = {
        "timestamp": (last, F.lit(None).cast("timestamp")),
        "unix text": (F.unix_timestamp(last).cast("string"), F.lit("never")),
        "date text": (F.date_format(last, "yyyy-MM-dd HH:mm:ss"), F.lit("31.5.")),
        "date": (last.cast("date"), F.lit(None).cast("date")),
        "seconds": (F.unix_timestamp(last), F.lit(None).cast("bigint")),
    }
    good, bad = written[kind]
    orders = numbers.select("memberid", good.alias("finishtime"), F.concat_ws("-", "memberid", "n").alias("ordersn"), F.lit(1).alias("orderamount"))
    one = spark.range(1).select(F.lit("bad").alias("memberid"), bad.alias("finishtime"), F.lit("b").alias("ordersn"), F.lit(1).alias("orderamount"))
    nobody = one.withColumn("memberid", F.lit(None).cast("string"))
    return orders.unionByName(one).unionByName(nobody)


@pytest.mark.parametrize("kind", ["timestamp", "unix text", "date text", "date", "seconds"])
def test_times_of_any_type_and_one_bad_user(spark, catalog, tmp_path, kind):
    orders = orders_of(spark, kind)
    arguments = {"as_of": AS_OF, "tables": {"orders": orders}.__getitem__, "text_time": "any"}
    with pytest.raises(Exception, match="users lack a score|without a key"):
        tag_models.run_tag(catalog, 361, str(tmp_path / "p"), **arguments)
    done = tag_models.run_tag(catalog, 361, str(tmp_path / "p"), handle_invalid="skip", **arguments)
    assert done.counts == {361: {
        "rows_without_user": 1, "unreadable_times": 2 if "text" in kind else 0, "rows_without_time": 0 if "text" in kind else 2,
        "unreadable_amounts": 0, "users_without_scores": 1,
    }}
    order = ["low", "lower", "middle", "upper", "high"]
    assert {int(r.userId): order.index(r.rfm) for r in done.profile.collect()} == {i: i % 5 for i in range(60)}


def test_window_dates_in_text_are_counted(spark, catalog, tmp_path):
    users = spark.createDataFrame([(1, "1", "2024-05-30"), (2, "1", "2020-01-01"), (3, "2", "soon"), (4, "2", "2024-13-01"), (5, "2", None), (6, "1", " 2024-05-31")], "id long, gender string, since string")
    rule = "inType=table\ntable=users\nselectFieldNames=id,gender\nwhereCondition=since#day#10"
    due = catalog.withColumn("rule", F.when(F.col("id") == 318, F.lit(rule)).otherwise(F.col("rule")))
    done = tag_models.run_tag(due, 318, str(tmp_path / "p"), as_of=AS_OF, tables={"users": users}.__getitem__)
    assert done.counts == {318: {"unreadable_window_dates": 2, "rows_without_user": 0}}
    assert {r.userId: r.gender for r in done.profile.collect()} == {"1": "male", "6": "male"}


def test_several_tags_share_scans_and_one_save(spark, catalog, tables, tmp_path):
    opened, base = [], str(tmp_path / "p")
    folder = str(tmp_path / "users")
    tables("users").write.parquet(folder)

    def resolve(name):
        opened.append(name)
        return spark.read.parquet(folder) if name == "users" else tables(name)

    rule = "inType=table\ntable=users\nselectFieldNames=id,gender\nfilterConditions=gender[NE]0"
    due = catalog.withColumn("rule", F.when(F.col("id") == 318, F.lit(rule.replace("table=users", "hbaseTable=users").replace("inType=table", "inType=hbase\nfamily=detail"))).otherwise(F.col("rule")))
    done = tag_models.run_tags(due, [318, 321, 361, 367], base, as_of=AS_OF, tables=resolve)
    assert sorted(opened) == ["logs", "orders", "users"]
    assert versions(spark, base) == [0]
    one_by_one = str(tmp_path / "q")
    for tag_id in (318, 321, 361, 367):
        last = tag_models.run_tag(due, tag_id, one_by_one, as_of=AS_OF, tables=tables).profile
    same = lambda df: sorted(map(tuple, df.select("userId", "gender", "job", "rfm", "rfe").collect()))
    assert same(done.profile) == same(last) and done.profile.count() == 20
    assert set(done.counts) == {318, 321, 361, 367}


def test_a_shared_place_is_scanned_once(spark, catalog, tables, tmp_path, plan_of, monkeypatch):
    """From the plans: the users' files stand in one scan, with the fields of both tags and the filters of both."""
    folder = str(tmp_path / "users")
    tables("users").write.parquet(folder)
    rules = {318: "id,gender\nfilterConditions=gender[EQ]1", 321: "id,job\nfilterConditions=job[EQ]1"}
    due = catalog
    for tag_id, rest in rules.items():
        due = due.withColumn("rule", F.when(F.col("id") == tag_id, F.lit("inType=table\ntable=users\nselectFieldNames=" + rest)).otherwise(F.col("rule")))
    plans, stage = [], tag_models.stage
    monkeypatch.setattr(tag_models, "stage", lambda df, label: plans.append(plan_of(df)) or stage(df, label))
    done = tag_models.run_tags(due, [318, 321], str(tmp_path / "p"), as_of=AS_OF, tables=lambda _: spark.read.parquet(folder))
    (plan,) = plans
    assert plan.count("Scan parquet") == 2 and "ReadSchema: struct<id:bigint,gender:bigint,job:bigint>" in plan  # the scan, and its description
    assert "PushedFilters: [Or(EqualTo(gender,1),EqualTo(job,1))]" in plan
    found = {int(r.userId): (r.gender, r.job) for r in done.profile.collect()}
    assert found == {i: ("male" if i % 3 == 1 else None, "student" if i % 4 == 1 else None) for i in range(20) if i % 3 == 1 or i % 4 == 1}


def test_options_of_a_run(catalog, tables, tmp_path):
    with pytest.raises(ValueError, match="handle_invalid"):
        tag_models.run_tags(catalog, [318], str(tmp_path / "p"), tables=tables, handle_invalid="keep")
    with pytest.raises(ValueError, match="text_time"):
        tag_models.run_tag(catalog, 367, str(tmp_path / "p"), as_of=AS_OF, tables=tables, text_time="roman")
