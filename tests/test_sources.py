"""Catalogue, business tables, files and cells."""

import datetime as dt

import duckdb
import pytest
from pyspark.sql import functions as F

from tagweave.plans.bulk_load import bulk_load
from tagweave.sinks.bulk import sorted_cells, write_sorted
from tagweave.sources import business, catalog, cells, files, layouts

CATALOG = "id bigint, pid bigint, name string, rule string, level int"
ROWS = [
    (318, 300, "gender", "inType=HBase\nzkHosts=h\nzkPort=1\nhbaseTable=users\nfamily=detail\nselectFieldNames=id,gender", 4),
    (320, 318, "female", "2", 5),
    (319, 318, "male", "1", 5),
    (321, 300, "job", "inType=table\ntable=users\nselectFieldNames=id,job", 4),
]


@pytest.fixture
def tags(spark):
    return catalog.tag_subtree(spark.createDataFrame([*ROWS, ROWS[1]], CATALOG), 318)


def test_subtree_is_distinct_and_ordered(tags):
    assert [r.id for r in tags.collect()] == [318, 319, 320]
    assert tags.columns == ["id", "name", "rule", "level"]


def test_subtree_query_gives_the_same_rows(tags):
    connection = duckdb.connect()
    connection.execute(f"CREATE TABLE tbl_basic_tag ({CATALOG})")
    connection.executemany("INSERT INTO tbl_basic_tag VALUES (?, ?, ?, ?, ?)", [*ROWS, ROWS[1]])
    found = connection.execute(f"SELECT * FROM {catalog.subtree_query(318)} ORDER BY level, id").fetchall()
    assert found == [tuple(r) for r in tags.collect()]


def test_value_rules(tags):
    assert {tuple(r) for r in catalog.value_rules(tags).collect()} == {("1", 319, "male"), ("2", 320, "female")}


def test_missing_source_rule(spark, tags):
    with pytest.raises(ValueError, match="level-4"):
        catalog.source_rule(tags.filter("level = 5"))


def test_describe_source():
    rule = {"inType": "HBASE", "hbaseTable": "t", "family": "f", "selectFieldNames": "a,b", "whereCondition": "m#day#1"}
    found = business.describe_source(rule)
    assert (found.kind, found.location, found.fields, found.family, found.window) == (
        "hbase", "t", ["a", "b"], "f", "m#day#1",
    )
    with pytest.raises(ValueError, match="mongo"):
        business.describe_source({**rule, "inType": "mongo"})
    for key in ("inType", "hbaseTable", "selectFieldNames"):
        with pytest.raises(ValueError, match=key):
            business.describe_source({k: v for k, v in rule.items() if k != key})


def test_database_source_can_be_read_in_ranges():
    rule = {
        "inType": "jdbc", "dbtable": "t", "selectFieldNames": "a", "url": "jdbc:x", "zkHosts": "h",
        "partitionColumn": "id", "lowerBound": "1", "upperBound": "9", "numPartitions": "4",
    }
    found = business.describe_source(rule)
    assert found.options == {k: rule[k] for k in rule if k not in ("inType", "dbtable", "selectFieldNames", "zkHosts")}


def test_business_rows_are_text(spark, tags):
    users = spark.createDataFrame([(1, 2, "x"), (2, None, "y")], "id int, gender int, other string")
    found = business.read_business(spark, tags, tables={"users": users}.__getitem__)
    assert [f.dataType.simpleString() for f in found.schema] == ["string", "string"]
    assert sorted(map(tuple, found.collect())) == [("1", "2"), ("2", None)]


def test_business_rows_from_cells_and_window(spark):
    table = [
        ("u1", "detail", "id", "u1"), ("u1", "detail", "gender", "1"), ("u1", "detail", "modified", "2024-02-28 10:00:00"),
        ("u2", "detail", "id", "u2"), ("u2", "detail", "modified", "2020-01-01 00:00:00"),
        ("u3", "detail", "id", "u3"), ("u3", "detail", "modified", "2024-03-01 23:00:00"),
        ("u3", "other", "gender", "9"),
    ]
    df = spark.createDataFrame(table, "rowkey string, family string, qualifier string, value string")
    source = business.describe_source(
        {"inType": "hbase", "hbaseTable": "t", "family": "detail", "selectFieldNames": "id,gender", "whereCondition": "modified#month#1"}
    )
    found = business.read_source(spark, source, as_of=dt.date(2024, 3, 2), tables=lambda _: df)
    assert sorted(map(tuple, found.collect())) == [("u1", "1"), ("u3", None)]


def test_business_rows_from_files_with_conditions(spark, tmp_path):
    spark.range(10).withColumn("x", F.col("id") * 2).write.parquet(str(tmp_path / "t"))
    source = business.describe_source(
        {"inType": "parquet", "path": str(tmp_path / "t"), "selectFieldNames": "x", "filterConditions": "id[GE]3,id[LT]5"}
    )
    assert sorted(r.x for r in business.read_source(spark, source).collect()) == ["6", "8"]


def test_layouts():
    assert [len(layouts.layout(n)) for n in (1, 2, 3, 4)] == [11, 37, 38, 25]
    assert all(layouts.layout(n)[0] == "id" for n in (1, 2, 3, 4))
    users, orders = layouts.layout("3"), layouts.layout(4)
    assert [users.index(f) for f in ("gender", "birthday", "job", "modified", "is_blacklist")] == [14, 15, 17, 33, 37]
    assert [orders.index(f) for f in ("ordersn", "memberid", "paytime", "productamount")] == [10, 12, 18, 24]
    with pytest.raises(ValueError, match="5"):
        layouts.layout(5)
    schema = layouts.text_schema("a,b")
    assert [(f.name, f.dataType.simpleString(), f.nullable) for f in schema] == [
        ("a", "string", True), ("b", "string", True),
    ]


def test_tsv_arity(spark):
    lines = ["1\ta\t", "2\tb", "3\tc\td\te", None, "\t\t"]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    fields = ["id", "x", "y"]
    assert sorted(map(tuple, files.parse_tsv(df, fields).collect())) == [("", "", ""), ("1", "a", "")]
    assert sorted(map(tuple, files.rejected_lines(df, fields).collect())) == [("2\tb", 2), ("3\tc\td\te", 4)]


def test_csv_is_not_inferred(spark, tmp_path):
    (tmp_path / "x.csv").write_text("5.1,3.5,1.4,0.2,setosa\n4.9,,1.4,0.2,é\n", encoding="utf-8")
    schema = "a double, b double, c double, d double, category string"
    found = files.read_csv(spark, str(tmp_path / "x.csv"), schema)
    assert sorted(map(tuple, found.collect()), key=str) == [
        (4.9, None, 1.4, 0.2, "é"), (5.1, 3.5, 1.4, 0.2, "setosa"),
    ]


def test_libsvm(spark, tmp_path):
    (tmp_path / "x.txt").write_text("1 1:0.5 3:2\n0 2:1\n")
    found = files.read_libsvm(spark, str(tmp_path / "x.txt"), 3).orderBy("label").collect()
    assert [(r.label, list(r.features.toArray())) for r in found] == [(0, [0, 1, 0]), (1, [0.5, 0, 2])]


def test_cells_both_ways(spark):
    df = spark.createDataFrame([("u1", "m", None), ("u2", None, 3)], "id string, gender string, n int")
    found = cells.rows_to_cells(df, "id", "f")
    assert sorted(map(tuple, found.collect())) == [
        ("u1", "f", "gender", "m"), ("u1", "f", "id", "u1"), ("u2", "f", "id", "u2"), ("u2", "f", "n", "3"),
    ]
    back = cells.cells_to_rows(found, "f", ["gender", "n", "none"], "id")
    assert sorted(map(tuple, back.collect())) == [("u1", "m", None, None), ("u2", None, "3", None)]


def test_newest_cell_wins(spark):
    table = [("u", "f", "x", "new", 2), ("u", "f", "x", "old", 1), ("u", "g", "x", "no", 9)]
    df = spark.createDataFrame(table, "rowkey string, family string, qualifier string, value string, at int")
    assert cells.cells_to_rows(df, "f", ["x"], version="at").collect() == [("u", "new")]


def test_bulk_load(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.tsv").write_text("10\tx\t\n2\ty\tz\nbad\n")
    target = str(tmp_path / "out")
    rejected = bulk_load(spark, ["id", "b", "a"], "detail", str(tmp_path / "in"), target)
    assert [tuple(r) for r in rejected.collect()] == [("bad", 1)]
    found = spark.read.parquet(target)
    assert sorted(map(tuple, found.select(cells.CELL_COLUMNS).collect())) == [
        ("10", "detail", "a", ""), ("10", "detail", "b", "x"), ("10", "detail", "id", "10"),
        ("2", "detail", "a", "z"), ("2", "detail", "b", "y"), ("2", "detail", "id", "2"),
    ]
    bulk_load(spark, ["id", "b", "a"], "detail", str(tmp_path / "in"), target, replace=True)
    assert spark.read.parquet(target).count() == 6


def newest_rows(spark, target, fields, conditions=None):
    rule = {"inType": "hbase", "hbaseTable": "t", "family": "detail", "selectFieldNames": fields}
    rule |= {"filterConditions": conditions} if conditions else {}
    source = business.describe_source(rule)
    found = business.read_source(spark, source, tables=lambda _: spark.read.parquet(target))
    return sorted(map(tuple, found.collect()))


def test_a_load_adds_to_the_table_and_the_newest_cell_counts(spark, tmp_path):
    target, (one, two) = str(tmp_path / "out"), (tmp_path / "one", tmp_path / "two")
    for folder, text in ((one, "1\t9\n1\t10\n2\t5\n"), (two, "1\t8\n3\t7\n")):
        folder.mkdir()
        (folder / "a.tsv").write_text(text)
    bulk_load(spark, ["id", "t"], "detail", str(one), target)
    assert newest_rows(spark, target, "id,t") == [("1", "10"), ("2", "5")]
    bulk_load(spark, ["id", "t"], "detail", str(two), target)
    assert newest_rows(spark, target, "id,t") == [("1", "8"), ("2", "5"), ("3", "7")]
    assert newest_rows(spark, target, "id", "t[GE]7") == [("1",), ("3",)]


def test_a_failed_load_leaves_the_table(spark, tmp_path):
    target = str(tmp_path / "out")
    write_sorted(spark.createDataFrame([("1", "a")], "id string, v string"), "id", "detail", target)
    broken = spark.range(1).select(F.lit("2").alias("id"), F.raise_error(F.lit("lost")).cast("string").alias("v"))
    with pytest.raises(Exception, match="lost"):
        write_sorted(broken, "id", "detail", target)
    assert newest_rows(spark, target, "id,v") == [("1", "a")]


def partitions_of(df):
    return df.withColumn("p", F.spark_partition_id()).collect()


def test_sorted_cells_are_in_key_order(spark):
    rows = spark.range(2000, numPartitions=5).select((F.col("id") * 7919 % 2000).alias("k"), F.lit("v").alias("x"))
    found = partitions_of(sorted_cells(rows, "k", "f"))
    assert len(found) == 4000
    order = [(r.p, r.rowkey, r.qualifier) for r in found]
    assert order == sorted(order)
    assert [r.rowkey for r in found] == sorted(r.rowkey for r in found)


def test_copies_of_one_row_are_spread(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = spark.range(4000, numPartitions=8).select(
            F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id")).alias("k"), F.lit("same").alias("x")
        )
        found = partitions_of(sorted_cells(rows, "k", "f"))
        hot = {r.p for r in found if r.rowkey == "7"}
        assert len(found) == 8000 and len(hot) > 1
        assert [r.rowkey for r in found] == sorted(r.rowkey for r in found)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_write_sorted_replaces_when_asked_to(spark, tmp_path):
    df = spark.createDataFrame([("a", "1")], "id string, x string")
    for _ in range(2):
        write_sorted(df, "id", "f", str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 4
    write_sorted(df, "id", "f", str(tmp_path / "t"), replace=True)
    assert spark.read.parquet(str(tmp_path / "t")).count() == 2
