"""The registered queries: every operator over the given tables.

``orders`` stands for the order table, ``events`` for the behaviour log,
``customer`` for the user table; rule catalogues are derived from the same tables.
"""

from __future__ import annotations

import datetime as dt
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tagweave.functions import bands, conditions, dates, money, rules
from tagweave.operators import classify, features, match, measures, segments
from tagweave.plans import bulk_load, classifiers, tag_models
from tagweave.sinks import profile
from tagweave.sources import business, catalog, cells, files
from tagweave.storage import literal_rows, scratch_path, stage

ORDERS_AS_OF = dt.date(2001, 8, 2)
EVENTS_AS_OF = dt.date(2024, 5, 10)

# Bands that spread the customers of ``orders`` and the users of ``events``.
RFM_SCALED = {
    "recency": bands.falling(30, 90, 180, 365),
    "frequency": bands.rising(6, 9, 12, 15),
    "monetary": bands.rising(1_000_000, 2_000_000, 2_500_000, 3_000_000),
}
RFE_SCALED = {
    "recency": bands.falling(1, 2, 3, 4),
    "frequency": bands.rising(58, 64, 69, 74),
    "engagements": bands.rising(45, 48, 50, 53),
}


def apart(scored: list[bands.Band]) -> list[bands.Band]:
    return [band._replace(score=band.score * 10_000) for band in scored]


# The same with one measure far ahead of the others: its bands are the only clusters of least cost,
# each of many score combinations, so SQL can say which users belong together.
RFM_APART = RFM_SCALED | {"frequency": apart(RFM_SCALED["frequency"])}
RFE_APART = RFE_SCALED | {"engagements": apart(bands.rising(45, 49, 53))}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def order_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measures.rfm(
        table(spark, sf_dir, "orders"), ORDERS_AS_OF,
        user="o_custkey", time="o_orderdate", order="o_orderkey", amount="o_totalprice",
    )


def event_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measures.rfe(
        table(spark, sf_dir, "events"), EVENTS_AS_OF, user="user_id", time="ts", page="props"
    )


# Catalogues ------------------------------------------------------------------


def nation_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One tag per nation; its customers are the values."""
    tags = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("bigint").alias("id"),
        F.lit(None).cast("bigint").alias("pid"),
        F.col("n_name").alias("name"),
        F.lit(
            "inType=table\n table=orders \nselectFieldNames=o_orderkey,o_custkey,o_orderstatus\n"
            "whereCondition=o_orderdate#year#3"
        ).alias("rule"),
        F.lit(4).alias("level"),
    )
    values = table(spark, sf_dir, "customer").select(
        (F.col("c_custkey") + 1000).alias("id"),
        F.col("c_nationkey").cast("bigint").alias("pid"),
        F.col("c_name").alias("name"),
        F.col("c_custkey").cast("string").alias("rule"),
        F.lit(5).alias("level"),
    )
    return tags.unionByName(values)


def value_catalog(
    df: DataFrame, tag_id: int, name: str, rule: str, value: str, key: str, leave_out: str
) -> DataFrame:
    """A tag whose values are those of a column, one left out; ids from the least key."""
    spark = df.sparkSession
    tag = literal_rows(spark, {"id": [tag_id], "name": [name], "rule": [rule]}).select(
        "id", F.lit(None).cast("bigint").alias("pid"), "name", "rule", F.lit(4).alias("level")
    )
    values = (
        df.filter(F.col(value) != leave_out)
        .groupBy(F.col(value).alias("rule"))
        .agg((F.min(key) + 1000).alias("id"))
        .select(
            "id",
            F.lit(tag_id).cast("bigint").alias("pid"),
            F.concat(F.lit(f"{name}: "), F.lower("rule")).alias("name"),
            "rule",
            F.lit(5).alias("level"),
        )
    )
    return tag.unionByName(values)


def segment_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return value_catalog(
        table(spark, sf_dir, "customer"), 321, "job",
        "inType=table\ntable=users\nselectFieldNames=id,job",
        "c_mktsegment", "c_custkey", leave_out="AUTOMOBILE",
    )


def status_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return value_catalog(
        table(spark, sf_dir, "orders"), 318, "gender",
        "inType=hbase\nhbaseTable=users\nfamily=detail\nselectFieldNames=id,gender",
        "o_orderstatus", "o_orderkey", leave_out="P",
    )


def rank_catalog(spark: SparkSession, tag_id: int, names: list[str]) -> DataFrame:
    """Values whose rules are the cluster ranks 0, 1, …"""
    ranks = range(len(names))
    values = literal_rows(
        spark, {"id": [tag_id + 1 + i for i in ranks], "name": names, "rule": [str(i) for i in ranks]}
    )
    return values.select(
        "id", F.lit(tag_id).cast("bigint").alias("pid"), "name", "rule", F.lit(5).alias("level")
    )


# Tag names by rank.
VALUE_NAMES = ["high", "upper middle", "middle", "lower middle", "low"]
ACTIVITY_NAMES = ["very active", "active", "inactive", "very inactive"]


def users_by_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr("c_custkey as id", "c_mktsegment as job")


def users_by_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr("o_orderkey as id", "o_orderstatus as gender")


# Sources and sinks -----------------------------------------------------------


def tag_catalog(spark, sf_dir):
    return catalog.tag_subtree(nation_catalog(spark, sf_dir), 7)


def attribute_tags(spark, sf_dir):
    return catalog.value_rules(nation_catalog(spark, sf_dir))


def business_scan(spark, sf_dir):
    tags = catalog.tag_subtree(nation_catalog(spark, sf_dir), 7)
    return business.read_business(
        spark, tags, as_of=ORDERS_AS_OF, tables=lambda name: table(spark, sf_dir, name)
    )


CUSTOMER_FIELDS = ["c_custkey", "c_mktsegment", "c_name", "c_nationkey"]


def rows_to_cells(spark, sf_dir):
    return cells.rows_to_cells(
        table(spark, sf_dir, "customer"), "c_custkey", "detail", CUSTOMER_FIELDS
    )


def cells_to_rows(spark, sf_dir):
    return cells.cells_to_rows(
        rows_to_cells(spark, sf_dir), "detail", ["c_name", "c_mktsegment", "c_nationkey"], "c_custkey"
    )


def relative_window_scan(spark, sf_dir):
    events = conditions.filter_window(
        table(spark, sf_dir, "events"), "ts#day#10", dt.date(2024, 1, 20)
    )
    return events.select("event_id", "user_id")


def csv_roundtrip(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    path = scratch_path(spark, "csv")
    rows.write.csv(path)
    return files.read_csv(spark, path, rows.schema)


def embedding_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select(
        "vec_id", F.col("label").cast("double").alias("label"), "embedding"
    )
    return features.vector_from_array(rows, "embedding").drop("embedding")


def libsvm_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "libsvm")
    embedding_vectors(spark, sf_dir).select("label", "features").write.format("libsvm").save(path)
    read = files.read_libsvm(spark, path, num_features=64)
    return (
        read.select("label", F.posexplode(vector_to_array("features")).alias("slot", "x"))
        .groupBy("label", "slot")
        .agg(F.round(F.sum("x"), 6).alias("total"), F.count("x").alias("n"))
    )


TSV_FIELDS = ["id", "nationkey", "segment"]


def tsv_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as lines; some have an empty last field, some one field too many or too few."""
    key, nation, segment = F.col("c_custkey"), F.col("c_nationkey"), F.col("c_mktsegment")
    line = (
        F.when(segment == "MACHINERY", F.concat_ws("\t", key, nation, F.lit("")))
        .when(segment == "BUILDING", F.concat_ws("\t", key, nation, segment, F.lit("more")))
        .when(segment == "HOUSEHOLD", F.concat_ws("\t", key, nation))
        .otherwise(F.concat_ws("\t", key, nation, segment))
    )
    return table(spark, sf_dir, "customer").select(line.alias("value"))


def tsv_parse(spark, sf_dir):
    return files.parse_tsv(tsv_lines(spark, sf_dir), TSV_FIELDS)


def tsv_rejects(spark, sf_dir):
    return files.rejected_lines(tsv_lines(spark, sf_dir), TSV_FIELDS)


def bulk_load_sorted(spark, sf_dir):
    source, target = scratch_path(spark, "lines"), scratch_path(spark, "cells")
    tsv_lines(spark, sf_dir).write.text(source)
    bulk_load.bulk_load(spark, TSV_FIELDS, "detail", source, target)
    return spark.read.parquet(target).select(cells.CELL_COLUMNS)


def bulk_load_twice(spark, sf_dir):
    """Two loads with overlapping keys, the second with other segments, read back as rows."""
    target = scratch_path(spark, "cells")
    for number in (1, 2):
        source = scratch_path(spark, f"lines{number}")
        customers = table(spark, sf_dir, "customer").filter(F.lit(number == 1) | (F.col("c_custkey") % 3 == 0))
        segment = F.col("c_mktsegment") if number == 1 else F.concat("c_mktsegment", F.lit(" again"))
        fields = [F.col("c_custkey").cast("string"), segment, F.col("c_nationkey").cast("string")]
        customers.select(F.concat_ws("\t", *fields)).write.text(source)
        bulk_load.bulk_load(spark, ["id", "segment", "nationkey"], "detail", source, target)
    rule = {"inType": "hbase", "hbaseTable": "t", "family": "detail", "selectFieldNames": "id,segment", "filterConditions": "nationkey[GE]5"}
    source = business.describe_source(rule)
    return business.read_source(spark, source, tables=lambda _: spark.read.parquet(target))


def old_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(
        "cast(c_custkey as string) as userId", "c_mktsegment as job", "c_name as nick_name"
    )


def new_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number of orders per customer; ``job`` is only there for frequent buyers."""
    n = F.count("o_orderkey")
    return table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").cast("string").alias("userId")).agg(
        F.when(n >= 12, F.lit("frequent buyer")).alias("job"), n.cast("string").alias("orders")
    )


def profile_upsert(spark, sf_dir):
    return profile.upsert(old_profile(spark, sf_dir), new_profile(spark, sf_dir))


def profile_store(spark, sf_dir):
    base = scratch_path(spark, "profile")
    profile.save_profile(old_profile(spark, sf_dir), base)
    return profile.save_profile(new_profile(spark, sf_dir), base)


def copy_fields(spark, sf_dir):
    return profile.copy_fields(
        table(spark, sf_dir, "customer"), ["c_custkey", "c_mktsegment"], "c_custkey",
        scratch_path(spark, "profile"),
    )


def score_sum(scored: DataFrame, scores: list[str], column: str) -> DataFrame:
    total = sum((F.col(s) for s in scores[1:]), F.col(scores[0]))
    return scored.select("userId", total.cast("int").cast("string").alias(column))


def wide_columns(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Four tags, each a frame of its own."""
    customer = table(spark, sf_dir, "customer")
    sign = customer.select(
        F.col("c_custkey").alias("userId"),
        F.when(F.col("c_acctbal") < 0, F.lit("owes")).otherwise("owns").alias("balance"),
    )
    return [
        sign,
        tag_models.profile_column(tag_job(spark, sf_dir), "job"),
        score_sum(rfm_score_scaled(spark, sf_dir), bands.score_columns(RFM_SCALED), "rfm"),
        score_sum(rfe_score_scaled(spark, sf_dir), bands.score_columns(RFE_SCALED), "rfe"),
    ]


def profile_wide(spark, sf_dir):
    return profile.assemble(wide_columns(spark, sf_dir))


def profile_by_tag(spark, sf_dir):
    """The same put into a stored profile tag by tag, and read from there."""
    base = scratch_path(spark, "profile")
    for column in wide_columns(spark, sf_dir):
        profile.save_profile(column, base)
    return profile.read_profile(spark, base)


def profile_saved_at_once(spark, sf_dir):
    """The same saved by four jobs at the same time, each of its own tag."""
    base = scratch_path(spark, "profile")
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda column: profile.save_profile(column, base), wide_columns(spark, sf_dir)))
    return profile.read_profile(spark, base)


# Filters, scalar functions ---------------------------------------------------

SIX_CONDITIONS = [
    "o_orderstatus[EQ]F",
    "o_orderpriority[ne]1-URGENT",
    "o_totalprice[GT]250000",
    "o_totalprice[lt]50000.5",
    "o_orderdate[Ge]1998-01-01",
    "o_orderdate[LE]1997-06-30",
]


def condition_filter(spark, sf_dir):
    """Rows each comparison keeps, counted in one scan."""
    orders = table(spark, sf_dir, "orders")
    parsed = [conditions.parse_condition(text) for text in SIX_CONDITIONS]
    counts = orders.agg(
        *[
            F.count_if(conditions.condition_column(c, orders.schema[c.field].dataType)).alias(c.compare)
            for c in parsed
        ]
    )
    return counts.unpivot([], [c.compare for c in parsed], "comparison", "n")


def condition_list_filter(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    text = "o_totalprice[GE]100000,o_orderdate[LE]1998-12-31,o_orderstatus[NE]P"
    return conditions.filter_by(orders, text).select("o_orderkey", "o_custkey")


def condition_text_filter(spark, sf_dir):
    """The same on text columns: numbers as numbers, dates by the day."""
    orders = table(spark, sf_dir, "orders").select(
        *[F.col(c).cast("string").alias(c) for c in ("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")],
        F.concat(F.col("o_orderdate").cast("date").cast("string"), F.lit(" 10:30:00")).alias("o_orderdate"),
    )
    text = "o_totalprice[GE]100000,o_orderdate[LE]1998-12-31,o_orderdate[NE]1998-12-30,o_orderstatus[NE]P,o_custkey[GT]99"
    return conditions.filter_by(orders, text).select("o_orderkey", "o_custkey")


def part_condition() -> Column:
    names = F.array(*[F.lit(n) for n in ("EQ", "ne", "GT", "lt", "Ge", "LE")])
    name = F.get(names, F.pmod(F.col("p_size"), F.lit(6)))
    return F.concat(F.lit("p_size["), name, F.lit("]"), F.col("p_brand"), F.lit("[x]"))


def condition_parts(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select(
        "p_partkey", conditions.condition_parts(part_condition()).alias("c")
    )
    return parts.select("p_partkey", "c.*")


def rule_map(spark, sf_dir):
    text = F.concat(
        F.lit("inType=table\n  table=part \r\n\nselectFieldNames=p_partkey,p_size\nfamily="),
        F.col("p_brand"), F.lit("\nwhereCondition=p_size#day#"), F.col("p_size"), F.lit("=\n"),
    )
    parsed = table(spark, sf_dir, "part").select("p_partkey", rules.rule_map(text).alias("m"))
    return parsed.select("p_partkey", F.explode("m").alias("key", "value"))


def date_shift(spark, sf_dir):
    day = dates.date_text(F.col("o_orderdate"))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        dates.now_text(ORDERS_AS_OF).alias("today"),
        dates.date_text(F.col("o_orderdate"), "yyyyMMdd").alias("compact"),
        dates.shift_date(day, -1).alias("day_before"),
        dates.shift_date(day, 100).alias("days_later"),
        dates.shift_date(
            dates.date_text(F.col("o_orderdate"), dates.LONG_FORMAT), 30, dates.LONG_FORMAT
        ).alias("moment_later"),
    )


def date_parse(spark, sf_dir):
    """Dates written in two ways, read by one pattern: the others are null."""
    text = F.when(F.col("o_orderstatus") == "P", F.date_format("o_orderdate", "dd/MM/yyyy"))
    text = text.otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    parsed = dates.parse_date(F.col("text"), dates.SHORT_FORMAT, strict=False)
    return (
        table(spark, sf_dir, "orders")
        .select("o_orderkey", text.alias("text"))
        .select("o_orderkey", "text", dates.date_text(parsed).alias("day"))
    )


def decimal_clean_sum(spark, sf_dir):
    """Amounts as text, some unreadable and some too large."""
    text = F.col("o_totalprice").cast("decimal(12,2)").cast("string")
    amount = (
        F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.lit("n/a"))
        .when(F.col("o_orderpriority") == "1-URGENT", F.concat(F.lit("9999"), text))
        .otherwise(text)
    )
    orders = table(spark, sf_dir, "orders").select("o_custkey", amount.alias("amount"))
    return money.clean_sum(orders, "o_custkey", "amount").select(
        "o_custkey", F.col("total").cast("double").alias("total"), "bad_amounts"
    )


def unix_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders the way the source table has them: everything is text, times are unix seconds."""
    seconds = F.unix_date(F.to_date("o_orderdate")).cast("bigint") * 86400 + 43200
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("memberid"),
        seconds.cast("string").alias("finishtime"),
        F.col("o_orderkey").cast("string").alias("ordersn"),
        F.col("o_totalprice").cast("decimal(12,2)").cast("string").alias("orderamount"),
    )


def last_activity(spark, sf_dir):
    return measures.last_activity(unix_orders(spark, sf_dir), "memberid", "finishtime")


def unix_recency(spark, sf_dir):
    return measures.rfm(unix_orders(spark, sf_dir), ORDERS_AS_OF).select("userId", "recency")


# Measures and scores ---------------------------------------------------------


def event_frequency(spark, sf_dir):
    """Viewed pages; other events have no page."""
    page = F.when(F.col("event_type") == "view", F.col("props")).alias("page")
    views = table(spark, sf_dir, "events").select("user_id", page)
    return measures.event_frequency(views, "user_id", "page")


def distinct_engagement(spark, sf_dir):
    return measures.distinct_engagement(table(spark, sf_dir, "events"), "user_id", "props")


def rfm_raw(spark, sf_dir):
    return order_measures(spark, sf_dir).withColumn("monetary", F.col("monetary").cast("double"))


def rfe_raw(spark, sf_dir):
    return event_measures(spark, sf_dir)


def rfm_score(spark, sf_dir):
    return bands.add_scores(order_measures(spark, sf_dir), bands.RFM_DOCUMENTED)


def rfm_score_as_coded(spark, sf_dir):
    return bands.add_scores(order_measures(spark, sf_dir), bands.RFM_AS_CODED)


def rfm_score_scaled(spark, sf_dir):
    return bands.add_scores(order_measures(spark, sf_dir), RFM_SCALED)


def rfe_score(spark, sf_dir):
    return bands.add_scores(event_measures(spark, sf_dir), bands.RFE_DOCUMENTED)


def rfe_score_as_coded(spark, sf_dir):
    return bands.add_scores(event_measures(spark, sf_dir), bands.RFE_AS_CODED)


def rfe_score_scaled(spark, sf_dir):
    return bands.add_scores(event_measures(spark, sf_dir), RFE_SCALED)


def order_value_band(spark, sf_dir):
    score = bands.band_score(money.money(F.col("o_totalprice")), bands.RFM_AS_CODED["monetary"])
    return table(spark, sf_dir, "orders").groupBy(score.alias("m_score")).agg(
        F.count("o_orderkey").alias("n")
    )


# Matching --------------------------------------------------------------------


def rule_match_inner(spark, sf_dir):
    found = catalog.value_rules(segment_catalog(spark, sf_dir))
    return match.match_rules(users_by_segment(spark, sf_dir), "job", found, "inner")


def rule_match_left(spark, sf_dir):
    found = catalog.value_rules(segment_catalog(spark, sf_dir))
    return match.match_rules(users_by_segment(spark, sf_dir), "job", found, "left")


def unmatched_values(spark, sf_dir):
    found = catalog.value_rules(segment_catalog(spark, sf_dir))
    return match.unmatched_values(users_by_segment(spark, sf_dir), "job", found)


# Features --------------------------------------------------------------------


def string_index(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return features.string_index(rows, "c_mktsegment", "label")


def assemble_features(spark, sf_dir):
    scored = rfm_score_scaled(spark, sf_dir)
    vector = features.assemble_features(scored, bands.score_columns(RFM_SCALED))
    x = F.col("x")
    return vector.select("userId", vector_to_array("features").alias("x")).select(
        "userId", x[0].alias("x0"), x[1].alias("x1"), x[2].alias("x2")
    )


def l2_normalize(spark, sf_dir):
    vector = embedding_vectors(spark, sf_dir).withColumnRenamed("features", "raw")
    unit = features.l2_normalize(vector, "raw").select("vec_id", vector_to_array("features").alias("x"))
    x = F.col("x")
    return unit.select(
        "vec_id",
        F.size("x").alias("slots"),
        *[F.round(x[i], 6).alias(f"x{i}") for i in (0, 31, 63)],
        F.round(F.aggregate("x", F.lit(0.0), lambda acc, v: acc + v), 6).alias("total"),
    )


def lineitem_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag = F.when(F.col("l_returnflag") == "A", 2.0).when(F.col("l_returnflag") == "R", -1.0)
    rows = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        "l_linenumber",
        flag.otherwise(0.0).alias("flag"),
        F.when(F.col("l_linestatus") == "F", 7.0).otherwise(3.0).alias("status"),
    )
    return features.assemble_features(rows, ["l_linenumber", "flag", "status"])


def vector_index(spark, sf_dir):
    vectors = lineitem_vectors(spark, sf_dir)
    model = features.fit_vector_index(vectors, "features", "indexed", max_categories=4)
    x = F.col("x")
    return (
        model.transform(vectors)
        .select("l_orderkey", "l_partkey", vector_to_array("indexed").alias("x"))
        .select("l_orderkey", "l_partkey", x[0].alias("x0"), x[1].alias("x1"), x[2].alias("x2"))
    )


def stable_split(spark, sf_dir):
    part = F.when(features.in_training("o_orderkey"), F.lit("train")).otherwise("test")
    return table(spark, sf_dir, "orders").select("o_orderkey", part.alias("part"))


# Clusters --------------------------------------------------------------------


def cluster_score_range(spark, sf_dir):
    scored = rfm_score_scaled(spark, sf_dir).withColumn("cluster", F.col("r_score").cast("int"))
    return segments.cluster_score_range(scored, "cluster", bands.score_columns(RFM_SCALED))


def within_cluster_error(spark, sf_dir):
    error = segments.within_cluster_error(embedding_vectors(spark, sf_dir), "label", "features")
    return error.select(F.round("wssse", 6).alias("wssse"))


def silhouette(spark, sf_dir):
    value = segments.silhouette(embedding_vectors(spark, sf_dir), "label", "features")
    return literal_rows(spark, {"silhouette": [round(value, 6)]})


def cluster_rank_labels(spark, sf_dir):
    """Rows of ten given clusters by the rank of their cluster; nine ranks have a tag."""
    vectors = embedding_vectors(spark, sf_dir)
    names = catalog.value_rules(rank_catalog(spark, 500, [f"band {i}" for i in range(9)]))
    return segments.tag_clusters(vectors, "label", "features", names).select(
        "vec_id", "rank", "tag_name", F.round("center_sum", 6).alias("center_sum")
    )


def order_segments(spark, sf_dir):
    scored = stage(bands.add_scores(order_measures(spark, sf_dir), RFM_APART), "scores")
    return segments.segment(scored, bands.score_columns(RFM_APART), k=5, max_iter=10).assigned


def event_segments(spark, sf_dir):
    scored = stage(bands.add_scores(event_measures(spark, sf_dir), RFE_APART), "scores")
    return segments.segment(scored, bands.score_columns(RFE_APART), k=4, max_iter=20).assigned


def segment_checks(found: segments.Segmentation, k: int) -> DataFrame:
    """What holds for any clustering of users by scores, as counts.

    ``split_points``: score combinations in more than one cluster; ``misplaced``:
    users nearer to another centre than to their own; ``unordered``: ranks whose
    centre sum is not below that of the rank before.
    """
    ranks = found.ranks.orderBy("rank").collect()
    unordered = sum(b.center_sum >= a.center_sum for a, b in zip(ranks, ranks[1:]))

    def distance(center: list[float]) -> Column:
        parts = [(F.col(s) - x) * (F.col(s) - x) for s, x in zip(found.scores, center)]
        return sum(parts[1:], parts[0])

    own = F.coalesce(*[F.when(F.col("cluster") == r.cluster, distance(r.center)) for r in ranks])
    nearest = F.least(*[distance(r.center) for r in ranks])
    per_point = found.assigned.groupBy(*found.scores).agg(
        F.count(F.lit(1)).alias("users"),
        (F.min("cluster") != F.max("cluster")).cast("int").alias("split"),
        F.count_if(own > nearest + 1e-9).alias("misplaced"),
    )
    return per_point.agg(
        F.sum("users").alias("users"),
        F.sum("split").alias("split_points"),
        F.sum("misplaced").alias("misplaced"),
    ).select(
        "*",
        F.lit(unordered).cast("bigint").alias("unordered"),
        F.lit(max(0, len(ranks) - k)).cast("bigint").alias("clusters_too_many"),
    )


def rfm_segment_checks(spark, sf_dir):
    scored = stage(rfm_score_scaled(spark, sf_dir), "scores")
    found = segments.segment(scored, bands.score_columns(RFM_SCALED), k=5, max_iter=10)
    return segment_checks(found, 5)


def rfe_segment_checks(spark, sf_dir):
    scored = stage(rfe_score_scaled(spark, sf_dir), "scores")
    found = segments.segment(scored, bands.score_columns(RFE_SCALED), k=4, max_iter=20)
    return segment_checks(found, 4)


# Classification --------------------------------------------------------------


def stepped_slots() -> Column:
    """Embeddings whose first three slots say which of three classes a row has: a step, so any sound classifier finds it."""
    x = F.col("embedding").cast("array<double>")
    return F.transform(x, lambda v, i: F.when(i < 3, (i == F.col("label") % 3).cast("double")).otherwise(v * 0.1))


def stepped_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select(
        "vec_id", (F.col("label") % 3).cast("double").alias("label"), stepped_slots().alias("slots")
    )
    return features.vector_from_array(rows, "slots").drop("slots")


def logreg_predict(spark, sf_dir):
    train, test = features.stable_split(stepped_vectors(spark, sf_dir), "vec_id")
    return classify.fit_logistic(train).transform(test).select("vec_id", "label", "prediction")


def dtree_predict(spark, sf_dir):
    train, test = features.stable_split(stepped_vectors(spark, sf_dir), "vec_id")
    return classify.fit_tree(train).transform(test).select("vec_id", "label", "prediction")


def prediction_checks(spark, sf_dir):
    """Test rows per classifier, and predictions that are none of the labels."""
    known = [float(i) for i in range(10)]
    parts = [
        query(spark, sf_dir).agg(
            F.lit(name).alias("classifier"),
            F.count(F.lit(1)).alias("n"),
            F.count_if(~F.col("prediction").isin(known)).alias("unknown"),
        )
        for name, query in (("logistic", logreg_predict), ("tree", dtree_predict))
    ]
    return parts[0].unionByName(parts[1])


def accuracy_given_labels(spark, sf_dir):
    return classify.accuracy(table(spark, sf_dir, "labels"), "quality", "toxic")


def model_roundtrip(spark, sf_dir):
    """Whether the saved and loaded model predicts what the trained one did."""
    vectors = embedding_vectors(spark, sf_dir)
    model, path = classify.fit_logistic(vectors), scratch_path(spark, "model")
    classify.save_model(model, path)
    before = model.transform(vectors).select("vec_id", "features", F.col("prediction").alias("before"))
    after = classify.load_logistic(path).setRawPredictionCol("raw2").setProbabilityCol("p2")
    same = (F.col("before") == F.col("prediction")).cast("int").alias("same")
    return after.transform(before).select("vec_id", same)


def measurements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All 64 slots as columns, the category last."""
    slots = [F.col("slots")[i].alias(f"x{i}") for i in range(64)]
    rows = table(spark, sf_dir, "embeddings").select(
        "vec_id", stepped_slots().alias("slots"), F.concat(F.lit("kind "), F.col("label") % 3).alias("category")
    )
    return rows.select("vec_id", *slots, "category")


def measurement_classifier(spark, sf_dir):
    rows = measurements(spark, sf_dir).drop("vec_id")
    path = scratch_path(spark, "measurements")
    rows.write.csv(path)
    trained = classifiers.measurement_classifier(
        spark, path, rows.schema, scratch_path(spark, "model")
    )
    return trained.predictions.groupBy("category", "label", "prediction").agg(
        F.count(F.lit(1)).alias("n")
    )


def pipeline_scores(spark, sf_dir):
    """Raw rows without a category, scored by stored pipelines that were trained on the others."""
    train, test = features.stable_split(measurements(spark, sf_dir), "vec_id")
    known, new = scratch_path(spark, "known"), scratch_path(spark, "new")
    train.drop("vec_id").write.csv(known)
    test.drop("category").write.csv(new)
    parts = []
    for classifier in ("logistic", "tree"):
        model = scratch_path(spark, "model")
        classifiers.train_pipeline(spark, known, train.drop("vec_id").schema, model, classifier)
        scored = classifiers.score_csv(spark, new, test.drop("category").schema, model)
        parts.append(scored.select(F.lit(classifier).alias("classifier"), "vec_id", "predicted"))
    return parts[0].unionByName(parts[1])


def tree_classifier(spark, sf_dir):
    """Line items late in their order or not, from quantity, discount, flag and line number."""
    flag = F.when(F.col("l_returnflag") == "A", 2.0).when(F.col("l_returnflag") == "R", 1.0)
    rows = table(spark, sf_dir, "lineitem").select(
        (F.col("l_linenumber") > 3).cast("double").alias("label"),
        flag.otherwise(0.0).alias("flag"), "l_quantity", "l_discount", "l_linenumber",
    )
    vectors = features.assemble_features(rows, ["flag", "l_quantity", "l_discount", "l_linenumber"])
    path = scratch_path(spark, "libsvm")
    vectors.select("label", "features").write.format("libsvm").save(path)
    trained = classifiers.tree_classifier(spark, path, num_features=4)
    return trained.predictions.groupBy("label", "index_label", "prediction").agg(
        F.count(F.lit(1)).alias("n")
    )


# Tag models ------------------------------------------------------------------


def tag_gender(spark, sf_dir):
    return tag_models.tag_gender(users_by_status(spark, sf_dir), status_catalog(spark, sf_dir))


def tag_job(spark, sf_dir):
    return tag_models.tag_job(users_by_segment(spark, sf_dir), segment_catalog(spark, sf_dir))


def tag_rfm(spark, sf_dir):
    return tag_models.tag_by_segment(
        order_measures(spark, sf_dir), rank_catalog(spark, 361, VALUE_NAMES), RFM_APART, k=5, max_iter=10
    )


def tag_rfe(spark, sf_dir):
    return tag_models.tag_by_segment(
        event_measures(spark, sf_dir), rank_catalog(spark, 367, ACTIVITY_NAMES), RFE_APART, k=4, max_iter=20
    )


def run_tag_models(spark, sf_dir):
    """Gender and job, from the catalogue into one stored profile."""
    users = {318: users_by_status(spark, sf_dir), 321: users_by_segment(spark, sf_dir)}
    found = status_catalog(spark, sf_dir).unionByName(segment_catalog(spark, sf_dir))
    base = scratch_path(spark, "profile")
    for tag_id in (318, 321):
        done = tag_models.run_tag(
            found, tag_id, base, as_of=ORDERS_AS_OF, tables=lambda _: users[tag_id]
        )
    return done.profile


def mining_catalog(spark: SparkSession) -> DataFrame:
    """The two mining tags over the tables ``orders`` and ``logs``, their values the ranks."""
    rules = {
        361: "inType=table\ntable=orders\nselectFieldNames=memberid,finishtime,ordersn,orderamount",
        367: "inType=table\ntable=logs\nselectFieldNames=global_user_id,log_time,loc_url",
    }
    tags = literal_rows(spark, {"id": list(rules), "name": ["value", "activity"], "rule": list(rules.values())}).select(
        "id", F.lit(None).cast("bigint").alias("pid"), "name", "rule", F.lit(4).alias("level")
    )
    values = rank_catalog(spark, 361, VALUE_NAMES).unionByName(rank_catalog(spark, 367, ACTIVITY_NAMES))
    return tags.unionByName(values)


TIME_KINDS = ["timestamp", "unix text", "date text"]


def written_time(moment: Column, kind: str) -> Column:
    if kind == "timestamp":
        return moment.cast("timestamp")
    seconds = F.unix_date(F.to_date(moment)).cast("bigint") * 86400 + 43200
    return seconds.cast("string") if kind == "unix text" else F.date_format(moment, "yyyy-MM-dd HH:mm:ss")


def with_bad_user(rows: DataFrame, user: str, time: str) -> DataFrame:
    """One row more, of a user whose only time cannot be read, or is missing where times are typed."""
    kind = rows.schema[time].dataType.simpleString()
    bad = {user: F.lit("nobody"), time: F.lit("never" if kind == "string" else None).cast(kind)}
    return rows.unionByName(rows.limit(1).withColumns(bad))


def mined_tables(spark: SparkSession, sf_dir: str, kind: str) -> dict[str, DataFrame]:
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("memberid"), written_time(F.col("o_orderdate"), kind).alias("finishtime"),
        F.col("o_orderkey").alias("ordersn"), F.col("o_totalprice").alias("orderamount"),
    )
    logs = table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("global_user_id"), written_time(F.col("ts"), kind).alias("log_time"), F.col("props").alias("loc_url")
    )
    return {"orders": with_bad_user(orders, "memberid", "finishtime"), "logs": with_bad_user(logs, "global_user_id", "log_time")}


def run_mining_tag(spark: SparkSession, sf_dir: str, tag_id: int, as_of: dt.date, preset) -> DataFrame:
    """A mining tag from the catalogue to the profile, with times of three types and one bad user each time."""
    column, parts = tag_models.TAG_MODELS[tag_id].column, []
    for kind in TIME_KINDS:
        done = tag_models.run_tag(
            mining_catalog(spark), tag_id, scratch_path(spark, "profile"), as_of=as_of,
            tables=mined_tables(spark, sf_dir, kind).__getitem__, handle_invalid="skip", text_time="any", preset=preset,
        )
        found = {name: F.lit(n).cast("bigint") for name, n in done.counts[tag_id].items()}
        counts = [found[name].alias(name) for name in ("unreadable_times", "rows_without_time", "users_without_scores")]
        parts.append(done.profile.select(F.lit(kind).alias("times"), "userId", column, *counts))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def run_value_tag(spark, sf_dir):
    return run_mining_tag(spark, sf_dir, 361, ORDERS_AS_OF, RFM_APART)


def run_activity_tag(spark, sf_dir):
    return run_mining_tag(spark, sf_dir, 367, EVENTS_AS_OF, RFE_APART)


def run_all_tags(spark, sf_dir):
    """Four tags in one run: gender and job from one scan of the users, one save."""
    users = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.when(F.col("c_acctbal") < 0, F.lit("owes")).otherwise("owns").alias("gender"), F.col("c_mktsegment").alias("job")
    )
    gender = value_catalog(users, 318, "gender", "inType=table\ntable=users\nselectFieldNames=id,gender", "gender", "id", leave_out="owns")
    due = gender.unionByName(segment_catalog(spark, sf_dir)).unionByName(mining_catalog(spark))
    places = {"users": users, **mined_tables(spark, sf_dir, "timestamp")}
    done = tag_models.run_tags(
        due, [318, 321, 361, 367], scratch_path(spark, "profile"), as_of=EVENTS_AS_OF, tables=places.__getitem__,
        options={361: {"preset": RFM_APART}, 367: {"preset": RFE_APART}}, handle_invalid="skip",
    )
    return done.profile


QUERIES = {
    query.__name__: query
    for query in (
        tag_catalog, attribute_tags, business_scan, rows_to_cells, cells_to_rows,
        relative_window_scan, csv_roundtrip, libsvm_roundtrip, tsv_parse, tsv_rejects,
        bulk_load_sorted, profile_upsert, profile_store, copy_fields, profile_wide,
        profile_by_tag, profile_saved_at_once,
        bulk_load_twice, condition_filter, condition_list_filter, condition_text_filter, condition_parts, rule_map, date_shift,
        date_parse, decimal_clean_sum, last_activity, unix_recency, event_frequency,
        distinct_engagement, rfm_raw, rfe_raw, rfm_score, rfm_score_as_coded,
        rfm_score_scaled, rfe_score, rfe_score_as_coded, rfe_score_scaled, order_value_band,
        rule_match_inner, rule_match_left, unmatched_values, string_index,
        assemble_features, l2_normalize, vector_index, stable_split, cluster_score_range,
        cluster_rank_labels, logreg_predict, dtree_predict, accuracy_given_labels,
        model_roundtrip, measurement_classifier, pipeline_scores, tree_classifier, tag_gender, tag_job,
        tag_rfm, tag_rfe, run_tag_models, run_value_tag, run_activity_tag, run_all_tags,
        rfm_segment_checks, rfe_segment_checks, prediction_checks,
    )
}
QUERIES |= {
    "wssse_given_labels": within_cluster_error,
    "silhouette_given_labels": silhouette,
    "rfm_segments": order_segments,
    "rfe_segments": event_segments,
}
