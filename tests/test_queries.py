"""The registered queries against their SQL counterparts."""

import pytest

import __spark_entry__ as spark_entry
from tests.oracle import differences, duck

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return duck(SF_DIR)


def test_entry(spark):
    df = spark_entry.entry(spark)
    assert df.columns == ["userId", "recency", "frequency", "monetary"] and df.count() == 150


def test_every_oracle_has_a_query():
    assert set(spark_entry.oracle_sql()) <= set(spark_entry.queries())


@pytest.mark.parametrize("name", sorted(spark_entry.oracle_sql()))
def test_same_as_sql(spark, connection, name):
    df = spark_entry.queries()[name](spark, SF_DIR)
    assert differences(df, connection, spark_entry.oracle_sql()[name]) is None


@pytest.mark.parametrize("name", sorted(set(spark_entry.queries()) - set(spark_entry.oracle_sql())))
def test_gives_rows(spark, name):
    assert spark_entry.queries()[name](spark, SF_DIR).count() > 0


@pytest.mark.parametrize("name", ["rfm_segments", "rfe_segments"])
def test_one_segment_per_user(spark, name):
    df = spark_entry.queries()[name](spark, SF_DIR)
    assert df.count() == df.select("userId").distinct().count()
    by_rank = df.selectExpr(
        "rank", f"{' + '.join(c for c in df.columns if c.endswith('_score'))} as total"
    ).groupBy("rank").avg("total").orderBy("rank").collect()
    means = [r[1] for r in by_rank]
    assert means == sorted(means, reverse=True) and len(means) > 1
