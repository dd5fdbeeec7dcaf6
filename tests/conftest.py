import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).parent.parent))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = (
        SparkSession.builder.master("local[8]")
        .appName("tagweave tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("scratch")))
    )
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def failing():
    """Expect an action to fail with a text in its message."""

    def check(df, text):
        with pytest.raises(Exception, match=text):
            df.collect()

    return check


@pytest.fixture
def plan_of(spark):
    """The physical plan of a frame as text, nothing left out."""
    return lambda df: spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
