"""Run the registered queries against DuckDB: ``python tests/check_queries.py SF_DIR [name…]``."""

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).parent.parent))

import __spark_entry__ as spark_entry  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

from tests.oracle import differences, duck  # noqa: E402

if __name__ == "__main__":
    sf_dir, wanted = sys.argv[1], sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection, failed = duck(sf_dir), 0
    for name, query in spark_entry.queries().items():
        if wanted and name not in wanted:
            continue
        started = time.time()
        try:
            df = query(spark, sf_dir)
            sql = spark_entry.oracle_sql().get(name)
            found = differences(df, connection, sql) if sql else None
            note = "rows only: %d" % df.count() if not sql else "same"
        except Exception as error:  # report and go on with the next query
            found = f"{type(error).__name__}: {str(error)[:600]}"
        failed += found is not None
        print(f"{name:26s} {time.time() - started:6.2f}s  {found or note}", flush=True)
    print("failed:", failed)
    sys.exit(failed > 0)
