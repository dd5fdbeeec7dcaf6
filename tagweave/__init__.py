"""Customer tagging as Spark DataFrame and Spark ML jobs."""
