"""Jobs to submit: ``spark-submit tagweave/__main__.py load|tag …`` (see ``--help``)."""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from tagweave.plans.bulk_load import bulk_load
from tagweave.plans.tag_models import TAG_MODELS, run_tags
from tagweave.sources.catalog import read_catalog_rows
from tagweave.sources.layouts import LAYOUTS


def known_tags(text: str) -> list[int]:
    ids = [int(part) for part in text.split(",")]
    if not set(ids) <= set(TAG_MODELS):
        raise argparse.ArgumentTypeError(f"not among {sorted(TAG_MODELS)}: {text}")
    return ids


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="tagweave")
    top.add_argument("--hive", action="store_true", help="take named tables from the Hive metastore")
    jobs = top.add_subparsers(dest="job", required=True)

    load = jobs.add_parser("load", help="tab-separated files into a sorted table of cells")
    load.add_argument("data_type", type=int, choices=sorted(LAYOUTS), help="1 log, 2 goods, 3 user, 4 order")
    load.add_argument("family")
    load.add_argument("source", help="folder of text files")
    load.add_argument("target", help="folder of the cell table, added to")
    load.add_argument("--replace", action="store_true", help="remove the earlier loads once this one is there")

    tag = jobs.add_parser("tag", help="compute tags and put them into the profile")
    tag.add_argument("tag_ids", type=known_tags, metavar="tag_id[,tag_id…]", help=f"of {sorted(TAG_MODELS)}")
    tag.add_argument("catalog", help="table with the columns id, pid, name, rule, level")
    tag.add_argument("profile", help="folder of the stored profile")
    tag.add_argument("--catalog-url", help="JDBC address of the database with the catalogue table, else the metastore")
    tag.add_argument("--handle-invalid", choices=["error", "skip"], default="error", help="rows without a user, users without a score")
    tag.add_argument("--text-time", choices=["unix", "datetime", "any"], help="how mining tags read times kept as text")
    tag.add_argument("--as-of", type=dt.date.fromisoformat, help="day the tag is computed for, today by default")
    tag.add_argument("--tables", help="folder with one parquet table per business table, else the metastore")
    return top


def run(spark: SparkSession, arguments: list[str] | None = None) -> DataFrame:
    """Run one job; the result is the stored profile or the rejected lines."""
    args = parser().parse_args(arguments)
    if args.job == "load":
        return bulk_load(spark, args.data_type, args.family, args.source, args.target, replace=args.replace)
    tables = (lambda name: spark.read.parquet(f"{args.tables}/{name}")) if args.tables else None
    catalog = read_catalog_rows(spark, args.catalog_url, args.catalog) if args.catalog_url else spark.table(args.catalog)
    mining = [i for i in args.tag_ids if TAG_MODELS[i].kind == "ML"]
    options = {i: {"text_time": args.text_time} for i in mining} if args.text_time else None
    done = run_tags(
        catalog, args.tag_ids, args.profile, as_of=args.as_of, tables=tables, options=options, handle_invalid=args.handle_invalid
    )
    for tag_id, counts in done.counts.items():
        print(f"tag {tag_id}: " + ", ".join(f"{n} {name.replace('_', ' ')}" for name, n in counts.items()))
    return done.profile


def session(arguments: list[str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName("tagweave")
    return (builder.enableHiveSupport() if parser().parse_args(arguments).hive else builder).getOrCreate()


if __name__ == "__main__":
    run(session())  # usage errors come before the session is started
