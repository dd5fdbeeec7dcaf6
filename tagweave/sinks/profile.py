"""The profile: one wide row per user, one text column per tag.

A stored profile is kept by column: ``data`` holds one folder for the keys and
one for each tag, all bucketed and sorted by the key, and ``manifests/<n>`` says
which folders make up version ``n``. Saving a tag rewrites the folder of that tag
(and the keys) and no other; reading joins the folders bucket by bucket, without
a shuffle.

Saves are optimistic. A save reads the newest manifest, writes folders of its
own, and publishes the next manifest by renaming a finished folder to its number,
which succeeds for one save only. Where another save came first, only what both
have changed is merged again; the rest goes into the next manifest as it is. So
simultaneous saves of different tags all stay, and of the same cell the last
published one counts. A save that dies leaves folders that no manifest names.

The rename has to be one step and must not replace a folder with files in it:
true of HDFS, of local files and of stores with real folders, not of plain object
stores, where one job at a time may save.
"""

from __future__ import annotations

import json
import logging
import time
import uuid
from concurrent.futures import ThreadPoolExecutor
from typing import NamedTuple

from py4j.protocol import Py4JError, Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tagweave.storage import absolute, file_system, stage

log = logging.getLogger(__name__)

#: Versions that stay after a save: a reader may take as long as so many saves less one.
KEEP = 10
#: Seconds after which folders that no manifest names are taken for the remains of a failed save.
LEFTOVERS_AFTER = 7 * 86400
#: Folders written at a time.
WRITERS = 4


def _agreed(column: str) -> Column:
    """The one value a group holds for a column; two different ones are an error."""
    low, high = F.min(column), F.max(column)
    conflict = F.concat(F.lit(f"conflicting values for {column}: "), low, F.lit(" and "), high)
    return F.when(low == high, high).when(high.isNotNull(), F.raise_error(conflict))


def assemble(frames: list[DataFrame], key: str = "userId") -> DataFrame:
    """One row per key over all frames, each bringing some tag columns.

    Frames are stacked and folded with one shuffle. A null is no value; a row
    without a key and two values for the same cell are errors.
    """
    stacked = frames[0]
    for frame in frames[1:]:
        stacked = stacked.unionByName(frame, allowMissingColumns=True)
    text = stacked.select(*[F.col(c).cast("string").alias(c) for c in stacked.columns])
    tags = [c for c in text.columns if c != key]
    no_key = F.raise_error(F.lit("profile row without a key")).cast("boolean")
    # The check is a filter and not part of the key, which keeps a partitioning by key usable.
    keyed = text.filter(F.when(F.col(key).isNull(), no_key).otherwise(True))
    return keyed.groupBy(key).agg(*[_agreed(t).alias(t) for t in tags])


def upsert(old: DataFrame, new: DataFrame, key: str = "userId") -> DataFrame:
    """Old profile with the cells of ``new`` put in: a null cell in ``new`` changes nothing.

    ``old`` has one row per key; ``new`` is folded to one with the partitioning
    the join needs anyway.
    """
    fresh = assemble([new], key)
    tags = list(dict.fromkeys(c for c in [*old.columns, *fresh.columns] if c != key))
    joined = old.alias("old").join(fresh.alias("new"), key, "full_outer")
    sides = {"new": fresh.columns, "old": old.columns}

    def cell(tag: str) -> Column:
        return F.coalesce(*[F.col(f"{s}.`{tag}`") for s, names in sides.items() if tag in names])

    return joined.select(key, *[cell(tag).alias(tag) for tag in tags])


class Snapshot(NamedTuple):
    """One version: the folder of the keys and that of each tag."""

    version: int
    buckets: int
    users: str
    tags: dict[str, str]


def _names(spark: SparkSession, folder: str) -> list[str]:
    fs, path = file_system(spark, folder)
    return [status.getPath().getName() for status in fs.listStatus(path)] if fs.exists(path) else []


def versions(spark: SparkSession, base: str) -> list[int]:
    """Numbers of the published versions, oldest first."""
    return sorted(int(n) for n in _names(spark, f"{base}/manifests") if n.isdigit())


def snapshot(spark: SparkSession, base: str, version: int | None = None) -> Snapshot | None:
    """A published version, the newest unless given; None where there is none."""
    known = versions(spark, base)
    if not known or version not in (None, *known):
        return None
    folder = f"{base}/manifests/{known[-1] if version is None else version}"
    (name,) = [n for n in _names(spark, folder) if n.endswith(".json")]
    fs, path = file_system(spark, f"{folder}/{name}")
    stream = fs.open(path)
    try:
        return Snapshot(**json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")))
    finally:
        stream.close()


def _publish(spark: SparkSession, base: str, new: Snapshot) -> bool:
    """Make ``new`` a version, unless its number has been taken.

    The manifest is complete before it is renamed to its number. A folder with
    that number is not replaced: some file systems refuse, some move the new
    folder into it; so whose manifest is there decides.
    """
    token = uuid.uuid4().hex
    fs, hidden = file_system(spark, f"{base}/manifests/_{token}")
    final = f"{base}/manifests/{new.version}"
    fs.mkdirs(hidden)
    out = fs.create(file_system(spark, f"{hidden.toString()}/{token}.json")[1], False)
    out.write(bytearray(json.dumps(new._asdict()).encode()))
    out.close()
    try:
        fs.rename(hidden, file_system(spark, final)[1])
    except Py4JJavaError:
        if not fs.exists(file_system(spark, final)[1]):
            raise
    won = fs.exists(file_system(spark, f"{final}/{token}.json")[1])
    if won and versions(spark, base)[-1] > new.version:  # its number was taken, and expired meanwhile
        fs.delete(file_system(spark, final)[1], True)
        return False
    if not won:
        for left in (hidden, file_system(spark, f"{final}/_{token}")[1]):
            fs.delete(left, True)
    return won


def prune_versions(spark: SparkSession, base: str, keep: int = KEEP, leftovers_after: float = LEFTOVERS_AFTER) -> None:
    """Delete all but the last ``keep`` versions, with the folders that only they name.

    Folders that no manifest names go once they are ``leftovers_after`` seconds
    old; younger ones may belong to a save that is under way.
    """
    if keep < 1:
        raise ValueError("at least one version has to stay")
    known = versions(spark, base)
    named = {n: {s.users, *s.tags.values()} for n in known if (s := snapshot(spark, base, n))}
    live = set().union(*(named[n] for n in known[-keep:] if n in named))
    expired = set().union(*(named[n] for n in known[:-keep] if n in named)) - live
    fs, data = file_system(spark, f"{base}/data")
    for n in known[:-keep]:
        fs.delete(file_system(spark, f"{base}/manifests/{n}")[1], True)
    for status in fs.listStatus(data) if fs.exists(data) else []:
        name = status.getPath().getName()
        left = name not in live and time.time() - status.getModificationTime() / 1000 >= leftovers_after
        if name in expired or left:
            fs.delete(status.getPath(), True)


def _bucketed_scan(spark: SparkSession, path: str, schema: StructType, key: str, buckets: int) -> DataFrame:
    """Scan of bucketed files that Spark knows to be bucketed, without declaring a table.

    The reader has no option for buckets, so the relation it would make is made
    with them. Where this Spark makes relations in another way, the files are read
    without that knowledge: the same rows, at the price of a shuffle.
    """
    jvm = spark._jvm
    try:
        seq, option = jvm.PythonUtils.toSeq, jvm.scala.Option
        keys = seq([key])
        spec = jvm.org.apache.spark.sql.catalyst.catalog.BucketSpec(buckets, keys, keys)
        fields = jvm.org.apache.spark.sql.types.DataType.fromJson(schema.json())
        source = jvm.org.apache.spark.sql.execution.datasources.DataSource(
            spark._jsparkSession, "parquet", seq([absolute(spark, path)]), option.apply(fields), seq([]),
            option.apply(spec), jvm.PythonUtils.toScalaMap({}), option.empty(),
        )
        return DataFrame(spark._jsparkSession.baseRelationToDataFrame(source.resolveRelation(True, True)), spark)
    except Py4JJavaError:
        raise  # the files themselves are at fault
    except (Py4JError, TypeError):
        log.warning("buckets of %s are not used", path)
        return spark.read.schema(schema).parquet(path)


def _write_bucketed(df: DataFrame, path: str, key: str, buckets: int) -> None:
    # Only a table can be written in buckets; dropping it leaves its files alone.
    name = f"spark_catalog.default.tagweave_{uuid.uuid4().hex}"
    writer = df.write.format("parquet").bucketBy(buckets, key).sortBy(key)
    writer.option("path", absolute(df.sparkSession, path)).saveAsTable(name)
    df.sparkSession.sql(f"DROP TABLE {name}")


def _column(spark: SparkSession, base: str, folder: str, names: list[str], buckets: int) -> DataFrame:
    """A stored folder: the key, and the tag unless it is the folder of the keys."""
    schema = StructType([StructField(n, StringType()) for n in names])
    return _bucketed_scan(spark, f"{base}/data/{folder}", schema, names[0], buckets)


def read_profile(
    spark: SparkSession, base: str, key: str = "userId", tags: list[str] | None = None, version: int | None = None
) -> DataFrame:
    """A stored version, the newest unless given, with all its tags or some of them.

    One row per key. The folders are joined to that of the keys, bucket by bucket.
    """
    stored = snapshot(spark, base, version)
    if stored is None:
        raise ValueError(f"no profile at {base}" + ("" if version is None else f" with version {version}"))
    wanted = list(stored.tags) if tags is None else tags
    if lacking := [t for t in wanted if t not in stored.tags]:
        raise ValueError(f"the profile has no {', '.join(lacking)}")
    found = _column(spark, base, stored.users, [key], stored.buckets)
    for tag in wanted:
        found = found.join(_column(spark, base, stored.tags[tag], [key, tag], stored.buckets), key, "left")
    return found.select(key, *[F.col(f"`{t}`") for t in wanted])


def _merged(old: DataFrame | None, new: DataFrame, key: str) -> DataFrame:
    """One column, or the keys alone: what ``new`` has counts, then what ``old`` has."""
    if old is None:
        return new
    joined = old.alias("old").join(new.alias("new"), key, "full_outer")
    tags = [F.coalesce(F.col(f"new.`{t}`"), F.col(f"old.`{t}`")).alias(t) for t in new.columns if t != key]
    return joined.select(key, *tags)


def save_profile(
    new: DataFrame,
    base: str,
    key: str = "userId",
    mode: str = "upsert",
    buckets: int | None = None,
    keep: int = KEEP,
) -> DataFrame:
    """Put ``new`` into the stored profile, or in its place if ``mode`` is overwrite; returns the version saved.

    ``buckets`` is that of the last version, for a first one the number of
    shuffle partitions; choose it so that a bucket of a tag is a few dozen
    megabytes. Another number rewrites all tags. Of older versions ``keep`` less
    one stay.
    """
    if mode not in ("upsert", "overwrite"):
        raise ValueError(f"unknown save mode {mode!r}")
    spark = new.sparkSession
    fresh = stage(assemble([new], key), "fresh")
    fresh_tags = [c for c in fresh.columns if c != key]
    written: dict[str | None, tuple] = {}  # column (None: the keys) -> what it was made from, where it is

    def write(column: str | None, old: Snapshot | None, count: int) -> str:
        folder = uuid.uuid4().hex
        names = [key] if column is None else [key, column]
        before = None
        if old and (column is None or column in old.tags):
            before = _column(spark, base, old.users if column is None else old.tags[column], names, old.buckets)
        if column is None:
            rows = _merged(before, fresh.select(key), key)
        elif column in fresh_tags:
            rows = _merged(before, fresh.select(*[F.col(f"`{n}`") for n in names]).filter(F.col(f"`{column}`").isNotNull()), key)
        else:
            rows = before
        if before is None or old.buckets != count:
            rows = rows.repartition(count, key)  # one file per bucket
        _write_bucketed(rows, f"{base}/data/{folder}", key, count)
        return folder

    while True:
        last = snapshot(spark, base)
        old = last if mode == "upsert" else None
        count = buckets or (last.buckets if last else int(spark.conf.get("spark.sql.shuffle.partitions")))
        columns = [None, *fresh_tags]
        if old and old.buckets != count:
            columns += [t for t in old.tags if t not in fresh_tags]
        source = {c: (count, old and (old.users if c is None else old.tags.get(c))) for c in columns}
        changed = [c for c in columns if c not in written or written[c][0] != source[c]]
        with ThreadPoolExecutor(WRITERS) as pool:
            folders = list(pool.map(lambda c: write(c, old, count), changed))
        written |= {c: (source[c], folder) for c, folder in zip(changed, folders, strict=True)}
        tags = {**(old.tags if old else {}), **{c: written[c][1] for c in columns if c is not None}}
        saved = Snapshot(last.version + 1 if last else 0, count, written[None][1], tags)
        if _publish(spark, base, saved):
            break
        log.info("version %d was taken, merging again", saved.version)
    prune_versions(spark, base, keep)
    return read_profile(spark, base, key, version=saved.version)


def copy_fields(source: DataFrame, fields: list[str], key: str, base: str) -> DataFrame:
    """Copy some fields of a table into a stored profile keyed by ``key``."""
    return save_profile(source.select(*fields), base, key)
