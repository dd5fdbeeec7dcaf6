"""Tag models: from a catalogue and a business table to one tag per user."""

from __future__ import annotations

import datetime as dt
import functools
import logging
import operator
from collections.abc import Callable
from typing import NamedTuple

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from tagweave.functions.bands import RFE_DOCUMENTED, RFM_DOCUMENTED, Preset, add_scores, score_columns
from tagweave.functions.money import bad_money
from tagweave.operators.match import match_rules
from tagweave.operators.measures import read_time, rfe, rfm
from tagweave.operators.segments import name_ranks, segment
from tagweave.sinks.profile import assemble, save_profile
from tagweave.sources.business import SourceDescriptor, TableResolver, describe_source, open_rows, source_filter, unreadable_window
from tagweave.sources.catalog import source_rule, tag_subtree, value_rules
from tagweave.storage import stage

log = logging.getLogger(__name__)

TAG_COLUMNS = ["userId", "tag_id", "tag_name"]


def tag_by_rule(
    business: DataFrame,
    tags: DataFrame,
    attribute: str,
    *,
    user: str = "id",
    how: str = "inner",
    on_missing: str = "null",
) -> DataFrame:
    """Tag users by the value of one attribute."""
    rows = business.select(F.col(user).alias("userId"), attribute)
    return match_rules(rows, attribute, value_rules(tags), how, on_missing).select(*TAG_COLUMNS)


def tag_gender(business: DataFrame, tags: DataFrame, as_of=None, **options) -> DataFrame:
    """Users whose gender has a tag."""
    return tag_by_rule(business, tags, "gender", **options)


def tag_job(business: DataFrame, tags: DataFrame, as_of=None, **options) -> DataFrame:
    """All users, with the tag of their job where it has one."""
    return tag_by_rule(business, tags, "job", how="left", **options)


def tag_by_segment(
    measured: DataFrame,
    tags: DataFrame,
    preset: Preset,
    *,
    k: int,
    max_iter: int,
    handle_invalid: str = "error",
    evaluate: bool = False,
    counts: dict[str, int] | None = None,
) -> DataFrame:
    """Tag users by the rank of the cluster their scores fall into.

    The scores are staged: one pass over the source serves the fit, the result
    and, with ``evaluate``, the silhouette in the log. ``counts`` gets the number
    of users that lack a score, which ``handle_invalid="skip"`` leaves out.
    """
    scores = score_columns(preset)
    scored = stage(add_scores(measured, preset), "scores")
    found = segment(scored, scores, k=k, max_iter=max_iter, handle_invalid=handle_invalid)
    if counts is not None:
        counts["users_without_scores"] = found.skipped
    log.info("%d clusters wanted, within-cluster squared error %f", k, found.cost)
    if evaluate:
        log.info("silhouette by squared Euclidean distance %s", found.silhouette())
    # One row per cluster, so at most k.
    named = name_ranks(found.ranks.select("rank"), value_rules(tags))
    return found.assigned.join(F.broadcast(named), "rank").select(*TAG_COLUMNS)


def tag_value(
    business: DataFrame,
    tags: DataFrame,
    as_of=None,
    *,
    preset: Preset = RFM_DOCUMENTED,
    handle_invalid: str = "error",
    counts: dict[str, int] | None = None,
    **columns,
) -> DataFrame:
    """Customer value in five segments."""
    measured = rfm(business, as_of, **columns)
    return tag_by_segment(measured, tags, preset, k=5, max_iter=10, handle_invalid=handle_invalid, counts=counts)


def tag_activity(
    business: DataFrame,
    tags: DataFrame,
    as_of=None,
    *,
    preset: Preset = RFE_DOCUMENTED,
    handle_invalid: str = "error",
    evaluate: bool = True,
    counts: dict[str, int] | None = None,
    **columns,
) -> DataFrame:
    """User activity in four segments."""
    measured = rfe(business, as_of, **columns)
    return tag_by_segment(
        measured, tags, preset, k=4, max_iter=20, handle_invalid=handle_invalid, evaluate=evaluate, counts=counts
    )


#: The time of a row once its text has been read.
READ_TIME = "_read_time"


def time_problems(time: str) -> dict[str, Column]:
    return {"rows_without_time": F.col(time).isNull(), "unreadable_times": F.col(time).isNotNull() & F.col(READ_TIME).isNull()}


def value_problems(
    orders: DataFrame, *, time: str = "finishtime", amount: str = "orderamount", text_time: str = "unix", **_
) -> tuple[str, DataFrame, dict[str, Column]]:
    """The time column, the orders with their time read, and those that the customer value cannot use in full."""
    read = orders.withColumn(READ_TIME, read_time(orders, time, text_time))
    return time, read, time_problems(time) | {"unreadable_amounts": bad_money(F.col(amount))}


def activity_problems(
    log: DataFrame, *, time: str = "log_time", text_time: str = "datetime", **_
) -> tuple[str, DataFrame, dict[str, Column]]:
    """The time column, the behaviour log with its time read, and the rows that the activity cannot use in full."""
    return time, log.withColumn(READ_TIME, read_time(log, time, text_time)), time_problems(time)


class TagModel(NamedTuple):
    column: str  # column of the profile
    kind: str  # MATCH or ML
    compute: Callable[..., DataFrame]
    user: str = "id"  # column of the business table
    problems: Callable[..., tuple[str, DataFrame, dict[str, Column]]] | None = None  # rows to count while they are read


# Catalogue ids of the four tags.
TAG_MODELS = {
    318: TagModel("gender", "MATCH", tag_gender),
    321: TagModel("job", "MATCH", tag_job),
    361: TagModel("rfm", "ML", tag_value, "memberid", value_problems),
    367: TagModel("rfe", "ML", tag_activity, "global_user_id", activity_problems),
}


class TagRun(NamedTuple):
    """What a run has stored, and what it met on the way."""

    profile: DataFrame
    counts: dict[int, dict[str, int]]  # by tag


def profile_column(tagged: DataFrame, column: str) -> DataFrame:
    """Tagged users as the part of the profile the tag fills."""
    return tagged.select("userId", F.col("tag_name").alias(column))


class Counted:
    """Rows counted by kind while they are read, without a pass of their own."""

    def __init__(self) -> None:
        self.watched: list[tuple[int, Observation]] = []

    def watch(self, rows: DataFrame, tag_ids: list[int], kinds: dict[str, Column]) -> DataFrame:
        if not kinds:
            return rows
        observation = Observation()
        self.watched += [(tag_id, observation) for tag_id in tag_ids]
        return rows.observe(observation, *[F.count_if(kind).alias(name) for name, kind in kinds.items()])

    def counts(self) -> dict[int, dict[str, int]]:
        """Known once the rows have been read."""
        found: dict[int, dict[str, int]] = {}
        for tag_id, observation in self.watched:
            found.setdefault(tag_id, {}).update(observation.get)
        return found


def business_rows(
    spark: SparkSession,
    sources: dict[int, SourceDescriptor],
    counted: Counted,
    as_of: dt.date | None = None,
    tables: TableResolver | None = None,
) -> dict[int, DataFrame]:
    """The rows of each tag, with the types of the source; each place is opened and scanned once.

    What several tags read from one place is the union of their fields and of
    their filters, staged with a mark for each tag. Where a window has to read
    dates from text, rows whose text is no date are counted; that needs all rows,
    so the years of the window are not pushed to the scan then.
    """
    groups: dict[tuple, list[int]] = {}
    for tag_id, s in sources.items():
        groups.setdefault((s.kind, s.location, s.family, tuple(sorted(s.options.items()))), []).append(tag_id)
    out = {}
    for ids in groups.values():
        df = open_rows(spark, [sources[i] for i in ids], tables)
        for i in ids:
            text_dates = unreadable_window(sources[i], df.schema)
            if text_dates is not None:
                df = counted.watch(df, [i], {"unreadable_window_dates": text_dates})
        wanted = {i: source_filter(sources[i], df.schema, as_of) for i in ids}
        if len(ids) > 1:
            marks = {i: f"_due_{i}" for i in ids}
            if all(chosen is not None for chosen in wanted.values()):
                df = df.filter(functools.reduce(operator.or_, wanted.values()))
            fields = list(dict.fromkeys(f for i in ids for f in sources[i].fields))
            due = [(F.lit(True) if wanted[i] is None else wanted[i]).alias(marks[i]) for i in ids]
            df = stage(df.select(*fields, *due), "business")
            wanted = {i: F.col(marks[i]) for i in ids}
        for i in ids:
            rows = df if wanted[i] is None else df.filter(wanted[i])
            out[i] = rows.select(*sources[i].fields)
    return out


def run_tags(
    catalog: DataFrame,
    tag_ids: list[int],
    profile: str,
    *,
    as_of: dt.date | None = None,
    tables: TableResolver | None = None,
    models: dict[int, TagModel] | None = None,
    options: dict[int, dict] | None = None,
    handle_invalid: str = "error",
) -> TagRun:
    """Compute tags from the catalogue on and put them into the profile at ``profile`` in one save.

    Tags that read the same place share its scan. ``options`` go to the model of
    a tag: columns, ``text_time``, ``preset``. Rows without a user and users
    without a score are an error, or left out with ``handle_invalid="skip"``;
    they are counted either way, like times and amounts that cannot be read.
    """
    if handle_invalid not in ("error", "skip"):
        raise ValueError(f"unknown handle_invalid {handle_invalid!r}")
    spark = catalog.sparkSession
    chosen = {i: (models or TAG_MODELS)[i] for i in tag_ids}
    due = catalog.filter(F.col("id").isin(*tag_ids) | F.col("pid").isin(*tag_ids)).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        subtrees = {i: tag_subtree(due, i) for i in tag_ids}
        sources = {i: describe_source(source_rule(tags)) for i, tags in subtrees.items()}
        counted, own, frames = Counted(), {i: {} for i in tag_ids}, []
        rows = business_rows(spark, sources, counted, as_of, tables)
        for i, model in chosen.items():
            extra = dict((options or {}).get(i, {}))
            user = F.col(extra.get("user", model.user))
            kinds, read, time = {"rows_without_user": user.isNull()}, rows[i], None
            if model.problems:
                time, read, others = model.problems(read, **extra)
                kinds |= others
            read = counted.watch(read, [i], kinds)
            if time:  # text is read once, for the counts and for the measures
                read = read.withColumn(time, F.col(READ_TIME)).drop(READ_TIME)
            if handle_invalid == "skip":
                read = read.filter(user.isNotNull())
            if model.kind == "ML":
                extra |= {"handle_invalid": handle_invalid, "counts": own[i]}
            frames.append(profile_column(model.compute(read, subtrees[i], as_of, **extra), model.column))
        stored = save_profile(assemble(frames), profile)
        found = counted.counts()
        return TagRun(stored, {i: {**found.get(i, {}), **own[i]} for i in tag_ids})
    finally:
        due.unpersist()


def run_tag(
    catalog: DataFrame,
    tag_id: int,
    profile: str,
    *,
    as_of: dt.date | None = None,
    tables: TableResolver | None = None,
    model: TagModel | None = None,
    handle_invalid: str = "error",
    **options,
) -> TagRun:
    """Compute one tag from the catalogue on and put it into the profile at ``profile``."""
    return run_tags(
        catalog, [tag_id], profile, as_of=as_of, tables=tables, models={tag_id: model} if model else None,
        options={tag_id: options}, handle_invalid=handle_invalid,
    )
