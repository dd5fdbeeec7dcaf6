"""Mixing sources to target weights by Sainte-Laguë apportionment of equal-token blocks.

Every source's share of the mix is its weight's share of all words, but no more
than ``most`` times what it has; what is cut off is shared again by weight until
no source is above its limit. The mix is counted in blocks of ``block_words``
words. Blocks go to sources by highest quotients (share / 1, 3, 5, ...), and a
source's blocks to its shards in the same way, which gives every shard a whole
number of blocks. A shard is about ``shard_words`` words of one source in seeded
order, read as one stream: its quota takes the whole stream as often as it goes
in, then the first blocks of the stream. So a document is taken whole, a whole
number of times, but for one at each shard's end, which is cut between words.

The quotients are not listed: the final divisor lies between the two that give
half a block more or less for each party, so only the few quotients between
those compete (at most four for each party on average).

Defined cases: a null text has no words; documents without words are never taken
(``taken`` 0). A null source is a source of its own, after all others. Rows that
repeat an id are documents of their own, which lie side by side in the stream.
Rows are dealt to shards by id and text, so rows without an id spread, too. Ties in
the seeded order go by id and size. Texts are read whole, however long. An empty
table, or one without any word, gives targets of 0. Columns with other names are
kept by ``mixed``, whatever they are called, and never read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tagweave.llm.common import SPACE, WORD, with_plain_names
from tagweave.operators.features import numbered_copies
from tagweave.operators.numbering import number_rows
from tagweave.storage import stage

BLOCK_WORDS = 64
SHARD_WORDS = 1 << 20


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def seeded_order(row_id: Column, digest: Column, seed: int) -> Column:
    """Where a row comes in the seeded order: by its id and the MD5 of its text."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(row_id.cast("string"), F.lit("")), F.lit(":"), digest))


def text_digest(text_col: str) -> Column:
    return F.md5(F.coalesce(F.col(text_col), F.lit("")))


def cyclic_weights(sizes: DataFrame, cycle: int = 3) -> DataFrame:
    """Sources numbered by code point, null last, with weights 1, 2, ... ``cycle``, repeating."""
    numbered = number_rows(sizes, "source_no", F.col("source").asc_nulls_last())
    return numbered.withColumn("weight", F.col("source_no") % cycle + 1)


def targets(weighted: DataFrame, most: int = 3) -> DataFrame:
    """Add ``target`` to rows of ``source_size, weight``: shares of the sum of all sizes.

    Each round is one aggregate over one row per source; the sources at their
    limit keep it, the others share the rest by weight.
    """
    limit = most * F.col("source_size")
    total = weighted.agg(F.sum("source_size")).first()[0] or 0
    unit = None
    while True:
        above = F.lit(False) if unit is None else limit < F.lit(unit) * F.col("weight")
        rest = weighted.agg(
            F.sum(F.when(above, limit).otherwise(0)).alias("full"), F.sum(F.when(above, 0).otherwise(F.col("weight"))).alias("weights")
        ).first()
        now = (total - (rest.full or 0)) / rest.weights if rest.weights else 0.0
        if unit is not None and (not rest.weights or now <= unit):
            break
        unit = now
    share = F.lit(unit) * F.col("weight")
    return weighted.withColumn("target", F.when(limit < share, limit.cast("double")).otherwise(share.cast("double")))


def apportion(parties: DataFrame, group: str, key: str, votes: str, seats: str) -> DataFrame:
    """Sainte-Laguë seats of each party: ``group, key, quota``.

    ``parties`` has one row per (group, key) with its ``votes`` and the ``seats``
    of its group. Equal quotients go to the smaller key. The competing quotients
    are ranked over the whole table at once, so that no group needs one task.
    """
    totals = parties.groupBy(group).agg(F.sum(votes).alias("__all"), F.count(F.lit(1)).alias("__n"))
    rows = parties.select(group, key, F.col(votes).cast("double").alias("__votes"), F.col(seats).cast("long").alias("__seats"))
    rows = rows.join(totals, group)
    part = F.when(F.col("__all") > 0, F.col("__votes") / F.col("__all")).otherwise(0.0)
    low = F.greatest(F.lit(0), F.floor(part * (F.col("__seats") - F.col("__n") / 2) + 0.5) - 1).cast("long")
    high = (F.floor(part * (F.col("__seats") + F.col("__n") / 2) + 0.5) + 1).cast("long")
    rows = stage(rows.select(group, key, "__votes", "__seats", low.alias("__low"), high.alias("__high")), "parties")
    tried = rows.filter("__votes > 0").select(group, key, "__votes", F.explode(F.sequence("__low", F.col("__high") - 1)).alias("__k"))
    tried = tried.withColumn("__quotient", F.col("__votes") / (2 * F.col("__k") + 1))
    tried = number_rows(tried, "__place", group, F.desc("__quotient"), key, "__k")
    first = tried.groupBy(group).agg(F.min("__place").alias("__first"))
    left = rows.groupBy(group).agg((F.first("__seats") - F.sum("__low")).alias("__left"))
    won = tried.join(first, group).join(left, group).filter("__place - __first < __left")
    won = won.groupBy(group, key).agg(F.count(F.lit(1)).alias("__won"))
    quota = F.col("__low") + F.coalesce("__won", F.lit(0))
    return rows.join(won, [group, key], "left").select(group, key, quota.cast("long").alias("quota"))


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights=cyclic_weights,
    most: int = 3,
    block_words: int = BLOCK_WORDS,
    shard_words: int = SHARD_WORDS,
    seed: int = 7,
    keep: list[str] | None = None,
) -> DataFrame:
    """What the mix takes of each row: ``id, source, size, source_size, target, times, first_words, taken``.

    The row is taken ``times`` times as a whole and then once more its first
    ``first_words`` words. ``weights`` adds ``source_no`` and ``weight`` to rows of
    ``source, source_size``. The same rows give the same mix, however they are
    partitioned. ``keep`` adds columns of the plan, such as ``shard``.
    """
    text = text_digest(text_col).alias("text")
    rows = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"), text)
    rows = stage(rows, "sizes")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = stage(targets(weights(sizes), most), "sources")
    smallest = sources.filter("target > 0").agg(F.min("target")).first()[0]
    block = max(1, min(block_words, int((smallest or 0) // 8)))
    total = F.sum("source_size").over(Window.partitionBy(F.lit(0)))
    seats = apportion(
        sources.select(F.lit(0).alias("all"), "source_no", "target", F.round(total / block).cast("long").alias("seats")),
        "all", "source_no", "target", "seats",
    ).select("source_no", F.col("quota").alias("seats"))

    known = F.broadcast(sources) if sources.count() <= 100_000 else sources
    named = rows.join(known.withColumnRenamed("source", "__of"), F.col("source").eqNullSafe(F.col("__of"))).drop("__of")
    dealt = seeded_order(F.col("id"), F.col("text"), seed)
    shards = F.greatest(F.lit(1), F.ceil(F.col("source_size") / shard_words))
    named = named.withColumns({"__order": dealt, "shard": F.pmod(F.conv(dealt.substr(1, 8), 16, 10).cast("long"), shards)}).drop("text")
    full = named.filter("size > 0")
    units = full.groupBy("source_no", "shard").agg(F.sum("size").alias("words"))
    units = stage(units.join(seats, "source_no"), "shards")
    quotas = apportion(units, "source_no", "shard", "words", "seats").join(units.drop("seats"), ["source_no", "shard"])
    given = F.least(F.col("quota") * block, most * F.col("words"))
    quotas = quotas.select(
        "source_no",
        "shard",
        F.floor(given / F.col("words")).alias("__times"),
        (given % F.col("words")).alias("__until"),
    )
    stream = Window.partitionBy("source_no", "shard").orderBy("__order", "id", "size").rowsBetween(Window.unboundedPreceding, -1)
    full = full.withColumn("__from", F.coalesce(F.sum("size").over(stream), F.lit(0)))
    full = full.join(quotas, ["source_no", "shard"])
    first = F.greatest(F.lit(0), F.least(F.col("size"), F.col("__until") - F.col("__from")))
    # All of its words once more is one more time.
    whole = (first == F.col("size")).cast("long")
    none = F.lit(0).cast("long")
    columns = ["id", "source", "size", "source_size", "target", *(keep or [])]
    taken = full.select(*columns, (F.col("__times") + whole).cast("long").alias("times"), (first * (1 - whole)).cast("long").alias("first_words"))
    rest = named.filter("size = 0").select(*columns, none.alias("times"), none.alias("first_words"))
    return taken.unionByName(rest).withColumn("taken", F.col("times") * F.col("size") + F.col("first_words"))


def mixed(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 7, **options
) -> DataFrame:
    """The mix itself, with all columns of ``docs``: each row as often as it is taken.

    A document that is taken in part is there with its first words, up to the
    space behind them. Rows that agree in id, text and source share what is taken
    of them in no particular order.
    """
    plan = mix(docs, id_col, text_col, source_col, seed=seed, keep=["__order"], **options).filter("size > 0")
    plan = stage(plan.select(F.col("source").alias("of_source"), F.col("__order").alias("of"), "times", "first_words", "taken"), "plan")
    rows, row_id, text, source = with_plain_names(docs, id_col, text_col, source_col)
    names = rows.columns
    rows = rows.withColumn("order", seeded_order(F.col(row_id), text_digest(text), seed))
    here = (F.col("order") == F.col("of")) & F.col(source).eqNullSafe(F.col("of_source"))
    if not plan.groupBy("of", "of_source").count().filter("count > 1").isEmpty():
        # Equal rows are told apart by a number.
        plan = numbered_copies(plan, ["of", "of_source"], "of_content", "of_nth")
        rows = numbered_copies(rows, ["order", source], "content", "nth")
        here &= F.col("nth") == F.col("of_nth")
    found = rows.join(plan.filter("taken > 0"), here)
    pieces = F.slice(F.regexp_extract_all(F.col(text), F.lit(rf"[{SPACE}]*{WORD}[{SPACE}]*"), F.lit(0)), F.lit(1), F.col("first_words").cast("int"))
    whole = F.array_repeat(F.col(text), F.col("times").cast("int"))
    texts = F.when(F.col("first_words") > 0, F.concat(whole, F.array(F.array_join(pieces, "")))).otherwise(whole)
    copies = found.select(*[c for c in names if c != text], F.explode(texts).alias(text))
    return copies.select(*names).toDF(*docs.columns)
