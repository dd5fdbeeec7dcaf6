"""Near-duplicates: universal hash minima in bands, links confirmed on full sets, components.

A document's set holds its distinct shingles of ``words`` words (A-Z lower-cased;
a document with fewer words is one shingle). Documents with equal sets are one
node from the start. Each node has ``BANDS * ROWS`` minima of universal hashes
``a * x + b``; nodes that agree in all rows of a band share a bucket. With 32
bands of 5 rows a pair at similarity 0.8 shares none with a chance of 3 in a
million.

A bucket's pairs are not listed. Its first node is the pivot, and all others are
compared to it on their full sets. Two nodes of a bucket still need a comparison
only if they are in different components by now and, distance being a metric,
their distances to the pivot differ by no more than a link's. Those nodes get a
second pivot. Those still outside are then compared to the pivot's whole
component, and to each other bucket by bucket, in blocks inside tasks, after a
look at sizes and signatures, whose estimate must be within ``BLOCK_SLACK`` (six
standard deviations) of the threshold. So a group of n copies costs about n
comparisons in each bucket, and no link is given up for a bucket's size.

Components come from alternating large-star and small-star.

Defined cases: a null or empty text, and one of spaces only, has an empty set,
is linked with nothing and is a component of its own. Rows that repeat an id
belong to whatever their texts belong to; rows without an id come last. The
smallest id of a component names it; two components may have one name where rows
repeat an id. Texts are read whole, however long. An empty table gives an empty
result. Only the two named columns are read; ``deduplicate`` keeps the others as
they are, whatever they are called.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tagweave.llm.common import text_or_empty, with_plain_names
from tagweave.llm.components import components
from tagweave.llm.repeats import free_shuffles
from tagweave.operators.numbering import number_rows
from tagweave.storage import release, stage

BANDS, ROWS = 32, 5
BLOCK_SLACK = 0.2
#: Bytes of sets on one side of a block.
BLOCK_BYTES = 1 << 19
#: Members compared to one copy of a pivot's set.
SHARE = 256

_rng = np.random.default_rng(7)
_A = _rng.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _rng.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64)
_R = int(_rng.integers(1 << 40, 1 << 60)) * 8 + 3
_R_BACK = pow(_R, -1, 1 << 64)
_MIX = np.uint64(0x9E3779B97F4A7C15)
#: Bytes hashed at a time; powers of the multiplier up to there.
PIECE = 1 << 16


def _powers(base: int, n: int) -> np.ndarray:
    steps = np.full(n, base, np.uint64)
    steps[0] = 1
    return np.multiply.accumulate(steps)


_FORTH, _BACK = _powers(_R, PIECE + 1), _powers(_R_BACK, PIECE + 1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MIX
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def word_hashes(body: bytes) -> np.ndarray:
    """64-bit hashes of the words of a text, in order, A-Z in lower case."""
    data = np.frombuffer(body, np.uint8)
    data = np.where((data >= 65) & (data <= 90), data + 32, data)
    inside = ~((data == 32) | ((data >= 9) & (data <= 13)))
    edges = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False]))))
    starts, ends = edges[::2], edges[1::2]
    out = np.zeros(len(starts), np.uint64)
    first = 0
    while first < len(starts):
        # Words of one piece; a word longer than a piece is hashed by itself.
        last = int(np.searchsorted(ends, starts[first] + PIECE, "right"))
        if last == first:
            digest = hashlib.blake2b(data[starts[first] : ends[first]].tobytes(), digest_size=8).digest()
            out[first] = int.from_bytes(digest, "little")
            first += 1
            continue
        at, upto = starts[first], ends[last - 1]
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((data[at:upto].astype(np.uint64) + np.uint64(1)) * _FORTH[: upto - at])))
        s, e = starts[first:last] - at, ends[first:last] - at
        out[first:last] = _mixed((sums[e] - sums[s]) * _BACK[s] + (e - s).astype(np.uint64))
        first = last
    return out


def shingles(body: bytes, words: int) -> np.ndarray:
    """The distinct shingles of a text as sorted 64-bit hashes."""
    hashes = word_hashes(body)
    width = min(words, len(hashes))
    if not width:
        return hashes
    joined = np.full(len(hashes) - width + 1, width, np.uint64)
    for k in range(width):
        joined = _mixed(joined * _MIX + hashes[k : len(hashes) - width + 1 + k])
    return np.unique(joined)


def signature(found: np.ndarray) -> np.ndarray:
    """The upper 32 bits of each hash function's minimum over a set."""
    least = np.full(len(_A), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(found), 1024):
        least = np.minimum(least, (np.multiply.outer(_A, found[at : at + 1024]) + _B[:, None]).min(axis=1))
    return (least >> np.uint64(32)).astype("<u4")


def _signatures(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, digests, signs = [], [], []
            for body in batch.column("body"):
                found = shingles(body.as_py(), words)
                sizes.append(len(found))
                digests.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest())
                signs.append(signature(found).tobytes() if len(found) else None)
            columns = [batch.column("id"), batch.column("md5"), pa.array(sizes, "int64"), pa.array(digests, "binary"), pa.array(signs, "binary")]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "md5", "n_shingles", "digest", "sign"])

    return run


def _sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                found = [shingles(body.as_py(), words).tobytes() for body in some.column("body")]
                yield pa.RecordBatch.from_arrays([some.column("no"), pa.array(found, "binary")], names=["no", "shingles"])

    return run


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted so that a pivot's own set (``no`` null) comes before its members'."""
    own = None
    for batch in batches:
        pivots, nos, shared, total = [], [], [], []
        for pivot, no, body in zip(batch.column("pivot").to_pylist(), batch.column("no").to_pylist(), batch.column("shingles"), strict=True):
            found = np.frombuffer(body.as_py(), np.uint64)
            if no is None:
                own = found
                continue
            places = np.searchsorted(own, found)
            places[places == len(own)] = 0
            both = int((own[places] == found).sum()) if len(own) else 0
            pivots.append(pivot)
            nos.append(no)
            shared.append(both)
            total.append(len(own) + len(found) - both)
        columns = [pa.array(x, "int64") for x in (pivots, nos, shared, total)]
        yield pa.RecordBatch.from_arrays(columns, names=["pivot", "no", "shared", "total"])


def compare(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Sizes of intersection and union for pairs (``pivot, no``): a pivot's set goes once to each share of its pairs."""
    shares = pairs.groupBy("pivot").agg(F.ceil(F.count(F.lit(1)) / SHARE).cast("int").alias("shares"))
    dealt = pairs.join(shares, "pivot").select("pivot", "no", F.pmod(F.xxhash64("no"), F.col("shares")).cast("int").alias("share"))
    members = dealt.join(sets, "no").select("pivot", "no", "share", "shingles")
    own = shares.join(sets, F.col("pivot") == F.col("no")).select(
        "pivot", F.lit(None).cast("long").alias("no"), F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share"), "shingles"
    )
    rows = own.unionByName(members).repartition("pivot", "share")
    rows = rows.sortWithinPartitions("pivot", "share", F.col("no").asc_nulls_first())
    return rows.select("pivot", "no", "shingles").mapInArrow(_compare, "pivot bigint, no bigint, shared bigint, total bigint")


def _block_links(threshold: int):
    """Links between different components on the two sides of a block: for a node of the second side one with each."""
    nearest = threshold / 100 - BLOCK_SLACK

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, kept, signs, sizes, roots = None, [], None, None, None
        for batch in batches:
            links: list[tuple[int, int]] = []
            columns = [batch.column(c) for c in ("pair", "one", "two", "second", "no", "root", "shingles", "sign")]
            for pair, one, two, second, no, root, body, sign in zip(*[c.to_pylist() for c in columns], strict=True):
                found, own = np.frombuffer(body, np.uint64), np.frombuffer(sign, np.uint32)
                if block != (pair, one, two):
                    block, kept, signs = (pair, one, two), [], None
                if not second:
                    kept.append((no, found, own, root))
                    continue
                if not kept:
                    continue
                if signs is None:
                    signs, sizes = np.stack([k[2] for k in kept]), np.array([len(k[1]) for k in kept])
                    roots = np.array([k[3] for k in kept])
                alike = np.minimum(sizes, len(found)) * 100 >= np.maximum(sizes, len(found)) * threshold
                alike &= roots != root
                alike[alike] = (signs[alike] == own).mean(axis=1) >= nearest
                linked = set()
                for i in np.flatnonzero(alike):
                    if kept[i][3] in linked:
                        continue
                    places = np.searchsorted(found, kept[i][1])
                    places[places == len(found)] = 0
                    both = int((found[places] == kept[i][1]).sum())
                    if both * 100 >= (len(found) + len(kept[i][1]) - both) * threshold:
                        links.append((kept[i][0], no))
                        linked.add(kept[i][3])
            a, b = zip(*links, strict=True) if links else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(a, "int64"), pa.array(b, "int64")], names=["a", "b"])

    return run


def in_blocks(first: DataFrame, second: DataFrame, sets: DataFrame, signs: DataFrame, threshold: int) -> DataFrame:
    """Links ``a, b`` between the nodes of two sides (``pair, no``) of each pair.

    Each side is dealt to shares of about ``BLOCK_BYTES`` of sets, and every share
    of one side meets every share of the other in a block, so sets are moved once
    for each block and no pair of nodes is ever a row.
    """
    known = sets.join(signs, "no")

    def dealt(side: DataFrame) -> tuple[DataFrame, DataFrame]:
        rows = side.join(known, "no")
        shares = rows.groupBy("pair").agg(F.ceil(F.sum(F.octet_length("shingles")) / BLOCK_BYTES).cast("int").alias("shares"))
        return rows, shares

    (one, one_shares), (two, two_shares) = dealt(first), dealt(second)
    shares = one_shares.withColumnRenamed("shares", "ones").join(two_shares.withColumnRenamed("shares", "twos"), "pair")
    share = lambda n: F.pmod(F.xxhash64("no"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    one = one.join(shares, "pair").select("pair", share("ones").alias("one"), every("twos").alias("two"), F.lit(False).alias("second"), "no", "root", "shingles", "sign")
    two = two.join(shares, "pair").select("pair", every("ones").alias("one"), share("twos").alias("two"), F.lit(True).alias("second"), "no", "root", "shingles", "sign")
    rows = one.unionByName(two).repartition("pair", "one", "two").sortWithinPartitions("pair", "one", "two", "second", "no")
    return rows.mapInArrow(_block_links(threshold), "a bigint, b bigint")


def _close(threshold: int):
    return F.col("shared") * 100 >= F.col("total") * threshold


def links(nodes: DataFrame, sets_of, threshold: int) -> DataFrame:
    """Confirmed pairs ``a, b`` of nodes, enough of them to connect what is linked.

    ``nodes`` has ``no, n_shingles, sign``; ``sets_of`` gives the full sets of some.
    """
    reach = 1 - threshold / 100
    signed = nodes.filter("sign is not null")
    keys = [F.xxhash64(F.lit(b), F.substring("sign", b * ROWS * 4 + 1, ROWS * 4)) for b in range(BANDS)]
    rows = signed.select("no", F.explode(F.array(*keys)).alias("key"))
    heads = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("no").alias("pivot")).filter("n > 1")
    buckets = stage(rows.join(heads.drop("n"), "key").select("key", "pivot", "no"), "buckets")
    sets = stage(sets_of(buckets.select("no").distinct()), "sets")
    free_shuffles(nodes.sparkSession)

    tested = stage(compare(buckets.filter("no <> pivot").select("pivot", "no").distinct(), sets), "tested")
    found = tested.filter(_close(threshold)).select(F.col("pivot").alias("a"), F.col("no").alias("b"))
    free_shuffles(nodes.sparkSession)

    def placed(members: DataFrame, found: DataFrame) -> DataFrame:
        """Members of buckets that still hold several components."""
        roots = components(found)
        known = members.join(roots, F.col("no") == F.col("node"), "left")
        known = known.withColumn("root", F.coalesce("root", "no")).drop("node")
        open_keys = known.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low < high").select("key")
        return stage(known.join(open_keys, "key"), "open")

    def may_link(a: str, b: str):
        return F.abs(F.col(a) - F.col(b)) <= F.lit(reach + 1e-9)

    far = (1 - F.col("shared") / F.col("total")).alias("far")
    away = tested.select("pivot", "no", far)
    members = placed(buckets, found)
    members = members.join(away, ["pivot", "no"], "left").withColumn("far", F.coalesce("far", F.lit(0.0)))
    # A second pivot: the first node outside the pivot's component.
    home = members.filter("no = pivot").select("key", F.col("root").alias("home"))
    outside = members.join(home, "key").filter((F.col("root") != F.col("home")))
    second = outside.groupBy("key").agg(F.min(F.struct("no", "root", "far")).alias("s"))
    second = second.select("key", F.col("s.no").alias("second"), F.col("s.root").alias("second_root"), F.col("s.far").alias("second_far"))
    members = stage(members.join(second, "key"), "members")
    pairs = members.filter((F.col("root") != F.col("second_root")) & (F.col("no") != F.col("pivot")) & may_link("far", "second_far"))
    pairs = pairs.select(F.col("second").alias("pivot"), "no").distinct()
    again = stage(compare(pairs, sets), "again")
    free_shuffles(nodes.sparkSession)
    found = stage(found.unionByName(again.filter(_close(threshold)).select(F.col("pivot").alias("a"), F.col("no").alias("b"))), "found")

    # Nodes outside against the pivot's component, in blocks.
    left = placed(members.select("key", "pivot", "no", "far", "second"), found)
    home = left.filter("no = pivot").select("key", F.col("root").alias("home"))
    left = left.join(home, "key")
    reached = left.filter("root = home").groupBy("key").agg(F.max("far").alias("most"))
    inside = left.filter("root = home").select(F.col("home").alias("pair"), "no", "root").distinct()
    outside = left.filter("root <> home").join(reached, "key").filter(F.col("far") <= F.col("most") + reach + 1e-9)
    outside = outside.select(F.col("home").alias("pair"), "no", "root").distinct()
    across = stage(in_blocks(inside, outside, sets, nodes.select("no", "sign"), threshold), "across")
    found = stage(found.unionByName(across), "found")
    free_shuffles(nodes.sparkSession)

    # And against each other, bucket by bucket: nodes that have just come to the pivot's component, too.
    apart = left.filter("root <> home and no <> second").select(F.col("key").alias("pair"), "no")
    left = apart.join(components(found), F.col("no") == F.col("node"), "left").select("pair", "no", F.coalesce("root", "no").alias("root"))
    some = left.groupBy("pair").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low < high").select("pair")
    left = stage(left.join(some, "pair"), "left")
    if not left.isEmpty():
        last = stage(in_blocks(left, left, sets, nodes.select("no", "sign"), threshold), "last")
        found = found.unionByName(last)
    release(sets, buckets)
    free_shuffles(nodes.sparkSession)
    return found


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, threshold: int = 80) -> DataFrame:
    """One row per input row: ``id, n_shingles, component_id, md5, component``.

    ``threshold`` is in hundredths of the Jaccard similarity. ``md5`` is that of
    the row's text, ``component`` a number of the component (null for empty sets).
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.encode(text_or_empty(text_col), "UTF-8").alias("body"))
    rows = rows.withColumn("md5", F.unhex(F.md5("body")))
    signed = rows.mapInArrow(_signatures(words), f"id {id_type}, md5 binary, n_shingles bigint, digest binary, sign binary")
    signed = stage(signed, "signed")
    kinds = signed.filter("n_shingles > 0").groupBy("digest").agg(
        F.min(F.struct(F.col("id").isNull().alias("none"), "id", "md5")).alias("at"), F.max("n_shingles").alias("n_shingles"), F.min("sign").alias("sign")
    )
    kinds = kinds.select("digest", F.col("at.id").alias("first_id"), F.col("at.md5").alias("first_md5"), "n_shingles", "sign")
    nodes = stage(number_rows(kinds, "no", F.col("first_id").asc_nulls_last(), "digest"), "nodes")
    free_shuffles(docs.sparkSession)

    def sets_of(chosen: DataFrame) -> DataFrame:
        wanted = nodes.select("no", "first_id", "first_md5").join(chosen, "no")
        texts = rows.join(wanted, F.col("id").eqNullSafe(F.col("first_id")) & (F.col("md5") == F.col("first_md5")))
        found = texts.select("no", "body").mapInArrow(_sets(words), "no bigint, shingles binary")
        return found.dropDuplicates(["no"])

    roots = components(links(nodes, sets_of, threshold))
    ids = nodes.select(F.col("no").alias("root"), F.col("first_id").alias("component_id"))
    known = nodes.select("no", "digest").join(roots, F.col("no") == F.col("node"), "left")
    known = known.select("digest", F.coalesce("root", "no").alias("root")).join(ids, "root").select("digest", "component_id", "root")
    joined = signed.join(known.withColumn("linked", F.lit(True)), "digest", "left")
    own = F.when(F.col("linked"), F.col("component_id")).otherwise(F.col("id"))
    return joined.select("id", "n_shingles", own.alias("component_id"), "md5", F.col("root").alias("component"))


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, threshold: int = 80) -> DataFrame:
    """One document of each component, the one with the smallest id, with all columns.

    Documents without words stay. Of rows that repeat this id the one whose text has
    the smallest MD5 stays, of rows that repeat the text as well any one.
    """
    verdicts = stage(near_duplicates(docs, id_col, text_col, words, threshold), "verdicts")
    rows, row_id, text = with_plain_names(docs, id_col, text_col)
    key = [F.col("id").alias("of"), F.col("md5").alias("md5")]
    filled = verdicts.filter("n_shingles > 0")
    first = F.col("id").eqNullSafe(F.col("component_id"))
    leaving = filled.filter(~first).select(*key)
    several = filled.filter(first).groupBy("component").agg(F.count(F.lit(1)).alias("n"), F.min("md5").alias("least")).filter("n > 1")
    several = stage(several, "several")
    marked = rows.withColumn("own", F.unhex(F.md5(text_or_empty(text))))
    here = F.col(row_id).eqNullSafe(F.col("of")) & (F.col("own") == F.col("md5"))
    if several.isEmpty():
        return marked.join(leaving.distinct(), here, "left_anti").drop("own").toDF(*docs.columns)
    equals = filled.filter(first).groupBy("component", "id", "md5").agg(F.count(F.lit(1)).alias("n")).join(several.drop("n"), "component")
    equals = stage(equals, "equals")
    leaving = leaving.unionByName(equals.filter("md5 <> least").select(*key))
    twice = equals.filter("md5 = least and n > 1").select(*key)
    staying = marked.join(leaving.distinct(), here, "left_anti")
    repeated = staying.join(twice, here, "left_semi").dropDuplicates([row_id, "own"])
    staying = staying.join(twice, here, "left_anti").unionByName(repeated)
    return staying.drop("own").toDF(*docs.columns)
