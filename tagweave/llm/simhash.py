"""SimHash near-duplicates: 64-bit fingerprints joined with themselves over binary tries.

A document's words (A-Z lower-cased) give shingles of ``words`` words, repeats
included, joined by one space; a document with fewer words is one shingle. Each
shingle has a 64-bit XXH64; a bit of the fingerprint is 1 if it is set in over
half of them. Fingerprints that differ in at most ``BUDGET`` bits are linked.

Different fingerprints are joined with themselves by going down a binary trie in
pairs of nodes: a pair carries the bits in which its prefixes differ, and is
given up when those exceed what is allowed at its depth. So that the tops of the
tries separate well, each fingerprint stands in five tries, one for each of five
blocks of bits to begin with. If two fingerprints differ in at most 4 bits, then
for one of the five beginnings the first l blocks hold at most ``4 * l / 5`` of
them, whatever l is (the cycle lemma). That is the allowance: none in the first
block, one in two, and so on; every link is met in at least one trie.

The tries are distributed. Nodes with more than ``LEAF`` fingerprints are opened
by ``STEP`` bits at a time; pairs of nodes are rows, expanded and pruned level by
level, until both ends are leaves. A leaf is one row of at most ``LEAF``
fingerprints, so a prefix shared by a third of all fingerprints becomes many
leaves. Pairs of leaves go on down their tries inside tasks, and give the links
as a spanning forest: at most one edge for each fingerprint of a pair of leaves,
which keeps all connections. Components come from alternating large-star and
small-star.

Defined cases: a null or empty text, and one of spaces only, has fingerprint
zero and is linked like any other. Texts are read whole, however long, with a
bounded number of shingles unpacked at a time. Equal fingerprints are one node;
rows that repeat an id or a whole row each get their own result row. The
smallest id in reach names a component; rows without an id have the id of their
component, null if no row of it has one. An empty table gives an empty result.
Only the two named columns are read, so no other name can clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from tagweave.llm.common import text_or_empty
from tagweave.llm.components import components
from tagweave.storage import release, stage

BUDGET = 4
#: Bits of the five blocks; a trie for each of them as the first one.
BLOCKS = (13, 13, 13, 13, 12)
STARTS = tuple(sum(BLOCKS[:r]) for r in range(len(BLOCKS)))
LEAF = 1024
#: Depth of the first nodes, which lies in the first block of any trie, and bits by which nodes are opened.
FIRST, STEP = 12, 4
#: Pairs of ranges with at most so many pairs of fingerprints are compared outright.
SMALL = 64
#: Shingles whose bits are unpacked at a time.
PIECE = 1 << 14
SEED = 42

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def fingerprint(body: bytes, words: int = 4) -> int:
    """The fingerprint of a text's UTF-8 bytes, unsigned; 0 without words."""
    found = body.translate(_LOWER).split()
    if not found:
        return 0
    joined = b" ".join(found)
    sizes = np.fromiter(map(len, found), np.int64, len(found))
    ends = np.cumsum(sizes + 1) - 1
    width = min(words, len(found))
    starts, ends = (ends - sizes)[: len(found) - width + 1].tolist(), ends[width - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for at in range(0, len(starts), PIECE):
        spans = zip(starts[at : at + PIECE], ends[at : at + PIECE], strict=True)
        hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(starts), bitorder="little").tobytes(), "little")


def _fingerprints(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(body.as_py(), words) for body in batch.column("body")]
            codes = pa.array(np.array(found, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("id"), codes], names=["id", "code"])

    return run


def allowed(turn: int, depth: int, budget: int = BUDGET) -> int:
    """Differing bits a pair may have in the first ``depth`` bits of trie ``turn``."""
    blocks = [BLOCKS[(turn + k) % len(BLOCKS)] for k in range(len(BLOCKS))]
    seen = 0
    for k, bits in enumerate(blocks, 1):
        seen += bits
        if depth <= seen:
            return budget * k // len(BLOCKS)
    return budget


def turned(code: Column, turn: int) -> Column:
    """The bits of ``code`` with block ``turn`` first, the blocks before it last."""
    by = STARTS[turn]
    return F.shiftleft(code, by).bitwiseOR(F.shiftrightunsigned(code, 64 - by)) if by else code


def top(code: Column, depth: int) -> Column:
    """The first ``depth`` bits, the others 0."""
    return code.bitwiseAND(F.lit(-(1 << (64 - depth))).cast("long"))


def leaves_and_pairs(codes: DataFrame, leaf: int = LEAF) -> tuple[DataFrame, DataFrame]:
    """Leaves ``turn, node, codes`` of the five tries and pairs ``turn, a, b`` of different leaves to compare.

    ``codes`` holds different fingerprints in ``code``.
    """
    each = [F.struct(F.lit(r).alias("turn"), turned(F.col("code"), r).alias("code")) for r in range(len(BLOCKS))]
    rest = stage(codes.select(F.explode(F.array(*each)).alias("x")).select("x.*"), "turned")
    depths = range(FIRST, 65, STEP)
    limits = F.array(*[F.lit(allowed(r, d)) for r in range(len(BLOCKS)) for d in depths])
    shallower = F.least("a_depth", "b_depth")
    limit = F.element_at(limits, (F.col("turn") * len(depths) + (shallower - FIRST) / STEP + 1).cast("int"))
    # Bits in which the prefixes differ, as far as both go.
    apart = F.bit_count(F.expr("shiftrightunsigned(a ^ b, 64 - least(a_depth, b_depth))"))

    leaves, done, front, used = None, None, None, [rest]
    for depth in depths:
        items = rest.withColumn("node", top(F.col("code"), depth))
        nodes = stage(items.groupBy("turn", "node").agg((F.count(F.lit(1)) > leaf).alias("open")), "nodes")
        full = nodes.filter("open").select("turn", "node")
        any_full = not full.isEmpty()
        here = items.join(full, ["turn", "node"], "left_anti") if any_full else items
        here = stage(here.groupBy("turn", "node").agg(F.collect_list("code").alias("codes")), "leaves")
        leaves = here if leaves is None else leaves.unionByName(here)

        if front is None:
            same = full.select("turn", F.col("node").alias("a"), F.col("node").alias("b"))
            front = same.withColumns({"a_depth": F.lit(depth), "b_depth": F.lit(depth), "a_open": F.lit(True), "b_open": F.lit(True)})
        else:
            kids = nodes.withColumn("parent", top(F.col("node"), depth - STEP))
            front = front.withColumn("same", F.col("a") == F.col("b"))
            for side in "ab":
                own = kids.select(F.col("turn").alias("of"), "parent", F.col("node").alias("kid"), F.col("open").alias("kid_open"))
                opened = front.filter(f"{side}_open").join(own, (F.col("of") == F.col("turn")) & (F.col("parent") == F.col(side)))
                opened = opened.withColumns({side: F.col("kid"), f"{side}_depth": F.lit(depth), f"{side}_open": F.col("kid_open")})
                front = opened.select(*front.columns).unionByName(front.filter(f"not {side}_open"))
            front = stage(front.filter((~F.col("same") | F.expr("a <= b")) & (apart <= limit)).drop("same"), "front")
            used.append(front)
            ended = front.filter("not a_open and not b_open and a <> b").select("turn", "a", "b")
            done = ended if done is None else done.unionByName(ended)
            front = front.filter("a_open or b_open")
        if not any_full:
            break
        rest = stage(items.join(full, ["turn", "node"], "left_semi").select("turn", "code"), "rest")
        used.append(rest)
    pairs = done if done is not None else front.select("turn", "a", "b")
    return leaves, pairs


def meet(turn: int, first: np.ndarray, second: np.ndarray | None, budget: int = BUDGET) -> tuple[np.ndarray, np.ndarray]:
    """Positions of linked fingerprints in two sorted arrays, or inside one (``second`` None).

    Both tries are gone down together, one bit a level; a range of the sorted
    array is a node.
    """
    same = second is None
    one, two = first, first if same else second
    at = np.array([[0, len(one), 0, len(two), 0]], np.int64)
    found = [np.zeros((2, 0), np.int64)]  # every pair of ranges may be given up before any is small
    for depth in range(65):
        n, m = at[:, 1] - at[:, 0], at[:, 3] - at[:, 2]
        few = (n * m <= SMALL) | (depth == 64)
        if few.any():
            some, width = at[few], m[few]
            pairs = n[few] * width
            of = np.repeat(np.arange(len(some)), pairs)
            place = np.arange(pairs.sum()) - np.repeat(np.cumsum(pairs) - pairs, pairs)
            i, j = some[of, 0] + place // width[of], some[of, 2] + place % width[of]
            near = np.bitwise_count(one[i] ^ two[j]) <= budget
            if same:
                near &= i < j
            found.append(np.stack((i[near], j[near])))
            at = at[~few]
        if not len(at):
            break
        bit = np.uint64(1 << (63 - depth))
        below = ~np.uint64((1 << (64 - depth)) - 1)
        cut_one = np.searchsorted(one, (one[at[:, 0]] & below) | bit)
        cut_two = np.searchsorted(two, (two[at[:, 2]] & below) | bit)
        a, b, c, d, err = at.T
        parts = [(a, cut_one, c, cut_two, err), (cut_one, b, cut_two, d, err), (a, cut_one, cut_two, d, err + 1)]
        cross = (cut_one, b, c, cut_two, err + 1)
        if same:  # the mirror image of a node paired with itself is left out
            itself = a == c
            cross = tuple(x[~itself] for x in cross)
        at = np.concatenate([np.stack(x, axis=1) for x in (*parts, cross)])
        at = at[(at[:, 0] < at[:, 1]) & (at[:, 2] < at[:, 3]) & (at[:, 4] <= allowed(turn, depth + 1, budget))]
    i, j = np.concatenate(found, axis=1)
    return i, j


def forest(i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """For each of ``n`` nodes the smallest one in reach over the links ``i, j``."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lows, highs = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
        turns = batch.column("turn").to_pylist()
        for turn, a, b in zip(turns, batch.column("first"), batch.column("second"), strict=True):
            first = np.sort(a.values.to_numpy().view(np.uint64))
            second = np.sort(b.values.to_numpy().view(np.uint64)) if b.is_valid else None
            i, j = meet(turn, first, second)
            if not len(i):
                continue
            nodes = first if second is None else np.concatenate((first, second))
            label = forest(i, j if second is None else j + len(first), len(nodes))
            more = np.flatnonzero(label != np.arange(len(nodes)))
            by = STARTS[turn]
            back = (nodes >> np.uint64(by)) | (nodes << np.uint64(64 - by)) if by else nodes
            lows.append(back[label[more]])
            highs.append(back[more])
        columns = [pa.array(np.concatenate(x).view(np.int64)) for x in (lows, highs)]
        yield pa.RecordBatch.from_arrays(columns, names=["a", "b"])


def links(codes: DataFrame, leaf: int = LEAF) -> DataFrame:
    """Edges ``a, b`` that connect all different fingerprints linked with each other, directly or through others."""
    leaves, pairs = leaves_and_pairs(codes, leaf)
    none = F.lit(None).cast("array<bigint>")
    alone = leaves.select("turn", F.col("codes").alias("first"), none.alias("second"))
    one = leaves.select(F.col("turn").alias("turn1"), F.col("node").alias("node1"), F.col("codes").alias("first"))
    two = leaves.select(F.col("turn").alias("turn2"), F.col("node").alias("node2"), F.col("codes").alias("second"))
    both = pairs.join(one, F.expr("turn = turn1 and a = node1")).join(two, F.expr("turn = turn2 and b = node2"))
    units = alone.unionByName(both.select("turn", "first", "second"))
    return units.mapInArrow(_links, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4, leaf: int = LEAF) -> DataFrame:
    """One row per input row: ``id, code, component_id``; ``code`` is the fingerprint's 64 bits as a long."""
    id_type = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.encode(text_or_empty(text_col), "UTF-8").alias("body"))
    signed = stage(rows.mapInArrow(_fingerprints(words), f"id {id_type}, code bigint"), "signed")
    kinds = stage(signed.groupBy("code").agg(F.min("id").alias("first_id")), "kinds")
    edges = stage(links(kinds.select("code"), leaf), "links")
    roots = components(edges)
    release(edges)
    known = kinds.join(roots, F.col("code") == F.col("node"), "left")
    known = stage(known.select("code", F.coalesce("root", "code").alias("root"), "first_id"), "known")
    names = known.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = known.join(names, "root").select("code", "component_id")
    return signed.join(named, "code").select("id", "code", "component_id")
