"""Ranked lexical search with per-term geometric blocks and exact bounds.

Terms are the longest runs of ASCII letters and digits and of characters beyond
ASCII, A-Z lower-cased. A document's impact for a term is ``10^9 * tf div
(1000 * tf + 8 * m)`` with ``m = 25 + 75 * n * N div L``; its score is the sum of
weight times impact over a query's terms, repeats included.

1. Each document becomes a short vector: counts of the queries' terms, staged.
   Document frequencies and the largest impact of each term come from there.
2. A query's rarest terms, ``SEEDS`` postings or more, give scored documents, and
   their tenth best score is a threshold that the tenth best of all must reach.
3. Terms by largest contribution, ascending, can be left out as long as together
   they stay below the threshold: a document with those alone cannot be among the
   best. Posting lists are needed for the other terms only. A posting carries the
   document's impacts for all terms of the queries that need the list.
4. Each posting list is cut into blocks by similarity: evenly chosen postings are
   representatives, and each posting joins the one whose weighted impacts make
   the smallest angle with its own. A block stores the coordinatewise maximum
   of its members' impacts.
5. A query takes the blocks of its lists. It skips a block only if the score of
   the summary itself, which no member can exceed, is below the threshold; members
   of the others are scored exactly. So nothing is approximate.

Documents are never moved: postings go to ``(term, salt)``, with salts in
proportion to the list's length, packed by the task that made them. Queries are
taken in batches of bounded vocabulary (``BATCH_TERMS``; a long query by itself),
so what is sent to the tasks is bounded; any number of queries is taken, one batch
after the other. To the driver come a batch's queries, one row for each of its
terms and one threshold for each query.

Defined cases: a null or empty text has no terms, counts for nothing and is never
found; a query without terms finds nothing. Texts are read whole, however long.
Equal scores are ordered by ascending id, rows without an id last, repeated ids
and rows in the order in which they are stored; each row of a repeated id is a
document, each row of a repeated query a query. Empty tables give an empty
result. Only the named columns are read, so no other name can clash.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tagweave.llm.common import text_or_empty
from tagweave.operators.numbering import number_rows
from tagweave.storage import stage

#: Terms of a batch of queries, counted for each query, and those of a query that is a batch of its own.
BATCH_TERMS, LONG_QUERY = 8192, 1024
SEEDS = 512
#: Postings for each salt of a list, members of a block on average, cells of a dense matrix.
LIST, BLOCK, CELLS = 4096, 32, 1 << 22
#: Postings packed at a time by the task that makes them, documents expanded at a time.
PACK, SOME = 1 << 18, 256
#: An impact is below 10^6 and takes the lower bits of a packed entry, its coordinate the upper ones.
IMPACT_BITS = 20

_TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256))


def terms(body: bytes) -> list[bytes]:
    """The terms of a text's UTF-8 bytes, in order."""
    return body.translate(_TERM_BYTES).split()


@dataclass
class Corpus:
    """Documents with terms, and all their terms."""

    documents: int
    length: int

    def impacts(self, tf: np.ndarray, n: np.ndarray) -> np.ndarray:
        m = 25 + (75 * n * self.documents) // self.length
        return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


class Lists:
    """What a batch of queries needs to know of the posting lists.

    Lists that the same queries need are of one kind, with one set of coordinates.
    """

    def __init__(self, weighted: np.ndarray, thresholds: np.ndarray, most: np.ndarray, df: np.ndarray):
        needed: list[list[int]] = [[] for _ in df]
        for q, row in enumerate(weighted):
            held = np.flatnonzero((row > 0) & (df > 0))
            most_of = row[held] * most[held]
            order = np.argsort(most_of, kind="stable")
            for t in held[order][np.cumsum(most_of[order]) >= thresholds[q]]:
                needed[t].append(q)
        kinds = {own: k for k, own in enumerate(sorted({tuple(x) for x in needed if x}))}
        #: The kind of each list, -1 for lists that nobody needs.
        self.kind = np.array([kinds.get(tuple(x), -1) for x in needed], np.int64)
        self.queries = [np.array(x, np.int64) for x in kinds]
        self.coordinates = [np.flatnonzero((weighted[qs] > 0).any(axis=0) & (df > 0)) for qs in self.queries]
        self.weights = [weighted[np.ix_(qs, cs)] for qs, cs in zip(self.queries, self.coordinates, strict=True)]
        self.salts = np.maximum(1, -(-df // LIST))
        self.thresholds = thresholds
        self.widest = max(map(len, self.coordinates), default=0)
        self.entry = np.dtype("<u4") if self.widest <= 1 << (32 - IMPACT_BITS) else np.dtype("<u8")

    def places(self) -> np.ndarray:
        """For each kind the coordinate of each term in it, -1 for the others."""
        out = np.full((len(self.coordinates), len(self.kind)), -1, np.int16 if self.widest < 1 << 15 else np.int32)
        for k, held in enumerate(self.coordinates):
            out[k, held] = np.arange(len(held))
        return out


def _vectors(vocabulary: dict[bytes, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, held, counts = [], [], []
            for body in batch.column("body"):
                found = terms(body.as_py())
                sizes.append(len(found))
                tf = Counter(found)
                own = sorted((vocabulary[t], tf[t]) for t in tf.keys() & vocabulary.keys())
                held.append(np.array([x[0] for x in own], "<i4").tobytes())
                counts.append(np.array([x[1] for x in own], "<i4").tobytes())
            columns = [batch.column("no"), batch.column("id"), pa.array(sizes, "int64"), pa.array(held, "binary"), pa.array(counts, "binary")]
            yield pa.RecordBatch.from_arrays(columns, names=["no", "id", "n", "terms", "counts"])

    return run


def _flat(column: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """Binary rows as one array, and the length of each."""
    rows = column.to_pylist()
    size = np.dtype(kind).itemsize
    return np.frombuffer(b"".join(rows), kind), np.array([len(r) // size for r in rows], np.int64)


def _opened(batch: pa.RecordBatch, corpus: Corpus) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Terms and impacts of all documents of a batch in one row, and the number of each one's terms."""
    held, lengths = _flat(batch.column("terms"), "<i4")
    tf, _ = _flat(batch.column("counts"), "<i4")
    n = np.repeat(batch.column("n").to_numpy(), lengths)
    return held.astype(np.int64), corpus.impacts(tf.astype(np.int64), n), lengths


def _frequencies(size: int, corpus: Corpus):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, most = np.zeros(size, np.int64), np.zeros(size, np.int64)
        for batch in batches:
            held, impact, _ = _opened(batch, corpus)
            df += np.bincount(held, minlength=size)
            np.maximum.at(most, held, impact)
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (some, df[some], most[some])], names=["term", "df", "most"])

    return run


def _seeds(weighted: np.ndarray, seeds: list[list[int]], corpus: Corpus, k: int):
    """The ``k`` best scores of each query among a task's documents with one of its seed terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list[int]] = [[] for _ in weighted]
        for batch in batches:
            held, impact, lengths = _opened(batch, corpus)
            ends = np.cumsum(lengths)
            seeded = np.fromiter((bool(seeds[t]) for t in range(weighted.shape[1])), bool, weighted.shape[1])
            for d in np.unique(np.searchsorted(ends, np.flatnonzero(seeded[held]), "right")):
                own = slice(ends[d] - lengths[d], ends[d])
                for q in {q for t in held[own] for q in seeds[t]}:
                    best[q].append(int(weighted[q, held[own]] @ impact[own]))
            best = [sorted(x, reverse=True)[:k] for x in best]
        rows = [(q, s) for q, x in enumerate(best) for s in x]
        columns = [pa.array([r[i] for r in rows], "int64") for i in (0, 1)]
        yield pa.RecordBatch.from_arrays(columns, names=["q", "score"])

    return run


def _packed(rows: list[tuple[np.ndarray, ...]], entry: np.dtype, salts: np.ndarray) -> pa.RecordBatch:
    """Postings as one row for each list: their documents, the size of each, and all their entries."""
    term, no, size, entries = (np.concatenate(x) for x in zip(*rows, strict=True))
    start = np.cumsum(size) - size
    order = np.argsort(term, kind="stable")
    some, first = np.unique(term[order], return_index=True)
    bounds = np.append(first, len(order))
    # A list's salt: the same for what one task packs, another for the next.
    lot = int(no[0]) * 0x9E3779B97F4A7C15 % (1 << 64) >> 20
    out: list[list] = [[], [], [], [], []]
    for t, a, b in zip(some.tolist(), bounds[:-1], bounds[1:], strict=True):
        here = order[a:b]
        values = (t, lot % int(salts[t]), no[here].tobytes(), size[here].astype("<i4").tobytes(), b"".join(entries[s : s + n].tobytes() for s, n in zip(start[here], size[here], strict=True)))
        for column, value in zip(out, values, strict=True):
            column.append(value)
    kinds = ("int32", "int32", "binary", "binary", "binary")
    return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(out, kinds, strict=True)], names=["term", "salt", "nos", "sizes", "entries"])


_LISTED = "term int, salt int, nos binary, sizes binary, entries binary"


def _postings(lists: Lists, corpus: Corpus):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = lists.places()
        kept: list[tuple[np.ndarray, ...]] = []
        waiting = 0
        for batch in batches:
            for at in range(0, batch.num_rows, SOME):
                some = batch.slice(at, SOME)
                held, impact, lengths = _opened(some, corpus)
                doc = np.repeat(np.arange(len(lengths)), lengths)
                post = np.flatnonzero(lists.kind[held] >= 0)
                if not len(post):
                    continue
                # Each posting with all terms of its document, then those that its list knows.
                n = lengths[doc[post]]
                of = np.repeat(np.arange(len(post)), n)
                begin = (np.cumsum(lengths) - lengths)[doc[post]]
                entry = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + begin[of]
                place = places[lists.kind[held[post]][of], held[entry]]
                known = place >= 0
                packed = (place[known].astype(lists.entry) << lists.entry.type(IMPACT_BITS)) | impact[entry[known]].astype(lists.entry)
                size = np.bincount(of[known], minlength=len(post))
                kept.append((held[post], some.column("no").to_numpy()[doc[post]], size, packed))
                waiting += len(post)
                if waiting >= PACK:
                    yield _packed(kept, lists.entry, lists.salts)
                    kept, waiting = [], 0
        if kept:
            yield _packed(kept, lists.entry, lists.salts)

    return run


def _dense(entries: np.ndarray, sizes: np.ndarray, width: int) -> np.ndarray:
    out = np.zeros((len(sizes), width), np.int64)
    bits = entries.dtype.type(IMPACT_BITS)
    out[np.repeat(np.arange(len(sizes)), sizes), (entries >> bits).astype(np.int64)] = entries & entries.dtype.type((1 << IMPACT_BITS) - 1)
    return out


def cut_by_angle(impacts: np.ndarray, weights: np.ndarray, block: int = BLOCK) -> np.ndarray:
    """The block of each row: that of the representative with the smallest angle."""
    rows = (impacts * weights).astype(np.float32)
    rows /= np.maximum(np.sqrt((rows**2).sum(axis=1, keepdims=True)), 1e-9)
    count = -(-len(rows) // block)
    chosen = np.arange(count) * len(rows) // count
    return (rows @ rows[chosen].T).argmax(axis=1)


def _blocks(lists: Lists):
    """Postings of one list and salt, which follow each other, into blocks with their summaries."""

    def blocked(term: int, salt: int, nos: np.ndarray, sizes: np.ndarray, entries: np.ndarray) -> Iterator[tuple]:
        weights = lists.weights[lists.kind[term]].max(axis=0)
        width = len(weights)
        ends = np.cumsum(sizes)
        step = max(BLOCK, CELLS // width)
        for at in range(0, len(nos), step):
            n = sizes[at : at + step]
            first = ends[at] - sizes[at]
            own = entries[first : first + n.sum()]
            full = _dense(own, n, width)
            block = cut_by_angle(full, weights)
            order = np.argsort(block, kind="stable")
            starts = np.flatnonzero(np.diff(block[order], prepend=-1))
            summary = np.maximum.reduceat(full[order], starts, axis=0)
            begin = np.cumsum(n) - n
            for k, (a, b) in enumerate(zip(starts, np.append(starts[1:], len(order)), strict=True)):
                here = order[a:b]
                top = np.flatnonzero(summary[k])
                packed = (top.astype(lists.entry) << lists.entry.type(IMPACT_BITS)) | summary[k, top].astype(lists.entry)
                members = b"".join(own[begin[i] : begin[i] + n[i]].tobytes() for i in here)
                yield term, salt, packed.tobytes(), nos[at : at + step][here].tobytes(), n[here].astype("<i4").tobytes(), members

    def out(rows: list[tuple]) -> pa.RecordBatch:
        kinds = ("int32", "int32", "binary", "binary", "binary", "binary")
        names = ["term", "salt", "summary", "nos", "sizes", "entries"]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names=names)

    def joined(parts: list[tuple[bytes, bytes, bytes]]):
        a, b, c = (b"".join(x) for x in zip(*parts, strict=True))
        return np.frombuffer(a, "<i8"), np.frombuffer(b, "<i4").astype(np.int64), np.frombuffer(c, lists.entry)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, parts = None, []
        for batch in batches:
            rows: list[tuple] = []
            for term, salt, *part in zip(*[batch.column(c).to_pylist() for c in ("term", "salt", "nos", "sizes", "entries")], strict=True):
                if (term, salt) != key:
                    if parts:
                        rows += blocked(*key, *joined(parts))
                    key, parts = (term, salt), []
                parts.append(part)
                if len(rows) > 2000:
                    yield out(rows)
                    rows = []
            yield out(rows)
        if parts:
            yield out(list(blocked(*key, *joined(parts))))

    return run


_BLOCK = "term int, salt int, summary binary, nos binary, sizes binary, entries binary"


def _search(lists: Lists, k: int):
    """Scored members of the blocks whose summary reaches a query's threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low = (1 << IMPACT_BITS) - 1
        for batch in batches:
            found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
            for term, summary, nos, sizes, entries in zip(*[batch.column(c).to_pylist() for c in ("term", "summary", "nos", "sizes", "entries")], strict=True):
                weights, queries = lists.weights[lists.kind[term]], lists.queries[lists.kind[term]]
                packed = np.frombuffer(summary, lists.entry).astype(np.int64)
                bound = weights[:, packed >> IMPACT_BITS] @ (packed & low)
                reach = bound >= lists.thresholds[queries]
                if not reach.any():
                    continue
                members, sizes = np.frombuffer(nos, "<i8"), np.frombuffer(sizes, "<i4")
                full = _dense(np.frombuffer(entries, lists.entry), sizes, weights.shape[1])
                for q, row in zip(queries[reach], weights[reach], strict=True):
                    scores = full @ row
                    least = lists.thresholds[q]
                    if len(scores) > k:  # equal ones stay: ids decide between them
                        least = max(least, np.partition(scores, -k)[-k])
                    here = scores >= least
                    found.append((np.full(here.sum(), q), members[here], scores[here]))
            columns = [np.concatenate(x) for x in zip(*found, strict=True)] if found else [np.zeros(0, np.int64)] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], names=["q", "no", "score"])

    return run


def _query_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [terms(body.as_py()) for body in batch.column("body")]
        columns = [batch.column("item"), batch.column("body"), pa.array([len(set(x)) for x in found], "int64")]
        yield pa.RecordBatch.from_arrays(columns, names=["item", "body", "kinds"])


def _best(rows: DataFrame, queries: list[Counter], k: int) -> DataFrame | None:
    """``q, no, id, score`` of documents among which are each query's ``k`` best; None if no document has a term."""
    vocabulary = {t: i for i, t in enumerate(sorted({t for q in queries for t in q}))}
    vectors = stage(rows.mapInArrow(_vectors(vocabulary), f"no bigint, id {rows.schema['id'].dataType.simpleString()}, n bigint, terms binary, counts binary"), "vectors")
    documents, length = vectors.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    if not documents or not vocabulary:
        return None
    corpus = Corpus(documents, length)

    df, most = np.zeros(len(vocabulary), np.int64), np.zeros(len(vocabulary), np.int64)
    counted = vectors.select("n", "terms", "counts").mapInArrow(_frequencies(len(vocabulary), corpus), "term bigint, df bigint, most bigint")
    for t, d, m in counted.groupBy("term").agg(F.sum("df"), F.max("most")).collect():
        df[t], most[t] = d, m
    weight = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * int(d) + 1))) for d in df], np.int64)
    weighted = np.zeros((len(queries), len(vocabulary)), np.int64)
    for q, held in enumerate(queries):
        for t, n in held.items():
            weighted[q, vocabulary[t]] = n * weight[vocabulary[t]]

    seeds: list[list[int]] = [[] for _ in vocabulary]
    for q, row in enumerate(weighted):
        held = np.flatnonzero((row > 0) & (df > 0))
        held = held[np.argsort(df[held], kind="stable")]
        for t in held[: np.searchsorted(np.cumsum(df[held]), SEEDS) + 1]:
            seeds[t].append(q)
    scored = vectors.select("n", "terms", "counts").mapInArrow(_seeds(weighted, seeds, corpus, k), "q bigint, score bigint")
    place = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score")))
    tenth = scored.filter("score > 0").withColumn("place", place).filter(F.col("place") <= k)
    thresholds = np.ones(len(queries), np.int64)
    for q, n, least in tenth.groupBy("q").agg(F.count(F.lit(1)), F.min("score")).collect():
        if n == k:
            thresholds[q] = least

    lists = Lists(weighted, thresholds, most, df)
    listed = vectors.select("no", "n", "terms", "counts").mapInArrow(_postings(lists, corpus), _LISTED)
    listed = listed.repartition("term", "salt").sortWithinPartitions("term", "salt", "nos")
    blocks = stage(listed.mapInArrow(_blocks(lists), _BLOCK), "blocks")
    found = blocks.mapInArrow(_search(lists, k), "q bigint, no bigint, score bigint").distinct()
    return stage(found, "found").join(vectors.select("no", "id"), "no")


def search(
    docs: DataFrame,
    queries: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    query_id_col: str = "item_id",
    query_text_col: str = "text",
    k: int = 10,
) -> DataFrame:
    """The ``k`` best documents of each query: ``query_id, rank, id, score``; only scores above 0 count."""
    body = lambda c: F.encode(text_or_empty(c), "UTF-8").alias("body")
    item_type = queries.schema[query_id_col].dataType.simpleString()
    asked = queries.select(F.col(query_id_col).alias("item"), body(query_text_col))
    asked = asked.mapInArrow(_query_terms, f"item {item_type}, body binary, kinds bigint").filter("kinds > 0")
    long = F.col("kinds") > LONG_QUERY
    before = {"before": F.when(~long, F.col("kinds"))}
    asked = stage(number_rows(asked, "query", F.col("item").asc_nulls_last(), "body", running=before), "queries")
    batch = F.when(long, -1 - F.col("query")).otherwise(F.floor(F.col("before") / BATCH_TERMS))
    batches = [r[0] for r in asked.select(batch.alias("batch")).distinct().orderBy("batch").collect()]
    rows = docs.select(F.monotonically_increasing_id().alias("no"), F.col(id_col).alias("id"), body(text_col))

    id_type = docs.schema[id_col].dataType.simpleString()
    found = docs.sparkSession.createDataFrame([], f"query bigint, no bigint, id {id_type}, score bigint")
    for number in batches:
        chosen = asked.filter(batch == number).select("query", "body").orderBy("query").collect()
        best = _best(rows, [Counter(terms(bytes(r.body))) for r in chosen], k)
        if best is not None:
            numbers = F.array(*[F.lit(r.query) for r in chosen])
            found = found.unionByName(best.select(F.element_at(numbers, (F.col("q") + 1).cast("int")).alias("query"), "no", "id", "score"))
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.col("id").asc_nulls_last(), "no")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.join(asked.select("query", F.col("item").alias("query_id")), "query").select("query_id", "rank", "id", "score")
