"""Removal of repeated byte strings: suffix arrays over the places that can repeat.

A byte is removed if some string of ``length`` (100) bytes that covers it also
starts earlier: in a document with a smaller id, or earlier in the same one.
Strings are judged on the input, not on what is left, and never cross documents.

1. Every string of 100 bytes is filed under the smallest hash of its 32-byte
   substrings, its anchor. Successive strings with one anchor in one place make
   a unit: r strings, at most 69, have r + 99 bytes. Equal strings have equal
   anchors, and the strings of one unit all differ.
2. Copies of a whole text are found first, by MD5; they are removed as they are,
   and only the earliest goes on. Anchors in more than one place are found by
   grouping; only their units are cut out of the texts.
3. Of equal units the earliest stays; the strings of the others are repeats.
4. Anchors with several different units: their texts are joined, separators
   between them, and sorted by suffix (``suffix.suffix_arrays``). Neighbours that
   agree in 100 bytes are one string; all but the earliest of a run are repeats.
   An anchor with more than ``MOST_UNITS`` different units is opened first: each
   unit becomes two, whose strings share 34 bytes more on the left or on the
   right, and these are its anchors now; of equal ones the earliest stays, as in 3,
   and what is large still is opened further. So a passage that a third of all
   documents share is never sorted in one task, and no unit becomes more than two
   rows a step.
5. The repeats of a document are merged to spans and its bytes cut.

No task holds more than one document's spans, or a batch of short units. The
number of rows grows with the text: one for each 35 bytes or so in step 2, of
some 40 bytes, then only what repeats. Each step is staged.

Defined cases: a null text is empty; texts under 100 bytes are kept. Rows without
an id come after all others. Rows that repeat an id and text are one document,
and all get its result; where an id has different texts, they are taken in the
order of their MD5. An empty table gives an empty result. Other columns are not
read by ``remove_repeats``.
"""

from __future__ import annotations

import gc
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tagweave.llm.common import text_or_empty
from tagweave.llm.suffix import suffix_arrays
from tagweave.operators.numbering import number_rows
from tagweave.storage import release, stage

LENGTH, SEED_BYTES = 100, 32
#: Different units of an anchor that are sorted together.
MOST_UNITS = 64
#: Bytes of text hashed at a time, and sorted at a time.
SLICE, SORTED = 1 << 17, 1 << 20

_rng = np.random.default_rng(20)
_BYTE = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACE = np.uint64((1 << 18) - 1)
_STEP = _rng.integers(0, 1 << 63, 8, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def anchors(data: np.ndarray, length: int = LENGTH, seed: int = SEED_BYTES) -> tuple[np.ndarray, np.ndarray]:
    """For the string at each place: where its anchor is, and the hash there.

    The anchor is the leftmost of the smallest hashes, compared by their upper
    bits: a choice by content alone, so equal strings have it at the same offset.
    """
    hashed, width, step = _BYTE[data], 1, 0
    while width < seed:
        hashed = hashed[:-width] * _STEP[step] + hashed[width:]
        width, step = width * 2, step + 1
    hashed ^= hashed >> np.uint64(29)
    least, window, width = (hashed & ~_PLACE) | np.arange(len(hashed), dtype=np.uint64), length - seed + 1, 1
    while width * 2 <= window:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    least = np.minimum(least[: len(least) - (window - width)], least[window - width :])
    place = (least & _PLACE).astype(np.int64)
    return place, hashed[place].view(np.int64)


def units(data: np.ndarray, bounds: np.ndarray, length: int = LENGTH, seed: int = SEED_BYTES):
    """Units of texts that lie one after the other: anchor, text, first string, number of strings."""
    found = []
    room = np.diff(bounds) >= length
    for at in range(0, len(data) - length + 1, SLICE):
        upto = min(at + SLICE, len(data) - length + 1)
        anchor, least = anchors(data[at : upto + length - 1], length, seed)
        place = np.arange(at, upto)
        text = np.searchsorted(bounds, place, "right") - 1
        inside = place + length <= bounds[text + 1]
        change = np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1]) | (inside[1:] != inside[:-1])))
        starts = np.flatnonzero(change)
        ends = np.concatenate((starts[1:], [upto - at]))
        keep = inside[starts] & room[text[starts]]
        starts, ends = starts[keep], ends[keep]
        found.append((least[starts], text[starts], starts + at - bounds[text[starts]], ends - starts))
    if not found:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a binary column, one value after the other, and where each begins."""
    if column.type == pa.large_binary():
        kind = np.int64
    else:
        kind = np.int32
    _, offsets, values = column.buffers()
    bounds = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(values, np.uint8) if values is not None else np.zeros(0, np.uint8)
    return data[bounds[0] : bounds[-1]], bounds - bounds[0]


def _list_units(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds = _bytes_of(batch.column("body"))
            anchor, text, start, strings = units(data, bounds, length)
            where = pa.array(text)
            columns = [pa.array(anchor), batch.column("no").take(where), batch.column("content").take(where)]
            columns += [pa.array(start), pa.array(strings.astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, names=["anchor", "no", "content", "start", "run"])

    return run


def _cut_units(length: int):
    """Texts with the anchors that count for each: the units themselves, with a digest of their bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            parts = batch.column("units")
            for row in range(batch.num_rows):
                body, listed = batch.column("body")[row].as_py(), parts[row].values
                no = batch.column("no")[row].as_py()
                for a, s, r in zip(listed.field("anchor").to_pylist(), listed.field("start").to_pylist(), listed.field("run").to_pylist(), strict=True):
                    piece = body[s : s + r + length - 1]
                    rows.append((a, int.from_bytes(hashlib.blake2b(piece, digest_size=8).digest(), "little", signed=True), no, s, r, piece))
                if len(rows) > 20_000:
                    yield _unit_batch(rows)
                    rows = []
            yield _unit_batch(rows)

    return run


def _unit_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (("anchor", "int64"), ("digest", "int64"), ("no", "int64"), ("start", "int64"), ("run", "int32"), ("piece", "binary"))
    columns = zip(*rows, strict=True) if rows else [[] for _ in kinds]
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, (_, k) in zip(columns, kinds, strict=True)], names=[n for n, _ in kinds])


def _repeats(anchor: np.ndarray, no: np.ndarray, start: np.ndarray, run: np.ndarray, data: np.ndarray, bounds: np.ndarray, length: int):
    """Strings of these units, sorted by anchor, that another unit has earlier: unit and place in it."""
    sizes = np.diff(bounds)
    # Each unit, then a separator; the last separator of an anchor is its smallest symbol.
    begins = bounds[:-1] + np.arange(len(sizes))
    text = np.ones(len(data) + len(sizes), np.int64)
    unit = np.repeat(np.arange(len(sizes)), sizes + 1)
    place = np.arange(len(text)) - begins[unit]
    body = place < sizes[unit]
    text[body] = data.astype(np.int64) + 2
    last = np.concatenate((anchor[1:] != anchor[:-1], [True]))
    text[begins[last] + sizes[last]] = 0
    firsts = np.flatnonzero(np.concatenate(([True], anchor[1:] != anchor[:-1])))
    order = suffix_arrays(text, np.concatenate((begins[firsts], [len(text)])))
    order = order[place[order] < run[unit[order]]]
    if len(order) < 2:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    windows = np.lib.stride_tricks.sliding_window_view(text.astype(np.int16), length)
    same = anchor[unit[order[1:]]] == anchor[unit[order[:-1]]]
    pairs = np.flatnonzero(same)
    for at in range(0, len(pairs), 50_000):
        some = pairs[at : at + 50_000]
        same[some] = (windows[order[some]] == windows[order[some + 1]]).all(axis=1)
    group = np.concatenate(([0], np.cumsum(~same)))
    where = start[unit[order]] + place[order]
    by = np.lexsort((where, no[unit[order]], group))
    later = np.concatenate(([False], group[by][1:] == group[by][:-1]))
    # The same place of a document is no repeat of itself.
    u, w = unit[order[by]], where[by]
    head = np.maximum.accumulate(np.where(later, 0, np.arange(len(by))))
    later &= (no[u] != no[u[head]]) | (w != w[head])
    chosen = order[by][later]
    return unit[chosen], place[chosen]


def _sort_units(length: int):
    """Units sorted by anchor: spans of strings that are repeats."""

    def spans(held: list[tuple]) -> pa.RecordBatch:
        anchor, no, start, run = (np.array([r[i] for r in held], np.int64) for i in range(4))
        bounds = np.concatenate(([0], np.cumsum([len(r[4]) for r in held])))
        data = np.frombuffer(b"".join(r[4] for r in held), np.uint8)
        unit, place = _repeats(anchor, no, start, run, data, bounds, length)
        by = np.lexsort((place, unit))
        unit, place = unit[by], place[by]
        new = np.flatnonzero(np.concatenate(([True], (unit[1:] != unit[:-1]) | (place[1:] != place[:-1] + 1)))) if len(unit) else np.zeros(0, np.int64)
        ends = np.concatenate((new[1:], [len(unit)])) - 1 if len(unit) else new
        first = start[unit[new]] + place[new]
        upto = start[unit[ends]] + place[ends] + length
        return pa.RecordBatch.from_arrays([pa.array(no[unit[new]]), pa.array(first), pa.array(upto)], names=["no", "first", "upto"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, last = [], 0, (None, None)
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("anchor", "no", "start", "run", "piece", "scale")]
            for *row, scale in zip(*columns, strict=True):
                # All texts of a batch advance together, so those of one scale make a batch.
                if held and (scale != last[0] or size > SORTED and row[0] != last[1]):
                    yield spans(held)
                    held, size = [], 0
                last = scale, row[0]
                held.append(row)
                size += len(row[4])
        if held:
            yield spans(held)

    return run


def _split(anchor: int, start: int, run: int, piece: bytes, low: int, high: int, length: int) -> Iterator[tuple]:
    """A unit's strings filed under more than the ``high - low`` bytes that they have in common.

    Half of what a string has besides lies on one side of those bytes at least.
    Strings with that half on the left are filed under it, too, the others under
    the same on the right, so equal strings stay together. At the end a string is
    filed under itself.
    """
    more = (length - (high - low) + 1) // 2
    cut = min(max(low - more + 1, 0), run)
    for side, (s, e) in enumerate(((0, cut), (cut, run))):
        if s < e:
            a, b = (low - more, high) if side == 0 else (low, high + more)
            key = anchor.to_bytes(8, "little", signed=True) + bytes([side]) + piece[a:b]
            digest = int.from_bytes(hashlib.blake2b(key, digest_size=8).digest(), "little", signed=True)
            yield digest, start + s, e - s, piece[s : e + length - 1], a - s, b - s


def _open_units(length: int):
    """Units of large anchors, each as one or two with anchors of their own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (("anchor", "int64"), ("no", "int64"), ("start", "int64"), ("run", "int32"), ("piece", "binary"), ("low", "int32"), ("high", "int32"))
        for batch in batches:
            names = ("anchor", "no", "start", "run", "piece", "low", "high")
            out: list[tuple] = []
            for anchor, no, start, strings, piece, low, high in zip(*[batch.column(c).to_pylist() for c in names], strict=True):
                if low is None:  # not opened before: what the strings share is the anchor itself
                    place, _ = anchors(np.frombuffer(piece[:length], np.uint8), length)
                    low, high = int(place[0]), int(place[0]) + SEED_BYTES
                out += [(a, no, *rest) for a, *rest in _split(anchor, start, strings, piece, low, high, length)]
            columns = zip(*out, strict=True) if out else [[] for _ in kinds]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, (_, k) in zip(columns, kinds, strict=True)], names=[n for n, _ in kinds])

    return run


def _opened(units: DataFrame, length: int) -> tuple[DataFrame, DataFrame]:
    """Different units (``n`` of them in an anchor) after one step of opening, and spans of those that are copies."""
    schema = "anchor bigint, no bigint, start bigint, run int, piece binary, low int, high int"
    rows = stage(units.select("anchor", "no", "start", "run", "piece", "low", "high").mapInArrow(_open_units(length), schema), "opened", "zstd")
    first = rows.groupBy("anchor", "piece").agg(F.min(F.struct("no", "start", "run", "low", "high")).alias("first"), F.count(F.lit(1)).alias("copies"))
    first = stage(first.select("anchor", "piece", "first.*", "copies"), "kinds", "zstd")
    several = first.filter("copies > 1").select("anchor", "piece", F.col("no").alias("no1"), F.col("start").alias("start1"))
    again = rows.join(several, ["anchor", "piece"]).filter("no <> no1 or start <> start1")
    upto = (F.col("start") + F.col("run") + length - 1).alias("upto")
    counts = first.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return stage(first.drop("copies").join(counts, "anchor"), "units", "zstd"), stage(again.select("no", F.col("start").alias("first"), upto), "again", "zstd")


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of steps whose results are staged."""
    gc.collect()
    spark._jvm.System.gc()


def repeat_spans(texts: DataFrame, length: int = LENGTH) -> DataFrame:
    """Byte ranges ``no, first, upto`` to remove from rows of ``no, body``; they may overlap."""
    spark = texts.sparkSession
    whole = texts.select("no", F.unhex(F.md5("body")).alias("md5"), F.octet_length("body").alias("size")).filter(F.col("size") >= length)
    earliest = whole.groupBy("md5").agg(F.min("no").alias("no1"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    copied = stage(whole.join(earliest, "md5").filter("no <> no1").select("no", "size"), "copied")

    listed = texts.select("no", "body", F.xxhash64("body").alias("content"))
    listed = listed.mapInArrow(_list_units(length), "anchor bigint, no bigint, content bigint, start bigint, run int")
    place = F.xxhash64("content", "start")
    repeated = listed.groupBy("anchor").agg(F.min(place).alias("low"), F.max(place).alias("high")).filter("low < high").select("anchor")
    kept = listed.drop("content").join(repeated, "anchor", "left_semi").join(copied, "no", "left_anti")
    kept = stage(kept, "units", "zstd")
    free_shuffles(spark)

    of_text = kept.groupBy("no").agg(F.collect_list(F.struct("anchor", "start", "run")).alias("units"))
    pieces = texts.join(of_text, "no").select("no", "body", "units")
    pieces = pieces.mapInArrow(_cut_units(length), "anchor bigint, digest bigint, no bigint, start bigint, run int, piece binary")
    pieces = stage(pieces, "pieces", "zstd")
    release(kept)
    free_shuffles(spark)

    first = pieces.groupBy("anchor", "digest").agg(F.min(F.struct("no", "start")).alias("first"))
    first = stage(first.select("anchor", "digest", F.col("first.no").alias("no1"), F.col("first.start").alias("start1")), "first", "zstd")
    free_shuffles(spark)
    at = (F.col("no") == F.col("no1")) & (F.col("start") == F.col("start1"))
    copies = pieces.drop("piece").join(first, ["anchor", "digest"]).filter(~at)
    spans = stage(copies.select("no", F.col("start").alias("first"), (F.col("start") + F.col("run") + length - 1).alias("upto")), "copies", "zstd")
    zero = F.lit(0).cast("long")
    spans = spans.unionByName(copied.select("no", zero.alias("first"), F.col("size").cast("long").alias("upto")))
    free_shuffles(spark)

    several = first.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    mixed = first.join(several, "anchor")
    mixed = pieces.join(mixed, ["anchor", "digest"]).filter(at)
    mixed = stage(mixed.select("anchor", "no", "start", "run", "piece", "n"), "mixed", "zstd")
    release(pieces, first)
    free_shuffles(spark)
    mixed = mixed.withColumns({c: F.lit(None).cast("int") for c in ("low", "high")})
    while True:
        few = mixed.filter(F.col("n") <= MOST_UNITS).withColumn("scale", F.floor(F.log2("n")).cast("int"))
        few = few.repartition("anchor").sortWithinPartitions("scale", "anchor", "no", "start")
        spans = spans.unionByName(few.mapInArrow(_sort_units(length), "no bigint, first bigint, upto bigint"))
        many = mixed.filter(F.col("n") > MOST_UNITS)
        if many.isEmpty():
            return spans
        mixed, again = _opened(many, length)
        spans = spans.unionByName(again)


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["id", "n_bytes", "n_removed", "spans", "kept"]
    for batch in batches:
        ids, sizes, removed, cut, kept = batch.column("id"), [], [], [], []
        for row in range(batch.num_rows):
            body, spans = batch.column("body")[row].as_py(), batch.column("spans")[row]
            merged: list[list[int]] = []
            if spans.is_valid:
                firsts, uptos = (np.asarray(spans.values.field(f)) for f in ("first", "upto"))
                by = np.argsort(firsts, kind="stable")
                firsts, uptos = firsts[by], np.maximum.accumulate(uptos[by])
                new = np.flatnonzero(np.concatenate(([True], firsts[1:] > uptos[:-1])))
                ends = np.concatenate((new[1:] - 1, [len(by) - 1]))
                merged = list(zip(firsts[new].tolist(), uptos[ends].tolist(), strict=True))
            pieces, at = [], 0
            for a, b in merged:
                pieces.append(body[at:a])
                at = b
            pieces.append(body[at:])
            sizes.append(len(body))
            removed.append(sum(b - a for a, b in merged))
            cut.append([{"first": a, "upto": b} for a, b in merged])
            kept.append(b"".join(pieces))
        kind = pa.list_(pa.struct([("first", pa.int64()), ("upto", pa.int64())]))
        columns = [ids, pa.array(sizes, "int64"), pa.array(removed, "int64"), pa.array(cut, kind), pa.array(kept, "binary")]
        yield pa.RecordBatch.from_arrays(columns, names=names)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """One row per input row: ``id, n_bytes, n_removed, spans, kept``.

    ``spans`` are the maximal removed runs (``first, upto`` in bytes), ``kept`` the
    remaining bytes, which need not be valid UTF-8.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.encode(text_or_empty(text_col), "UTF-8").alias("body"))
    ids = docs.select(F.col(id_col).alias("id"))
    once = ids.agg(F.count(F.lit(1)).alias("n"), F.count("id").alias("filled")).first()
    several = ids.groupBy("id").count().filter("count > 1")
    if once.n != once.filled or not several.isEmpty() or dict(ids.dtypes)["id"] not in ("bigint", "int", "smallint", "tinyint"):
        known = rows.select("id", F.md5("body").alias("md5")).distinct()
        known = number_rows(known, "no", F.col("id").asc_nulls_last(), "md5").withColumnRenamed("id", "id1")
        rows = rows.withColumn("md5", F.md5("body")).alias("r")
        rows = stage(rows.join(known, F.col("id").eqNullSafe(F.col("id1")) & (F.col("r.md5") == known["md5"])).select("no", "id", "body"), "numbered")
        texts = rows.select("no", "body").dropDuplicates(["no"])
    else:
        rows = rows.withColumn("no", F.col("id").cast("long"))
        texts = rows.select("no", "body")
    spans = repeat_spans(texts, length)
    of_row = stage(spans.groupBy("no").agg(F.collect_list(F.struct("first", "upto")).alias("spans")), "spans")
    free_shuffles(docs.sparkSession)
    id_type = docs.schema[id_col].dataType.simpleString()
    schema = f"id {id_type}, n_bytes bigint, n_removed bigint, spans array<struct<first:bigint,upto:bigint>>, kept binary"
    return rows.join(of_row, "no", "left").select("id", "body", "spans").mapInArrow(_remove, schema)
