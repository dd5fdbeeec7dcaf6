"""Vector code compression: a codebook for each part of a vector, fitted where the parts reside.

A vector of whole numbers (components times ``SCALE``, rounded down) is cut into
``parts`` equal consecutive parts. Each part position has a codebook, at first
that part of the ``entries`` smallest ids. A round assigns every part to its
nearest entry (squared distance, ties to the lower index) and moves each entry
to its parts' mean, rounded down.

Parts reside with the owner of their ``(position, entry, salt)``: one shuffle
after the first assignment brings them there, and they are staged. An update is
a sum in each owner's task; what is shuffled for it is one row per entry and
task. With the new codebook each owner judges its resident parts; only those
whose nearest entry has changed are shuffled to their new owner, the others are
read where they were written. The salt comes from the row's number and the
number of salts from the number of vectors, so that an entry that holds a third
of all parts has many owners.

To the driver come the codebooks: ``parts * entries`` rows a round. Nothing else
is gathered; a lost executor costs a re-read of staged parts.

Defined cases: rows whose vector is null or holds a null or non-finite component
are dropped, and so are vectors of another length than the first kept one in the
order of ids. That length must be a multiple of ``parts`` (``ValueError``
otherwise); components beyond 2^29 after scaling raise an error. Rows without an
id come last in the order of ids, equal ids follow the order of their vectors;
each row of a repeated id has its own code. With fewer rows than entries the
codebooks are shorter; entries without parts stay as they are. Rows without a
label form one group. An empty table gives an empty result. Only the three named
columns are read, so no other name can clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tagweave.storage import release, stage

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Vectors for each salt of an entry.
SHARE = 1024
#: Distances in memory at a time.
PIECE = 1 << 18


def scaled(vector: str, scale: int = SCALE) -> Column:
    """Components times ``scale``, rounded down; an error beyond 2^29, where squared distances leave 64 bits."""

    def whole(x: Column) -> Column:
        value = F.floor(x.cast("double") * scale)
        return F.when(F.abs(value) < (1 << 29), value).otherwise(F.raise_error(F.lit("component too large for a code")).cast("long"))

    return F.transform(vector, whole)


def usable(vector: str) -> Column:
    """No null, and only finite components."""
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    return F.coalesce(F.col(vector).isNotNull() & F.forall(vector, fine), F.lit(False))


def nearest(parts: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry and its squared distance for rows of whole numbers."""
    index, far = np.zeros(len(parts), np.int64), np.zeros(len(parts), np.int64)
    step = max(1, PIECE // max(1, book.size))
    for at in range(0, len(parts), step):
        away = ((parts[at : at + step, None, :] - book[None]) ** 2).sum(axis=2)
        index[at : at + step] = away.argmin(axis=1)
        far[at : at + step] = away.min(axis=1)
    return index, far


def _rows(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), width)


def _lists(values: np.ndarray) -> pa.Array:
    """Rows of whole numbers as a column of lists."""
    ends = np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.ravel()))


def _cut(books: np.ndarray):
    """Vectors into parts: ``position, entry, no, part``."""
    count, _, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = _rows(batch.column("vector"), count * width).reshape(-1, count, width)
            nos = batch.column("no").to_numpy()
            for p in range(count):
                part = np.ascontiguousarray(values[:, p])
                entry, _ = nearest(part, books[p])
                columns = [pa.array(np.full(len(nos), p, np.int32)), pa.array(entry.astype(np.int32)), pa.array(nos), _lists(part)]
                yield pa.RecordBatch.from_arrays(columns, names=["position", "entry", "no", "part"])

    return run


def _judge(books: np.ndarray):
    """Resident parts with the nearest entry of the new books and the distance to it."""
    width = books.shape[2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part, position = _rows(batch.column("part"), width), batch.column("position").to_numpy()
            chosen, far = np.zeros(len(part), np.int32), np.zeros(len(part), np.int64)
            for p in np.unique(position):
                here = position == p
                chosen[here], far[here] = nearest(part[here], books[p])
            columns = [*batch.columns, pa.array(chosen), pa.array(far)]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "chosen", "far"])

    return run


_MEMBER = "position int, entry int, no bigint, part array<bigint>"


def at_owners(members: DataFrame, salts: int) -> DataFrame:
    """Parts moved to the owner of their position, entry and salt, and staged there."""
    return stage(members.repartition("position", "entry", F.pmod(F.xxhash64("no"), F.lit(salts))), "members")


def moved_books(members: DataFrame, books: np.ndarray) -> np.ndarray:
    """Each entry at the mean of its members, rounded down; at most one row per entry comes to the driver."""
    sums = [F.sum(F.col("part")[k]).alias(f"s{k}") for k in range(books.shape[2])]
    found = members.groupBy("position", "entry").agg(F.count(F.lit(1)).alias("n"), *sums)
    books = books.copy()
    for position, entry, n, *total in found.collect():
        books[position, entry] = [s // n for s in total]
    return books


def digest(books: np.ndarray) -> str:
    """SHA-256 of all components as decimal text, by part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def first_books(vectors: DataFrame, parts: int, entries: int) -> np.ndarray:
    """The parts of the first ``entries`` vectors, ``parts x entries x width``."""
    first = vectors.orderBy(F.col("id").asc_nulls_last(), "vector").limit(entries).select("vector").collect()
    if not first:
        return np.zeros((parts, 0, 0), np.int64)
    length = len(first[0].vector)
    if length % parts:
        raise ValueError(f"vectors of {length} components cannot be cut into {parts} equal parts")
    rows = [r.vector for r in first if len(r.vector) == length]
    return np.array(rows, np.int64).reshape(len(rows), parts, length // parts).transpose(1, 0, 2).copy()


def compress(
    rows: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> tuple[DataFrame, np.ndarray]:
    """``id, label, code, error`` for each kept row, and the final books (``parts x entries x width``).

    ``code`` lists the entry of each part in order; ``error`` is the sum of the
    parts' squared distances.
    """
    kept = rows.filter(usable(vector_col)).select(
        F.monotonically_increasing_id().alias("no"), F.col(id_col).alias("id"), F.col(label_col).alias("label"), scaled(vector_col).alias("vector")
    )
    vectors = stage(kept, "vectors")
    books = first_books(vectors, parts, entries)
    vectors = vectors.filter(F.size("vector") == parts * books.shape[2])
    if not books.size:  # no rows, or vectors without components
        code = F.array_repeat(F.lit(0), parts)
        return vectors.select("id", "label", code.alias("code"), F.lit(0).cast("long").alias("error")), books

    salts = -(-vectors.count() // SHARE)
    placed = vectors.select("no", "vector").mapInArrow(_cut(books), _MEMBER)
    members = resident = at_owners(placed, salts)
    for k in range(rounds):
        books = moved_books(members, books)
        judged = stage(members.mapInArrow(_judge(books), f"{_MEMBER}, chosen int, far bigint"), "judged")
        release(resident)
        if k + 1 < rounds:
            staying = judged.filter("chosen = entry").select("position", "entry", "no", "part")
            moving = judged.filter("chosen <> entry").select("position", F.col("chosen").alias("entry"), "no", "part")
            members = staying.unionByName(at_owners(moving, salts))
        resident = judged
    if not rounds:
        judged = stage(members.mapInArrow(_judge(books), f"{_MEMBER}, chosen int, far bigint"), "judged")
    found = judged.groupBy("no").agg(
        F.sort_array(F.collect_list(F.struct("position", "chosen"))).alias("code"), F.sum("far").alias("error")
    )
    found = found.select("no", F.transform("code", lambda x: x["chosen"]).alias("code"), "error")
    return vectors.drop("vector").join(found, "no").drop("no"), books


def coded(rows: DataFrame, **options) -> DataFrame:
    """``id, code, error, label_error, codebooks_sha256``: codes as hexadecimal text, errors also summed over equal labels."""
    found, books = compress(rows, **options)
    found = stage(found, "codes")
    labels = found.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    pair = lambda x: F.lower(F.lpad(F.hex(x.cast("long")), 2, "0"))
    return found.join(labels, F.col("label").eqNullSafe(F.col("of"))).select(
        "id",
        F.array_join(F.transform("code", pair), "").alias("code"),
        "error",
        "label_error",
        F.lit(digest(books)).alias("codebooks_sha256"),
    )
