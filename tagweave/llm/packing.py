"""Packing documents into fixed-length sequences: shortest pack first over the length histogram.

A document's ids are cut into pieces of ``length`` ids and a shorter last one.
Only the histogram of piece lengths, at most ``length`` rows whatever the corpus,
reaches the driver. There lengths are placed longest first: the packing pattern
with the shortest packs takes as many pieces as fit, its packs are split off as
a pattern of their own with their count, and pieces that fit nowhere open new
packs. The result is a table of ranges: pieces of this length from this rank on
go to these sequences at this offset. Pieces are ranked within their length over
the whole table (no length needs one task) and find their range by binary search.

Defined cases: a null text is an empty one, which is a single end id. Rows that
repeat an id are documents of their own. Ties in rank go by id, start and
checksum; pieces that agree in all of them are alike. An empty table gives an
empty result. Other columns are not read.
"""

from __future__ import annotations

import functools
import heapq
import itertools
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from tagweave.llm.common import text_or_empty
from tagweave.operators.numbering import number_rows
from tagweave.storage import stage

END_ID = 1
LENGTH = 2048
#: Words kept with their ids in each Python worker, in each of two generations, and the longest such word.
CACHE_WORDS, CACHE_CHARS = 400_000, 64
#: A Latin letter before a comma or full stop. U+0130 is not among them: in lower case it ends with a mark that the sign would join.
LETTER_SIGN = r"([A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{12F}\x{131}-\x{24F}])([,.])"


@functools.cache
def tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class WordIds:
    """Ids of texts as little-endian 32-bit numbers, each different word tokenized once.

    The tokenizer drops white space and case and lets no token reach across white
    space, nor from a letter into a comma or full stop, so the ids of a text are
    those of its parts. Arrow cuts the texts and numbers the words, so Python sees
    each different word of some texts once; the ids are then gathered by number.
    Words not met before are tokenized many at a time. When those kept are too
    many, they become the earlier generation: what is met again moves on, the rest
    goes at the next change.
    """

    def __init__(self, path: str):
        self.encode, self.known, self.earlier = tokenizer(path).encode, {}, {}

    def of(self, texts: list[str]) -> list[bytes]:
        lines = pc.replace_substring(pa.array(texts, pa.large_string()), "\n", " ")
        words = pc.split_pattern(pc.replace_substring_regex(lines, LETTER_SIGN, r"\1 \2"), " ")
        coded = words.values.dictionary_encode()
        found = self.look_up(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        ids = np.frombuffer(b"".join(found), "<u4")
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        starts, numbers = np.cumsum(sizes) - sizes, coded.indices.to_numpy()
        joined = b"".join(self.gather(ids, starts, sizes, numbers[at : at + (1 << 18)]) for at in range(0, len(numbers), 1 << 18))
        cuts = 4 * np.append(0, np.cumsum(sizes[numbers]))[words.offsets.to_numpy()]
        return [joined[a:b] for a, b in itertools.pairwise(cuts.tolist())]

    @staticmethod
    def gather(ids: np.ndarray, starts: np.ndarray, sizes: np.ndarray, numbers: np.ndarray) -> bytes:
        n = sizes[numbers]
        before = np.cumsum(n) - n
        return ids[np.repeat(starts[numbers] - before, n) + np.arange(n.sum())].tobytes()

    def look_up(self, words: list[str]) -> list[bytes]:
        if len(self.known) > CACHE_WORDS:
            self.known, self.earlier = {}, self.known
        known, earlier = self.known, self.earlier
        found = [known.get(word) for word in words]
        # A special token is no word of letters, and only as it stands does it count as one.
        missing = {i: words[i] for i, ids in enumerate(found) if ids is None}
        missing = {i: word.lower() if word.isascii() and word.isalpha() else word for i, word in missing.items()}
        new = set(missing.values()).difference(known)
        for word in new.intersection(earlier):
            known[word] = earlier[word]
        self.tokenize(list(new.difference(earlier)))
        for i, word in missing.items():
            found[i] = known[word]
        for word in [word for word in new if len(word) > CACHE_CHARS]:
            del known[word]
        return found

    def tokenize(self, words: list[str]) -> None:
        for at in range(0, len(words), 128):
            some = words[at : at + 128]
            found = self.encode(" ".join(some), add_special_tokens=False)
            ids = np.asarray(found.ids, "<u4")
            starts = np.cumsum([0] + [len(word) + 1 for word in some])
            cuts = 4 * np.searchsorted(np.fromiter((o[0] for o in found.offsets), np.int64, len(ids)), starts)
            joined = ids.tobytes()
            for word, a, b in zip(some, cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                self.known[word] = joined[a:b]


@functools.cache
def word_ids(path: str) -> WordIds:
    return WordIds(path)


def groups(texts: pa.Array, chars: int = 1 << 22) -> Iterator[list[str]]:
    """The texts in order, some at a time: about ``chars`` characters, or one longer text."""
    held, size = [], 0
    for text in texts:
        held.append(text.as_py())
        size += len(held[-1])
        if size >= chars:
            yield held
            held, size = [], 0
    if held:
        yield held


def cut(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, keep_ids: bool = False) -> DataFrame:
    """Pieces of each document: ``id, start, length, ids_crc32, doc_tokens`` and, if asked for, ``ids``."""
    id_type = docs.schema[id_col].dataType.simpleString()
    schema = f"id {id_type}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint" + ", ids binary" * keep_ids
    end = np.asarray([END_ID], "<u4").tobytes()

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, size = word_ids(path).of, 4 * length
        for batch in batches:
            where, starts, lengths, sums, totals, parts = [], [], [], [], [], []
            texts = batch.column(1)
            for row, body in enumerate(body for some in groups(texts) for body in ids_of(some)):
                ids = body + end
                for at in range(0, len(ids), size):
                    part = ids[at : at + size]
                    where.append(row)
                    starts.append(at // 4)
                    lengths.append(len(part) // 4)
                    sums.append(zlib.crc32(part))
                    totals.append(len(ids) // 4)
                    if keep_ids:
                        parts.append(part)
            columns = [batch.column(0).take(pa.array(where, "int64"))]
            columns += [pa.array(x, "int64") for x in (starts, lengths, sums, totals)] + [pa.array(parts, "binary")] * keep_ids
            names = ["id", "start", "length", "ids_crc32", "doc_tokens"] + ["ids"] * keep_ids
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text")).mapInArrow(pieces, schema)


def place(histogram: dict[int, int], length: int = LENGTH) -> tuple[pd.DataFrame, int]:
    """Ranges ``length, rank, n, each, sequence, offset`` and the number of sequences.

    A range: ``n`` pieces of a length from ``rank`` on, ``each`` to a sequence, in
    consecutive sequences, the first piece of each at ``offset``.
    """
    ranges, opened = [], 0
    packs: list[tuple[int, int, int]] = []  # a pattern: room left (negative), first sequence, how many
    for size in sorted(histogram, reverse=True):
        rank, left = 0, histogram[size]

        def put(room: int, sequence: int, packs_of: int, size=size) -> None:
            nonlocal rank, left
            each = room // size
            full = min(packs_of, left // each)
            used = full
            if full:
                ranges.append((size, rank, full * each, each, sequence, length - room))
                rank, left = rank + full * each, left - full * each
                heapq.heappush(packs, (-(room - each * size), sequence, full))
            if left and used < packs_of:  # fewer pieces than one more pack could take
                ranges.append((size, rank, left, left, sequence + used, length - room))
                heapq.heappush(packs, (-(room - left * size), sequence + used, 1))
                rank, left, used = rank + left, 0, used + 1
            if used < packs_of:
                heapq.heappush(packs, (-room, sequence + used, packs_of - used))

        while left and packs and -packs[0][0] >= size:
            room, sequence, n = heapq.heappop(packs)
            put(-room, sequence, n)
        if left:
            new = -(-left // (length // size))
            first, opened = opened, opened + new
            put(length, first, new)
    return pd.DataFrame(ranges, columns=["length", "rank", "n", "each", "sequence", "offset"], dtype="int64"), opened


def pack(pieces: DataFrame, length: int = LENGTH) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to staged pieces. Sequences count from 0, offsets have no gap."""
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    ranges, _ = place(histogram, length)
    ranges = ranges.sort_values(["length", "rank"], ignore_index=True)
    before, total = {}, 0
    for size in sorted(histogram):
        before[size] = total
        total += histogram[size]
    at = ranges["length"].map(before).to_numpy("int64") if len(ranges) else np.zeros(0, "int64")
    starts, table = at + ranges["rank"].to_numpy(), {c: ranges[c].to_numpy() for c in ranges}
    numbered = number_rows(pieces, "__n", "length", "id", "start", "ids_crc32")
    names = list(pieces.columns)
    schema = StructType([*pieces.schema.fields]).add("sequence_id", "long").add("offset", "long")

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.column("__n").to_numpy(zero_copy_only=False)
            found = np.searchsorted(starts, n, "right") - 1
            pack_of, slot = np.divmod(n - starts[found], table["each"][found])
            columns = [batch.column(c) for c in names]
            columns += [pa.array(table["sequence"][found] + pack_of), pa.array(table["offset"][found] + slot * table["length"][found])]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "sequence_id", "offset"])

    return numbered.mapInArrow(assign, schema)


def packed(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, keep_ids: bool = False) -> DataFrame:
    """Pieces of all documents with their sequence and offset."""
    return pack(stage(cut(docs, path, id_col, text_col, length, keep_ids), "pieces"), length)


def sequences(placed: DataFrame, length: int = LENGTH, pad_id: int = 0) -> DataFrame:
    """``sequence_id, n_tokens, ids``: pieces with ``ids`` put together, padded with ``pad_id``.

    A sequence whose length is a power of two is not padded. A group is one
    sequence, so at most ``length`` ids.
    """
    schema = "sequence_id bigint, n_tokens bigint, ids array<bigint>"

    def whole(group: pd.DataFrame) -> pd.DataFrame:
        ids = np.frombuffer(b"".join(group.sort_values("offset")["ids"]), "<u4").astype("int64")
        n = len(ids)
        if n & (n - 1):
            ids = np.pad(ids, (0, length - n), constant_values=pad_id)
        return pd.DataFrame({"sequence_id": [group["sequence_id"].iloc[0]], "n_tokens": [n], "ids": [ids]})

    return placed.select("sequence_id", "offset", "ids").groupBy("sequence_id").applyInPandas(whole, schema)
