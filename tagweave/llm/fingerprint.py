"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests.

A text is the set of its paragraphs' digests; a paragraph of more than
``part_words`` words counts as several parts of so many words. A sketch is three
rows of cells; every digest falls into one cell of each row, and a cell holds the
number of its digests, their xor and the xor of their checks. Subtracting the
sketches of two versions cell by cell leaves the digests that differ. Cells with
one digest give it away; taking those out of their other cells opens further
ones, until all are recovered. Then the versions share the rest, and likeness is
the share of common digests among all.

The fingerprint is the text of a sketch of ``3 * BASE`` cells, whatever the size
of the document. If the difference of two of them cannot be peeled, a larger
sketch is tried: digests are split into buckets of about ``BUCKET``, each a
sketch of ``3 * WIDE`` cells of its own, so the work grows with the document and
not with its square. What cannot be peeled yet is tried again with twice as many
buckets and other hashes.

All of it is DataFrame functions on arrays within a row; nothing is exploded. The
texts are moved once, together with each document's part in the edit of another.

Defined cases: a null text is an empty one. Texts without words have an empty set
and likeness 1 to each other, 0 to all others. The next document of the last is
the first, so a single document is its own. Rows without an id come last; rows
that repeat an id follow each other in the order of their MD5. Rows that agree in
both get the same next document. An empty table gives an empty result. Columns
other than the two named ones are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tagweave.llm.common import SPACE, text_or_empty
from tagweave.operators.numbering import number_rows
from tagweave.storage import stage

PART_WORDS = 24
BASE, WIDE, BUCKET = 6, 12, 12
ROUNDS = 8


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def digests(text: Column, part_words: int) -> Column:
    """The distinct 64-bit digests of a text's paragraphs."""
    part = rf"(?:[^{SPACE}]++[\x20\x09\x0B-\x0D]*+){{1,{part_words}}}"
    parts = F.regexp_extract_all(text, F.lit(part), F.lit(0))
    return F.array_distinct(F.transform(parts, lambda p: F.xxhash64(F.rtrim(p))))


def _check(digest: Column) -> Column:
    return F.xxhash64(digest, F.lit(99))


def _placed(found: Column, width: int, seed: Column) -> Column:
    """Digests with their cell in each row, numbered through the rows, and a bucket number."""

    def place(d: Column) -> Column:
        return _let(
            F.xxhash64(d, seed),
            lambda h: F.struct(
                d.alias("k"),
                F.pmod(h, F.lit(width)).alias("a"),
                (F.pmod(F.shiftright(h, 20), F.lit(width)) + width).alias("b"),
                (F.pmod(F.shiftright(h, 40), F.lit(width)) + 2 * width).alias("c"),
                F.shiftrightunsigned(h, 8).alias("bucket"),
                _check(d).alias("h"),
            ),
        )

    return F.transform(found, place)


def _cells(found: Column, width: int) -> Column:
    """Cells of a sketch of placed digests."""
    return _let(found, lambda placed: _filled(placed, width))


def _filled(placed: Column, width: int) -> Column:
    zero = F.lit(0).cast("long")
    empty = F.struct(zero.alias("n"), zero.alias("k"), zero.alias("h"))

    def add(s: Column, d: Column) -> Column:
        return F.struct(
            (s["n"] + 1).alias("n"), s["k"].bitwiseXOR(d["k"]).alias("k"), s["h"].bitwiseXOR(d["h"]).alias("h")
        )

    def row(name: str, first: int) -> Column:
        numbers = F.array(*[F.lit(first + i).cast("long") for i in range(width)])
        return F.transform(numbers, lambda j: F.aggregate(F.filter(placed, lambda d: d[name] == j), empty, add))

    return F.concat(row("a", 0), row("b", width), row("c", 2 * width))


def _subtract(left: Column, right: Column) -> Column:
    return F.zip_with(
        left,
        right,
        lambda x, y: F.struct(
            (x["n"] - y["n"]).alias("n"), x["k"].bitwiseXOR(y["k"]).alias("k"), x["h"].bitwiseXOR(y["h"]).alias("h")
        ),
    )


def _peel(difference: Column, width: int, seed: Column) -> Column:
    """``rest`` (cells that are not empty) and ``found`` (``k``, and ``n``: 1 on the left only, -1 on the right only)."""
    none = F.array().cast("array<struct<k:bigint,n:bigint>>")
    start = F.struct(difference.alias("cells"), none.alias("found"), F.lit(False).alias("done"))

    def opened(cells: Column) -> Column:
        single = F.filter(cells, lambda c: (F.abs(c["n"]) == 1) & (_check(c["k"]) == c["h"]))
        keys = F.array_distinct(F.transform(single, lambda c: F.struct(c["k"].alias("k"), c["n"].alias("n"), c["h"].alias("h"))))

        def place(c: Column) -> Column:
            return _let(
                F.xxhash64(c["k"], seed),
                lambda h: F.struct(
                    c["k"].alias("k"),
                    c["n"].alias("n"),
                    c["h"].alias("h"),
                    F.pmod(h, F.lit(width)).cast("int").alias("a"),
                    (F.pmod(F.shiftright(h, 20), F.lit(width)) + width).cast("int").alias("b"),
                    (F.pmod(F.shiftright(h, 40), F.lit(width)) + 2 * width).cast("int").alias("c"),
                ),
            )

        return F.transform(keys, place)

    def taken(cells: Column, out: Column) -> Column:
        def of_row(name: str, first: int) -> Column:
            # A digest lies in one cell of each row, so a row's cells ask for their own place only.
            return F.transform(
                F.slice(cells, first + 1, width),
                lambda c, j: F.aggregate(
                    F.filter(out, lambda d: d[name] == j + first),
                    c,
                    lambda s, d: F.struct(
                        (s["n"] - d["n"]).alias("n"), s["k"].bitwiseXOR(d["k"]).alias("k"), s["h"].bitwiseXOR(d["h"]).alias("h")
                    ),
                ),
            )

        return F.concat(of_row("a", 0), of_row("b", width), of_row("c", 2 * width))

    def step(state: Column, _: Column) -> Column:
        def go(out: Column) -> Column:
            found = F.transform(out, lambda d: F.struct(d["k"].alias("k"), d["n"].alias("n")))
            none_left = F.struct(state["cells"].alias("cells"), state["found"].alias("found"), F.lit(True).alias("done"))
            return F.when(F.size(out) == 0, none_left).otherwise(
                F.struct(taken(state["cells"], out).alias("cells"), F.concat(state["found"], found).alias("found"), F.lit(False).alias("done"))
            )

        return F.when(state["done"], state).otherwise(_let(opened(state["cells"]), go))

    def end(state: Column) -> Column:
        rest = F.filter(state["cells"], lambda c: (c["n"] != 0) | (c["k"] != 0) | (c["h"] != 0))
        return F.struct(F.size(rest).alias("rest"), state["found"].alias("found"))

    rounds = F.array(*[F.lit(i) for i in range(ROUNDS)])
    return F.aggregate(rounds, start, step, end)


def _base(found: Column) -> Column:
    return _cells(_placed(found, BASE, F.lit(0).cast("long")), BASE)


def written(cells: Column, found: Column) -> Column:
    """A sketch as text: the number of digests, then each cell's number, xor and check."""
    cell = lambda c: F.concat_ws(".", c["n"].cast("string"), F.lower(F.hex(c["k"])), F.lower(F.hex(c["h"])))
    return F.concat(F.size(found).cast("string"), F.lit(":"), F.array_join(F.transform(cells, cell), ","))


def _wide(left: Column, right: Column, attempt: Column) -> Column:
    """``rest, found`` of a pair by sketches of buckets."""
    seed = (attempt + 1).cast("long")
    wanted = F.ceil((F.size(left) + F.size(right)) / BUCKET)
    bits = F.ceil(F.log2(F.greatest(wanted, F.lit(1)).cast("double"))).cast("int") + attempt
    # Split in two steps, each by the root of the number of buckets.
    power = lambda b: F.pow(F.lit(2), F.floor(b)).cast("long")
    shape = F.struct(power(bits / 2).alias("upper"), power((bits + 1) / 2).alias("lower"))
    return _let(shape, lambda buckets: _by_bucket(left, right, seed, buckets))


def _by_bucket(left: Column, right: Column, seed: Column, buckets: Column) -> Column:
    first = F.lit(0).cast("long")

    def split(found: Column) -> Column:
        outer, inner = F.sequence(first, buckets["upper"] - 1), F.sequence(first, buckets["lower"] - 1)
        of_outer = lambda placed, i: F.filter(placed, lambda d: F.pmod(d["bucket"], buckets["upper"]) == i)
        of_inner = lambda some, j: F.filter(some, lambda d: F.pmod(F.shiftrightunsigned(d["bucket"], 24), buckets["lower"]) == j)
        return _let(
            _placed(found, WIDE, seed),
            lambda placed: F.when((buckets["upper"] == 1) & (buckets["lower"] == 1), F.array(placed)).otherwise(
                F.flatten(F.transform(outer, lambda i: _let(of_outer(placed, i), lambda some: F.transform(inner, lambda j: of_inner(some, j)))))
            ),
        )

    peeled = F.zip_with(split(left), split(right), lambda x, y: _peel(_subtract(_cells(x, WIDE), _cells(y, WIDE)), WIDE, seed))
    return _let(
        peeled,
        lambda p: F.struct(
            F.aggregate(p, F.lit(0), lambda s, x: s + x["rest"]).alias("rest"), F.flatten(F.transform(p, lambda x: x["found"])).alias("found")
        ),
    )


def compare(left: Column, right: Column, left_base: Column, right_base: Column, attempt: Column) -> Column:
    """``rest, found`` by the fingerprints themselves, else by larger sketches."""
    small = _peel(_subtract(left_base, right_base), BASE, F.lit(0).cast("long"))
    # More filled cells than could be peeled, or sizes that cannot be that near: not worth the steps.
    near = (F.abs(F.size(left) - F.size(right)) <= 2 * BASE) & (
        F.size(F.filter(_subtract(left_base, right_base), lambda c: (c["n"] == 0) & (c["h"] == 0))) > 0
    )
    by_base = F.when(near & (attempt == 0), small)
    return _let(by_base, lambda b: F.when(b["rest"] == 0, b).otherwise(_wide(left, right, attempt)))


def _likeness(left: Column, right: Column, found: Column) -> Column:
    both = (F.size(left) + F.size(right) - F.size(found)) / 2
    every = F.size(left) + F.size(right) - both
    return F.when(every == 0, 1.0).otherwise(both / every)


def _attempt(sets: Column, attempt: Column, all_of: bool) -> Column:
    """Results for ``own, edited, next`` digests; the sets themselves only if something is left to peel."""

    def bases(s: Column) -> Column:
        return F.struct(_base(s["own"]).alias("own"), _base(s["edited"]).alias("edited"), _base(s["next"]).alias("next"))

    def results(s: Column, b: Column) -> Column:
        return F.struct(
            compare(s["own"], s["edited"], b["own"], b["edited"], attempt).alias("edited"),
            compare(s["own"], s["next"], b["own"], b["next"], attempt).alias("next"),
        )

    def row(s: Column, b: Column, r: Column) -> Column:
        open_ = (r["edited"]["rest"] > 0) | (r["next"]["rest"] > 0)
        columns = [
            _likeness(s["own"], s["edited"], r["edited"]["found"]).alias("near_edited"),
            _likeness(s["own"], s["next"], r["next"]["found"]).alias("near_next"),
            F.when(open_, s).alias("again"),
        ]
        if all_of:
            columns += [written(b["own"], s["own"]).alias("fingerprint"), written(b["edited"], s["edited"]).alias("edited_fingerprint")]
        return F.struct(*columns)

    return _let(sets, lambda s: _let(bases(s), lambda b: _let(results(s, b), lambda r: row(s, b, r))))


def neighbours(docs: DataFrame, descending: bool = True) -> DataFrame:
    """``id, md5, size, next_id, next_md5``: each row with the next in order of id, the last with the first."""
    rows = docs.select("id", F.md5("text").alias("md5"), F.length("text").alias("size")).distinct()
    by = F.col("id").desc_nulls_last() if descending else F.col("id").asc_nulls_last()
    ranked = stage(number_rows(rows, "rank", by, "md5"), "ranked")
    total = ranked.count()
    after = ranked.select(F.pmod(F.col("rank") - 1, F.lit(max(total, 1))).alias("rank"), F.col("id").alias("next_id"), F.col("md5").alias("next_md5"))
    return ranked.join(after, "rank").drop("rank")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_words: int = PART_WORDS) -> DataFrame:
    """One row per input row: ``id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``.

    The edited text: the last third of the characters (rounded down) replaced by
    the first as many of the next document, in descending order of ids.
    """
    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    pairs = stage(neighbours(rows), "pairs")
    ids = rows.agg(F.count(F.lit(1)).alias("n"), F.count("id").alias("filled"), F.count_distinct("id").alias("distinct")).first()
    unique = ids.n == ids.filled == ids.distinct
    third = F.floor(F.col("size") / 3).cast("int")
    if unique:
        as_next = pairs.select(F.col("next_id").alias("id"), F.col("id").alias("for_id"), "size")
        given = rows.join(as_next, "id")
        given = given.select(F.col("for_id").alias("id"), F.substring("text", F.lit(1), third).alias("head"), digests(F.col("text"), part_words).alias("next"))
        joined = rows.join(given, "id")
    else:
        keyed = rows.withColumn("md5", F.md5("text"))
        as_next = pairs.select("next_id", "next_md5", F.col("id").alias("for_id"), F.col("md5").alias("for_md5"), "size")
        # Of rows that agree in id and text one speaks for all.
        once = keyed.dropDuplicates(["id", "md5"])
        given = once.join(as_next, F.col("id").eqNullSafe(F.col("next_id")) & (F.col("md5") == F.col("next_md5")))
        given = given.select("for_id", "for_md5", F.substring("text", F.lit(1), third).alias("head"), digests(F.col("text"), part_words).alias("next"))
        joined = keyed.join(given, F.col("id").eqNullSafe(F.col("for_id")) & (F.col("md5") == F.col("for_md5")))
    size = F.length("text")
    kept = F.substring("text", F.lit(1), size - F.floor(size / 3).cast("int"))
    edited = joined.select("id", size.cast("long").alias("n_chars"), "text", F.concat(kept, "head").alias("edited"), "next")
    sets = F.struct(digests(F.col("text"), part_words).alias("own"), digests(F.col("edited"), part_words).alias("edited"), F.col("next").alias("next"))
    first = edited.select(
        "id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), _attempt(sets, F.lit(0), True).alias("r")
    )
    done = stage(first, "sketches")
    columns = ["id", "n_chars", "edited_sha256", "r.fingerprint", "r.edited_fingerprint"]
    result = done.filter("r.again is null").select(*columns, "r.near_edited", "r.near_next")
    left, attempt = done.filter("r.again is not null").select(*columns, F.col("r.again").alias("again")), 1
    while not left.isEmpty():
        tried = left.withColumn("r", _attempt(F.col("again"), F.lit(attempt), False)).drop("again")
        tried = stage(tried, f"attempt{attempt}")
        kept_columns = ["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint"]
        result = result.unionByName(tried.filter("r.again is null").select(*kept_columns, "r.near_edited", "r.near_next"))
        left, attempt = tried.filter("r.again is not null").select(*kept_columns, F.col("r.again").alias("again")), attempt + 1
    return result
