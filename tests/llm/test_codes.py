"""Vector codes against plain Python."""

import math
import random

import numpy as np
import pytest

from tagweave.llm import codes


def plain(rows, parts, entries, rounds):
    """Rows ``id, vector, label`` by the same rules, one at a time."""
    kept = [(i, [math.floor(256 * x) for x in v], lab) for i, v, lab in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    kept = [r for r in kept if len(r[1]) == len(kept[0][1])]
    if not kept:
        return [], []
    width = len(kept[0][1]) // parts
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for _, v, _ in kept]
    books = [[list(v[p]) for v in cut[:entries]] for p in range(parts)]

    def near(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, e, strict=True)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            own = [near(v[p], books[p])[1] for v in cut]
            for k in set(own):
                members = [v[p] for v, o in zip(cut, own, strict=True) if o == k]
                books[p][k] = [sum(x) // len(members) for x in zip(*members, strict=True)]
    out = []
    for (i, _, lab), v in zip(kept, cut, strict=True):
        found = [near(v[p], books[p]) for p in range(parts)]
        out.append((i, lab, [k for _, k in found], sum(d for d, _ in found)))
    return out, books


def some(n, length, seed=0):
    rng = random.Random(seed)
    rows = [(k * 3 % (n + 1), [rng.gauss(0, 0.3) for _ in range(length)], rng.choice([1, 2, None])) for k in range(n)]
    hot = [rng.gauss(0, 0.3) for _ in range(length)]
    rows += [(1000 + k, hot, 1) for k in range(n // 2)]  # one vector makes up a third
    rows += [(2000, None, 1), (2001, [None] + hot[1:], 1), (2002, [float("nan")] + hot[1:], 2), (2003, [float("inf")] + hot[1:], 2)]
    return rows + [(None, hot, None), (5, hot, 2), (5, rows[0][1], 2), (2004, hot[:-1], 2)]


SCHEMA = "vec_id long, embedding array<float>, label int, no string, id string, entry string, part string, code string"


def frame(spark, rows, schema=SCHEMA):
    rows = [(i, v and [x if x is None else float(np.float32(x)) for x in v], lab, *["z"] * 5) for i, v, lab in rows]
    return spark.createDataFrame(rows, schema).repartition(3), rows


@pytest.mark.parametrize(("parts", "entries", "rounds"), [(4, 8, 2), (2, 64, 3), (8, 5, 0)])
def test_against_plain(spark, monkeypatch, parts, entries, rounds):
    monkeypatch.setattr(codes, "SHARE", 16)  # several owners for each entry
    df, rows = frame(spark, some(120, 16))
    expected, books = plain([r[:3] for r in rows], parts, entries, rounds)
    result, found = codes.compress(df, parts=parts, entries=entries, rounds=rounds)
    assert found.tolist() == books
    key = lambda r: (r[0] is None, r[0] or 0, str(r))
    assert sorted(((r.id, r.label, r.code, r.error) for r in result.collect()), key=key) == sorted(expected, key=key)


def test_coded(spark):
    df, rows = frame(spark, some(60, 16, seed=4))
    expected, books = plain([r[:3] for r in rows], 4, 64, 2)
    result = codes.coded(df, parts=4).collect()
    sums = {}
    for _, label, _, error in expected:
        sums[label] = sums.get(label, 0) + error
    assert sorted((r.id or 0, r.code, r.error, r.label_error) for r in result) == sorted((i or 0, "".join(f"{k:02x}" for k in c), e, sums[lab]) for i, lab, c, e in expected)
    assert {r.codebooks_sha256 for r in result} == {codes.digest(np.array(books))}


def test_fewer_rows_than_entries_and_none(spark):
    df, rows = frame(spark, some(3, 16))
    expected, books = plain([r[:3] for r in rows], 4, 64, 2)
    result, found = codes.compress(df, parts=4)
    assert found.tolist() == books and result.count() == len(expected)
    for empty in (df.filter("vec_id < 0"), df.filter("vec_id >= 2000 and vec_id < 2004")):
        nothing = codes.coded(empty)
        assert nothing.columns == ["id", "code", "error", "label_error", "codebooks_sha256"] and nothing.count() == 0


def test_only_parts_that_change_entry_move(spark, monkeypatch):
    moved = []
    own = codes.at_owners
    monkeypatch.setattr(codes, "at_owners", lambda members, salts: moved.append(members.count()) or own(members, salts))
    df, _ = frame(spark, some(200, 16, seed=9))
    codes.compress(df, parts=4, entries=16, rounds=3)
    everything, *later = moved
    assert len(later) == 2 and all(0 < n < everything / 2 for n in later)


def test_odd_lengths_and_sizes(spark, failing):
    df, _ = frame(spark, [(1, [0.5] * 10, 1)])
    with pytest.raises(ValueError, match="equal parts"):
        codes.compress(df, parts=4)
    df, _ = frame(spark, [(1, [], 1), (2, [], None)])
    assert [(r.code, r.error) for r in codes.coded(df, parts=3).collect()] == [("000000", 0)] * 2
    df, _ = frame(spark, [(1, [1e30] * 4, 1)])
    with pytest.raises(Exception, match="too large"):
        codes.compress(df, parts=4)
