"""Operators against plain Python on random rows, a third of them on one key."""

import datetime as dt
import random
from collections import Counter, defaultdict
from decimal import Decimal

from pyspark.sql import functions as F

from tagweave.functions import dates
from tagweave.operators import features, measures, segments
from tagweave.operators.features import vector_from_array
from tagweave.sinks import profile
from tagweave.sources import cells

N = 3000


def key(draw):
    return "hot" if draw.random() < 1 / 3 else f"u{draw.randint(0, 200)}"


def test_date_shift(spark):
    draw = random.Random(1)
    rows = [
        (str(dt.date(1990, 1, 1) + dt.timedelta(days=draw.randint(0, 20000))), draw.randint(-900, 900))
        for _ in range(N)
    ]
    df = spark.createDataFrame(rows, "d string, n int")
    for row in df.withColumn("x", dates.shift_date(F.col("d"), F.col("n"))).collect():
        assert row.x == str(dt.date.fromisoformat(row.d) + dt.timedelta(days=row.n))


def test_rfm(spark):
    draw = random.Random(2)
    rows = [
        (key(draw), str(draw.randint(1, 2_000_000_000)), draw.choice([None, "o"]), draw.choice(["x", None, f"{draw.randint(0, 999999) / 100:.2f}"]))
        for _ in range(N)
    ]
    df = spark.createDataFrame(rows, "memberid string, finishtime string, ordersn string, orderamount string")
    expected = defaultdict(lambda: [0, 0, None, 0])
    for user, seconds, order, amount in rows:
        entry = expected[user]
        entry[0] = max(entry[0], int(seconds))
        entry[1] += order is not None
        if amount == "x":
            entry[3] += 1
        elif amount is not None:
            entry[2] = (entry[2] or 0) + Decimal(amount)
    as_of = dt.date(2040, 1, 1)
    found = measures.rfm(df.repartition(7), as_of, count_bad_amounts=True).collect()
    assert len(found) == len(expected)
    for row in found:
        last, n, total, bad = expected[row.userId]
        day = dt.datetime.fromtimestamp(last, dt.timezone.utc).date()
        assert tuple(row)[1:] == ((as_of - day).days, n, total, bad)


def test_rfe(spark):
    draw = random.Random(3)
    start = dt.datetime(2024, 1, 1)
    rows = [
        (key(draw), start + dt.timedelta(minutes=draw.randint(0, 90000)), draw.choice([None, *map(str, range(60))]))
        for _ in range(N)
    ]
    df = spark.createDataFrame(
        [(u, str(t), p) for u, t, p in rows], "global_user_id string, log_time string, loc_url string"
    )
    times, pages = defaultdict(list), defaultdict(list)
    for user, time, page in rows:
        times[user].append(time)
        pages[user] += [page] if page else []
    found = measures.rfe(df.repartition(7), dt.date(2024, 9, 1)).collect()
    assert {r.userId: tuple(r)[1:] for r in found} == {
        u: ((dt.date(2024, 5, 24) - max(times[u]).date()).days, len(pages[u]), len(set(pages[u]))) for u in times
    }


def test_string_index(spark):
    draw = random.Random(4)
    rows = [(i, key(draw)) for i in range(N)]
    counts = Counter(k for _, k in rows)
    place = {k: float(i) for i, k in enumerate(sorted(counts, key=lambda k: (-counts[k], k)))}
    df = spark.createDataFrame(rows, "i int, k string").repartition(7)
    found = features.string_index(df, "k", "x").collect()
    assert {r.i: r.x for r in found} == {i: place[k] for i, k in rows}


def test_within_cluster_error(spark):
    draw = random.Random(5)
    rows = [(key(draw), [draw.gauss(0, 1) for _ in range(4)]) for _ in range(N)]
    groups = defaultdict(list)
    for k, x in rows:
        groups[k].append(x)
    total = 0.0
    for points in groups.values():
        for slot in zip(*points):
            mean = sum(slot) / len(slot)
            total += sum((v - mean) ** 2 for v in slot)
    df = vector_from_array(spark.createDataFrame(rows, "k string, e array<double>").repartition(7), "e")
    assert abs(segments.within_cluster_error(df, "k", "features").first().wssse - total) < 1e-7


def test_cells_and_upserts(spark, tmp_path):
    """Three rounds of random cells, stored and read back."""
    draw = random.Random(6)
    tags, expected, base = ["a", "b", "c"], defaultdict(dict), str(tmp_path / "profile")
    for _ in range(3):
        chosen = draw.sample(tags, 2)
        users = draw.sample(range(300), 150)
        rows = [(f"u{u}", *(draw.choice([None, str(draw.randint(0, 9))]) for _ in chosen)) for u in users]
        for user, *values in rows:
            expected[user].update({t: v for t, v in zip(chosen, values) if v is not None})
        df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in ["userId", *chosen]))
        # The same rows once more, in pieces: they say nothing new.
        pieces = df.unionByName(df.select("userId", chosen[0]), allowMissingColumns=True)
        stored = profile.save_profile(pieces, base, buckets=5)
    found = {r.userId: {t: r[t] for t in stored.columns if t != "userId" and r[t] is not None} for r in stored.collect()}
    assert found == dict(expected)
    as_cells = cells.rows_to_cells(stored, "userId", "user")
    assert as_cells.count() == sum(map(len, expected.values())) + len(expected)
    back = cells.cells_to_rows(as_cells, "user", tags, "userId").collect()
    # A scan of some fields does not see rows that have none of them.
    with_tags = {user: cell for user, cell in expected.items() if cell}
    assert {r.userId: {t: r[t] for t in tags if r[t] is not None} for r in back} == with_tags
