"""Operators on documents against plain Python over small and odd tables."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tagweave.llm import exact, fingerprint, mixing, neardup, packing, queries, repeats, toxicity
from tagweave.llm.components import components
from tagweave.llm.suffix import suffix_arrays
from tests.llm.plain import key, near_components, near_kept, noisy_or, targets, words

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


# Exact deduplication


@pytest.mark.parametrize("largest", [True, False])
def test_exact_groups(odd_docs, odd_rows, largest):
    groups = defaultdict(list)
    for i, t, _ in odd_rows:
        groups[t or ""].append(i)
    expected = Counter()
    for i, t, _ in odd_rows:
        ids = [x for x in groups[t or ""] if x is not None]
        keep = (max(ids) if largest else min(ids)) if ids else None
        expected[(i, keep, len(groups[t or ""]), i == keep, hashlib.sha256((t or "").encode()).hexdigest())] += 1
    assert Counter(map(tuple, exact.duplicates(odd_docs, largest=largest).collect())) == expected


def test_exact_keeps_one_of_each(odd_docs, odd_rows):
    kept = exact.deduplicate(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(r.text or "" for r in kept.collect()) == sorted({t or "" for _, t, _ in odd_rows})


def test_exact_tells_colliding_texts_apart(odd_docs, odd_rows):
    weak = lambda text: F.substring(F.md5(text), 1, 1)
    found = exact.duplicates(odd_docs, hashed=weak)
    assert Counter(map(tuple, found.collect())) == Counter(map(tuple, exact.duplicates(odd_docs).collect()))


# Suffix arrays and repeats


def test_suffix_arrays():
    rng = np.random.default_rng(0)
    parts = [np.append(rng.integers(1, rng.integers(2, 5), rng.integers(0, 40)), 0) for _ in range(200)]
    starts = np.concatenate(([0], np.cumsum([len(p) for p in parts])))
    found = suffix_arrays(np.concatenate(parts), starts)
    for k, part in enumerate(parts):
        p = tuple(part)
        assert list(found[starts[k] : starts[k + 1]] - starts[k]) == sorted(range(len(p)), key=lambda j: p[j:])


def without_repeats(rows, length=100):
    seen, found = set(), {}
    for i, t in sorted({(i, t or "") for i, t in rows}, key=lambda r: key(*r)):
        body = t.encode()
        covered = np.zeros(len(body), bool)
        for at in range(len(body) - length + 1):
            piece = body[at : at + length]
            if piece in seen:
                covered[at : at + length] = True
            seen.add(piece)
        spans = int((np.diff(np.concatenate(([0], covered.astype(int)))) == 1).sum())
        found[(i, t)] = (len(body), int(covered.sum()), spans, bytes(np.frombuffer(body, np.uint8)[~covered]))
    return found


def check_repeats(spark, df, rows):
    expected = without_repeats([(i, t) for i, t, *_ in rows])
    wanted = Counter((i, *expected[(i, t or "")]) for i, t, *_ in rows)
    found = Counter((r.id, r.n_bytes, r.n_removed, len(r.spans), bytes(r.kept)) for r in repeats.remove_repeats(df).collect())
    assert found == wanted


def test_repeats_on_odd_rows(spark, odd_docs, odd_rows):
    short = [r for r in odd_rows if len(r[1] or "") < 20_000]
    check_repeats(spark, odd_docs.filter("text is null or length(text) < 20000"), short)


@pytest.mark.parametrize("most", [2, 64])
def test_repeats_of_a_hot_passage(spark, monkeypatch, most):
    monkeypatch.setattr(repeats, "MOST_UNITS", most)
    rng = np.random.default_rng(3)
    letters = np.array(list("abcdef gh"))
    base = "".join(rng.choice(letters, 300))
    rows = []
    for i in range(150):
        a, b = rng.integers(0, 90), rng.integers(150, 300)
        rows.append((i, "".join(rng.choice(letters, rng.integers(0, 90))) + base[a:b] + str(i)))
    check_repeats(spark, spark.createDataFrame(rows, "doc_id long, text string"), rows)


def test_repeats_of_an_anchor_with_thousands_of_units(spark, monkeypatch):
    """5,000 texts with one anchor, between some beginnings and ends: opened step by step, and no string lost."""
    rng = np.random.default_rng(4)
    letters = np.array(list("abcdefghijklmnop"))
    some = lambda n: "".join(rng.choice(letters, n))
    least = lambda text: int(repeats.anchors(np.frombuffer(text.encode(), np.uint8), 32)[1].view(np.uint64)[0])
    core = min((some(32) for _ in range(4000)), key=least)
    lefts, rights = [some(60) for _ in range(30)], [some(60) for _ in range(30)]
    rows = []
    for i in range(5000):
        own = [rng.choice(lefts) if rng.random() < 0.5 else some(60), rng.choice(rights) if rng.random() < 0.5 else some(60)]
        rows.append((i, own[0][rng.integers(0, 50) :] + core + own[1][: rng.integers(10, 60)]))
    monkeypatch.setattr(repeats, "MOST_UNITS", 8)
    units, opened = [], repeats._opened
    monkeypatch.setattr(repeats, "_opened", lambda many, length: units.append(many.agg(F.max("n")).first()[0]) or opened(many, length))
    check_repeats(spark, spark.createDataFrame(rows, "doc_id long, text string"), rows)
    assert units[0] > 2000 and len(units) >= 2 and units == sorted(units, reverse=True)


def test_every_string_of_a_split_unit_is_filed_once():
    rng = np.random.default_rng(9)
    for _ in range(200):
        run = int(rng.integers(1, 70))
        piece = rng.integers(0, 256, run + 99, dtype=np.uint8).tobytes()
        low = int(rng.integers(run - 1, 69))
        waiting, done = [(7, 0, run, piece, low, low + 32)], []
        while waiting:
            for _, start, n, part, a, b in repeats._split(*waiting.pop(), 100):
                assert part == piece[start : start + n + 99] and 0 <= a < b <= len(part)
                # What is filed lies in every string of the unit.
                assert a >= n - 1 and b <= 100
                if b - a < 100:
                    waiting.append((7, start, n, part, a, b))
                else:
                    done += range(start, start + n)
        assert sorted(done) == list(range(run))


# Near duplicates


def near_groups(rows, n):
    least, found = {}, near_components(rows, n)
    for i, _, _, c in found:
        least[c] = min(least.get(c, (True, 0)), (i is None, i or 0))
    return Counter((i, len(s), (None if least[c][0] else least[c][1]) if s else i) for i, _, s, c in found)


def test_near_duplicates_on_odd_rows(odd_docs, odd_rows):
    found = neardup.near_duplicates(odd_docs, words=2)
    assert Counter(tuple(r)[:3] for r in found.collect()) == near_groups(odd_rows, 2)


def test_near_duplicates_of_a_large_group(spark):
    rng = np.random.default_rng(8)
    base, rows = [f"w{k}" for k in range(120)], []
    for i in range(240):
        text = list(base)
        for at in rng.integers(0, 120, rng.integers(0, 12)):
            text[at] = f"v{rng.integers(0, 400)}"
        rows.append((i, " ".join(text)))
    found = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), words=2)
    assert Counter(tuple(r)[:3] for r in found.collect()) == near_groups(rows, 2)


def drifted(n, rng, length=120, most=7):
    """Texts of a tree of variants: each a changed copy of an earlier one."""
    texts = [[f"w{k}" for k in range(length)]]
    while len(texts) < n:
        text = list(texts[rng.integers(0, len(texts))])
        for at in rng.integers(0, length, rng.integers(1, most)):
            text[at] = f"v{rng.integers(0, 4000)}"
        texts.append(text)
    return [(i, " ".join(texts[k])) for i, k in enumerate(rng.permutation(n).tolist())]


def test_near_duplicates_of_a_drifting_group(spark, monkeypatch):
    # All in one bucket: no other bucket can make up for a pair that is not compared in it.
    monkeypatch.setattr(neardup, "BANDS", 1)
    monkeypatch.setattr(neardup, "ROWS", 0)
    rows = drifted(1100, np.random.default_rng(11))
    found = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), words=2)
    assert Counter(tuple(r)[:3] for r in found.collect()) == near_groups(rows, 2)


def test_near_deduplicate(odd_docs, odd_rows):
    for n in (2, 5):
        kept = neardup.deduplicate(odd_docs, words=n)
        assert kept.columns == odd_docs.columns
        # Rows without words are no copies of each other, rows that agree in id and text are.
        expected = Counter(near_kept(list(dict.fromkeys((i, t) for i, t, _ in odd_rows)), n))
        assert Counter((r.doc_id, r.text or "") for r in kept.collect()) == expected


def test_near_deduplicate_tells_documents_with_one_id_apart(spark):
    base = " ".join(f"w{k}" for k in range(60))
    rows = [(1, base), (1, base + " x"), (1, "some other text of the same id"), (None, "without an id"), (None, "without an id"), (None, "nor has this"), (2, base)]
    kept = neardup.deduplicate(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert Counter(map(tuple, kept)) == Counter(near_kept(rows, 5)) and len(kept) == 4


def test_components(spark):
    edges = [(k, k + 1) for k in range(40) if k % 10] + [(100, 7), (100, 100), (7, 100), (50, 60)] + [(200, 201 + k) for k in range(30)]
    found = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert found[100] == 1 and found[10] == 1 and found[20] == 11 and found[60] == 50 and found[230] == 200
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# Mixing


def test_apportion(spark):
    rows = [("x", k, float(v), s) for s, votes in ((17, [5, 3, 9, 0, 1]),) for k, v in enumerate(votes)]
    rows += [("y", k, float(v), 100) for k, v in enumerate([1, 1, 1, 50, 0.5])]
    found = {(r.g, r.k): r.quota for r in mixing.apportion(spark.createDataFrame(rows, "g string, k long, v double, s long"), "g", "k", "v", "s").collect()}
    for g in ("x", "y"):
        mine = [(k, v, s) for h, k, v, s in rows if h == g]
        quotients = sorted(((-v / (2 * j + 1), k, j) for k, v, s in mine for j in range(s) if v), key=lambda q: q)[: mine[0][2]]
        seats = Counter(k for _, k, _ in quotients)
        assert {k: found[(g, k)] for k, _, _ in mine} == {k: seats[k] for k, _, _ in mine}


def test_targets(spark):
    sizes = [(10, 1), (1000, 1), (50, 6), (2000, 2), (0, 3)]
    found = [r.target for r in mixing.targets(spark.createDataFrame(sizes, "source_size long, weight long")).orderBy("weight", "source_size").collect()]
    assert sum(found) == pytest.approx(3060)
    limits = [3 * s for s, _ in sorted(sizes, key=lambda x: (x[1], x[0]))]
    assert all(t <= m + 1e-9 for t, m in zip(found, limits, strict=True)) and found[0] == 30


def test_mix_takes_near_targets_and_is_stable(spark):
    rng = np.random.default_rng(1)
    rows = [(i, " ".join(["w"] * int(rng.integers(0, 300))), f"s{i % 5}") for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    one = {tuple(r) for r in mixing.mix(docs.repartition(3), shard_words=10_000).select("id", "size", "target", "taken", "source").collect()}
    two = {tuple(r) for r in mixing.mix(docs.repartition(7), shard_words=10_000).select("id", "size", "target", "taken", "source").collect()}
    assert one == two and all(taken <= 3 * size for _, size, _, taken, _ in one)
    taken, wanted = Counter(), {}
    for _, _, target, t, source in one:
        taken[source] += t
        wanted[source] = target
    assert all(abs(taken[s] - wanted[s]) < 0.02 * wanted[s] for s in wanted)
    text = Counter(len(words(r.text)) for r in mixing.mixed(docs, shard_words=10_000).collect())
    assert sum(k * v for k, v in text.items()) == sum(taken.values())


def test_small_sources_come_near_their_targets(spark):
    """100 sources of 30 words each, targets of 15 to 45; and a single tiny one beside a large one."""
    rows = [(i * 3 + k, "w " * 10, f"s{i:03}") for i in range(100) for k in range(3)]
    tiny = [(i, "w " * 500, "a") for i in range(50)] + [(100, "w " * 40, "b")]
    for some in (rows, tiny):
        docs = spark.createDataFrame(some, "doc_id long, text string, source string")
        found = mixing.mix(docs).groupBy("source", "target").agg(F.sum("taken").alias("taken")).collect()
        assert all(abs(r.taken - r.target) <= 0.1 * r.target for r in found)
        assert abs(sum(r.taken for r in found) - sum(r.target for r in found)) <= 64


def test_rows_without_an_id_are_dealt_to_shards(spark):
    docs = spark.range(4000).selectExpr("cast(null as long) doc_id", "concat('word ', id, ' and more') text", "'s' source")
    shards = mixing.mix(docs, shard_words=1000, keep=["shard"]).groupBy("shard").count().collect()
    assert len(shards) == 16 and max(r["count"] for r in shards) < 2 * 4000 / 16


def test_mixed_rows_are_those_of_their_source(spark):
    """Rows of several sources that repeat an id or have none: each source keeps to its own words."""
    rows = [(k % 7 or None, f"{s} " * 12, s, "z") for s in "abcd" for k in range(60)] + [(9, "e " * 5, "e", "z")] * 40
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, __order string").repartition(4)
    taken, text = Counter(), Counter()
    for r in mixing.mix(docs).collect():
        taken[r.source] += r.taken
    found = mixing.mixed(docs).collect()
    for r in found:
        text[r.source] += len(words(r.text))
        assert set(words(r.text)) == {r.source}
    assert text == taken
    size = Counter(r[2] for r in rows for _ in words(r[1]))
    assert all(abs(taken[s] - t) <= 0.1 * t + 5 for s, t in targets(size).items())


def test_mix_on_odd_rows(odd_docs, odd_rows):
    found = mixing.mix(odd_docs).collect()
    assert Counter((r.id, r["size"]) for r in found) == Counter((i, len(words(t))) for i, t, _ in odd_rows)
    assert all(r.taken == 0 for r in found if r["size"] == 0)
    out = mixing.mixed(odd_docs)
    assert out.columns == odd_docs.columns
    assert sum(len(words(r.text)) for r in out.collect()) == sum(r.taken for r in found)


# Packing


def test_tokens_are_those_of_the_tokenizer():
    texts = ["", "  ", "a\tb\x1cc", "don't stop. It's", "\u0130. x \u0130, \u03a3\u03b1\u03c2.", "x" * 5000 + " y", "<|endoftext|> a.", "a..,b ,. .\n\n.x,\ny"]
    expected = [np.asarray(packing.tokenizer(TOKENIZER).encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert packing.WordIds(TOKENIZER).of(texts) == expected


def test_word_ids_of_any_letter_and_after_a_change_of_generation(monkeypatch):
    monkeypatch.setattr(packing, "CACHE_WORDS", 50)
    word_ids, encode = packing.WordIds(TOKENIZER), packing.tokenizer(TOKENIZER).encode
    letters = [chr(c) for c in range(1, 0x3000)]
    texts = [f"x{c}, {c}.y\nX{c} A{c.upper()}" for c in letters] + ["<|ENDOFTEXT|> <|endoftext|>, The the THE"]
    for at in range(0, len(texts), 100):
        some = texts[at : at + 100]
        expected = [np.asarray(encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in some]
        assert word_ids.of(some) == expected == word_ids.of(some)
    assert word_ids.earlier


def test_place_fills_sequences():
    rng = np.random.default_rng(2)
    for histogram in ({100: 1000}, {1: 5}, {2048: 3, 2047: 2, 1: 2}, Counter(rng.integers(1, 2049, 3000).tolist())):
        ranges, n = packing.place(dict(histogram))
        used = defaultdict(list)
        for r in ranges.itertuples():
            for k in range(r.n):
                used[r.sequence + k // r.each].append((r.offset + k % r.each * r.length, r.length))
        assert sorted(used) == list(range(n)) and sum(map(len, used.values())) == sum(histogram.values())
        for pieces in used.values():
            at = 0
            for offset, length in sorted(pieces):
                assert offset == at
                at += length
            assert at <= 2048


def test_packed_pieces(odd_docs, odd_rows):
    placed = packing.packed(odd_docs, TOKENIZER, keep_ids=True)
    found = placed.collect()
    wanted = Counter()
    for i, t, _ in odd_rows:
        ids = np.asarray(packing.tokenizer(TOKENIZER).encode(t or "", add_special_tokens=False).ids + [1], "<u4").tobytes()
        for at in range(0, len(ids), 4 * 2048):
            part = ids[at : at + 4 * 2048]
            wanted[(i, at // 4, len(part) // 4, zlib.crc32(part), len(ids) // 4)] += 1
    assert Counter((r.id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in found) == wanted
    whole = packing.sequences(placed).collect()
    assert sum(r.n_tokens for r in whole) == sum(r.length for r in found)
    assert all(len(r.ids) == 2048 or not len(r.ids) & (len(r.ids) - 1) for r in whole)


# Fingerprints


def test_fingerprints(odd_docs, odd_rows):
    parts = lambda t: {p.rstrip(" ") for p in re.findall(r"(?:[^\x20\x09-\x0D]+[\x20\x09\x0B-\x0D]*){1,24}", t)}
    alike = lambda a, b: len(a & b) / len(a | b) if a | b else 1.0
    order = sorted({(i, t or "") for i, t, _ in odd_rows}, key=lambda r: (r[0] is None, -(r[0] or 0), key(*r)[2]))
    expected = {}
    for k, (i, t) in enumerate(order):
        after, third = order[(k + 1) % len(order)][1], len(t) // 3
        edited = t[: len(t) - third] + after[:third]
        expected[(i, t)] = (len(t), hashlib.sha256(edited.encode()).hexdigest(), alike(parts(t), parts(edited)), alike(parts(t), parts(after)))
    found = fingerprint.fingerprints(odd_docs).collect()
    wanted = Counter((i, n, s, round(a, 9), round(b, 9)) for i, t, _ in odd_rows for n, s, a, b in [expected[(i, t or "")]])
    assert Counter((r.id, r.n_chars, r.edited_sha256, round(r.near_edited, 9), round(r.near_next, 9)) for r in found) == wanted
    assert len({r.fingerprint for r in found if r.id in (5, 6)}) == 1


def test_fingerprint_query_tells_parts_of_a_short_line(spark, tmp_path):
    rows = [(i, " ".join(f"{i}{k:03}" for k in range(36))) for i in (1, 2)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.op5_fingerprint(spark, str(tmp_path)).collect()
    assert [(round(r.near_edited, 9), r.near_next) for r in found] == [(round(1 / 3, 9), 0.0)] * 2


# Toxicity


def test_toxicity_finds_the_sentence(spark):
    rng = np.random.default_rng(4)
    line = lambda: " ".join(f"w{k}" for k in rng.integers(0, 300, 8)) + "."
    rows, marks = [], []
    for i in range(600):
        text = [line() for _ in range(rng.integers(1, 9))]
        if i % 5 == 0:
            text[rng.integers(0, len(text))] = f"w1 vile{rng.integers(0, 3)} w2."
        rows.append((i, " ".join(text)))
        marks.append((i, int(i % 5 == 0)))
    docs, labels = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(marks, "doc_id long, toxic int")
    weights = toxicity.learn(docs.filter("doc_id < 400"), labels)
    found = {r.id: r for r in toxicity.score(docs, weights).collect()}
    tested = [i for i in range(400, 600)]
    assert sum((found[i].score >= 0.7) == (i % 5 == 0) for i in tested) >= 198
    assert all(abs(found[i].score - noisy_or(weights, rows[i][1])) < 1e-9 for i in range(600))
    hit = found[405]
    assert ["vile" in rows[405][1][o.first : o.upto] for o in hit.offending] == [True]


def test_toxicity_on_odd_rows(spark, odd_docs, odd_rows):
    labels = spark.createDataFrame([(4, 1), (4, 1), (5, 0), (6, 0), (8, None), (11, 1), (11, 0), (None, 1)], "doc_id long, toxic int")
    found = toxicity.score(odd_docs, toxicity.learn(odd_docs, labels))
    weights = toxicity.learn(odd_docs, labels)
    assert Counter((r.id, round(r.score, 9)) for r in found.collect()) == Counter((i, round(noisy_or(weights, t), 9)) for i, t, _ in odd_rows)
    assert found.count() == len(odd_rows) and found.filter("score < 0 or score > 1 or score is null").count() == 0
    assert toxicity.clean(odd_docs, labels.filter("toxic = 9")).count() == len(odd_rows)


# Empty tables


@pytest.mark.parametrize(
    "operator",
    [
        exact.duplicates,
        exact.deduplicate,
        repeats.remove_repeats,
        neardup.near_duplicates,
        neardup.deduplicate,
        mixing.mix,
        mixing.mixed,
        fingerprint.fingerprints,
        lambda d: packing.packed(d, TOKENIZER),
        lambda d: toxicity.score(d, toxicity.learn(d, d.selectExpr("doc_id", "1 as toxic"))),
    ],
)
def test_empty_tables(no_docs, operator):
    assert operator(no_docs).count() == 0


def test_peeled_cells_ask_for_their_own_row_only(spark):
    """Of a digest's three places a cell compares the one in its row; all differences come back."""
    left, right = [*range(40)], [*range(6, 46)]
    df = spark.createDataFrame([(left, right)], "l array<long>, r array<long>")
    seed, width = fingerprint.F.lit(1).cast("long"), 24
    cells = [fingerprint._cells(fingerprint._placed(fingerprint.F.col(c), width, seed), width) for c in "lr"]
    peeled = fingerprint._peel(fingerprint._subtract(*cells), width, seed)
    found = df.select(peeled.alias("p")).first().p
    assert found.rest == 0
    assert {(d.k, d.n) for d in found.found} == {(k, 1) for k in range(6)} | {(k, -1) for k in range(40, 46)}
    plan = df.select(peeled)._jdf.queryExecution().analyzed().toString()
    assert not re.search(r"\.[ab] = [^()]*\) OR ", plan)
