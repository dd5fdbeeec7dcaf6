"""SimHash near-duplicates against plain Python: all pairs, all links."""

import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash

from tagweave.llm import queries, simhash


def plain_fingerprint(text, width=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    n = min(width, len(words))
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + n]).encode(), seed=42) for i in range(len(words) - n + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(rows, budget=4):
    """``id, code, component_id`` of rows ``id, code`` by comparing all different codes."""
    codes = sorted({c for _, c in rows})
    root = {c: c for c in codes}

    def find(c):
        while root[c] != c:
            c = root[c]
        return c

    for i, a in enumerate(codes):
        for b in codes[:i]:
            if (a ^ b).bit_count() <= budget:
                root[find(a)] = find(b)
    least = {}
    for i, c in rows:
        known = least.get(find(c))
        least[find(c)] = i if known is None else known if i is None else min(i, known)
    return Counter((i, c, least[find(c)]) for i, c in rows)


def found(df):
    return Counter((r.id, r.code % (1 << 64), r.component_id) for r in df.collect())


def test_odd_rows(odd_docs, odd_rows):
    expected = plain_components([(i, plain_fingerprint(t)) for i, t, _ in odd_rows])
    assert found(simhash.near_duplicates(odd_docs)) == expected


def test_empty_table(no_docs):
    empty = simhash.near_duplicates(no_docs)
    assert empty.columns == ["id", "code", "component_id"] and empty.count() == 0


def test_texts_without_words_are_one_group(spark):
    rows = [(5, None), (3, ""), (9, " \n"), (1, "some other words stand here")]
    result = simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.id: (r.code, r.component_id) for r in result.collect() if r.id > 1} == {5: (0, 3), 3: (0, 3), 9: (0, 3)}


def test_pieces_of_long_texts(monkeypatch):
    random.seed(3)
    text = " ".join(random.choice(["one", "two", "Three", "VIER"]) for _ in range(3000))
    monkeypatch.setattr(simhash, "PIECE", 7)
    assert simhash.fingerprint(text.encode()) == plain_fingerprint(text)


def drifting(n, seed):
    """Codes in chains of one to three changed bits, and others far from all."""
    random.seed(seed)
    codes = [random.getrandbits(64) for _ in range(n // 4)]
    while len(codes) < n:
        code = random.choice(codes[-40:])
        for b in random.sample(range(64), random.randint(1, 6)):
            code ^= 1 << b
        codes.append(code)
    return codes


@pytest.mark.parametrize("leaf", [1, 7, 4096])
def test_links_connect_what_all_pairs_connect(spark, leaf):
    codes = drifting(300, leaf)
    signed = np.array(codes, np.uint64).view(np.int64).tolist()
    edges = simhash.links(spark.createDataFrame([(c,) for c in sorted(set(signed))], "code long"), leaf)
    root = {c: c for c in codes}

    def find(c):
        while root[c] != c:
            c = root[c]
        return c

    for a, b in edges.collect():
        root[find(a % (1 << 64))] = find(b % (1 << 64))
    expected = plain_components(list(enumerate(codes)))
    names = {}
    for i, c in enumerate(codes):
        names.setdefault(find(c), i)
    assert Counter((i, c, names[find(c)]) for i, c in enumerate(codes)) == expected


def test_a_shared_beginning_is_split_into_leaves(spark):
    """A hot node: codes that agree in their first 24 bits, more than a leaf holds."""
    random.seed(11)
    codes = {(0xABCDEF << 40) | random.getrandbits(40) for _ in range(2000)}
    signed = np.array(sorted(codes), np.uint64).view(np.int64).tolist()
    leaves, pairs = simhash.leaves_and_pairs(spark.createDataFrame([(c,) for c in signed], "code long"), 64)
    sizes = [len(r.codes) for r in leaves.filter("turn = 0").collect()]
    assert max(sizes) <= 64 and sum(sizes) == len(codes)
    # 256 leaves by 8 more bits, of which two may differ: 18 others each, not 128.
    assert len(sizes) == 256 and pairs.filter("turn = 0").count() == 256 * (8 + 28) // 2


@pytest.mark.parametrize("turn", range(5))
def test_meet_finds_every_pair_within_the_allowance(turn):
    codes = np.sort(np.array(drifting(400, turn + 20), np.uint64))
    i, j = simhash.meet(turn, codes, None)
    pairs = set(zip(i.tolist(), j.tolist(), strict=True))
    for a in range(len(codes)):
        for b in range(a + 1, len(codes)):
            apart = int(codes[a]) ^ int(codes[b])
            fits = all((apart >> (64 - d)).bit_count() <= simhash.allowed(turn, d) for d in range(1, 65))
            assert ((a, b) in pairs) >= fits
            assert apart.bit_count() <= 4 or (a, b) not in pairs


def test_meet_with_no_range_left():
    """Ranges too large to be compared outright, all given up on the way down."""
    low = np.arange(9, dtype=np.uint64)
    i, j = simhash.meet(0, low, low + np.uint64(1 << 63))
    assert len(i) == len(j) == 0


def test_pairs_of_leaves_without_links(spark):
    """Leaves one bit apart, so they are a pair, whose codes differ in all of the next ten bits."""
    random.seed(7)
    codes = [(0xABC0 << 48) | random.getrandbits(38) for _ in range(12)] + [(0xABC1 << 48) | (1023 << 38) | random.getrandbits(38) for _ in range(12)]
    codes.append(codes[0] ^ 5)
    signed = np.array(sorted(codes), np.uint64).view(np.int64).tolist()
    frame = spark.createDataFrame([(c,) for c in signed], "code long")
    assert simhash.leaves_and_pairs(frame, 16)[1].filter("turn = 0").count() == 1
    edges = {frozenset((a % (1 << 64), b % (1 << 64))) for a, b in simhash.links(frame, 16).collect()}
    assert edges == {frozenset((codes[0], codes[-1]))}


def test_every_close_pair_fits_one_of_the_turns():
    random.seed(1)
    for _ in range(3000):
        apart = sum(1 << b for b in random.sample(range(64), 4))
        turned = [((apart << s) | (apart >> (64 - s))) % (1 << 64) for s in simhash.STARTS]
        assert any(all((x >> (64 - d)).bit_count() <= simhash.allowed(r, d) for d in range(1, 65)) for r, x in enumerate(turned))


def test_query(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    expected = plain_components([(r.doc_id, plain_fingerprint(r.text)) for r in rows])
    result = queries.op13_simhash(spark, sf_dir).collect()
    assert Counter((r.doc_id, int(r.fingerprint, 16), r.component_id) for r in result) == expected
    assert all(re.fullmatch("[0-9a-f]{16}", r.fingerprint) for r in result)
