"""Ranked search against a scan of everything in plain Python."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tagweave.llm import lexical

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def plain_terms(text):
    return re.findall(TERM, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(docs, queries, k=10):
    """Rows ``id, text`` and ``id, text``: ``query, rank, doc, score``, ties by id, none last."""
    counted = [(i, Counter(plain_terms(t))) for i, t in docs]
    n = [c.total() for _, c in counted]
    docs_n, length = sum(x > 0 for x in n), sum(n)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for q, text in queries:
        scored = []
        for (i, c), size in zip(counted, n, strict=True):
            score = 0
            for t, times in Counter(plain_terms(text)).items():
                if c[t]:
                    weight = math.floor(1000 * math.log((2 * docs_n + 2) / (2 * df[t] + 1)))
                    score += times * weight * ((10**9 * c[t]) // (1000 * c[t] + 8 * (25 + (75 * size * docs_n) // length)))
            if score > 0:
                scored.append((-score, i is None, i or 0))
        out += [(q, rank, None if none else i, -s) for rank, (s, none, i) in enumerate(sorted(scored)[:k], 1)]
    return Counter(out)


def test_terms():
    for text in ("", "a-B_c", "\x00Ünï9\x7fx y中　文", "ABCxyz 0:9;[z]`{a}", "tab\tand\x1cmore"):
        assert [t.decode() for t in lexical.terms(text.encode())] == plain_terms(text)


def corpus(n, seed=0):
    """Texts of a skewed vocabulary, near copies among them, and one text that makes up a third."""
    rng = random.Random(seed)
    vocabulary = [f"w{int(rng.paretovariate(0.6))}" for _ in range(400)]
    texts = [" ".join(rng.choices(vocabulary, k=rng.randint(1, 60))) for _ in range(n)]
    for k in range(0, n, 5):
        texts[k] = texts[k - 1] + " " + rng.choice(vocabulary)
    for k in range(0, n, 3):
        texts[k] = texts[0]
    queries = [(q, " ".join(rng.choices(vocabulary, k=rng.randint(1, 12)))) for q in range(25)]
    return list(enumerate(texts)), queries + [(25, None), (26, "..."), (27, "nowhere"), (None, texts[0]), (3, texts[1] + " " + texts[1])]


def frames(spark, docs, queries):
    names = "id no q query rank score term salt n body batch before place item".split()
    extra = ", ".join(f"{c} string" for c in names)
    wide = lambda rows: [(*r, *["z"] * len(names)) for r in rows]
    return (
        spark.createDataFrame(wide(docs), f"doc_id long, text string, {extra}").repartition(3),
        spark.createDataFrame(wide(queries), f"item_id long, text string, {extra}"),
    )


def found(df):
    return Counter(tuple(r) for r in df.select("query_id", "rank", "id", "score").collect())


@pytest.mark.parametrize("limits", [{}, {"SEEDS": 1, "LIST": 16, "BLOCK": 4, "PACK": 32, "SOME": 5}, {"BATCH_TERMS": 40, "CELLS": 8}, {"LONG_QUERY": 8}])
def test_against_plain(spark, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(lexical, name, value)
    docs, queries = corpus(240)
    assert found(lexical.search(*frames(spark, docs, queries))) == plain(docs, queries)


def test_odd_rows(spark, odd_docs, odd_rows):
    queries = [(1, odd_rows[4][1]), (2, odd_rows[7][1]), (3, "one ß 中文 x"), (4, ""), (1, odd_rows[4][1])]
    asked = spark.createDataFrame(queries, "item_id long, text string")
    assert found(lexical.search(odd_docs, asked)) == plain([r[:2] for r in odd_rows], queries)


def test_empty_tables(spark, no_docs, odd_docs):
    asked = spark.createDataFrame([(1, "one")], "item_id long, text string")
    for docs, queries in ((no_docs, asked), (odd_docs, asked.filter("item_id > 1")), (no_docs, asked.filter("item_id > 1"))):
        nothing = lexical.search(docs, queries)
        assert nothing.columns == ["query_id", "rank", "id", "score"] and nothing.count() == 0


def test_blocks_are_skipped_and_bounds_hold(spark, monkeypatch):
    """A block's summary scores at least as high as each of its members, and many blocks are not opened."""
    docs, queries = corpus(600, seed=8)
    seen = {}
    own = lexical._search

    def watched(lists, k):
        seen["lists"] = lists
        return own(lists, k)

    monkeypatch.setattr(lexical, "_search", watched)
    monkeypatch.setattr(lexical, "BLOCK", 8)
    staged = {}
    stage = lexical.stage
    monkeypatch.setattr(lexical, "stage", lambda df, label: staged.setdefault(label, stage(df, label)))
    result = lexical.search(*frames(spark, docs, queries))
    lists, blocks = seen["lists"], staged["blocks"].collect()
    opened = 0
    for b in blocks:
        weights = lists.weights[lists.kind[b.term]]
        entries, sizes = np.frombuffer(b.entries, lists.entry), np.frombuffer(b.sizes, "<i4")
        summary = lexical._dense(np.frombuffer(b.summary, lists.entry), np.array([len(b.summary) // lists.entry.itemsize]), weights.shape[1])
        members = lexical._dense(entries, sizes, weights.shape[1])
        assert (members <= summary).all() and (members.max(axis=0) == summary[0]).all()
        opened += ((weights @ summary[0]) >= lists.thresholds[lists.queries[lists.kind[b.term]]]).any()
    assert 0 < opened < len(blocks)
    assert found(result) == plain(docs, queries)


def test_blocks_follow_similarity():
    rng = np.random.default_rng(2)
    kinds = rng.integers(0, 4, 200)
    rows = np.zeros((200, 40), np.int64)
    for i, kind in enumerate(kinds):
        rows[i, kind * 10 + rng.integers(0, 10, 6)] = rng.integers(1, 1000)
    block = lexical.cut_by_angle(rows, np.ones(40, np.int64), block=10)
    mixed = sum(len(set(kinds[block == b])) > 1 for b in np.unique(block))
    assert mixed <= 1
