"""The pipeline's stages, and the registered queries of the corpus operators."""

import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as spark_entry
import corpus_pipeline
from tagweave.llm import exact, neardup, packing, queries, toxicity
from tests.llm import plain

SF_DIR = "/root/testdata/sf0.001"


def test_every_operator_is_registered():
    numbers = [int(m[1]) for m in map(re.compile(r"op(\d+)_").match, spark_entry.queries()) if m]
    assert sorted(numbers) == list(range(1, 14)) and "pipeline" in spark_entry.queries()


@pytest.fixture(scope="module")
def fixture(spark, odd_docs, odd_rows, tmp_path_factory):
    """Odd rows, a group of 150 variants of one text, copies, and marked documents; and a folder without rows."""
    rng = np.random.default_rng(12)
    line = lambda: " ".join(f"w{k}" for k in rng.integers(0, 300, 8)) + "."
    rows, marks = list(odd_rows), []
    texts = [[f"v{k}" for k in range(110)]]
    while len(texts) < 150:
        text = list(texts[rng.integers(0, len(texts))])
        for at in rng.integers(0, 110, rng.integers(1, 3)):
            text[at] = f"u{rng.integers(0, 4000)}"
        texts.append(text)
    rows += [(1000 + i, " ".join(texts[k]), "abc"[i % 3]) for i, k in enumerate(rng.permutation(150).tolist())]
    for i in range(2000, 2400):
        text = [line() for _ in range(rng.integers(2, 9))]
        if i % 5 == 0:
            text[rng.integers(0, len(text))] = f"w1 vile{rng.integers(0, 3)} w2."
        rows.append((i, " ".join(text), "bcd"[i % 3]))
        marks.append((i, int(i % 5 == 0)))
    rows += [(i + 3000, t, "a") for i, t, _ in rows[-30:]]
    found = {}
    for name, some, labels in (("some", rows, marks), ("none", [], [])):
        folder = str(tmp_path_factory.mktemp(name))
        clashing = odd_docs.columns[3:]
        docs = spark.createDataFrame([(*r, *["z"] * len(clashing)) for r in some], odd_docs.schema)
        docs.write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{folder}/labels.parquet")
        found[name] = folder
    return found


def check_stages(spark, sf_dir):
    """Each stage on its own input, against the rules in plain Python."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    weights = toxicity.learn(docs.filter(~toxicity.held_out(F.col("doc_id"))), labels)
    rows, columns = {"start": docs.collect()}, docs.columns
    for name, stage_of in corpus_pipeline.STAGES:
        docs = stage_of(spark, docs, sf_dir).cache()
        rows[name] = docs.collect()
        assert docs.columns == columns or name == "packing"
    texts = {name: Counter((r.doc_id, r.text or "") for r in some) for name, some in rows.items() if name != "packing"}
    assert Counter(rows["toxicity"]) == Counter(r for r in rows["start"] if plain.noisy_or(weights, r.text) < 0.7)
    assert texts["exact_dedup"] == Counter(plain.exact_kept((r.doc_id, r.text) for r in rows["toxicity"]))
    assert texts["near_dedup"] == Counter(plain.near_kept([(r.doc_id, r.text) for r in rows["exact_dedup"]], 5))
    assert set(rows["near_dedup"]) <= set(rows["exact_dedup"]) <= set(rows["toxicity"])

    sizes, taken, whole = Counter(), Counter(), {}
    for r in rows["near_dedup"]:
        sizes[r.source] += len(plain.words(r.text))
        whole.setdefault((r.doc_id, r.source), []).append(r.text or "")
    for r in rows["mixing"]:
        taken[r.source] += len(plain.words(r.text))
        assert any(t.startswith(r.text) for t in whole[r.doc_id, r.source])
    for source, target in plain.targets(sizes).items() if sizes else ():
        # A block is an eighth of the smallest target at most, 64 words if that is more.
        assert abs(taken[source] - target) <= max(0.1 * target, 64) and taken[source] <= 3 * sizes[source]

    pieces = Counter()
    encode = packing.tokenizer(public_tokenizers.path(corpus_pipeline.TOKENIZER)).encode
    ids_of = {t: np.asarray(encode(t, add_special_tokens=False).ids + [1], "<u4") for _, t in texts["mixing"]}
    for (i, t), n in texts["mixing"].items():
        ids = ids_of[t]
        for at in range(0, len(ids), 2048):
            pieces[i, at, len(ids[at : at + 2048]), zlib.crc32(ids[at : at + 2048].tobytes()), len(ids)] += n
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows["packing"]) == pieces
    return rows


def test_stages_follow_their_rules(spark):
    rows = check_stages(spark, SF_DIR)
    assert len(rows["toxicity"]) > 0.8 * len(rows["start"])
    run = corpus_pipeline.run(spark, SF_DIR).collect()
    assert Counter((r.doc_id, r.start, r.ids_crc32) for r in run) == Counter((r.doc_id, r.start, r.ids_crc32) for r in rows["packing"])


def test_stages_on_odd_rows_and_large_groups(spark, fixture):
    rows = check_stages(spark, fixture["some"])
    ids = {name: {r.doc_id for r in some} for name, some in rows.items()}
    marked = {i + k for i in range(2000, 2400) if i % 5 == 0 for k in (0, 3000)} & ids["start"]
    assert len(marked & ids["toxicity"]) <= 2 and len(ids["toxicity"] - marked) >= len(ids["start"] - marked) - 2
    # Two changed words of 110 leave a similarity above 0.8, so the variants are one group.
    assert len([i for i in ids["near_dedup"] if i and 1000 <= i < 1150]) == 1


def test_empty_tables_go_through(spark, fixture):
    assert corpus_pipeline.run(spark, fixture["none"]).count() == 0


@pytest.mark.parametrize("name", ["op1_mixing", "op2_exact_dedup", "op3_toxicity", "op4_suffix_dedup", "op6_packing", "op7_minhash"])
def test_queries_take_odd_rows(spark, fixture, name):
    """The registered queries return every row of the odd table, and nothing of the empty one."""
    found = queries.QUERIES[name](spark, fixture["some"]).collect()
    docs = spark.read.parquet(f"{fixture['some']}/documents.parquet")
    assert Counter(r.doc_id for r in found if name != "op6_packing" or r.start == 0) == Counter(r.doc_id for r in docs.collect())
    assert queries.QUERIES[name](spark, fixture["none"]).count() == 0


def test_exact_after_near_finds_nothing(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    near = neardup.deduplicate(docs).cache()
    assert exact.deduplicate(near).count() == near.count()


@pytest.mark.parametrize("name", ["op3_toxicity", "op8_html_text"])
def test_no_row_is_lost(spark, name):
    df = queries.QUERIES[name](spark, SF_DIR)
    table = "pages" if "page_id" in df.columns else "documents"
    assert df.count() == spark.read.parquet(f"{SF_DIR}/{table}.parquet").count()
