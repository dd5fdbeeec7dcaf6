"""From raw documents to packed training sequences, in five stages.

1. toxicity: documents with a score of 0.7 or more go; labels are learnt from the
   rows that are not held out.
2. exact dedup: of documents with equal texts the one with the largest id stays.
3. near-dedup: of documents linked at similarity 0.8 over shingles of five words,
   directly or through others, the one with the smallest id stays.
4. mixing: sources at their target weights; a document is there as often as it is
   taken, and at most one at the end of each shard is cut.
5. packing: sequences of 2048 ids, one row for each piece of a document.

Each stage takes all rows its predecessor kept and reads nothing from the first
table again. All but the last return the columns of ``documents``.

Defined cases: a null text counts as an empty one; it has the score of one sentence
without features, is a copy of other empty texts, near to none and never mixed. A
null id comes last, so among copies a row with an id stays. Ties go by id, then by
the MD5 of the text; rows that share an id with other texts are documents of their
own. Texts are read whole, however long. Without labels of both kinds no document
is rejected. Empty tables give an empty result. Other columns go through unread,
whatever they are called.

A fitted model and hash minima decide here, which SQL cannot state, so there is
no ``ORACLE_SQL``; ``tests/llm/test_pipeline.py`` has the same rules in plain Python.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tagweave.llm import exact, mixing, neardup, packing, toxicity
from tagweave.storage import stage

TOKENIZER = "word_bpe_49k.json"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.clean(docs, labels)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact.deduplicate(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.deduplicate(docs, words=5, threshold=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.packed(docs, public_tokenizers.path(TOKENIZER)).withColumnRenamed("id", "doc_id")


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage_of in STAGES[:-1]:
        docs = stage(stage_of(spark, docs, sf_dir), name, "zstd")
    return STAGES[-1][1](spark, docs, sf_dir)
