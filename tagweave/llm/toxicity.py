"""Toxicity by multiple-instance learning: sentence scores, combined by noisy-or.

A document is toxic if one of its sentences is: with sentence probabilities p,
its score is 1 - prod(1 - p). A sentence's log-odds are a bias and the weights of
its words' features (the word itself, its first 3 to 6 and last 4 characters).
Only documents have labels; the weights are fitted by full-batch gradient steps
on the documents' likelihood, which pushes up those sentences of a toxic document
that already stand out. Applied again, the sentence scores locate the offending
sentences.

The fit sees a bounded sample: ``most_rows`` labelled documents (those with the
smallest hash of their id) of at most ``most_chars`` characters; from these,
``most_features`` features that tell the labels apart best. It runs in one task,
and what comes back is a table of that many weights. Scoring covers every whole
text. A text's language, source and id are never looked at.

Defined cases: a null text is an empty one; a text without words has the score of
one sentence with no feature. Repeated rows get equal scores. Labels that are
null count as missing, repeated label rows count once if they agree and not at
all if they do not. Without a labelled row of each kind there is nothing to learn
and every score is 0. An empty table gives an empty result. Other columns are not
read by ``score``.
"""

from __future__ import annotations

import json
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tagweave.llm.common import text_or_empty

MOST_ROWS, MOST_CHARS, MOST_FEATURES = 8_000, 20_000, 4_000
THRESHOLD = 0.7
#: Longest word looked up as a whole, and the words kept with their weight in each worker.
WORD_CHARS, CACHE_WORDS = 64, 500_000

_SENTENCE = re.compile(r"[^.!?\n]+")
_WORD = re.compile(r"\w+")


def features(word: str) -> list[str]:
    """Features of a lower-case word: itself, first and last characters."""
    found = [f"={word}"] if len(word) <= WORD_CHARS else []
    found += [f"^{word[:n]}" for n in (3, 4, 5, 6) if len(word) > n]
    if len(word) > 4:
        found.append(f"{word[-4:]}$")
    return found


def sentences(text: str) -> list[tuple[int, int]]:
    """Where the sentences of a text that have a word begin and end."""
    return [m.span() for m in _SENTENCE.finditer(text) if _WORD.search(m[0])]


def _softplus(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, z)


def fit(texts: list[str], labels: list[int], most_features: int = MOST_FEATURES, steps: int = 300, penalty: float = 5e-5, toxic_weight: float = 2.0) -> dict:
    """Weights by feature, and the bias under the empty name. Toxic documents, the rarer kind, count ``toxic_weight`` times."""
    y = np.asarray(labels, float)
    if not len(y) or y.min() == y.max():
        return {"": -math.inf}
    known: dict[str, list[str]] = {}
    seen = (Counter(), Counter())
    split = []
    for text, label in zip(texts, labels, strict=True):
        lines = [_WORD.findall(text[a:b].lower()) for a, b in sentences(text)]
        split.append(lines)
        mine = set()
        for word in {w for line in lines for w in line}:
            if word not in known:
                known[word] = features(word)
            mine.update(known[word])
        seen[label].update(mine)
    totals = [max(1, (y == k).sum()) for k in (0, 1)]
    gain = {}
    for name in seen[0].keys() | seen[1].keys():
        a, b = seen[1][name], seen[0][name]
        if a + b < 4:
            continue
        p, q = (a + 0.5) / (totals[1] + 1), (b + 0.5) / (totals[0] + 1)
        gain[name] = a * math.log(p / q) + (totals[1] - a) * math.log((1 - p) / (1 - q))
        gain[name] += b * math.log(q / p) + (totals[0] - b) * math.log((1 - q) / (1 - p))
    names = sorted(gain, key=lambda n: (-gain[n], n))[:most_features]
    number = {n: i for i, n in enumerate(names)}
    rows, columns, of_doc, plain = [], [], [], np.zeros(len(y))
    for doc, lines in enumerate(split):
        for line in lines or [[]]:
            found = [number[f] for w in line for f in known[w] if f in number]
            if found:
                rows += [len(of_doc)] * len(found)
                columns += found
                of_doc.append(doc)
            else:
                plain[doc] += 1
    rows, columns, of_doc = (np.asarray(x, np.int64) for x in (rows, columns, of_doc))
    weights, bias = np.zeros(len(names)), -6.0
    moments = np.zeros((2, len(names) + 1))
    for step in range(1, steps + 1):
        z = bias + np.bincount(rows, weights[columns], len(of_doc))
        mass = np.bincount(of_doc, _softplus(z), len(y)) + plain * _softplus(bias)
        toxic = -np.expm1(-mass)
        pull = (1 - y) - toxic_weight * y * np.exp(-mass) / np.maximum(toxic, 1e-9)
        slope = pull[of_doc] / (1 + np.exp(-np.clip(z, -50, 50)))
        grad = np.bincount(columns, slope[rows], len(names)) / len(y) + penalty * weights
        grad_bias = (slope.sum() + (pull * plain).sum() / (1 + math.exp(-bias))) / len(y)
        grad = np.append(grad, grad_bias)
        moments[0] = 0.9 * moments[0] + 0.1 * grad
        moments[1] = 0.99 * moments[1] + 0.01 * grad**2
        move = 0.1 * (moments[0] / (1 - 0.9**step)) / (np.sqrt(moments[1] / (1 - 0.99**step)) + 1e-8)
        weights, bias = weights - move[:-1], bias - move[-1]
    return {"": float(bias), **{n: float(w) for n, w in zip(names, weights, strict=True) if w}}


class Scorer:
    """Sentence and document scores; the weight of each different word is kept."""

    def __init__(self, weights: dict[str, float]):
        self.weights, self.bias, self.known = weights, weights[""], {}

    def word(self, word: str) -> float:
        found = self.known.get(word)
        if found is None:
            found = sum(self.weights.get(f, 0.0) for f in features(word))
            if len(self.known) >= CACHE_WORDS:
                self.known.clear()
            self.known[word] = found
        return found

    def mass(self, sentence: str) -> float:
        known, z = self.known, self.bias
        for word in _WORD.findall(sentence):
            found = known.get(word)
            z += self.word(word) if found is None else found
        return z if z > 30 else math.log1p(math.exp(z))

    def document(self, text: str) -> float:
        """1 - prod(1 - p) over the sentences."""
        total, any_word = 0.0, False
        for sentence in _SENTENCE.findall(text.lower()):
            if _WORD.search(sentence):
                any_word = True
                total += self.mass(sentence)
        if not any_word:
            total = math.log1p(math.exp(self.bias))
        return -math.expm1(-total)

    def offending(self, text: str, threshold: float) -> list[dict]:
        """Sentences whose own score reaches the threshold, with their place in the text."""
        found = []
        for a, b in sentences(text):
            p = -math.expm1(-self.mass(text[a:b].lower()))
            if p >= threshold:
                found.append({"first": a, "upto": b, "score": p})
        return found


def learn(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    most_rows: int = MOST_ROWS,
    most_chars: int = MOST_CHARS,
    most_features: int = MOST_FEATURES,
) -> dict[str, float]:
    """Weights from documents with a 0/1 label."""
    known = labels.filter(F.col(label_col).isin(0, 1)).groupBy(F.col(id_col).alias("id"))
    known = known.agg(F.min(label_col).alias("low"), F.max(label_col).alias("label")).filter("low = label")
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    rows = rows.filter(F.length("text") <= most_chars)
    # Ids are chosen first, so that only the chosen texts are moved.
    short = rows.select("id").distinct().join(known, "id").select("id", "label")
    chosen = short.orderBy(F.xxhash64(F.col("id").cast("string")), "id").limit(most_rows)
    sample = rows.join(F.broadcast(chosen), "id").groupBy("id", "text").agg(F.max("label").alias("label"))
    sample = sample.orderBy("id", "text").select("text", "label").coalesce(1)

    def train(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        texts, marks = [], []
        for batch in batches:
            texts += batch["text"].tolist()
            marks += batch["label"].astype(int).tolist()
        yield pd.DataFrame({"model": [json.dumps(fit(texts, marks, most_features))]})

    found = sample.mapInPandas(train, "model string").collect()
    return json.loads(found[0].model) if found else {"": -math.inf}


def score(docs: DataFrame, weights: dict[str, float], id_col: str = "doc_id", text_col: str = "text", sentence_at: float | None = THRESHOLD) -> DataFrame:
    """``id, score, offending``: sentences (``first, upto`` in characters, ``score``) at or above ``sentence_at``."""
    id_type = docs.schema[id_col].dataType.simpleString()
    kind = pa.list_(pa.struct([("first", pa.int64()), ("upto", pa.int64()), ("score", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Scorer(weights)
        for batch in batches:
            scores, places = [], []
            for text in batch.column("text"):
                body = text.as_py()
                scores.append(model.document(body))
                # No sentence scores above its document.
                near = sentence_at is not None and scores[-1] >= sentence_at
                places.append(model.offending(body, sentence_at) if near else [])
            columns = [batch.column("id"), pa.array(scores, "float64"), pa.array(places, kind)]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "score", "offending"])

    schema = f"id {id_type}, score double, offending array<struct<first:bigint,upto:bigint,score:double>>"
    return docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text")).mapInArrow(run, schema)


def held_out(ids):
    """Rows whose labels are never learnt from: crc32 of the id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(ids.cast("string")) % 3 == 1, F.lit(False))


def clean(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows with a score below the threshold, with all columns."""
    from_rows = docs.filter(~held_out(F.col(id_col)))
    weights = learn(from_rows, labels, id_col, text_col)
    id_type = docs.schema
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Scorer(weights)
        for batch in batches:
            texts = batch.column(names.index(text_col))
            keep = [model.document(t.as_py() or "") < threshold for t in texts]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, id_type)
