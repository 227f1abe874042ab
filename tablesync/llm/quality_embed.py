"""Quality classifier: supervised subword embeddings.

A word's features are hashed: itself, its character n-grams, and, if it repeats the word
before it, one more token, `<again>`, counted `AGAIN` times (a vector of its own is learned for it;
an average of words can't tell repetition otherwise). Each hash has a learned vector; a document is the mean of the
vectors of all its words' features, and a softmax over it gives the probability of each label.
Vectors and output are trained by stochastic gradient descent in numpy on the driver, over at
most `sample` labelled documents (those with the least hashes of their ids), whose features,
not texts, are collected.

The output is linear in the mean, so scoring needs one number per feature: it is broadcast
(`1 << BUCKET_BITS` floats) and every task scores its own texts, whole, without a shuffle.

Null and empty texts have no features and get the score of the bias alone. Repeated rows are
scored each; labels of an id that is labelled twice both count; null ids and labels are not
learned from. Without labels every score is 0.5. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tablesync.llm.common import distinct_words, known_values, sampled_texts, slices, split_words

BUCKET_BITS = 18
DIMENSIONS = 10
NGRAMS = (3, 4, 5)
EPOCHS = 8
RATE = 0.5
#: Labelled documents to learn from, at most.
SAMPLE = 4000
#: Score from which label 1 is predicted.
THRESHOLD = 0.7

#: How often a repeated word counts the token that stands for repetition.
AGAIN = 8

_MASK = (1 << BUCKET_BITS) - 1
_AGAIN = crc32(b"<again>") & _MASK


def features(word: str) -> np.ndarray:
    """The buckets of a word and of its character n-grams."""
    framed = f"<{word}>"
    found = [crc32(word.encode())]
    if word.isascii():  # characters are bytes
        coded = framed.encode()
        for n in NGRAMS:
            found += [crc32(coded[i : i + n]) for i in range(len(coded) - n + 1)]
    else:
        for n in NGRAMS:
            found += [crc32(framed[i : i + n].encode()) for i in range(len(framed) - n + 1)]
    return np.array(found, np.int64) & _MASK


def _again(at: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Where a word is the one before it in its text."""
    same = np.zeros(len(at), bool)
    same[1:] = at[1:] == at[:-1]
    same[bounds[:-1][bounds[:-1] < len(at)]] = False
    return same


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, label, buckets, counts) of labelled texts."""
    known: dict[str, np.ndarray] = {}
    for batch in batches:
        for part in slices(batch):
            words, bounds = split_words(part.column("text"))
            distinct, at = distinct_words(words)
            found = known_values(distinct, known, features)
            again = _again(at, bounds)
            buckets, counts = [], []
            for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                of_words = [found[i] for i in at[a:b].tolist()]
                repeated = np.full(int(again[a:b].sum()) * AGAIN, _AGAIN)
                one, n = np.unique(np.concatenate([*of_words, repeated]).astype(np.int32), return_counts=True)
                buckets.append(one)
                counts.append(n.astype(np.int32))
            yield pa.record_batch(
                {
                    "doc_id": part.column("doc_id"),
                    "label": part.column("label"),
                    "buckets": pa.array(buckets, pa.list_(pa.int32())),
                    "counts": pa.array(counts, pa.list_(pa.int32())),
                }
            )


@dataclass(frozen=True)
class Model:
    """What each bucket adds to the log odds of label 1, times its share of the features; and the bias."""

    weights: np.ndarray
    bias: float


def _train(documents: list[tuple[np.ndarray, np.ndarray, int]]) -> Model:
    dice = np.random.default_rng(7)
    vectors = dice.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (1 << BUCKET_BITS, DIMENSIONS)).astype(np.float32)
    output, bias = np.zeros((DIMENSIONS, 2), np.float32), np.zeros(2, np.float32)
    steps, step = EPOCHS * len(documents), 0
    for _ in range(EPOCHS):
        for number in dice.permutation(len(documents)):
            buckets, share, label = documents[number]
            rate = RATE * (1 - step / steps)
            step += 1
            own = vectors[buckets]
            mean = share @ own
            scores = mean @ output + bias
            error = np.exp(scores - scores.max())
            error /= error.sum()
            error[label] -= 1
            back = output @ error
            output -= rate * np.outer(mean, error)
            bias -= 0.1 * rate * error
            # a vector's share of the mean is small, so its step is scaled up to the document's
            vectors[buckets] = own - rate * np.outer(share * (1 / np.sqrt((share**2).sum())), back)
    return Model((vectors @ (output[:, 1] - output[:, 0])).astype(np.float32), float(bias[1] - bias[0]))


def train(docs: DataFrame, labels: DataFrame, *, sample: int = SAMPLE) -> Model:
    """Learn from `labels` (doc_id, label 0 or 1) of `docs` (doc_id, text)."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = (
        sampled_texts(docs, labels, sample)
        .mapInArrow(_counted, f"doc_id {kind}, label int, buckets array<int>, counts array<int>")
        .toArrow()
        .sort_by([("doc_id", "ascending"), ("label", "ascending")])
    )
    documents = []
    for label, buckets, counts in zip(rows["label"].to_pylist(), rows["buckets"], rows["counts"]):
        buckets = buckets.values.to_numpy()
        counts = counts.values.to_numpy().astype(np.float32)
        if len(buckets):
            documents.append((buckets, counts / counts.sum(), label))
    return _train(documents)


def _scores(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias = model.value.weights.astype(np.float64), model.value.bias
        known: dict[str, tuple[float, int]] = {}

        def value(word: str) -> tuple[float, int]:
            buckets = features(word)
            return float(weights[buckets].sum()), len(buckets)

        for batch in batches:
            for part in slices(batch):
                words, bounds = split_words(part.column("text"))
                distinct, at = distinct_words(words)
                numbers = np.array(known_values(distinct, known, value), np.float64).reshape(-1, 2)
                again = _again(at, bounds) * float(AGAIN)
                total = np.concatenate(([0.0], np.cumsum(numbers[at, 0] + again * weights[_AGAIN])))
                n = np.concatenate(([0.0], np.cumsum(numbers[at, 1] + again)))
                mean = np.diff(total[bounds]) / np.maximum(np.diff(n[bounds]), 1)
                score = 1 / (1 + np.exp(-np.clip(mean + bias, -500, 500)))
                yield pa.record_batch({"doc_id": part.column("doc_id"), "score": pa.array(score)})

    return run


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of each row of `docs` (doc_id, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.select("doc_id", "text").mapInArrow(
        _scores(shared), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score double"
    )


def fold(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 4."""
    return F.crc32(F.col(doc_id).cast("string")) % 4
