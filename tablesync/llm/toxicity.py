"""Toxicity: cumulative-link ordinal regression over sparse text features.

Severity is one of ordered grades 0 .. K. P(grade >= k) is the logistic function of s - t_k: the
score s = w . x is shared by all thresholds t_1 <= ... <= t_K, and x is log(1 + count) of each
hashed token (letters and digits of a word, without case). The expected severity is the sum of
P(grade >= k) over k; a text is toxic where P(grade >= 1) is at least a half.

Labels that only say toxic or not become grades by `graded`: 0 for clean texts, and 1 .. K for
toxic ones by how many of its tokens are ones that the labels tie to toxicity.

The model is fitted on the driver from the features, not texts, of at most `sample` labelled
documents (those with the least hashes of their ids), by gradient steps over the
tokens whose share differs between toxic and clean documents. It is broadcast (`1 << BUCKET_BITS` floats), and every task scores its own
texts, whole, without a shuffle.

Null and empty texts score as having no features. Repeated rows are scored each. Null ids and
labels are not learned from; without a toxic label nothing is toxic. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tablesync.llm.common import distinct_words, known_values, sampled_texts, slices, split_words, token_hash

BUCKET_BITS = 18
GRADES = 3
STEPS = 400
RATE = 0.1
#: Weight of the penalty on w ** 2.
DECAY = 0.00003
#: A token is a feature if the shares of toxic and of clean documents that have it differ by so many standard errors.
CERTAIN = 5.0
#: Labelled documents to learn from, at most.
SAMPLE = 8000

_SHIFT = 64 - BUCKET_BITS


def _bucket(word: str) -> int:
    """The bucket of a word's token, -1 if it has no letter or digit."""
    token = token_hash(word)
    return (token >> _SHIFT) if token else -1


def _counts(part: pa.RecordBatch, known: dict[str, int], wanted: np.ndarray | None) -> tuple[np.ndarray, ...]:
    """(row, bucket, count) of the wanted buckets."""
    words, bounds = split_words(part.column("text"))
    distinct, at = distinct_words(words)
    bucket = np.array(known_values(distinct, known, _bucket), np.int64)
    row = np.repeat(np.arange(part.num_rows), np.diff(bounds))
    use = bucket >= 0
    if wanted is not None:
        use &= wanted[bucket]
    keep = use[at]
    pairs, n = np.unique(row[keep] << BUCKET_BITS | bucket[at][keep], return_counts=True)
    return pairs >> BUCKET_BITS, pairs & ((1 << BUCKET_BITS) - 1), n


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: dict[str, int] = {}
    for batch in batches:
        for part in slices(batch):
            row, bucket, n = _counts(part, known, None)
            offsets = pa.array(np.searchsorted(row, np.arange(part.num_rows + 1)), pa.int32())
            yield pa.record_batch(
                {
                    "doc_id": part.column("doc_id"),
                    "label": part.column("label"),
                    "buckets": pa.ListArray.from_arrays(offsets, pa.array(bucket.astype(np.int32))),
                    "counts": pa.ListArray.from_arrays(offsets, pa.array(n.astype(np.int32))),
                }
            )


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    thresholds: np.ndarray


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def graded(toxic: np.ndarray, row: np.ndarray, bucket: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Grades 0 .. GRADES: toxic texts by how many of their tokens are ones that tell toxic texts."""
    bad, good = _documents(toxic == 1, row, bucket)
    strong = telling(toxic == 1, row, bucket) & (bad / max(toxic.sum(), 1) > 20 * good / max((1 - toxic).sum(), 1))
    found = np.bincount(row, weights=n * strong[bucket], minlength=len(toxic))
    some = found[(toxic == 1) & (found > 0)]
    cuts = np.quantile(some, np.arange(1, GRADES) / GRADES) if len(some) else np.zeros(GRADES - 1)
    return np.where(toxic == 1, 1 + np.searchsorted(cuts, found, side="left"), 0)


def _documents(toxic: np.ndarray, row: np.ndarray, bucket: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """In how many toxic and clean documents each bucket is."""
    size = 1 << BUCKET_BITS
    return np.bincount(bucket[toxic[row]], minlength=size), np.bincount(bucket[~toxic[row]], minlength=size)


def telling(toxic: np.ndarray, row: np.ndarray, bucket: np.ndarray) -> np.ndarray:
    """Of all buckets, those that toxic and clean documents have in shares that differ for certain."""
    n_toxic, n_clean = max(toxic.sum(), 1), max((~toxic).sum(), 1)
    bad, good = _documents(toxic, row, bucket)
    both = (bad + good + 1) / (n_toxic + n_clean + 2)
    error = np.sqrt(both * (1 - both) * (1 / n_toxic + 1 / n_clean))
    return np.abs(bad / n_toxic - good / n_clean) >= CERTAIN * error


def fitted(grade: np.ndarray, row: np.ndarray, bucket: np.ndarray, n: np.ndarray) -> Model:
    """Maximum likelihood with a penalty on large weights, by gradient steps over all rows."""
    toxic = grade > 0
    useful = telling(toxic, row, bucket)[bucket]
    row, bucket, n = row[useful], bucket[useful], n[useful]
    used, column = np.unique(bucket, return_inverse=True)
    x = np.log1p(n)
    rows, k = np.arange(len(grade)), np.arange(1, GRADES + 1)
    # w, then the first threshold and the logarithms of the gaps after it
    theta = np.concatenate((np.zeros(len(used)), [1.0], np.zeros(GRADES - 1)))
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, STEPS + 1):
        w, base, gaps = theta[: len(used)], theta[len(used)], np.exp(theta[len(used) + 1 :])
        thresholds = base + np.concatenate(([0.0], np.cumsum(gaps)))
        score = np.bincount(row, weights=w[column] * x, minlength=len(grade))
        p = _logistic(score[:, None] - thresholds)  # P(grade >= k)
        upper = np.concatenate((np.ones((len(grade), 1)), p), axis=1)[rows, grade]
        lower = np.concatenate((p, np.zeros((len(grade), 1))), axis=1)[rows, grade]
        # log(upper - lower) by the score, and by each threshold
        by_score = 1 - upper - lower
        each = p * (1 - p) / np.maximum(upper - lower, 1e-12)[:, None]
        by_threshold = (each * (grade[:, None] == k - 1) - each * (grade[:, None] == k)).sum(axis=0)
        after = np.cumsum(by_threshold[::-1])[::-1]
        slope = np.concatenate(
            (np.bincount(column, weights=by_score[row] * x, minlength=len(used)), after[:1], after[1:] * gaps)
        ) / len(grade)
        slope[: len(used)] -= DECAY * w
        first = 0.9 * first + 0.1 * slope
        second = 0.999 * second + 0.001 * slope**2
        theta = theta + RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    weights = np.zeros(1 << BUCKET_BITS, np.float32)
    weights[used] = theta[: len(used)]
    return Model(weights, thresholds)


def train(docs: DataFrame, labels: DataFrame, *, sample: int = SAMPLE) -> Model:
    """Learn from `labels` (doc_id, label 0 or 1) of `docs` (doc_id, text)."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = (
        sampled_texts(docs, labels, sample)
        .mapInArrow(_features, f"doc_id {kind}, label int, buckets array<int>, counts array<int>")
        .toArrow()
        .sort_by([("doc_id", "ascending"), ("label", "ascending")])
        .combine_chunks()
    )
    toxic = rows["label"].to_numpy().astype(np.int64)
    if not toxic.any():
        return Model(np.zeros(1 << BUCKET_BITS, np.float32), np.arange(1.0, GRADES + 1) * 10)
    lists = rows["buckets"].combine_chunks()
    row = np.repeat(np.arange(len(toxic)), np.diff(lists.offsets.to_numpy()))
    bucket = lists.flatten().to_numpy().astype(np.int64)
    n = rows["counts"].combine_chunks().flatten().to_numpy().astype(np.float64)
    grade = graded(toxic, row, bucket, n)
    return fitted(grade, row, bucket, n)


def _severities(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, thresholds = model.value.weights.astype(np.float64), model.value.thresholds
        wanted, known = weights != 0, {}
        for batch in batches:
            for part in slices(batch):
                row, bucket, n = _counts(part, known, wanted)
                score = np.bincount(row, weights=weights[bucket] * np.log1p(n), minlength=part.num_rows)
                p = _logistic(score[:, None] - thresholds)
                yield pa.record_batch(
                    {
                        "doc_id": part.column("doc_id"),
                        "expected_severity": pa.array(p.sum(axis=1)),
                        "p_toxic": pa.array(p[:, 0].copy()),
                        "grade": pa.array((p >= 0.5).sum(axis=1).astype(np.int32)),
                        "toxic": pa.array(p[:, 0] >= 0.5),
                    }
                )

    return run


def severities(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, expected_severity, p_toxic, grade and toxic of each row of `docs` (doc_id, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.select("doc_id", "text").mapInArrow(
        _severities(shared), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, expected_severity double, p_toxic double, grade int, toxic boolean"
    )
