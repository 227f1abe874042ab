"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import re
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Bytes of text that a task works on at once; a longer text is worked on alone.
SLICE_BYTES = 4 << 20

#: Words that a task remembers.
KNOWN_WORDS = 1_000_000

_NOISE = re.compile(r"[\W_]+")
_FIRST, _SECOND = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F  # odd, so that they have inverses mod 2**64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder of `spark.checkpoint.dir`; on one machine a folder of its own where that is unset."""
    context = spark.sparkContext
    if folder := spark.conf.get("spark.checkpoint.dir", None):
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(folder)
        return folder
    if not context.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(tempfile.mkdtemp(prefix="checkpoints-"))
    return context.getCheckpointDir()


def discard(spark: SparkSession, path: str) -> None:
    """Remove a folder of intermediate rows, in whatever store it is."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def settled(frame: DataFrame) -> DataFrame:
    """`frame`, written once to the shared folder, so that what follows doesn't compute it again."""
    shared_folder(frame.sparkSession)
    return frame.checkpoint()


def sampled_texts(docs: DataFrame, labels: DataFrame, sample: int) -> DataFrame:
    """(doc_id, label, text) of at most `sample` labels (doc_id, label 0 or 1): the least by a hash of the id.

    Of rows that share an id, the one whose text has the least hash counts, so that there are
    at most `sample` rows, however often a labelled id repeats; tasks pick theirs before they shuffle.
    """
    chosen = (
        labels.where("doc_id is not null and label in (0, 1)")
        .select("doc_id", F.col("label").cast("int").alias("label"))
        .distinct()
        .orderBy(F.xxhash64("doc_id"), "doc_id", "label")
        .limit(sample)
    )
    joined = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # `sample` rows are broadcast
    least = F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("least")
    return joined.groupBy("doc_id", "label").agg(least).select("doc_id", "label", "least.text")


def words_of(text: str) -> Column:
    """SQL array of the words `[^\\x20\\x09-\\x0D]+` of a column; null and blank texts have none."""
    return F.expr(f"filter(split(coalesce({text}, ''), '[ \\\\t-\\\\r]+'), w -> w != '')")


def slices(batch: pa.RecordBatch, column: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of a batch of at most so many bytes in `column`, or of one row."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words `[^\\x20\\x09-\\x0D]+` of all texts in one array, and where each text's begin and end."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    flat, offsets = lists.flatten(), lists.offsets.to_numpy() - lists.offsets[0].as_py()
    full = pc.greater(pc.binary_length(flat), 0)
    counted = np.concatenate(([0], np.cumsum(full.to_numpy(zero_copy_only=False), dtype=np.int64)))
    return flat.filter(full), counted[offsets]


def distinct_words(flat: pa.Array) -> tuple[list[str], np.ndarray]:
    """The distinct words of an array, and the number of the word at each place."""
    coded = flat.dictionary_encode()
    return coded.dictionary.to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy().astype(np.int64)


def hash_words(words: list[str]) -> np.ndarray:
    """Two independent 64-bit hashes of each word, as an array of shape (n, 2)."""
    digests = b"".join(map(xxhash.xxh3_128_digest, words))
    return np.frombuffer(digests, dtype="<u8").reshape(-1, 2).astype(np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit over all others (splitmix64's last step)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Rolling:
    """128-bit hashes of runs of words: equal word sequences have equal hashes, wherever they stand."""

    def __init__(self, hashes: np.ndarray):
        n = len(hashes)
        self.back, self.sums = [], []
        for lane, base in enumerate((_FIRST, _SECOND)):
            ahead = np.full(n + 1, base, np.uint64)
            ahead[0] = 1
            behind = np.full(n + 1, pow(base, -1, 1 << 64), np.uint64)
            behind[0] = 1
            np.multiply.accumulate(ahead, out=ahead)
            self.back.append(np.multiply.accumulate(behind))
            total = np.zeros(n + 1, np.uint64)
            np.cumsum(hashes[:, lane] * ahead[:n], out=total[1:])
            self.sums.append(total)

    def lane(self, lane: int, starts: np.ndarray, lengths: np.ndarray | int) -> np.ndarray:
        total = self.sums[lane]
        run = (total[starts + lengths] - total[starts]) * self.back[lane][starts]
        return mixed(run + np.asarray(lengths, np.uint64))


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each `width` neighbours, by doubling."""
    have = 1
    while have < width:
        step = min(have, width - have)
        values = np.minimum(values[:-step], values[step:])
        have += step
    return values


def signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def token_hash(word: str) -> int:
    """A hash of a word's letters and digits, without case; 0 if it has none."""
    token = _NOISE.sub("", word.casefold())
    return xxhash.xxh3_64_intdigest(token) | 1 if token else 0


def known_values(words: list[str], known: dict, value) -> list:
    """`value(word)` of each word, remembered in `known`, which starts anew when it is full."""
    if len(known) > KNOWN_WORDS:
        known.clear()
    out = []
    for word in words:
        if (found := known.get(word)) is None:
            known[word] = found = value(word)
        out.append(found)
    return out


def tokens_of(texts: pa.Array, known: dict[str, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Token hashes of all texts, where each text's begin and end, and each token's word number."""
    words, bounds = split_words(texts)
    distinct, at = distinct_words(words)
    hashes = np.array(known_values(distinct, known, token_hash), np.uint64)[at]
    kept = hashes != 0
    counted = np.concatenate(([0], np.cumsum(kept)))
    word = (np.arange(len(at)) - np.repeat(bounds[:-1], np.diff(bounds)))[kept]
    return hashes[kept], counted[bounds], word
