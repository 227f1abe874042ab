"""Exact substring dedup: remove every word in a run of `window` words that occurs elsewhere.

De Bruijn compaction. The edges of the graph are the token k-mers of all texts (`window`
words each). Writing each edge down would cost a row per word, so edges are compacted before
any shuffle: consecutive edges that share an anchor (the least hash among their shorter
k-mers of `anchor` words) are one path. Equal edges have equal anchors, so an edge can only
repeat at its own anchor. Per anchor,

* one path only: it doesn't branch, and all its edges occur as often as the path;
* several paths: it branches. Their edges are compared one by one, each path once however
  often it occurs, and each gets a bit mask of the edges that repeat.

The verdicts go back to the texts by Spark joins on path digests, and each text is verified
at its own coordinates: a path counts there only if the text's own words have its digest.
Paths and edges are known by 128-bit digests of their words.

Skew: paths are counted per task before the shuffle, so copies of one passage arrive as one
row a task. An anchor found to branch within a task has its paths dealt by their digest and
leaves one mark at the anchor, so one that a third of all texts share is split as well.
Adaptive execution splits a hot path in the join that brings verdicts back. What a text is
told to remove is a set of its paths, however often its row is repeated.

Nulls and empty texts have no words; texts shorter than `window` keep all of theirs. Repeated
rows are texts of their own, and so remove each other's words. Null and repeated ids are
allowed, and other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from tablesync.llm.common import (
    Rolling,
    distinct_words,
    hash_words,
    mixed,
    signed,
    slices,
    sliding_least,
    split_words,
)

WINDOW = 35
ANCHOR = 8
#: Paths that a task gathers before it counts them and sends them on.
GATHERED = 1 << 20

_PLAIN, _BRANCHING, _MARK = 0, 1, 2


class _Paths:
    """The compacted paths of the texts in a batch, in order of the texts."""

    def __init__(self, texts: pa.Array, window: int, anchor: int):
        self.words, self.bounds = split_words(texts)
        distinct, at = distinct_words(self.words)
        n = len(at)
        self.rolling = Rolling(hash_words(distinct)[at])
        lengths = np.diff(self.bounds)
        text = np.repeat(np.arange(len(lengths)), lengths)
        edges = np.flatnonzero(np.arange(n) + window <= self.bounds[1:][text])
        if not len(edges):
            self.first = self.count = self.text = np.zeros(0, np.int64)
            self.anchor = self.digest = self.second = np.zeros(0, np.uint64)
            return
        hashes = self.rolling.lane(0, np.arange(n - anchor + 1), anchor)
        # the upper half of a hash and, among equals, the leftmost place
        ranked = (hashes & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(hashes), dtype=np.uint64)
        place = sliding_least(ranked, window - anchor + 1)[edges] & np.uint64(0xFFFFFFFF)
        starts = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
        self.first = edges[starts]
        self.count = np.diff(np.append(starts, len(edges)))
        self.text = text[self.first]
        self.anchor = hashes[place[starts].astype(np.int64)]
        self.digest = self.rolling.lane(0, self.first, self.count + window - 1)
        self.second = self.rolling.lane(1, self.first, self.count + window - 1)


def _counted(rows: list[np.ndarray]) -> pa.RecordBatch:
    """Paths of a task as (route, kind, digest, second, n, text_key), one row for each."""
    anchor, digest, second, key = map(np.concatenate, zip(*rows))
    order = np.lexsort((second, digest, anchor))
    anchor, digest, second, key = anchor[order], digest[order], second[order], key[order]
    new = np.concatenate(([True], (digest[1:] != digest[:-1]) | (second[1:] != second[:-1]) | (anchor[1:] != anchor[:-1])))
    starts = np.flatnonzero(new)
    n = np.diff(np.append(starts, len(anchor)))
    anchor, digest, second, key = anchor[starts], digest[starts], second[starts], key[starts]
    group = np.flatnonzero(np.concatenate(([True], anchor[1:] != anchor[:-1])))
    paths = np.diff(np.append(group, len(anchor)))
    branching = np.repeat(paths > 1, paths)
    marks = anchor[group[paths > 1]]
    none = np.zeros(len(marks), np.uint64)
    kind = np.concatenate((np.where(branching, _BRANCHING, _PLAIN), np.full(len(marks), _MARK))).astype(np.int32)
    return pa.record_batch(
        {
            "route": signed(np.concatenate((np.where(branching, mixed(digest), anchor), marks))),
            "kind": pa.array(kind),
            "digest": signed(np.concatenate((digest, none))),
            "second": signed(np.concatenate((second, none))),
            "n": pa.array(np.concatenate((n, none.astype(np.int64)))),
            "text_key": pa.array(np.concatenate((key, none.astype(np.int64)))),
        }
    )


def _path_counts(window: int, anchor: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches):
        rows, gathered = [], 0
        for batch in batches:
            for part in slices(batch):
                paths = _Paths(part.column("text"), window, anchor)
                if len(paths.first):
                    keys = part.column("text_key").to_numpy()[paths.text]
                    rows.append((paths.anchor, paths.digest, paths.second, keys))
                    gathered += len(keys)
                if gathered >= GATHERED:
                    yield _counted(rows)
                    rows, gathered = [], 0
        if rows:
            yield _counted(rows)

    return run


def _path_places(window: int, anchor: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches):
        for batch in batches:
            for part in slices(batch):
                paths = _Paths(part.column("text"), window, anchor)
                keys = part.column("text_key").to_numpy()[paths.text]
                yield pa.record_batch({"text_key": pa.array(keys), "digest": signed(paths.digest)})

    return run


def _listed(part: pa.RecordBatch, column: str, fields: tuple[str, ...]) -> tuple[np.ndarray, list[np.ndarray]]:
    """A column of lists of structs as the row of each element and the arrays of its fields."""
    lists = part.column(column)
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    flat = lists.flatten()
    return np.repeat(np.arange(len(sizes)), sizes), [flat.field(name).to_numpy(zero_copy_only=False) for name in fields]


def _found(paths: _Paths, row: np.ndarray, digest: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the paths, those that a text's list has, and where the list has them."""
    if not len(row) or not len(paths.first):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    digest, second = (half.astype(np.int64).view(np.uint64) for half in (digest, second))
    listed = mixed(digest + mixed(second + mixed(row.astype(np.uint64))))
    own = mixed(paths.digest + mixed(paths.second + mixed(paths.text.astype(np.uint64))))
    order = np.argsort(listed)
    at = order[np.minimum(np.searchsorted(listed, own, sorter=order), len(order) - 1)]
    same = (row[at] == paths.text) & (digest[at] == paths.digest) & (second[at] == paths.second)
    return np.flatnonzero(same), at[same]


def _edges_of_branching(window: int, anchor: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The edges of the branching paths that a text stands for, once for each path."""

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                paths = _Paths(part.column("text"), window, anchor)
                row, (digest, second, n) = _listed(part, "paths", ("digest", "second", "n"))
                own, at = _found(paths, row, digest, second)
                _, once = np.unique(at, return_index=True)  # a path may stand twice in one text
                own, at = own[once], at[once]
                count = paths.count[own]
                place = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                edge = np.repeat(paths.first[own], count) + place
                yield pa.record_batch(
                    {
                        "edge": signed(paths.rolling.lane(0, edge, window)),
                        "edge_second": signed(paths.rolling.lane(1, edge, window)),
                        "digest": signed(np.repeat(paths.digest[own], count)),
                        "second": signed(np.repeat(paths.second[own], count)),
                        "bit": pa.array(np.int64(1) << place),
                        "n": pa.array(np.repeat(n[at].astype(np.int64), count)),
                    }
                )

    return run


def _removals(window: int, anchor: int, keep_layout: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches):
        for batch in batches:
            for part in slices(batch):
                paths = _Paths(part.column("text"), window, anchor)
                row, (digest, second, mask) = _listed(part, "repeats", ("digest", "second", "mask"))
                own, at = _found(paths, row, digest, second)
                count = paths.count[own]
                place = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                repeats = (np.repeat(mask[at].astype(np.int64), count) >> place) & 1 == 1
                edge = (np.repeat(paths.first[own], count) + place)[repeats]
                change = np.zeros(len(paths.words) + 1, np.int64)
                np.add.at(change, edge, 1)
                np.add.at(change, edge + window, -1)
                gone = np.cumsum(change[:-1]) > 0
                kept_before = np.concatenate(([0], np.cumsum(~gone)))
                words = np.diff(paths.bounds)
                ends = kept_before[paths.bounds]
                n_removed = words - np.diff(ends)
                kept = pa.LargeListArray.from_arrays(pa.array(ends), paths.words.filter(pa.array(~gone)))
                joined = pc.binary_join(kept, " ")
                whole = pa.array(n_removed == 0) if keep_layout else pa.scalar(False)
                yield pa.record_batch(
                    {
                        "doc_id": part.column("doc_id"),
                        "carried": part.column("carried"),
                        "n_words": pa.array(words),
                        "n_removed": pa.array(n_removed),
                        "kept_text": pc.if_else(whole, part.column("text"), joined),
                        "kept_sha256": pa.array([hashlib.sha256(j.as_buffer()).hexdigest() for j in joined]),
                    }
                )

    return run


def remove_repeats(
    docs: DataFrame, *, window: int = WINDOW, anchor: int = ANCHOR, keep_layout: bool = False, carry: tuple[str, ...] = ()
) -> DataFrame:
    """One row per row of `docs` (doc_id, text): doc_id, n_words, n_removed, kept_text, kept_sha256.

    The columns named in `carry` follow as the fields of a struct `carried`, null if there are none.
    `kept_text` joins the kept words by one space; with `keep_layout` a text that loses none
    stays as it is. `kept_sha256` is always of the joined words.
    """
    if not 0 < anchor <= window or window - anchor > 62:
        raise ValueError("anchor must be in 1 .. window, and less than 63 below it")
    carried = F.struct(*carry) if carry else F.lit(None).cast("int")
    own = docs.select("doc_id", "text", carried.alias("carried"), F.xxhash64("doc_id", "text").alias("text_key"))
    read = own.select("text_key", "text")

    counted = read.mapInArrow(
        _path_counts(window, anchor), "route long, kind int, digest long, second long, n long, text_key long"
    )
    paths = (
        counted.repartition("route")
        .groupBy("route", "kind", "digest", "second")
        .agg(F.sum("n").alias("n"), F.min("text_key").alias("text_key"))
    )
    at_anchor = Window.partitionBy("route")
    paths = paths.withColumns(
        {
            "marked": F.max("kind").over(at_anchor) == _MARK,
            "rivals": F.count(F.when(F.col("kind") == _PLAIN, 1)).over(at_anchor),
        }
    ).where(F.col("kind") != _MARK)
    branches = (F.col("kind") == _BRANCHING) | F.col("marked") | (F.col("rivals") > 1)
    paths = paths.withColumn("branches", branches).where("branches or n > 1")

    lists = (
        paths.where("branches")
        .groupBy("text_key")
        .agg(F.collect_list(F.struct("digest", "second", "n")).alias("paths"))
    )
    edges = (
        own.join(lists, "text_key")
        .mapInArrow(
            _edges_of_branching(window, anchor),
            "edge long, edge_second long, digest long, second long, bit long, n long",
        )
    )
    repeated = edges.groupBy("edge", "edge_second").agg(F.sum("n").alias("n")).where("n > 1").drop("n")
    masks = (
        edges.drop("n")
        .join(repeated, ["edge", "edge_second"])
        .select("digest", "second", F.col("bit").alias("mask"))
    )
    # the condition on text_key always holds; with it both uses of `paths` read the same columns and share a shuffle
    straight = paths.where("not branches and text_key is not null").select("digest", "second", F.lit(-1).cast("long").alias("mask"))
    verdicts = masks.unionByName(straight).groupBy("digest", "second").agg(F.bit_or("mask").alias("mask"))

    # By one half of the digest, `_found` compares both. So the verdicts, aggregated by both, are shuffled
    # for this join, and adaptive execution can split a hot path, which it can't beside an aggregate.
    repeats = (
        read.mapInArrow(_path_places(window, anchor), "text_key long, digest long")
        .join(verdicts, "digest")
        .groupBy("text_key")
        .agg(F.collect_set(F.struct("digest", "second", "mask")).alias("repeats"))
    )
    kind = own.schema["carried"].dataType.simpleString()
    return own.join(repeats, "text_key", "left").mapInArrow(
        _removals(window, anchor, keep_layout),
        f"doc_id long, carried {kind}, n_words long, n_removed long, kept_text string, kept_sha256 string",
    )
