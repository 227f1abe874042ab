"""Benchmark decontamination by spaced-seed hashing.

Tokens are the letters and digits of words apart by white space, without case. A fixed mask
takes some of the tokens in a span and ignores the others, so texts that differ at an ignored
place still hash alike. The hashes of the benchmark's spans are joined with those at every
place of every document; each hit names a diagonal, on which the item and the document are
compared token by token. There every maximal stretch (a match +1, a substitution -2; no part
of it and none around it scores better) counts if it has `MIN_STRETCH` matches. Stretches add
up, of one diagonal and of several, so that neither a replaced block nor an insertion or
deletion hides a leak. A document leaks an item if at least half of the item's tokens are
found (between `MIN_TOKENS` and `ENOUGH_TOKENS` of them), or if `RUN` of them stand in a row.
An item of fewer than `MIN_TOKENS` tokens leaks where all of them stand in a row.

The benchmark is the query side. It is split into blocks of about `BLOCK_BYTES` of text, and
one block after the other is read, broadcast, joined against all documents and let go, whatever
the number of blocks; documents aren't shuffled. Nulls and empty texts have no tokens. Items of
fewer tokens than the shortest mask spans can't be told from chance and match nothing. Repeated rows and repeated
ids are each compared; a pair of ids is returned once. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from tablesync.llm.common import mixed, settled, slices, tokens_of

MASKS = ("111111", "11101011", "1100110011", "11010010101")
MIN_STRETCH = 8
MIN_TOKENS = 10
ENOUGH_TOKENS = 25
RUN = 13
BLOCK_BYTES = 32 << 20

_TABLE_BITS = 22
SCHEMA = "item_id long, matched int, first_word long, last_word long"


def _seeds(tokens: np.ndarray, mask: str, number: int) -> np.ndarray:
    """The hash of the masked tokens at every place with room for the mask."""
    n = len(tokens) - len(mask) + 1
    total = np.full(max(n, 0), number + 1, np.uint64)
    if n > 0:
        for place, taken in enumerate(mask):
            if taken == "1":
                total = total * np.uint64(0x9E3779B97F4A7C15) + tokens[place : place + n]
    return mixed(total)


def _stretches(same: np.ndarray) -> list[tuple[int, int]]:
    """(start, stop) of all maximal stretches of a diagonal with `MIN_STRETCH` matches, by Ruzzo and Tompa's one pass."""
    matches = np.concatenate(([0], np.cumsum(same)))
    if matches[-1] < MIN_STRETCH:
        return []
    turns = np.flatnonzero(np.diff(np.concatenate(([False], same, [False]))))
    score = 3 * matches[turns] - 2 * turns  # before and after each run of matches
    kept: list[tuple] = []  # start, stop, score before, score after, the last kept one with a lower score before
    for start, stop, before, after in zip(turns[::2].tolist(), turns[1::2].tolist(), score[::2].tolist(), score[1::2].tolist()):
        while True:
            lower = len(kept) - 1
            while lower >= 0 and kept[lower][2] >= before:
                lower = kept[lower][4]
            if lower < 0 or kept[lower][3] >= after:
                break
            start, before = kept[lower][0], kept[lower][2]
            del kept[lower:]
        kept.append((start, stop, before, after, lower))
    return [(start, stop) for start, stop, *_ in kept if matches[stop] - matches[start] >= MIN_STRETCH]


def _longest_run(same: np.ndarray) -> int:
    turns = np.flatnonzero(np.diff(np.concatenate(([False], same, [False]))))
    return int((turns[1::2] - turns[::2]).max(initial=0))


@dataclass(frozen=True)
class Index:
    """The spans of a block of benchmark items, by hash."""

    item_ids: list
    tokens: np.ndarray
    bounds: np.ndarray
    hashes: np.ndarray
    item: np.ndarray
    place: np.ndarray
    present: np.ndarray

    @classmethod
    def of(cls, rows: list[tuple]) -> Index:
        tokens, bounds, _ = tokens_of(pa.array([text for _, text in rows], pa.string()), {})
        sizes = np.diff(bounds)
        owner = np.repeat(np.arange(len(rows)), sizes)
        hashes, item, place = [], [], []
        for number, mask in enumerate(MASKS):
            found = _seeds(tokens, mask, number)
            at = np.arange(len(found))
            own = owner[: len(found)]
            whole = at + len(mask) <= bounds[1:][own]
            hashes.append(found[whole])
            item.append(own[whole])
            place.append((at - bounds[:-1][own])[whole])
        hashes, item, place = map(np.concatenate, (hashes, item, place))
        order = np.argsort(hashes, kind="stable")
        present = np.zeros(1 << _TABLE_BITS, bool)
        present[hashes >> np.uint64(64 - _TABLE_BITS)] = True
        return cls([i for i, _ in rows], tokens, bounds, hashes[order], item[order], place[order], present)

    def diagonals(self, tokens: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Distinct (text, item, diagonal) of all hits."""
        text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        hits = [np.zeros((0, 3), np.int64)]
        for number, mask in enumerate(MASKS):
            found = _seeds(tokens, mask, number)
            at = np.flatnonzero(self.present[found >> np.uint64(64 - _TABLE_BITS)])
            at = at[at + len(mask) <= bounds[1:][text[at]]]
            low = np.searchsorted(self.hashes, found[at], "left")
            n = np.searchsorted(self.hashes, found[at], "right") - low
            at, low = np.repeat(at, n), np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())
            hits.append(np.stack((text[at], self.item[low], at - self.place[low]), axis=1))
            if len(hits) > 1:
                hits = [np.unique(np.concatenate(hits), axis=0)]
        return hits[0]

    def leaks(self, tokens: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, int, int, int, int]]:
        """(text, item, matched tokens, first token, last token) of the texts that leak an item."""
        found = self.diagonals(tokens, bounds)
        if not len(found):
            return
        groups = np.flatnonzero(np.concatenate(([True], (found[1:, :2] != found[:-1, :2]).any(axis=1))))
        for rows in np.split(found, groups[1:]):
            text, item = int(rows[0, 0]), int(rows[0, 1])
            own = self.tokens[self.bounds[item] : self.bounds[item + 1]]
            begin, end = int(bounds[text]), int(bounds[text + 1])
            covered = np.zeros(len(own), bool)
            first, last, run = end, begin, 0
            for diagonal in rows[:, 2].tolist():
                low, high = max(0, begin - diagonal), min(len(own), end - diagonal)
                same = own[low:high] == tokens[diagonal + low : diagonal + high]
                run = max(run, _longest_run(same))
                if len(own) < MIN_TOKENS:
                    stretches = [(0, len(own))] if run == len(own) else []
                else:
                    stretches = _stretches(same)
                for start, stop in stretches:
                    covered[low + start : low + stop] |= same[start:stop]
                    first = min(first, diagonal + low + start)
                    last = max(last, diagonal + low + stop - 1)
            matched = int(covered.sum())
            least = max(MIN_TOKENS, min(len(own) / 2, ENOUGH_TOKENS))
            if matched >= min(len(own), least) or run >= RUN:
                yield text, item, matched, first, last


def _leaks(index):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, int] = {}
        for batch in batches:
            for part in slices(batch):
                tokens, bounds, word = tokens_of(part.column("text"), known)
                ids = part.column("doc_id")
                rows = [
                    (text, index.value.item_ids[item], matched, int(word[first]), int(word[last]))
                    for text, item, matched, first, last in index.value.leaks(tokens, bounds)
                ]
                texts, *columns = list(zip(*rows)) or [[]] * 5
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64()]
                names = ["doc_id", "item_id", "matched", "first_word", "last_word"]
                found = [pa.array(c, k) for c, k in zip(columns, kinds)]
                yield pa.record_batch([ids.take(pa.array(texts, pa.int64())), *found], names)

    return run


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, matched, first_word, last_word): one row per leaking document and leaked item.

    `doc_id` can be of any type that can be grouped by.
    """
    read = docs.select("doc_id", "text")
    schema = StructType([read.schema["doc_id"], *StructType.fromDDL(SCHEMA)])
    context = docs.sparkSession.sparkContext
    items = benchmark.select("item_id", "text").where("text is not null")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = size // BLOCK_BYTES + 1
    found = None
    for block in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        index = context.broadcast(Index.of([tuple(row) for row in part.collect()]))
        rows = settled(read.mapInArrow(_leaks(index), schema))
        index.unpersist()
        found = rows if found is None else found.union(rows)
    return found.groupBy("doc_id", "item_id").agg(
        F.max("matched").alias("matched"), F.min("first_word").alias("first_word"), F.max("last_word").alias("last_word")
    )


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of `docs` that leak no item; of rows that share an id, those whose own text leaks none."""
    key = F.struct("doc_id", F.xxhash64("text").alias("text"))
    found = leaks(docs.select(key.alias("doc_id"), "text"), benchmark).select(F.col("doc_id").alias("__key"))
    return docs.join(found.distinct(), key.eqNullSafe(F.col("__key")), "left_anti")
