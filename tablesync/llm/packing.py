"""Bounded-space online packing of token sequences.

Each task reads its documents in order, with at most `open_windows` windows open. Whole
windows of a long document stand alone; what is left of it goes to the open window with the
least room that holds it. When none does, the fullest is filled up with the document's first
tokens and emitted (or emitted as it is, if that piece would be shorter than `min_piece`).
At a task's end its open windows are merged: the fullest are filled from the emptiest, so a
task leaves one window that isn't full. Those leftovers are merged over groups of `MERGED`
tasks, without further cuts; no group grows with the input.

A null or empty text is the end-of-text id alone. Repeated rows are packed each. Null and
repeated ids are allowed, other columns are ignored. Rows follow from a task's input alone,
so a task that is run again gives the same rows.
"""

from __future__ import annotations

import os
from bisect import bisect_left, insort
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tablesync.llm.common import KNOWN_WORDS, distinct_words, settled, slices, split_words

LENGTH = 2048
END_ID = 1
OPEN_WINDOWS = 64
MIN_PIECE = 16
#: Tasks whose leftover windows are merged in one group.
MERGED = 256

_SEQUENCES = 40  # bits of a sequence id below the task's number
_TOGETHER = 200  # words encoded as one text, and texts encoded in one call
_ROWS = 1 << 15
_FIELDS = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "open", "ids"]
SCHEMA = (
    "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, open boolean, ids binary"
)


class Encoder:
    """Ids of texts. Words apart by ASCII white space are encoded once each and remembered.

    The tokenizer must drop white space and never join what it separates, as a vocabulary with
    word ends does. New words are encoded many at a time; offsets tell whose each id is.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self._forget()

    def _forget(self) -> None:
        self.number: dict[str, int] = {}
        self.ids, self.sizes, self.starts = np.zeros(0, "<u4"), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _learn(self, words: list[str]) -> None:
        ids, sizes = [self.ids], [self.sizes]
        parts = [words[i : i + _TOGETHER] for i in range(0, len(words), _TOGETHER)]
        for begin in range(0, len(parts), _TOGETHER):
            group = parts[begin : begin + _TOGETHER]
            coded = self.tokenizer.encode_batch([" ".join(part) for part in group], add_special_tokens=False)
            for part, found in zip(group, coded):
                length = np.fromiter(map(len, part), np.int64, len(part)) + 1
                at = np.array([start for start, _ in found.offsets], np.int64)
                owner = np.searchsorted(np.cumsum(length) - length, at, side="right") - 1
                ids.append(np.array(found.ids, "<u4"))
                sizes.append(np.bincount(owner, minlength=len(part)))
        self.number.update(zip(words, range(len(self.number), len(self.number) + len(words))))
        self.ids, self.sizes = np.concatenate(ids), np.concatenate(sizes)
        self.starts = np.cumsum(self.sizes) - self.sizes

    def __call__(self, texts: pa.Array, end_id: int) -> Iterator[np.ndarray]:
        words, bounds = split_words(texts)
        distinct, at = distinct_words(words)
        new = [w for w in distinct if w not in self.number]
        if len(self.number) + len(new) > KNOWN_WORDS:
            self._forget()
            new = distinct
        if new:
            self._learn(new)
        at = np.array([self.number[w] for w in distinct], np.int64)[at]
        end = np.full(1, end_id, "<u4")
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            n = self.sizes[at[a:b]]
            place = np.arange(n.sum()) + np.repeat(self.starts[at[a:b]] - (np.cumsum(n) - n), n)
            yield np.concatenate((self.ids[place], end))


class _Window:
    __slots__ = ("pieces", "used")

    def __init__(self):
        self.used, self.pieces = 0, []

    def add(self, doc_id, start: int, ids: np.ndarray, total: int) -> None:
        self.pieces.append((doc_id, start, ids, total))
        self.used += len(ids)


class Packer:
    """The open windows of one task; `emit` gets each window that is done."""

    def __init__(self, emit: Callable[[_Window, bool], None], length: int, most: int, least: int):
        self.emit, self.length, self.most, self.least = emit, length, most, least
        self.open: list[tuple[int, int, _Window]] = []  # (room, number, window), by room
        self.number = 0

    def add(self, doc_id, ids: np.ndarray) -> None:
        total, start = len(ids), 0
        while total - start >= self.length:
            whole = _Window()
            whole.add(doc_id, start, ids[start : start + self.length], total)
            self.emit(whole, False)
            start += self.length
        while start < total:
            rest = ids[start:]
            at = bisect_left(self.open, len(rest), key=lambda x: x[0])
            if at < len(self.open):
                _, number, window = self.open.pop(at)
                window.add(doc_id, start, rest, total)
                start = total
            elif len(self.open) < self.most:
                number, window = self.number, _Window()
                self.number += 1
                window.add(doc_id, start, rest, total)
                start = total
            else:
                room, number, window = self.open.pop(0)
                if room >= self.least:
                    window.add(doc_id, start, rest[:room], total)
                    start += room
                self.emit(window, False)
                continue
            if window.used == self.length:
                self.emit(window, False)
            else:
                insort(self.open, (self.length - window.used, number, window), key=lambda x: x[:2])

    def close(self) -> None:
        """Fill the fullest windows from the emptiest, until one isn't full."""
        windows = [w for _, _, w in self.open]
        self.open = []
        while windows:
            window = windows.pop(0)
            while window.used < self.length and windows:
                giver = windows[-1]
                doc_id, start, ids, total = giver.pieces.pop()
                giver.used -= len(ids)
                room = self.length - window.used
                window.add(doc_id, start, ids[:room], total)
                if room < len(ids):
                    giver.add(doc_id, start + room, ids[room:], total)
                if not giver.pieces:
                    windows.pop()
            self.emit(window, window.used < self.length)


def _pack(path: str, end_id: int, length: int, most: int, least: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from zlib import crc32

        encode = Encoder(path)
        columns: list[list] = [[] for _ in _FIELDS]
        sequence = TaskContext.get().partitionId() << _SEQUENCES

        def emit(window: _Window, still_open: bool) -> None:
            nonlocal sequence
            offset = 0
            for doc_id, start, ids, total in window.pieces:
                raw = ids.tobytes()
                if not with_ids:
                    raw = crc32(raw).to_bytes(4, "big")
                for column, value in zip(columns, (doc_id, start, len(ids), total, sequence, offset, still_open, raw)):
                    column.append(value)
                offset += len(ids)
            sequence += 1

        def rows() -> pa.RecordBatch:
            kinds = [pa.int64()] * 6 + [pa.bool_(), pa.binary()]
            batch = pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], _FIELDS)
            for column in columns:
                column.clear()
            return batch

        packer = Packer(emit, length, most, least)
        for batch in batches:
            for part in slices(batch):
                for doc_id, ids in zip(part.column("doc_id").to_pylist(), encode(part.column("text"), end_id)):
                    packer.add(doc_id, ids)
                    if len(columns[0]) >= (_ROWS if not with_ids else 1024):
                        yield rows()
        packer.close()
        yield rows()

    return run


def _merge(length: int):
    """Best fit of whole leftover windows, the fullest first."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("sequence_id", "ascending"), ("offset", "ascending")])
        sequence, size = table["sequence_id"].to_numpy(), table["length"].to_numpy()
        starts = np.flatnonzero(np.concatenate(([True], sequence[1:] != sequence[:-1])))
        used = np.add.reduceat(size, starts)
        merged: list[tuple[int, int]] = []  # (room, number), by room
        to, begin = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
        for i in np.argsort(-used, kind="stable").tolist():
            at = bisect_left(merged, (int(used[i]), -1))
            room, number = merged.pop(at) if at < len(merged) else (length, i)
            to[i], begin[i] = sequence[starts[number]], length - room
            insort(merged, (room - int(used[i]), number))
        window = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(sequence))))
        table = table.set_column(table.schema.get_field_index("sequence_id"), "sequence_id", pa.array(to[window]))
        offset = pa.array(table["offset"].to_numpy() + begin[window])
        return table.set_column(table.schema.get_field_index("offset"), "offset", offset)

    return run


def pack(
    docs: DataFrame,
    tokenizer: str,
    *,
    length: int = LENGTH,
    end_id: int = END_ID,
    open_windows: int = OPEN_WINDOWS,
    min_piece: int = MIN_PIECE,
    with_ids: bool = True,
) -> DataFrame:
    """The pieces of `docs` (doc_id, text) in windows of `length` ids.

    doc_id, start (ids of the document before the piece), length, doc_tokens, sequence_id,
    offset (in the window), and `ids`: little-endian unsigned 32-bit ids, or instead
    `ids_crc32`, their CRC, without `with_ids`.
    """
    if open_windows < 1 or length < 1 or min_piece < 1:
        raise ValueError("length, open_windows and min_piece must be at least 1")
    pieces = settled(
        docs.select("doc_id", "text").mapInArrow(
            _pack(tokenizer, end_id, length, open_windows, min_piece, with_ids), SCHEMA
        )
    )
    group = F.shiftright("sequence_id", _SEQUENCES + MERGED.bit_length() - 1)
    merged = pieces.where("open").groupBy(group).applyInArrow(_merge(length), SCHEMA)
    packed = pieces.where("not open").union(merged).drop("open")
    if with_ids:
        return packed
    return packed.withColumn("ids_crc32", F.conv(F.hex("ids"), 16, 10).cast("long")).drop("ids")
