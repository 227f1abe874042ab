"""Alignment of two tokenizers' tokens by the bytes that they stand for.

Tokens of A and B are ranges of the same bytes (a space, then the text). Where an A token and
a B token end together, the text is cut; what lies between two cuts is a group, and its last
tokens are linked. Groups are put together by an associative product of fragments: a fragment
of a byte range has an open prefix (tokens up to its first cut), closed groups, and an open
suffix (tokens after its last cut); a product closes the group between a suffix and the next
prefix. A range without a cut is all prefix, and no tokens are the neutral fragment.

* A text of at most `CHUNK` characters is one product in one task. Its factors are what lies
  between single spaces among other characters than white space: neither tokenizer has a token
  across such a space, so each factor is encoded once and remembered.
* A longer text is cut into byte ranges of CHUNK characters that are dealt over the cluster.
  A range may begin and end inside a word; it is encoded from the space before its start to the
  space after its end, and gives the tokens that end in it. (Text without such a space for
  CHUNK characters has no inner end: its range goes on to the next one.) Fragments are then
  multiplied in a tree, `FAN` neighbours a task and round.

Links are counted over the corpus by id pair: each row's distinct pairs are counted in its
task, then by Spark. Pairs are at most as many as both vocabularies allow; they are broadcast
to the rows if their measured size is within `BROADCAST_BYTES`, else joined by shuffling.

A must be a byte-level BPE whose patterns take a space only before a word, B a BPE with byte
fallback that marks a space by U+2581 and has no piece with that mark after another character
(this is checked). A null or empty text, or one whose A or B bytes differ from it, has no
tokens: zeros, and '' for its groups. Repeated rows, null and repeated ids are rows of their
own; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import os
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from tablesync.llm.common import settled, shared_folder, slices

#: Characters of a text that are worked on at once.
CHUNK = 1 << 15
#: Fragments that one task multiplies in a round.
FAN = 16
#: Bytes of text whose segments are looked up at once.
SLICE_BYTES = 1 << 19
#: Segments that a task remembers.
KNOWN = 300_000
#: Segments encoded as one text, and texts encoded in one call.
TOGETHER = 100
BROADCAST_BYTES = 64 << 20
_PAIR_BYTES = 64  # of a pair's counts in memory, with what a hash table takes
_ROWS = 40  # bits of a row's number below its task's

_SAFE = re.compile(r"(?<=\S) (?=\S)")
_UNSAFE = re.compile(r"\A | \Z|\s | \s")
_MARK = "▁"

FACTS = "n_a long, n_b long, n_groups long, groups_sha256 string, pairs array<long>, counts array<long>"
FRAGMENT = (
    "ok boolean, cut boolean, n_a long, n_b long, n_groups long, head_a array<int>, head_b array<int>, "
    "tail_a array<int>, tail_b array<int>, groups binary, pairs array<long>, counts array<long>"
)


def _group(a: list[int], b: list[int]) -> bytes:
    return b"%s|%s" % (",".join(map(str, a)).encode(), ",".join(map(str, b)).encode())


def _pair(a: int, b: int) -> int:
    return a << 32 | b


@dataclass
class Fragment:
    """Tokens of a byte range; see above. `ok` is False if bytes differed from the text."""

    ok: bool = True
    cut: bool = False
    n_a: int = 0
    n_b: int = 0
    n_groups: int = 0  # closed
    head_a: list[int] = field(default_factory=list)
    head_b: list[int] = field(default_factory=list)
    tail_a: list[int] = field(default_factory=list)
    tail_b: list[int] = field(default_factory=list)
    groups: bytes = b""  # closed, joined by ;
    pairs: dict[int, int] = field(default_factory=dict)  # of closed groups

    def __mul__(self, other: Fragment) -> Fragment:
        out = Fragment(self.ok and other.ok, self.cut or other.cut, self.n_a + other.n_a, self.n_b + other.n_b)
        out.head_a, out.head_b, out.tail_a, out.tail_b = self.head_a, self.head_b, other.tail_a, other.tail_b
        closed = [self.groups]
        out.pairs = dict(self.pairs)
        out.n_groups = self.n_groups + other.n_groups
        if not self.cut:
            out.head_a, out.head_b = self.head_a + other.head_a, self.head_b + other.head_b
        elif not other.cut:
            out.tail_a, out.tail_b = self.tail_a + other.head_a, self.tail_b + other.head_b
        else:
            a, b = self.tail_a + other.head_a, self.tail_b + other.head_b
            closed.append(_group(a, b))
            out.n_groups += 1
            link = _pair(a[-1], b[-1])
            out.pairs[link] = out.pairs.get(link, 0) + 1
        closed.append(other.groups)
        out.groups = b";".join(filter(None, closed))
        for link, n in other.pairs.items():
            out.pairs[link] = out.pairs.get(link, 0) + n
        return out

    def whole(self) -> Fragment:
        """The fragment of a whole text with its first group closed, too."""
        assert not self.ok or not (self.tail_a or self.tail_b), "tokens after the last cut of a whole text"
        return Fragment(cut=True) * self if self.ok and self.cut else Fragment(ok=False)


def _before(counts: np.ndarray) -> np.ndarray:
    return np.cumsum(counts) - counts


class Pairing:
    """Two vocabularies: the bytes of their tokens, and how their ids are written in groups."""

    def __init__(self, size_a: list[int], size_b: list[int]):
        self.size_a, self.size_b = np.array(size_a, np.int64), np.array(size_b, np.int64)
        within, last = (("%d,", "%d,"), ("%d|", "%d;"))
        counts = (len(size_a), len(size_b))
        # ids of A, the last of a group; then those of B
        self.kinds = np.cumsum([0, counts[0], counts[0], counts[1]])
        self.shown = [(form[i] % x).encode() for i in (0, 1) for form in (within, last) for x in range(counts[i])]
        self.widths = np.fromiter(map(len, self.shown), np.int64, len(self.shown))

    def cuts(self, ids_a: np.ndarray, ids_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Where tokens of A and of B end, and the numbers of those that end together."""
        ends_a, ends_b = np.cumsum(self.size_a[ids_a]), np.cumsum(self.size_b[ids_b])
        at = np.searchsorted(ends_b, ends_a)
        same = np.flatnonzero(ends_a == np.append(ends_b, -1)[at])
        return ends_a, ends_b, same, at[same]

    def written(self, ids_a: np.ndarray, ids_b: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The text of closed groups, each with ; behind it, and where each ends. Cuts are from the first id on."""
        n_a, n_b = np.diff(cut_a, prepend=-1), np.diff(cut_b, prepend=-1)
        codes = np.empty(len(ids_a) + len(ids_b), np.int64)
        place_a = np.arange(len(ids_a)) + np.repeat(_before(n_b), n_a)
        place_b = np.arange(len(ids_b)) + np.repeat(np.cumsum(n_a), n_b)
        codes[place_a], codes[place_b] = ids_a, ids_b + self.kinds[2]
        codes[place_a[cut_a]] += self.kinds[1]
        codes[place_b[cut_b]] += self.kinds[3] - self.kinds[2]
        ends = np.cumsum(self.widths[codes])[place_b[cut_b]]
        return b"".join(map(self.shown.__getitem__, codes.tolist())), ends

    def fragment(self, ids_a: list[int], ids_b: list[int], low: int = 0, high: int | None = None) -> Fragment:
        """The fragment of the tokens that end after byte `low`, up to byte `high`."""
        a, b = np.array(ids_a, np.int64), np.array(ids_b, np.int64)
        ends_a, ends_b, cut_a, cut_b = self.cuts(a, b)
        high = max([0, *ends_a[-1:].tolist(), *ends_b[-1:].tolist()]) if high is None else high
        (from_a, to_a), (from_b, to_b) = (np.searchsorted(e, [low, high], side="right") for e in (ends_a, ends_b))
        inner = (cut_a >= from_a) & (cut_a < to_a)
        a, b, cut_a, cut_b = a[from_a:to_a], b[from_b:to_b], cut_a[inner] - from_a, cut_b[inner] - from_b
        out = Fragment(cut=len(cut_a) > 0, n_a=len(a), n_b=len(b))
        if not out.cut:
            out.head_a, out.head_b = a.tolist(), b.tolist()
            return out
        (x, y), (i, j) = (cut_a[0] + 1, cut_a[-1] + 1), (cut_b[0] + 1, cut_b[-1] + 1)
        out.head_a, out.tail_a = a[:x].tolist(), a[y:].tolist()
        out.head_b, out.tail_b = b[:i].tolist(), b[j:].tolist()
        out.n_groups = len(cut_a) - 1
        out.groups = self.written(a[x:y], b[i:j], cut_a[1:] - x, cut_b[1:] - i)[0][:-1]
        links, times = np.unique(a[cut_a[1:]] << 32 | b[cut_b[1:]], return_counts=True)
        out.pairs = dict(zip(links.tolist(), times.tolist()))
        return out


def _byte_of() -> dict[str, int]:
    """The characters that a byte-level vocabulary writes for bytes: printable ones of Latin-1
    for themselves, the others in order from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Tokenizers:
    """Both tokenizers of a task, their tokens' bytes, and the segments that it has seen."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a, self.b = Tokenizer.from_file(path_a), SentencePieceProcessor(model_file=path_b)
        self.a.encode_special_tokens = True  # their strings in a text are ordinary text
        byte = _byte_of()
        vocabulary = self.a.get_vocab(with_added_tokens=False)
        self.bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.bytes_a[i] = bytes(byte[c] for c in token) if all(c in byte for c in token) else token.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any(_MARK in p.lstrip(_MARK) for p in pieces):
            raise ValueError(f"{path_b} has pieces that go on after a space")
        self.bytes_b = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(_MARK, " ").encode()
            for i, p in enumerate(pieces)
        ]
        self.pairing = Pairing([*map(len, self.bytes_a)], [*map(len, self.bytes_b)])
        self._forget()

    def encoded(self, texts: list[str]) -> Iterator[tuple[list[int], list[int], bool]]:
        """Ids by A and B of each text with a space before it, and whether both have its bytes."""
        spaced = [" " + t for t in texts]
        coded = self.a.encode_batch_fast(spaced, add_special_tokens=False)
        for text, a, b in zip(spaced, coded, self.b.encode(texts, num_threads=1)):
            raw, a = text.encode(), a.ids
            yield a, b, self._bytes(a, b) == (raw, raw)

    def _bytes(self, a: list[int], b: list[int]) -> tuple[bytes, bytes]:
        return b"".join(map(self.bytes_a.__getitem__, a)), b"".join(map(self.bytes_b.__getitem__, b))

    def fragment(self, text: str, low: int, high: int) -> Fragment:
        ((a, b, same),) = self.encoded([text])
        return self.pairing.fragment(a, b, low, high) if same else Fragment(ok=False)

    def _forget(self) -> None:
        """Of each segment by number: is it ok, ids of A and of B, groups, where its links begin."""
        self.number: dict[str, int] = {}
        self.groups: list[bytes] = []
        self.ok, self.n_a, self.n_b, self.n_groups = np.zeros(0, bool), *[np.zeros(0, np.int64)] * 3
        self.links = np.zeros(0, np.int64)
        self.starts = np.zeros(0, np.int64)

    def learn(self, segments: set[str]) -> None:
        new = [s for s in segments if s not in self.number]
        if len(self.number) + len(new) > KNOWN and self.number:
            self._forget()
            new = list(segments)
        if not new:
            return
        # Segments without white space at their ends are encoded many at a time, side by side.
        new.sort(key=lambda s: s == "" or s[0].isspace() or s[-1].isspace())
        loose = next((i for i, s in enumerate(new) if s == "" or s[0].isspace() or s[-1].isspace()), len(new))
        groups = [new[i : min(i + TOGETHER, loose)] for i in range(0, loose, TOGETHER)]
        ids_a, ids_b, good = [], [], []
        for group, (a, b, same) in zip(groups, self._many([" ".join(g) for g in groups])):
            if same:
                ids_a.append(a)
                ids_b.append(b)
                good += [True] * len(group)
            else:  # one of them has other bytes
                self._singly(group, ids_a, ids_b, good)
        self._singly(new[loose:], ids_a, ids_b, good)
        self._remember(new, np.array(good), *[np.fromiter((i for x in ids for i in x), np.int64) for ids in (ids_a, ids_b)])

    def _many(self, texts: list[str]) -> Iterator[tuple[list[int], list[int], bool]]:
        for i in range(0, len(texts), TOGETHER):
            yield from self.encoded(texts[i : i + TOGETHER])

    def _singly(self, segments: list[str], ids_a: list, ids_b: list, good: list[bool]) -> None:
        for a, b, same in self._many(segments):
            if same:
                ids_a.append(a)
                ids_b.append(b)
            good.append(same)

    def _remember(self, new: list[str], good: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
        """`a` and `b`: the ids of the good segments, which stand for the same bytes."""
        raw = np.fromiter((len(s.encode()) + 1 for s in new), np.int64, len(new))
        ends = np.cumsum(raw[good])
        ends_a, ends_b, cut_a, cut_b = self.pairing.cuts(a, b)
        text, ends_text = self.pairing.written(a, b, cut_a, cut_b)

        def counted(token_ends: np.ndarray) -> np.ndarray:
            """Tokens of each segment, 0 for those that are not good."""
            out = np.zeros(len(new), np.int64)
            out[good] = np.diff(np.searchsorted(token_ends, ends, side="right"), prepend=0)
            return out

        n_groups = counted(ends_a[cut_a])
        bounds = np.concatenate(([0], ends_text))[np.concatenate(([0], np.cumsum(n_groups)))].tolist()
        self.number.update(zip(new, range(len(self.number), len(self.number) + len(new))))
        self.groups += [text[x:y] for x, y in zip(bounds[:-1], bounds[1:])]
        self.ok = np.concatenate((self.ok, good))
        self.n_a, self.n_b = np.concatenate((self.n_a, counted(ends_a))), np.concatenate((self.n_b, counted(ends_b)))
        self.n_groups = np.concatenate((self.n_groups, n_groups))
        self.links = np.concatenate((self.links, a[cut_a] << 32 | b[cut_b]))
        self.starts = _before(self.n_groups)


def _segments(text: str) -> list[str]:
    """The text apart at the spaces that no token crosses."""
    return _SAFE.split(text) if _UNSAFE.search(text) else text.split(" ")


def _lists(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int64()))


def _numbers() -> Iterator[int]:
    """Row numbers that no other task has, the same when a task is run again."""
    first = TaskContext.get().partitionId() << _ROWS
    while True:
        yield first
        first += 1


def _short(path_a: str, path_b: str):
    """Facts of texts that are worked on whole."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, numbers = Tokenizers(path_a, path_b), _numbers()
        for batch in batches:
            for part in slices(batch, most=SLICE_BYTES):
                texts = [_segments(t) if t else [] for t in part.column("text").to_pylist()]
                flat = [s for t in texts for s in t]
                if flat:
                    known.learn(set(flat))
                yield _facts(known, texts, flat, part, numbers)

    return run


def _facts(known: Tokenizers, texts: list, flat: list, part: pa.RecordBatch, numbers: Iterator[int]) -> pa.RecordBatch:
    count = len(texts)
    sizes = np.fromiter(map(len, texts), np.int64, count)
    bounds = np.concatenate(([0], np.cumsum(sizes)))
    codes = np.fromiter(map(known.number.__getitem__, flat), np.int64, len(flat))

    def summed(values: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(values)))
        return total[bounds[1:]] - total[bounds[:-1]]

    if flat:
        bad = summed(~known.ok[codes]) > 0
        n_a, n_b, n_groups = (summed(x[codes]) for x in (known.n_a, known.n_b, known.n_groups))
        n = known.n_groups[codes]
        place = np.arange(n.sum()) + np.repeat(known.starts[codes] - _before(n), n)
        distinct, links = np.unique(known.links[place], return_inverse=True)
        owner = np.repeat(np.repeat(np.arange(count), sizes), n)
        keys, times = np.unique(owner * max(1, len(distinct)) + links, return_counts=True)
        owner, links = np.divmod(keys, max(1, len(distinct)))
        whole = ~bad[owner]
        owner, times, pairs = owner[whole], times[whole], distinct[links[whole]]
    else:
        bad, n_a, n_b, n_groups = np.zeros(count, bool), *[np.zeros(count, np.int64)] * 3
        owner = pairs = times = np.zeros(0, np.int64)
    number, groups = codes.tolist(), known.groups
    hashes = [
        hashlib.sha256(b"".join([groups[i] for i in number[a:b]])[:-1]).hexdigest() if b > a and not skip else ""
        for a, b, skip in zip(bounds[:-1].tolist(), bounds[1:].tolist(), bad.tolist())
    ]
    own = np.bincount(owner, minlength=count)
    kept = np.where(bad, 0, 1)
    columns = [
        pa.array([next(numbers) for _ in range(count)], pa.int64()),
        part.column("doc_id"),
        *[pa.array(x * kept, pa.int64()) for x in (n_a, n_b, n_groups)],
        pa.array(hashes, pa.string()),
        _lists(pairs, own),
        _lists(times, own),
    ]
    names = ["row", "doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "pairs", "counts"]
    return pa.RecordBatch.from_arrays(columns, names=names)


def _free_space(text: str, start: int, stop: int, ahead: bool) -> int:
    """The first (or last) place from start to stop of a space that no token crosses, or -1."""
    while True:
        at = text.find(" ", start, stop) if ahead else text.rfind(" ", start, stop)
        if at < 0:
            return -1
        if 0 < at < len(text) - 1 and not text[at - 1].isspace() and not text[at + 1].isspace():
            return at
        start, stop = (at + 1, stop) if ahead else (start, at)


def ranges(text: str, chunk: int) -> Iterator[tuple[str, int, int]]:
    """Byte ranges of a text: what to encode, and the bytes of it (with its space) that tokens
    of the range end after and up to."""
    start = wide = 0
    while start < len(text):
        stop, until = start + chunk, len(text)
        following = (len(text), len(text))
        if stop < len(text):
            back = _free_space(text, max(wide, stop - chunk), stop, ahead=False)
            until = _free_space(text, stop, stop + chunk, ahead=True)
            if back < 0 or until < 0:
                stop = until = _free_space(text, stop, len(text), ahead=True)
                following = (stop, stop)
            else:
                following = (stop, back)
            if until < 0:
                stop = until = len(text)
                following = (stop, stop)
        stop = min(stop, len(text))
        low = len(text[wide:start].encode())
        high = low + len(text[start:stop].encode())
        yield (text[wide + 1 : until], low, high) if wide else (text[:until], low + 1 if start else 0, high + 1)
        start, wide = following


def _cut(chunk: int):
    """Long texts in byte ranges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = _numbers()
        for batch in batches:
            for i in range(batch.num_rows):
                row, found = next(numbers), ranges(batch.column("text")[i].as_py(), chunk)
                for piece, (text, low, high) in enumerate(found):
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([row], pa.int64()),
                            batch.column("doc_id").slice(i, 1),
                            *[pa.array([x], pa.int64()) for x in (piece, low, high)],
                            pa.array([text], pa.string()),
                        ],
                        names=["row", "doc_id", "piece", "low", "high", "text"],
                    )

    return run


_STATE = [x.split()[0] for x in FRAGMENT.split(", ")]
_KINDS = [pa.bool_()] * 2 + [pa.int64()] * 3 + [pa.list_(pa.int32())] * 4 + [pa.binary()] + [pa.list_(pa.int64())] * 2


def _as_row(f: Fragment) -> list[pa.Array]:
    values = [getattr(f, c) for c in _STATE[:10]] + [list(f.pairs), list(f.pairs.values())]
    return [pa.array([v], k) for v, k in zip(values, _KINDS)]


def _fragments(path_a: str, path_b: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Tokenizers(path_a, path_b)
        for batch in batches:
            for i in range(batch.num_rows):
                text, low, high = (batch.column(c)[i].as_py() for c in ("text", "low", "high"))
                own = [batch.column(c).slice(i, 1) for c in ("row", "doc_id", "piece")]
                made = _as_row(known.fragment(text, low, high))
                yield pa.RecordBatch.from_arrays(own + made, names=["row", "doc_id", "piece", *_STATE])

    return run


def _multiplied(group: pa.Table) -> pa.Table:
    """The product of neighbouring fragments, as the next round's fragment."""
    group = group.sort_by("piece")
    product = Fragment()
    for row in group.select(_STATE).to_pylist():
        row["pairs"] = dict(zip(row.pop("pairs"), row.pop("counts")))
        product = product * Fragment(**row)
    own = [group.column(c).slice(0, 1) for c in ("row", "doc_id", "part")]
    return pa.table(own + _as_row(product), names=["row", "doc_id", "piece", *_STATE])


def _finished(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            state = {c: row[c] for c in _STATE[:10]} | {"pairs": dict(zip(row["pairs"], row["counts"]))}
            whole = Fragment(**state).whole()
            digest = hashlib.sha256(whole.groups).hexdigest() if whole.ok else ""
            yield pa.RecordBatch.from_pylist(
                [
                    {
                        "row": row["row"], "doc_id": row["doc_id"], "n_a": whole.n_a, "n_b": whole.n_b,
                        "n_groups": whole.n_groups, "groups_sha256": digest,
                        "pairs": list(whole.pairs), "counts": list(whole.pairs.values()),
                    }
                ],
                schema=pa.schema(
                    [
                        ("row", pa.int64()), ("doc_id", batch.schema.field("doc_id").type), ("n_a", pa.int64()),
                        ("n_b", pa.int64()), ("n_groups", pa.int64()), ("groups_sha256", pa.string()),
                        ("pairs", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64())),
                    ]
                ),
            )


def _long_texts(docs: DataFrame, path_a: str, path_b: str, chunk: int) -> DataFrame:
    """Facts of long texts: ranges in all tasks, then a tree of products."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    pieces = settled(
        docs.mapInArrow(_cut(chunk), f"row long, doc_id {kind}, piece long, low long, high long, text string")
    )
    most = pieces.agg(F.max("piece")).first()[0]
    schema = f"row long, doc_id {kind}, piece long, {FRAGMENT}"
    parts = pieces.repartition("row", "piece").mapInArrow(_fragments(path_a, path_b), schema)
    while most:  # one round at least where a text has two ranges
        parts = parts.withColumn("part", F.expr(f"piece div {FAN}")).groupBy("row", "part").applyInArrow(
            _multiplied, schema
        )
        most //= FAN
    return parts.mapInArrow(_finished, f"row long, doc_id {kind}, {FACTS}")


def alignments(docs: DataFrame, path_a: str, path_b: str, chunk: int | None = None) -> DataFrame:
    """One row a document: doc_id, n_a, n_b, n_groups, groups_sha256, and its distinct links as
    `pairs` (A id << 32 | B id) with `counts`; `row` numbers the rows. Written to the shared folder."""
    spark, chunk = docs.sparkSession, chunk or CHUNK
    docs = docs.select("doc_id", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    long = F.coalesce(F.char_length("text") > chunk, F.lit(False))
    short = docs.where(~long).mapInArrow(_short(path_a, path_b), f"row long, doc_id {kind}, {FACTS}")
    path = f"{shared_folder(spark).rstrip('/')}/alignments-{uuid.uuid4().hex}"
    made = short.unionAll(_long_texts(docs.where(long), path_a, path_b, chunk).withColumn("row", -1 - F.col("row")))
    made.write.parquet(path)
    return spark.read.schema(made.schema).parquet(path)


def pair_counts(facts: DataFrame) -> DataFrame:
    """The links of each id pair over all rows (`total`), and whether no A id has more with its B id (`best`)."""
    pairs = facts.selectExpr("inline(arrays_zip(pairs, counts))").groupBy("pairs").agg(F.sum("counts").alias("total"))
    partners = Window.partitionBy(F.expr("pairs & 4294967295"))  # at most A's vocabulary
    return pairs.withColumn("best", F.col("total") == F.max("total").over(partners))


def scored(facts: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of each row."""
    counted = settled(pair_counts(facts))
    if counted.count() * _PAIR_BYTES <= broadcast_bytes:
        counted = F.broadcast(counted)
    links = facts.selectExpr("row", "inline(arrays_zip(pairs, counts))").join(counted, "pairs")
    sums = links.groupBy("row").agg(
        F.sum("counts").alias("n_links"),
        F.sum(F.when(F.col("best"), F.col("counts")).otherwise(0)).alias("n_best"),
        F.sum(F.col("counts") * F.col("total")).alias("count_sum"),
    )
    zero = F.lit(0).cast("long")
    return facts.drop("pairs", "counts").join(sums, "row", "left").select(
        "doc_id",
        "n_a",
        "n_b",
        "n_groups",
        *[F.coalesce(c, zero).alias(c) for c in ("n_links", "n_best", "count_sum")],
        "groups_sha256",
    )
