"""License scans: MinHash bands over overlapping text windows, verified by shingle containment.

Texts and templates are tokens (letters and digits of words, without case). Shingles are
`SHINGLE` tokens, or a whole template of fewer. A template of fewer than `PASSAGE` tokens is a
one-line notice, whose every word may name another license, so all of its shingles must be found,
in a window of as many tokens. Longer ones are passages, of which a share `CONTAINED` is enough:
from that length on, it bears one changed word; their windows have the template's length, rounded
up by at most a half. Windows stand at every place of every text. A band is one hash function:
window and template collide if their least values under it agree. A window that holds what is
demanded of a template has at least a known Jaccard similarity j with it, so each template has the
least number of bands for which 1 - (1 - j) ** bands is `FOUND`; a notice needs one. A
collision is only a candidate; it counts if the window truly holds those shingles.

Whole license texts are cut into pieces of `PIECE` words that overlap by half, each a passage
like the others, so any `PIECE` + `PIECE` / 2 words in a row of a license hold a whole piece and
are found wherever they come from. A piece that several licenses share, or nearly, counts for the
one named first, unless the others' piece holds more of the text.

Templates are the query side: a list that the caller holds, broadcast whole; one of more than
`TEMPLATE_BYTES` of text is refused. Texts aren't shuffled. Each document returns its best window per
passage and all of its notices; of those that overlap, the one of which most tokens are found
stays, so near variants of one license give one row.

Null and empty texts hold no template. Templates without a token are refused. The templates are
those of `license_texts`; a license that they don't word isn't found. Ids may be of any type that
can be grouped. Repeated rows and ids are each scanned; a pair of id and license is returned once.
Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tablesync.llm.common import mixed, sliding_least, slices, tokens_of
from tablesync.llm.license_texts import TEMPLATES, whole_texts

SHINGLE = 3
#: Tokens from which on a template is a passage: of its shingles, one changed word leaves `CONTAINED`.
PASSAGE = 17
CONTAINED = 0.8
#: Words of a piece of a whole license.
PIECE = 90
#: Chance that a window which holds a template becomes a candidate, at least.
FOUND = 0.999
#: Bytes of all templates' text, at most.
TEMPLATE_BYTES = 64 << 20
#: Places of a text that are looked at together.
PLACES = 2048


def _shingles(tokens: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    n = max(len(tokens) - size + 1, 0)
    total = np.zeros(n, np.uint64)
    for place in range(size):
        total = total * np.uint64(0x9E3779B97F4A7C15) + tokens[place : place + n]
    return mixed(total)


def _among(values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Where `values` are among the few `wanted`, by their upper bits first."""
    present = np.zeros(1 << 16, bool)
    present[wanted >> np.uint64(48)] = True
    at = np.flatnonzero(present[values >> np.uint64(48)])
    return at[np.isin(values[at], wanted)]


def _hashed(shingles: np.ndarray, band: int) -> np.ndarray:
    product = shingles * (mixed(np.array([band + 1], np.uint64)) | np.uint64(1))
    return product ^ (product >> np.uint64(32))


@dataclass(frozen=True)
class _Template:
    """`width`: shingles of a window; `needed`: those of the template that it must hold."""

    license: str
    shingles: np.ndarray  # sorted, distinct
    width: int
    needed: int
    bands: int
    is_notice: bool

    @classmethod
    def of(cls, license: str, tokens: np.ndarray) -> tuple[int, _Template]:
        """The template and the size of its shingles."""
        size = min(SHINGLE, len(tokens))
        own = np.unique(_shingles(tokens, size))
        is_notice, length, needed = len(tokens) < PASSAGE, len(tokens), len(own)
        if not is_notice:
            length, needed = SHINGLE, ceil(CONTAINED * len(own))
            while length < len(tokens):
                length = length + length // 2
        width = length - size + 1
        similar = needed / (width + len(own) - needed)
        bands = ceil(log(1 - FOUND) / log(1 - similar)) if similar < 1 else 1
        return size, cls(license, own, width, needed, bands, is_notice)


@dataclass(frozen=True)
class _Group:
    """The templates whose shingles have one size, and all these shingles, one template's after another's."""

    size: int
    numbers: list[int]  # of the templates among all
    templates: list[_Template]
    flat: np.ndarray
    starts: np.ndarray
    distinct: np.ndarray

    @classmethod
    def of(cls, size: int, numbered: list[tuple[int, _Template]]) -> _Group:
        numbers, templates = map(list, zip(*numbered))
        flat = np.concatenate([t.shingles for t in templates])
        starts = np.cumsum([0] + [len(t.shingles) for t in templates[:-1]])
        return cls(size, numbers, templates, flat, starts, np.unique(flat))

    def candidates(self, shingles: np.ndarray, places: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(template, places of windows) that collide in a band; `places`: where known shingles are.

        Windows with too few places of the template's shingles, repeats counted, are left out."""
        order = np.argsort(shingles[places], kind="stable")
        known, at = shingles[places][order], places[order]
        first, end = np.searchsorted(known, self.flat), np.searchsorted(known, self.flat, "right")
        there = np.add.reduceat((end > first).astype(np.int64), self.starts)
        for t in np.flatnonzero(there >= [t.needed for t in self.templates]).tolist():
            template, begin = self.templates[t], self.starts[t]
            width = template.width
            low, high = first[begin:][: len(template.shingles)], end[begin:][: len(template.shingles)]
            held = np.sort(np.concatenate([at[a:b] for a, b in zip(low.tolist(), high.tolist())]))
            found = [np.zeros(0, np.int64)]
            for band in range(template.bands):
                own = _hashed(template.shingles, band)
                least = int(own.argmin())
                # a window can only have this least value around a place of the shingle that gives it
                near = at[low[least] : high[least]]
                many = np.searchsorted(held, near + width) - np.searchsorted(held, near - width + 1)
                near = near[many >= template.needed]
                for start in range(0, len(near), PLACES):
                    grid = near[start : start + PLACES] + np.arange(1 - width, width)[:, None]
                    # a window may run over the end of all texts, not over its own text's in what is verified
                    inside = (grid >= 0) & (grid < len(shingles))
                    values = _hashed(shingles[np.where(inside, grid, 0)], band)
                    values[~inside] = np.iinfo(np.uint64).max
                    collide = (sliding_least(values, width) == own[least]) & inside[:width]
                    found.append(grid[:width][collide])
            windows = np.unique(np.concatenate(found))
            many = np.searchsorted(held, windows + width) - np.searchsorted(held, windows)
            yield t, windows[many >= template.needed]


class _Texts:
    """Shingles of one size of all texts: whose they are, and which are known."""

    def __init__(self, tokens: np.ndarray, bounds: np.ndarray, group: _Group):
        self.shingles = _shingles(tokens, group.size)
        self.text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))[: len(self.shingles)]
        self.last = bounds[1:][self.text] - group.size  # the last whole shingle of the place's text
        at = _among(self.shingles, group.distinct)
        self.places = at[at <= self.last[at]]
        self.known = np.zeros(len(self.shingles), bool)
        self.known[self.places] = True

    def notices(self, template: _Template, windows: np.ndarray) -> np.ndarray:
        """The windows that hold every shingle of a notice."""
        windows = windows[windows + template.width - 1 <= self.last[windows]]
        held = np.ones(len(windows), bool)
        grid = self.shingles[windows + np.arange(template.width)[:, None]]
        for shingle in template.shingles:
            held &= (grid == shingle).any(axis=0)
        return windows[held]

    def passages(self, template: _Template, windows: np.ndarray, size: int) -> dict[int, tuple]:
        """The best window of each text: (containment, tokens found, first token, last token)."""
        best: dict[int, tuple] = {}
        own = template.shingles
        for place in windows[windows <= self.last[windows]].tolist():
            stop = min(place + template.width, int(self.last[place]) + 1)
            inside = np.flatnonzero(self.known[place:stop]) + place
            inside = inside[np.isin(self.shingles[inside], own)]
            n = len(np.unique(self.shingles[inside]))
            if n >= template.needed:
                hit = (n / len(own), n + size - 1, int(inside[0]), int(inside[-1]) + size - 1)
                doc = int(self.text[place])
                if doc not in best or (hit[0], -hit[2]) > (best[doc][0], -best[doc][2]):
                    best[doc] = hit
        return best


@dataclass(frozen=True)
class Scanner:
    """All templates, by the size of their shingles."""

    names: list[str]
    groups: list[_Group]

    @classmethod
    def of(cls, named: list[tuple[str, str]]) -> Scanner:
        sized: dict[int, list[tuple[int, _Template]]] = {}
        for number, (name, text) in enumerate(named):
            tokens, _, _ = tokens_of(pa.array([text]), {})
            if not len(tokens):
                raise ValueError(f"a template of {name} has no token")
            size, template = _Template.of(name, tokens)
            sized.setdefault(size, []).append((number, template))
        return cls([name for name, _ in named], [_Group.of(size, of) for size, of in sized.items()])

    def hits(self, tokens: np.ndarray, bounds: np.ndarray) -> list[tuple[int, int, float, int, int]]:
        """(text, template, containment, first token, last token); none overlap."""
        found = []
        for group in self.groups:
            texts = _Texts(tokens, bounds, group)
            if not len(texts.places):
                continue
            for t, windows in group.candidates(texts.shingles, texts.places):
                template, number = group.templates[t], group.numbers[t]
                if template.is_notice:
                    size = template.width + group.size - 1
                    for place in texts.notices(template, windows).tolist():
                        found.append((size, 1.0, int(texts.text[place]), place, place + size - 1, number))
                else:
                    for doc, (share, n, first, end) in texts.passages(template, windows, group.size).items():
                        found.append((n, share, doc, first, end, number))
        taken, kept = np.zeros(len(tokens), bool), []
        for _, share, doc, first, end, number in sorted(found, key=lambda x: (x[2], -x[0], -x[1], x[3], x[5])):
            if not taken[first : end + 1].any():
                taken[first : end + 1] = True
                kept.append((doc, number, share, first, end))
        return kept


def _scan(scanner):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, int] = {}
        for batch in batches:
            for part in slices(batch):
                tokens, bounds, word = tokens_of(part.column("text"), known)
                hits = scanner.value.hits(tokens, bounds)
                docs, numbers, shares, first, end = map(list, zip(*hits)) if hits else ([],) * 5
                columns = [
                    part.column("doc_id").take(pa.array(docs, pa.int64())),
                    pa.array([scanner.value.names[n] for n in numbers], pa.string()),
                    pa.array(shares, pa.float64()),
                    pa.array(word[np.array(first, np.int64)], pa.int64()),
                    pa.array(word[np.array(end, np.int64)], pa.int64()),
                ]
                yield pa.record_batch(columns, ["doc_id", "license", "containment", "first_word", "last_word"])

    return run


def pieces(text: str, size: int = PIECE) -> list[str]:
    """Overlapping runs of words, all of full size if the text has so many; the last ends with the text."""
    words = text.split()
    starts = [*range(0, max(1, len(words) - size), max(1, size // 2)), max(0, len(words) - size)]
    return [" ".join(words[at : at + size]) for at in dict.fromkeys(starts)]


def licenses(
    docs: DataFrame,
    templates: dict[str, tuple[str, ...]] = TEMPLATES,
    whole: dict[str, str] | None = None,
) -> DataFrame:
    """(doc_id, license, containment, first_word, last_word): one row per document and license found.

    ``whole``: license texts to be found by any piece; those of `license_texts` if not given."""
    named = [(name, text) for name, texts in templates.items() for text in texts]
    named += [(name, piece) for name, text in (whole_texts() if whole is None else whole).items() for piece in pieces(text)]
    if not named:
        raise ValueError("there must be a template")
    size = sum(len(text.encode()) for _, text in named)
    if size > TEMPLATE_BYTES:
        raise ValueError(f"templates of {size} bytes; at most {TEMPLATE_BYTES} can be broadcast")
    scanner = docs.sparkSession.sparkContext.broadcast(Scanner.of(named))
    kind = docs.schema["doc_id"].dataType.simpleString()
    found = docs.select("doc_id", "text").mapInArrow(
        _scan(scanner), f"doc_id {kind}, license string, containment double, first_word long, last_word long"
    )
    best = F.max(F.struct("containment", (-F.col("first_word")).alias("before"), "last_word"))
    return found.groupBy("doc_id", "license").agg(best.alias("best")).select(
        "doc_id",
        "license",
        "best.containment",
        (-F.col("best.before")).alias("first_word"),
        "best.last_word",
    )
