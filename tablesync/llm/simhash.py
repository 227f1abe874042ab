"""SimHash near-dedup: fingerprints of word shingles, linked by pigeonring filtering.

Two fingerprints within 3 bits differ in a ring of four 16-bit segments by d0..d3 with a sum
of at most 3. Then from some segment on, every chain of 1, 2, 3, 4 consecutive segments has a
cumulative difference of at most 0, 1, 2, 3 (its share of the budget). The first two shares
are a join key: the segment itself, and three of the four parts of the next one, of which at
most one bit may differ. The longer chains prune what shares a key, before the full check.

Only distinct fingerprints are compared. Those that share a key are linked by a spanning
forest, not by all pairs: components stay whole and links stay fewer than fingerprints. A key
that more than `BLOCK` fingerprints share is dealt out as pairs of blocks, each a task's row
group of its own, so that every two of them still meet.

Nulls and texts without words have fingerprint zero and are linked like any other. Repeated
rows and equal texts share a fingerprint and a component. A null id never is a component's
id, unless all ids of the component are null. Other columns are ignored.

Of each component `one_of_each` keeps the row with the least id (nulls last), text digest and
other columns. Rows are found again by id and digest, as ids may be null or repeated; each task
sends one row of each such pair at most.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tablesync.llm.common import settled, signed
from tablesync.llm.components import components

SHINGLE = 3
SEED = 42
#: Differing bits of linked fingerprints. The segments and the budgets of chains follow from it.
BITS = 3
#: Distinct fingerprints that share a key and are compared in one group.
BLOCK = 2048

_SEGMENTS, _WIDTH = 4, 16
_FEW = 8
_CHUNK = 1 << 16


def _fingerprint(text: str | None) -> bytes:
    words = (text or "").encode().lower().split()
    if not words:
        return bytes(8)
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    last = min(SHINGLE, len(words)) - 1
    starts = (ends - lengths)[: len(words) - last].tolist()
    digest = xxhash.xxh64_digest
    hashes = b"".join([digest(joined[a:b], SEED) for a, b in zip(starts, ends[last:].tolist())])
    rows = np.frombuffer(hashes, np.uint8).reshape(-1, 8)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(rows), _CHUNK):
        ones += np.unpackbits(rows[at : at + _CHUNK], axis=1).sum(axis=0, dtype=np.uint32)
    return np.packbits(2 * ones > len(rows)).tobytes()


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = b"".join(_fingerprint(text.as_py()) for text in batch.column("text"))
        values = np.frombuffer(prints, ">u8").astype(np.uint64)
        yield pa.record_batch({"doc_id": batch.column("doc_id"), "print": signed(values)})


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, of any type; print: the 64 bits as a signed long), one row per row of `docs`."""
    read = docs.select("doc_id", "text")
    return read.mapInArrow(_fingerprints, StructType([read.schema["doc_id"], StructField("print", LongType())]))


def _keys() -> Column:
    """The keys under which a fingerprint may meet others: chains of two segments, one part left out."""
    segment = [F.shiftrightunsigned("print", _WIDTH * i).bitwiseAND(0xFFFF) for i in range(_SEGMENTS)]
    keys = []
    for i in range(_SEGMENTS):
        follower = segment[(i + 1) % _SEGMENTS]
        for part in range(4):
            kept = follower.bitwiseAND(0xFFFF ^ (0xF << 4 * part))
            number = F.lit(i * 4 + part).cast("long")
            keys.append(F.shiftleft(number, 32).bitwiseOR(F.shiftleft(segment[i], 16)).bitwiseOR(kept))
    return F.array(*keys)


def _near(one: np.ndarray, other: np.ndarray, first: np.ndarray | int) -> np.ndarray:
    """Which pairs keep to the budgets of the chains from segment `first` on."""
    differ = one ^ other
    turn = np.asarray(first, np.uint64) * np.uint64(_WIDTH)
    differ = (differ >> turn) | (differ << (np.uint64(64) - turn) % np.uint64(64))
    near = np.ones(np.shape(differ), bool)
    for chain in range(1, _SEGMENTS + 1):
        mask = np.uint64((1 << _WIDTH * chain) - 1)
        near &= np.bitwise_count(differ & mask) <= chain * BITS // _SEGMENTS
    return near


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows sorted by (key, pair), the links within each group."""
    kept: list[pa.RecordBatch] = []

    def linked(rows: pa.Table) -> pa.RecordBatch:
        key, pair = rows["key"].to_numpy(), rows["pair"].to_numpy()
        prints = rows["print"].to_numpy().view(np.uint64)
        new = np.flatnonzero(np.concatenate(([True], (key[1:] != key[:-1]) | (pair[1:] != pair[:-1]))))
        size = np.diff(np.append(new, len(key)))
        group = np.repeat(np.arange(len(new)), size)
        few = size[group] <= _FEW
        a, b = [], []
        for step in range(1, _FEW):
            at = np.flatnonzero((group[step:] == group[:-step]) & few[:-step])
            at = at[_near(prints[at], prints[at + step], key[at] >> 34)]
            a.append(prints[at])
            b.append(prints[at + step])
        for start, n in zip(new[size > _FEW].tolist(), size[size > _FEW].tolist()):
            for tree in _trees(prints[start : start + n], int(key[start]) >> 34):
                a.append(tree)
                b.append(np.full(len(tree), tree[0], np.uint64))
        return pa.record_batch({"a": signed(np.concatenate(a)), "b": signed(np.concatenate(b))})

    for batch in batches:
        if not batch.num_rows:
            continue
        kept.append(batch)
        rows = pa.Table.from_batches(kept)
        last = (rows["key"][-1].as_py(), rows["pair"][-1].as_py())
        open_ = int(((rows["key"].to_numpy() == last[0]) & (rows["pair"].to_numpy() == last[1])).sum())
        if open_ < rows.num_rows:
            yield linked(rows.slice(0, rows.num_rows - open_))
            kept = rows.slice(rows.num_rows - open_).to_batches()
    if kept:
        yield linked(pa.Table.from_batches(kept))


def _trees(prints: np.ndarray, first: int) -> Iterator[np.ndarray]:
    """The members of each tree of near fingerprints with two members or more."""
    rest = prints
    while len(rest):
        tree, frontier, rest = [rest[:1]], [rest[0]], rest[1:]
        while frontier and len(rest):
            near = _near(rest, frontier.pop(), first)
            if near.any():
                tree.append(rest[near])
                frontier.extend(rest[near])
                rest = rest[~near]
        if len(tree) > 1:
            yield np.concatenate(tree)


def links(prints: DataFrame) -> DataFrame:
    """Links (a, b) between the distinct fingerprints `print`, that keep all components whole."""
    keyed = prints.select("print", F.explode(_keys()).alias("key"))
    large = (
        keyed.groupBy("key").count().where(F.col("count") > BLOCK)
        .select("key", F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks"))
    )
    blocks = F.coalesce("blocks", F.lit(1))
    own = F.pmod(F.xxhash64("print"), F.col("n"))
    dealt = (
        keyed.join(large, "key", "left")
        .select("key", "print", blocks.alias("n"))
        .withColumn("own", own)
        .withColumn("with", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n").cast("long") - 1)))
        .select("key", "print", (F.least("own", "with") * F.col("n") + F.greatest("own", "with")).alias("pair"))
    )
    return (
        dealt.repartition("key", "pair")
        .sortWithinPartitions("key", "pair")
        .mapInArrow(_links, "a long, b long")
        .distinct()
    )


def _least(marked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(print, doc_id, root) of the fingerprints of `marked`, and (root, component_id: the least id) of components."""
    prints = settled(marked.groupBy("print").agg(F.min("doc_id").alias("doc_id")))
    roots = components(links(prints.select("print"))).withColumnRenamed("node", "print")
    rooted = prints.join(roots, "print", "left").withColumn("root", F.coalesce("root", "print"))
    return rooted, rooted.groupBy("root").agg(F.min("doc_id").alias("component_id"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per row of `docs` (doc_id, text): doc_id, fingerprint, component_id."""
    marked = settled(fingerprints(docs))
    rooted, least = _least(marked)
    labels = rooted.join(least, "root").select("print", "component_id")
    return marked.join(labels, "print").select(
        "doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id"
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """One row of `docs` for each component: the one with the least id (nulls last), text digest and other columns."""
    digest = F.sha2(F.col("text").cast("binary"), 256)
    key = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", digest.alias("digest"))
    _, least = _least(fingerprints(docs.select(key.alias("doc_id"), "text")))
    columns = [c for c in docs.columns if c not in ("doc_id", "text")] + ["text"]
    row = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns)])
    rows = docs.select(key.alias("key"), row.alias("row")).groupBy("key").agg(F.min("row").alias("row"))
    kept = rows.join(least.select(F.col("component_id").alias("key")), "key", "left_semi")
    found = {c: F.col(f"row.c{i}") for i, c in enumerate(columns)} | {"doc_id": F.col("key.doc_id")}
    return kept.select(*[found[c].alias(c) for c in docs.columns])
