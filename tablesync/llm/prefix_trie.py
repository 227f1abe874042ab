"""The trie of conversation prefixes, and totals of its subtrees by time-forward processing.

Conversations are first rebuilt: the first h turns of the first conversation of their block
of 100 ids, then their own turns after the first h (h is a CRC of the id, modulo 6). A node is
a distinct sequence of the first d rebuilt turns. It is known by its depth and two 64-bit
XORs, over its turns, of a hash of place, role and text: prefixes and their digests come
from running windows, a parent's digest from its child's and the child's last turn.

Subtree totals go from the leaves to the root along sorted nodes:

* The trie is cut into fragments. A node's class says how many members it has, by powers of
  `BRANCH`, and its layer how deep it is, by `LAYER` levels; a fragment is what hangs together
  with one class and layer. It has at most BRANCH nodes a level (they have disjoint members)
  and LAYER levels, however wide or deep the trie is, and however many rows share a turn.
* Fragments are dealt to shards by a hash of their root. A shard's nodes are sorted by Spark,
  which spills, in reverse level order; each node takes the messages sent to it out of a
  priority queue, adds its own part and sends the sum to its parent. The queue writes sorted
  runs to an unlinked scratch file of its task when it holds more than `QUEUE` messages.
* What fragment roots send to a parent in another fragment is summed up by parent, and that
  fragment takes it in when its round comes: classes upwards, in a class layers upwards. There
  are few rounds: log(members) / log(BRANCH) times depth / LAYER. Each is written to the
  shared folder, so that lost executors repeat a part of a round.

Running windows take a conversation by slices of `SLICE` turns (by turn number, then by
depth), whose totals are added afterwards, so a very long conversation is spread over tasks.
Turns with one number, or none, stand in order of role, then text; repeated rows each count.
Null roles and texts are empty. Rows without conv_id belong to no conversation and are left
out. An empty table has no nodes. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import pickle
import tempfile
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tablesync.llm.common import settled

#: Members by which a node's class grows by one: 2 ** BRANCH_BITS.
BRANCH_BITS = 10
LAYER = 1 << 16
#: Turns of a conversation in one slice of a running window.
SLICE = 4096
#: Messages that a shard's queue holds in memory.
QUEUE = 1 << 18
#: Member ids (numbers, not members) that one chunk of an id list spans.
CHUNK = 4096
BLOCK, HEAD = 100, 6

_KEY = ["depth", "x1", "x2"]
_NO_IDS = hashlib.sha256(b"").hexdigest()


def _placed(turns: DataFrame) -> DataFrame:
    """The turns with `pos`, their place (from 1) in their conversation."""
    sliced = turns.withColumn("slice", F.expr(f"turn div {SLICE}"))
    sizes = sliced.groupBy("conv", "slice").agg(F.count("*").alias("size"))
    before = Window.partitionBy("conv").orderBy(F.col("slice").asc_nulls_first())
    starts = sizes.select("conv", "slice", (F.sum("size").over(before) - F.col("size")).alias("start"))
    own = Window.partitionBy("conv", "slice").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    numbered = sliced.withColumn("own", F.row_number().over(own)).alias("t")
    same = F.expr("t.conv = s.conv AND t.slice <=> s.slice")
    return numbered.join(starts.alias("s"), same).selectExpr("t.conv", "role", "text", "start + own AS pos")


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The conversations that there are (conv), and their rebuilt turns (conv, depth, role, text)."""
    turns = conversations.where("conv_id IS NOT NULL").selectExpr(
        "CAST(conv_id AS BIGINT) AS conv",
        "CAST(turn AS BIGINT) AS turn",
        "coalesce(role, '') AS role",
        "coalesce(text, '') AS text",
    )
    placed = settled(_placed(turns))
    convs = placed.groupBy("conv").agg(F.max("pos").alias("length"))
    convs = convs.selectExpr(
        "conv", "length", f"conv - conv % {BLOCK} AS base", f"crc32(CAST(conv AS STRING)) % {HEAD} AS head"
    )
    bases = convs.where("conv = base").selectExpr("base", "length AS base_length")
    convs = convs.join(bases, "base", "left").selectExpr(
        "conv", "base", "head", "least(head, coalesce(base_length, 0)) AS taken"
    )
    # At most HEAD - 1 turns of a base, for at most BLOCK conversations.
    heads = placed.where(f"conv % {BLOCK} = 0 AND pos < {HEAD}").withColumnRenamed("conv", "base")
    first = convs.join(heads, "base").where("pos <= head").selectExpr("conv", "pos AS depth", "role", "text")
    rest = placed.join(convs, "conv").where("pos > head").selectExpr(
        "conv", "taken + pos - head AS depth", "role", "text"
    )
    return convs.select("conv"), first.unionAll(rest)


def _paths(turns: DataFrame) -> DataFrame:
    """Each rebuilt turn with the digest of its prefix (x1, x2), of its own turn (t1, t2), and its size."""
    turns = turns.select(
        "conv",
        "depth",
        *[F.xxhash64(F.lit(i), "depth", "role", "text").alias(f"t{i}") for i in (1, 2)],
        F.char_length("text").alias("chars"),
        F.expr(f"(depth - 1) div {SLICE}").alias("slice"),
    )
    totals = turns.groupBy("conv", "slice").agg(*[F.bit_xor(f"t{i}").alias(f"s{i}") for i in (1, 2)])
    upto = Window.partitionBy("conv").orderBy("slice")
    starts = totals.select(
        "conv", "slice", *[F.bit_xor(f"s{i}").over(upto).bitwiseXOR(F.col(f"s{i}")).alias(f"s{i}") for i in (1, 2)]
    )
    own = Window.partitionBy("conv", "slice").orderBy("depth")
    local = turns.select("*", *[F.bit_xor(f"t{i}").over(own).alias(f"r{i}") for i in (1, 2)])
    return local.join(starts, ["conv", "slice"]).select(
        "conv", "depth", "chars", "t1", "t2", *[F.col(f"r{i}").bitwiseXOR(F.col(f"s{i}")).alias(f"x{i}") for i in (1, 2)]
    )


def _nodes(convs: DataFrame, paths: DataFrame) -> DataFrame:
    """One row a node: its key, its parent's digest, its members and the fragment it is in."""
    members = [F.count("*").alias("n_convs"), F.min("conv").alias("conv")]
    same = [F.max(c).alias(c) for c in ("chars", "t1", "t2")]  # one value a node
    nodes = paths.groupBy(*_KEY).agg(*members, *same)
    nodes = nodes.selectExpr(*_KEY, "n_convs", "conv", "chars", "x1 ^ t1 AS p1", "x2 ^ t2 AS p2")
    root = convs.agg(*members).where("n_convs > 0").selectExpr(
        "0L AS depth", "0L AS x1", "0L AS x2", "n_convs", "conv", "0 AS chars", "0L AS p1", "0L AS p2"
    )
    nodes = nodes.unionByName(root)
    return nodes.withColumns(
        {
            "class": F.expr(f"(char_length(bin(n_convs)) - 1) div {BRANCH_BITS}"),
            "layer": F.expr(f"depth div {LAYER}"),
        }
    )


def _in_fragments(nodes: DataFrame, paths: DataFrame) -> DataFrame:
    """The nodes with the key of their fragment's root: the first node with their class and
    layer on the path of their least member."""
    seen = paths.select("conv", *_KEY).join(nodes.select(*_KEY, "class", "layer"), _KEY)
    tops = seen.groupBy("conv", "class", "layer").agg(F.min_by(F.struct(*_KEY), "depth").alias("top"))
    # The root has the empty path. It is the top of all nodes of its class and layer.
    root = nodes.where("depth = 0").selectExpr("class", "layer", "struct(depth, x1, x2) AS root_top")
    return (
        nodes.join(tops, ["conv", "class", "layer"], "left")
        .join(F.broadcast(root), ["class", "layer"], "left")  # one row
        .withColumn("top", F.coalesce("root_top", "top"))
        .drop("root_top")
    )


class SpillingQueue:
    """A priority queue of messages (key, values): least key first, sorted runs on disk beyond `most`."""

    def __init__(self, most: int = QUEUE):
        self.most, self.heap, self.heads, self.file = most, [], [], None

    def push(self, key: tuple, values: tuple) -> None:
        heapq.heappush(self.heap, (key, values))
        if len(self.heap) > self.most:
            self._spill()

    def _spill(self) -> None:
        if self.file is None:
            self.file = tempfile.TemporaryFile()  # has no name: it goes with the task, however that ends
        self.heap.sort()
        blocks, size = [], max(1, self.most // 16)
        for i in range(0, len(self.heap), size):
            start = self.file.seek(0, 2)
            pickle.dump(self.heap[i : i + size], self.file, pickle.HIGHEST_PROTOCOL)
            blocks.append(start)
        self.heap = []
        self._refill(iter(blocks))

    def _refill(self, blocks: Iterator[int]) -> None:
        """The next block of a run; `heads` holds the least message of every run."""
        if (at := next(blocks, None)) is not None:
            self.file.seek(at)
            rest = iter(pickle.load(self.file))
            self._head(next(rest), rest, blocks)

    def _head(self, message: tuple, rest: Iterator[tuple], blocks: Iterator[int]) -> None:
        heapq.heappush(self.heads, (message, len(self.heads), id(rest), rest, blocks))

    def _least(self) -> tuple | None:
        found = [h[0] for h in (self.heap[:1], [x[0] for x in self.heads[:1]]) if h]
        return min(found, default=None)

    def _pop(self) -> tuple:
        if self.heads and (not self.heap or self.heads[0][0] < self.heap[0]):
            message, _, _, rest, blocks = heapq.heappop(self.heads)
            if (following := next(rest, None)) is not None:
                self._head(following, rest, blocks)
            else:
                self._refill(blocks)
            return message
        return heapq.heappop(self.heap)

    def take(self, key: tuple) -> list[tuple]:
        """All messages sent to this key; keys are taken in order."""
        out = []
        while (least := self._least()) and least[0] <= key:
            assert least[0] == key, "a message to a node that is not there"
            out.append(self._pop()[1])
        return out


_FIELDS = [*_KEY, "p1", "p2", "n_convs", "conv", "inside", "own", "children", "leaves", "saved"]


def _shard(queue: int):
    """Time-forward processing of a shard; its rows come in reverse level order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        messages = SpillingQueue(queue)
        for batch in batches:
            columns = {name: batch.column(name).to_pylist() for name in _FIELDS}
            children, leaves, saved = columns["children"], columns["leaves"], columns["saved"]
            for i, (depth, x1, x2, p1, p2, inside, own) in enumerate(
                zip(*(columns[c] for c in ("depth", "x1", "x2", "p1", "p2", "inside", "own")))
            ):
                for more in messages.take((-depth, x1, x2)):
                    children[i] += more[0]
                    leaves[i] += more[1]
                    saved[i] += more[2]
                if not children[i]:
                    leaves[i] = 1
                saved[i] += own
                if inside:
                    messages.push((1 - depth, p1, p2), (1, leaves[i], saved[i]))
            made = [pa.array(columns[c], pa.int64()) for c in ("children", "leaves", "saved")]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in _FIELDS[:9]] + made, names=[*_FIELDS[:9], "children", "leaves", "saved"]
            )

    return run


def subtree_totals(nodes: DataFrame, queue: int = QUEUE) -> DataFrame:
    """The nodes with `children`, and `leaves` and `saved` summed up over their subtrees."""
    nodes = settled(
        nodes.selectExpr(
            *_KEY, "p1", "p2", "n_convs", "conv", "class", "layer", "top",
            "depth > top.depth AS inside", "(n_convs - 1) * chars AS own",
        )
    )
    rounds = nodes.select("class", "layer").distinct().collect()  # a few, see above
    totals = {c: F.lit(0).cast("long") for c in ("children", "leaves", "saved")}
    if not rounds:
        return nodes.select(*_FIELDS[:7]).withColumns(totals)
    names = {"inside": "boolean"}
    schema = ", ".join(f"{c} {names.get(c, 'long')}" for c in [*_FIELDS[:9], *totals])
    done: list[DataFrame] = []
    sent: list[DataFrame] = []
    for kind, layer in sorted(((r["class"], r["layer"]) for r in rounds), key=lambda r: (r[0], -r[1])):
        here = nodes.where((F.col("class") == kind) & (F.col("layer") == layer))
        if sent:
            # Summed up in tasks first: a node may have any number of fragments below it.
            inbox = reduce(DataFrame.unionAll, sent).groupBy(*_KEY).agg(*[F.sum(c).alias(c) for c in totals])
            here = here.join(inbox, _KEY, "left").withColumns({c: F.coalesce(c, zero) for c, zero in totals.items()})
        else:
            here = here.withColumns(totals)
        shards = here.repartition("top").sortWithinPartitions(F.col("depth").desc(), "x1", "x2")
        made = settled(shards.select(*_FIELDS).mapInArrow(_shard(queue), schema))
        done.append(made.drop("inside", "own"))
        sent.append(
            made.where("NOT inside AND depth > 0").selectExpr(
                "depth - 1 AS depth", "p1 AS x1", "p2 AS x2", "1L AS children", "leaves", "saved"
            )
        )
    return reduce(DataFrame.unionAll, done)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's id list, whose chunks come in order."""
    key, digest = None, None
    out: list[tuple] = []

    def flush() -> pa.RecordBatch:
        columns = list(zip(*out)) or [()] * 4
        kinds = [pa.int64()] * 3 + [pa.string()]
        made = pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], names=[*_KEY, "ends_sha256"]
        )
        out.clear()
        return made

    for batch in batches:
        for *now, ids in zip(*(batch.column(c).to_pylist() for c in [*_KEY, "ids"])):
            if now == key:
                digest.update(b",")
            else:
                if key:
                    out.append((*key, digest.hexdigest()))
                key, digest = now, hashlib.sha256()
            digest.update(ids.encode())
        yield flush()
    if key:
        out.append((*key, digest.hexdigest()))
    yield flush()


def _ends(convs: DataFrame, paths: DataFrame) -> DataFrame:
    """By node: the hash of the ids of the conversations that end there, in order.

    Ids are joined by chunks of CHUNK numbers; of a node that very many conversations end in,
    one task then reads a thousandth as many rows, one at a time."""
    last = paths.groupBy("conv").agg(
        F.max("depth").alias("depth"), F.bit_xor("t1").alias("x1"), F.bit_xor("t2").alias("x2")
    )
    zero = F.lit(0).cast("long")
    last = convs.join(last, "conv", "left").select("conv", *[F.coalesce(c, zero).alias(c) for c in _KEY])
    chunks = last.groupBy(*_KEY, F.expr(f"conv div {CHUNK}").alias("chunk")).agg(
        F.expr("array_join(transform(sort_array(collect_list(conv)), c -> CAST(c AS STRING)), ',')").alias("ids")
    )
    ordered = chunks.repartition(*_KEY).sortWithinPartitions(*_KEY, "chunk").select(*_KEY, "ids")
    return ordered.mapInArrow(_hashed, "depth long, x1 long, x2 long, ends_sha256 string")


def trie(conversations: DataFrame, queue: int = QUEUE) -> DataFrame:
    """One row a node: conv_id (its least member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256."""
    convs, turns = rebuilt(conversations)
    convs, paths = settled(convs), settled(_paths(turns))
    nodes = settled(_nodes(convs, paths))
    totals = subtree_totals(_in_fragments(nodes, paths), queue)
    parents = nodes.selectExpr("depth + 1 AS depth", "x1 AS p1", "x2 AS p2", "conv AS parent_conv_id")
    return (
        totals.join(parents, ["depth", "p1", "p2"], "left")
        .join(_ends(convs, paths), _KEY, "left")
        .select(
            F.col("conv").alias("conv_id"),
            "depth",
            "parent_conv_id",
            "n_convs",
            F.col("children").alias("n_children"),
            F.col("leaves").alias("n_leaves"),
            F.col("saved").alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(_NO_IDS)).alias("ends_sha256"),
        )
    )
