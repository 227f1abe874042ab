"""The conversation trie, against a plain one."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from checks.compare import difference
from tablesync.llm import prefix_trie, queries

SCHEMA = "conv_id long, turn long, role string, text string"


def plain(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in turns.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(own):
        h = zlib.crc32(str(c).encode()) % 6
        path = tuple(own.get(c - c % 100, [])[:h] + own[c][h:])
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
        ends[path].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for path in sorted(members, key=len, reverse=True):
        if path:
            saved[path] += (len(members[path]) - 1) * len(path[-1][1])
        leaves[path] = leaves[path] or 1
        if path:
            children[path[:-1]] += 1
            leaves[path[:-1]] += leaves[path]
            saved[path[:-1]] += saved[path]
    return sorted(
        (
            m[0], len(p), members[p[:-1]][0] if p else None, len(m), children[p], leaves[p], saved[p],
            hashlib.sha256(",".join(map(str, ends[p])).encode()).hexdigest(),
        )
        for p, m in members.items()
    )


def found(frame, **options):
    return sorted(map(tuple, prefix_trie.trie(frame, **options).collect()))


def odd_rows(seed=4):
    dice, rows = random.Random(seed), []
    for conv in [*range(0, 40), *range(100, 130), *range(205, 220), 7_000_000_000, 7_000_000_001]:
        for turn in range(dice.choice([1, 2, 3, 4, 6, 9])):
            text = dice.choice(["a", "b", "é", "", None])
            rows.append((conv, dice.choice([turn, turn, turn, None, 1]), dice.choice(["user", "user", None]), text))
    rows += rows[:20]  # repeated rows
    rows += [(None, 1, "user", "x"), (None, None, None, None), (300, None, None, None)]
    return rows + [(350, i, "user", "deep" if i % 7 else "é") for i in range(150)]


@pytest.fixture
def rows():
    return odd_rows()


def test_trie_of_odd_conversations(spark, rows):
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert found(frame) == plain(rows)


def test_many_fragments_slices_and_spills(spark, rows, monkeypatch):
    for name, value in {"BRANCH_BITS": 1, "LAYER": 13, "SLICE": 3, "CHUNK": 4}.items():
        monkeypatch.setattr(prefix_trie, name, value)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert found(frame, queue=1) == plain(rows)


def test_fragments_are_bounded(spark, rows, monkeypatch):
    monkeypatch.setattr(prefix_trie, "BRANCH_BITS", 2)
    monkeypatch.setattr(prefix_trie, "LAYER", 8)
    convs, turns = prefix_trie.rebuilt(spark.createDataFrame(rows, SCHEMA))
    paths = prefix_trie._paths(turns)
    nodes = prefix_trie._in_fragments(prefix_trie._nodes(convs, paths), paths)
    widest = nodes.groupBy("top", "class", "layer", "depth").count().agg(F.max("count")).first()[0]
    assert widest <= 4 and nodes.where("top IS NULL").count() == 0


def test_empty_table_and_other_columns(spark):
    assert found(spark.createDataFrame([], SCHEMA)) == []
    assert found(spark.createDataFrame([(None, 1, "a", "b")], SCHEMA)) == []
    more = "*, 1 as depth, 2 as conv, 3 as x1, 4 as slice, 5 as base, 6 as top"
    rows = [(100, 1, "user", "x"), (101, 1, "user", "x"), (101, 2, "user", "y")]
    assert found(spark.createDataFrame(rows, SCHEMA).selectExpr(*more.split(", "))) == plain(rows)


def test_a_third_of_all_rows_in_one_path(spark):
    rows = [(i, t, "user", f"t{t}") for i in range(400) for t in range(3)]
    rows += [(1000 + i, t, "user", f"{i} {t}") for i in range(200) for t in range(3)]
    assert found(spark.createDataFrame(rows, SCHEMA)) == plain(rows)


def test_queue_spills_and_keeps_order():
    dice = random.Random(1)
    queue, sent = prefix_trie.SpillingQueue(7), defaultdict(list)
    for step in range(300):
        for _ in range(dice.randrange(5)):
            key = (step + 1 + dice.randrange(40), dice.randrange(3))
            queue.push(key, (step,))
            sent[key].append((step,))
        for last in range(3):
            assert sorted(queue.take((step, last))) == sorted(sent.pop((step, last), []))
    assert queue.file is not None


def test_sql(spark, sf_dir):
    name = "op12_prefix_trie"
    assert difference(queries.QUERIES[name](spark, sf_dir), sf_dir, queries.ORACLE[name]) is None
