"""Operators whose results are fixed, against plain versions of them."""

import hashlib
import random
import zlib
from collections import defaultdict

import brute
import numpy as np
import public_tokenizers
import pytest
from brute import ODD
from tokenizers import Tokenizer

from tablesync.llm import packing, quality_rules, sharding, simhash, substring_dedup
from tablesync.llm.common import table
from tablesync.llm.components import components

PATH = public_tokenizers.path("word_bpe_49k.json")


def documents(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs, [tuple(r) for r in docs.select("doc_id", "text").collect()]


def small_words(seed=5):
    dice, rows = random.Random(seed), []
    for i in range(250):
        few = dice.choice([2, 3, 10])
        words = [dice.choice("abcdefghij"[:few]) for _ in range(dice.choice([0, 3, 34, 35, 36, 60, 200]))]
        rows.append((dice.choice([i, i, i, None, 1]), dice.choice([" ", "\n", "\t  "]).join(words) if i % 13 else None))
    return rows + rows[:40]


def removed(frame, **options):
    kept = substring_dedup.remove_repeats(frame, **options)
    return sorted(map(tuple, kept.select("doc_id", "n_words", "n_removed", "kept_sha256").collect()), key=str)


@pytest.mark.parametrize("window, anchor", [(35, 8), (5, 2), (6, 6)])
def test_repeats_of_few_words(texts, window, anchor):
    rows = small_words()
    assert removed(texts(rows), window=window, anchor=anchor) == brute.repeats(rows, window)


def test_repeats_in_documents(spark, sf_dir):
    docs, rows = documents(spark, sf_dir)
    assert removed(docs) == brute.repeats(rows, 35)


def test_repeats_of_odd_texts(texts):
    assert removed(texts(ODD)) == brute.repeats(ODD, 35)
    assert removed(texts(ODD).limit(0)) == []
    one = substring_dedup.remove_repeats(texts(ODD), window=3, anchor=2, keep_layout=True, carry=("count", "n"))
    kept = {(r.doc_id, r.kept_text) for r in one.collect() if r.carried["count"] == 1 and r.carried.n == "x"}
    assert (6, "x" * 20_000) in kept and (4, "d e f") in kept and (4, "") in kept


def test_counts_in_a_task_are_cut_into_parts(texts, monkeypatch):
    monkeypatch.setattr(substring_dedup, "GATHERED", 10)
    rows = small_words(6)
    assert removed(texts(rows, 2)) == brute.repeats(rows, 35)


def test_paths_that_share_half_a_digest_are_told_apart():
    import pyarrow as pa

    paths = substring_dedup._Paths(pa.array(["a b c d e f", "g h", None, "a b c d e f"]), 3, 2)
    own = np.flatnonzero(paths.text == 3)
    digest, second = paths.digest[own].view(np.int64), paths.second[own].view(np.int64)
    row = np.full(2 * len(own), 3)
    lists = np.concatenate((digest, digest)), np.concatenate((second + 1, second))
    found, at = substring_dedup._found(paths, row, *lists)
    assert found.tolist() == own.tolist() and (at >= len(own)).all()
    found, _ = substring_dedup._found(paths, row[: len(own)], digest, second + 1)
    assert not len(found)


def test_near_duplicates_in_documents(spark, sf_dir):
    docs, rows = documents(spark, sf_dir)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.near_duplicates(docs).collect()}
    assert got == brute.linked(rows)


def test_near_duplicates_of_odd_texts(texts):
    got = simhash.near_duplicates(texts(ODD)).collect()
    assert len(got) == len(ODD)
    assert {r.component_id for r in got if r.doc_id in (1, 2, 3, 8)} == {1}
    assert {(r.doc_id, r.component_id) for r in got if r.fingerprint == f"{brute.fingerprint('a b c'):016x}"} == {
        (None, 4), (4, 4),
    }
    kept = simhash.one_of_each(texts(ODD)).select("doc_id", "text").collect()
    # by row: null and repeated ids name no row, and two components may have one least id
    apart = brute.linked(list(enumerate(text for _, text in ODD)))
    assert len(kept) == len({component for _, component in apart.values()})
    assert simhash.near_duplicates(texts(ODD).limit(0)).count() == 0


def test_one_row_of_each_component_is_kept(spark):
    """Null and repeated ids name no row; which row is kept doesn't hang on them alone."""
    dice = random.Random(8)
    unlike = [" ".join(f"{dice.getrandbits(32):x}" for _ in range(40)) for _ in range(16)]
    rows = [(None, t, "x", 1) for t in unlike[:8]] + [(3, t, "x", 1) for t in unlike[8:11]]
    rows += [(i, t, "x", 1) for i, t in enumerate(unlike[11:], 20)]
    rows += [(None, unlike[0], "x", 1)] * 3 + [(None, unlike[1], "w", 2), (3, unlike[8], "w", 2), (9, unlike[2], "y", 1)]
    rows += [(None, unlike[12], "a", 0), (4, unlike[13], "a", 0), (None, None, "b", 0), (None, "", "a", 0), (50, " ", "c", 0)]
    of = brute.linked(list(enumerate(r[1] for r in rows)))
    groups = defaultdict(list)
    for i, row in enumerate(rows):
        groups[of[i][1]].append(row)

    def rank(row):
        doc_id, text, *rest = row
        return doc_id is None, doc_id or 0, text is not None, hashlib.sha256((text or "").encode()).hexdigest(), *rest

    docs = spark.createDataFrame(rows, "doc_id long, text string, `a.b` string, n int").repartition(3)
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns and len(groups) == 17
    assert sorted(map(tuple, kept.collect()), key=str) == sorted((min(g, key=rank) for g in groups.values()), key=str)


def test_one_of_each_of_odd_texts(texts):
    parts = brute.linked(list(enumerate(t for _, t in ODD)))
    kept = [(r.doc_id, r.text) for r in simhash.one_of_each(texts(ODD)).collect()]
    assert len({parts[ODD.index(row)][1] for row in kept}) == len(kept) == len({c for _, c in parts.values()})


@pytest.mark.parametrize("block", [2048, 40])
def test_links_keep_components(spark, monkeypatch, block):
    monkeypatch.setattr(simhash, "BLOCK", block)
    dice = random.Random(2)
    base, prints = [dice.getrandbits(64) for _ in range(12)], set()
    for _ in range(900):
        x = dice.choice(base)
        for _ in range(dice.choice([1, 2, 4, 9])):
            x ^= 1 << dice.choice(range(64) if dice.random() < 0.5 else range(20, 30))
        prints.add(x - (1 << 64) if x >> 63 else x)
    at = {p: p for p in prints}

    def root(x):
        while at[x] != x:
            x = at[x]
        return x

    for i, p in enumerate(sorted(prints)):
        for q in sorted(prints)[i + 1 :]:
            if ((p ^ q) & (1 << 64) - 1).bit_count() <= 3:
                a, b = sorted((root(p), root(q)))
                at[b] = a
    links = simhash.links(spark.createDataFrame([(p,) for p in prints], "print long"))
    got = {r.node: r.root for r in components(links).collect()}
    assert {p: got.get(p, p) for p in prints} == {p: root(p) for p in prints}


@pytest.mark.parametrize("with_ids", [True, False])
@pytest.mark.parametrize("options", [{}, {"length": 64, "open_windows": 3, "min_piece": 5}])
def test_packing_round_trip(spark, sf_dir, texts, with_ids, options):
    _, rows = documents(spark, sf_dir)
    rows = [(1000 + i, t) for i, t in rows[:80]] + [(i, t) for i, (_, t) in enumerate(ODD)]
    length = options.get("length", packing.LENGTH)
    encoder, pieces, windows = Tokenizer.from_file(PATH), defaultdict(list), defaultdict(list)
    for r in packing.pack(texts(rows), PATH, with_ids=with_ids, **options).collect():
        pieces[r.doc_id].append(r)
        windows[r.sequence_id].append(r)
    assert pieces.keys() == {d for d, _ in rows}
    for doc_id, text in rows:
        want = encoder.encode(text or "", add_special_tokens=False).ids + [1]
        at = 0
        for r in sorted(pieces[doc_id], key=lambda r: r.start):
            raw = np.array(want[r.start : r.start + r.length], "<u4").tobytes()
            assert r.start == at and r.doc_tokens == len(want)
            assert bytes(r.ids) == raw if with_ids else r.ids_crc32 == zlib.crc32(raw)
            at += r.length
        assert at == len(want)
    used = []
    for rows_ in windows.values():
        at = 0
        for r in sorted(rows_, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        used.append(at)
    assert max(used) <= length and sum(used) / length > 0.9 * len(used) - 3


def test_ids_of_odd_characters():
    import pyarrow as pa

    dice = random.Random(3)
    signs = ["a", "B", "é", "É", "\u0301", "ß", "İ", "Σ", "漢", "🙂", "<|endoftext|>", "<|", "'s", "12", "½", "\u200b",
             "\u00a0", "\x1c", "\x85", ".", "!!!", "$", "\ufeff", "K", " ", " ", "\n", "\t", "\x00", "the"]
    rows = ["".join(dice.choices(signs, k=dice.choice([0, 1, 5, 40]))) for _ in range(500)] + [None]
    plain = Tokenizer.from_file(PATH)
    for text, ids in zip(rows, packing.Encoder(PATH)(pa.array(rows, pa.string()), 1)):
        assert ids.tolist() == plain.encode(text or "", add_special_tokens=False).ids + [1]


def test_packing_nothing(texts):
    assert packing.pack(texts(ODD).limit(0), PATH).count() == 0


def test_shards(spark, sf_dir, texts, tmp_path):
    _, rows = documents(spark, sf_dir)
    records = sharding.sized(texts(rows + ODD))
    slots = sharding.measured(records)
    path = str(tmp_path / "map")
    sharding.store_map(spark, sharding.new_map(slots, 24), path, 0)
    version, entries = sharding.load_map(spark, path)
    got, held = sharding.assigned(records, entries).collect(), defaultdict(int)
    assert version == 0 and len(got) == len(rows + ODD)
    places = defaultdict(list)
    for r in got:
        places[r.shard].append(r.slot)
        held[r.shard] += r["size"]
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    assert sorted((r["size"], r.text_crc32) for r in got) == sorted(
        (len((t or "").encode()) + 8, brute.crc(t)) for _, t in rows + ODD
    )
    assert max(held.values()) < 1.2 * sum(held.values()) / 24


@pytest.mark.parametrize("parts", [1, 7])
def test_sizes_stay_even_with_a_third_of_all_rows_equal(texts, parts):
    rows = [(i, f"text {i} " * (i % 9)) for i in range(6000)] + [(5, "same text " * 9)] * 3000 + [(None, None)] * 900
    records = sharding.sized(texts(rows, parts))
    entries = sharding.new_map(sharding.measured(records), 24)
    got, held, places = sharding.assigned(records, entries).collect(), defaultdict(int), defaultdict(list)
    for r in got:
        held[r.shard] += r["size"]
        places[r.shard].append(r.slot)
    assert len(got) == len(rows) and all(sorted(p) == list(range(len(p))) for p in places.values())
    assert max(held.values()) < 1.02 * sum(held.values()) / 24
    assert max(e.rows for e in entries) < 20
    # the first of equal rows, and rows that don't repeat, keep their slot
    slots = {(r.doc_id, r.virtual_slot) for r in got}
    alone = sharding.sized(texts(rows[:6001], 2)).collect()
    assert {(r.doc_id, r.virtual_slot) for r in alone} <= slots


def test_a_rebalance_moves_few_slots(spark, tmp_path):
    slots = {i: (100 + i % 7, 1) for i in range(1000)}
    old = sharding.new_map(slots, 10)
    new = sharding.rebalanced(old, slots, 11)
    moved = sum(a.shard != b.shard for a, b in zip(old, new))
    assert {e.shard for e in new} == set(range(11)) and moved < 1.5 * 1000 / 11
    fewer = sharding.rebalanced(old, slots, 9)
    assert {e.shard for e in fewer} == set(range(9))
    for version, entries in enumerate((old, new)):
        sharding.store_map(spark, entries, str(tmp_path), version)
    assert sharding.load_map(spark, str(tmp_path)) == (1, new) and sharding.load_map(spark, str(tmp_path), 0) == (0, old)
    assert sharding.new_map(sharding.measured(sharding.sized(spark.createDataFrame([], "doc_id long, text string"))), 3)


def test_base_rules(spark, sf_dir, texts):
    _, rows = documents(spark, sf_dir)
    rows = rows + [(1000 + i, t) for i, (_, t) in enumerate(ODD)]
    want = dict((d, brute.base_rules(t)) for d, t in rows)
    got = quality_rules.judged(texts(rows)).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.word_chars, r.n_words, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == want[r.doc_id]
        assert not (r.kept and r.base_failed) and r.kept == (not r.base_failed and r.posterior >= 0.5)
    assert quality_rules.judged(texts(ODD).limit(0)).count() == 0
    assert quality_rules.kept_rows(texts(ODD)).columns == texts(ODD).columns


def test_accuracies_by_hand(spark):
    """One round over two patterns, against the formula."""
    names = [f"vote_{r}" for r in quality_rules.RULES]
    rows = [tuple([-1 if n == "vote_symbols" else 0 for n in names] + [40]), tuple([1 if n == "vote_plain" else 0 for n in names] + [60])]
    patterns = spark.createDataFrame(rows, ", ".join(f"{n} int" for n in names) + ", n long")
    model = quality_rules.fit(patterns, rounds=1)
    first = quality_rules.FIRST_ACCURACY
    assert abs(model.accuracy["symbols"] - (40 * first + 10 * first) / 50) < 1e-9
    assert abs(model.accuracy["plain"] - (60 * first + 10 * first) / 70) < 1e-9
    assert abs(model.accuracy["bangs"] - first) < 1e-9
