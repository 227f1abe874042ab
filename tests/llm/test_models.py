"""Operators that learn or search, against labels, planted cases and plain versions."""

import random
import re

import brute
import numpy as np
import pytest
from brute import ODD
from pyspark.sql import functions as F

from tablesync.llm import decontaminate, license_scan, quality_embed, queries, toxicity, url_rules
from tablesync.llm.common import table

SF = "/root/testdata/sf0.01"


def test_quality_on_held_out_labels(spark, texts):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels").withColumnRenamed("quality", "label")
    held = quality_embed.fold() == 2
    model = quality_embed.train(docs, labels.where(~held))
    got = quality_embed.scored(docs, model).join(labels.where(held), "doc_id").collect()
    right = sum((r.score >= 0.7) == (r.label == 1) for r in got)
    assert len(got) > 60 and right / len(got) > 0.93
    odd = quality_embed.scored(texts(ODD), model).collect()
    assert len(odd) == len(ODD) and all(0 <= r.score <= 1 for r in odd)
    nothing = quality_embed.train(docs, labels.limit(0))
    assert {r.score for r in quality_embed.scored(texts(ODD), nothing).select("score").distinct().collect()} == {0.5}
    assert quality_embed.scored(texts(ODD).limit(0), model).count() == 0


def test_toxic_words_are_learned(spark, texts):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels").withColumnRenamed("toxic", "label")
    model = toxicity.train(docs, labels)
    assert list(model.thresholds) == sorted(model.thresholds)
    clean, bad = "Thnt blere ouin the of. " * 30, "you worthless pathetic idiot, moron and trash. "
    planted = [(1, clean), (2, clean + bad), (3, clean + bad * 4)]
    got = {r.doc_id: r for r in toxicity.severities(texts(planted), model).collect()}
    assert not got[1].toxic and got[3].toxic
    assert got[1].expected_severity < got[2].expected_severity <= got[3].expected_severity
    flagged = toxicity.severities(docs, model).join(labels.where("label = 0"), "doc_id")
    assert flagged.where("toxic").count() <= 0.02 * flagged.count()
    assert toxicity.severities(texts(ODD), model).count() == len(ODD)
    none = toxicity.train(docs, labels.where("label = 0"))
    assert toxicity.severities(docs, none).where("toxic").count() == 0


def test_toxic_labels_that_were_held_out(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels").withColumnRenamed("toxic", "label")
    held = quality_embed.fold() == 2
    model = toxicity.train(docs, labels.where(~held))
    got = toxicity.severities(docs, model).join(labels.where(held), "doc_id").collect()
    right = sum(r.toxic == (r.label == 1) for r in got) / len(got)
    # toxic words are English; the five toxic labels on other texts stand on nothing that can be seen there
    english = {r.doc_id for r in docs.where("lang = 'en'").collect()}
    caught = [r.toxic for r in got if r.label == 1 and r.doc_id in english]
    assert len(got) > 60 and right > 0.94 and len(caught) == 9 and all(caught)


@pytest.mark.parametrize("operator", [toxicity, quality_embed])
def test_a_labelled_id_on_many_rows_is_learned_once(spark, operator):
    """A third of all rows has one labelled id; ids may be text."""
    docs = table(spark, SF, "documents").select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    labels = table(spark, SF, "labels").select(F.col("doc_id").cast("string").alias("doc_id"), F.col("toxic").alias("label"))
    one = labels.orderBy("doc_id").first()["doc_id"]
    many = docs.union(spark.range(500).select(F.lit(one), F.concat(F.lit("zq "), "id")))
    least = docs.where(F.col("doc_id") == one).union(many.where("text like 'zq %'"))
    least = least.orderBy(F.xxhash64("text"), "text").limit(1)
    once = docs.where(F.col("doc_id") != one).union(least)
    a, b = operator.train(many, labels), operator.train(once, labels)
    assert np.array_equal(a.weights, b.weights)
    from tablesync.llm.common import sampled_texts

    assert sampled_texts(many, labels.union(labels), 8000).groupBy("doc_id").count().where("count > 1").count() == 0


def test_leaks(spark, sf_dir, texts):
    benchmark = table(spark, sf_dir, "benchmark")
    items = [tuple(r) for r in benchmark.collect()]
    rows = [(10_000 + i, "Zq xv " * 40) for i in range(20)]
    for item, text in items:
        words = text.split()
        changed = [f"zq{i}" if i % 7 == 3 else w for i, w in enumerate(words)]
        rows.append((item, "lorem " * 9 + " ".join(changed).upper() + "!! ipsum" * 9))
        half = len(words) // 2
        rows.append((1000 + item, " ".join([*words[:half], "inserted", *words[half:]])))
    got = decontaminate.leaks(texts(rows), benchmark).collect()
    assert {(r.doc_id % 1000, r.item_id) for r in got} >= {(i, i) for i, _ in items}
    assert {r.doc_id for r in got} == {d for d, _ in rows if d < 10_000}
    assert {r.doc_id % 1000 == r.item_id for r in got} == {True}
    blocks = decontaminate.BLOCK_BYTES
    try:
        decontaminate.BLOCK_BYTES = 2000  # several blocks give the same
        assert sorted(decontaminate.leaks(texts(rows), benchmark).collect()) == sorted(got)
    finally:
        decontaminate.BLOCK_BYTES = blocks
    assert decontaminate.leaks(texts(ODD), benchmark).count() == 0
    assert decontaminate.leaks(texts(rows), benchmark.limit(0)).count() == 0
    assert decontaminate.without_leaks(texts(rows), benchmark).count() == 20


def test_leaks_in_documents(spark, sf_dir):
    """Every run of 13 words that a document shares with an item is found."""
    docs, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    runs = {}
    for item, text in benchmark.collect():
        words = text.lower().split()
        for i in range(len(words) - 12):
            runs.setdefault(tuple(words[i : i + 13]), set()).add((item, len(words)))
    want = set()
    for doc_id, text in docs.select("doc_id", "text").collect():
        words = (text or "").lower().split()
        for i in range(len(words) - 12):
            want |= {(doc_id, item) for item, size in runs.get(tuple(words[i : i + 13]), ())}
    got = {(r.doc_id, r.item_id) for r in decontaminate.leaks(docs, benchmark).collect()}
    assert want <= got


def plain_leaks(rows, items):
    """All diagonals of every pair compared, without seeds."""
    found = set()
    for doc_id, text in rows:
        doc = text.split()
        for item_id, own in ((i, t.split()) for i, t in items):
            covered, run = set(), 0
            for diagonal in range(-len(own) + 1, len(doc)):
                low, high = max(0, -diagonal), min(len(own), len(doc) - diagonal)
                same = [own[i] == doc[diagonal + i] for i in range(low, high)]
                run = max([run, *map(len, "".join("x" if x else " " for x in same).split())])
                if len(own) >= decontaminate.MIN_TOKENS:
                    for a, b in brute.stretches(same, decontaminate.MIN_STRETCH):
                        covered |= {low + i for i in range(a, b) if same[i]}
            least = max(decontaminate.MIN_TOKENS, min(len(own) / 2, decontaminate.ENOUGH_TOKENS))
            if len(covered) >= least or run >= min(len(own), decontaminate.RUN):
                found.add((doc_id, item_id))
    return found


def test_leaks_against_a_full_comparison(spark, texts):
    dice = random.Random(11)
    items = [(i, " ".join(f"t{dice.randrange(900)}" for _ in range(n))) for i, n in enumerate((6, 7, 9, 10, 14, 26, 50, 60))]
    rows = []
    for i in range(160):
        own = dice.choice(items)[1].split()
        a = dice.randrange(max(1, len(own) - 6))
        part = own[a : a + dice.choice([5, 6, 7, 9, 12, 13, 20, 24, 60])]
        part = [w if dice.random() > dice.choice([0, 0, 0.1]) else "zq" for w in part]
        rows.append((i, " ".join(["lorem"] * dice.randrange(5) + part + ["ipsum"] * dice.randrange(5))))
    got = decontaminate.leaks(texts(rows), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id) for r in got} == plain_leaks(rows, items)


@pytest.mark.parametrize("copied", [13, 20, 24])
def test_a_copied_run_of_a_long_item_is_a_leak(spark, texts, copied):
    item = [f"t{i}" for i in range(50)]
    short = [f"s{i}" for i in range(9)]
    benchmark = spark.createDataFrame([(1, " ".join(item)), (2, " ".join(short))], "item_id long, text string")
    rows = [
        (1, " ".join(["a"] * 30 + item[11 : 11 + copied] + ["b"] * 30)), (2, " ".join(["a", *short, "b"])),
        (3, " ".join(item[:12])), (4, " ".join(short[:8])),
    ]
    got = {(r.doc_id, r.item_id) for r in decontaminate.leaks(texts(rows), benchmark).collect()}
    assert got == {(1, 1), (2, 2)}


@pytest.mark.parametrize("rate, least", [(0.05, 1.0), (0.1, 0.97), (0.15, 0.9), (0.2, 0.8)])
def test_recall_by_substitution_rate(spark, texts, rate, least):
    """Words of benchmark items replaced at random."""
    dice = random.Random(3)
    benchmark = table(spark, SF, "benchmark")
    items = [tuple(r) for r in benchmark.collect()]
    rows = []
    for item_id, text in items:
        for _ in range(10):
            words = [f"zq{i}" if dice.random() < rate else w for i, w in enumerate(text.split())]
            rows.append((item_id, " ".join(["lorem"] * 20 + words + ["ipsum"] * 20)))
    frame = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(rows)], "doc_id long, text string")
    got = {(rows[r.doc_id][0], r.doc_id) for r in decontaminate.leaks(frame, benchmark).collect() if rows[r.doc_id][0] == r.item_id}
    assert len(got) / len(rows) >= least


def test_stretches_against_plain_ones():
    dice = random.Random(7)
    for _ in range(400):
        share = dice.choice([0.5, 0.7, 0.9])
        same = [x for _ in range(dice.choice([1, 4, 12])) for x in [dice.random() < share] * dice.choice([1, 2, 5, 9])][:45]
        assert decontaminate._stretches(np.array(same)) == brute.stretches(same, decontaminate.MIN_STRETCH)


@pytest.mark.parametrize("left, replaced, right", [(20, 10, 20), (10, 6, 14), (24, 12, 24)])
def test_a_replaced_block_hides_no_leak(spark, texts, left, replaced, right):
    item = [f"t{i}" for i in range(left + replaced + right)]
    changed = [f"zq{i}" if left <= i < left + replaced else w for i, w in enumerate(item)]
    same = [a == b for a, b in zip(item, changed)]
    benchmark = spark.createDataFrame([(5, " ".join(item))], "item_id long, text string")
    got = decontaminate.leaks(texts([(1, "lorem " * 9 + " ".join(changed) + " ipsum" * 9)]), benchmark).collect()
    found = brute.stretches(same, decontaminate.MIN_STRETCH)
    assert found == [(0, left), (left + replaced, len(item))]
    assert [tuple(r) for r in got] == [(1, 5, left + right, 9, 8 + len(item))]


def test_a_leak_removes_no_other_row_of_its_id(spark, texts):
    item = " ".join(f"t{i}" for i in range(30))
    clean = [(None, "one clean text"), (None, "another"), (None, None), (7, "a clean text of a repeated id"), (8, "")]
    rows = [*clean, (None, f"a {item} b"), (None, f"a {item} b"), (7, item), (9, item)]
    kept = decontaminate.without_leaks(texts(rows), spark.createDataFrame([(1, item)], "item_id long, text string"))
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted(clean, key=str)


def test_licenses(spark, texts):
    dice, rows, want = random.Random(1), [], set()
    for i, (name, wordings) in enumerate(license_scan.TEMPLATES.items()):
        for j, wording in enumerate(wordings):
            filler = lambda n: " ".join(f"w{dice.randrange(500)}" for _ in range(n))
            rows.append((100 * i + j, f"{filler(60)}\n{wording.upper()} {filler(30)}"))
            want.add((100 * i + j, name))
    rows += [(10_000 + i, " ".join(f"w{dice.randrange(500)}" for _ in range(200))) for i in range(30)]
    got = license_scan.licenses(texts(rows + [(20_000 + i, t) for i, (_, t) in enumerate(ODD)])).collect()
    assert {(r.doc_id, r.license) for r in got} == want
    assert all(r.first_word == 60 and r.containment == 1.0 for r in got)
    long = license_scan.TEMPLATES["BSD-3-Clause"][0].split()
    long[8] = "changed"
    near = license_scan.licenses(texts([(1, " ".join(["a"] * 20 + long + ["b"] * 20))])).collect()
    assert [r.license for r in near] == ["BSD-3-Clause"]
    assert license_scan.licenses(texts(ODD)).count() == 0


def test_licenses_in_usual_words(texts):
    bsd = license_scan.TEMPLATES["BSD-3-Clause"]
    changed = bsd[0].split()
    changed[8] = "changed"
    two = license_scan.TEMPLATES["BSD-2-Clause"][1].replace("COPYRIGHT HOLDER OR", "REGENTS OR")
    rows = {
        "Distributed under the MIT License": ["MIT"],
        "Licensed under Apache License 2.0": ["Apache-2.0"],
        " ".join(changed): ["BSD-3-Clause"],
        two: ["BSD-2-Clause"],
        license_scan.TEMPLATES["BSD-3-Clause"][1]: ["BSD-3-Clause"],
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.": ["GPL-3.0"],
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
        "Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your "
        "option) any later version.": ["LGPL-2.1"],
        "You may copy it under the terms of the GNU Affero General Public License v3.": ["AGPL-3.0"],
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.": ["MPL-2.0"],
        "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.": ["ISC"],
        "All text is available under CC BY-SA 4.0 unless noted.": ["CC-BY-SA-4.0"],
        "Code under the MIT License, text under CC BY 4.0": ["CC-BY-4.0", "MIT"],
        "This work is licensed under a Creative Commons Attribution 4.0 International License.": ["CC-BY-4.0"],
        "Eclipse Public License - v 2.0": ["EPL-2.0"],
        "Distributed under the MIT open source License": ["MIT"],
        "Licensed GPLv3": ["GPL-3.0"],
        "Released under Apache 2": ["Apache-2.0"],
        "The MIT press printed it under the license of the city.": [],
    }
    got = license_scan.licenses(texts([(i, f"a b c {text} d e f") for i, text in enumerate(rows)])).collect()
    for i, want in enumerate(rows.values()):
        assert sorted(r.license for r in got if r.doc_id == i) == want, i


def plain_notices(rows, named):
    """Windows of a template's length that hold all of its shingles; the longest win, then the first."""
    out = set()
    for doc_id, text in rows:
        words, found = text.split(), []
        for number, (_, template) in enumerate(named):
            own = template.split()
            size = min(license_scan.SHINGLE, len(own))
            shingles = lambda w: {tuple(w[i : i + size]) for i in range(len(w) - size + 1)}
            for i in range(len(words) - len(own) + 1):
                if shingles(own) <= shingles(words[i : i + len(own)]):
                    found.append((-len(own), i, number, i + len(own) - 1))
        taken = set()
        for _, first, number, last in sorted(found):
            if not taken & set(range(first, last + 1)):
                taken |= set(range(first, last + 1))
                out.add((doc_id, named[number][0]))
    return out


@pytest.mark.parametrize("others", [0, 4500])
def test_notices_against_plain_ones(spark, others):
    """Also among thousands of other templates, first or last in the list."""
    dice = random.Random(5)
    some = lambda n: " ".join(f"v{dice.randrange(7)}" for _ in range(n))
    named = [(f"L{i}", some(n)) for i, n in enumerate([1, 2, 3, 4, 5, 6, 8, 12, 16] * 3)]
    rows = [(f"d{i}", some(dice.choice([0, 1, 2, 5, 20, 60])) + f" {dice.choice(named)[1]} " + some(4)) for i in range(120)]
    rest = {f"other {i}": (f"nothing {i} of this kind",) for i in range(others)}
    ours = {name: (template,) for name, template in named}
    templates = dict([*ours.items()][:20]) | rest | dict([*ours.items()][20:])
    docs = spark.createDataFrame(rows * 2, "doc_id string, text string").repartition(3)
    got = license_scan.licenses(docs, templates, whole={}).collect()
    assert {(r.doc_id, r.license) for r in got} == plain_notices(rows, named)
    assert len(got) == len({(r.doc_id, r.license) for r in got})


def test_templates_beyond_the_bound_are_refused(texts, monkeypatch):
    monkeypatch.setattr(license_scan, "TEMPLATE_BYTES", 10)
    with pytest.raises(ValueError, match="broadcast"):
        license_scan.licenses(texts(ODD), {"A": ("some words of a license",)}, whole={})


def plain_pieces(words, whole):
    """License pieces of which a stretch of as many words holds 0.8 of the 3-word shingles, by a full comparison."""
    tokens = [re.sub(r"[\W_]+", "", w).lower() for w in words]
    tokens = [t for t in tokens if t]
    here = {tuple(tokens[i : i + 3]) for i in range(len(tokens) - 2)}
    found = set()
    for name, text in whole.items():
        for piece in license_scan.pieces(text):
            own = [t for w in piece.split() if (t := re.sub(r"[\W_]+", "", w).lower())]
            own = {tuple(own[i : i + 3]) for i in range(len(own) - 2)}
            if len(own & here) >= 0.8 * len(own):
                found.add(name)
    return found


def test_any_part_of_a_long_license(texts):
    """Whole texts and 300 words from anywhere of each, as they are and with 2 words of each 90 changed."""
    dice, whole = random.Random(3), license_scan.whole_texts()
    rows, want = [], []
    for name, text in whole.items():
        words = text.split()
        rows.append(text)
        want.append((name, words))
        for changed in (0, 2):
            for _ in range(8):
                at = dice.randrange(max(1, len(words) - 300))
                part = words[at : at + 300]
                for start in range(0, len(part), 90):
                    for place in dice.sample(range(start, min(start + 90, len(part))), min(changed, len(part) - start)):
                        part[place] = "replaced"
                rows.append(" ".join(["a"] * 30 + part + ["b"] * 30))
                want.append((name, part))
    got = license_scan.licenses(texts(list(enumerate(rows)))).collect()
    found = {i: {r.license for r in got if r.doc_id == i} for i in range(len(rows))}
    for i, (name, words) in enumerate(want):
        fits = plain_pieces(words, whole)
        assert name in fits and found[i] & fits, (i, name, found[i], fits)  # shared wording may be another's
    own = [name in found[i] for i, (name, _) in enumerate(want)]
    assert sum(own) >= 0.9 * len(own), [(want[i][0], found[i]) for i, hit in enumerate(own) if not hit]
    assert all(found[i] == {"Apache-2.0"} for i, (name, _) in enumerate(want) if name == "Apache-2.0")


def test_fixed_url_rules(spark):
    rules = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("com", "/de/", "block")]
    urls = [
        (1, "http://A.Example.ORG/es/x?q#f", "a.example.org", "/es/x", "example.org/es/", "block"),
        (2, "https://example.org", "example.org", "", None, "allow"),
        (3, "https://other.org/x#/es/", "other.org", "/x", "org/", "allow"),
        (4, "x://notexample.org/es/1", "notexample.org", "/es/1", "org/", "allow"),
        (5, None, "", "", None, "allow"), (6, "no scheme", "", "", None, "allow"), (6, "no scheme", "", "", None, "allow"),
        (7, "a://b.com/de/?x=http://c.org/", "b.com", "/de/", "com/de/", "block"),
    ]
    pages = spark.createDataFrame([u[:2] for u in urls], "page_id long, url string")
    got = url_rules.judged(pages, rules).select("page_id", "url", "host", "path", "rule", "verdict").collect()
    assert sorted(map(tuple, got), key=str) == sorted(urls, key=str)
    assert url_rules.judged(pages.limit(0), rules).count() == 0


def test_copies_of_a_table_give_the_same_verdicts(spark):
    pages = table(spark, SF, "pages").select("page_id", "url")
    copies = pages.join(spark.range(30).withColumnRenamed("id", "copy"))
    verdicts = lambda frame: {tuple(r) for r in url_rules.judged(frame, queries.URL_RULES).select("url", "verdict", "mined").collect()}
    once = verdicts(pages)
    assert once == verdicts(copies) and any(mined for _, _, mined in once)


def test_columns_named_like_results(spark):
    rows = [(1, "http://b.com/de/x", 7, 8, 9, 10, 11)]
    pages = spark.createDataFrame(rows, "page_id long, url string, Host int, tokens int, rule_verdict int, page int, count int")
    (row,) = url_rules.judged(pages, [("com", "/de/", "block")]).collect()
    assert row.asDict() == {
        "page_id": 1, "url": "http://b.com/de/x", "tokens": 8, "rule_verdict": 9, "page": 10, "count": 11,
        "host": "b.com", "path": "/de/x", "rule": "com/de/", "verdict": "block", "mined": False,
    }


def test_mined_rules_by_hand(spark):
    """Every frequent token set is counted plainly; the rules that fire must agree."""
    from itertools import combinations

    dice, rows = random.Random(4), []
    for i in range(300):
        names = sorted({dice.choice("abc"), dice.choice("de"), dice.choice("fg")})
        rows.append((names, "block" if {"a", "d"} <= set(names) else dice.choice(["allow"] * 9 + ["block"])))
    frame = spark.createDataFrame(rows, "tokens array<string>, label string")
    rules = url_rules.mined(frame, support=0.1, confidence=0.9)
    got = {tuple(r.antecedent) for r in rules.where("label = 'block'").collect()}
    want = {}
    for n in (1, 2, 3):
        for names in combinations("abcdefg", n):
            held = [label for tokens, label in rows if set(names) <= set(tokens)]
            both = held.count("block")
            if both >= 30 and both / len(held) >= 0.9:
                want[names] = both / len(held)
    want = {
        k for k, sure in want.items() if not any(want.get(tuple(x for x in k if x != t), 0) >= sure for t in k)
    }
    assert got == want and ("a", "d") in got
    fired = {tuple(r.tokens) for r in url_rules.fired(frame, rules, "block").collect()}
    assert fired == {tuple(t) for t, _ in rows if any(set(k) <= set(t) for k in want)}
    assert url_rules.mined(frame.limit(0)).count() == 0
