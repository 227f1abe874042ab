"""Lines of many documents, against a plain count."""

import hashlib
import random
import re
import uuid
from collections import Counter

from brute import ODD
from pyspark.sql import functions as F

from checks.compare import difference
from tablesync.llm import line_dedup, queries

_UPPER = re.compile("[A-Z]")


def key_of(line):
    return _UPPER.sub(lambda m: m[0].lower(), line.strip(" \t\x0b\x0c\r"))


def plain(rows, least_docs=10, least_chars=1):
    counts = Counter(k for _, t in rows for k in {key_of(x) for x in (t or "").split("\n")} if len(k) >= least_chars)
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if counts[key_of(x)] < least_docs]
        out.append((doc_id, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def found(frame):
    return sorted(map(tuple, frame.select("doc_id", "n_lines", "n_dropped", "kept_sha256").collect()), key=str)


def few_lines(seed=3):
    dice, rows = random.Random(seed), []
    some = ["Menu", " menu\t", "É", "é", " Menu", "a b", "", " ", "A\x0b", "x" * 9000, "Straße", "STRASSE", "ſ", "K"]
    for i in range(120):
        lines = [dice.choice(some) if dice.random() < 0.4 else f"line {dice.randrange(400)}" for _ in range(dice.randrange(9))]
        rows.append((dice.choice([i, 1, None]), dice.choice(["\n", "\r\n"]).join(lines) if i % 11 else None))
    return rows + rows[:30] + ODD


def test_lines_of_odd_texts(texts):
    rows = few_lines()
    for least_docs, least_chars, batches in [(10, 1, 5), (2, 3, 1), (3, 1, 8)]:
        got = line_dedup.deduped(texts(rows), least_docs, least_chars, batches)
        assert found(got) == plain(rows, least_docs, least_chars)


def test_empty_table_and_other_columns(texts):
    assert found(line_dedup.deduped(texts(ODD).limit(0))) == []
    frame = texts(ODD).selectExpr("*", "1 as h1", "2 as d1", "3 as lines", "4 as gone", "5 as batch", "6 as n_docs")
    got = line_dedup.deduped(frame, 2, 1, 3, carry=("h1", "lines", "gone"))
    assert found(got) == plain(ODD, 2)
    assert {tuple(r.carried) for r in got.collect()} == {(1, 3, 4)}


def test_a_third_of_all_rows_with_one_line_and_one_text(texts):
    rows = [(i, "shared\nown %d" % i) for i in range(300)] + [(i, "same\ntext\nshared") for i in range(300)]
    assert found(line_dedup.deduped(texts(rows, 9))) == plain(rows)


def test_runs_are_compacted_found_again_and_dropped(spark, texts):
    name = f"t_{uuid.uuid4().hex[:12]}"
    rows = few_lines(8)
    for number in range(9):  # every batch by an index opened anew
        runs = line_dedup.LineRuns(spark, name, least_docs=4, buckets=3)
        runs.add(line_dedup.line_keys(texts([r for i, r in enumerate(rows) if i % 9 == number])))
    assert runs.runs == [(0, 7), (8, 8)]
    # a run that a compaction left behind
    runs._write(spark.createDataFrame([(1, 2, 9, True)], "h1 long, h2 long, n_docs long, common boolean"), (2, 3))
    runs = line_dedup.LineRuns(spark, name, least_docs=4)
    assert runs.runs == [(0, 7), (8, 8)] and runs.buckets == 3
    assert found(line_dedup.without_lines(texts(rows), runs.common())) == plain(rows, 4)
    runs.drop()
    assert line_dedup.LineRuns(spark, name).runs == []


def test_a_batch_meets_the_runs_without_moving_them(spark, texts):
    runs = line_dedup.LineRuns(spark, f"t_{uuid.uuid4().hex[:12]}", least_docs=2, buckets=4)
    runs.add(line_dedup.line_keys(texts(few_lines())))
    run = spark.table(runs._table(runs.runs[0]))
    batch = line_dedup.line_keys(texts(ODD)).repartition(4, "h1", "h2")
    plan = batch.join(run.hint("merge"), ["h1", "h2"], "left")._jdf.queryExecution().executedPlan().toString()
    runs.drop()
    assert "SortMergeJoin" in plan and plan.count("Exchange hashpartitioning") == 1


def test_sql_and_documents(spark, sf_dir):
    name = "op11_line_dedup"
    assert difference(queries.QUERIES[name](spark, sf_dir), sf_dir, queries.ORACLE[name]) is None
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert found(line_dedup.deduped(docs)) == plain([tuple(r) for r in docs.select("doc_id", F.col("text")).collect()])
