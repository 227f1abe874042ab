"""The corpus pipeline, stage by stage on its own input."""

import brute
import corpus_pipeline
from pyspark.sql import functions as F

from tablesync.llm import decontaminate, quality_rules, simhash
from tablesync.llm.common import table


def test_stages(spark, sf_dir, tmp_path):
    docs = table(spark, sf_dir, "documents")
    inputs = {}
    for name, stage in corpus_pipeline.STAGES:
        inputs[name] = docs
        stage(spark, docs, sf_dir).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if name != "packing":
            assert docs.columns == list(corpus_pipeline.COLUMNS)
    before = {r.doc_id: r.text for r in inputs["quality_rules"].collect()}
    good = {r.doc_id for r in inputs["simhash_near_dedup"].collect()}
    judged = quality_rules.judged(inputs["quality_rules"])
    assert good == {r.doc_id for r in judged.where("kept").collect()} and 0 < len(good) < len(before)
    labelled = table(spark, sf_dir, "labels").where("quality = 1").join(judged, "doc_id")
    assert labelled.where("not kept and not base_failed").count() == 0
    unlike = {r.doc_id for r in inputs["substring_dedup"].collect()}
    assert unlike == {c for _, c in brute.linked([(d, before[d]) for d in good]).values()}
    rows = [(d, before[d]) for d in unlike]
    kept = {r.doc_id: r for r in inputs["benchmark_decontamination"].collect()}
    for doc_id, _, removed, _ in brute.repeats(rows, 35):
        assert (kept[doc_id].text == before[doc_id]) == (removed == 0)
        assert kept[doc_id].n_chars == len(kept[doc_id].text)
    leaky = {r.doc_id for r in decontaminate.leaks(inputs["benchmark_decontamination"], table(spark, sf_dir, "benchmark")).collect()}
    assert {r.doc_id for r in inputs["packing"].collect()} == kept.keys() - leaky
    assert {r.doc_id for r in docs.select("doc_id").distinct().collect()} == kept.keys() - leaky
    assert docs.where(F.crc32("ids") != F.col("ids_crc32")).count() == 0


def test_run_gives_pieces(spark, sf_dir):
    assert corpus_pipeline.run(spark, sf_dir).count() > 0
