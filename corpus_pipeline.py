"""A corpus pipeline of five operators: from raw documents to packed training windows."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tablesync.llm import decontaminate, packing, quality_rules, simhash, substring_dedup
from tablesync.llm.common import discard, shared_folder, table
from tablesync.llm.queries import TOKENIZER

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weighed rules call good and the base rules let pass."""
    return quality_rules.kept_rows(docs).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints: the one with the least id."""
    return simhash.one_of_each(docs).select(*COLUMNS)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the words of repeated passages; one that loses none stays as it is."""
    cut = substring_dedup.remove_repeats(docs, keep_layout=True, carry=("lang", "source", "n_chars"))
    n_chars = F.when(F.col("n_removed") > 0, F.length("kept_text")).otherwise(F.col("carried.n_chars"))
    return cut.select(
        "doc_id",
        F.col("kept_text").alias("text"),
        "carried.lang",
        "carried.source",
        n_chars.cast("long").alias("n_chars"),
    )


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak no benchmark item."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark")).select(*COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in training windows, with their token ids."""
    pieces = packing.pack(docs, public_tokenizers.path(TOKENIZER))
    return pieces.withColumn("ids_crc32", F.crc32("ids")).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"
    )


STAGES = [
    ("quality_rules", quality),
    ("simhash_near_dedup", near_duplicates),
    ("substring_dedup", substrings),
    ("benchmark_decontamination", decontaminated),
    ("packing", packed),
]

#: Fingerprints, fitted votes, spaced seeds and tokenizers have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each is written to the shared folder and read by the next.

    A stage's rows are removed once the next has written its own; the last one's stay.
    """
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    before = None
    for name, stage in STAGES:
        path = f"{folder}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            discard(spark, before)
        before = path
    return docs
