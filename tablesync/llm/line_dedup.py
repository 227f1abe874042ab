"""Lines that many documents share, found by levelled sorted runs of line hashes.

A line's key is the line without ASCII white space at its ends, A-Z lower-cased; it is known
by two 64-bit hashes. An index (`LineRuns`) takes documents batch by batch. It is a list of
runs, each a table bucketed and sorted by key hash that covers some batches and holds how
many of their documents have a key. A new batch counts its keys, merge-joins every run on
the buckets (no run is shuffled or sorted into place again) and

* leaves out the keys that a run already calls common (the anti-join), and
* adds the others as its own run, common where all runs together have enough documents.

Two neighbouring runs of one width are compacted into one run of the next level by a full
outer merge join, again without a shuffle. So there is one run a level at most, and levels
grow with the logarithm of the batches. A run's name says which batches it covers and a run
exists only when whole, so an index that was broken off is opened by its name: runs inside a
wider one are dropped.

Common lines then go from every document: line positions meet the common keys, positions
are gathered by text, and each text is joined by its digest. Line positions of a hot line and
texts of a hot group of copies are rows of ordinary joins, which adaptive execution splits;
counts are formed in tasks before they are shuffled.

A document is a row: repeated rows count each, ids may be null or repeat. A null or empty
text is one empty line. Blank lines have empty keys and always stay. A document that loses
all lines keeps the empty text. An empty table gives no rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tablesync.llm.common import discard, settled, shared_folder

#: Documents that make a line common, and the code points that its key needs.
LEAST_DOCS = 10
LEAST_CHARS = 1
#: Batches that a whole table is taken in by.
BATCHES = 8

SCHEMA_NAME = "tablesync_line_runs"
HASHES = ("h1", "h2")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# SQL of a text's lines, and of their keys; a line of ASCII alone takes the faster way to the same key.
_LINES = r"split(coalesce(text, ''), '\n')"
_BARE = rf"transform({_LINES}, line -> trim(BOTH ' \t\u000B\u000C\r' FROM line))"
_KEYS = (
    f"transform({_BARE}, k -> if(octet_length(k) = char_length(k), lower(k), translate(k, '{_UPPER}', '{_LOWER}')))"
)


def _hashes(column: str) -> list[Column]:
    return [F.xxhash64(column).alias("h1"), F.xxhash64(F.lit(1), column).alias("h2")]


def line_keys(docs: DataFrame, least_chars: int = LEAST_CHARS) -> DataFrame:
    """The key hashes (h1, h2) of each document's lines, each key once a document."""
    keys = docs.selectExpr(f"explode(array_distinct({_KEYS})) AS key")
    return keys.where(f"char_length(key) >= {max(1, least_chars)}").select(*_hashes("key"))


def _merged(older: DataFrame, newer: DataFrame) -> DataFrame:
    """Two runs as one. A key has one row a run. (A union of bucketed tables followed by an
    aggregate keeps two rows of a key in Spark 4.1, so runs are never put together by union.)"""
    newer = newer.selectExpr(*HASHES, "n_docs AS more", "common AS also")
    return older.join(newer.hint("merge"), list(HASHES), "full").selectExpr(
        *HASHES,
        "coalesce(n_docs, 0) + coalesce(more, 0) AS n_docs",
        "coalesce(common, false) OR coalesce(also, false) AS common",
    )


class LineRuns:
    """An index of line keys by the name of its runs; opened again, it goes on where it was."""

    def __init__(
        self,
        spark: SparkSession,
        name: str,
        least_docs: int = LEAST_DOCS,
        buckets: int | None = None,
    ):
        self.spark, self.name, self.least_docs = spark, name, least_docs
        folder = f"{shared_folder(spark).rstrip('/')}/{SCHEMA_NAME}"
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {SCHEMA_NAME} LOCATION '{folder}'")
        found = [self._covers(t.name) for t in spark.catalog.listTables(SCHEMA_NAME, f"{name}__*")]
        self.runs = [r for r in sorted(found) if not any(r != w and w[0] <= r[0] and r[1] <= w[1] for w in found)]
        for run in set(found) - set(self.runs):
            self._drop(run)
        self.buckets = self._buckets_of(self.runs[0]) if self.runs else (
            buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        )

    def _covers(self, table: str) -> tuple[int, int]:
        first, last = table.removeprefix(f"{self.name}__").split("_")
        return int(first), int(last)

    def _table(self, run: tuple[int, int]) -> str:
        return f"{SCHEMA_NAME}.{self.name}__{run[0]}_{run[1]}"

    def _buckets_of(self, run: tuple[int, int]) -> int:
        about = self.spark.sql(f"DESCRIBE EXTENDED {self._table(run)}").where("col_name = 'Num Buckets'")
        return int(about.first()["data_type"])

    def _drop(self, run: tuple[int, int]) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self._table(run)}")

    def _write(self, rows: DataFrame, run: tuple[int, int]) -> None:
        """Rows are in the buckets' tasks already, so that a bucket is one sorted file."""
        writer = rows.select(*HASHES, "n_docs", "common").write.format("parquet").mode("overwrite")
        writer.bucketBy(self.buckets, *HASHES).sortBy(*HASHES).saveAsTable(self._table(run))

    def add(self, keys: DataFrame) -> None:
        """Take in a batch: the key hashes of its documents, each key once a document."""
        batch = keys.groupBy(*HASHES).agg(F.count("*").alias("n_docs")).repartition(self.buckets, *HASHES)
        total, known = ["n_docs"], ["false"]
        for i, run in enumerate(self.runs):
            older = self.spark.table(self._table(run)).selectExpr(*HASHES, f"n_docs AS n{i}", f"common AS c{i}")
            batch = batch.join(older.hint("merge"), list(HASHES), "left")
            total.append(f"coalesce(n{i}, 0)")
            known.append(f"coalesce(c{i}, false)")
        fresh = batch.where(f"NOT ({' OR '.join(known)})")
        number = self.runs[-1][1] + 1 if self.runs else 0
        self._write(fresh.withColumn("common", F.expr(f"{' + '.join(total)} >= {self.least_docs}")), (number, number))
        self.runs.append((number, number))
        self._compact()

    def _compact(self) -> None:
        """Merge the two newest runs while they have one width."""
        width = lambda run: run[1] - run[0] + 1
        while len(self.runs) > 1 and width(self.runs[-1]) == width(self.runs[-2]):
            old = self.runs[-2:]
            wide = (old[0][0], old[1][1])
            self._write(_merged(*(self.spark.table(self._table(run)) for run in old)), wide)
            self.runs[-2:] = [wide]
            for run in old:
                self._drop(run)

    def common(self) -> DataFrame:
        """The hashes of the common keys."""
        if not self.runs:
            return self.spark.createDataFrame([], "h1 long, h2 long")
        return reduce(_merged, (self.spark.table(self._table(run)) for run in self.runs)).where("common").select(*HASHES)

    def drop(self) -> None:
        for run in self.runs:
            self._drop(run)
        self.runs = []


def without_lines(docs: DataFrame, common: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Every document without the lines whose key is common.

    Columns: doc_id, n_lines (before), n_dropped, kept_text, kept_sha256, and `carried`, a
    struct of the columns named by `carry`. Other columns may have any name.
    """
    texts = docs.select(
        "doc_id",
        F.coalesce("text", F.lit("")).alias("text"),
        (F.struct(*carry) if carry else F.lit(None).cast("string")).alias("carried"),
    ).withColumns({"d1": F.xxhash64("text"), "d2": F.xxhash64(F.lit(1), "text")})
    places = texts.selectExpr("d1", "d2", f"posexplode({_KEYS}) AS (pos, key)")
    found = places.select("d1", "d2", "pos", *_hashes("key")).join(common, list(HASHES), "left_semi")
    gone = found.groupBy("d1", "d2").agg(F.collect_set("pos").alias("gone"))
    lines = texts.join(gone, ["d1", "d2"], "left").selectExpr(
        "doc_id", "carried", "gone", f"{_LINES} AS lines"
    )
    kept = "array_except(sequence(0, size(lines) - 1), coalesce(gone, array()))"
    kept_text = lines.selectExpr(
        "doc_id",
        "CAST(size(lines) AS BIGINT) AS n_lines",
        "CAST(coalesce(size(gone), 0) AS BIGINT) AS n_dropped",
        f"array_join(if(gone IS NULL, lines, transform({kept}, i -> lines[i])), '\\n') AS kept_text",
        "carried",
    )
    return kept_text.select(
        "doc_id", "n_lines", "n_dropped", "kept_text", F.sha2("kept_text", 256).alias("kept_sha256"), "carried"
    )


def deduped(
    docs: DataFrame,
    least_docs: int = LEAST_DOCS,
    least_chars: int = LEAST_CHARS,
    batches: int = BATCHES,
    carry: Sequence[str] = (),
) -> DataFrame:
    """`without_lines` of a whole table: its documents enter an index in `batches` batches."""
    spark = docs.sparkSession
    name = f"lines_{uuid.uuid4().hex}"
    folder = f"{shared_folder(spark).rstrip('/')}/{name}"
    batch = F.expr(f"pmod(xxhash64(text), {batches})")
    # The keys of all documents, apart by batch: one pass over the texts, no shuffle.
    keyed = docs.select("text", batch.alias("batch")).selectExpr(
        "batch", f"explode(array_distinct({_KEYS})) AS key"
    )
    keyed = keyed.where(f"char_length(key) >= {max(1, least_chars)}").select("batch", *_hashes("key"))
    keyed.write.partitionBy("batch").parquet(folder)
    stored = spark.read.schema("h1 long, h2 long, batch long").parquet(folder)
    runs = LineRuns(spark, name, least_docs)
    try:
        for number in range(batches):
            runs.add(stored.where(F.col("batch") == number).select(*HASHES))
        common = settled(runs.common())
    finally:
        runs.drop()
        discard(spark, folder)
    return without_lines(docs, common, carry)
