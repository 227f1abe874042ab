"""How rows are spread over write tasks, and the table writer."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, DataFrameWriter, functions as F

from tablesync.catalog import quote
from tablesync.functions.columns import row_bytes

# How text formats keep microseconds, line breaks, blanks and empty text.
_TEXT_OPTIONS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}
FORMAT_OPTIONS = {
    "json": _TEXT_OPTIONS,
    "csv": _TEXT_OPTIONS
    | {
        "header": "true",
        "multiLine": "true",
        "escape": '"',
        "nullValue": "\u0000",
        "ignoreLeadingWhiteSpace": "false",
        "ignoreTrailingWhiteSpace": "false",
    },
}
# Formats whose files one task must read from end to end (csv with line breaks in values).
UNSPLITTABLE = ("csv",)
_BUCKET = "__tablesync_bucket"


def lay_out(
    df: DataFrame,
    partition_by: Sequence[str] = (),
    bucket_by: Sequence[str] = (),
    num_buckets: int | None = None,
    num_partitions: int | None = None,
) -> DataFrame:
    """Spread rows over write tasks so that files are few and tasks are even.

    A partitioned or bucketed target is rebalanced by its directories and bucket
    numbers: rows of one directory (or bucket) meet in one task, so not every task
    opens a file in every directory, and adaptive execution splits a directory that
    holds far more rows than others over several tasks. Where that is turned off,
    each directory is split by the tasks that read its rows. A plain target is
    written as it comes, or in exactly ``num_partitions`` tasks.
    """
    columns = [quote(c) for c in partition_by]
    if bucket_by:
        # the number of the bucket, as the writer computes it
        number = F.pmod(F.hash(*[F.col(quote(c)) for c in bucket_by]), F.lit(num_buckets))
        df = df.withColumn(_BUCKET, number)
        columns.append(_BUCKET)
    if columns:
        tasks = num_partitions or (num_buckets if not partition_by else None)
        first = [tasks] if tasks else []
        if df.sparkSession.conf.get("spark.sql.adaptive.enabled").lower() == "true":
            return df.hint("rebalance", *first, *columns).drop(_BUCKET)
        # buckets stay whole; a directory without buckets is split by the tasks that read its rows
        split = [] if bucket_by else [F.pmod(F.spark_partition_id(), F.lit(_split_count(df)))]
        return df.repartition(*first, *columns, *split).drop(_BUCKET)
    return df.repartition(num_partitions) if num_partitions else df


def _split_count(df: DataFrame) -> int:
    """As many parts as the cluster runs tasks at once."""
    return max(1, df.sparkSession.sparkContext.defaultParallelism)


def rows_per_file(file_format: str | None, file_bytes: int, *frames: DataFrame) -> int | None:
    """Rows that fill a file of about ``file_bytes``, for a format whose files cannot be split.

    Their size is measured on all rows of the frames, which is one more pass over them.
    """
    if file_format not in UNSPLITTABLE:
        return None
    size, count = 0, 0
    for df in frames:
        found = df.agg(F.sum(row_bytes(df.schema)).alias("size"), F.count("*").alias("count")).first()
        size, count = size + (found["size"] or 0), count + found["count"]
    return max(1, file_bytes * count // size) if size else None


def table_writer(
    df: DataFrame,
    file_format: str,
    mode: str,
    path: str | None = None,
    partition_by: Sequence[str] = (),
    bucket_by: Sequence[str] = (),
    num_buckets: int | None = None,
    rows_per_file: int | None = None,
) -> DataFrameWriter:
    writer = df.write.format(file_format).mode(mode).options(**FORMAT_OPTIONS.get(file_format, {}))
    if path:
        writer = writer.option("path", path)
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by:
        writer = writer.bucketBy(num_buckets, *bucket_by)
    return writer
