"""File scans, partition discovery and relocation of datasets."""

from __future__ import annotations

import re
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, types as T

from tablesync.catalog import session_conf
from tablesync.functions.columns import pick
from tablesync.spec import SpecError

COLUMNAR_FORMATS = ("parquet", "orc")


def scan(spark: SparkSession, path: str, file_format: str, infer_partition_types: bool = True) -> DataFrame:
    """Scan a parquet or ORC dataset.

    Partition values are typed by what they look like (``01`` reads as 1)
    unless ``infer_partition_types`` is off, which keeps them as text.
    """
    if file_format.lower() not in COLUMNAR_FORMATS:
        raise SpecError(f"file format must be one of {COLUMNAR_FORMATS}, got {file_format!r}")
    setting = "spark.sql.sources.partitionColumnTypeInference.enabled"
    with session_conf(spark, {setting: str(infer_partition_types).lower()}):
        return spark.read.format(file_format.lower()).load(path)


def scan_parquet(spark: SparkSession, path: str) -> DataFrame:
    return scan(spark, path, "parquet")


def scan_orc(spark: SparkSession, path: str) -> DataFrame:
    return scan(spark, path, "orc")


def scan_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Scan CSV with a header. Types are inferred in an extra pass unless given."""
    reader = spark.read.option("header", True)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


def discover_partitions(spark: SparkSession, path: str, file_format: str = "parquet") -> list[str]:
    """The partition columns of a dataset, outermost first.

    Spark's reader has checked by the time it returns that all files lie in the
    same levels, so one file's path tells the names; a dataset whose levels
    differ raises here.
    """
    frame = scan(spark, path, file_format)
    return partition_columns_of(spark, frame, path)


def partition_columns_of(spark: SparkSession, frame: DataFrame, path: str) -> list[str]:
    """The partition columns of a frame read from ``path``."""
    one = frame.select("_metadata.file_path").first()
    if one is not None:
        file = unquote(one["file_path"])
    else:  # files, but no rows
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
        one = files.select("path").first()
        if one is None:
            return []
        file = one["path"]
    file, base = _one_slash(file), _one_slash(re.sub(r"^[\w.+-]+:/*", "/", path)).rstrip("/")
    tail = file[file.find(base) + len(base):] if base in file else file
    names = [unquote(n) for n in re.findall(r"/([^/=]+)=(?=[^/]*/)", tail)]
    known = {c.lower(): c for c in frame.columns}
    unknown = [n for n in names if n.lower() not in known]
    if unknown:
        raise SpecError(f"partition directories {unknown} are not columns of the data at {path}")
    return [known[n.lower()] for n in names]


def _one_slash(path: str) -> str:
    return re.sub(r"/+", "/", path)


def relocate_dataset(
    spark: SparkSession,
    source: str,
    target: str,
    file_format: str = "parquet",
    target_format: str | None = None,
) -> list[str]:
    """Copy a dataset to another place, replacing what is there.

    Keeps the partition directories (values untouched) and moves rows through
    the executors with no shuffle. Returns the partition columns.
    """
    frame = scan(spark, source, file_format, infer_partition_types=False)
    partitions = partition_columns_of(spark, frame, source)
    body = [c for c in frame.columns if c not in partitions]
    writer = pick(frame, [*body, *partitions]).write
    if partitions:
        writer = writer.partitionBy(*partitions)
    # a session's dynamic mode would leave partitions of an earlier copy
    writer = writer.option("partitionOverwriteMode", "static")
    writer.format(target_format or file_format).mode("overwrite").save(target)
    return partitions
