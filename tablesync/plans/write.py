"""Overwrite and append a catalog table."""

from __future__ import annotations

import json
import uuid
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession

from tablesync.catalog import (
    OVERWRITE_MODE,
    TableInfo,
    ensure_schema,
    overwrites_statically,
    qualified,
    session_with,
    set_properties,
    split_name,
    table_exists,
    table_info,
    unset_properties,
)
from tablesync.functions.columns import (
    add_derived,
    blank_partitions_to_null,
    nested_to_json,
    partition_columns_last,
)
from tablesync.operators.layout import lay_out, rows_per_file, table_writer
from tablesync.spec import DEFAULT_FORMAT, SpecError, TableSpec

DERIVED_PROPERTY = "tablesync.derived"


def case_sensitive(spark: SparkSession) -> bool:
    return spark.conf.get("spark.sql.caseSensitive").lower() == "true"


def resolve(df: DataFrame, spec: TableSpec) -> tuple[DataFrame, TableSpec]:
    """The rows as the table stores them (derived columns not yet added)."""
    spec = spec.resolved(df.columns, case_sensitive(df.sparkSession))
    return (nested_to_json(df) if spec.nested == "json" else df), spec


def derived_properties(spec: TableSpec) -> dict[str, str]:
    return {DERIVED_PROPERTY: json.dumps(dict(spec.derived))} if spec.derived else {}


def with_layout(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Add derived columns, move partition columns last, spread over tasks."""
    df = blank_partitions_to_null(df, spec.partition_by)
    shaped = partition_columns_last(add_derived(df, spec.derived), spec.partition_columns)
    return lay_out(
        shaped,
        spec.partition_columns,
        spec.bucket_columns,
        spec.num_buckets,
        spec.num_partitions,
    )


def save(
    df: DataFrame, spec: TableSpec, table: str, mode: str, path: str | None, file_rows: int | None = None
) -> None:
    """Write rows to a table. An overwrite replaces all partitions, whatever the session says.

    (Spark keeps an option of the writer with the table, where it would bind later inserts, and
    the session is not ours to change; so a dynamic session's rows are written from another.)
    """
    spark = df.sparkSession

    def write(rows: DataFrame) -> None:
        table_writer(
            rows,
            spec.file_format or DEFAULT_FORMAT,
            mode,
            path,
            spec.partition_columns,
            spec.bucket_columns,
            spec.num_buckets,
            file_rows,
        ).saveAsTable(qualified(spark, table))

    if mode != "overwrite" or not spec.partition_columns or overwrites_statically(spark):
        return write(df)
    view = f"tablesync_{uuid.uuid4().hex}"
    df.createGlobalTempView(view)
    try:
        shared = spark.conf.get("spark.sql.globalTempDatabase")
        write(session_with(spark, {OVERWRITE_MODE: "static"}).table(f"{shared}.{view}"))
    finally:
        spark.catalog.dropGlobalTempView(view)
    spark.catalog.refreshTable(qualified(spark, table))  # this session may remember the old files


def overwrite(df: DataFrame, spec: TableSpec) -> None:
    """Replace the table: its rows, its columns and its layout."""
    spark = df.sparkSession
    rows, spec = resolve(df, spec)
    ensure_schema(spark, split_name(spark, spec.table)[0])
    file_rows = rows_per_file(spec.file_format, spec.file_bytes, rows)
    save(with_layout(rows, spec), spec, spec.table, "overwrite", spec.path, file_rows)
    set_properties(spark, spec.table, derived_properties(spec))


def append(df: DataFrame, spec: TableSpec) -> None:
    """Add the rows; a missing table is made as by ``overwrite``."""
    spark = df.sparkSession
    if not table_exists(spark, spec.table):
        return overwrite(df, spec)
    rows, spec = resolve(df, spec)
    info = table_info(spark, spec.table)
    spec = fit_to_table(spark, spec, info)
    stored = json.loads(info.properties.get(DERIVED_PROPERTY) or "{}")
    if stored and spec.derived and stored != dict(spec.derived):
        raise SpecError(f"{spec.table} derives {stored}, the spec {dict(spec.derived)}")
    shaped = with_layout(rows, spec)
    check_columns(spark, shaped, spec.table)
    if stored and not spec.derived:  # the rows bring values of their own: none can be trusted any more
        unset_properties(spark, spec.table, [DERIVED_PROPERTY])
    save(shaped, spec, spec.table, "append", None, rows_per_file(spec.file_format, spec.file_bytes, rows))


def check_columns(spark: SparkSession, df: DataFrame, table: str) -> None:
    fold = (lambda c: c) if case_sensitive(spark) else str.lower
    given = {fold(c) for c in df.columns}
    wanted = {fold(c) for c in spark.table(qualified(spark, table)).columns}
    if given != wanted:
        raise SpecError(
            f"columns differ from table {table}: missing {sorted(wanted - given)}, "
            f"unknown {sorted(given - wanted)}"
        )


def fit_to_table(spark: SparkSession, spec: TableSpec, info: TableInfo) -> TableSpec:
    """The spec with the layout of the existing table; a contradiction is an error."""
    fold = (lambda c: c) if case_sensitive(spark) else str.lower

    def agree(what: str, asked: object, actual: object) -> None:
        if asked and asked != actual:
            raise SpecError(f"{spec.table} has {what} {actual}, the spec asks for {asked}")

    agree("format", spec.file_format, info.file_format)
    agree(
        "partition columns",
        tuple(map(fold, spec.partition_columns)),
        tuple(map(fold, info.partition_by)),
    )
    agree("bucket columns", tuple(map(fold, spec.bucket_columns)), tuple(map(fold, info.bucket_by)))
    agree("bucket count", spec.num_buckets if spec.bucket_columns else None, info.num_buckets)
    if spec.path and not info.external:
        raise SpecError(f"{spec.table} is managed, the spec asks for path {spec.path}")
    if spec.path and not _same_path(spark, spec.path, info.location):
        raise SpecError(f"{spec.table} is at {info.location}, the spec asks for {spec.path}")
    named = {fold(c): c for c in info.partition_by}
    return replace(
        spec,
        derived={named.get(fold(a), a): e for a, e in spec.derived.items()},
        path=info.location if info.external else None,
        file_format=info.file_format,
        partition_by=info.partition_by,
        bucket_by=info.bucket_by,
        num_buckets=info.num_buckets,
    )


def _same_path(spark: SparkSession, asked: str, actual: str) -> bool:
    """The same path on the same store; what a path leaves out is the default store's."""
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    files = jvm.org.apache.hadoop.fs.FileSystem
    default, root = files.getDefaultUri(conf), jvm.org.apache.hadoop.fs.Path("/")

    def whole(path: str) -> tuple[str, str, str]:
        uri = jvm.org.apache.hadoop.fs.Path(path).makeQualified(default, root).toUri()
        return (uri.getScheme() or "").lower(), (uri.getAuthority() or "").lower(), uri.getPath().rstrip("/")

    return whole(asked) == whole(actual)
