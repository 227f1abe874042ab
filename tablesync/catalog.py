"""Catalog helpers: names, existence, layout, schemas, drop, rename, repair."""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator, Mapping
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import SparkSession


_UNREPAIRED = "tablesync.unrepaired"


def quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def text_literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def shared_folder(spark: SparkSession) -> str | None:
    """The folder all executors reach, as the cluster names it; None in tests."""
    return spark.conf.get("spark.checkpoint.dir", None)


def split_name(spark: SparkSession, table: str) -> tuple[str, str]:
    """``db.name`` or ``name`` in the current database."""
    db, dot, name = table.replace("`", "").rpartition(".")
    return (db if dot else spark.catalog.currentDatabase()), name


def qualified(spark: SparkSession, table: str) -> str:
    db, name = split_name(spark, table)
    return f"{quote(db)}.{quote(name)}"


def table_exists(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(qualified(spark, table))


def ensure_schema(spark: SparkSession, schema: str, location: str | None = None) -> None:
    where = f" LOCATION {text_literal(location)}" if location else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {quote(schema)}{where}")


def drop_table(spark: SparkSession, table: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {qualified(spark, table)}")


def rename_table(spark: SparkSession, table: str, new_name: str) -> None:
    """Rename, and register the partitions again under the new location.

    The table is marked meanwhile; ``finish_rename`` does what a stop between left undone.
    """
    partitioned = bool(table_info(spark, table).partition_by)
    if partitioned:
        set_properties(spark, table, {_UNREPAIRED: "true"})
    spark.sql(f"ALTER TABLE {qualified(spark, table)} RENAME TO {qualified(spark, new_name)}")
    finish_rename(spark, new_name)


def finish_rename(spark: SparkSession, table: str) -> None:
    """Register the partitions of a table that was renamed but not yet repaired."""
    if _UNREPAIRED in table_info(spark, table).properties:
        repair_table(spark, table)
        unset_properties(spark, table, [_UNREPAIRED])


def repair_table(spark: SparkSession, table: str) -> None:
    """Register the partition directories found under the table's location."""
    spark.sql(f"MSCK REPAIR TABLE {qualified(spark, table)}")


def set_properties(spark: SparkSession, table: str, properties: Mapping[str, str]) -> None:
    if properties:
        pairs = ", ".join(f"{text_literal(k)} = {text_literal(v)}" for k, v in properties.items())
        spark.sql(f"ALTER TABLE {qualified(spark, table)} SET TBLPROPERTIES ({pairs})")


def unset_properties(spark: SparkSession, table: str, names: Iterable[str]) -> None:
    if listed := ", ".join(map(text_literal, names)):
        spark.sql(f"ALTER TABLE {qualified(spark, table)} UNSET TBLPROPERTIES IF EXISTS ({listed})")


@dataclass(frozen=True)
class TableInfo:
    """How the catalog says a table is laid out."""

    file_format: str
    location: str
    external: bool
    partition_by: tuple[str, ...]
    bucket_by: tuple[str, ...]
    num_buckets: int | None
    properties: Mapping[str, str] = field(default_factory=dict)
    comment: str | None = None
    column_comments: Mapping[str, str] = field(default_factory=dict)
    statistics: Mapping[str, int] = field(default_factory=dict)


def table_info(spark: SparkSession, table: str) -> TableInfo:
    row = spark.sql(f"DESCRIBE EXTENDED {qualified(spark, table)} AS JSON").first()
    about = json.loads(row[0])
    return TableInfo(
        file_format=about["provider"].lower(),
        location=about["location"],
        external=about["type"] == "EXTERNAL",
        partition_by=tuple(about.get("partition_columns") or ()),
        bucket_by=tuple(about.get("bucket_columns") or ()),
        num_buckets=about.get("num_buckets") if about.get("bucket_columns") else None,
        properties=about.get("table_properties") or {},
        comment=about.get("comment"),
        column_comments={c["name"]: c["comment"] for c in about["columns"] if c.get("comment")},
        statistics=about.get("statistics") or {},
    )


@contextmanager
def session_conf(spark: SparkSession, settings: Mapping[str, str]) -> Iterator[None]:
    """Run a block with session settings, then put the old ones back."""
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"


def session_with(spark: SparkSession, settings: Mapping[str, str]) -> SparkSession:
    """A session with this one's settings, but for those given.

    It shares the catalog and the context; nobody else sees what is set in it, so writes of
    other threads are not disturbed. Temporary views are not shared.
    """
    other = spark.newSession()
    for row in spark.sql("SET").collect():
        if row["key"].startswith("spark.sql.") and spark.conf.isModifiable(row["key"]):
            other.conf.set(row["key"], row["value"])
    for key, value in settings.items():
        other.conf.set(key, value)
    return other


def overwrites_statically(spark: SparkSession) -> bool:
    return spark.conf.get(OVERWRITE_MODE).lower() == "static"
