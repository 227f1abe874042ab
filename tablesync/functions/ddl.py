"""Table column lists and CREATE TABLE text from a Spark schema."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import types as T

from tablesync.catalog import quote, text_literal
from tablesync.functions.columns import split_columns
from tablesync.spec import SpecError

_ATOMIC = (
    T.ByteType,
    T.ShortType,
    T.IntegerType,
    T.LongType,
    T.FloatType,
    T.DoubleType,
    T.DecimalType,
    T.StringType,
    T.BinaryType,
    T.BooleanType,
    T.TimestampType,
    T.DateType,
)


def _field_name(name: str) -> str:
    return name if re.fullmatch(r"\w+", name) else quote(name)


def table_type(data_type: T.DataType, column: str, keep_ntz: bool = True) -> str:
    """The DDL type of a column. Names of struct fields keep their case.

    Without ``keep_ntz`` a zone-less timestamp is rendered as ``timestamp``,
    for catalogs that know only that one.
    """

    def render(dt: T.DataType) -> str:
        if isinstance(dt, T.TimestampNTZType):
            return "timestamp_ntz" if keep_ntz else "timestamp"
        if isinstance(dt, T.ArrayType):
            return f"array<{render(dt.elementType)}>"
        if isinstance(dt, T.MapType) and isinstance(dt.keyType, (*_ATOMIC, T.TimestampNTZType)):
            return f"map<{render(dt.keyType)},{render(dt.valueType)}>"
        if isinstance(dt, T.StructType):
            return "struct<" + ",".join(f"{_field_name(f.name)}:{render(f.dataType)}" for f in dt) + ">"
        if isinstance(dt, _ATOMIC):
            return dt.simpleString()
        raise SpecError(f"column {column}: type {dt.simpleString()} has no table type")

    return render(data_type)


def describe_ddl(
    schema: T.StructType, partition_by: Sequence[str] = (), keep_ntz: bool = True
) -> list[tuple[str, str, str]]:
    """``(column, type, section)`` in table order; section is body or partition."""
    body, partitions = split_columns(schema.names, partition_by)
    return [
        (name, table_type(schema[name].dataType, name, keep_ntz), section)
        for section, names in (("body", body), ("partition", partitions))
        for name in names
    ]


def create_table_ddl(
    schema: T.StructType,
    table: str,
    path: str,
    file_format: str,
    partition_by: Sequence[str] = (),
    dialect: str = "spark",
) -> str:
    """CREATE TABLE text over existing files.

    ``spark`` makes a data source table, which any Spark catalog takes.
    ``hive`` is for a Hive catalog or server, which has no zone-less timestamp.
    """
    if dialect not in ("spark", "hive"):
        raise SpecError(f"dialect must be spark or hive, got {dialect!r}")
    hive = dialect == "hive"
    columns = describe_ddl(schema, partition_by, keep_ntz=not hive)

    def listed(section: str) -> str:
        return ", ".join(f"{quote(n)} {t}" for n, t, s in columns if s == section)

    head = "CREATE EXTERNAL TABLE" if hive else "CREATE TABLE"
    name = ".".join(quote(part) for part in table.replace("`", "").split("."))
    parts = [f"{head} IF NOT EXISTS {name} ({listed('body')})"]
    if not hive:
        parts.append(f"USING {file_format}")
    if partition_by:
        parts.append(f"PARTITIONED BY ({listed('partition')})")
    if hive:
        parts.append(f"STORED AS {file_format.upper()}")
    parts.append(f"LOCATION {text_literal(path)}")
    return " ".join(parts)
