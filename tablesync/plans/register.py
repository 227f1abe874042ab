"""Register files that already exist as a catalog table."""

from __future__ import annotations

from pyspark.sql import SparkSession

from tablesync.catalog import ensure_schema, qualified, repair_table, split_name
from tablesync.functions.ddl import create_table_ddl
from tablesync.sources.files import partition_columns_of, scan


def registration_ddl(
    spark: SparkSession,
    table: str,
    path: str,
    file_format: str,
    dialect: str = "spark",
    infer_partition_types: bool = True,
) -> tuple[str, bool]:
    """The CREATE TABLE text for a dataset and whether its partitions need repair."""
    frame = scan(spark, path, file_format, infer_partition_types)
    partitions = partition_columns_of(spark, frame, path)
    name = qualified(spark, table)
    ddl = create_table_ddl(frame.schema, name, path, file_format.lower(), partitions, dialect)
    return ddl, bool(partitions)


def register_files(
    spark: SparkSession,
    table: str,
    path: str,
    file_format: str,
    infer_partition_types: bool = True,
) -> list[str]:
    """Make the dataset at ``path`` a table, if there is none of that name.

    No row is read or moved. Returns the statements that were run.
    """
    ddl, needs_repair = registration_ddl(
        spark, table, path, file_format, infer_partition_types=infer_partition_types
    )
    ensure_schema(spark, split_name(spark, table)[0])
    spark.sql(ddl)
    if needs_repair:
        repair_table(spark, table)
        return [ddl, f"MSCK REPAIR TABLE {qualified(spark, table)}"]
    return [ddl]
