"""Land DataFrames in catalog tables and keep the tables up to date."""

from tablesync.functions.columns import (
    add_derived,
    nested_to_json,
    partition_columns_last,
    scalars_to_text,
    text_to_typed,
    typed_ingest,
)
from tablesync.functions.ddl import create_table_ddl, describe_ddl
from tablesync.operators.merge import KeySkew, merge_frames
from tablesync.plans.register import register_files, registration_ddl
from tablesync.plans.sync import append, merge, overwrite, sync
from tablesync.sources.files import (
    discover_partitions,
    relocate_dataset,
    scan,
    scan_csv,
    scan_orc,
    scan_parquet,
)
from tablesync.sources.jdbc import jdbc_append, jdbc_scan
from tablesync.spec import SpecError, TableSpec

__all__ = [
    "KeySkew",
    "SpecError",
    "TableSpec",
    "add_derived",
    "append",
    "create_table_ddl",
    "describe_ddl",
    "discover_partitions",
    "jdbc_append",
    "jdbc_scan",
    "merge",
    "merge_frames",
    "nested_to_json",
    "overwrite",
    "partition_columns_last",
    "register_files",
    "registration_ddl",
    "relocate_dataset",
    "scalars_to_text",
    "scan",
    "scan_csv",
    "scan_orc",
    "scan_parquet",
    "sync",
    "text_to_typed",
    "typed_ingest",
]
