"""The entry points: put a frame into its table by one of three modes."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame

from tablesync.plans import merge_table, write
from tablesync.spec import TableSpec


def sync(df: DataFrame, spec: TableSpec) -> None:
    """Overwrite, append to or merge into ``spec.table``.

    Finishes or clears away first what a broken-off merge has left behind.
    """
    merge_table.recover(df.sparkSession, spec.table)
    modes = {"overwrite": write.overwrite, "append": write.append, "merge": merge_table.merge}
    modes[spec.mode](df, spec)


def overwrite(df: DataFrame, spec: TableSpec) -> None:
    sync(df, replace(spec, mode="overwrite"))


def append(df: DataFrame, spec: TableSpec) -> None:
    sync(df, replace(spec, mode="append"))


def merge(df: DataFrame, spec: TableSpec) -> None:
    sync(df, replace(spec, mode="merge"))
