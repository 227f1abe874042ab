"""Merge a frame into a catalog table.

How the merged rows are published follows from the table and the spec alone:

* *touched* -- a partitioned table. The partitions that incoming rows and their
  matches lie in are read and merged into a stage table, which then replaces them.
  ``rewrite="all"``, or derived columns that are not a function of the row or not
  those the table was written with, turn this off.
* *files* -- a table without partitions or buckets, if the spec says ``rewrite="files"``.
  Only the files that hold a match are read in full and merged into a stage, whose files
  take their place; all others stay.
* *renamed* -- a managed table where renaming moves no data: the merged rows are
  written once to a new table, which takes the place of the old one.
* *staged* -- any other table: the stage holds all merged rows.

A stage is kept, with its mark, until it has replaced the target's rows, so a merge
that is broken off can be finished. Helper tables name the table they belong to in a
property; nothing without it is ever touched.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from tablesync.catalog import (
    OVERWRITE_MODE,
    TableInfo,
    drop_table,
    ensure_schema,
    finish_rename,
    qualified,
    quote,
    rename_table,
    session_with,
    set_properties,
    shared_folder,
    split_name,
    table_exists,
    table_info,
    text_literal,
    unset_properties,
)
from tablesync.functions.columns import (
    add_derived,
    blank_partitions_to_null,
    conform,
    partition_columns_last,
    pick,
    row_bytes,
)
from tablesync.operators.layout import FORMAT_OPTIONS, lay_out, rows_per_file
from tablesync.operators.merge import (
    KeySkew,
    check_unique,
    count_hot_keys,
    merge_few,
    merge_frames,
    merge_matched,
)
from tablesync.plans import write
from tablesync.spec import SpecError, TableSpec

STAGE_SCHEMA = "tablesync_stage"
_READY = "tablesync.stage.ready"
_TARGET_PATH = "tablesync.stage.path"
_OWNER = "tablesync.owner"
#: Begins the names of helper columns that stand beside a table's own.
_T = "__tablesync_"
_WHOLE, _TOUCHED, _FILES = "whole", "touched", "files"
#: Threads that remove folders; partitions dropped by one statement.
_THREADS = 16
_DROPPED_AT_ONCE = 100

# Formats whose files can be added to a table as they are.
_SELF_DESCRIBING = ("orc", "parquet")

# File systems on which renaming a directory moves no data.
_CHEAP_RENAME = ("file", "hdfs", "viewfs", "abfs", "abfss")


def _full_name(spark: SparkSession, table: str) -> str:
    return json.dumps(split_name(spark, table))


def stage_name(spark: SparkSession, table: str, role: str = "stage") -> str:
    """Where a merge keeps its intermediate rows: in the cluster's shared
    checkpoint folder where one is set, else beside the table."""
    shared = shared_folder(spark)
    if not shared:
        return successor_name(spark, table, role)
    ensure_schema(spark, STAGE_SCHEMA, f"{shared.rstrip('/')}/{STAGE_SCHEMA}")
    return f"{STAGE_SCHEMA}.{_helper(spark, table, role)}"


def successor_name(spark: SparkSession, table: str, role: str = "merged") -> str:
    return f"{split_name(spark, table)[0]}.{_helper(spark, table, role)}"


def _helper(spark: SparkSession, table: str, role: str) -> str:
    digest = hashlib.sha1(_full_name(spark, table).encode()).hexdigest()[:16]
    return f"{split_name(spark, table)[1]}__{digest}_{role}"


def _owned(spark: SparkSession, helper: str, table: str) -> bool:
    """Whether a helper table is there and was made for this table."""
    if not table_exists(spark, helper):
        return False
    return table_info(spark, helper).properties.get(_OWNER) == _full_name(spark, table)


def _drop_helper(spark: SparkSession, helper: str, table: str) -> None:
    if _owned(spark, helper, table):
        drop_table(spark, helper)


def _save_helper(
    df: DataFrame,
    helper: str,
    table: str,
    file_format: str = "orc",
    partition_by: Sequence[str] = (),
    bucket_by: Sequence[str] = (),
    num_buckets: int | None = None,
    file_rows: int | None = None,
    location: str | None = None,
) -> None:
    """Write rows to a new helper table, which names its owner from the start."""
    spark = df.sparkSession
    _drop_helper(spark, helper, table)
    if table_exists(spark, helper):
        raise SpecError(f"{helper} is in the way of a merge into {table}; it was not made by one")

    def listed(names: Sequence[str]) -> str:
        return "(" + ", ".join(map(quote, names)) + ")"

    options = FORMAT_OPTIONS.get(file_format, {})
    clauses = [
        f"USING {file_format}",
        "OPTIONS (" + ", ".join(f"{text_literal(k)} = {text_literal(v)}" for k, v in options.items()) + ")"
        if options
        else "",
        f"PARTITIONED BY {listed(partition_by)}" if partition_by else "",
        f"CLUSTERED BY {listed(bucket_by)} INTO {num_buckets} BUCKETS" if bucket_by else "",
        f"LOCATION {text_literal(location)}" if location else "",
        f"TBLPROPERTIES ({text_literal(_OWNER)} = {text_literal(_full_name(spark, table))})",
    ]
    columns = T.StructType([T.StructField(f.name, f.dataType) for f in df.schema])
    spark.sql(f"CREATE TABLE {qualified(spark, helper)} ({columns.toDDL()}) {' '.join(clauses)}")
    spec = TableSpec(
        helper, file_format=file_format, partition_by=partition_by, bucket_by=bucket_by, num_buckets=num_buckets
    )
    write.save(df, spec, helper, "append", None, file_rows)


def merge(df: DataFrame, spec: TableSpec) -> None:
    """Merge the rows by ``spec.keys``; a missing table is made as by overwrite."""
    spark = df.sparkSession
    if not table_exists(spark, spec.table):
        return write.overwrite(df, spec)
    if not spec.keys:
        raise SpecError("merge needs keys")
    asked = dict(spec.derived)
    rows, spec = write.resolve(df, spec)
    info = table_info(spark, spec.table)
    spec = write.fit_to_table(spark, spec, info)
    clash = [k for k in spec.keys if k in spec.derived]
    if clash:
        raise SpecError(f"a derived column cannot be a merge key: {clash}")

    target = spark.table(qualified(spark, spec.table))
    # Derived columns are outputs: they are computed again from the merged row.
    old = target.drop(*spec.derived)
    new = conform(rows, old.schema, write.case_sensitive(spark))
    new = blank_partitions_to_null(new, spec.partition_by)
    named = {c.lower(): c for c in old.columns}
    spec = replace(spec, keys=[k if k in old.columns else named[k.lower()] for k in spec.keys])
    incoming = stage_name(spark, spec.table, "incoming")
    try:
        new, few = _take_in(new, spec, incoming)
        if spec.duplicate_keys == "error":
            check_unique(new, spec.keys, "incoming")
            check_unique(old, spec.keys, "existing")

        same_derivation = info.properties.get(write.DERIVED_PROPERTY) == (
            json.dumps(asked) if asked else None
        )
        if info.partition_by and spec.rewrite != "all" and same_derivation and _stable(new, spec):
            if _merge_touched(target, new, spec, few):
                return
        if _by_file(spec, info):
            return _merge_files(target, new, spec, few, info)
        _merge_whole(old, new, spec, few, info)
    finally:
        if spec.stage_incoming:
            _drop_helper(spark, incoming, spec.table)
        _drop_helper(spark, stage_name(spark, spec.table, "hot"), spec.table)


def _take_in(new: DataFrame, spec: TableSpec, stage: str) -> tuple[DataFrame, bool]:
    """The incoming rows, staged if asked for, and whether they may be broadcast.

    Their size is measured on all rows, while they are staged."""
    spark = new.sparkSession
    size = F.sum(row_bytes(new.schema)).alias("bytes")
    if spec.stage_incoming:
        seen = Observation()
        _save_helper(new.observe(seen, size), stage, spec.table)
        new, measured = spark.table(qualified(spark, stage)), seen.get["bytes"]
    else:
        measured = new.agg(size).first()["bytes"] if spec.broadcast_bytes else None
    return new, (measured or 0) <= spec.broadcast_bytes


def _aligned(spec: TableSpec, few: bool) -> bool:
    """Whether a join on the keys puts each bucket of the table in one task."""
    return not few and not spec.partition_columns and set(spec.bucket_columns) == set(spec.keys) != set()


def _merged(old: DataFrame, new: DataFrame, spec: TableSpec, few: bool) -> DataFrame:
    """The merge of two frames, planned for their size and the keys they hold, and spread
    over write tasks."""

    def spread(rows: DataFrame) -> DataFrame:
        return lay_out(rows, spec.partition_columns, spec.bucket_columns, spec.num_buckets, spec.num_partitions)

    if few:
        return spread(add_derived(merge_few(old, new, spec.keys), spec.derived))
    # With unique keys only null keys can be many.
    skew = KeySkew() if spec.duplicate_keys == "error" else _skew(old, new, spec)
    if _aligned(spec, few) and skew.hot is None:
        # Joined rows stay in their bucket's task; those with a null key are brought there.
        return merge_frames(old, new, spec.keys, skew, apart=spread)
    return spread(add_derived(merge_frames(old, new, spec.keys, skew), spec.derived))


def _skew(old: DataFrame, new: DataFrame, spec: TableSpec) -> KeySkew:
    """Look for hot keys on both sides; those that there are go to a helper table."""
    spark = old.sparkSession
    seen = Observation()
    hot = count_hot_keys(old, new, spec.keys, spec.hot_key_rows, seen)
    null_keys = seen.get["null_keys"] > 0
    if hot is None:
        return KeySkew(null_keys=null_keys)
    helper, written = stage_name(spark, spec.table, "hot"), Observation()
    size = F.sum(row_bytes(hot.schema)).alias("bytes")
    _save_helper(hot.observe(written, size), helper, spec.table)
    size = written.get["bytes"]
    return KeySkew(
        null_keys=null_keys,
        hot=spark.table(qualified(spark, helper)) if size else None,
        broadcast_hot=(size or 0) <= spec.broadcast_bytes,
    )


# --- touched partitions -----------------------------------------------------


@dataclass(frozen=True)
class _Touched:
    """The partitions to read, as rows, and whether these may be broadcast.

    Its columns, all named by `_T`, are 0, 1, ... of the partition columns' own types,
    `matched` (the partition holds matched old rows), `code`, a hash of the partition's
    values, and `chosen`, always 1 (only a filtered table prunes partitions).
    """

    partitions: DataFrame
    few: bool

    def only(self, rows: DataFrame, columns: Sequence[str]) -> DataFrame:
        """The rows that lie in these partitions. No value passes through text.

        The hash makes one equality of all columns, null or not; Spark turns it into a
        partition filter at run time (dynamic pruning), where the table may be broadcast.
        """
        wanted = self.partitions.where(f"{_T}code IS NOT NULL AND {_T}chosen = 1")
        same = [F.expr(f"{_code(columns)} = {_T}code")]
        same += [F.col(quote(c)).eqNullSafe(F.col(f"{_T}{i}")) for i, c in enumerate(columns)]
        return rows.join(F.broadcast(wanted) if self.few else wanted, same, "left_semi")


def _code(columns: Sequence[str]) -> str:
    return f"xxhash64({', '.join(map(quote, columns))})"


def _mentions(expression: str, name: str) -> bool:
    """Whether the name occurs in the text; may say yes where it is no column."""
    text, word = expression.lower(), name.lower()
    if re.fullmatch(r"\w+", word):
        return re.search(rf"(?<!\w){word}(?!\w)", text) is not None
    return word.replace("`", "``") in text


def _stable(rows: DataFrame, spec: TableSpec) -> bool:
    """Whether derived values depend on the row alone: the analyzed expressions are
    deterministic, and all they start from is columns and literals (so no clock, no user)."""
    if not spec.derived:
        return True
    found = rows.selectExpr(*spec.derived.values())._jdf.queryExecution().analyzed().expressions()
    for i in range(found.size()):
        expression = found.apply(i)
        if not expression.deterministic():
            return False
        leaves = expression.collectLeaves()
        kinds = {leaves.apply(j).getClass().getSimpleName() for j in range(leaves.size())}
        if kinds - {"AttributeReference", "Literal"}:
            return False
    return True


def _follows_from_keys(columns: Sequence[str], spec: TableSpec) -> bool:
    """Whether the merge key alone decides the partition of a row."""
    plain = [c for c in spec.partition_columns if c not in spec.derived]
    others = [c for c in columns if c not in spec.keys]
    return set(plain) <= set(spec.keys) and not any(
        _mentions(e, c) for e in spec.derived.values() for c in others
    )


def _find_touched(target: DataFrame, new: DataFrame, spec: TableSpec, few: bool) -> _Touched | None:
    """Which partitions the incoming rows touch: those they land in, and those their
    matches are in and go to. None if there are none."""
    columns = spec.partition_columns
    own = ", ".join(f"'{_T}{i}', {quote(c)}" for i, c in enumerate(columns))
    partition = f"named_struct({own})"
    landing = add_derived(new, spec.derived).selectExpr(f"{partition} AS part", f"false AS {_T}matched")
    if _follows_from_keys(new.columns, spec):
        ends = landing
    else:
        # Of the table only the keys, the partition columns and what the derived
        # expressions read are scanned here.
        was = "__partition_before"
        paired = merge_matched(
            target.selectExpr(*map(quote, new.columns), f"{partition} AS {was}"),
            F.broadcast(new) if few else new,
            spec.keys,
            was,
        )
        matched = add_derived(paired, spec.derived).select(
            F.expr(
                f"inline(array(struct({was} AS part, true AS {_T}matched), "
                f"struct({partition} AS part, false AS {_T}matched)))"
            )
        )
        ends = landing.unionAll(matched)
    held = [f"{_T}{i}" for i in range(len(columns))]
    found = ends.select("part.*", f"{_T}matched").groupBy(*held).agg(F.bool_or(f"{_T}matched").alias(f"{_T}matched"))
    found = found.selectExpr("*", f"{_code(held)} AS {_T}code", f"1 AS {_T}chosen")
    found = found.persist()
    size = found.agg(F.sum(row_bytes(found.schema))).first()[0]
    return _Touched(found, size <= spec.broadcast_bytes) if size else None


def _merge_touched(target: DataFrame, new: DataFrame, spec: TableSpec, few: bool) -> bool:
    """Rewrite only the partitions the incoming rows touch; False if the rows were not
    the same as when they were looked at."""
    spark = target.sparkSession
    columns = spec.partition_columns
    touched = _find_touched(target, new, spec, few)
    if touched is None:  # nothing came in
        return True
    try:
        old = touched.only(target, columns).drop(*spec.derived)
        stage = stage_name(spark, spec.table)
        _save_stage(_merged(old, new, spec, few), spec, stage)
        present = _listed(spark, stage).selectExpr("*", f"true AS {_T}present")
        same = [F.col(quote(c)).eqNullSafe(F.col(f"{_T}{i}")) for i, c in enumerate(columns)]
        both = touched.partitions.join(present, same, "full")
        emptied = both.where(f"{_T}matched AND {_T}present IS NULL").select(touched.partitions.columns)
        outside, left = both.agg(
            F.count_if(F.col(f"{_T}matched").isNull()), F.count_if(F.expr(f"{_T}matched AND {_T}present IS NULL"))
        ).first()
        if outside:
            _drop_helper(spark, stage, spec.table)
            return False
        if left:
            _save_helper(emptied, stage_name(spark, spec.table, "emptied"), spec.table, "parquet")
    finally:
        touched.partitions.unpersist()
    _publish_stage(spark, spec, stage, _TOUCHED)
    return True


def _listed(spark: SparkSession, table: str) -> DataFrame:
    """The partitions of a table as its catalog lists them: their values typed as they are
    when rows are read, and `raw`, the catalog's own text."""
    name, columns = qualified(spark, table), table_info(spark, table).partition_by
    schema = spark.table(name).schema
    value = "url_decode(replace(substring_index(part, '=', -1), '+', '%2B'))"
    values = f"transform(split(partition, '/'), part -> nullif({value}, '__HIVE_DEFAULT_PARTITION__'))"
    typed = [f"CAST({_T}raw[{i}] AS {schema[c].dataType.simpleString()}) AS {quote(c)}" for i, c in enumerate(columns)]
    return spark.sql(f"SHOW PARTITIONS {name}").selectExpr(f"{values} AS {_T}raw").selectExpr(f"{_T}raw", *typed)


def _insert_dynamic(spark: SparkSession, rows: str, table: str) -> None:
    """Replace the partitions that the rows of one table have in another one."""
    other = session_with(spark, {OVERWRITE_MODE: "dynamic"})
    source, target = other.table(qualified(spark, rows)), qualified(spark, table)
    pick(source, other.table(target).columns).write.mode("overwrite").insertInto(target)
    spark.catalog.refreshTable(target)


# --- touched files ----------------------------------------------------------


def _by_file(spec: TableSpec, info: TableInfo) -> bool:
    """Whether single files of the table are to be replaced, and can be."""
    apart = not info.partition_by and not info.bucket_by
    return spec.rewrite == "files" and apart and info.file_format in _SELF_DESCRIBING


def _merge_files(target: DataFrame, new: DataFrame, spec: TableSpec, few: bool, info: TableInfo) -> None:
    """Rewrite only the files that hold a key of the incoming rows.

    Of the table the keys are scanned, then those files. Their names are collected: no more
    than the file index of the table holds on the driver anyway. The stage lies in a hidden
    folder of the table, so its files move into place on any store.
    """
    spark = target.sparkSession
    spark.catalog.refreshTable(qualified(spark, spec.table))
    path = target.metadataColumn("_metadata")["file_path"]
    keys = range(len(spec.keys))
    held = target.select(*[F.col(quote(k)).alias(f"o{i}") for i, k in enumerate(spec.keys)], path.alias("file"))
    wanted = new.select(*[F.col(quote(k)).alias(f"n{i}") for i, k in enumerate(spec.keys)])
    same = F.expr(" AND ".join(f"o{i} = n{i}" for i in keys))
    touched = held.join(F.broadcast(wanted) if few else wanted, same, "left_semi").select("file").distinct()
    replaced = stage_name(spark, spec.table, "files")
    _save_helper(touched, replaced, spec.table, "parquet")
    files = [file for (file,) in spark.table(qualified(spark, replaced)).collect()]
    # The names are constant in each file: others are not opened.
    merged = _merged(target.where(path.isin(files)), new, spec, few)
    folder = f"{info.location.rstrip('/')}/_{_helper(spark, spec.table, 'stage')}"
    _remove_paths(spark, [folder])
    _save_helper(merged, stage_name(spark, spec.table), spec.table, spec.file_format, location=folder)
    _publish_stage(spark, spec, stage_name(spark, spec.table), _FILES)


def _swap_files(spark: SparkSession, table: str, stage: str, replaced: str) -> None:
    """Move the staged files into the table, then remove those they replace. Done again, it
    moves and removes what is left; no row is missing at any time."""
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    source, target = (jvm.org.apache.hadoop.fs.Path(table_info(spark, t).location) for t in (stage, table))
    store = source.getFileSystem(conf)

    def move(file: str) -> None:
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(file))
        if not store.rename(path, jvm.org.apache.hadoop.fs.Path(target, path.getName())) and store.exists(path):
            raise OSError(f"{file} can't be moved to {target}")

    spark.catalog.refreshTable(qualified(spark, stage))
    with ThreadPoolExecutor(_THREADS) as pool:
        list(pool.map(move, spark.table(qualified(spark, stage)).inputFiles()))
    _remove_paths(spark, [file for (file,) in spark.table(qualified(spark, replaced)).collect()], encoded=True)
    spark.catalog.refreshTable(qualified(spark, table))
    if table_info(spark, table).statistics:  # an insert would have dropped them
        spark.sql(f"ANALYZE TABLE {qualified(spark, table)} COMPUTE STATISTICS NOSCAN")


def _remove_paths(spark: SparkSession, paths: Sequence[str], encoded: bool = False) -> None:
    """Remove files or folders, as far as they are there; ``encoded`` paths are URIs."""
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()

    def remove(name: str) -> None:
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(name) if encoded else name)
        path.getFileSystem(conf).delete(path, True)

    with ThreadPoolExecutor(_THREADS) as pool:
        list(pool.map(remove, paths))


# --- whole table ------------------------------------------------------------


def _renames(info: TableInfo) -> bool:
    """Whether another table can take this one's place without moving data."""
    scheme = re.match(r"([\w+.-]+):", info.location)
    return not info.external and (scheme.group(1) if scheme else "file") in _CHEAP_RENAME


def _merge_whole(
    old: DataFrame, new: DataFrame, spec: TableSpec, few: bool, info: TableInfo
) -> None:
    spark = old.sparkSession
    merged = _merged(old, new, spec, few)
    if _renames(info):
        successor = successor_name(spark, spec.table)
        _save_stage(merged, spec, successor, rows_per_file(spec.file_format, spec.file_bytes, old, new))
        _describe(spark, successor, info)
        set_properties(spark, successor, write.derived_properties(spec))
        _take_over(spark, successor, spec.table)
        return
    stage = stage_name(spark, spec.table)
    _save_stage(merged, spec, stage)
    _describe(spark, stage, info)
    _publish_stage(spark, spec, stage, _WHOLE)


def _save_stage(merged: DataFrame, spec: TableSpec, table: str, file_rows: int | None = None) -> None:
    shaped = partition_columns_last(merged, spec.partition_columns)
    _save_helper(
        shaped,
        table,
        spec.table,
        spec.file_format,
        spec.partition_columns,
        spec.bucket_columns,
        spec.num_buckets,
        file_rows,
    )


def _describe(spark: SparkSession, table: str, info: TableInfo) -> None:
    """Give a table the properties and comments of another."""
    own = ("tablesync.", "spark.sql.")
    set_properties(spark, table, {k: v for k, v in info.properties.items() if not k.startswith(own)})
    if info.comment:
        spark.sql(f"COMMENT ON TABLE {qualified(spark, table)} IS {text_literal(info.comment)}")
    for name, comment in info.column_comments.items():
        spark.sql(
            f"ALTER TABLE {qualified(spark, table)} CHANGE COLUMN {quote(name)} COMMENT {text_literal(comment)}"
        )


def _take_over(spark: SparkSession, successor: str, table: str) -> None:
    drop_table(spark, table)
    rename_table(spark, successor, table)
    unset_properties(spark, table, [_OWNER])


# --- publishing a stage -----------------------------------------------------


def _publish_stage(spark: SparkSession, spec: TableSpec, stage: str, reach: str) -> None:
    """Mark the stage as complete, replace the target's rows by it, drop it.

    The mark holds all that ``recover`` needs to do the second step again.
    """
    marks = {_READY: reach} | ({_TARGET_PATH: spec.path} if spec.path else {})
    set_properties(spark, stage, marks | write.derived_properties(spec))
    _replay(spark, spec.table, stage)


def _remove_partitions(spark: SparkSession, table: str, emptied: str) -> None:
    """Drop the partitions listed in a helper table; of an external table, their files before."""
    info, name = table_info(spark, table), qualified(spark, table)
    gone = _Touched(spark.table(qualified(spark, emptied)), few=False)
    if info.external:
        # Dropping the partition of an external table leaves its files.
        files = gone.only(spark.table(name).select("*", "_metadata.file_path"), info.partition_by)
        folders = files.select(F.regexp_extract("file_path", "^(.*)/[^/]*$", 1)).distinct().collect()
        _remove_paths(spark, [folder for (folder,) in folders], encoded=True)
    rows = gone.only(_listed(spark, table), info.partition_by).select(f"{_T}raw").collect()
    for i in range(0, len(rows), _DROPPED_AT_ONCE):
        clauses = ", ".join(f"PARTITION ({_partition_clause(info, row[0])})" for row in rows[i : i + _DROPPED_AT_ONCE])
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {clauses}")
    spark.catalog.refreshTable(name)


def _partition_clause(info: TableInfo, raw: Sequence[str | None]) -> str:
    values = ("NULL" if v is None else text_literal(v) for v in raw)
    return ", ".join(f"{quote(c)} = {v}" for c, v in zip(info.partition_by, values))


def _replay(spark: SparkSession, table: str, stage: str) -> None:
    info = table_info(spark, stage)
    if info.properties[_READY] == _TOUCHED:
        _insert_dynamic(spark, stage, table)
        emptied = stage_name(spark, table, "emptied")
        if _owned(spark, emptied, table):
            _remove_partitions(spark, table, emptied)
            drop_table(spark, emptied)
    elif info.properties[_READY] == _FILES:
        replaced = stage_name(spark, table, "files")
        _swap_files(spark, table, stage, replaced)
        _drop_stage(spark, stage)
        return drop_table(spark, replaced)
    else:
        derived = info.properties.get(write.DERIVED_PROPERTY)
        spec = TableSpec(
            table=table,
            path=info.properties.get(_TARGET_PATH),
            file_format=info.file_format,
            partition_by=info.partition_by,
            bucket_by=info.bucket_by,
            num_buckets=info.num_buckets,
        )
        rows = spark.table(qualified(spark, stage))
        write.save(rows, spec, table, "overwrite", spec.path, rows_per_file(spec.file_format, spec.file_bytes, rows))
        _describe(spark, table, info)
        if derived:
            set_properties(spark, table, {write.DERIVED_PROPERTY: derived})
    drop_table(spark, stage)


def _drop_stage(spark: SparkSession, stage: str) -> None:
    """Drop a stage; of one that lies in its table's folder, the files as well."""
    info = table_info(spark, stage)
    drop_table(spark, stage)
    if info.external:
        _remove_paths(spark, [info.location])


def recover(spark: SparkSession, table: str) -> None:
    """Finish a merge that was broken off while it replaced the table's rows.

    A stage without its mark, or a successor beside a table that still exists,
    was not complete: it is dropped and the table is as before that merge.
    """
    successor, stage = successor_name(spark, table), stage_name(spark, table)
    for role in ("incoming", "hot"):
        _drop_helper(spark, stage_name(spark, table, role), table)
    if _owned(spark, successor, table):
        if table_exists(spark, table):
            drop_table(spark, successor)
        else:
            rename_table(spark, successor, table)
    if table_exists(spark, table):
        finish_rename(spark, table)
    if _owned(spark, stage, table):
        if _READY in table_info(spark, stage).properties:
            _replay(spark, table, stage)
        else:
            _drop_stage(spark, stage)
    for role in ("emptied", "files"):
        _drop_helper(spark, stage_name(spark, table, role), table)
