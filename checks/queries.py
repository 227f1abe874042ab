"""One query per operator: each writes or reads tables made of the given ones and
returns what a reader of the result sees."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

import tablesync as ts
from tablesync import catalog
from tablesync.spec import FILE_FORMATS


class Workspace:
    """A fresh schema and folder: in the cluster's shared folder where it names
    one, in the warehouse otherwise."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self.db = f"ts_{uuid.uuid4().hex[:12]}"
        shared = catalog.shared_folder(spark) or spark.conf.get("spark.sql.warehouse.dir")
        self.base = f"{shared.rstrip('/')}/{self.db}"
        catalog.ensure_schema(spark, self.db, f"{self.base}/managed")

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def table(self, name: str = "t") -> DataFrame:
        return self.spark.table(f"{self.db}.{name}")

    def path(self, name: str) -> str:
        return f"{self.base}/{name}"

    def spec(self, name: str = "t", external: bool = False, **options) -> ts.TableSpec:
        if external:
            options["path"] = self.path(f"external_{name}")
        return ts.TableSpec(f"{self.db}.{name}", **options)


Query = Callable[[Workspace], DataFrame]
BY_YEAR = {"o_year": "year(o_orderdate)"}


def order_changes(orders: DataFrame) -> DataFrame:
    """A change set as large as the table: new keys for finished orders, changes
    for the others, with nulls where the old status is to stay."""
    return orders.select(
        F.when(F.col("o_orderstatus") == "F", -F.col("o_orderkey"))
        .otherwise(F.col("o_orderkey"))
        .alias("o_orderkey"),
        (F.col("o_custkey") + 1).alias("o_custkey"),
        F.when(F.col("o_orderpriority") != "1-URGENT", "X").alias("o_orderstatus"),
        (F.col("o_totalprice") * 2).alias("o_totalprice"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.expr("o_orderdate + interval 400 days"))
        .otherwise(F.col("o_orderdate"))
        .alias("o_orderdate"),
        F.when(F.col("o_orderpriority") != "2-HIGH", F.lower("o_orderpriority")).alias("o_orderpriority"),
    )


# --- scans and ingest ---------------------------------------------------------


def scan_parquet(w: Workspace) -> DataFrame:
    return ts.scan_parquet(w.spark, f"{w.sf_dir}/orders.parquet")


def scan_orc(w: Workspace) -> DataFrame:
    w.read("orders").write.orc(w.path("orc"))
    return ts.scan_orc(w.spark, w.path("orc"))


def scan_csv_inferred(w: Workspace) -> DataFrame:
    w.read("customer").write.option("header", True).csv(w.path("csv"))
    return ts.scan_csv(w.spark, w.path("csv"))


def typed_ingest(w: Workspace) -> DataFrame:
    w.read("orders").select(
        "o_orderkey",
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("insert_ts"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_date"),
        F.col("o_totalprice").alias("price"),
        (F.col("o_totalprice") > 100000).cast("string").alias("is_large"),
    ).write.option("header", True).csv(w.path("csv"))
    text = T.StructType.fromDDL(
        "o_orderkey bigint, insert_ts string, order_date string, price string, is_large string"
    )
    typed = ts.typed_ingest(
        ts.scan_csv(w.spark, w.path("csv"), text),
        timestamps=["insert_ts"],
        dates=["order_date"],
        amounts=["price"],
        booleans=["is_large"],
    )
    return typed.withColumn("insert_ts", F.col("insert_ts").cast("timestamp_ntz"))


# --- projections ----------------------------------------------------------------


def scalars_to_text(w: Workspace) -> DataFrame:
    return ts.scalars_to_text(w.read("events"))


def text_to_typed(w: Workspace) -> DataFrame:
    events = w.read("events")
    return ts.text_to_typed(ts.scalars_to_text(events), events.schema)


def nested_to_json(w: Workspace) -> DataFrame:
    rows = w.read("customer").select(
        "c_custkey",
        F.struct(F.col("c_custkey").alias("key"), F.col("c_name").alias("name")).alias("as_struct"),
        F.array(F.col("c_custkey"), F.col("c_nationkey").cast("bigint")).alias("as_array"),
        F.create_map("c_mktsegment", "c_nationkey").alias("as_map"),
    )
    ts.overwrite(rows, w.spec())
    return w.table()


def keep_nested(w: Workspace) -> DataFrame:
    ts.overwrite(w.read("embeddings"), w.spec(nested="keep", file_format="parquet"))
    return w.table().select(
        "vec_id", "label", F.posexplode("embedding").alias("position", "component")
    )


def derived_partition(w: Workspace) -> DataFrame:
    return ts.add_derived(w.read("orders"), BY_YEAR)


def partition_columns_last(w: Workspace) -> DataFrame:
    return ts.partition_columns_last(w.read("orders"), ["o_orderstatus", "o_orderpriority"])


# --- writes -----------------------------------------------------------------------


def _in_all_formats(w: Workspace, name: str) -> DataFrame:
    read = []
    for file_format in FILE_FORMATS:
        ts.overwrite(w.read(name), w.spec(file_format, external=True, file_format=file_format))
        read.append(w.table(file_format).withColumn("file_format", F.lit(file_format)))
    return reduce(DataFrame.unionByName, read)


def write_formats(w: Workspace) -> DataFrame:
    return _in_all_formats(w, "customer")


def write_formats_events(w: Workspace) -> DataFrame:
    return _in_all_formats(w, "events")


def write_formats_documents(w: Workspace) -> DataFrame:
    return _in_all_formats(w, "documents")


def write_bucketed(w: Workspace) -> DataFrame:
    ts.overwrite(w.read("orders"), w.spec(bucket_by=["o_custkey"], num_buckets=4))
    return w.table()


def write_bucketed_partitioned(w: Workspace) -> DataFrame:
    spec = w.spec(
        partition_by=["o_orderstatus"],
        bucket_by=["o_orderstatus", "o_custkey"],
        num_buckets=4,
    )
    ts.overwrite(w.read("orders"), spec)
    return w.table()


def write_repartitioned(w: Workspace) -> DataFrame:
    ts.overwrite(w.read("orders"), w.spec(num_partitions=3))
    return w.table()


def _overwritten(w: Workspace, external: bool, by_year: bool) -> DataFrame:
    """Write other rows first: none of them may be left."""
    final = w.read("orders")
    first = final.withColumn("o_orderkey", -F.col("o_orderkey")).withColumn(
        "o_orderdate", F.expr("o_orderdate + interval 10 years")
    )
    spec = w.spec(external=external, derived=BY_YEAR if by_year else {})
    ts.overwrite(first, spec)
    ts.overwrite(final, spec)
    return w.table()


def overwrite_managed(w: Workspace) -> DataFrame:
    return _overwritten(w, external=False, by_year=False)


def overwrite_managed_partitioned(w: Workspace) -> DataFrame:
    return _overwritten(w, external=False, by_year=True)


def overwrite_external(w: Workspace) -> DataFrame:
    return _overwritten(w, external=True, by_year=False)


def overwrite_external_partitioned(w: Workspace) -> DataFrame:
    return _overwritten(w, external=True, by_year=True)


DYNAMIC = {"spark.sql.sources.partitionOverwriteMode": "dynamic"}


def overwrite_external_in_dynamic_session(w: Workspace) -> DataFrame:
    with catalog.session_conf(w.spark, DYNAMIC):
        return _overwritten(w, external=True, by_year=True)


def append_missing_table(w: Workspace) -> DataFrame:
    ts.append(w.read("customer"), w.spec())
    return w.table()


def append_existing(w: Workspace) -> DataFrame:
    customer = w.read("customer")
    ts.overwrite(customer, w.spec())
    ts.append(customer.withColumn("c_custkey", -F.col("c_custkey")), w.spec())
    return w.table()


def append_partitioned(w: Workspace) -> DataFrame:
    orders = w.read("orders")
    spec = w.spec(derived=BY_YEAR)
    ts.overwrite(orders, spec)
    later = orders.withColumn("o_orderkey", -F.col("o_orderkey")).withColumn(
        "o_orderdate", F.expr("o_orderdate + interval 400 days")
    )
    ts.append(later, spec)
    return w.table()


# --- merges -----------------------------------------------------------------------


# Incoming rows that fit a broadcast would all take that way: most merges here turn
# it off, so that the full outer join is what gets checked.
JOINED = {"broadcast_bytes": 0}


def _merged_orders(w: Workspace, **options) -> DataFrame:
    orders = w.read("orders")
    spec = w.spec(keys=["o_orderkey"], **options)
    ts.overwrite(orders, spec)
    ts.merge(order_changes(orders), spec)
    return w.table()


def merge_missing_table(w: Workspace) -> DataFrame:
    ts.merge(order_changes(w.read("orders")), w.spec())
    return w.table()


def merge_managed(w: Workspace) -> DataFrame:
    return _merged_orders(w, **JOINED)


def merge_managed_partitioned(w: Workspace) -> DataFrame:
    return _merged_orders(w, derived=BY_YEAR, **JOINED)


def merge_external(w: Workspace) -> DataFrame:
    return _merged_orders(w, external=True, **JOINED)


def merge_external_partitioned(w: Workspace) -> DataFrame:
    return _merged_orders(w, external=True, partition_by=["o_orderstatus"], **JOINED)


def _by_file(w: Workspace, **options) -> DataFrame:
    """Orders in files by key range; changes come in for the upper half of the keys and the new keys."""
    orders = w.read("orders")
    spec = w.spec(keys=["o_orderkey"], rewrite="files", **options)
    ts.overwrite(orders.repartitionByRange(8, "o_orderkey"), spec)
    middle = orders.selectExpr("percentile(o_orderkey, 0.5)").first()[0]
    ts.merge(order_changes(orders).where((F.col("o_orderkey") < 0) | (F.col("o_orderkey") > middle)), spec)
    return w.table()


def merge_by_file(w: Workspace) -> DataFrame:
    return _by_file(w)


def merge_by_file_external(w: Workspace) -> DataFrame:
    return _by_file(w, external=True, file_format="parquet", **JOINED)


def merge_rewriting_all_in_dynamic_session(w: Workspace) -> DataFrame:
    """Changed statuses move rows to other partitions; none may stay in the old one."""
    with catalog.session_conf(w.spark, DYNAMIC):
        return _merged_orders(w, external=True, partition_by=["o_orderstatus"], rewrite="all", **JOINED)


def _merged_hours(w: Workspace, external: bool) -> DataFrame:
    """Events by the hour, a timestamp; purchases are changed, in a zone that is not the process's."""
    rows = w.read("events").select("event_id", "value", "ts")
    with catalog.session_conf(w.spark, {"spark.sql.session.timeZone": "Asia/Kolkata"}):
        hour = F.date_trunc("hour", F.col("ts").cast("timestamp"))
        spec = w.spec(keys=["event_id"], partition_by=["hour"], external=external)
        ts.overwrite(rows.select("event_id", "value", hour.alias("hour")), spec)
        changed = w.read("events").where("event_type = 'purchase'").withColumn("value", -F.col("value"))
        ts.merge(changed.select("event_id", "value", hour.alias("hour")), spec)
    return w.table().select("event_id", "value", F.col("hour").cast("timestamp_ntz").alias("hour"))


def merge_timestamp_partition(w: Workspace) -> DataFrame:
    return _merged_hours(w, external=False)


def merge_timestamp_partition_external(w: Workspace) -> DataFrame:
    return _merged_hours(w, external=True)


def merge_emptied_partitions(w: Workspace) -> DataFrame:
    """All events of one type move to the partition of another, hour by hour; theirs are emptied."""
    rows = w.read("events").withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    spec = w.spec(keys=["event_id"], partition_by=["event_type", "day"], external=True)
    ts.overwrite(rows, spec)
    ts.merge(rows.where("event_type = 'click'").withColumn("event_type", F.lit("view")), spec)
    days = w.spark.sql(f"SHOW PARTITIONS {spec.table}").where("partition LIKE 'event_type=click/%'").count()
    return w.table().withColumn("days_left", F.lit(days).cast("long"))


def write_csv_in_files_of_bounded_size(w: Workspace) -> DataFrame:
    """All documents as csv, and in how many files they are, at a target of 256 KiB a file."""
    ts.overwrite(w.read("documents"), w.spec(file_format="csv", file_bytes=256 * 1024))
    files = w.table().select("_metadata.file_path").distinct().count()
    return w.table().withColumn("in_several_files", F.lit(files > 1))


def merge_bucketed(w: Workspace) -> DataFrame:
    return _merged_orders(w, bucket_by=["o_orderkey"], num_buckets=8, **JOINED)


def merge_partition_follows_key(w: Workspace) -> DataFrame:
    return _merged_orders(w, derived={"key_range": "o_orderkey div 5000"})


def merge_broadcast(w: Workspace) -> DataFrame:
    return _merged_orders(w)


def merge_broadcast_partitioned(w: Workspace) -> DataFrame:
    return _merged_orders(w, external=True, partition_by=["o_orderstatus"], derived=BY_YEAR)


def merge_composite_key(w: Workspace) -> DataFrame:
    talks = w.read("conversations")
    spec = w.spec(keys=["conv_id", "turn"], **JOINED)
    ts.overwrite(talks, spec)
    ts.merge(
        talks.select(
            "conv_id",
            F.when(F.col("role") == "user", F.col("turn")).otherwise(F.col("turn") + 1000).alias("turn"),
            F.when(F.col("turn") > 0, F.upper("role")).alias("role"),
            F.lower("text").alias("text"),
        ),
        spec,
    )
    return w.table()


def merge_null_update(w: Workspace) -> DataFrame:
    orders = w.read("orders")
    ts.overwrite(orders, w.spec())
    key = F.when(F.col("o_orderstatus") == "F", -F.col("o_orderkey")).otherwise(F.col("o_orderkey"))
    nulls = [F.lit(None).cast(f.dataType).alias(f.name) for f in orders.schema if f.name != "o_orderkey"]
    ts.merge(orders.select(key.alias("o_orderkey"), *nulls), w.spec(keys=["o_orderkey"]))
    return w.table()


def _merged_with_blanks(w: Workspace, **options) -> DataFrame:
    """Orders whose status is empty text for one value and null for another, merged with changes."""
    status = F.when(F.col("o_orderstatus") == "F", "").when(F.col("o_orderstatus") == "O", "O")
    orders = w.read("orders").withColumn("o_orderstatus", status)
    spec = w.spec(keys=["o_orderkey"], **options)
    ts.overwrite(orders, spec)
    few = w.read("orders").where("o_orderpriority = '1-URGENT'")
    ts.merge(few.withColumns({"o_orderkey": -F.col("o_orderkey"), "o_orderstatus": F.lit("")}), spec)
    return w.table()


def merge_empty_partition_text(w: Workspace) -> DataFrame:
    return _merged_with_blanks(w, partition_by=["o_orderstatus"])


def merge_empty_partition_text_external(w: Workspace) -> DataFrame:
    return _merged_with_blanks(w, partition_by=["o_orderstatus"], external=True)


def merge_empty_derived_text(w: Workspace) -> DataFrame:
    return _merged_with_blanks(w, derived={"tail": "substr(o_orderstatus, 2, 3)"})


def merge_two_partition_columns(w: Workspace) -> DataFrame:
    return _merged_orders(w, partition_by=["o_orderstatus", "o_orderpriority"], **JOINED)


def append_then_merge_derived(w: Workspace) -> DataFrame:
    """Rows come by append and by merge into a table with a derived partition."""
    orders = w.read("orders")
    spec = w.spec(keys=["o_orderkey"], derived=BY_YEAR)
    ts.overwrite(orders.where("o_orderstatus = 'F'"), spec)
    ts.append(orders.where("o_orderstatus <> 'F'"), spec)
    ts.merge(order_changes(orders), spec)
    return w.table()


def merge_null_keys(w: Workspace) -> DataFrame:
    orders = w.read("orders").withColumn(
        "o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_orderkey"))
    )
    spec = w.spec(keys=["o_orderkey"], **JOINED)
    ts.overwrite(orders, spec)
    ts.merge(orders.withColumn("o_orderstatus", F.lower("o_orderstatus")), spec)
    return w.table()


def merge_duplicate_keys(w: Workspace) -> DataFrame:
    lines = w.read("lineitem")
    spec = w.spec(keys=["l_orderkey", "l_linenumber"], **JOINED)
    ts.overwrite(lines, spec)
    ts.merge(
        lines.withColumns(
            {
                "l_quantity": F.when(F.col("l_returnflag") != "N", F.col("l_quantity") * 2),
                "l_linestatus": F.lower("l_linestatus"),
            }
        ),
        spec,
    )
    return w.table()


def merge_hot_key(w: Workspace) -> DataFrame:
    """One key holds a fifth of the existing events, another of the incoming ones."""
    events = w.read("events")
    types = events.select("event_type").distinct()
    hot_old, hot_new = types.agg(F.min("event_type"), F.max("event_type")).first()
    spec = w.spec(keys=["event_id"], hot_key_rows=100, **JOINED)

    def keyed(hot: str, key: int) -> DataFrame:
        return events.withColumn(
            "event_id",
            F.when(F.col("event_type") == hot, F.lit(key)).otherwise(F.col("event_id")).cast("bigint"),
        )

    ts.overwrite(keyed(hot_old, -1), spec)
    ts.merge(
        keyed(hot_new, -2).withColumn("value", F.when(F.col("event_type") != hot_new, -F.col("value"))),
        spec,
    )
    return w.table()


def merge_hot_on_both_sides(w: Workspace) -> DataFrame:
    """Every key has more rows than `hot_key_rows` on both sides."""
    events = w.read("events").withColumn("event_id", F.expr("event_id div 8"))
    spec = w.spec(keys=["event_id"], hot_key_rows=3, **JOINED)
    ts.overwrite(events, spec)
    ts.merge(events.withColumn("value", F.when(F.col("user_id") % 2 == 0, -F.col("value"))), spec)
    return w.table()


# --- registration and catalog -----------------------------------------------------


def register_files(w: Workspace) -> DataFrame:
    ts.register_files(w.spark, f"{w.db}.t", f"{w.sf_dir}/orders.parquet", "parquet")
    return w.table()


def _orders_by(w: Workspace, *columns: str, file_format: str = "parquet") -> str:
    path = w.path("dataset")
    rows = ts.add_derived(w.read("orders"), BY_YEAR)
    rows.hint("rebalance", *columns).write.partitionBy(*columns).format(file_format).save(path)
    return path


def register_partitioned(w: Workspace) -> DataFrame:
    ts.register_files(
        w.spark, f"{w.db}.t", _orders_by(w, "o_year"), "parquet", infer_partition_types=False
    )
    return w.table()


def discover_partitions(w: Workspace) -> DataFrame:
    """The partition columns of all orders, with the rows found in each directory."""
    path = _orders_by(w, "o_orderstatus", "o_year", file_format="orc")
    names = ts.discover_partitions(w.spark, path, "orc")
    rows = ts.scan(w.spark, path, "orc", infer_partition_types=False)
    return reduce(
        DataFrame.unionAll,
        [
            rows.groupBy(F.col(n).alias("value"))
            .agg(F.count("*").alias("n_rows"))
            .select(F.lit(i).alias("level"), F.lit(n).alias("name"), "value", "n_rows")
            for i, n in enumerate(names, 1)
        ],
    )


def describe_ddl(w: Workspace) -> DataFrame:
    """The declared type of each column of a registered table, against the type and
    number of the values read through it."""
    path = _orders_by(w, "o_year")
    schema = ts.scan(w.spark, path, "parquet", infer_partition_types=False).schema
    w.spark.sql(ts.create_table_ddl(schema, f"{w.db}.t", path, "parquet", ["o_year"]))
    catalog.repair_table(w.spark, f"{w.db}.t")
    declared = ts.describe_ddl(schema, ["o_year"])
    totals = w.table().agg(
        *[F.count(n).alias(n) for n, _, _ in declared],
        *[F.max(F.typeof(n)).alias(f"{n}_type") for n, _, _ in declared],
    )
    return totals.select(
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(n).alias("column_name"),
                        F.lit(t).alias("declared_type"),
                        F.col(f"{n}_type").alias("read_type"),
                        F.lit(s).alias("section"),
                        F.col(n).alias("n_values"),
                    )
                    for n, t, s in declared
                ]
            )
        ).alias("c")
    ).select("c.*")


def relocate_dataset(w: Workspace) -> DataFrame:
    """The second copy replaces the first, of other rows, in a session whose overwrites are dynamic."""
    source, target, other = _orders_by(w, "o_orderstatus", "o_year"), w.path("copy"), w.path("other")
    rows = ts.add_derived(w.read("orders").withColumn("o_orderstatus", F.lit("old")), BY_YEAR)
    rows.write.partitionBy("o_orderstatus", "o_year").parquet(other)
    with catalog.session_conf(w.spark, {"spark.sql.sources.partitionOverwriteMode": "dynamic"}):
        ts.relocate_dataset(w.spark, other, target)
        ts.relocate_dataset(w.spark, source, target)
    return ts.scan(w.spark, target, "parquet", infer_partition_types=False)


def catalog_lifecycle(w: Workspace) -> DataFrame:
    spark, first, second = w.spark, f"{w.db}.first", f"{w.db}.second"
    catalog.ensure_schema(spark, w.db)
    catalog.drop_table(spark, first)
    ts.overwrite(w.read("orders"), w.spec("first", partition_by=["o_orderstatus"]))
    ts.overwrite(w.read("customer"), w.spec("second"))
    catalog.drop_table(spark, second)
    catalog.rename_table(spark, first, second)
    seen = [str(catalog.table_exists(spark, t)).lower() for t in (first, second)]
    return w.table("second").withColumn("tables_seen", F.lit(",".join(seen)))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        scan_parquet,
        scan_orc,
        scan_csv_inferred,
        typed_ingest,
        scalars_to_text,
        text_to_typed,
        nested_to_json,
        keep_nested,
        derived_partition,
        partition_columns_last,
        write_formats,
        write_formats_events,
        write_formats_documents,
        write_csv_in_files_of_bounded_size,
        write_bucketed,
        write_bucketed_partitioned,
        write_repartitioned,
        overwrite_managed,
        overwrite_managed_partitioned,
        overwrite_external,
        overwrite_external_partitioned,
        overwrite_external_in_dynamic_session,
        append_missing_table,
        append_existing,
        append_partitioned,
        merge_missing_table,
        merge_managed,
        merge_managed_partitioned,
        merge_external,
        merge_external_partitioned,
        merge_by_file,
        merge_by_file_external,
        merge_rewriting_all_in_dynamic_session,
        merge_timestamp_partition,
        merge_timestamp_partition_external,
        merge_emptied_partitions,
        merge_bucketed,
        merge_broadcast,
        merge_broadcast_partitioned,
        merge_partition_follows_key,
        merge_composite_key,
        merge_null_update,
        merge_empty_partition_text,
        merge_empty_partition_text_external,
        merge_empty_derived_text,
        merge_two_partition_columns,
        append_then_merge_derived,
        merge_null_keys,
        merge_duplicate_keys,
        merge_hot_key,
        merge_hot_on_both_sides,
        register_files,
        register_partitioned,
        discover_partitions,
        describe_ddl,
        relocate_dataset,
        catalog_lifecycle,
    )
}
