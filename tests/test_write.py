import datetime as dt
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tablesync import SpecError, TableSpec, append, overwrite, sync
from tablesync import catalog
from tablesync.operators.layout import lay_out

SCHEMA = "id int, country string, day date, tags array<string>"
ROWS = [
    (1, "de", dt.date(2020, 1, 1), ["a", None]),
    (2, "fr", dt.date(2021, 5, 1), []),
    (3, None, None, None),
]


def frame(spark, rows=ROWS, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_managed_partitioned_bucketed(spark, db):
    spec = TableSpec(
        f"{db}.t", partition_by=["country"], derived={"year": "year(day)"}, bucket_by=["country", "id"], num_buckets=2
    )
    overwrite(frame(spark), spec)
    info = catalog.table_info(spark, spec.table)
    assert (info.file_format, info.external) == ("orc", False)
    assert info.partition_by == ("country", "year")
    assert (info.bucket_by, info.num_buckets) == (("id",), 2)
    table = spark.table(spec.table)
    assert table.columns == ["id", "day", "tags", "country", "year"]
    assert table.schema["year"].dataType.simpleString() == "string"
    assert table.schema["tags"].dataType.simpleString() == "string"  # JSON text
    assert rows(table.select("id", "tags", "country", "year")) == [
        (1, '["a",null]', "de", "2020"),
        (2, "[]", "fr", "2021"),
        (3, None, None, None),
    ]


def test_external_table_and_kept_nesting(spark, db, tmp_path):
    path = str(tmp_path / "ext")
    spec = TableSpec(f"{db}.t", path=path, file_format="parquet", nested="keep", derived={"y": "year(day)"})
    overwrite(frame(spark), spec)
    overwrite(frame(spark, ROWS[:1]), spec)
    info = catalog.table_info(spark, spec.table)
    assert info.external and info.location.endswith(path) and info.file_format == "parquet"
    assert spark.table(spec.table).schema["tags"].dataType.simpleString() == "array<string>"
    # The files of the first write are gone, not just unregistered.
    assert {p.name for p in Path(path).iterdir() if "=" in p.name} == {"y=2020"}
    assert spark.read.parquet(path).count() == 1
    catalog.drop_table(spark, spec.table)
    assert spark.read.parquet(path).count() == 1
    overwrite(frame(spark), spec)  # onto files that are still there
    assert spark.table(spec.table).count() == 3


def test_overwrite_replaces_columns_and_layout(spark, db):
    overwrite(frame(spark), TableSpec(f"{db}.t", partition_by=["country"]))
    overwrite(frame(spark).select("id"), TableSpec(f"{db}.t", file_format="parquet"))
    assert spark.table(f"{db}.t").columns == ["id"]
    info = catalog.table_info(spark, f"{db}.t")
    assert (info.partition_by, info.file_format) == ((), "parquet")


@pytest.mark.parametrize("external", [False, True])
def test_static_overwrite_even_in_a_dynamic_session(spark, db, tmp_path, external):
    spec = TableSpec(f"{db}.t", partition_by=["country"], path=str(tmp_path / "x") if external else None)
    overwrite(frame(spark), spec)
    with catalog.session_conf(spark, {"spark.sql.sources.partitionOverwriteMode": "dynamic"}):
        overwrite(frame(spark, ROWS[:1]), spec)
        assert spark.table(spec.table).count() == 1
        # and later inserts are the session's again
        spark.table(spec.table).selectExpr("*").where("false").write.mode("overwrite").insertInto(spec.table)
    assert spark.table(spec.table).count() == 1


def test_two_threads_with_different_overwrite_modes(spark, db, tmp_path):
    """Merges replace partitions while overwrites in the same session replace whole tables."""
    old = spark.range(60).selectExpr("id", "CAST(id % 6 AS STRING) AS p", "'old' AS v")
    merged = TableSpec(f"{db}.m", mode="merge", keys=["id"], partition_by=["p"])
    overwrite(old, merged)

    def merges(_):
        sync(spark.range(3).selectExpr("id", "CAST(id % 6 AS STRING) AS p", "'new' AS v"), merged)
        return spark.table(merged.table).count()

    def overwrites(i):
        spec = TableSpec(f"{db}.o{i}", partition_by=["p"], path=str(tmp_path / f"o{i}"))
        overwrite(old, spec)
        overwrite(old.where("p = '1'"), spec)
        return spark.table(spec.table).count()

    with ThreadPoolExecutor(2) as pool:
        first, second = pool.submit(lambda: [merges(i) for i in range(3)]), pool.submit(lambda: [overwrites(i) for i in range(3)])
        assert (first.result(), second.result()) == ([60] * 3, [10] * 3)


def test_sync_modes_and_missing_schema(spark, db):
    name = f"{db}_made.t"
    sync(frame(spark), TableSpec(name))
    sync(frame(spark), TableSpec(name, mode="append"))
    assert spark.table(name).count() == 6
    sync(frame(spark), TableSpec(name, mode="overwrite"))
    assert spark.table(name).count() == 3
    sync(frame(spark), TableSpec(f"{db}_made.u", mode="append"))
    assert spark.table(f"{db}_made.u").count() == 3


def test_append_takes_the_layout_of_the_table(spark, db, tmp_path):
    spec = TableSpec(
        f"{db}.t", path=str(tmp_path / "x"), file_format="parquet", derived={"y": "year(day)"},
        bucket_by=["id"], num_buckets=2,
    )
    overwrite(frame(spark), spec)
    append(frame(spark).select("tags", "day", "country", "id"), TableSpec(f"{db}.t", derived={"Y": "year(day)"}))
    append(frame(spark), spec)
    assert rows(spark.table(spec.table).groupBy("id", "country", "y").count()) == [
        (1, "de", "2020", 3), (2, "fr", "2021", 3), (3, None, None, 3),
    ]
    for wrong, message in [
        (TableSpec(f"{db}.t", file_format="orc"), "has format parquet"),
        (TableSpec(f"{db}.t", partition_by=["country"]), "has partition columns"),
        (TableSpec(f"{db}.t", bucket_by=["country"], num_buckets=2), "has bucket columns"),
        (TableSpec(f"{db}.t", bucket_by=["id"], num_buckets=3), "has bucket count 2"),
        (TableSpec(f"{db}.t", path=str(tmp_path / "y")), "the spec asks for"),
    ]:
        with pytest.raises(SpecError, match=message):
            append(frame(spark), wrong)
    with pytest.raises(SpecError, match="missing .'country'."):
        append(frame(spark).drop("country"), spec)
    with pytest.raises(SpecError, match="unknown .'more'."):
        append(frame(spark).withColumn("more", F.lit(1)), spec)
    overwrite(frame(spark), TableSpec(f"{db}.m"))
    with pytest.raises(SpecError, match="is managed"):
        append(frame(spark), TableSpec(f"{db}.m", path="/elsewhere"))


def test_number_of_files(spark, db):
    many = spark.range(1000).selectExpr("cast(id as int) id", "'x' country")
    overwrite(many, TableSpec(f"{db}.t", num_partitions=3))
    files = spark.table(f"{db}.t").select("_metadata.file_path").distinct()
    assert files.count() == 3
    # One file per directory although eight tasks read the rows.
    spread = spark.range(0, 1000, 1, 8).selectExpr("id", "id % 4 AS p")
    overwrite(spread, TableSpec(f"{db}.p", partition_by=["p"]))
    assert spark.table(f"{db}.p").select("_metadata.file_path").distinct().count() == 4
    overwrite(spread, TableSpec(f"{db}.b", bucket_by=["id"], num_buckets=4))
    assert spark.table(f"{db}.b").select("_metadata.file_path").distinct().count() == 4


def test_a_hot_partition_is_written_by_several_tasks(spark, db):
    rows_ = spark.range(0, 400_000, 1, 8).selectExpr("id", "hash(id) AS v", "if(id % 10 < 6, 'hot', cast(id % 10 as string)) AS p")
    settings = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "200k"}
    with catalog.session_conf(spark, settings):
        overwrite(rows_, TableSpec(f"{db}.t", partition_by=["p"]))
    files = dict(
        spark.table(f"{db}.t").groupBy("p").agg(F.countDistinct("_metadata.file_path")).collect()
    )
    assert files["hot"] > 2, files
    assert spark.table(f"{db}.t").count() == 400_000


def test_layout_plans(spark):
    df = spark.range(10).selectExpr("id", "id AS `a.b`")
    plan = lambda d: d._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan(lay_out(df))
    assert "REBALANCE_PARTITIONS_BY_COL" in plan(lay_out(df, ["a.b"]))
    assert "hashpartitioning(a.b" in plan(lay_out(df, ["a.b"], num_partitions=5))
    assert "RoundRobinPartitioning(5)" in plan(lay_out(df, num_partitions=5))


def test_layout_without_adaptive_execution(spark, db):
    df = spark.range(0, 4000, 1, 8).selectExpr("id", "if(id % 8 < 6, 'hot', 'x') AS `p.q`")
    with catalog.session_conf(spark, {"spark.sql.adaptive.enabled": "false"}):
        overwrite(df, TableSpec(f"{db}.t", partition_by=["p.q"]))
        overwrite(df, TableSpec(f"{db}.b", bucket_by=["id"], num_buckets=4))
    table = spark.table(f"{db}.t")
    assert table.count() == spark.table(f"{db}.b").count() == 4000
    files = dict(table.groupBy("`p.q`").agg(F.countDistinct("_metadata.file_path")).collect())
    assert 2 <= files["hot"] <= 8


def test_catalog_helpers(spark, db):
    assert not catalog.table_exists(spark, f"{db}.t") and not catalog.table_exists(spark, "no_such_db.t")
    catalog.drop_table(spark, f"{db}.t")
    overwrite(frame(spark), TableSpec(f"{db}.t", partition_by=["country"]))
    assert catalog.table_exists(spark, f"{db.upper()}.T")
    catalog.rename_table(spark, f"{db}.t", f"{db}.u")
    assert not catalog.table_exists(spark, f"{db}.t")
    assert spark.table(f"{db}.u").count() == 3
    catalog.set_properties(spark, f"{db}.u", {"a'b": "c\\d'e"})
    assert catalog.table_info(spark, f"{db}.u").properties["a'b"] == "c\\d'e"


def test_paths_on_other_stores_differ(spark):
    from tablesync.plans.write import _same_path

    assert _same_path(spark, "/a/b/", "file:/a/b") and _same_path(spark, "file:///a/b", "file:/a/b")
    assert not _same_path(spark, "s3a://one/x", "s3a://two/x")


def test_few_files_per_bucket(spark, db):
    from pyspark.sql import functions as F

    df = spark.range(0, 6000, 1, 8).select("id", (F.col("id") % 3).cast("string").alias("p"))
    for i, tasks in enumerate((None, 50)):
        spec = TableSpec(f"{db}.t{i}", partition_by=["p"], bucket_by=["id"], num_buckets=16, num_partitions=tasks)
        overwrite(df, spec)
        files = spark.table(spec.table).select("_metadata.file_path").distinct().count()
        assert files <= 48 + 4, files


def test_csv_files_have_about_the_target_size(spark, db):
    rows_ = spark.range(0, 2000, 1, 1).selectExpr("id", "repeat('line\n', CAST(id % 50 AS INT)) AS text")
    spec = TableSpec(f"{db}.t", mode="merge", keys=["id"], file_format="csv", file_bytes=40_000)
    overwrite(rows_, spec)
    for _ in range(2):
        found = spark.table(spec.table)
        sizes = [r[0] for r in found.select("_metadata.file_path", "_metadata.file_size").distinct().select("file_size").collect()]
        assert len(sizes) >= 5 and max(sizes) < 80_000, sizes
        assert sorted(map(tuple, found.collect())) == sorted(map(tuple, rows_.collect()))
        sync(rows_.where("id < 10"), spec)
