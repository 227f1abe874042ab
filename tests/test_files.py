import pytest
from pyspark.sql import functions as F, types as T

from tablesync import (
    SpecError,
    discover_partitions,
    jdbc_append,
    jdbc_scan,
    register_files,
    registration_ddl,
    relocate_dataset,
    scan,
    scan_csv,
)
from tablesync.sources.jdbc import jdbc_options


@pytest.fixture
def dataset(spark, tmp_path):
    path = str(tmp_path / "base=dir" / "data")
    spark.range(20).selectExpr(
        "id", "lpad(id % 3, 2, '0') AS c", "if(id % 5 = 0, null, concat('a b/', id % 2)) AS `k l`"
    ).write.partitionBy("c", "k l").parquet(path)
    return path


def test_discover(spark, dataset, tmp_path):
    assert discover_partitions(spark, dataset) == ["c", "k l"]
    assert discover_partitions(spark, f"file:{dataset}/") == ["c", "k l"]
    spark.range(3).write.orc(str(tmp_path / "flat"))
    assert discover_partitions(spark, str(tmp_path / "flat"), "orc") == []
    spark.range(3).selectExpr("id", "id p").where("id > 5").write.partitionBy("p").parquet(str(tmp_path / "none"))
    with pytest.raises(Exception):  # no file, no schema
        discover_partitions(spark, str(tmp_path / "none"))


def test_files_without_rows(spark, tmp_path):
    path = tmp_path / "empty"
    spark.range(3).where("id > 5").write.parquet(str(path / "p=1"))
    assert discover_partitions(spark, str(path)) == ["p"]


def test_formats_are_checked_first(spark):
    for call in (scan, discover_partitions):
        with pytest.raises(SpecError, match="file format must be one of"):
            call(spark, "/no/such/path", "avro")


def test_register(spark, db, dataset):
    statements = register_files(spark, f"{db}.t", dataset, "parquet", infer_partition_types=False)
    assert len(statements) == 2 and statements[1].startswith("MSCK REPAIR")
    table = spark.table(f"{db}.t")
    assert table.columns == ["id", "c", "k l"]
    assert table.count() == 20 and table.where("c = '01'").count() == 7
    assert table.where("`k l` is null").count() == 4
    # An existing table is left alone; new directories are registered.
    spark.createDataFrame([(99,)], "id long").write.parquet(f"{dataset}/c=09/k l=z")
    register_files(spark, f"{db}.t", dataset, "parquet", infer_partition_types=False)
    assert spark.table(f"{db}.t").count() == 21
    assert spark.catalog.getTable(f"{db}.t").tableType == "EXTERNAL"

    inferred, repair = registration_ddl(spark, f"{db}.u", dataset, "parquet")
    assert "PARTITIONED BY (`c` int, `k l` string)" in inferred and repair
    hive, _ = registration_ddl(spark, f"{db}.u", dataset, "PARQUET", dialect="hive")
    assert hive.startswith("CREATE EXTERNAL TABLE") and "STORED AS PARQUET" in hive


def test_register_makes_the_schema(spark, db, tmp_path):
    spark.range(5).write.orc(str(tmp_path / "o"))
    assert len(register_files(spark, f"{db}_new.t", str(tmp_path / "o"), "orc")) == 1
    assert spark.table(f"{db}_new.t").count() == 5


def test_relocate(spark, dataset, tmp_path):
    target = str(tmp_path / "copy")
    spark.range(7).write.parquet(target)  # is replaced
    assert relocate_dataset(spark, dataset, target) == ["c", "k l"]
    relocate_dataset(spark, dataset, target)
    read = lambda p, f: sorted(map(tuple, scan(spark, p, f, infer_partition_types=False).collect()))
    key = lambda rows: sorted(rows, key=repr)
    source = key(map(tuple, scan(spark, dataset, "parquet", False).collect()))
    assert key(map(tuple, scan(spark, target, "parquet", False).collect())) == source
    assert (tmp_path / "copy" / "c=01").is_dir()
    relocate_dataset(spark, dataset, str(tmp_path / "orc"), target_format="orc")
    assert key(map(tuple, scan(spark, str(tmp_path / "orc"), "orc", False).collect())) == source


def test_csv(spark, tmp_path):
    (tmp_path / "x.csv").write_text("id,salary,at\n1,2.5,2020-01-01\n2,,2020-01-02\n")
    inferred = scan_csv(spark, str(tmp_path / "x.csv"))
    assert inferred.dtypes == [("id", "int"), ("salary", "double"), ("at", "date")]
    given = scan_csv(spark, str(tmp_path / "x.csv"), T.StructType.fromDDL("id string, salary string, at string"))
    assert given.collect()[0] == ("1", "2.5", "2020-01-01")


def test_jdbc_options_and_refusals(spark):
    assert jdbc_options("jdbc:x", "t", "d", {"batchsize": 5}) == {
        "url": "jdbc:x", "dbtable": "t", "driver": "d", "batchsize": "5",
    }
    with pytest.raises(SpecError, match="url and a table"):
        jdbc_options("", "t")
    with pytest.raises(SpecError, match="parallel read"):
        jdbc_scan(spark, "jdbc:x", "t", split_on="id")
    # No driver takes such a url: the sink reaches Spark's JDBC writer and fails there.
    with pytest.raises(Exception, match="(?i)driver"):
        jdbc_append(spark.range(1).withColumn("s", F.array("id")), "jdbc:none:x", "t")
