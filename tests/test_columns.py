import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import types as T

from tablesync import (
    SpecError,
    create_table_ddl,
    describe_ddl,
    nested_to_json,
    partition_columns_last,
    scalars_to_text,
    text_to_typed,
    typed_ingest,
)
from tablesync.functions.columns import conform


def test_nested_to_json(spark):
    df = spark.createDataFrame(
        [(1, (1, None), ["x", None], {"k": (2, "y")}), (2, None, None, None)],
        "id int, s struct<a:int,b:string>, l array<string>, m map<string,struct<a:int,b:string>>",
    )
    assert [tuple(r) for r in nested_to_json(df).orderBy("id").collect()] == [
        (1, '{"a":1}', '["x",null]', '{"k":{"a":2,"b":"y"}}'),
        (2, None, None, None),
    ]
    assert nested_to_json(df, ["l"]).schema["s"].dataType == df.schema["s"].dataType


def test_text_and_back(spark):
    df = spark.createDataFrame(
        [(1, 2.5, True, dt.date(2020, 2, 3), Decimal("1.50")), (None,) * 5],
        "i int, d double, b boolean, t date, `n.n` decimal(5,2)",
    )
    text = scalars_to_text(df)
    assert {f.dataType.simpleString() for f in text.schema} == {"string"}
    assert text.collect()[0] == ("1", "2.5", "true", "2020-02-03", "1.50")
    assert text_to_typed(text, df.schema).collect() == df.collect()
    bad = spark.createDataFrame([("x", "1")], "i string, j string")
    typed = text_to_typed(bad, T.StructType.fromDDL("i int"))
    assert typed.collect() == [(None, "1")] and typed.columns == ["i", "j"]


def test_typed_ingest(spark):
    raw = spark.createDataFrame(
        [("2020-01-02 03:04:05", "2020-01-02", "12.34567891", "true"), ("?", "2020-13-01", "x", "maybe")],
        "insert_ts string, d string, salary string, active string",
    )
    got = typed_ingest(raw, ["insert_ts"], ["d"], ["salary"], ["active"])
    assert [f.dataType.simpleString() for f in got.schema] == ["timestamp", "date", "decimal(20,7)", "boolean"]
    first, second = got.selectExpr("cast(insert_ts as string)", "d", "salary", "active").collect()
    assert first == ("2020-01-02 03:04:05", dt.date(2020, 1, 2), Decimal("12.3456789"), True)
    assert second == (None, None, None, None)
    assert typed_ingest(raw) is raw


def test_partition_columns_last(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert partition_columns_last(df, ["b", "a"]).columns == ["c", "b", "a"]
    with pytest.raises(SpecError, match="not in the data: .'z'"):
        partition_columns_last(df, ["z"])


def test_conform_types(spark):
    df = spark.createDataFrame([(1, "x")], "a long, b string")
    assert conform(df, T.StructType.fromDDL("B string, A int")).schema.simpleString() == "struct<B:string,A:int>"
    with pytest.raises(SpecError, match="column b: string does not fit int"):
        conform(df, T.StructType.fromDDL("a int, b int"))
    with pytest.raises(SpecError, match="columns differ"):
        conform(df, T.StructType.fromDDL("A long, b string"), case_sensitive=True)


@pytest.fixture
def ddl_schema(spark):
    return T.StructType.fromDDL(
        "id bigint, s smallint, amount decimal(10,2), at timestamp_ntz, "
        "n array<struct<`Odd Name`:date,Inner:map<string,binary>>>, p string, q int"
    )


def test_describe_ddl(ddl_schema):
    described = describe_ddl(ddl_schema, ["q", "p"])
    assert described == [
        ("id", "bigint", "body"),
        ("s", "smallint", "body"),
        ("amount", "decimal(10,2)", "body"),
        ("at", "timestamp_ntz", "body"),
        ("n", "array<struct<`Odd Name`:date,Inner:map<string,binary>>>", "body"),
        ("q", "int", "partition"),
        ("p", "string", "partition"),
    ]
    assert describe_ddl(ddl_schema, keep_ntz=False)[3] == ("at", "timestamp", "body")
    for ddl in ("a void", "a interval day", "a variant", "a map<array<int>,int>"):
        with pytest.raises(SpecError, match="column a: type"):
            describe_ddl(T.StructType.fromDDL(ddl))


def test_create_table_ddl(spark):
    schema = T.StructType.fromDDL("id bigint, at timestamp_ntz, y string")
    assert create_table_ddl(schema, "d.t", "/a'b", "orc", ["y"]) == (
        "CREATE TABLE IF NOT EXISTS `d`.`t` (`id` bigint, `at` timestamp_ntz) USING orc "
        "PARTITIONED BY (`y` string) LOCATION '/a\\'b'"
    )
    assert create_table_ddl(schema, "d.t", "/x", "parquet", dialect="hive") == (
        "CREATE EXTERNAL TABLE IF NOT EXISTS `d`.`t` (`id` bigint, `at` timestamp, `y` string) "
        "STORED AS PARQUET LOCATION '/x'"
    )
    with pytest.raises(SpecError, match="dialect"):
        create_table_ddl(schema, "d.t", "/x", "orc", dialect="other")


def test_nested_ddl_makes_a_table(spark, db, tmp_path, ddl_schema):
    spark.sql(create_table_ddl(ddl_schema, f"{db}.t", str(tmp_path / "t"), "parquet", ["q", "p"]))
    table = spark.table(f"{db}.t")
    assert table.schema["n"].dataType == ddl_schema["n"].dataType
    assert table.columns[-2:] == ["q", "p"]
