import pytest

from tablesync import SpecError, TableSpec


def test_defaults_and_normal_forms():
    spec = TableSpec("d.t", partition_by=["a"], derived={"y": "year(d)"}, bucket_by=["a", "b"], num_buckets=3)
    assert spec.mode == "overwrite" and spec.file_format is None
    assert spec.partition_columns == ("a", "y")
    assert spec.bucket_columns == ("b",)  # a partition column cannot bucket
    assert TableSpec("d.t", partition_by=["y", "a"], derived={"y": "x"}).partition_columns == ("a", "y")
    assert TableSpec("d.t", file_format="PARQUET").file_format == "parquet"


@pytest.mark.parametrize(
    "options, message",
    [
        ({"mode": "upsert"}, "mode must be one of"),
        ({"mode": "Overwrite"}, "mode must be one of"),
        ({"file_format": "avro"}, "file_format must be one of"),
        ({"nested": "drop"}, "nested must be one of"),
        ({"bucket_by": ["a"]}, "both bucket_by and num_buckets"),
        ({"num_buckets": 4}, "both bucket_by and num_buckets"),
        ({"bucket_by": ["a"], "num_buckets": 0}, "at least 1"),
        ({"num_partitions": 0}, "at least 1"),
        ({"keys": ["a", "A"]}, "names a column twice"),
        ({"partition_by": "a"}, "list of column names"),
    ],
)
def test_wrong_specs(options, message):
    with pytest.raises(SpecError, match=message):
        TableSpec("d.t", **options)
    with pytest.raises(ValueError, match="table is required"):
        TableSpec("")


def test_names_are_resolved_against_the_data():
    spec = TableSpec("d.t", partition_by=["COUNTRY"], keys=["Id"], derived={"y": "1"})
    resolved = spec.resolved(["id", "Country"])
    assert (resolved.partition_by, resolved.keys) == (("Country",), ("id",))
    with pytest.raises(SpecError, match="partition columns not in the data: .'COUNTRY'"):
        spec.resolved(["id", "Country"], case_sensitive=True)
    with pytest.raises(SpecError, match="already in the data: .'y'"):
        spec.resolved(["id", "country", "Y"])


def test_text_options():
    spec = TableSpec.from_options(
        {
            "table": "d.t",
            "syncMode": "merge",
            "externalTablePath": "/x",
            "fileStorageFormat": "ORC",
            "partitionColumns": "country, state",
            "derivedPartitionColumns": "year(d):y,date_format(d, 'HH:mm'):clock",
            "bucketingColumns": "city",
            "numberOfBuckets": "3",
            "mergeKeys": "id,part",
            "numOfRePartitions": "12",
        }
    )
    assert spec == TableSpec(
        "d.t",
        mode="merge",
        path="/x",
        file_format="orc",
        partition_by=["country", "state"],
        derived={"y": "year(d)", "clock": "date_format(d, 'HH:mm')"},
        bucket_by=["city"],
        num_buckets=3,
        keys=["id", "part"],
        num_partitions=12,
    )
    assert TableSpec.from_options({"table": "d.t"}) == TableSpec("d.t")
    with pytest.raises(SpecError, match="expression:alias"):
        TableSpec.from_options({"table": "d.t", "derivedPartitionColumns": "year(d)"})
    with pytest.raises(SpecError, match="table is required"):
        TableSpec.from_options({})


def test_options_with_calls_in_calls_and_quotes():
    spec = TableSpec.from_options(
        {"table": "d.t", "derivedPartitionColumns": "concat(a, upper(b)):x, date_format(d, 'a,b:c'):y, `odd,name`:z"}
    )
    assert spec.derived == {"x": "concat(a, upper(b))", "y": "date_format(d, 'a,b:c')", "z": "`odd,name`"}
