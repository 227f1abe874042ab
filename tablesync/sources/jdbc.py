"""JDBC scan and append sink, for targets that only speak JDBC."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from tablesync.functions.columns import nested_to_json, scalars_to_text
from tablesync.spec import SpecError


def jdbc_options(
    url: str, table: str, driver: str | None = None, options: Mapping[str, object] | None = None
) -> dict[str, str]:
    if not url or not table:
        raise SpecError("JDBC needs a url and a table")
    named = {"url": url, "dbtable": table, **({"driver": driver} if driver else {})}
    return named | {k: str(v) for k, v in (options or {}).items()}


def jdbc_scan(
    spark: SparkSession,
    url: str,
    table: str,
    driver: str | None = None,
    user: str | None = None,
    password: str | None = None,
    split_on: str | None = None,
    bounds: tuple[object, object] | None = None,
    num_partitions: int | None = None,
    fetch_size: int = 10_000,
) -> DataFrame:
    """Read a table. Give ``split_on``, ``bounds`` and ``num_partitions`` to read in parallel."""
    options: dict[str, object] = {"fetchsize": fetch_size}
    if user is not None:
        options |= {"user": user, "password": password or ""}
    given = [split_on is not None, bounds is not None, num_partitions is not None]
    if any(given) and not all(given):
        raise SpecError("a parallel read needs split_on, bounds and num_partitions")
    if all(given):
        options |= {
            "partitionColumn": split_on,
            "lowerBound": bounds[0],
            "upperBound": bounds[1],
            "numPartitions": num_partitions,
        }
    return spark.read.format("jdbc").options(**jdbc_options(url, table, driver, options)).load()


def jdbc_append(
    df: DataFrame,
    url: str,
    table: str,
    driver: str | None = None,
    num_partitions: int | None = None,
    batch_size: int = 10_000,
    as_text: bool = True,
) -> None:
    """Append rows. Nested columns go as JSON text, and all others as text too
    unless ``as_text`` is off; ``num_partitions`` bounds the open connections."""
    sent = nested_to_json(df)
    if as_text:
        sent = scalars_to_text(sent)
    options: dict[str, object] = {"batchsize": batch_size}
    if num_partitions:
        options["numPartitions"] = num_partitions
    sent.write.format("jdbc").options(**jdbc_options(url, table, driver, options)).mode("append").save()
