"""Timings of the headline workloads; prints one JSON line.

BENCH_SF_DIR names the input folder, BENCH_CPUS the cores, BENCH_RUNS the timed
runs per workload (after one warm-up; the median counts).
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import tempfile
import time
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession, functions as F

import tablesync as ts
from checks.queries import JOINED, Workspace, order_changes

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

SHIP_YEAR = {"l_year": "year(l_shipdate)"}
ORDER_YEAR = {"o_year": "year(o_orderdate)"}


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("tablesync-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="tablesync-bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


class Bench:
    """Each workload is a pair: an untimed preparation and the timed step."""

    def __init__(self, spark: SparkSession):
        self.w = Workspace(spark, SF_DIR)
        self.lineitem, self.orders = self.w.read("lineitem"), self.w.read("orders")
        self.half, self.last_percent = self.orders.select(
            F.unix_micros(F.col("o_orderdate").cast("timestamp")).alias("t")
        ).approxQuantile("t", [0.5, 0.99], 0.0005)
        self.dear = self.orders.approxQuantile("o_totalprice", [0.99], 0.0005)[0]
        self.made = 0

    def spec(self, **options) -> ts.TableSpec:
        self.made += 1
        return self.w.spec(f"b{self.made}", **options)

    def since(self, micros: float) -> DataFrame:
        at = F.unix_micros(F.col("o_orderdate").cast("timestamp"))
        return self._changed(self.orders.where(at >= F.lit(int(micros))))

    def dearest(self) -> DataFrame:
        return self._changed(self.orders.where(F.col("o_totalprice") >= self.dear))

    @staticmethod
    def _changed(rows: DataFrame) -> DataFrame:
        return rows.withColumns(
            {
                "o_custkey": F.col("o_custkey") + 1,
                "o_orderstatus": F.when(F.col("o_orderpriority") != "1-URGENT", "X"),
            }
        )

    def writes(self, source: DataFrame, **options) -> Callable[[], Callable[[], None]]:
        def prepare():
            spec = self.spec(**options)
            return lambda: ts.overwrite(source, spec)

        return prepare

    def appends(self) -> Callable[[], None]:
        spec = self.spec(derived=SHIP_YEAR)
        early = F.col("l_linestatus") == "F"
        ts.overwrite(self.lineitem.where(early), spec)
        return lambda: ts.append(self.lineitem.where(~early), spec)

    def merges(self, new: DataFrame, **options) -> Callable[[], Callable[[], None]]:
        def prepare():
            spec = self.spec(keys=["o_orderkey"], **options)
            ts.overwrite(self.orders, spec)
            return lambda: ts.merge(new, spec)

        return prepare

    def merges_hot_third(self) -> Callable[[], None]:
        """One key, 0, holds a third of the existing rows."""
        key, kind = F.col("o_orderkey"), self.orders.schema["o_orderkey"].dataType
        spec = self.spec(keys=["o_orderkey"], hot_key_rows=5000, **JOINED)
        ts.overwrite(self.orders.withColumn("o_orderkey", F.when(key % 3 != 0, key).otherwise(0).cast(kind)), spec)
        one = self.orders.orderBy("o_orderkey").limit(1).withColumn("o_orderkey", F.lit(0).cast(kind))
        new = self.since(self.half).where("o_orderkey % 3 != 0").unionByName(self._changed(one))
        return lambda: ts.merge(new, spec)

    def registers(self) -> Callable[[], None]:
        self.made += 1
        path, table = self.w.path(f"files{self.made}"), f"{self.w.db}.r{self.made}"
        ts.add_derived(self.lineitem, SHIP_YEAR).hint("rebalance", "l_year").write.partitionBy(
            "l_year"
        ).parquet(path)
        return lambda: ts.register_files(self.w.spark, table, path, "parquet")

    def relocates(self) -> Callable[[], None]:
        self.made += 1
        source, target = self.w.path(f"from{self.made}"), self.w.path(f"to{self.made}")
        ts.add_derived(self.lineitem, SHIP_YEAR).hint("rebalance", "l_year").write.partitionBy(
            "l_year"
        ).parquet(source)
        return lambda: ts.relocate_dataset(self.w.spark, source, target)

    def workloads(self) -> dict[str, Callable[[], Callable[[], None]]]:
        half, recent, dearest = self.since(self.half), self.since(self.last_percent), self.dearest()
        return {
            "overwrite_plain": self.writes(self.lineitem),
            "overwrite_plain_in_8_tasks": self.writes(self.lineitem, num_partitions=8),
            "overwrite_derived_year": self.writes(self.lineitem, derived=SHIP_YEAR),
            "overwrite_bucketed": self.writes(self.orders, bucket_by=["o_orderkey"], num_buckets=8),
            "append_derived_year": self.appends,
            "merge_half_of_keys": self.merges(half),
            "merge_half_of_keys_joined": self.merges(half, **JOINED),
            "merge_half_of_keys_joined_bucketed": self.merges(
                half, bucket_by=["o_orderkey"], num_buckets=8, **JOINED
            ),
            "merge_hot_third_joined": self.merges_hot_third,
            "merge_half_of_keys_external": self.merges(half, external=True),
            "merge_all_keys_by_year": self.merges(
                order_changes(self.orders), derived=ORDER_YEAR, **JOINED
            ),
            "merge_1pct_recent_by_year": self.merges(recent, derived=ORDER_YEAR),
            "merge_1pct_recent_by_year_rewriting_all": self.merges(
                recent, derived=ORDER_YEAR, rewrite="all"
            ),
            "merge_1pct_scattered_by_year": self.merges(dearest, derived=ORDER_YEAR),
            "merge_1pct_partition_follows_key": self.merges(
                recent, derived={"key_range": "o_orderkey div 20000"}
            ),
            "register_and_repair": self.registers,
            "relocate_by_year": self.relocates,
        }


def measure(prepare: Callable[[], Callable[[], None]]) -> float:
    times = []
    for _ in range(RUNS + 1):
        step = prepare()
        start = time.perf_counter()
        step()
        times.append(time.perf_counter() - start)
    return round(statistics.median(times[1:]), 3)


def main() -> None:
    spark = session()
    bench = Bench(spark)
    chosen = sys.argv[1:]
    timed = {
        name: measure(prepare)
        for name, prepare in bench.workloads().items()
        if not chosen or name in chosen
    }
    print(
        json.dumps(
            {
                "metric": "sum of median workload seconds",
                "value": round(sum(timed.values()), 3),
                "unit": "sec",
                "queries": timed,
                "sf": float(re.search(r"sf([\d.]+)", SF_DIR).group(1)) if "sf" in SF_DIR else None,
                "cpus": int(CPUS) if CPUS.isdigit() else CPUS,
                "rows": {"lineitem": bench.lineitem.count(), "orders": bench.orders.count()},
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
