"""Headline queries over $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line of seconds.

do the same on bare Parquet; sf_ entries run over the given tables. Reads are the least of five warm runs, writes and DDL one pass.
"""

from __future__ import annotations

import json
import os
import shutil
import sys
import tempfile
import time
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import SparkSession

from firnlake import Lake

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]").config("spark.sql.shuffle.partitions", CPUS).config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "8g").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    work, seconds = tempfile.mkdtemp(prefix="firnlake-bench-"), {}

    def timed(name: str, f: Callable, runs: int = 1) -> None:
        best = None
        for _ in range(runs):
            t = time.perf_counter()
            f()
            took = time.perf_counter() - t
            best = took if best is None else min(best, took)
        seconds[name] = round(best, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)

    def noop(df) -> None:
        df.write.format("noop").mode("overwrite").save()

    lake = Lake(spark, f"{work}/catalog.db", f"{work}/data")
    columns = ("id", "concat('name_', id % 1000) AS name", "id * 1.5D AS value", "CAST(id % 50 AS INT) AS category")
    big = spark.range(100_000).selectExpr(*columns)
    shape = "id long, name string, value double, category int"
    lake.create_table("warm", shape)
    lake.append(big.limit(1000), "warm", files=1)
    lake.read("warm", where="category = 7").count()

    lake.create_table("w", shape)
    timed("lake_write_100k", lambda: lake.append(big, "w", files=1))
    timed("raw_write_100k", lambda: big.coalesce(1).write.parquet(f"{work}/raw"))
    timed("lake_count_100k", lambda: lake.count("w"), 5)
    timed("raw_count_100k", lambda: spark.read.parquet(f"{work}/raw").count(), 5)
    timed("lake_filtered_100k", lambda: lake.read("w", where="category = 7").count(), 5)
    timed("raw_filtered_100k", lambda: spark.read.parquet(f"{work}/raw").filter("category = 7").count(), 5)

    lake.create_table("stream", shape)
    batches = [spark.range(i * 1000, (i + 1) * 1000, numPartitions=1).selectExpr(*columns) for i in range(100)]
    timed("lake_stream_100_batches", lambda: [lake.append(b, "stream") for b in batches])
    timed("raw_stream_100_batches", lambda: [b.write.mode("append").parquet(f"{work}/raw_stream") for b in batches])
    timed("lake_scan_after_stream", lambda: lake.read("stream", where="category = 7").count(), 5)
    timed("lake_time_travel", lambda: lake.count("stream", version=lake.version - 50), 5)
    timed("lake_add_column_50", lambda: [lake.ddl.add_column("w", f"c{i}", "INTEGER", i) for i in range(50)])
    timed("lake_rename_column_50", lambda: [lake.ddl.rename_column("w", f"c{i}", f"d{i}") for i in range(50)])
    timed("lake_create_20_tables", lambda: [lake.create_table(f"t{i}", shape) for i in range(20)])

    item = spark.read.parquet(f"{SF_DIR}/lineitem.parquet")
    timed("sf_write_lineitem", lambda: lake.create_from(item, "lineitem"))
    timed("sf_write_partitioned", lambda: lake.create_from(item, "by_flag", ["l_returnflag"]))
    timed("sf_scan_lineitem", lambda: noop(lake.read("lineitem")), 3)
    timed("sf_group_by", lambda: noop(lake.sql("SELECT l_returnflag, l_linestatus, count(*) AS n, sum(l_quantity) AS q FROM lineitem GROUP BY 1, 2")), 3)
    timed("sf_partition_prune", lambda: noop(lake.read("by_flag", where="l_returnflag = 'R'")), 3)
    timed("sf_delete", lambda: lake.delete("lineitem", "l_orderkey % 10 = 0"))
    timed("sf_scan_with_deletes", lambda: noop(lake.read("lineitem")), 3)
    timed("sf_update", lambda: lake.sql("UPDATE lineitem SET l_tax = l_tax + 1 WHERE l_orderkey % 10 = 1"))
    lake.create_from(spark.read.parquet(f"{SF_DIR}/orders.parquet"), "orders")
    news = lake.read("orders").filter("o_orderkey % 20 = 0").withColumnRenamed("o_custkey", "c").selectExpr("o_orderkey", "c AS o_custkey", "'X' AS o_orderstatus")
    timed("sf_merge", lambda: lake.merge("orders").using(news).on("target.o_orderkey = source.o_orderkey").when_matched().update_all().when_not_matched().insert_all().execute())
    before = lake.version - 1
    timed("sf_changes", lambda: noop(lake.changes("orders", before)), 3)
    timed("sf_compaction", lambda: lake.rewrite_data_files("lineitem"))

    print(json.dumps({"metric": "total seconds of all queries", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": Path(SF_DIR).name}))
    spark.stop()
    shutil.rmtree(work, ignore_errors=True)


if __name__ == "__main__":
    main()
