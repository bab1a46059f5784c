"""Queries over lake tables, and the SQL that they are held against: each builds a lake of its own from the given tables."""

from __future__ import annotations

import tempfile
import time
import uuid
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import LakeError
from ..lake import Lake

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


class Bench:
    """A new lake for one query: its catalog in a folder of the driver, its files in the shared folder if there is one."""

    def __init__(self, spark: SparkSession, sf_dir: str, inline_limit: int = 0) -> None:
        self.spark, self.sf_dir = spark, sf_dir
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if not shared and not spark.sparkContext.master.startswith("local"):
            raise LakeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        self.dir = tempfile.mkdtemp(prefix="firnlake-")
        data = f"{shared.rstrip('/')}/firnlake-{uuid.uuid4().hex}" if shared else f"{self.dir}/data"
        self.shared = data + "-more"
        self.lake = Lake(spark, f"{self.dir}/catalog.db", data, inline_limit=inline_limit)

    def source(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def load(self, name: str, partition_by: list[str] | None = None) -> Lake:
        self.lake.create_from(self.source(name), name, partition_by)
        return self.lake

    def batches(self, name: str, key: str, n: int) -> Lake:
        """n appends, by key % n."""
        df = self.source(name)
        self.lake.create_table(name, T.StructType([T.StructField(f.name, f.dataType) for f in df.schema.fields]))
        for i in range(n):
            self.lake.append(df.filter(F.col(key) % n == i), name)
        return self.lake


def query(sql: str | None, inline_limit: int = 0) -> Callable:
    def register(f: Callable[[Bench], DataFrame]) -> Callable:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(Bench(spark, sf_dir, inline_limit))

        QUERIES[f.__name__] = run
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return register


@query("SELECT * FROM nation")
def scan_full(b: Bench) -> DataFrame:
    return b.load("nation").read("nation")


@query("SELECT o_orderkey, o_totalprice FROM orders")
def scan_projection(b: Bench) -> DataFrame:
    return b.load("orders").read("orders").select("o_orderkey", "o_totalprice")


@query("SELECT n_nationkey, n_name FROM nation WHERE n_regionkey = 2")
def scan_by_name(b: Bench) -> DataFrame:
    return b.load("nation").sql("SELECT n_nationkey, n_name FROM lake.main.nation WHERE n_regionkey = 2")


@query("SELECT * FROM customer WHERE c_mktsegment = 'BUILDING'")
def filter_eq(b: Bench) -> DataFrame:
    return b.load("customer").read("customer", where="c_mktsegment = 'BUILDING'")


@query("SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity >= 45 AND l_discount < 0.03")
def filter_range(b: Bench) -> DataFrame:
    return b.load("lineitem").read("lineitem", where="l_quantity >= 45 AND l_discount < 0.03D").select("l_orderkey", "l_linenumber", "l_quantity")


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey IN (1, 7, 42, 99, 100000000)")
def filter_in(b: Bench) -> DataFrame:
    df, lake = b.source("orders"), b.lake
    lake.create_table("orders", T.StructType([T.StructField(f.name, f.dataType) for f in df.schema.fields]))
    top = df.agg(F.max("o_orderkey")).first()[0] + 1
    for i in range(4):
        lake.append(df.filter(f"o_orderkey >= {top * i // 4} AND o_orderkey < {top * (i + 1) // 4}"), "orders")
    return lake.read("orders", where="o_orderkey IN (1, 7, 42, 99, 100000000)").select("o_orderkey", "o_custkey")


@query("SELECT o_orderkey FROM orders WHERE o_orderkey % 10 = 0")
def filter_null(b: Bench) -> DataFrame:
    b.lake.create_from(b.source("orders").withColumn("o_totalprice", F.expr("CASE WHEN o_orderkey % 10 <> 0 THEN o_totalprice END")), "orders")
    return b.lake.read("orders", where="o_totalprice IS NULL").select("o_orderkey")


@query("SELECT p_partkey FROM part WHERE (p_size < 10 OR p_size > 40) AND NOT (p_brand = 'Brand#1')")
def filter_and_or_not(b: Bench) -> DataFrame:
    return b.load("part").read("part", where="(p_size < 10 OR p_size > 40) AND NOT (p_brand = 'Brand#1')").select("p_partkey")


@query("SELECT p_partkey, p_name FROM part WHERE p_name LIKE 'blue%'")
def filter_prefix(b: Bench) -> DataFrame:
    return b.load("part").read("part", where="p_name LIKE 'blue%'").select("p_partkey", "p_name")


@query("SELECT c_custkey FROM customer WHERE c_name LIKE '%1' OR c_name LIKE '%00%'")
def filter_suffix_contains(b: Bench) -> DataFrame:
    return b.load("customer").read("customer", where="c_name LIKE '%1' OR c_name LIKE '%00%'").select("c_custkey")


@query("SELECT n_nationkey FROM nation WHERE n_regionkey IS NOT DISTINCT FROM 3")
def filter_null_safe_eq(b: Bench) -> DataFrame:
    return b.load("nation").read("nation", where="n_regionkey <=> 3").select("n_nationkey")


@query("SELECT COUNT(*) AS n FROM lineitem")
def count_star_metadata(b: Bench) -> DataFrame:
    return b.load("lineitem").sql("SELECT COUNT(*) AS n FROM lineitem")


@query("SELECT COUNT(*) AS n FROM orders WHERE NOT (o_orderkey % 7 = 0)")
def count_star_after_delete(b: Bench) -> DataFrame:
    lake = b.load("orders")
    lake.delete("orders", "o_orderkey % 7 = 0")
    return lake.count_frame("orders")


@query("SELECT * FROM orders")
def append_batches(b: Bench) -> DataFrame:
    return b.batches("orders", "o_orderkey", 3).read("orders")


@query("SELECT * FROM orders WHERE o_orderstatus = 'F'")
def overwrite(b: Bench) -> DataFrame:
    lake = b.load("orders")
    lake.overwrite(b.source("orders").filter("o_orderstatus = 'F'"), "orders")
    return lake.read("orders")


@query("SELECT l_orderkey, l_linenumber, l_returnflag FROM lineitem WHERE l_returnflag = 'R'")
def partitioned_write_prune(b: Bench) -> DataFrame:
    return b.load("lineitem", ["l_returnflag"]).read("lineitem", where="l_returnflag = 'R'").select("l_orderkey", "l_linenumber", "l_returnflag")


@query("SELECT DISTINCT l_returnflag AS partition_value FROM lineitem")
def partition_values(b: Bench) -> DataFrame:
    return b.load("lineitem", ["l_returnflag"]).partition_values("lineitem").select("partition_value").distinct()


@query("SELECT c_custkey, c_nationkey FROM customer WHERE c_nationkey BETWEEN 9 AND 12")
def partition_int_range(b: Bench) -> DataFrame:
    return b.load("customer", ["c_nationkey"]).read("customer", where="c_nationkey BETWEEN 9 AND 12").select("c_custkey", "c_nationkey")


@query("SELECT * FROM orders WHERE o_orderkey % 3 = 0")
def time_travel_version(b: Bench) -> DataFrame:
    lake = b.batches("orders", "o_orderkey", 3)
    return lake.read("orders", version=lake.version - 2)


@query("SELECT * FROM orders WHERE o_orderkey % 3 IN (0, 1)")
def time_travel_timestamp(b: Bench) -> DataFrame:
    lake = b.batches("orders", "o_orderkey", 3)
    return lake.read("orders", timestamp=lake.snapshot(lake.version - 1).snapshot_time)


@query("SELECT n_nationkey, n_name FROM nation WHERE n_nationkey % 2 = 0")
def time_travel_sql(b: Bench) -> DataFrame:
    lake = b.batches("nation", "n_nationkey", 2)
    return lake.sql(f"SELECT n_nationkey, n_name FROM nation VERSION AS OF {lake.version - 1}")


@query("SELECT r_regionkey, r_name FROM region")
def time_travel_schema(b: Bench) -> DataFrame:
    lake = b.load("region")
    before = lake.version
    lake.ddl.add_column("region", "extra", "INTEGER", 7)
    return lake.read("region", version=before)


@query("SELECT * FROM orders WHERE NOT (o_totalprice > 100000)")
def delete_where(b: Bench) -> DataFrame:
    lake = b.load("orders")
    lake.sql("DELETE FROM orders WHERE o_totalprice > 100000")
    return lake.read("orders")


@query("SELECT * FROM orders WHERE o_orderkey % 5 NOT IN (0, 1, 2)")
def delete_repeated(b: Bench) -> DataFrame:
    lake = b.load("orders")
    for i in range(3):
        lake.delete("orders", f"o_orderkey % 5 = {i}")
    return lake.read("orders")


@query("SELECT * FROM orders")
def delete_then_append(b: Bench) -> DataFrame:
    lake = b.load("orders")
    lake.delete("orders", "o_orderkey % 4 = 1")
    lake.append(b.source("orders").filter("o_orderkey % 4 = 1"), "orders")
    return lake.read("orders")


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus FROM orders")
def update_literal(b: Bench) -> DataFrame:
    lake = b.load("orders")
    lake.update("orders", {"o_orderstatus": "X"}, "o_orderkey % 4 = 0")
    return lake.read("orders").select("o_orderkey", "o_orderstatus")


@query("SELECT c_custkey, CASE WHEN c_nationkey = 3 THEN NULL ELSE c_mktsegment END AS c_mktsegment, CASE WHEN c_nationkey = 3 THEN 0.0 ELSE c_acctbal END AS c_acctbal FROM customer")
def update_multi_null(b: Bench) -> DataFrame:
    lake = b.load("customer")
    lake.update("customer", {"c_mktsegment": None, "c_acctbal": 0.0}, "c_nationkey = 3")
    return lake.read("customer").select("c_custkey", "c_mktsegment", "c_acctbal")


@query("SELECT s_suppkey, CASE WHEN s_nationkey < 5 THEN s_acctbal + 1 ELSE s_acctbal END AS s_acctbal FROM supplier")
def update_sql_expression(b: Bench) -> DataFrame:
    lake = b.load("supplier")
    lake.sql("UPDATE lake.main.supplier SET s_acctbal = s_acctbal + 1 WHERE s_nationkey < 5")
    return lake.read("supplier").select("s_suppkey", "s_acctbal")


@query("SELECT s_suppkey, CASE WHEN s_suppkey % 10 = 0 THEN s_acctbal * 2 ELSE s_acctbal END AS s_acctbal FROM supplier UNION ALL SELECT s_suppkey + 1000000 AS s_suppkey, s_acctbal FROM supplier WHERE s_suppkey % 10 = 0")
def merge_upsert(b: Bench) -> DataFrame:
    lake, s = b.load("supplier"), b.source("supplier").filter("s_suppkey % 10 = 0")
    new = s.withColumn("s_acctbal", F.col("s_acctbal") * 2).unionByName(s.withColumn("s_suppkey", F.col("s_suppkey") + 1000000))
    lake.merge("supplier").using(new).on("target.s_suppkey = source.s_suppkey").when_matched().update_all().when_not_matched().insert_all().execute()
    return lake.read("supplier").select("s_suppkey", "s_acctbal")


@query("SELECT s_suppkey FROM supplier WHERE s_suppkey % 2 = 1 UNION ALL SELECT s_suppkey + 1000000 AS s_suppkey FROM supplier WHERE s_suppkey % 2 = 0")
def merge_delete_insert(b: Bench) -> DataFrame:
    lake, s = b.load("supplier"), b.source("supplier").filter("s_suppkey % 2 = 0")
    new = s.unionByName(s.withColumn("s_suppkey", F.col("s_suppkey") + 1000000))
    lake.merge("supplier").using(new).on("target.s_suppkey = source.s_suppkey").when_matched().delete().when_not_matched().insert_all().execute()
    return lake.read("supplier").select("s_suppkey")


@query("SELECT s_suppkey, 0.0 AS s_acctbal FROM supplier WHERE s_suppkey % 2 = 0 AND s_acctbal > 0 UNION ALL SELECT s_suppkey, s_acctbal FROM supplier WHERE s_suppkey % 2 = 1")
def merge_conditional(b: Bench) -> DataFrame:
    lake, s = b.load("supplier"), b.source("supplier").filter("s_suppkey % 2 = 0").select("s_suppkey", F.col("s_acctbal").alias("v"))
    lake.merge("supplier").using(s).on("target.s_suppkey = source.s_suppkey").when_matched("source.v > 0").update({"s_acctbal": "0.0D"}).when_matched().delete().execute()
    return lake.read("supplier").select("s_suppkey", "s_acctbal")


@query("SELECT n_nationkey, n_name FROM nation")
def merge_insert_only(b: Bench) -> DataFrame:
    df, lake = b.source("nation"), b.lake
    lake.create_from(df.filter("n_nationkey < 10"), "nation")
    lake.merge("nation").using(df).on("target.n_nationkey = source.n_nationkey").when_not_matched().insert({c: f"source.{c}" for c in df.columns}).execute()
    return lake.read("nation").select("n_nationkey", "n_name")


@query("SELECT s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN 'renamed' ELSE s_name END AS s_name, s_acctbal FROM supplier")
def merge_partial_columns(b: Bench) -> DataFrame:
    lake, s = b.load("supplier"), b.source("supplier").filter("s_suppkey % 3 = 0").select("s_suppkey", F.lit("renamed").alias("s_name"))
    lake.merge("supplier").using(s).on("target.s_suppkey = source.s_suppkey").when_matched().update_all().execute()
    return lake.read("supplier").select("s_suppkey", "s_name", "s_acctbal")


@query("SELECT s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN 'even' ELSE s_name END AS s_name FROM supplier WHERE s_suppkey % 5 <> 1")
def merge_sql(b: Bench) -> DataFrame:
    lake = b.load("supplier")
    lake.create_from(b.source("supplier").filter("s_suppkey % 2 = 0 OR s_suppkey % 5 = 1"), "news")
    lake.sql("MERGE INTO supplier AS t USING lake.main.news AS n ON t.s_suppkey = n.s_suppkey WHEN MATCHED AND n.s_suppkey % 5 = 1 THEN DELETE WHEN MATCHED THEN UPDATE SET s_name = 'even' WHEN NOT MATCHED THEN INSERT *")
    return lake.read("supplier").select("s_suppkey", "s_name")


@query("SELECT o_orderkey, 'insert' AS _change_type FROM orders")
def cdc_inserts(b: Bench) -> DataFrame:
    lake = b.batches("orders", "o_orderkey", 2)
    return lake.changes("orders", lake.version - 2, lake.version).select("o_orderkey", "_change_type")


@query("SELECT n_nationkey, n_name, 'delete' AS _change_type FROM nation WHERE n_regionkey = 1 UNION ALL SELECT n_nationkey, 'Z' AS n_name, 'insert' AS _change_type FROM nation WHERE n_regionkey = 1")
def cdc_update(b: Bench) -> DataFrame:
    lake = b.load("nation")
    before = lake.version
    lake.update("nation", {"n_name": "Z"}, "n_regionkey = 1")
    return lake.changes("nation", before).select("n_nationkey", "n_name", "_change_type")


@query("SELECT o_orderkey, 'delete' AS _change_type FROM orders WHERE o_orderkey % 11 = 0")
def cdc_delete(b: Bench) -> DataFrame:
    lake = b.load("orders")
    before = lake.version
    lake.delete("orders", "o_orderkey % 11 = 0")
    return lake.changes("orders", before).select("o_orderkey", "_change_type")


@query("SELECT r_regionkey, 'delete' AS _change_type FROM region UNION ALL SELECT r_regionkey, 'insert' AS _change_type FROM region WHERE r_regionkey < 3")
def cdc_overwrite(b: Bench) -> DataFrame:
    lake = b.load("region")
    before = lake.version
    lake.overwrite(b.source("region").filter("r_regionkey < 3"), "region")
    return lake.changes("region", before).select("r_regionkey", "_change_type")


@query("SELECT r_regionkey, r_name, CAST(42 AS INTEGER) AS extra FROM region")
def add_column_default(b: Bench) -> DataFrame:
    lake, df = b.lake, b.source("region")
    lake.create_from(df.filter("r_regionkey < 2"), "region")
    lake.ddl.add_column("region", "extra", "INTEGER", 42)
    lake.append(df.filter("r_regionkey >= 2").withColumn("extra", F.lit(42)), "region")
    return lake.read("region")


@query("SELECT n_nationkey, n_name FROM nation")
def drop_column(b: Bench) -> DataFrame:
    lake = b.load("nation")
    lake.sql("ALTER TABLE lake.main.nation DROP COLUMN n_regionkey")
    return lake.read("nation")


@query("SELECT n_nationkey, n_name AS full_name, n_regionkey FROM nation")
def rename_column(b: Bench) -> DataFrame:
    lake, df = b.lake, b.source("nation")
    lake.create_from(df.filter("n_nationkey < 12"), "nation")
    lake.sql("ALTER TABLE nation RENAME COLUMN n_name TO full_name")
    lake.append(df.filter("n_nationkey >= 12").withColumnRenamed("n_name", "full_name"), "nation")
    return lake.read("nation")


@query("SELECT CAST(n_nationkey AS BIGINT) AS n_nationkey, n_name FROM nation")
def widen_column(b: Bench) -> DataFrame:
    lake = b.load("nation")
    lake.ddl.alter_column_type("nation", "n_nationkey", "BIGINT")
    return lake.read("nation").select("n_nationkey", "n_name")


@query("SELECT n_nationkey, CAST(NULL AS DOUBLE) AS n_name FROM nation")
def drop_readd_column(b: Bench) -> DataFrame:
    lake = b.load("nation")
    lake.ddl.drop_column("nation", "n_name")
    lake.ddl.add_column("nation", "n_name", "DOUBLE")
    return lake.read("nation").select("n_nationkey", "n_name")


@query("SELECT n_nationkey, n_name AS nm FROM nation WHERE NOT (n_name LIKE 'NATION_1%')")
def rename_then_delete(b: Bench) -> DataFrame:
    lake = b.load("nation")
    lake.ddl.rename_column("nation", "n_name", "nm")
    lake.delete("nation", "nm LIKE 'NATION_1%'")
    return lake.read("nation").select("n_nationkey", "nm")


@query("SELECT * FROM orders WHERE NOT (o_orderkey % 9 = 0)")
def compaction(b: Bench) -> DataFrame:
    lake = b.batches("orders", "o_orderkey", 8)
    lake.delete("orders", "o_orderkey % 9 = 0")
    lake.rewrite_data_files("orders")
    return lake.read("orders")


@query("SELECT CAST(1 AS BIGINT) AS active_files")
def compaction_file_count(b: Bench) -> DataFrame:
    lake = b.batches("customer", "c_custkey", 4)
    lake.rewrite_data_files("customer")
    return lake.files("customer").agg(F.count("*").alias("active_files"))


@query("SELECT CAST(1 AS BIGINT) AS snapshots")
def expire_snapshots(b: Bench) -> DataFrame:
    lake = b.batches("region", "r_regionkey", 3)
    time.sleep(0.01)
    lake.expire_snapshots(0)
    return lake.snapshots().agg(F.count("*").alias("snapshots"))


@query("SELECT * FROM customer WHERE NOT (c_custkey % 6 = 0)")
def vacuum(b: Bench) -> DataFrame:
    lake = b.batches("customer", "c_custkey", 2)
    lake.delete("customer", "c_custkey % 6 = 0")
    lake.rewrite_data_files("customer")
    time.sleep(0.01)
    lake.expire_snapshots(0)
    lake.vacuum()
    return lake.read("customer")


def _existing(b: Bench) -> Lake:
    df = b.source("part")
    b.lake.create_table("part", T.StructType([T.StructField(f.name, f.dataType) for f in df.schema.fields]))
    b.lake.add_files("part", [f"{b.sf_dir}/part.parquet"])
    return b.lake


@query("SELECT * FROM part")
def add_files(b: Bench) -> DataFrame:
    return _existing(b).read("part")


@query("SELECT * FROM part WHERE NOT (p_size = 5)")
def add_files_delete(b: Bench) -> DataFrame:
    lake = _existing(b)
    lake.delete("part", "p_size = 5")
    return lake.read("part")


@query("SELECT * FROM region", inline_limit=100)
def inline_rows(b: Bench) -> DataFrame:
    return b.batches("region", "r_regionkey", 5).read("region")


@query("SELECT * FROM nation", inline_limit=10)
def inline_plus_files(b: Bench) -> DataFrame:
    df, lake = b.source("nation"), b.lake
    lake.create_from(df.filter("n_nationkey < 4"), "nation")
    lake.append(df.filter("n_nationkey >= 4"), "nation")
    return lake.read("nation")


@query("SELECT n_nationkey, CASE WHEN n_nationkey = 2 THEN 'two' ELSE n_name END AS n_name FROM nation WHERE n_nationkey <> 1", inline_limit=100)
def inline_update_delete(b: Bench) -> DataFrame:
    lake = b.load("nation")
    lake.delete("nation", "n_nationkey = 1")
    lake.update("nation", {"n_name": "two"}, "n_nationkey = 2")
    return lake.read("nation").select("n_nationkey", "n_name")


@query("SELECT vec_id, CAST(len(embedding) AS INTEGER) AS dim, label FROM embeddings")
def nested_roundtrip(b: Bench) -> DataFrame:
    return b.load("embeddings").read("embeddings").select("vec_id", F.size("embedding").alias("dim"), "label")


@query("SELECT MIN(o_orderkey) AS min_value, MAX(o_orderkey) AS max_value, CAST(COUNT(*) - COUNT(o_orderkey) AS BIGINT) AS null_count FROM orders")
def column_stats(b: Bench) -> DataFrame:
    stats = b.batches("orders", "o_orderkey", 3).column_stats("orders").filter("column_name = 'o_orderkey'")
    return stats.agg(F.min(F.col("min_value").cast("long")).alias("min_value"), F.max(F.col("max_value").cast("long")).alias("max_value"), F.sum("null_count").alias("null_count"))


@query("SELECT event_id, user_id, event_type FROM events")
def streaming_append(b: Bench) -> DataFrame:
    df = b.source("events")
    b.lake.create_table("events", T.StructType([T.StructField(f.name, f.dataType) for f in df.schema.fields]))
    df.repartition(3).write.parquet(f"{b.shared}/in")
    stream = b.spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(f"{b.shared}/in")
    b.lake.write_stream(stream, "events", f"{b.shared}/checkpoint", availableNow=True).awaitTermination()
    return b.lake.read("events").select("event_id", "user_id", "event_type")


@query("SELECT event_id, event_type FROM events")
def streaming_read(b: Bench) -> DataFrame:
    lake = b.batches("events", "event_id", 2)
    out = f"{b.shared}/out"
    lake.read_stream("events").select("event_id", "event_type").writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{b.shared}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return b.spark.read.parquet(out)


@query("SELECT c_custkey, c_name FROM customer WHERE c_acctbal > 0")
def view_read(b: Bench) -> DataFrame:
    lake = b.load("customer")
    lake.sql("CREATE VIEW rich AS SELECT c_custkey, c_name FROM customer WHERE c_acctbal > 0")
    return lake.sql("SELECT * FROM lake.main.rich")


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def sort_limit(b: Bench) -> DataFrame:
    return b.load("orders").sql("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")


@query("SELECT MIN(o_orderkey) AS mn, MAX(o_orderkey) AS mx, CAST(SUM(o_orderkey) AS BIGINT) AS s FROM orders")
def agg_min_max_sum(b: Bench) -> DataFrame:
    return b.load("orders").sql("SELECT MIN(o_orderkey) AS mn, MAX(o_orderkey) AS mx, SUM(o_orderkey) AS s FROM orders")


@query("SELECT l_returnflag, l_linestatus, COUNT(*) AS n, CAST(SUM(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS qty FROM lineitem GROUP BY l_returnflag, l_linestatus")
def agg_group_by(b: Bench) -> DataFrame:
    return b.load("lineitem", ["l_returnflag"]).sql("SELECT l_returnflag, l_linestatus, COUNT(*) AS n, CAST(SUM(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS qty FROM lineitem GROUP BY l_returnflag, l_linestatus")


@query("SELECT n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey")
def join_lake_tables(b: Bench) -> DataFrame:
    b.load("nation")
    return b.load("region").sql("SELECT n.n_name, r.r_name FROM lake.main.nation n JOIN lake.main.region r ON n.n_regionkey = r.r_regionkey")


@query("SELECT r_name, COUNT(*) AS n FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY r_name HAVING COUNT(*) > 1 UNION ALL SELECT 'all', COUNT(*) FROM nation")
def cte_union_having(b: Bench) -> DataFrame:
    b.load("nation")
    return b.load("region").sql("WITH x AS (SELECT r_name, n_name FROM nation JOIN region ON n_regionkey = r_regionkey) SELECT r_name, COUNT(*) AS n FROM x GROUP BY r_name HAVING COUNT(*) > 1 UNION ALL SELECT 'all', COUNT(*) FROM nation")


@query("SELECT o_custkey, o_orderkey, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rn FROM orders")
def window_rank(b: Bench) -> DataFrame:
    return b.load("orders").sql("SELECT o_custkey, o_orderkey, CAST(ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS BIGINT) AS rn FROM orders")


@query("SELECT n_nationkey AS id, n_name AS name FROM nation WHERE n_nationkey >= 5 UNION ALL SELECT 100 AS id, 'new' AS name")
def sql_lifecycle(b: Bench) -> DataFrame:
    b.load("nation")
    for statement in (
        "CREATE NAMESPACE IF NOT EXISTS lake.other",
        "CREATE TABLE IF NOT EXISTS lake.other.t (id INT NOT NULL, name STRING) PARTITIONED BY (id)",
        "INSERT INTO lake.other.t SELECT n_nationkey, n_name FROM nation",
        "DELETE FROM lake.other.t WHERE id < 5",
        "INSERT INTO lake.other.t VALUES (100, 'new')",
    ):
        b.lake.sql(statement)
    return b.lake.sql("SELECT id, name FROM lake.other.t")

# ---- which files are opened


@query("SELECT * FROM (VALUES ('alias', 1), ('filter', 1), ('join', 1), ('subquery', 1), ('view', 1), ('where', 1)) AS t(how, files)")
def pushdown_opened_files(b: Bench) -> DataFrame:
    lake = b.lake
    df = b.source("orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    lake.create_table("o", df.schema)
    top = df.agg(F.max("o_orderkey")).first()[0] + 1
    for i in range(4):
        lake.append(df.filter(f"o_orderkey >= {top * i // 4} AND o_orderkey < {top * (i + 1) // 4}").coalesce(1), "o")
    lake.sql("CREATE VIEW main.v AS SELECT o_orderkey AS k, o_custkey AS c FROM o")
    lake.create_table("k", "key long")
    lake.append(b.spark.range(1).select(F.lit(5).cast("long").alias("key")), "k")
    how = {
        "where": lake.read("o", where="o_orderkey = 5"),
        "filter": lake.read("o").filter(F.col("o_orderkey") < 10),
        "alias": lake.sql("SELECT * FROM o AS x WHERE x.o_orderkey = 5"),
        "join": lake.sql("SELECT o.* FROM o JOIN k ON o.o_orderkey = k.key WHERE k.key = 5"),
        "view": lake.sql("SELECT c FROM v WHERE k BETWEEN 3 AND 5"),
        "subquery": lake.sql("SELECT c FROM (SELECT * FROM v) AS s WHERE s.k IN (1, 2)"),
    }
    rows = [(k, sum("/k-" not in f for f in df.inputFiles())) for k, df in how.items()]
    return b.spark.createDataFrame(rows, "how string, files int")


@query("SELECT o_orderkey FROM orders WHERE o_orderkey % 10 <> 0")
def filter_not_null(b: Bench) -> DataFrame:
    lake = b.lake
    df = b.source("orders").withColumn("o_comment", F.expr("CASE WHEN o_orderkey % 10 <> 0 THEN 'set' END"))
    lake.create_table("orders", T.StructType([T.StructField(f.name, f.dataType) for f in df.schema.fields]))
    lake.append(df.filter("o_comment IS NULL"), "orders")
    lake.append(df.filter("o_comment IS NOT NULL"), "orders")
    return lake.read("orders").filter("o_comment IS NOT NULL").select("o_orderkey")


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_discount > 0.05 AND l_shipdate < TIMESTAMP '1998-01-01' AND l_returnflag <> 'R'")
def filter_typed_bounds(b: Bench) -> DataFrame:
    return b.load("lineitem").read("lineitem").filter("l_discount > 0.05D AND l_shipdate < timestamp_ntz'1998-01-01' AND l_returnflag <> 'R'").select("l_orderkey", "l_linenumber")


@query("SELECT c_custkey FROM customer WHERE c_custkey % 7 = 3 AND length(c_name) > 3")
def filter_any_expression(b: Bench) -> DataFrame:
    return b.load("customer").read("customer").filter("c_custkey % 7 = 3 AND length(c_name) > 3").select("c_custkey")


# ---- errors and no-ops, as rows of what was raised or left alone


def _raised(f: Callable[[], object]) -> str:
    try:
        f()
    except Exception as e:  # noqa: BLE001  the name of its kind is the result
        return type(e).__name__
    return "nothing"


@query("SELECT * FROM (VALUES ('both', 'SnapshotNotFoundError'), ('early', 'SnapshotNotFoundError'), ('no number', 'SnapshotNotFoundError'), ('unknown', 'SnapshotNotFoundError')) AS t(what, error)")
def time_travel_errors(b: Bench) -> DataFrame:
    lake = b.load("region")
    tries = {"both": lambda: lake.read("region", version=1, timestamp="2030-01-01"), "early": lambda: lake.read("region", timestamp="1970-01-01"), "no number": lambda: lake.read("region", version="x"), "unknown": lambda: lake.read("region", version=10_000)}
    return b.spark.createDataFrame([(k, _raised(f)) for k, f in tries.items()], "what string, error string")


@query("SELECT * FROM (VALUES ('no clause', 'MergeError'), ('no equality', 'MergeError'), ('no source', 'MergeError'), ('two rows', 'MergeError')) AS t(what, error)")
def merge_validation(b: Bench) -> DataFrame:
    lake = b.load("region")
    two = b.source("region").filter("r_regionkey < 2").withColumn("r_regionkey", F.lit(1))
    on = "target.r_regionkey = source.r_regionkey"
    tries = {
        "no clause": lambda: lake.merge("region").using(two).on(on).execute(),
        "no equality": lambda: lake.merge("region").using(two).on("target.r_regionkey > source.r_regionkey"),
        "no source": lambda: lake.merge("region").on(on).when_matched().delete().execute(),
        "two rows": lambda: lake.merge("region").using(two).on(on).when_matched().update_all().execute(),
    }
    return b.spark.createDataFrame([(k, _raised(f)) for k, f in tries.items()], "what string, error string")


@query("SELECT * FROM (VALUES ('delete', 0), ('empty append', 0), ('merge', 0), ('update', 0)) AS t(what, snapshots)")
def nothing_to_do_commits_nothing(b: Bench) -> DataFrame:
    lake = b.load("region")
    none = b.source("region").filter("r_regionkey < 0")
    on = "target.r_regionkey = source.r_regionkey"
    rows = []
    for what, f in {"merge": lambda: lake.merge("region").using(none).on(on).when_matched().delete().execute(), "empty append": lambda: lake.append(none, "region"), "delete": lambda: lake.delete("region", "r_regionkey = -1"), "update": lambda: lake.update("region", {"r_name": "x"}, "r_regionkey = -1")}.items():
        before = lake.version
        f()
        rows.append((what, lake.version - before))
    return b.spark.createDataFrame(rows, "what string, snapshots int")


@query("SELECT r_regionkey, r_name, 'insert' AS _change_type FROM region WHERE FALSE")
def cdc_empty_range(b: Bench) -> DataFrame:
    lake = b.load("region")
    return lake.changes("region", lake.version).select("r_regionkey", "r_name", "_change_type")


@query("SELECT * FROM (VALUES ('append', 0), ('column', 1), ('delete', 0), ('rename', 1)) AS t(what, ddl)")
def schema_version_moves_with_ddl(b: Bench) -> DataFrame:
    lake, rows = b.load("region"), []
    for what, f in {"column": lambda: lake.ddl.add_column("region", "x", "INTEGER"), "append": lambda: lake.append(b.source("region"), "region"), "delete": lambda: lake.delete("region", "r_regionkey = 1"), "rename": lambda: lake.ddl.rename_column("region", "x", "y")}.items():
        before = lake.snapshot().schema_version
        f()
        rows.append((what, lake.snapshot().schema_version - before))
    return b.spark.createDataFrame(rows, "what string, ddl int")


@query("SELECT n_nationkey, n_name FROM nation")
def rename_table(b: Bench) -> DataFrame:
    lake = b.load("nation")
    lake.sql("ALTER TABLE nation RENAME TO countries")
    return lake.sql("SELECT n_nationkey, n_name FROM countries")


@query("SELECT * FROM (VALUES ('column', 'unit', 'none'), ('table', 'owner', 'second')) AS t(what, tag, value)")
def tags(b: Bench) -> DataFrame:
    lake = b.load("region")
    lake.ddl.set_tag("region", "owner", "first")
    lake.ddl.set_tag("region", "owner", "second")
    lake.ddl.set_tag("region", "gone", "x")
    lake.ddl.set_tag("region", "gone", None)
    lake.ddl.set_tag("region", "unit", "none", column="r_name")
    rows = [("table", k, v) for k, v in lake.ddl.tags(lake.table("region")).items()] + [("column", k, v) for k, v in lake.ddl.tags(lake.table("region"), "r_name").items()]
    return b.spark.createDataFrame(rows, "what string, tag string, value string")


@query("SELECT * FROM (VALUES ('append', 'ConstraintError'), ('direct', 'ConstraintError'), ('fits', 'nothing'), ('update', 'ConstraintError')) AS t(what, error)")
def not_null_constraint(b: Bench) -> DataFrame:
    lake = b.load("nation")
    lake.ddl.add_constraint("nation", "named", "NOT NULL", ["n_name"])
    bad = b.source("nation").withColumn("n_name", F.lit(None).cast("string"))
    tries = {"append": lambda: lake.append(bad, "nation"), "direct": lambda: lake.append(b.spark.range(3).selectExpr("CAST(id AS int) AS n_nationkey"), "nation"), "update": lambda: lake.update("nation", {"n_name": None}, "n_nationkey = 1"), "fits": lambda: lake.append(b.source("nation"), "nation")}
    return b.spark.createDataFrame([(k, _raised(f)) for k, f in tries.items()], "what string, error string")


@query("SELECT CAST(8 AS BIGINT) AS commits, COUNT(*) * 8 AS n FROM region")
def concurrent_appends(b: Bench) -> DataFrame:
    from concurrent.futures import ThreadPoolExecutor

    lake = b.lake
    lake.create_table("r", "r_regionkey int, r_name string")
    df, before = b.source("region"), lake.version
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda _: lake.append(df, "r"), range(8)))
    return b.spark.createDataFrame([(lake.version - before, lake.read("r").count())], "commits long, n long")


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE NOT (o_orderkey % 4 = 0)")
def compact_expire_vacuum(b: Bench) -> DataFrame:
    lake = b.batches("orders", "o_orderkey", 3)
    lake.delete("orders", "o_orderkey % 4 = 0")
    lake.rewrite_data_files("orders")
    lake.expire_snapshots(0)
    lake.vacuum()
    return lake.read("orders").select("o_orderkey", "o_orderstatus")


# ---- queries over lake tables


def _three(b: Bench) -> Lake:
    for name in ("customer", "orders", "nation"):
        b.load(name)
    return b.lake


@query("SELECT c_custkey, o_orderkey FROM customer LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus = 'P') AS o ON c_custkey = o_custkey")
def join_left_outer(b: Bench) -> DataFrame:
    return _three(b).sql("SELECT c_custkey, o_orderkey FROM customer LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus = 'P') AS o ON c_custkey = o_custkey")


@query("SELECT c_custkey, n_nationkey FROM (SELECT * FROM customer WHERE c_nationkey < 5) AS c FULL JOIN nation ON c_nationkey = n_nationkey")
def join_full_outer(b: Bench) -> DataFrame:
    return _three(b).sql("SELECT c_custkey, n_nationkey FROM (SELECT * FROM customer WHERE c_nationkey < 5) AS c FULL JOIN nation ON c_nationkey = n_nationkey")


@query("SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 300000)")
def join_semi(b: Bench) -> DataFrame:
    return _three(b).sql("SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 300000)")


@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 300000)")
def join_anti(b: Bench) -> DataFrame:
    lake = _three(b)
    return lake.read("customer").join(lake.read("orders", where="o_totalprice > 300000"), F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey")


@query("SELECT c_mktsegment, c_nationkey, COUNT(*) AS n FROM customer GROUP BY ROLLUP (c_mktsegment, c_nationkey)")
def agg_rollup(b: Bench) -> DataFrame:
    return _three(b).sql("SELECT c_mktsegment, c_nationkey, COUNT(*) AS n FROM customer GROUP BY ROLLUP (c_mktsegment, c_nationkey)")


@query("SELECT o_orderstatus, o_orderpriority, COUNT(DISTINCT o_custkey) AS n FROM orders GROUP BY CUBE (o_orderstatus, o_orderpriority)")
def agg_cube_distinct(b: Bench) -> DataFrame:
    return _three(b).read("orders").cube("o_orderstatus", "o_orderpriority").agg(F.count_distinct("o_custkey").alias("n"))


@query("SELECT c_custkey AS k FROM customer INTERSECT SELECT o_custkey AS k FROM orders EXCEPT SELECT c_custkey AS k FROM customer WHERE c_nationkey = 1")
def set_intersect_except(b: Bench) -> DataFrame:
    return _three(b).sql("SELECT c_custkey AS k FROM customer INTERSECT SELECT o_custkey AS k FROM orders EXCEPT SELECT c_custkey AS k FROM customer WHERE c_nationkey = 1")


@query("SELECT o_orderkey FROM orders WHERE o_totalprice > (SELECT AVG(o_totalprice) FROM orders) AND o_custkey IN (SELECT c_custkey FROM customer WHERE c_nationkey = 3)")
def subqueries(b: Bench) -> DataFrame:
    return _three(b).sql("SELECT o_orderkey FROM orders WHERE o_totalprice > (SELECT AVG(o_totalprice) FROM orders) AND o_custkey IN (SELECT c_custkey FROM customer WHERE c_nationkey = 3)")


@query("SELECT n_nationkey, upper(substr(n_name, 1, 3)) || '-' || n_nationkey AS code, coalesce(nullif(n_regionkey, 0), -1) AS region FROM nation")
def scalar_functions(b: Bench) -> DataFrame:
    return b.load("nation").sql("SELECT n_nationkey, upper(substr(n_name, 1, 3)) || '-' || n_nationkey AS code, coalesce(nullif(n_regionkey, 0), -1) AS region FROM nation")


@query("SELECT c_nationkey, MAX(c_custkey) - MIN(c_custkey) AS span, MIN(length(c_name) * 2) AS d FROM customer GROUP BY c_nationkey")
def udf_and_udaf(b: Bench) -> DataFrame:
    @F.pandas_udf("int")
    def doubled(s: pd.Series) -> pd.Series:
        return s.str.len().mul(2).astype("int32")

    @F.pandas_udf("long")
    def span(s: pd.Series) -> int:
        return int(s.max() - s.min())

    df = b.load("customer").read("customer").select("c_nationkey", "c_custkey", doubled("c_name").alias("d"))
    spans, least = df.groupBy("c_nationkey").agg(span("c_custkey").alias("span")), df.groupBy("c_nationkey").agg(F.min("d").alias("d"))
    return spans.join(least, "c_nationkey")


@query("SELECT event_type, date_trunc('day', ts) AS day, COUNT(*) AS n FROM events GROUP BY ALL")
def streaming_watermark_window(b: Bench) -> DataFrame:
    """Windowed counts of a table read as a stream, with a watermark longer than the table's span, so that all windows are there."""
    lake, name = b.lake, f"windows_{uuid.uuid4().hex}"
    lake.create_from(b.source("events").orderBy("ts"), "events", files=1)
    days = lake.read_stream("events").select(F.col("ts").cast("timestamp").alias("at"), "event_type").withWatermark("at", "100000 days")
    counts = days.groupBy(F.window("at", "1 day"), "event_type").count()
    q = counts.writeStream.format("memory").queryName(name).outputMode("complete").option("checkpointLocation", f"{b.shared}/windows").trigger(availableNow=True).start()
    q.awaitTermination()
    return b.spark.table(name).select("event_type", F.col("window.start").cast("timestamp_ntz").alias("day"), F.col("count").alias("n"))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Appends, a delete, a merge and a compaction, then orders by status before and after them."""
    b = Bench(spark, sf_dir)
    lake = b.batches("orders", "o_orderkey", 3)
    loaded = lake.version
    lake.delete("orders", "o_totalprice > 400000")
    some = b.source("orders").filter("o_orderkey % 10 = 0")
    news = some.withColumn("o_orderstatus", F.lit("X")).unionByName(some.withColumn("o_orderkey", F.col("o_orderkey") + 10_000_000))
    lake.merge("orders").using(news).on("target.o_orderkey = source.o_orderkey").when_matched().update_all().when_not_matched().insert_all().execute()
    lake.rewrite_data_files("orders")
    both = lake.read("orders", version=loaded).withColumn("state", F.lit("loaded")).unionByName(lake.read("orders").withColumn("state", F.lit("now")))
    return both.groupBy("state", "o_orderstatus").agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total")).orderBy("state", "o_orderstatus")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
