"""Change data feed: rows inserted and deleted after one snapshot and up to another."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import SnapshotNotFoundError
from ..sources.metastore import Transaction
from ..sources.paths import qualify_all
from ..sources.scan import FILE, INLINE, POS, DataFile, Scanner, TableInfo, full_path


def changes(scanner: Scanner, t: TableInfo, start: int, end: int) -> DataFrame:
    """The table's columns as of end with _change_type (insert, delete) and _snapshot_id, for snapshots in (start, end].

    Inserts are the rows of files begun in the range, deletes those that delete files name and those alive in files that an
    overwrite ended; an update is both in one snapshot. Compaction changes no rows and is left out. Ordered by snapshot,
    deletes first.
    """
    if start > end:
        raise SnapshotNotFoundError(f"the range ends at {end}, before its start {start}")
    spark, base = scanner.spark, scanner.store.data_path

    def query(tx: Transaction) -> tuple:
        moved = {r["snapshot_id"] for r in tx.rows("SELECT snapshot_id FROM {snapshot_changes} WHERE changes_made LIKE ?", (f"%compacted_table:{t.table_id}%",))}
        within = "{0} > ? AND {0} <= ?"
        hit = f"SELECT data_file_id FROM {{delete_file}} WHERE table_id = ? AND {within.format('begin_snapshot')}"
        where = f"table_id = ? AND (({within.format('begin_snapshot')}) OR ({within.format('end_snapshot')}) OR data_file_id IN ({hit}))"
        args = (t.table_id, start, end, start, end, t.table_id, start, end)
        files = tx.rows(f"SELECT * FROM {{data_file}} WHERE {where}", args)
        deletes = tx.rows(f"SELECT * FROM {{delete_file}} WHERE begin_snapshot <= ? AND data_file_id IN (SELECT data_file_id FROM {{data_file}} WHERE {where})", (end, *args))
        return moved, files, deletes

    moved, files, deletes = scanner.store.read(query)
    by_file: dict[int, list[dict]] = {}
    for d in deletes:
        by_file.setdefault(d["data_file_id"], []).append(d)

    def in_range(n: int | None) -> bool:
        return n is not None and start < n <= end and n not in moved

    def data(f: dict, kept: list[dict]) -> DataFile:
        return DataFile(f["data_file_id"], full_path(base, f["path"], f["path_is_relative"]), f["record_count"], 0, f["mapping_id"], f["begin_snapshot"], tuple((full_path(base, d["path"], d["path_is_relative"]), d["delete_count"]) for d in kept))

    def named(df: DataFrame, snapshots: dict[str, int], kind: str) -> DataFrame:
        """df (with FILE) with the change's columns."""
        rows = list(zip(qualify_all(spark, list(snapshots)), snapshots.values(), strict=True))
        names = F.broadcast(spark.createDataFrame(rows, f"{FILE} string, _snapshot_id long"))
        return df.join(names, FILE).withColumn("_change_type", F.lit(kind))

    parts: list[DataFrame] = []
    begun = [data(f, []) for f in files if in_range(f["begin_snapshot"])]
    if begun:
        parts.append(named(scanner.rows_of(t, begun, positions=True), {f.path: f.begin for f in begun}, "insert"))
    ended = [f for f in files if in_range(f["end_snapshot"])]
    if ended:
        alive = [data(f, by_file.get(f["data_file_id"], [])) for f in ended]
        parts.append(named(scanner.rows_of(t, alive, positions=True), {a.path: f["end_snapshot"] for a, f in zip(alive, ended, strict=True)}, "delete"))
    hit = [(f, [d for d in by_file.get(f["data_file_id"], []) if in_range(d["begin_snapshot"])]) for f in files]
    hit = [(data(f, own), own) for f, own in hit if own]
    if hit:
        pairs = [(p, f.path) for f, _ in hit for p, _ in f.deletes]
        snapshots = {p: d["begin_snapshot"] for f, own in hit for (p, _), d in zip(f.deletes, own, strict=True)}
        names = list(zip(qualify_all(spark, [p for p, _ in pairs]), qualify_all(spark, [f for _, f in pairs]), [snapshots[p] for p, _ in pairs], strict=True))
        where = F.broadcast(spark.createDataFrame(names, f"_delete string, {FILE} string, _snapshot_id long"))
        gone = spark.read.schema("row_id long").parquet(*(p for p, _ in pairs)).select(F.col("row_id").alias(POS), F.col("_metadata.file_path").alias("_delete")).join(where, "_delete").drop("_delete")
        whole = [DataFile(f.data_file_id, f.path, f.records, 0, f.mapping_id, f.begin) for f, _ in hit]
        parts.append(scanner.rows_of(t, whole, positions=True).join(gone, [FILE, POS]).withColumn("_change_type", F.lit("delete")))
    for column, kind in (("begin_snapshot", "insert"), ("end_snapshot", "delete")):
        if (df := scanner.inlined(t, f"{column} > {start} AND {column} <= {end}", snapshot=column)) is not None:
            parts.append(df.filter(~F.col("_snapshot_id").isin(sorted(moved))).withColumn("_change_type", F.lit(kind)))
    columns = [*(F.col(f"`{c.name}`") for c in t.columns), "_change_type", "_snapshot_id"]
    if not parts:
        return spark.createDataFrame([], T.StructType([*t.spark_schema().fields, T.StructField("_change_type", T.StringType()), T.StructField("_snapshot_id", T.LongType())]))
    out = parts[0].select(*columns)
    for p in parts[1:]:
        out = out.unionByName(p.select(*columns))
    return out.orderBy("_snapshot_id", "_change_type")


__all__ = ["INLINE", "changes"]
