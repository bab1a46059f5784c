"""The lake: one catalog and its tables, for one Spark session."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .errors import LakeError
from .operators import changes as _changes
from .operators import maintenance as _maintenance
from .operators.ddl import Ddl
from .operators.rowops import Merge, RowOps
from .operators.write import Writer
from .sources.frame import LakeFrame
from .sources.metastore import Metastore, Snapshot, seen
from .sources.scan import Scanner, TableInfo
from .sources.ship import ship


class Lake:
    """Tables are named "table" (of schema main) or "schema.table".

    Opening a lake sets three options of the session that its files need: Parquet field ids on reading and on writing,
    and timestamps as microseconds.
    """

    def __init__(self, spark: SparkSession, catalog: str, data_path: str | None = None, create: bool = True, inline_limit: int = 0, prefix: str = "lake_") -> None:
        ship(spark)
        self.spark, self.inline_limit = spark, inline_limit
        self.store = Metastore(catalog, data_path, create, prefix)
        self.scanner = Scanner(spark, self.store)
        self.writer = Writer(spark, self.store, self.scanner)
        self.rows = RowOps(self.writer)
        self.ddl = Ddl(self.store)

    # ---- what there is

    def snapshot(self, version: int | str | None = None, timestamp: Any = None) -> Snapshot:
        return self.store.snapshot(version, timestamp)

    @property
    def version(self) -> int:
        return self.store.snapshot().snapshot_id

    def table(self, name: str, version: int | str | None = None, timestamp: Any = None) -> TableInfo:
        return self.scanner.table(name, version, timestamp)

    def table_exists(self, name: str) -> bool:
        try:
            self.table(name)
        except LookupError:
            return False
        return True

    def _frame(self, rows: list[dict], schema: str) -> DataFrame:
        names = [f.split()[0] for f in schema.split(", ")]
        return self.spark.createDataFrame([tuple(r[n] for n in names) for r in rows], schema)

    def snapshots(self) -> DataFrame:
        """Every snapshot with what it changed."""
        rows = self.store.rows("SELECT s.*, c.changes_made, c.author, c.commit_message FROM {snapshot} s LEFT JOIN {snapshot_changes} c ON s.snapshot_id = c.snapshot_id ORDER BY s.snapshot_id")
        return self._frame(rows, "snapshot_id long, snapshot_time string, schema_version long, next_catalog_id long, next_file_id long, changes_made string, author string, commit_message string")

    def files(self, name: str, version: int | str | None = None, where: str | Column | None = None) -> DataFrame:
        """Data files that a read opens, with how many of their rows are deleted."""
        found = self.scanner.plan(self.table(name, version), where).files
        return self.spark.createDataFrame([(f.data_file_id, f.path, f.records, f.size, f.begin, sum(n for _, n in f.deletes)) for f in found], "data_file_id long, path string, record_count long, file_size_bytes long, begin_snapshot long, delete_count long")

    def skipped_files(self, name: str, where: str | Column) -> int:
        return self.scanner.plan(self.table(name), where).skipped

    def column_stats(self, name: str, version: int | str | None = None) -> DataFrame:
        """Statistics by file and column."""
        t = self.table(name, version)
        by_id = {c.column_id: c.name for c in t.columns}
        rows = self.store.rows(f"SELECT * FROM {{file_column_stats}} WHERE data_file_id IN (SELECT data_file_id FROM {{data_file}} WHERE table_id = ? AND {seen(t.snapshot.snapshot_id)})", (t.table_id,))
        rows = [r | {"column_name": by_id[r["column_id"]], "contains_nan": None if r["contains_nan"] is None else bool(r["contains_nan"])} for r in rows if r["column_id"] in by_id]
        return self._frame(rows, "data_file_id long, column_name string, value_count long, null_count long, min_value string, max_value string, contains_nan boolean")

    def partition_values(self, name: str) -> DataFrame:
        """Partition values by file."""
        t = self.table(name)
        rows = self.store.rows(f"SELECT * FROM {{file_partition_value}} WHERE data_file_id IN (SELECT data_file_id FROM {{data_file}} WHERE table_id = ? AND {seen(t.snapshot.snapshot_id)})", (t.table_id,))
        rows = [r | {"column_name": t.partition_by[r["partition_key_index"]]} for r in rows]
        return self._frame(rows, "data_file_id long, column_name string, partition_value string")

    # ---- reading

    def read(self, name: str, version: int | str | None = None, timestamp: Any = None, where: str | Column | None = None) -> DataFrame:
        """The table's rows. where, and any filter put on the returned frame, chooses files by the catalog's statistics; see sources.frame."""
        df = LakeFrame(self.scanner, self.table(name, version, timestamp))
        return df if where is None else df.filter(where)

    def count(self, name: str, version: int | str | None = None, timestamp: Any = None) -> int:
        """Rows, from the catalog alone."""
        return self.scanner.count(self.table(name, version, timestamp))

    def count_frame(self, name: str, alias: str = "n") -> DataFrame:
        return self.spark.range(1).select(F.lit(self.count(name)).cast("long").alias(alias))

    def changes(self, name: str, start: int, end: int | None = None) -> DataFrame:
        """Change data feed of snapshots after start up to end (the latest)."""
        t = self.table(name, end)
        return _changes.changes(self.scanner, t, int(start), t.snapshot.snapshot_id)

    def read_stream(self, name: str, start_snapshot: int = 0) -> DataFrame:
        from .streaming.source import read_stream

        return read_stream(self.spark, self.store.path, name, self.store.data_path, start_snapshot)

    # ---- writing

    def append(self, df: DataFrame, name: str, files: int | None = None, message: str | None = None) -> Snapshot | None:
        return self.writer.append(df, self.table(name), files=files, message=message, inline_limit=self.inline_limit)

    def overwrite(self, df: DataFrame, name: str, files: int | None = None, message: str | None = None) -> Snapshot | None:
        return self.writer.append(df, self.table(name), replace=True, files=files, message=message)

    def delete(self, name: str, where: str | Column) -> Snapshot | None:
        return self.rows.delete(self.table(name), where)

    def update(self, name: str, values: dict[str, Any], where: str | Column | None = None) -> Snapshot | None:
        return self.rows.update(self.table(name), values, where)

    def merge(self, name: str) -> Merge:
        return Merge(self.rows, self.table(name))

    def add_files(self, name: str, paths: list[str], relative: bool = False) -> Snapshot:
        return self.writer.add_files(self.table(name), paths, relative)

    def write_stream(self, df: DataFrame, name: str, checkpoint: str, **options: Any) -> Any:
        from .streaming.sink import write_stream

        return write_stream(self, df, name, checkpoint, **options)

    # ---- tables

    def create_table(self, name: str, schema: str | T.StructType, partition_by: list[str] | None = None, if_not_exists: bool = False, defaults: dict[str, Any] | None = None) -> Snapshot | None:
        """schema: a StructType, or DDL as Spark has it."""
        if isinstance(schema, str):
            schema = self.spark.createDataFrame([], schema).schema if "not null" not in schema.lower() else T.StructType.fromDDL(schema)
        return self.ddl.create_table(name, schema, partition_by, if_not_exists, defaults)

    def create_from(self, df: DataFrame, name: str, partition_by: list[str] | None = None, files: int | None = None) -> Snapshot | None:
        """A new table with df's columns and rows."""
        self.create_table(name, T.StructType([T.StructField(f.name, f.dataType) for f in df.schema.fields]), partition_by)
        return self.append(df, name, files)

    def view(self, name: str, version: int | str | None = None) -> DataFrame:
        """The rows of a stored view."""
        return self.sql(self.ddl.view(name, self.snapshot(version).snapshot_id))

    def sql(self, text: str) -> DataFrame | None:
        """A statement over this lake's tables; see plans.sqlfront."""
        from .plans.sqlfront import run

        return run(self, text)

    # ---- maintenance

    def rewrite_data_files(self, name: str, target_bytes: int = 512 << 20) -> Snapshot | None:
        return _maintenance.rewrite_data_files(self.writer, self.table(name), target_bytes)

    def expire_snapshots(self, older_than_days: float) -> int:
        return _maintenance.expire_snapshots(self.store, older_than_days)

    def vacuum(self) -> int:
        return _maintenance.vacuum(self.spark, self.store)


class LakeReader:
    """Reads by options, as DataFrameReader has them: catalog, table, schema, data_path, snapshot_version (asOfVersion), snapshot_time (asOfTimestamp)."""

    def __init__(self, spark: SparkSession, **options: str) -> None:
        self._spark, self._options = spark, {k.lower(): v for k, v in options.items()}

    def option(self, key: str, value: Any) -> LakeReader:
        return LakeReader(self._spark, **{**self._options, key.lower(): value})

    def options(self, **options: Any) -> LakeReader:
        return LakeReader(self._spark, **{**self._options, **options})

    def _lake(self, create: bool) -> tuple[Lake, str]:
        for key in ("catalog", "table"):
            if key not in self._options:
                raise LakeError(f"option {key} is missing")
        table, schema = self._options["table"], self._options.get("schema", "main")
        return Lake(self._spark, self._options["catalog"], self._options.get("data_path"), create), table if "." in table else f"{schema}.{table}"

    def load(self) -> DataFrame:
        lake, name = self._lake(False)
        o = self._options
        return lake.read(name, o.get("snapshot_version", o.get("asofversion")), o.get("snapshot_time", o.get("asoftimestamp")), o.get("where"))


class LakeWriter(LakeReader):
    """Writes by options. Modes: append, overwrite."""

    def __init__(self, df: DataFrame, mode: str = "append", **options: str) -> None:
        super().__init__(df.sparkSession, **options)
        self._df, self._mode = df, mode

    def option(self, key: str, value: Any) -> LakeWriter:
        return LakeWriter(self._df, self._mode, **{**self._options, key.lower(): value})

    def mode(self, mode: str) -> LakeWriter:
        if mode not in ("append", "overwrite"):
            raise LakeError(f"mode {mode} is not append or overwrite")
        return LakeWriter(self._df, mode, **self._options)

    def save(self) -> Snapshot | None:
        lake, name = self._lake(False)
        return (lake.append if self._mode == "append" else lake.overwrite)(self._df, name)
