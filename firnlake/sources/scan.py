"""A table at a snapshot as a DataFrame: files are chosen on the driver, the rest is Spark's own Parquet scan."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import ColumnNotFoundError, SchemaNotFoundError, TableNotFoundError
from ..functions.values import decode, literal_sql, parse_type
from ..plans.prune import Zone, predicate, zone
from .metastore import Metastore, Snapshot, Transaction, seen
from .paths import qualify_all

#: Columns that a positioned scan adds: the file as Spark names it, and the row's place in it.
FILE, POS = "__file", "__pos"
INLINE = "inline:"
#: Deleted positions of about so many bytes (each has its file's path) are broadcast against the files that have deletes; more are joined by a shuffle.
BROADCAST_DELETES = 64 << 20
#: Files of the lists that are kept, about.
KEPT_FILES = 1_000_000


@dataclass(frozen=True)
class ColumnInfo:
    column_id: int
    name: str
    type: str
    initial_default: str | None
    default_value: str | None
    nullable: bool

    @property
    def spark_type(self) -> T.DataType:
        return parse_type(self.type)


@dataclass(frozen=True)
class TableInfo:
    """A table as a snapshot sees it."""

    snapshot: Snapshot
    table_id: int
    schema: str
    name: str
    path: str
    columns: tuple[ColumnInfo, ...]
    partition_by: tuple[str, ...] = ()

    def column(self, name: str) -> ColumnInfo:
        found = [c for c in self.columns if c.name.lower() == name.lower()]
        if not found:
            raise ColumnNotFoundError(f"{self.schema}.{self.name} has no column {name}")
        return found[0]

    def spark_schema(self, ids: bool = False) -> T.StructType:
        """The columns; with ids, the metadata that lets Spark's reader find them by field id and fill initial defaults."""
        fields = []
        for c in self.columns:
            meta: dict = {}
            if ids:
                meta["parquet.field.id"] = c.column_id
                if (d := literal_sql(c.initial_default, c.spark_type)) is not None:
                    meta |= {"EXISTS_DEFAULT": d, "CURRENT_DEFAULT": d}
            fields.append(T.StructField(c.name, c.spark_type, True, meta))
        return T.StructType(fields)


@dataclass(frozen=True)
class DataFile:
    data_file_id: int
    path: str
    records: int
    size: int
    mapping_id: int | None
    begin: int
    deletes: tuple[tuple[str, int], ...] = ()


@dataclass
class Scan:
    """Files that a read opens, and how many were passed over."""

    files: list[DataFile] = field(default_factory=list)
    skipped: int = 0


def full_path(base: str, path: str, relative: bool | int | None) -> str:
    return base + path if relative else path


def split_name(name: str, schema: str = "main") -> tuple[str, str]:
    """schema and table of "table" or "schema.table"."""
    head, dot, tail = name.rpartition(".")
    return (head.strip("`"), tail.strip("`")) if dot else (schema, name.strip("`"))


def find_schema(tx: Transaction, name: str, at: int) -> dict:
    row = tx.one(f"SELECT * FROM {{schema}} WHERE lower(schema_name) = lower(?) AND {seen(at)}", (name,))
    if not row:
        raise SchemaNotFoundError(f"there is no schema {name}")
    return row


def find_table(tx: Transaction, name: str, at: Snapshot) -> TableInfo:
    schema, table = split_name(name)
    s = find_schema(tx, schema, at.snapshot_id)
    row = tx.one(f"SELECT * FROM {{table}} WHERE schema_id = ? AND lower(table_name) = lower(?) AND {seen(at.snapshot_id)}", (s["schema_id"], table))
    if not row:
        raise TableNotFoundError(f"there is no table {schema}.{table}")
    columns = tx.rows(f"SELECT * FROM {{column}} WHERE table_id = ? AND parent_column IS NULL AND {seen(at.snapshot_id)} ORDER BY column_order", (row["table_id"],))
    info = tuple(ColumnInfo(c["column_id"], c["column_name"], c["column_type"], c["initial_default"], c["default_value"], c["nulls_allowed"] is None or bool(c["nulls_allowed"])) for c in columns)
    by_id = {c.column_id: c.name for c in info}
    parts = tx.rows("SELECT column_id FROM {table_partition_column} WHERE table_id = ?", (row["table_id"],))
    if not parts:
        parts = tx.rows("SELECT column_id FROM {name_mapping} WHERE mapping_id = ? AND is_partition", (row["table_id"],))
    path = full_path(full_path("", s["path"] or "", True), row["path"] or "", True) if row["path_is_relative"] else row["path"]
    return TableInfo(at, row["table_id"], s["schema_name"], row["table_name"], path, info, tuple(by_id[p["column_id"]] for p in parts if p["column_id"] in by_id))


class Scanner:
    """Reads of one catalog. What a snapshot holds never changes, so it is kept by snapshot."""

    def __init__(self, spark: SparkSession, store: Metastore) -> None:
        self.spark, self.store = spark, store
        self._tables: dict[tuple[str, int], TableInfo] = {}
        self._files: dict[tuple[int, int], list[DataFile]] = {}
        self.shapes: dict[tuple[int, int, int], DataFrame] = {}
        spark.conf.set("spark.sql.parquet.fieldId.read.enabled", "true")
        spark.conf.set("spark.sql.parquet.fieldId.write.enabled", "true")
        spark.conf.set("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")

    def table(self, name: str, version: int | str | None = None, timestamp: object = None) -> TableInfo:
        at = self.store.snapshot(version, timestamp)
        key = (name.lower(), at.snapshot_id)
        if key not in self._tables:
            if len(self._tables) > 1000:
                self._tables.clear()
            self._tables[key] = self.store.read(lambda tx: find_table(tx, name, at))
        return self._tables[key]

    def data_files(self, t: TableInfo) -> list[DataFile]:
        """Visible files with their visible delete files: one query for each kind."""

        def query(tx: Transaction) -> list[DataFile]:
            at, base = t.snapshot.snapshot_id, self.store.data_path
            deletes: dict[int, list] = {}
            for r in tx.rows(f"SELECT data_file_id, path, path_is_relative, delete_count FROM {{delete_file}} WHERE table_id = ? AND {seen(at)}", (t.table_id,)):
                deletes.setdefault(r["data_file_id"], []).append((full_path(base, r["path"], r["path_is_relative"]), r["delete_count"]))
            rows = tx.rows(f"SELECT * FROM {{data_file}} WHERE table_id = ? AND {seen(at)} ORDER BY begin_snapshot, file_order, data_file_id", (t.table_id,))
            return [DataFile(r["data_file_id"], full_path(base, r["path"], r["path_is_relative"]), r["record_count"], r["file_size_bytes"] or 0, r["mapping_id"], r["begin_snapshot"], tuple(deletes.get(r["data_file_id"], ()))) for r in rows]

        key = (t.table_id, t.snapshot.snapshot_id)
        if key not in self._files:
            found = self.store.read(query)
            if sum(map(len, self._files.values())) + len(found) > KEPT_FILES:
                self._files.clear()
            self._files[key] = found
        return self._files[key]

    def zones(self, t: TableInfo, names: set[str]) -> dict[int, dict[str, Zone]]:
        """Statistics of the named columns by file; a partition value stands in for missing ones."""
        by_id = {c.column_id: c for c in t.columns if c.name in names}
        if not by_id:
            return {}
        marks = ", ".join("?" * len(by_id))

        def query(tx: Transaction) -> tuple[list[dict], list[dict]]:
            where = f"data_file_id IN (SELECT data_file_id FROM {{data_file}} WHERE table_id = ? AND {seen(t.snapshot.snapshot_id)})"
            stats = tx.rows(f"SELECT * FROM {{file_column_stats}} WHERE column_id IN ({marks}) AND {where}", (*by_id, t.table_id))
            return stats, tx.rows(f"SELECT * FROM {{file_partition_value}} WHERE {where}", (t.table_id,)) if t.partition_by else []

        stats, parts = self.store.read(query)
        out: dict[int, dict[str, Zone]] = {}
        for r in parts:
            if r["partition_key_index"] < len(t.partition_by) and (name := t.partition_by[r["partition_key_index"]]) in names:
                v = decode(r["partition_value"], t.column(name).spark_type)
                out.setdefault(r["data_file_id"], {})[name] = Zone(v, v)
        for r in stats:
            c = by_id[r["column_id"]]
            out.setdefault(r["data_file_id"], {})[c.name] = zone(r, c.spark_type)
        return out

    def plan(self, t: TableInfo, where: str | Column | None = None) -> Scan:
        """The files that may hold matches."""
        files = self.data_files(t)
        if where is None:
            return Scan(files)
        test, names = predicate(self.spark, t.spark_schema(), where)
        zones = self.zones(t, names)
        kept = [f for f in files if test(zones.get(f.data_file_id, {}))]
        return Scan(kept, len(files) - len(kept))

    def mapping(self, mapping_id: int) -> dict[int, str]:
        return {r["column_id"]: r["source_name"] for r in self.store.rows("SELECT column_id, source_name FROM {name_mapping} WHERE mapping_id = ? AND source_name IS NOT NULL", (mapping_id,))}

    def _parquet(self, t: TableInfo, files: list[DataFile], positions: bool) -> DataFrame:
        """Files of one kind: all with field ids, or all of one name mapping."""
        paths, where = [f.path for f in files], [F.col("_metadata.file_path").alias(FILE), F.col("_metadata.row_index").alias(POS)] if positions else []
        if files[0].mapping_id is None:
            df = self.spark.read.schema(t.spark_schema(ids=True)).parquet(*paths)
            return df.select(*(F.col(f"`{c.name}`") for c in t.columns), *where)
        names = self.mapping(files[0].mapping_id)
        df = self.spark.read.parquet(*paths)
        physical = {c.lower(): c for c in df.columns}
        out = []
        for c in t.columns:
            own = physical.get(names[c.column_id].lower()) if c.column_id in names else None
            default = literal_sql(c.initial_default, c.spark_type)
            value = F.col(f"`{own}`") if own else F.expr(default) if default else F.lit(None)
            out.append(value.cast(c.spark_type).alias(c.name))
        return df.select(*out, *where)

    def positions(self, deletes: list[tuple[str, str]], count: int) -> DataFrame:
        """FILE and POS of the rows that delete files name. deletes: (delete file, data file)."""
        qualified = qualify_all(self.spark, [d for d, _ in deletes])
        data = qualify_all(self.spark, [f for _, f in deletes])
        names = self.spark.createDataFrame(list(zip(qualified, data, strict=True)), f"_delete string, {FILE} string")
        rows = self.spark.read.schema("row_id long").parquet(*sorted({d for d, _ in deletes}))
        found = rows.select(F.col("row_id").alias(POS), F.col("_metadata.file_path").alias("_delete")).join(F.broadcast(names), "_delete").select(FILE, POS)
        return F.broadcast(found) if count * (16 + max(map(len, data), default=0)) <= BROADCAST_DELETES else found

    def rows_of(self, t: TableInfo, files: list[DataFile], positions: bool = False, deleted: bool = False) -> DataFrame | None:
        """The rows of files that are not deleted, or with deleted the others only; None without files."""
        kinds: dict[tuple, list[DataFile]] = {}
        for f in files:
            kinds.setdefault((f.mapping_id, bool(f.deletes)), []).append(f)
        out = None
        for (_, has), group in sorted(kinds.items(), key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[0][1])):
            if deleted and not has:
                continue
            df = self._parquet(t, group, positions or has)
            if has:
                gone = self.positions([(d, f.path) for f in group for d, _ in f.deletes], sum(n for f in group for _, n in f.deletes))
                df = df.join(gone, [FILE, POS], "left_semi" if deleted else "left_anti")
                df = df.select(*(F.col(f"`{c.name}`") for c in t.columns), *([FILE, POS] if positions else []))
            out = df if out is None else out.unionByName(df)
        return out

    def inlined_rows(self, t: TableInfo, condition: str | None = None, snapshot: str | None = None) -> list[tuple]:
        """Values, INLINE name and row id of rows kept in the catalog; see inlined()."""

        def query(tx: Transaction) -> list[tuple]:
            out = []
            for r in tx.rows("SELECT table_name FROM {inlined_data_tables} WHERE table_id = ? ORDER BY schema_version", (t.table_id,)):
                for row in tx.rows(f'SELECT * FROM "{r["table_name"]}" WHERE {condition or seen(t.snapshot.snapshot_id)} ORDER BY row_id'):
                    values = [decode(row[k], c.spark_type) if (k := f"c{c.column_id}") in row else decode(c.initial_default, c.spark_type) for c in t.columns]
                    out.append((*values, INLINE + r["table_name"], row["row_id"], *((row[snapshot],) if snapshot else ())))
            return out

        return self.store.read(query)

    def inlined(self, t: TableInfo, condition: str | None = None, positions: bool = False, snapshot: str | None = None) -> DataFrame | None:
        """Rows kept in the catalog that are visible (or meet a condition on begin_snapshot and end_snapshot). snapshot: which of these is given as _snapshot_id."""
        rows = self.inlined_rows(t, condition, snapshot)
        if not rows:
            return None
        schema = T.StructType([*t.spark_schema().fields, T.StructField(FILE, T.StringType()), T.StructField(POS, T.LongType()), *([T.StructField("_snapshot_id", T.LongType())] if snapshot else [])])
        df = self.spark.createDataFrame(rows, schema)
        return df if positions else df.drop(FILE, POS)

    def read(self, t: TableInfo, where: str | Column | None = None, positions: bool = False, files: list[DataFile] | None = None) -> DataFrame:
        """The table's rows; where chooses files and is applied to the rows. files: those that were chosen before."""
        df = self.rows_of(t, self.plan(t, where).files if files is None else files, positions)
        inline = self.inlined(t, positions=positions)
        if inline is not None:
            df = inline if df is None else df.unionByName(inline)
        if df is None:
            extra = [T.StructField(FILE, T.StringType()), T.StructField(POS, T.LongType())] if positions else []
            df = self.spark.createDataFrame([], T.StructType([*t.spark_schema().fields, *extra]))
        return df if where is None else df.filter(where)

    def count(self, t: TableInfo) -> int:
        """Rows from the catalog alone; no file is opened."""
        at = t.snapshot.snapshot_id

        def query(tx: Transaction) -> int:
            kept = tx.one(f"SELECT coalesce(sum(record_count), 0) AS n FROM {{data_file}} WHERE table_id = ? AND {seen(at)}", (t.table_id,))["n"]
            gone = tx.one(f"SELECT coalesce(sum(d.delete_count), 0) AS n FROM {{delete_file}} d JOIN {{data_file}} f ON d.data_file_id = f.data_file_id WHERE d.table_id = ? AND {seen(at, 'd')} AND {seen(at, 'f')}", (t.table_id,))["n"]
            inline = sum(tx.one(f'SELECT count(*) AS n FROM "{r["table_name"]}" WHERE {seen(at)}')["n"] for r in tx.rows("SELECT table_name FROM {inlined_data_tables} WHERE table_id = ?", (t.table_id,)))
            return int(kept) - int(gone) + inline

        return self.store.read(query)


def at_snapshot(t: TableInfo, snapshot: Snapshot) -> TableInfo:
    return replace(t, snapshot=snapshot)
