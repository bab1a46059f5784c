"""Writes: files go to a folder of their own under the table, invisible until one metadata transaction names them."""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import AlreadyExistsError, ColumnNotFoundError, ConcurrentModificationError, ConstraintError, SchemaMismatchError
from ..functions.values import decode, encode, is_scalar, literal_sql
from ..sources.metastore import Metastore, Snapshot, Transaction, seen
from ..sources.paths import described, footers, list_parquet, qualified, qualify_all, remove, write_bytes
from ..sources.scan import FILE, INLINE, POS, Scanner, TableInfo

#: A frame that has at most so many rows by its plan, and about so many bytes, is written by the driver as one file, without a Spark write job.
DIRECT_ROWS, DIRECT_BYTES = 100_000, 64 << 20
#: Partition value of nulls.
NULL = "__NULL__"
#: What the error of a null says before the column's name.
NOT_NULL = "firnlake: null in the column that must not have one:"


@dataclass
class Written:
    """Files that a write left in a folder: path relative to the data path, size, and their footer."""

    folder: str
    files: list[tuple[str, int, dict]] = field(default_factory=list)

    @property
    def rows(self) -> int:
        return sum(f["rows"] for *_, f in self.files)


@contextmanager
def not_null() -> Iterator[None]:
    """Tells the error of a written null, which checked() raises in the plan, as ConstraintError."""
    try:
        yield
    except Exception as e:
        text = str(e)
        if NOT_NULL in text:
            said = re.search(re.escape(NOT_NULL) + r"[^\n]*", text)[0]
            raise ConstraintError(said.partition(" SQLSTATE:")[0].removeprefix("firnlake: ")) from e
        raise


class Writer:
    def __init__(self, spark: SparkSession, store: Metastore, scanner: Scanner) -> None:
        self.spark, self.store, self.scanner = spark, store, scanner
        self._local: bool | None = None  # is the data path on the driver's own file system

    # ---- files

    def align(self, df: DataFrame, t: TableInfo) -> DataFrame:
        """df's columns as the table's: by name in any case; missing ones take their write default; unknown ones fail."""
        own = {c.lower(): c for c in df.columns}
        if len(own) < len(df.columns):
            raise SchemaMismatchError(f"columns repeat: {df.columns}")
        unknown = set(own) - {c.name.lower() for c in t.columns}
        if unknown:
            raise SchemaMismatchError(f"{t.schema}.{t.name} has no columns {sorted(unknown)}")
        schema, out = t.spark_schema(ids=True), []
        for c, f in zip(t.columns, schema.fields, strict=True):
            default = literal_sql(c.default_value, c.spark_type)
            value = F.col(f"`{own[c.name.lower()]}`") if c.name.lower() in own else F.expr(default) if default else F.lit(None)
            out.append(value.cast(c.spark_type).alias(c.name, metadata={"parquet.field.id": f.metadata["parquet.field.id"]}))
        return df.select(*out)

    def write_files(self, df: DataFrame, t: TableInfo, files: int | None = None) -> Written:
        """df (aligned) as Parquet in a new folder. A partitioned table gets files of one combination of values each;
        a frequent combination is dealt to several tasks."""
        folder = f"{t.path}{uuid.uuid4().hex}"
        target = self.store.data_path + folder
        out = Written(folder)
        try:
            if t.partition_by:
                keys = [f"_p{i}" for i in range(len(t.partition_by))]
                for k, c in zip(keys, t.partition_by, strict=True):
                    df = df.withColumn(k, F.col(f"`{c}`").cast("string"))
                df.hint("rebalance", *keys).write.partitionBy(*keys).parquet(target)
            else:
                (df.coalesce(files) if files else df).write.parquet(target)
            types = {c.name: c.type for c in t.columns if is_scalar(c.spark_type)}
            listed = list_parquet(self.spark, target)
            read = footers(self.spark, [f"{target}/{p}" for p, _ in listed], types)
            out.files = [(f"{folder}/{p}", size, f) for (p, size), f in zip(listed, read, strict=True) if f["rows"]]
        except BaseException:
            remove(self.spark, target)
            raise
        if not out.files:
            remove(self.spark, target)
        return out

    def write_direct(self, df: DataFrame, t: TableInfo) -> Written | None:
        """df (as it was given) as one file that the driver writes; None if df may be large, or the table is partitioned or nested."""
        if t.partition_by or not all(is_scalar(c.spark_type) for c in t.columns):
            return None
        plan = df._jdf.queryExecution().optimizedPlan()
        most = plan.maxRows()
        if most.isEmpty() or most.get() > DIRECT_ROWS or int(str(plan.stats().sizeInBytes())) > DIRECT_BYTES:
            return None
        if [(f.name, f.dataType) for f in df.schema.fields] != [(c.name, c.spark_type) for c in t.columns]:
            df = self.align(df, t)
        folder = f"{t.path}{uuid.uuid4().hex}"
        import pyarrow as pa
        import pyarrow.compute as pc
        import pyarrow.parquet as pq

        rows = df.toArrow()
        if not rows.num_rows:
            return Written(folder)
        rows = rows.cast(pa.schema([f.with_metadata({"PARQUET:field_id": str(c.column_id)}) for f, c in zip(rows.schema, t.columns, strict=True)]))
        if null := [n for n in sorted(self.required(t)) if rows[n].null_count]:
            raise ConstraintError(f"{NOT_NULL} {null[0]}".removeprefix("firnlake: "))
        sink = pa.BufferOutputStream()
        # bounds that this writer gives leave NaN out, which is the largest value to Spark: such a column gets none
        nan = {f.name for f in rows.schema if pa.types.is_floating(f.type) and pc.any(pc.is_nan(rows[f.name])).as_py()}
        pq.write_table(rows, sink, compression="snappy", write_statistics=[n for n in rows.column_names if n not in nan])
        data = sink.getvalue()
        found = described(pq.ParquetFile(pa.BufferReader(data)), folder, {c.name: c.type for c in t.columns})
        for n in nan:
            found["stats"][n] = [rows.num_rows - rows[n].null_count, rows[n].null_count, None, None, True]
        name = f"{folder}/part-0.parquet"
        try:
            self._put(self.store.data_path + name, data)
        except BaseException:
            remove(self.spark, self.store.data_path + folder)
            raise
        return Written(folder, [(name, len(data), found)])

    def _put(self, path: str, data: Any) -> None:
        if self._local is None:
            self._local = qualified(self.spark, self.store.data_path).startswith("file:")
        if not self._local:
            write_bytes(self.spark, path, bytes(data))
            return
        path = re.sub(r"^file:/+", "/", path)
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "xb") as f:
            f.write(data)

    def discard(self, *written: Written | str) -> None:
        for w in written:
            remove(self.spark, self.store.data_path + (w if isinstance(w, str) else w.folder))

    def write_deletes(self, positions: DataFrame, t: TableInfo) -> tuple[str, dict[str, list[tuple[str, int, int]]]]:
        """positions (FILE, POS) as delete files: by data file (path as Spark names it) its delete files as (path, rows, size)."""
        folder = f"{t.path}{uuid.uuid4().hex}-deletes"
        target = self.store.data_path + folder
        rows = positions.withColumn("_p0", F.md5(FILE))
        named = {r["_p0"]: r[FILE] for r in rows.select("_p0", FILE).distinct().collect()}  # as many as files are touched
        if not named:
            return folder, {}
        rows.select(F.col(POS).cast("long").alias("row_id"), "_p0").hint("rebalance", "_p0").sortWithinPartitions("_p0", "row_id").write.partitionBy("_p0").parquet(target)
        listed = list_parquet(self.spark, target)
        counts = footers(self.spark, [f"{target}/{p}" for p, _ in listed], {})
        found: dict[str, list] = {}
        for (p, size), f in zip(listed, counts, strict=True):
            found.setdefault(named[p.split("/")[0].removeprefix("_p0=")], []).append((f"{folder}/{p}", f["rows"], size))
        return folder, found

    # ---- metadata

    def register(self, tx: Transaction, t: TableInfo, new: Snapshot, files: list[tuple[str, int, dict]], first_file_id: int, relative: bool = True, mapping_id: int | None = None) -> None:
        """Rows of the data files, their statistics and partition values; the table's statistics grow."""
        stats = tx.one("SELECT * FROM {table_stats} WHERE table_id = ?", (t.table_id,)) or {"record_count": 0, "next_row_id": 0, "file_size_bytes": 0}
        row_id, by_name = stats["next_row_id"], {c.name: c for c in t.columns}
        data, columns, parts = [], [], []
        for i, (path, size, f) in enumerate(files):
            file_id = first_file_id + i
            data.append({"data_file_id": file_id, "table_id": t.table_id, "begin_snapshot": new.snapshot_id, "end_snapshot": None, "file_order": i, "path": path, "path_is_relative": relative, "file_format": "parquet", "record_count": f["rows"], "file_size_bytes": size, "row_id_start": row_id, "mapping_id": mapping_id})
            row_id += f["rows"]
            for name, (values, nulls, low, high, nan) in f["stats"].items():
                columns.append({"data_file_id": file_id, "table_id": t.table_id, "column_id": by_name[name].column_id, "value_count": values, "null_count": nulls, "min_value": low, "max_value": high, "contains_nan": nan})
            for k, name in enumerate(t.partition_by):
                low, high, nulls = f["stats"].get(name, [None, None, None, None, None])[2:4] + [f["stats"].get(name, [0, 0])[1]]
                if relative and (low is not None and low == high or low is None and nulls):
                    parts.append({"data_file_id": file_id, "table_id": t.table_id, "partition_key_index": k, "partition_value": NULL if low is None else low})
        tx.add_many("data_file", data)
        tx.add_many("file_column_stats", columns)
        tx.add_many("file_partition_value", parts)
        tx.run("DELETE FROM {table_stats} WHERE table_id = ?", (t.table_id,))
        tx.add("table_stats", table_id=t.table_id, record_count=stats["record_count"] + sum(f["rows"] for *_, f in files), next_row_id=row_id, file_size_bytes=stats["file_size_bytes"] + sum(s for _, s, _ in files))

    def end_all(self, tx: Transaction, t: TableInfo, at: int) -> None:
        """Data files, delete files and inlined rows of the table end together; its counts start anew, but row ids go on."""
        for table in ("data_file", "delete_file"):
            tx.run(f"UPDATE {{{table}}} SET end_snapshot = ? WHERE table_id = ? AND end_snapshot IS NULL", (at, t.table_id))
        for r in tx.rows("SELECT table_name FROM {inlined_data_tables} WHERE table_id = ?", (t.table_id,)):
            tx.run(f'UPDATE "{r["table_name"]}" SET end_snapshot = ? WHERE end_snapshot IS NULL', (at,))
        tx.run("UPDATE {table_stats} SET record_count = 0, file_size_bytes = 0 WHERE table_id = ?", (t.table_id,))

    def guard(self, tx: Transaction, t: TableInfo, rows_too: bool) -> None:
        """Fail if a commit after t's snapshot dropped or altered the table or, with rows_too, changed its rows."""
        since = tx.rows("SELECT snapshot_id, changes_made FROM {snapshot_changes} WHERE snapshot_id > ?", (t.snapshot.snapshot_id,))
        if not since:
            return
        alive = tx.one(f"SELECT table_id FROM {{table}} WHERE table_id = ? AND {seen(tx.latest().snapshot_id)}", (t.table_id,))
        now = [(r["column_id"], r["column_name"], r["column_type"]) for r in tx.rows(f"SELECT * FROM {{column}} WHERE table_id = ? AND parent_column IS NULL AND {seen(tx.latest().snapshot_id)} ORDER BY column_order", (t.table_id,))]
        if not alive or now != [(c.column_id, c.name, c.type) for c in t.columns]:
            raise ConcurrentModificationError(f"{t.schema}.{t.name} was dropped or altered since snapshot {t.snapshot.snapshot_id}")
        marks = [f"{what}:{t.table_id}" for what in ("inserted_into_table", "deleted_from_table", "compacted_table")]
        touched = [r["snapshot_id"] for r in since if any(m in [x.strip() for x in (r["changes_made"] or "").split(",")] or f"to table:{t.table_id}" in (r["changes_made"] or "") for m in marks)]
        if rows_too and touched:
            raise ConcurrentModificationError(f"{t.schema}.{t.name} was changed by snapshots {touched} since {t.snapshot.snapshot_id}")

    def required(self, t: TableInfo) -> set[str]:
        """Columns that must not be null, by themselves or by a constraint."""
        names = {c.name for c in t.columns if not c.nullable}
        listed = self.store.rows(f"SELECT column_names FROM {{table_constraint}} WHERE table_id = ? AND upper(constraint_type) = 'NOT NULL' AND {seen(t.snapshot.snapshot_id)}", (t.table_id,))
        return names | {t.column(n.strip()).name for r in listed for n in (r["column_names"] or "").split(",") if n.strip()}

    def checked(self, df: DataFrame, t: TableInfo) -> DataFrame:
        """df (aligned), which fails where a required column is null: in the plan that is written, not before it."""
        names = self.required(t)
        if not names:
            return df
        out = []
        for f in df.schema.fields:
            value = F.col(f"`{f.name}`")
            if f.name in names:
                value = F.coalesce(value, F.raise_error(F.lit(f"{NOT_NULL} {f.name}")).cast(f.dataType)).alias(f.name, metadata=f.metadata)
            out.append(value)
        return df.select(*out)

    # ---- operators

    def append(self, df: DataFrame, t: TableInfo, replace: bool = False, files: int | None = None, message: str | None = None, extra: str | None = None, inline_limit: int = 0, skip: Callable[[Transaction], bool] | None = None) -> Snapshot | None:
        """Rows of df as a commit; with replace they take the place of all rows. An empty append commits nothing.

        inline_limit: rows of the table that may be kept in the catalog; a table that stays within it gets no file. extra: a mark
        kept with the commit. skip: asked inside the transaction; if true, nothing is committed.
        """
        given, df = df, None
        if inline_limit and not replace and not t.partition_by and all(is_scalar(c.spark_type) for c in t.columns):
            df = self.checked(self.align(given, t), t)
            with not_null():
                rows = df.limit(inline_limit + 1).collect()  # at most inline_limit rows are kept
            if len(rows) + self.inlined_count(t) <= inline_limit:
                return self.inline(t, rows, message, extra) if rows else None
        written = self.write_direct(given, t) if files in (None, 1) else None
        if written is None:
            with not_null():
                written = self.write_files(self.checked(self.align(given, t), t) if df is None else df, t, files)
        if not written.files and not replace:
            return None

        def commit(tx: Transaction) -> Snapshot | None:
            self.guard(tx, t, rows_too=False)
            if skip and skip(tx):
                return None
            changes = [f"inserted_into_table:{t.table_id}"] if written.files or not replace else []
            changes = [f"deleted_from_table:{t.table_id}"] * replace + changes
            first = tx.latest().next_file_id
            new = tx.commit_snapshot(",".join(changes), message, extra, file_ids=len(written.files))
            if replace:
                self.end_all(tx, t, new.snapshot_id)
            self.register(tx, t, new, written.files, first)
            return new

        return self._commit(commit, written)

    def _commit(self, change: Callable[[Transaction], Any], *written: Written | str) -> Any:
        """change in a transaction; if it fails or commits nothing, the files written for it go."""
        try:
            done = self.store.write(change)
        except BaseException:
            self.discard(*written)
            raise
        if done is None:
            self.discard(*written)
        return done

    def inlined_count(self, t: TableInfo) -> int:
        return self.store.read(lambda tx: sum(tx.one(f'SELECT count(*) AS n FROM "{r["table_name"]}" WHERE end_snapshot IS NULL')["n"] for r in tx.rows("SELECT table_name FROM {inlined_data_tables} WHERE table_id = ?", (t.table_id,))))

    def inline(self, t: TableInfo, rows: list, message: str | None = None, extra: str | None = None) -> Snapshot:
        """rows kept in the catalog, as text by column id."""

        def commit(tx: Transaction) -> Snapshot:
            self.guard(tx, t, rows_too=False)
            new = tx.commit_snapshot(f"inserted_into_table:{t.table_id}", message, extra)
            name = f"{tx.prefix}inlined_data_{t.table_id}_{new.schema_version}"
            if not tx.one("SELECT table_name FROM {inlined_data_tables} WHERE table_name = ?", (name,)):
                columns = "".join(f', "c{c.column_id}" VARCHAR' for c in t.columns)
                tx.run(f'CREATE TABLE IF NOT EXISTS "{name}" (row_id BIGINT, begin_snapshot BIGINT, end_snapshot BIGINT{columns})')
                tx.add("inlined_data_tables", table_id=t.table_id, table_name=name, schema_version=new.schema_version)
            stats = tx.one("SELECT * FROM {table_stats} WHERE table_id = ?", (t.table_id,))
            first = stats["next_row_id"] if stats else 0
            tx.add_many(name.removeprefix(tx.prefix), [{"row_id": first + i, "begin_snapshot": new.snapshot_id, "end_snapshot": None} | {f"c{c.column_id}": "NaN" if v != v else encode(v, c.spark_type) for c, v in zip(t.columns, r, strict=True)} for i, r in enumerate(rows)])
            tx.run("UPDATE {table_stats} SET record_count = record_count + ?, next_row_id = next_row_id + ? WHERE table_id = ?", (len(rows), len(rows), t.table_id))
            return new

        return self.store.write(commit)

    def apply(self, t: TableInfo, positions: DataFrame | None, rows: DataFrame | None, message: str | None = None) -> Snapshot | None:
        """Delete positions (FILE, POS) and add rows in one commit, based on t's snapshot. Nothing to do commits nothing.

        Both must come from one materialised plan.
        """
        folder, deletes = self.write_deletes(positions, t) if positions is not None else ("", {})
        written = None
        try:
            if rows is not None:
                rows = self.checked(self.align(rows, t), t)
                with not_null():
                    written = self.write_files(rows, t)
        except BaseException:
            if folder:
                self.discard(folder)
            raise
        used = [x for x in (folder if deletes else None, written if written and written.files else None) if x]
        if not used:
            return None
        files = self.scanner.data_files(t)
        at_file = dict(zip(qualify_all(self.spark, [f.path for f in files]), files, strict=True))
        in_files = [(at_file[name].data_file_id, *d) for name, found in sorted(deletes.items()) if not name.startswith(INLINE) for d in found]
        in_catalog = {name.removeprefix(INLINE): [self.store.data_path + p for p, *_ in found] for name, found in deletes.items() if name.startswith(INLINE)}
        ended = {name: [r["row_id"] for r in self.spark.read.parquet(*paths).collect()] for name, paths in in_catalog.items()}  # at most the inline limit
        added = written.files if written else []

        def commit(tx: Transaction) -> Snapshot:
            self.guard(tx, t, rows_too=True)
            first = tx.latest().next_file_id
            changes = [f"deleted_from_table:{t.table_id}"] * bool(deletes) + [f"inserted_into_table:{t.table_id}"] * bool(added)
            new = tx.commit_snapshot(",".join(changes), message, file_ids=len(in_files) + len(added))
            tx.add_many("delete_file", [{"delete_file_id": first + i, "table_id": t.table_id, "begin_snapshot": new.snapshot_id, "end_snapshot": None, "data_file_id": file_id, "path": p, "path_is_relative": True, "format": "parquet", "delete_count": n, "file_size_bytes": size} for i, (file_id, p, n, size) in enumerate(in_files)])
            for name, ids in ended.items():
                tx.run(f'UPDATE "{name}" SET end_snapshot = ? WHERE end_snapshot IS NULL AND row_id IN ({", ".join(map(str, ids))})', (new.snapshot_id,))
            gone = sum(n for _, _, n, _ in in_files) + sum(map(len, ended.values()))
            tx.run("UPDATE {table_stats} SET record_count = record_count - ? WHERE table_id = ?", (gone, t.table_id))
            if added:
                self.register(tx, t, new, added, first + len(in_files))
            return new

        return self._commit(commit, *used)

    def add_files(self, t: TableInfo, paths: list[str], relative: bool = False) -> Snapshot:
        """Existing Parquet files become part of the table where they are. Their columns must be the table's, in any case."""
        base = self.store.data_path
        full = [base + p if relative else p for p in paths]
        read = footers(self.spark, full, {})
        wanted = {c.name.lower(): c for c in t.columns}
        for f in read:
            if sorted(n.lower() for n in f["names"]) != sorted(wanted):
                raise SchemaMismatchError(f"{f['path']} has columns {f['names']}, the table {[c.name for c in t.columns]}")
        types = {n: wanted[n.lower()].type for f in read for n in f["names"] if is_scalar(wanted[n.lower()].spark_type)}
        read = footers(self.spark, full, types)
        for f in read:
            f["stats"] = {wanted[n.lower()].name: s for n, s in f["stats"].items()}
            for name, s in f["stats"].items():  # bounds must read as the table's type
                kind = t.column(name).spark_type
                if any(x is not None and decode(x, kind) is None for x in s[2:4]):
                    s[2:4] = None, None
        sizes = {p: n for p, n in zip(full, self._sizes(full), strict=True)}
        known = {f.path for f in self.scanner.data_files(t)}
        if twice := [p for p in full if p in known]:
            raise AlreadyExistsError(f"already part of the table: {twice}")

        def commit(tx: Transaction) -> Snapshot:
            self.guard(tx, t, rows_too=False)
            old = tx.latest()
            new = tx.commit_snapshot(f"add_files:{len(paths)} files to table:{t.table_id}", file_ids=len(paths))
            for i, (p, f) in enumerate(zip(paths, read, strict=True)):
                # one mapping for each distinct list of physical names: its id is that of its first file, moved out of the way of table ids
                mapping = -(old.next_file_id + next(j for j, g in enumerate(read) if g["names"] == f["names"]) + 1)
                if not tx.one("SELECT mapping_id FROM {name_mapping} WHERE mapping_id = ?", (mapping,)):
                    tx.add_many("name_mapping", [{"mapping_id": mapping, "column_id": wanted[n.lower()].column_id, "source_name": n, "target_field_id": wanted[n.lower()].column_id, "is_partition": False} for n in f["names"]])
                self.register(tx, t, new, [(p, sizes[full[i]], f)], old.next_file_id + i, relative, mapping)
            return new

        return self.store.write(commit)

    def _sizes(self, paths: list[str]) -> list[int]:
        hadoop, conf = self.spark._jvm.org.apache.hadoop.fs.Path, self.spark._jsparkSession.sessionState().newHadoopConf()
        return [hadoop(p).getFileSystem(conf).getFileStatus(hadoop(p)).getLen() for p in paths]


def need_column(t: TableInfo, name: str) -> None:
    if name.lower() not in {c.name.lower() for c in t.columns}:
        raise ColumnNotFoundError(f"{t.schema}.{t.name} has no column {name}")


__all__ = ["FILE", "POS", "Writer", "Written", "need_column"]
