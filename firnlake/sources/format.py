"""spark.read.format("firnlake") and df.write.format("firnlake"): the lake's tables for code that knows Spark's data sources only.

register(spark) makes it known and lets Spark push filters to it. Options as LakeReader has them: catalog, table, schema, data_path,
snapshot_version (asOfVersion), snapshot_time (asOfTimestamp). Filters that Spark pushes choose files, and Spark applies them to the rows.
Rows pass through Python workers here, on stores that pyarrow opens; Lake.read() leaves them to Spark's own Parquet reader and is the one to
use for large reads.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from typing import TYPE_CHECKING, Any

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, Filter, InputPartition, WriterCommitMessage

from ..errors import LakeError, SchemaMismatchError
from ..functions.values import decode, is_scalar
from ..plans.prune import pushed_test
from .metastore import Metastore
from .paths import _local, _open, described
from .scan import DataFile, Scanner, TableInfo, find_table
from .ship import ship

if TYPE_CHECKING:
    import pyarrow as pa

FORMAT = "firnlake"


def options_of(options: dict) -> tuple[Metastore, str, dict]:
    """The catalog, the table's name and all options by lower case."""
    own = {k.lower(): v for k, v in options.items()}
    for key in ("catalog", "table"):
        if key not in own:
            raise LakeError(f"option {key} is missing")
    name = own["table"] if "." in own["table"] else f"{own.get('schema', 'main')}.{own['table']}"
    return Metastore(own["catalog"], own.get("data_path"), create=False), name, own


def table_of(options: dict) -> tuple[Metastore, TableInfo]:
    store, name, own = options_of(options)
    at = store.snapshot(own.get("snapshot_version", own.get("asofversion")), own.get("snapshot_time", own.get("asoftimestamp")))
    return store, store.read(lambda tx: find_table(tx, name, at))


class _Part(InputPartition):
    def __init__(self, file: DataFile | None, names: dict[int, str] | None, rows: list | None = None) -> None:
        self.file, self.names, self.rows = file, names, rows


class _Planner(Scanner):
    """The parts of a scanner that need no session."""

    def __init__(self, store: Metastore) -> None:
        self.spark, self.store, self._tables, self._files = None, store, {}, {}


def batches(path: str, names: dict[int, str] | None, t: TableInfo, schema: pa.Schema, gone: set[int] | None = None) -> Iterator[pa.RecordBatch]:
    """A file's rows as the table's columns, without those at the places gone."""
    import numpy as np
    import pyarrow as pa

    with _open(path) as f:
        physical = f.schema_arrow
        by_id = {int(m[b"PARQUET:field_id"]): i for i in range(len(physical.names)) if (m := physical.field(i).metadata or {}).get(b"PARQUET:field_id") is not None}
        by_name = {n.lower(): i for i, n in enumerate(physical.names)}
        places = [by_id.get(c.column_id) if names is None else by_name.get(names.get(c.column_id, "").lower()) for c in t.columns]
        at = 0
        for b in f.iter_batches():
            columns = []
            for place, c, kind in zip(places, t.columns, schema, strict=True):
                if place is None:
                    value = decode(c.initial_default, c.spark_type) if is_scalar(c.spark_type) else None
                    columns.append(pa.array([value] * b.num_rows, kind.type))
                else:
                    columns.append(b.column(place).cast(kind.type))
            out = pa.RecordBatch.from_arrays(columns, schema=schema)
            if gone:
                out = out.filter(pa.array(~np.isin(np.arange(at, at + b.num_rows), list(gone))))
            at += b.num_rows
            yield out


class _Reader(DataSourceReader):
    def __init__(self, store: Metastore, t: TableInfo, schema: pa.Schema) -> None:
        self.store, self.t, self.schema = store, t, schema
        self.filters: list[Filter] = []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:  # noqa: N802
        self.filters = list(filters)
        return filters  # all are still applied to the rows

    def partitions(self) -> list[_Part]:
        planner = _Planner(self.store)
        test, names = pushed_test(self.filters, {c.name for c in self.t.columns})
        zones = planner.zones(self.t, names)
        out = [_Part(f, planner.mapping(f.mapping_id) if f.mapping_id is not None else None) for f in planner.data_files(self.t) if test(zones.get(f.data_file_id, {}))]
        rows = planner.inlined_rows(self.t)
        return [*out, *([_Part(None, None, [r[: len(self.t.columns)] for r in rows])] if rows else [])]

    def read(self, partition: _Part) -> Iterator[Any]:
        if partition.file is None:
            yield from partition.rows or []
            return
        gone: set[int] = set()
        for path, _ in partition.file.deletes:
            with _open(path) as f:
                gone.update(f.read(columns=["row_id"]).column(0).to_pylist())
        yield from batches(partition.file.path, partition.names, self.t, self.schema, gone)


@dataclass
class _Message(WriterCommitMessage):
    path: str
    size: int
    footer: dict


class _Writer(DataSourceArrowWriter):
    """Each task writes one file; the commit names them all."""

    def __init__(self, store: Metastore, t: TableInfo, given: Any, overwrite: bool) -> None:
        own = {f.name.lower() for f in given.fields}
        if unknown := own - {c.name.lower() for c in t.columns}:
            raise SchemaMismatchError(f"{t.schema}.{t.name} has no columns {sorted(unknown)}")
        if t.partition_by:
            raise LakeError("a partitioned table is written by Lake.append")
        self.store, self.t, self.overwrite, self.folder = store, t, overwrite, f"{t.path}{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        import os

        import pyarrow as pa
        import pyarrow.compute as pc
        import pyarrow.parquet as pq
        from pyarrow import fs
        from pyspark.sql.pandas.types import to_arrow_schema

        found = [b for b in iterator if b.num_rows]
        if not found:
            return _Message("", 0, {})
        given, columns, kinds = pa.Table.from_batches(found), [], to_arrow_schema(self.t.spark_schema())
        by_name = {n.lower(): n for n in given.column_names}
        for c, kind in zip(self.t.columns, kinds, strict=True):
            if c.name.lower() in by_name:
                columns.append(given[by_name[c.name.lower()]].cast(kind.type))
            else:
                columns.append(pa.chunked_array([pa.array([decode(c.default_value, c.spark_type) if is_scalar(c.spark_type) else None] * given.num_rows, kind.type)]))
            if not c.nullable and columns[-1].null_count:
                raise LakeError(f"null in the column that must not have one: {c.name}")
        rows = pa.table(columns, schema=pa.schema([pa.field(c.name, k.type, True, {"PARQUET:field_id": str(c.column_id)}) for c, k in zip(self.t.columns, kinds, strict=True)]))
        nan = {f.name for f in rows.schema if pa.types.is_floating(f.type) and pc.any(pc.is_nan(rows[f.name])).as_py()}
        sink = pa.BufferOutputStream()
        pq.write_table(rows, sink, write_statistics=[n for n in rows.column_names if n not in nan])
        data = sink.getvalue()
        footer = described(pq.ParquetFile(pa.BufferReader(data)), "", {c.name: c.type for c in self.t.columns if is_scalar(c.spark_type)})
        for n in nan:
            footer["stats"][n] = [rows.num_rows - rows[n].null_count, rows[n].null_count, None, None, True]
        path = f"{self.folder}/part-{uuid.uuid4().hex}.parquet"
        if (local := _local(self.store.data_path + path)) is not None:
            os.makedirs(os.path.dirname(local), exist_ok=True)
            with open(local, "xb") as f:
                f.write(data)
        else:
            store, inner = fs.FileSystem.from_uri(self.store.data_path + path)
            with store.open_output_stream(inner) as out:
                out.write(data)
        return _Message(path, len(data), footer)

    def commit(self, messages: list[_Message | None]) -> None:
        from ..operators.write import Writer

        files = [(m.path, m.size, m.footer) for m in messages if m and m.path]
        if not files and not self.overwrite:
            return
        writer = Writer(None, self.store, _Planner(self.store))

        def change(tx: Any) -> None:
            writer.guard(tx, self.t, rows_too=False)
            first = tx.latest().next_file_id
            said = [f"deleted_from_table:{self.t.table_id}"] * self.overwrite + [f"inserted_into_table:{self.t.table_id}"] * bool(files)
            new = tx.commit_snapshot(",".join(said), file_ids=len(files))
            if self.overwrite:
                writer.end_all(tx, self.t, new.snapshot_id)
            writer.register(tx, self.t, new, files, first)

        self.store.write(change)

    def abort(self, messages: list[_Message | None]) -> None:
        """Files that were written stay unnamed; nothing reads them."""


class LakeSource(DataSource):
    """See the module."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> Any:
        return table_of(dict(self.options))[1].spark_schema()

    def reader(self, schema: Any) -> _Reader:
        from pyspark.sql.pandas.types import to_arrow_schema

        store, t = table_of(dict(self.options))
        return _Reader(store, t, to_arrow_schema(t.spark_schema()))

    def writer(self, schema: Any, overwrite: bool) -> _Writer:
        store, t = table_of(dict(self.options))
        return _Writer(store, t, schema, overwrite)


def register(spark: SparkSession) -> None:
    """Make the format known to the session."""
    ship(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(LakeSource)


__all__ = ["FORMAT", "LakeSource", "register"]
