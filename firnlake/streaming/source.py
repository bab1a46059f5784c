"""A table's appended rows as a stream: the offset is a snapshot, a micro-batch the files begun since the one before.

Files that compaction wrote are left out, as their rows were seen before. Inlined rows are read in the planning task.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from ..functions.values import decode, is_scalar
from ..sources.metastore import Metastore, Transaction
from ..sources.paths import _open
from ..sources.scan import ColumnInfo, TableInfo, find_table, full_path

FORMAT = "firnlake-stream"
#: Bytes of small files that one task reads, about.
TASK_BYTES = 64 << 20


class _Files(InputPartition):
    """Files (path, name mapping) that one task reads, or rows."""

    def __init__(self, files: list[tuple[str, dict[int, str] | None]], rows: list | None = None) -> None:
        self.files, self.rows = files, rows


class _Reader(DataSourceStreamReader):
    def __init__(self, options: dict, table: TableInfo, schema: pa.Schema) -> None:
        self.options, self.columns, self.schema, self.table_id, self.name = options, table.columns, schema, table.table_id, f"{table.schema}.{table.name}"

    def _store(self) -> Metastore:
        return Metastore(self.options["catalog"], self.options.get("data_path"), create=False)

    def initialOffset(self) -> dict:  # noqa: N802
        return {"snapshotId": int(self.options.get("start_snapshot", 0))}

    def latestOffset(self) -> dict:  # noqa: N802
        """All there is: Spark tells a Python source neither where the query stands nor how much it may admit."""
        return {"snapshotId": self._store().snapshot().snapshot_id}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        store, low, high = self._store(), start["snapshotId"], end["snapshotId"]

        def query(tx: Transaction) -> list[InputPartition]:
            moved = {r["snapshot_id"] for r in tx.rows("SELECT snapshot_id FROM {snapshot_changes} WHERE changes_made LIKE ?", (f"%compacted_table:{self.table_id}%",))}
            out: list[InputPartition] = []
            mappings: dict[int, dict[int, str]] = {}
            held, weight = [], 0
            for r in tx.rows("SELECT * FROM {data_file} WHERE table_id = ? AND begin_snapshot > ? AND begin_snapshot <= ? ORDER BY begin_snapshot, file_order", (self.table_id, low, high)):
                if r["begin_snapshot"] in moved:
                    continue
                key = r["mapping_id"]
                if key is not None and key not in mappings:
                    mappings[key] = {m["column_id"]: m["source_name"] for m in tx.rows("SELECT column_id, source_name FROM {name_mapping} WHERE mapping_id = ?", (key,))}
                held.append((full_path(store.data_path, r["path"], r["path_is_relative"]), mappings.get(key)))
                weight += r["file_size_bytes"] or 0
                if weight >= TASK_BYTES:
                    out.append(_Files(held))
                    held, weight = [], 0
            if held:
                out.append(_Files(held))
            for t in tx.rows("SELECT table_name FROM {inlined_data_tables} WHERE table_id = ?", (self.table_id,)):
                rows = tx.rows(f'SELECT * FROM "{t["table_name"]}" WHERE begin_snapshot > ? AND begin_snapshot <= ? ORDER BY row_id', (low, high))
                if rows:
                    out.append(_Files([], [tuple(decode(r.get(f"c{c.column_id}", c.initial_default), c.spark_type) for c in self.columns) for r in rows]))
            return out

        return store.read(query) or [_Files([], [])]

    def read(self, partition: _Files) -> Iterator[Any]:
        if partition.rows is not None:
            yield from partition.rows
            return
        for path, names in partition.files:
            with _open(path) as f:
                physical = f.schema_arrow
                by_id = {int(m[b"PARQUET:field_id"]): i for i in range(len(physical.names)) if (m := physical.field(i).metadata or {}).get(b"PARQUET:field_id") is not None}
                places = [self._place(c, names, by_id, physical) for c in self.columns]
                for b in f.iter_batches():
                    columns = [self._column(b, p, c, k) for p, c, k in zip(places, self.columns, self.schema, strict=True)]
                    yield pa.RecordBatch.from_arrays(columns, schema=self.schema)

    @staticmethod
    def _place(c: ColumnInfo, names: dict[int, str] | None, by_id: dict[int, int], physical: pa.Schema) -> int | None:
        if names is not None:
            name = names.get(c.column_id, "").lower()
            return next((i for i, n in enumerate(physical.names) if n.lower() == name), None)
        return by_id.get(c.column_id)

    @staticmethod
    def _column(b: pa.RecordBatch, place: int | None, c: ColumnInfo, kind: pa.Field) -> pa.Array:
        if place is not None:
            return b.column(place).cast(kind.type)
        value = decode(c.initial_default, c.spark_type) if is_scalar(c.spark_type) else None
        return pa.array([value] * b.num_rows, kind.type)

    def commit(self, end: dict) -> None:
        """Nothing to do: a snapshot's files stay until it is expired and vacuumed."""


class LakeStream(DataSource):
    """Options: catalog, table, and if wanted data_path, start_snapshot (rows after it; 0 is all)."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def _table(self) -> TableInfo:
        store = Metastore(self.options["catalog"], self.options.get("data_path"), create=False)
        return store.read(lambda tx: find_table(tx, self.options["table"], tx.latest()))

    def schema(self) -> Any:
        return self._table().spark_schema()

    def streamReader(self, schema: Any) -> _Reader:  # noqa: N802
        from pyspark.sql.pandas.types import to_arrow_schema

        return _Reader(dict(self.options), self._table(), to_arrow_schema(schema))


def read_stream(spark: SparkSession, catalog: str, table: str, data_path: str | None = None, start_snapshot: int = 0) -> Any:
    """A streaming DataFrame of the rows appended to table."""
    spark.dataSource.register(LakeStream)
    reader = spark.readStream.format(FORMAT).option("catalog", catalog).option("table", table).option("start_snapshot", str(start_snapshot))
    return (reader.option("data_path", data_path) if data_path else reader).load()


__all__ = ["FORMAT", "LakeStream", "read_stream"]
