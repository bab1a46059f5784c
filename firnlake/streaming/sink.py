"""Streaming into a table: every micro-batch that has rows is one commit, made once however often it is replayed."""

from __future__ import annotations

import hashlib
from typing import TYPE_CHECKING, Any

from pyspark.sql import DataFrame

from ..sources.metastore import Snapshot, Transaction

if TYPE_CHECKING:
    from ..lake import Lake


def commit_batch(lake: Lake, df: DataFrame, table: str, query: str, batch: int) -> Snapshot | None:
    """Append df unless the batch of that query was committed before."""
    mark = f"{query}:{batch}"

    def done(tx: Transaction) -> bool:
        return tx.one("SELECT snapshot_id FROM {snapshot_changes} WHERE commit_extra_info = ?", (mark,)) is not None

    if lake.store.read(done):
        return None
    return lake.writer.append(df, lake.table(table), message=f"Streaming write epoch {batch}", extra=mark, skip=done)


def write_stream(lake: Lake, df: DataFrame, table: str, checkpoint: str, query: str | None = None, **trigger: Any) -> Any:
    """Start a query that appends df (a stream) to table; trigger as DataStreamWriter.trigger has it.

    query names the stream in the catalog; by default it follows from the checkpoint, which must not be used for another.
    """
    name = query or hashlib.sha256(f"{table}|{checkpoint}".encode()).hexdigest()[:32]
    writer = df.writeStream.option("checkpointLocation", checkpoint).outputMode("append")
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.foreachBatch(lambda batch, n: commit_batch(lake, batch, table, name, n) and None).start()
