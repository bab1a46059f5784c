"""File operations through Hadoop's file systems, so that any store that Spark reads will do, and Parquet footers."""

from __future__ import annotations

import math
import os
import re
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from typing import Any

import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import types as T

from ..functions.values import encode, parse_type


def _path(spark: SparkSession, path: str) -> Any:
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _fs(spark: SparkSession, path: str) -> Any:
    return _path(spark, path).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def qualified(spark: SparkSession, path: str) -> str:
    """The path as Spark's _metadata.file_path has it."""
    uri = _fs(spark, path).makeQualified(_path(spark, path)).toUri()
    return f"{uri.getScheme()}:{'//' + uri.getRawAuthority() if uri.getRawAuthority() else ''}{uri.getRawPath()}"


def qualify_all(spark: SparkSession, paths: list[str]) -> list[str]:
    """qualified() of many paths; each folder is resolved once."""
    folders: dict[str, str] = {}
    out = []
    for p in paths:
        folder, _, name = p.rpartition("/")
        if folder and re.fullmatch(r"[A-Za-z0-9_.=-]+", name):
            if folder not in folders:
                folders[folder] = qualified(spark, folder)
            out.append(f"{folders[folder]}/{name}")
        else:
            out.append(qualified(spark, p))
    return out


def list_parquet(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """Parquet files below path, as (path relative to it, size), by name."""
    fs, root = _fs(spark, path), _path(spark, path)
    base = fs.makeQualified(root).toString().rstrip("/") + "/"
    found, files = [], fs.listFiles(root, True)
    while files.hasNext():
        f = files.next()
        name = f.getPath().toString().removeprefix(base)
        if name.endswith(".parquet") and not re.search(r"(^|/)[_.](?!p\d+=)", name):
            found.append((name, f.getLen()))
    return sorted(found)


def remove(spark: SparkSession, path: str) -> bool:
    return bool(_fs(spark, path).delete(_path(spark, path), True))


def exists(spark: SparkSession, path: str) -> bool:
    return bool(_fs(spark, path).exists(_path(spark, path)))


def write_bytes(spark: SparkSession, path: str, data: bytes) -> None:
    """A new file of data, with the folders above it."""
    out = _fs(spark, path).create(_path(spark, path), False)
    try:
        out.write(data)
    finally:
        out.close()


class _Remote:
    """A file of any store that Hadoop reads, for pyarrow: only the ranges that are asked for are fetched."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        fs = _fs(spark, path)
        self.size = fs.getFileStatus(_path(spark, path)).getLen()
        self.stream, self.io, self.at, self.closed = fs.open(_path(spark, path)), spark._jvm.org.apache.commons.io.IOUtils, 0, False

    def seek(self, to: int, whence: int = 0) -> int:
        self.at = to + (0, self.at, self.size)[whence]
        return self.at

    def tell(self) -> int:
        return self.at

    def read(self, n: int = -1) -> bytes:
        n = self.size - self.at if n is None or n < 0 else min(n, self.size - self.at)
        self.stream.seek(self.at)
        data = bytes(self.io.toByteArray(self.stream, n)) if n else b""
        self.at += len(data)
        return data

    def close(self) -> None:
        if not self.closed:
            self.closed = True
            self.stream.close()


def _local(path: str) -> str | None:
    """The path on this machine's file system, if it is one."""
    if path.startswith("file:"):
        return re.sub(r"^file:/+", "/", path)
    return None if re.match(r"[A-Za-z][A-Za-z0-9+.-]*:", path) else path


def _open(path: str) -> Any:
    """A Parquet file where only Python runs."""
    import pyarrow.parquet as pq
    from pyarrow import fs

    if (local := _local(path)) is not None:
        return pq.ParquetFile(local)
    store, inner = fs.FileSystem.from_uri(path)
    return pq.ParquetFile(inner, filesystem=store)


def footer(path: str, types: dict[str, str]) -> dict:
    """path, rows, names (of top-level columns), ids (have they field ids) and stats by name: values, nulls, least, most (text), nan.

    types: the catalog type of each column that statistics are wanted of.
    """
    with _open(path) as f:
        return described(f, path, types)


def described(f: Any, path: str, types: dict[str, str]) -> dict:
    """footer() of an open file."""
    meta, schema = f.metadata, f.schema_arrow
    names = schema.names
    ids = bool(names) and all((schema.field(i).metadata or {}).get(b"PARQUET:field_id") is not None for i in range(len(names)))
    stats: dict[str, list] = {}
    at = {meta.schema.column(i).path: i for i in range(meta.num_columns)} if meta.num_columns else {}
    for name, kind in types.items():
        if name not in at:
            continue
        t, values, nulls, low, high, known = parse_type(kind), 0, 0, None, None, True
        for g in range(meta.num_row_groups):
            s = meta.row_group(g).column(at[name]).statistics
            rows = meta.row_group(g).num_rows
            if s is None or not s.has_null_count:
                values = nulls = None
                known = False
                break
            values, nulls = values + rows - s.null_count, nulls + s.null_count
            if rows == s.null_count:
                continue
            if not s.has_min_max or any(isinstance(x, float) and math.isnan(x) for x in (s.min, s.max)):
                known = False
                continue
            low = s.min if low is None or s.min < low else low
            high = s.max if high is None or s.max > high else high
        real = isinstance(t, (T.FloatType, T.DoubleType))
        stats[name] = [values, nulls, encode(low, t) if known else None, encode(high, t) if known else None, real and not known]
    return {"path": path, "rows": meta.num_rows, "names": names, "ids": ids, "stats": stats}


def footers(spark: SparkSession, paths: list[str], types: dict[str, str], local: int = 256) -> list[dict]:
    """footer() of each path: by threads of the driver, or by tasks if there are many. Files that are not local are read through Hadoop, by the driver."""
    if any(_local(p) is None for p in paths):
        import pyarrow.parquet as pq

        def remote(path: str) -> dict:
            source = _Remote(spark, path)
            try:
                return described(pq.ParquetFile(source, pre_buffer=False), path, types)
            finally:
                source.close()

        with ThreadPoolExecutor(16) as pool:
            return list(pool.map(remote, paths))
    if len(paths) <= local:
        with ThreadPoolExecutor(min(16, max(1, os.cpu_count() or 1))) as pool:
            return list(pool.map(lambda p: footer(p, types), paths))
    import json

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"i": b["i"], "f": [json.dumps(footer(p, types)) for p in b["p"]]})

    frame = spark.createDataFrame(list(enumerate(paths)), "i long, p string").repartition(max(1, len(paths) // 64))
    got = {r["i"]: json.loads(r["f"]) for r in frame.mapInPandas(read, "i long, f string").collect()}
    return [got[i] for i in range(len(paths))]
