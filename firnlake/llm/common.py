"""Helpers that the operators share: the shared folder, materialised tables, words and hashes."""

from __future__ import annotations

import re
import tempfile
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.paths import remove
from ..sources.ship import ship

#: What separates words: space and U+0009 to U+000D, in Java's regular expressions and in DuckDB's.
WORD_RE = r"[^\x20\x09-\x0D]+"
SPACE_RE = r"[\x20\x09-\x0D]"


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, which driver and executors share; a new one of our own if it is unset in a session that is one process."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not path:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = "file://" + tempfile.mkdtemp(prefix="firnlake-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def scratch_path(spark: SparkSession, what: str) -> str:
    """A new table's path in this application's scratch folder."""
    return f"{shared_dir(spark)}/firnlake-{spark.sparkContext.applicationId}/{what}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete all tables that operators of this application wrote to the shared folder. Results that were not written elsewhere go with them."""
    remove(spark, f"{shared_dir(spark)}/firnlake-{spark.sparkContext.applicationId}")


def discard(*tables: DataFrame) -> None:
    """Delete materialised tables that nothing will read again: what was made of them is materialised."""
    for t in tables:
        remove(t.sparkSession, t.scratch)


#: What a tidy write sets for itself: its shuffles' files are deleted after it, and Python workers get few rows at a time.
TIDY = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.execution.arrow.maxRecordsPerBatch": "1000"}


def materialize(df: DataFrame, what: str, tidy: bool = False) -> DataFrame:
    """Write df to the shared folder and read it again: cuts the lineage and survives lost executors. tidy: less is held, see TIDY."""
    ship(df.sparkSession)
    path, conf = scratch_path(df.sparkSession, what), df.sparkSession.conf
    before = {k: conf.get(k, None) for k in TIDY if tidy}
    try:
        for k in before:
            conf.set(k, TIDY[k])
        df.write.option("compression", "zstd").parquet(path)
    finally:
        for k, v in before.items():
            conf.unset(k) if v is None else conf.set(k, v)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.scratch = path
    return out


def small(df: DataFrame, rows: int = 2_000_000) -> DataFrame:
    """df, marked for broadcast if it has at most so many (narrow) rows; any larger one is joined by a shuffle. Counts df: give a materialised one."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


#: What empties the caches that a worker's tasks leave for later ones.
CACHES: list = []


def release() -> None:
    """Empty a Python worker's caches and give freed memory back to the system, where the C library can; workers stay for other operators' tasks."""
    import ctypes

    import pyarrow as pa

    for clear in CACHES:
        clear()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError, TypeError):
        pass


def shrink(spark: SparkSession) -> None:
    """Have every executor's JVM collect its garbage and give back the heap that earlier steps made it grow by, before steps whose Python workers need the room."""
    tasks = spark.sparkContext.defaultParallelism  # all cores at once, hence all executors
    spark.range(0, tasks, 1, tasks).select(F.expr("java_method('java.lang.System', 'gc')").alias("gc")).write.format("noop").mode("overwrite").save()


def shielded(docs: DataFrame, used: tuple[str, ...]) -> tuple[DataFrame, dict[str, str]]:
    """docs with every column but the used ones renamed out of the way, and the names to give back by restored()."""
    names = {c: c if c in used else f"_own_{i}" for i, c in enumerate(docs.columns)}
    return docs.toDF(*names.values()), {v: k for k, v in names.items()}


def restored(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.select(*(F.col(v).alias(k) for v, k in names.items()))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: Column, modulus: int) -> Column:
    """crc32(doc_id as text) mod modulus; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(modulus)


def fold_of(doc_id: int | None, modulus: int) -> int | None:
    return None if doc_id is None else zlib.crc32(str(doc_id).encode()) % modulus


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser over unsigned 64-bit integers (the public splitmix64 one)."""
    x = x.astype(np.uint64, copy=True)
    with np.errstate(over="ignore"):
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return x


#: Bytes of texts that are hashed at once, and the longest word that is hashed eight bytes at a time.
HASHED_BYTES, LONG_WORD = 1 << 22, 256
_IS_WORD = np.ones(256, dtype=bool)
_IS_WORD[[9, 10, 11, 12, 13, 32]] = False
_LOWEST = np.array([(1 << 8 * n) - 1 for n in range(8)] + [(1 << 64) - 1], dtype=np.uint64)


def _hash_bytes(data: bytes, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """64-bit hashes of the words of data (which ends with eight spare bytes) at starts."""
    import xxhash

    eights = np.ndarray(len(data) - 7, dtype="<u8", buffer=data, strides=(1,))
    h = mix64(lengths.astype(np.uint64) + (eights[starts] & _LOWEST[np.minimum(lengths, 8)]) * _ODD)
    more, at = np.flatnonzero(lengths > 8), 8
    while len(more):
        rest = lengths[more] - at
        h[more] = mix64((h[more] ^ (eights[starts[more] + at] & _LOWEST[np.minimum(rest, 8)])) * _ODD)
        more, at = more[rest > 8], at + 8
        if at >= LONG_WORD:
            for i in more.tolist():
                h[i] = xxhash.xxh3_64_intdigest(data[int(starts[i]) : int(starts[i] + lengths[i])])
            break
    return h


_ODD = np.uint64(0x9E3779B97F4A7C15)


def hashed(texts, lower: bool = True, shaped: bool = False) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """64-bit hashes of the words of an Arrow column of texts (null: none), for some rows at a time: (bounds, hashes), where row i of them has bounds[i] to bounds[i + 1].

    lower: with A-Z in lower case. shaped: the five lowest bits tell a word's length and last byte instead.
    """
    import pyarrow as pa

    texts = texts.cast(pa.large_string()).fill_null("") if len(texts) else texts
    at = 0
    while at < len(texts):
        offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset + at : texts.offset + len(texts) + 1]
        rows = max(1, int(np.searchsorted(offsets, offsets[0] + HASHED_BYTES, side="right")) - 1)
        offsets = offsets[: rows + 1]
        at += rows
        data = b"" if texts.buffers()[2] is None else texts.buffers()[2][int(offsets[0]) : int(offsets[-1])].to_pybytes()
        if lower:
            data = data.lower()
        data += bytes(8)
        edges = offsets - offsets[0]
        inner = _IS_WORD[np.frombuffer(data, dtype=np.uint8, count=len(data) - 8)]
        # a word begins where its run or its row begins, and ends likewise
        after = np.zeros(len(inner) + 1, dtype=bool)
        after[1:] = ~inner
        after[edges] = True
        starts = np.flatnonzero(inner & after[:-1])
        before = np.ones(len(inner) + 1, dtype=bool)
        before[:-1] = ~inner
        before[edges] = True
        ends = np.flatnonzero(inner & before[1:]) + 1
        h = _hash_bytes(data, starts, ends - starts)
        if shaped:
            last = np.frombuffer(data, dtype=np.uint8)[ends - 1]
            h = h & ~np.uint64(31) | (np.minimum(ends - starts, 15) // 4 * 8 + last % 8).astype(np.uint64)
        yield np.searchsorted(starts, edges), h


def hashes_of(words: list[bytes], lower: bool = True, shaped: bool = False) -> np.ndarray:
    """The hashes of some words."""
    import pyarrow as pa

    return np.concatenate([np.empty(0, np.uint64), *(h for _, h in hashed(pa.array([b" ".join(words).decode()]), lower, shaped))])


def framed(bounds: np.ndarray, words: np.ndarray, start: np.uint64, starts: int, end: np.uint64) -> tuple[np.ndarray, np.ndarray]:
    """hashed()'s bounds and hashes with so many start marks before each row's words, and an end mark after them."""
    new = bounds + (starts + 1) * np.arange(len(bounds))
    out, own = np.empty(len(words) + (starts + 1) * (len(bounds) - 1), dtype=np.uint64), np.ones(len(words) + (starts + 1) * (len(bounds) - 1), dtype=bool)
    for i in range(starts):
        out[new[:-1] + i], own[new[:-1] + i] = start, False
    out[new[1:] - 1], own[new[1:] - 1] = end, False
    out[own] = words
    return new, out
