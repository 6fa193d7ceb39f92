"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from furrow.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def wrap(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return wrap


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id's text modulo ``parts``; a null id falls in part 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts, F.lit(0)).cast("int")


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def kept(df: DataFrame, name: str, **options) -> DataFrame:
    """Write what several jobs read to the shared folder and read it from there; the shuffle files of the write go at its end."""
    spark = df.sparkSession
    path, before = scratch_path(spark, name), spark.conf.get(CLEANUP, None)
    writer = df.write
    for k, v in options.items():
        writer = writer.option(k, v)
    spark.conf.set(CLEANUP, "true")
    try:
        writer.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def forget(*frames: DataFrame) -> None:
    """Remove the files of frames that ``kept`` returned, once nothing reads them any more."""
    for df in frames:
        jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
        for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(folder))
            path.getFileSystem(conf).delete(path, True)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def in_order(df: DataFrame, order: list[Column], name: str, n: int | None = None) -> DataFrame:
    """Rows range-sorted over ``n`` partitions with the partition number in ``_part``, stored so that it stays."""
    n = n or partitions(df.sparkSession)
    ranged = df.repartitionByRange(n, *order).withColumn("_part", F.spark_partition_id())
    return kept(ranged, name)


_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc


def release() -> None:
    """Hand memory that Arrow and the C library keep for later use back to the system; Python workers are reused."""
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values (the public splitmix finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BASE = 0x9E3779B97F4A7C17
_MOST_POWERS = 1 << 20
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}
_BYTE_VALUES = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base^i and base^-i modulo 2^64."""
    have = _POWERS.get(0)
    if have is None or len(have[0]) < n:
        size = 1 << max(16, (n - 1).bit_length())
        up = np.full(size, _BASE, dtype=np.uint64)
        down = np.full(size, pow(_BASE, -1, 1 << 64), dtype=np.uint64)
        up[0] = down[0] = 1
        have = np.multiply.accumulate(up), np.multiply.accumulate(down)
        if size <= _MOST_POWERS:  # a reused worker does not keep those of a long text
            _POWERS[0] = have
    return have


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the spans of a byte array; equal bytes have equal hashes wherever they stand."""
    up, down = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTE_VALUES[data] * up[: len(data)], out=sums[1:])
    return mix64((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


_SPACES = np.zeros(256, dtype=bool)
_SPACES[[0x20, *range(0x09, 0x0E)]] = True
CHUNK = 1 << 20


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, A-Z in lower case, and where each text's words begin (one entry more at the end)."""
    hashes, first, n, at = [], [0], 0, 0
    while at < len(texts):
        parts, size = [], 0
        while at < len(texts) and (not parts or size < CHUNK):
            parts.append(texts[at].encode().lower())
            size += len(parts[-1]) + 1
            at += 1
        data = np.frombuffer(b"\n".join([b"", *parts, b""]), dtype=np.uint8)
        space = _SPACES[data]
        edges = np.flatnonzero(space[1:] != space[:-1]) + 1
        starts, ends = edges[::2], edges[1::2]
        hashes.append(span_hashes(data, starts, ends))
        bounds = np.cumsum([len(p) + 1 for p in parts])
        first += (n + np.searchsorted(starts, bounds)).tolist()
        n += len(starts)
    return np.concatenate(hashes) if hashes else np.empty(0, dtype=np.uint64), np.array(first, dtype=np.int64)


def window_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all windows of ``n`` consecutive word hashes."""
    if len(h) < n:
        return np.empty(0, dtype=np.uint64)
    out = np.zeros(len(h) - n + 1, dtype=np.uint64)
    for k in range(n):
        out = mix64(out * np.uint64(0x9E3779B97F4A7C15) + h[k : len(h) - n + 1 + k] + np.uint64(k + 1))
    return out
