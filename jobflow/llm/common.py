"""Helpers shared by the operators: Arrow text views, folds, shared-folder tables."""

from __future__ import annotations

import math
import os
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobflow.session import scratch_path

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def importable(spark: SparkSession) -> None:
    """Let Python workers on this machine import the package from where the driver has it, whatever their folder."""
    root = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: Column, mod: int) -> Column:
    """crc32 of the id written as text, modulo ``mod``; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % mod


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh folder under spark.checkpoint.dir and read it back.

    This cuts the lineage (a lost executor re-reads files instead of re-running
    the steps before) and lets Spark delete the write's own shuffle files.
    """
    return stored(df, name)[0]


def stored(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``materialize`` that also tells the folder, so that it can be removed once its rows are replaced."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    old = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        if old is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, old)
    return spark.read.schema(df.schema).parquet(path), path


BUCKET_BYTES = 64 << 20


def bucket_bits(spark: SparkSession, size: int, least: int = 8) -> int:
    """log2 of the number of buckets for ``size`` bytes of packed names: 2**least at least, one for each shuffle partition at least, and as many as
    keep a bucket, which is one group in one task, at ``BUCKET_BYTES`` or less.

    A packed row stands for one task batch and one bucket, so more buckets mean more and smaller rows.
    """
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(least, math.ceil(math.log2(max(1, parts))), math.ceil(math.log2(max(1, size / BUCKET_BYTES))))


def even_keys(spark: SparkSession, bits: int) -> np.ndarray:
    """A grouping key for each of 2**bits buckets, such that the shuffle's hash deals the buckets evenly to its partitions.

    Hashing the bucket numbers themselves would give some partitions several times the mean.
    """
    parts, n = int(spark.conf.get("spark.sql.shuffle.partitions")), 1 << bits
    want = np.bincount((np.arange(n) * parts) >> bits, minlength=parts)
    tried = 2 * n + 64 * parts
    while True:
        to = spark.range(tried).select(F.pmod(F.hash(F.col("id").cast("int")), F.lit(parts)).alias("to")).toPandas()["to"].to_numpy()
        if (np.bincount(to, minlength=parts) >= want).all():
            break
        tried *= 2
    order = np.argsort(to, kind="stable")  # the first keys of each partition, partitions in the order of their buckets
    first = np.searchsorted(to[order], np.arange(parts))
    return np.concatenate([order[f:f + k] for f, k in zip(first, want, strict=True)]).astype(np.int32)


def utf8_view(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text or binary column (nulls: empty) and the n+1 row offsets."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = column.buffers()
    off = np.frombuffer(off, np.int64)[column.offset: column.offset + len(column) + 1]
    data = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return data[off[0]: off[-1]], off - off[0]


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that each holds about ``most`` bytes of ``column`` (one row at least)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, off = utf8_view(batch.column(column))
        at = 0
        while at < batch.num_rows:
            end = int(np.searchsorted(off, off[at] + most, side="right")) - 1
            end = min(max(end, at + 1), batch.num_rows)
            yield batch.slice(at, end - at)
            at = end


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, so that all bits of a name depend on all bits of ``x``."""
    x = x ^ (x >> np.uint64(32))  # an array of its own from here on
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


class WindowNames:
    """64-bit names of fixed-length byte windows, from one prefix sum over the bytes."""

    BASE = 0x9E3779B97F4A7C15
    CODES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F)) | np.uint64(1)
    powers = inverses = np.ones(1, np.uint64)

    def __init__(self, data: np.ndarray):
        n, own = len(data), type(self)
        if len(own.powers) < n + 1:
            size = n + n // 4 + 1
            own.powers = self._powers(self.BASE, size)
            own.inverses = self._powers(pow(self.BASE, -1, 1 << 64), size)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(self.CODES[data] * self.powers[:n], out=self.sums[1:])

    @staticmethod
    def _powers(base: int, n: int) -> np.ndarray:
        out = np.full(n, base, np.uint64)
        out[0] = 1
        return np.cumprod(out, dtype=np.uint64)

    def at(self, pos: np.ndarray, length: int) -> np.ndarray:
        return mix((self.sums[pos + length] - self.sums[pos]) * self.inverses[pos])


def table_of(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns.values()],
                                      names=list(columns))
