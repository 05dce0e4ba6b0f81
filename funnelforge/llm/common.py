"""Helpers shared by the operators: words, stable hashes, scratch tables, bounds.

Words are cut on UTF-8 bytes: every byte of a multi-byte character is at least
0x80, so byte classes and code point classes agree.
"""

from __future__ import annotations

import ctypes
import gc
import pickle
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_LOWER = {c: c + 32 for c in range(0x41, 0x5B)}
#: A-Z lower-cased; every ASCII byte that is no letter or digit becomes a space.
ALNUM = bytes(
    _LOWER.get(b, b) if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256))
#: A-Z lower-cased, nothing else changed.
LOWER = bytes(_LOWER.get(b, b) for b in range(256))


def alnum_words(text: bytes) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the lower-cased text."""
    return text.translate(ALNUM).split()


def space_words(text: bytes) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of the lower-cased text."""
    return text.translate(LOWER).split()


def byte_texts(column: pa.Array) -> Iterator[bytes]:
    """The UTF-8 bytes of a string column, a few rows at a time; null is empty."""
    pa.default_memory_pool().release_unused()  # what earlier batches took
    whole = column.cast(pa.large_binary())
    for at in range(0, len(whole), 256):
        for x in whole.slice(at, 256).to_pylist():
            yield x or b""


def fold(id_col: str, modulus: int) -> F.Column:
    """crc32 of the id as text, modulo ``modulus``: which rows may teach labels."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % modulus


#: Rows sent to a Python worker at once: whole texts are long, and the usual
#: 10,000 of them are held several times over on their way.
BATCH_ROWS = 1_000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back (cuts lineage)."""
    from funnelforge.session import scratch_path  # here, as tasks get this module without the package

    spark = df.sparkSession
    path = scratch_path(spark, name)
    own = spark.conf.get(_BATCH)
    spark.conf.set(_BATCH, str(BATCH_ROWS))
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_BATCH, own)  # the caller's session stays as it was
    return spark.read.schema(df.schema).parquet(path)


def frugal(run):
    """``run`` for mapInArrow, after which the worker gives the memory it took back:
    workers are used again by later stages and keep what the allocators hold.  Arrow's
    own allocator keeps more than the system's, so that one is used."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pa.set_memory_pool(pa.system_memory_pool())
        try:
            yield from run(batches)
        finally:
            _trim()

    return task


def _trim() -> None:
    """Return what this Python process has freed."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        ctypes.CDLL(None).malloc_trim(0)


def give_back(spark: SparkSession) -> None:
    """Have executors and driver give unused memory back: a JVM keeps what its heap once
    grew to, beside the Python workers of the next stage, until a full collection shrinks
    it; the driver also lets go of plans, broadcasts and tables that nothing names."""
    n = spark.sparkContext.defaultParallelism
    collected = spark.range(0, n, 1, n).select(F.expr("java_method('java.lang.System', 'gc')"))
    collected.write.format("noop").mode("overwrite").save()
    _trim()
    spark.sparkContext._jvm.java.lang.System.gc()


class Sent:
    """A broadcast object of this package.  Its bytes are sent, so executors need not
    have the package; ``value`` makes the object anew: ask once a task."""

    def __init__(self, spark: SparkSession, value):
        self.data = spark.sparkContext.broadcast(cloudpickle.dumps(value))

    @property
    def value(self):
        return pickle.loads(self.data.value)


def broadcast_checked(spark: SparkSession, value, n_bytes: int, limit: int, what: str) -> Sent:
    """Broadcast ``value`` after checking its measured size against ``limit``."""
    if n_bytes > limit:
        raise ValueError(f"{what}: {n_bytes} bytes exceed the broadcast bound of {limit}")
    return Sent(spark, value)


#: Ids up to this many (under 64 MB as a hash table) are sent to all tasks.
SMALL_IDS = 500_000


def row_key(id_col: str = "doc_id", text_hash: F.Column | None = None) -> F.Column:
    """Tells rows of equal or no id apart by their texts' hash."""
    return F.xxhash64(F.col(id_col).cast("long"), F.xxhash64("text") if text_hash is None else text_hash)


def without(documents: DataFrame, gone: DataFrame) -> DataFrame:
    """The rows whose ``row_key`` is not among ``gone``'s; columns as they were.  Few
    keys are broadcast after counting them, more are joined by a shuffle."""
    keys = stored(gone.select(F.col("row_key").alias("gone_key")).distinct(), "gone-rows")
    side = F.broadcast(keys) if keys.count() <= SMALL_IDS else keys
    return documents.join(side, row_key() == side["gone_key"], "left_anti")
