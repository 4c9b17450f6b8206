"""Shared pieces: stage tables, Arrow batching, vectorised word and byte hashing."""

from __future__ import annotations

import atexit
import ctypes
import gc
import inspect
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of an Arrow batch that goes to a worker, about: Spark's own 64 MB stand in the JVM and in the worker at once, for each task.
BATCH_BYTES = 8 << 20
_BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Bytes of text that a numpy kernel handles at once; bounds a worker's memory.
CHUNK_BYTES = 1 << 20
_WS = np.zeros(256, bool)
_WS[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_MULT = 0x9E3779B97F4A7C15 | 1
_own_dir: str | None = None


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir. Where it is unset, a temporary one in local mode, where driver and executors are one process; on a cluster that is an error."""
    global _own_dir
    path = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if path:
        return path
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    if _own_dir is None:
        folder = tempfile.mkdtemp(prefix="thermaquilt-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        _own_dir = "file://" + folder
    return _own_dir


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Arrow batches of at most about BATCH_BYTES for what is run inside, however large a row's lists are."""
    before = spark.conf.get(_BATCH_CONF)
    spark.conf.set(_BATCH_CONF, BATCH_BYTES)
    try:
        yield
    finally:
        spark.conf.set(_BATCH_CONF, before)


def stage_table(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet in the shared folder and read it again: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    with small_batches(spark):
        df.write.option("compression", "zstd").parquet(path)
    # Shuffle files of plans that nothing refers to any more go when the driver collects its garbage.
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    table = spark.read.schema(df.schema).parquet(path)
    table._stage_path = path
    return table


def release(*tables: DataFrame) -> None:
    """Delete stage tables that no table yet to be written reads."""
    for t in tables:
        jvm, path = t.sparkSession.sparkContext._jvm, getattr(t, "_stage_path", None)
        if path:
            at = jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(t.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def give_back() -> None:
    """Freed memory goes back to the system: a worker waits for its next task for up to a minute, while others run."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not glibc
        pass


def tidy(kernel: Callable) -> Callable:
    """kernel, for mapInArrow or applyInArrow of one or two tables, whose worker holds no freed memory once it is done."""
    if inspect.isgeneratorfunction(kernel):

        def over_batches(batches):  # noqa: ANN001, ANN202
            yield from kernel(batches)
            give_back()

        return over_batches

    def done(out: pa.Table) -> pa.Table:
        give_back()
        return out

    return (lambda left, right: done(kernel(left, right))) if len(inspect.signature(kernel).parameters) == 2 else lambda table: done(kernel(table))


def most_frequent(counts: DataFrame, key: str, most: int) -> list:
    """The rows (key, n) of the largest counts, at most `most`: all rows whose count is above a level read off a small histogram."""
    level = F.floor(F.log2(F.col("n")) * 16).cast("int")
    total, cut = 0, None
    for r in counts.groupBy(level.alias("level")).count().orderBy(F.desc("level")).collect():  # at most 1,024 levels
        total += r["count"]
        if total > most:
            break
        cut = r["level"]
    if cut is None:
        return []
    return counts.where(level >= cut).select(key, "n").toPandas()


def text_chunks(batches: Iterator[pa.RecordBatch], text: str, limit: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of the batches with at most about `limit` bytes of text (one long text may exceed it), nulls as empty."""
    for batch in batches:
        col = batch.column(batch.schema.get_field_index(text)).cast(pa.binary())
        begin, size = 0, 0
        sizes = pa.compute.fill_null(pa.compute.binary_length(col), 0).to_numpy(zero_copy_only=False)
        for i, n in enumerate(sizes):
            if size and size + n > limit:
                yield batch.slice(begin, i - begin), [x or b"" for x in col.slice(begin, i - begin).to_pylist()]
                begin, size = i, 0
            size += int(n)
        if begin < batch.num_rows:
            yield batch.slice(begin), [x or b"" for x in col.slice(begin).to_pylist()]


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalizer of a 64-bit hash, in place."""
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def _byte_codes() -> np.ndarray:
    return mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(_MULT)) | np.uint64(1)


_CODES = _byte_codes()
_powers: tuple[np.ndarray, np.ndarray] | None = None


def _pow_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2**64."""
    global _powers
    if _powers is None or len(_powers[0]) < n:
        size = max(n, CHUNK_BYTES + (1 << 17))
        inverse = pow(_MULT, -1, 1 << 64)
        tables = []
        for base in (_MULT, inverse):
            t = np.full(size, base, np.uint64)
            t[0] = 1
            tables.append(np.multiply.accumulate(t))
        _powers = tables[0], tables[1]
    return _powers


def prefix_hash(buf: np.ndarray) -> np.ndarray:
    """Prefix sums from which span_hash takes the hash of any span in constant time."""
    up, _ = _pow_tables(len(buf) + 1)
    out = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(_CODES[buf] * up[: len(buf)], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the bytes from start to end, equal for equal bytes wherever they stand."""
    _, down = _pow_tables(len(prefix))
    return mix64((prefix[end] - prefix[start]) * down[start])


def concat(texts: list[bytes], gap: bytes = b"\n") -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One buffer of all texts with a gap after each, and where each begins and ends."""
    sizes = np.fromiter((len(t) for t in texts), np.int64, len(texts))
    ends = np.cumsum(sizes + len(gap)) - len(gap)
    return np.frombuffer(gap.join(texts) + gap, np.uint8), ends - sizes, ends


def word_spans(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs without ASCII white space; buf ends in white space."""
    word = ~_WS[buf]
    edge = np.flatnonzero(np.diff(word, prepend=False))
    return edge[0::2], edge[1::2]


def gram_hash(word_hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of n consecutive words, by first word; shorter by n - 1 than the input."""
    size = len(word_hashes) - n + 1
    if size <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(size, np.uint64)
    for i in range(n):
        out *= np.uint64(0xD6E8FEB86659FD93)
        out += word_hashes[i : i + size]
    return mix64(out)


def window_minimum(order: np.ndarray, w: int) -> np.ndarray:
    """Position of the least of each w consecutive values, the leftmost on ties: one per window."""
    n = len(order)
    if n < w:
        return np.zeros(0, np.int64)
    packed = (order & np.uint64(0xFFFFFFFF00000000)) | np.arange(n, dtype=np.uint64)
    if w == 1:
        return np.arange(n)
    pad = -n % w
    full = np.concatenate([packed, np.full(pad, np.iinfo(np.uint64).max, np.uint64)]).reshape(-1, w)
    head = np.minimum.accumulate(full, axis=1).ravel()
    tail = np.minimum.accumulate(full[:, ::-1], axis=1)[:, ::-1].ravel()
    best = np.minimum(tail[: n - w + 1], head[w - 1 : n])
    return (best & np.uint64(0xFFFFFFFF)).astype(np.int64)
