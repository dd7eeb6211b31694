"""Helpers shared by the text operators."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from selvatrace.session import scratch_path

#: Bytes of text that one numpy pass handles at once, so that its arrays stay small.
SLAB_BYTES = 1 << 18
#: Rows and bytes that go to Python at once, about.
BATCH_ROWS, BATCH_BYTES = 256, 4 << 20


def pick(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, matched exactly, so that other columns cannot clash with them."""
    have = df.columns
    bare = df.toDF(*[f"c{i}" for i in range(len(have))])
    return bare.select(*[F.col(f"c{have.index(n)}").alias(n) for n in names])


#: Tables written within each open ``workspace``.
_WORKSPACES: list[list[str]] = []


@contextmanager
def workspace(spark: SparkSession) -> Iterator[None]:
    """Tables written within it go when it ends, but for those that are to last. What is made of the others must have been
    written by then."""
    _WORKSPACES.append([])
    try:
        yield
    finally:
        for path in _WORKSPACES.pop():
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def written(df: DataFrame, name: str, compression: str = "zstd", lasting: bool = False) -> DataFrame:
    """``df`` as a table in the shared folder: computed once, and safe from lost executors."""
    path = scratch_path(df.sparkSession, name)
    if _WORKSPACES and not lasting:
        _WORKSPACES[-1].append(path)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucket(key: Column, parts: int) -> Column:
    """CRC32 of the key's text, modulo ``parts``; 0 for a null key."""
    return F.coalesce(F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(parts)), F.lit(0))


def about(df: DataFrame, key: str, rows: int, most: int) -> DataFrame:
    """Around ``most`` of the ``rows`` rows of ``df``, chosen by a hash of the key."""
    if rows <= most:
        return df
    return df.filter(F.pmod(F.xxhash64(F.lit(7), key), F.lit(1 << 20)) < int((1 << 20) * most / rows))


def slabs(texts: list[bytes] | list[str], most: int = SLAB_BYTES) -> Iterator[tuple[int, int]]:
    """Index ranges over ``texts``, each of about ``most`` bytes or characters and at least one text."""
    start = size = 0
    for i, text in enumerate(texts):
        if i > start and size + len(text) > most:
            yield start, i
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield start, len(texts)


def small_batches(spark: SparkSession, most: int = BATCH_ROWS) -> None:
    """From now on at most ``most`` rows and about ``BATCH_BYTES`` go to Python at once: texts are long, and two or three copies
    of a batch are held on either side. Lower settings stay, but for the one that this sets by default."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= most or int(spark.conf.get(name)) == BATCH_ROWS:
        spark.conf.set(name, str(most))
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(name)) > BATCH_BYTES:
        spark.conf.set(name, str(BATCH_BYTES))


def give_back() -> None:
    """Memory that Arrow and the C library keep for later goes back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc only
    if trim:
        trim(0)


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` for ``mapInArrow``, with ``give_back`` at its end: a worker outlives its task, and would hold the most that any task
    took beside the JVM's heap while other stages run."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return task


def small(batches: Iterator[pa.RecordBatch], most: int = 512) -> Iterator[pa.RecordBatch]:
    """The batches in slices of ``most`` rows, so that what is made of one stays small."""
    for b in batches:
        for at in range(0, b.num_rows, most):
            yield b.slice(at, most)


def mixed(x: np.ndarray) -> np.ndarray:
    """A well mixed 64-bit hash of each 64-bit number."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1.0, rounds: int = 30) -> np.ndarray:
    """Weights of a logistic regression by Newton steps; the last weight is the constant."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    ridge = np.full(x.shape[1], penalty)
    ridge[-1] = 1e-3
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(ridge), x.T @ (p - y) + ridge * w)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return w
