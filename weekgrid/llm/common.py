"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import functools
import sys
import types

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from weekgrid.session import scratch_path

CHUNK_BYTES = 1_000_000
_written: list[str] = []
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
READ = "spark.sql.parquet.columnarReaderBatchSize"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Writes a table to the shared folder and reads it back; Spark drops the
    shuffle files of the job that wrote it, so the disk holds one job's at a time."""
    conf = df.sparkSession.conf
    before = conf.get(CLEANUP, None)
    conf.set(CLEANUP, "true")
    path = scratch_path(df.sparkSession, name)
    try:
        df.write.mode("overwrite").parquet(path)
    finally:
        conf.unset(CLEANUP) if before is None else conf.set(CLEANUP, before)
    _written.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def tidy(operator):
    """Stores the operator's result and deletes the tables it wrote on the way."""

    @functools.wraps(operator)
    def run(*args, **options):
        mark = len(_written)
        result = stored(operator(*args, **options), operator.__name__)
        spark = result.sparkSession
        for path in _written[mark:-1]:
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
        del _written[mark:-1]
        return result

    return run


def in_batches(size: str, rows: int):
    """While the operator runs, a batch for Python ends at about ``size`` bytes (or a
    longer text), and Parquet is read ``rows`` rows at a time. By default these are 64
    MB and 4,096 rows, so long texts make arrays of many MB on both sides of the pipe."""

    def wrap(operator):
        @functools.wraps(operator)
        def run(docs, *args, **options):
            conf = docs.sparkSession.conf
            before = {k: conf.get(k, None) for k in (BATCH, READ)}
            conf.set(BATCH, size)
            conf.set(READ, rows)
            try:
                return operator(docs, *args, **options)
            finally:
                for k, v in before.items():
                    conf.unset(k) if v is None else conf.set(k, v)

        return run

    return wrap


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cached(key, make):
    """``make()``, kept for later tasks of this Python worker until another key is asked for.

    Code that travels by value has fresh globals in every task, so a loaded
    tokenizer is kept in a module of its own; only one, to bound the memory.
    """
    name = "_weekgrid_worker_cache"
    if name not in sys.modules:
        sys.modules[name] = types.ModuleType(name)
        sys.modules[name].items = {}
    items = sys.modules[name].items
    if key not in items:
        items.clear()
        items[key] = make()
    return items[key]


def slices_of(batches, size: int = CHUNK_BYTES):
    """Slices of the batches whose text column (the last) has about ``size`` bytes; a
    longer text comes alone. Yields (columns before it, texts as large binary)."""
    for batch in batches:
        texts = batch.column(batch.num_columns - 1).cast(pa.large_binary())
        lengths = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
        sizes = np.concatenate([[0], np.cumsum(lengths)])
        start = 0
        while start < batch.num_rows:
            stop = int(np.searchsorted(sizes, sizes[start] + size, side="right")) - 1
            stop = min(max(stop, start + 1), batch.num_rows)
            part = batch.slice(start, stop - start)
            yield [part.column(i) for i in range(part.num_columns - 1)], texts.slice(start, stop - start)
            start = stop
    # Workers live on after the task, and would keep what it has freed.
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def rows_of(batches, size: int = CHUNK_BYTES):
    """``slices_of`` with the texts as a list of bytes or None."""
    for columns, texts in slices_of(batches, size):
        yield columns, texts.to_pylist()
