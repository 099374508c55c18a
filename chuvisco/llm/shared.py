"""What several operators need: working tables on shared storage and texts as flat byte arrays."""

from __future__ import annotations

import ctypes
import tempfile
from collections.abc import Iterator
from contextlib import suppress
from functools import cache
from uuid import uuid4

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that a task turns into arrays at once.
STEP = 1 << 20


def work_folder(spark: SparkSession) -> str:
    """A fresh path in the folder that ``spark.checkpoint.dir`` names; a local session without one gets its own."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = _local_folder()
    return f"{root.rstrip('/')}/llm-{uuid4().hex}"


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="shared-")


def stored(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again: lineage ends there, and a lost executor costs a
    file read. The files go when the session ends."""
    spark = df.sparkSession
    folder = work_folder(spark)
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


#: Rows that a join may send to all tasks (8 bytes each); more are joined by a shuffle.
SMALL = 1 << 20


def among(docs: DataFrame, wanted: DataFrame, on: str, how: str = "left_semi") -> DataFrame:
    """``docs`` whose ``on`` is among (``left_semi``) or not among (``left_anti``) the distinct values in ``wanted``,
    which is stored: sent to all tasks if they are few enough, so that ``docs`` stay where they are, else shuffled."""
    return docs.join(F.broadcast(wanted) if wanted.count() <= SMALL else wanted, on, how)


def texts_of(docs: DataFrame, key: str, text: str, *others: str) -> DataFrame:
    """Key and text under names of our own, so that other columns cannot clash with what an operator adds."""
    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"), *others)


def numbered_columns(docs: DataFrame) -> DataFrame:
    """``docs`` with its columns as ``c0``, ``c1`` and so on, whatever they are called, so that none clashes with our own."""
    return docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the place where each value starts (and the last ends); null is empty."""
    array = pc.fill_null(column.cast(pa.large_binary()), b"")
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    starts = np.frombuffer(array.buffers()[1], np.int64)[array.offset : array.offset + len(array) + 1]
    held = array.buffers()[2]
    data = np.frombuffer(held, np.uint8) if held is not None else np.zeros(0, np.uint8)
    return data[starts[0] : starts[-1]], starts - starts[0]


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = STEP) -> Iterator[pa.RecordBatch]:
    """The batches, cut where ``limit`` bytes of text come together; a longer text stays whole. After the last one the
    worker gives unused memory back, as it may wait long for its next task."""
    yield from _cut(batches, column, limit)
    with suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    pa.default_memory_pool().release_unused()


def _cut(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends, begin = np.cumsum(sizes, dtype=np.int64), 0
        while begin < batch.num_rows:
            before = ends[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(ends, before + limit, "right")))
            yield batch.slice(begin, end - begin)
            begin = end


def strings(data: np.ndarray, starts: np.ndarray) -> pa.Array:
    """Values that lie one after another in ``data``, as an Arrow array."""
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(starts) - 1, [None, pa.py_buffer(starts.astype(np.int64)), pa.py_buffer(data)]
    )


@cache
def _powers(base: int, exponent: int) -> tuple[np.ndarray, np.ndarray]:
    both = []
    for factor in (base, pow(base, -1, 1 << 64)):
        held = np.full(1 << exponent, factor, np.uint64)
        held[0] = 1
        both.append(np.cumprod(held))
    return tuple(both)


def stretch_hashes(data: np.ndarray, base: int):
    """A function that gives the polynomial hash, modulo 2**64, of any stretches of ``data``, wherever they stand."""
    up, down = _powers(base, max(20, (len(data) + 1).bit_length()))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    return lambda start, end: (sums[end] - sums[start]) * down[start]


def table(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)
