"""Shared plumbing of the corpus operators."""

from __future__ import annotations

import ctypes
import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes of an Arrow batch between Spark and Python, so that long texts do not pile up; one longer text stands alone. A smaller
#: setting of the session stays.
BATCH_BYTES = 4 << 20

#: Bytes of a table that is broadcast after adding them up, and in how many parts a possibly hot key is dealt beyond.
BROADCAST_BYTES, SALTS = 16 << 20, 16

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Hand this package to the executors once per application, so that Python workers can import it anywhere, and bound the batches."""
    size = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(spark.conf.get(size).rstrip("bB")) > BATCH_BYTES:
        spark.conf.set(size, str(BATCH_BYTES))
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    top = os.path.dirname(root)
    out = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="hypercell-")), "hypercell_pkg.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for d, _, names in os.walk(root):
            for n in sorted(names):
                if n.endswith((".py", ".json")):
                    z.write(os.path.join(d, n), os.path.relpath(os.path.join(d, n), top))
    sc.addPyFile(out)
    _SHIPPED.add(sc.applicationId)


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
    """``run`` for ``mapInArrow``; when a task ends, its Python worker, which waits for others, gives freed memory back."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim is not None:
                trim(0)

    return task


def _shared(spark: SparkSession) -> str:
    """The folder ``spark.checkpoint.dir``; a folder of our own only where that is unset and all runs on one machine."""
    top = spark.conf.get("spark.checkpoint.dir", None)
    if top is None:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        top = tempfile.mkdtemp(prefix="hypercell-")
    return top.rstrip("/")


def durable(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in ``spark.checkpoint.dir``, which Spark removes with the table if it is told to
    (``spark.cleaner.referenceTracking.cleanCheckpoints``)."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(_shared(df.sparkSession))
    return df.checkpoint()


def _hadoop(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder's path under ``spark.checkpoint.dir``, which all machines share. It goes when the application ends."""
    path = f"{_shared(spark)}/{name}-{uuid.uuid4().hex}"
    fs, p = _hadoop(spark, path)
    fs.mkdirs(p)
    fs.deleteOnExit(p)
    return path


def discard(spark: SparkSession, path: str) -> None:
    """Delete a folder that nothing reads any more."""
    fs, p = _hadoop(spark, path)
    fs.delete(p, True)


def small(df: DataFrame) -> bool:
    """Whether a table, which a checkpoint is behind, has at most ``BROADCAST_BYTES``."""
    size = F.lit(32)
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            size += F.coalesce(F.octet_length(f.name), F.lit(0))
        elif isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType)):
            size += F.octet_length(F.to_json(F.struct(f.name)))
        else:
            size += 8
    return (df.agg(F.sum(size)).first()[0] or 0) <= BROADCAST_BYTES


def spread(left: DataFrame, right: DataFrame, on: list[str], *by: str, how: str = "inner") -> DataFrame:
    """A join whose left side may hold a key in a great share of its rows. ``right`` has each key once or a few times, and a checkpoint
    behind it: if it is small, it is broadcast; else its rows are repeated, and the left's rows of a key, dealt by the columns
    ``by``, meet one of them each."""
    if small(right):
        return left.join(F.broadcast(right), on, how)
    left = left.withColumn("salt", F.pmod(F.xxhash64(*by), F.lit(SALTS)))
    right = right.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    return left.join(right, [*on, "salt"], how).drop("salt")


def id_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id and the text, as ``id`` and ``text``; a null text counts as empty. Other columns cannot clash."""
    return df.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def chunks(batch: pa.RecordBatch, column: int | tuple[int, ...], size: int) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows whose ``column`` (or columns) hold about ``size`` bytes; a longer value stands alone."""
    n = batch.num_rows
    if not n:
        return
    lens = sum(np.asarray(pc.fill_null(pc.binary_length(batch.column(c)), 0), dtype=np.int64) for c in (column if isinstance(column, tuple) else (column,)))
    ends = np.cumsum(lens)
    at = 0
    while at < n:
        base = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, base + size, side="right")))
        yield batch.slice(at, to - at)
        at = to


def raw(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (from 0) and bytes of a string or binary array without nulls."""
    if pa.types.is_string(arr.type) or pa.types.is_binary(arr.type):
        kind = np.int32
    else:
        kind = np.int64
    bufs = arr.buffers()
    off = np.frombuffer(bufs[1], dtype=kind)[arr.offset : arr.offset + len(arr) + 1].astype(np.int64)
    data = np.frombuffer(bufs[2], dtype=np.uint8)[off[0] : off[-1]] if bufs[2] is not None else np.empty(0, np.uint8)
    return off - off[0], data


def ragged(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """The positions ``starts[i] .. starts[i]+lens[i]-1`` for every i, one after another."""
    total = int(lens.sum())
    if not total:
        return np.empty(0, np.int64)
    shift = np.repeat(starts - np.concatenate(([0], np.cumsum(lens)[:-1])), lens)
    return shift + np.arange(total)


def binary_array(data: np.ndarray, ends: np.ndarray) -> pa.Array:
    """A binary array of consecutive slices of ``data``; ``ends`` are byte offsets."""
    off = np.concatenate(([0], ends)).astype(np.int64)
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(off.tobytes()), pa.py_buffer(np.ascontiguousarray(data))]).cast(pa.binary())
