"""Helpers of the training-data operators: scratch tables, bounds, Arrow texts.

Written tables go to the folder that ``spark.checkpoint.dir`` names, which
driver and executors share.  Only a local session without that setting gets a
temporary folder of its own (tests).
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

KEY = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The folder for written tables; raises on a cluster that names none."""
    sc = spark.sparkContext
    path = sc.getConf().get(KEY, None) or sc.getCheckpointDir()
    if not path:
        if not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError(f"set {KEY} to a folder that all executors share")
        sc.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="returnscope-"))
        path = sc.getCheckpointDir()
    return path.rstrip("/")


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of 1,000 rows in this session, so that one of documents is some megabytes."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back.

    Cuts the lineage: a lost executor loses none of it, and every later reader
    sees the same rows.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/returnscope-llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch_path = path
    return out


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column of ``df`` has it (in any case of letters)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def discard(*tables: DataFrame) -> None:
    """Deletes tables made by ``written`` that nothing will read any more."""
    for df in tables:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df._scratch_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def text_buffers(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and row offsets (one more than rows) of a text column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    if column.null_count:
        column = pc.fill_null(column, "")
    _, offsets, data = column.buffers()
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(offsets, np.int64, n + 1, column.offset * 8)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[off[0] : off[-1]], off - off[0]


def slices(batches: Iterator[pa.RecordBatch], column: str, max_bytes: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The batches in slices of about ``max_bytes`` of text (one row at least)."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        at, ends = 0, np.cumsum(sizes, dtype=np.int64)
        while at < batch.num_rows:
            done = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, done + max_bytes, "right")))
            yield batch.slice(at, to - at)
            at = to


def strings(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """A text column from UTF-8 bytes and offsets."""
    return pa.LargeStringArray.from_buffers(
        len(offsets) - 1, pa.py_buffer(offsets.astype(np.int64).tobytes()), pa.py_buffer(data.tobytes())
    ).cast(pa.string())
