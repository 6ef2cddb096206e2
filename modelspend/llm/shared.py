"""Helpers of the operators in this package: the shared folder, and texts as bytes.

Tables that several steps read, and every step of an iteration, are written as
Parquet below the folder that ``spark.checkpoint.dir`` names, so a lost executor
costs its running tasks only and plans stay short.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_DIR = "spark.checkpoint.dir"
#: ASCII white space, the only characters that end a word in the operators' contracts.
SPACES = r"[\x20\x09-\x0D]+"


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder; a temporary one only for local sessions that name none."""
    folder = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="modelspend-llm-"))
        folder = spark.sparkContext.getCheckpointDir()
    return folder.rstrip("/")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and return the stored table."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    stored.stage_path = path
    return stored


def discard(*stored: DataFrame) -> None:
    """Delete tables that :func:`stage` returned, once nothing reads them any more."""
    for df in stored:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df.stage_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def read_table(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or the first of its like that no column of ``df`` has in any letter case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def row_key(*columns: str) -> Column:
    """A 64-bit key of a row's content; equal rows share it, null columns count."""
    return F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in columns])


def text_blocks(batches: Iterator[pa.RecordBatch], limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in slices of about ``limit`` bytes of text, null texts as empty.

    A text longer than the limit is a slice of its own; no text is cut.
    """
    for batch in batches:
        at = batch.schema.get_field_index("text")
        text = batch.column(at).fill_null("")
        batch = batch.set_column(at, "text", text)
        ends = offsets(text)
        row, last = 0, batch.num_rows
        while row < last:
            upto = int(np.searchsorted(ends, ends[row] + limit, side="right")) - 1
            upto = min(max(upto, row + 1), last)
            yield batch.slice(row, upto - row)
            row = upto


def offsets(text: pa.Array) -> np.ndarray:
    """Start of each text and the end of the last, in its data buffer."""
    kind = np.int64 if pa.types.is_large_string(text.type) else np.int32
    return np.frombuffer(text.buffers()[1], dtype=kind, count=len(text) + 1, offset=text.offset * kind().itemsize)


def joined_bytes(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts of an array as one run of UTF-8 bytes, and the bounds of each text in it."""
    bounds = offsets(text).astype(np.int64)
    data = text.buffers()[2]
    if data is None:
        return np.zeros(0, np.uint8), bounds - bounds[0]
    return np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]], bounds - bounds[0]


def texts(block: pa.RecordBatch) -> list[str]:
    return block.column(block.schema.get_field_index("text")).to_pylist()
