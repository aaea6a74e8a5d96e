"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table, read through Spark's reader so that any file system it knows will do."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_and_text(docs: DataFrame) -> DataFrame:
    """(doc_id, text) with null texts as empty; every other column, whatever its name, is left behind."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, which all executors and the driver share. Where none is set, a temporary one will do for
    a session on one machine, such as those of tests; on a cluster that is an error."""
    context = spark.sparkContext
    named = context.getConf().get("spark.checkpoint.dir")
    if named:
        return named
    held = context.getCheckpointDir()
    if held is None:
        if not context.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="docloom-checkpoint-"))
        held = context.getCheckpointDir()
    return held


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage with a checkpoint in the shared folder. The shuffle files that led to the checkpoint go at once, not when the
    driver happens to collect its garbage."""
    spark, name = df.sparkSession, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    folder = shared_folder(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        return df.select("*").checkpoint(eager=True)  # a new frame, as a frame holds to what was set when it was made
    finally:
        spark.conf.set(name, before)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def pieces(batches: Iterator[pa.RecordBatch], column: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Slice record batches so that the text of each slice is about `most` bytes (a longer text stands alone)."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        ends = ends_of(batch.column(column))
        start = 0
        while start < batch.num_rows:
            stop = int(np.searchsorted(ends, ends[start] + most, side="right")) - 1
            stop = min(max(stop, start + 1), batch.num_rows)
            yield batch.slice(start, stop - start)
            start = stop


def ends_of(column: pa.Array) -> np.ndarray:
    """The n + 1 byte offsets of a string column, relative to its data buffer."""
    width, kind = (8, np.int64) if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else (4, np.int32)
    raw = column.buffers()[1]
    if raw is None:
        return np.zeros(len(column) + 1, dtype=np.int64)
    return np.frombuffer(raw, dtype=kind, count=len(column) + 1, offset=column.offset * width).astype(np.int64)


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column without nulls, and the n + 1 offsets into them."""
    ends = ends_of(column)
    data = column.buffers()[2]
    flat = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return flat[ends[0] : ends[-1]], ends - ends[0]


def mixed(x: np.ndarray, seed: int) -> np.ndarray:
    """A bijection of 64-bit integers, by multiplications and shifts, that spreads its input."""
    x = x + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xA0761D6478BD642F)
    return x ^ (x >> np.uint64(32))
