"""Streaming ingest: new Markdown files of a directory become chunks, each batch by the same plan as in batch mode."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from docloom.operators import chunking


def stream_chunks(spark: SparkSession, source: str, target: str, checkpoint: str, target_tokens: int = 1200, max_tokens: int = 1800) -> StreamingQuery:
    """Chunks files as they arrive and appends them to a Parquet table. Files are whole documents, so batches are independent; a batch
    that runs again after a failure replaces its own part of the table."""
    files = spark.readStream.format("text").option("wholetext", True).load(source).select("value", F.col("_metadata.file_path").alias("path"))

    def add(batch: DataFrame, number: int) -> None:
        name = F.regexp_replace(F.element_at(F.split("path", "/"), -1), r"(?<=.)\.[^.]*$", "")
        docs = batch.select(F.xxhash64("path").alias("doc_id"), F.replace(name, F.lit("_"), F.lit(" ")).alias("doc_title"), F.col("value").alias("md"))
        chunking.chunk_documents(docs, target_tokens, max_tokens).write.mode("overwrite").parquet(f"{target}/batch={number}")

    return files.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
