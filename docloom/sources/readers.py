"""Sources: Markdown files, chunk directories, pages, manifests, optional Parquet tables, and the knowledge base directory."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom import schemas
from docloom.functions import text as T
from docloom.operators import markdown
from docloom.operators.adjacency import open_adjacency

CHUNK_SUFFIXES = [".md", ".markdown", ".txt", ".text", ""]


def markdown_files(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, doc_title, md) of Markdown files; the title is the file's name, or "Specification"."""
    rows = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("md"))
    stem = F.trim(F.replace(F.regexp_replace(F.url_decode(F.element_at(F.split("path", "/"), -1)), r"(?<=.)\.[^.]*$", ""), F.lit("_"), F.lit(" ")))
    return rows.select(F.xxhash64("path").alias("doc_id"), F.coalesce(F.nullif(stem, F.lit("")), F.lit("Specification")).alias("doc_title"), "md")


def chunk_directory(spark: SparkSession, path: str, collection_id: int = 0) -> DataFrame:
    """(collection_id, path, content) of the text files below a directory; bytes that are not UTF-8 become replacement characters.
    A path that is not a directory is an error."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not system.exists(hadoop) or not system.getFileStatus(hadoop).isDirectory():
        raise NotADirectoryError(f"no directory of chunks at {path}")
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    name = F.element_at(F.split("path", "/"), -1)
    suffix = F.lower(F.regexp_extract(name, r"(?<=.)(\.[^.]*)$", 1))
    return rows.where(suffix.isin(CHUNK_SUFFIXES)).select(F.lit(collection_id).cast("long").alias("collection_id"), F.url_decode("path").alias("path"), F.make_valid_utf8(F.col("content").cast("string")).alias("content"))


def converted(rows: DataFrame, convert: Callable[[bytes], str] | None = None) -> DataFrame:
    """(doc_id, doc_title, md) from binary files (path, content) by a converter of one file, such as one for PDF, that a user brings."""
    if convert is None:
        raise ValueError("a converter from bytes to Markdown is needed; none for PDF comes with this library")
    given = rows.select(F.xxhash64("path").alias("doc_id"), F.element_at(F.split("path", "/"), -1).alias("doc_title"), "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            md = [convert(raw or b"") for raw in batch.column("content").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("doc_title"), pa.array(md, pa.string())], ["doc_id", "doc_title", "md"])

    return given.mapInArrow(run, "doc_id long, doc_title string, md string")


def pages(rows: DataFrame) -> DataFrame:
    """(doc_id, doc_title, md) of web pages (page_id, url, html)."""
    return rows.select(F.col("page_id").alias("doc_id"), F.coalesce("url", F.lit("Specification")).alias("doc_title"), markdown.html_to_markdown(F.coalesce("html", F.lit(""))).alias("md"))


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """Chunk records from JSON lines; blank lines are skipped, a missing file is an error."""
    return spark.read.schema(schemas.CHUNK).json(path)


def by_prefix(chunks: DataFrame, chars: int = 80) -> DataFrame:
    """(prefix, chunk_id): the beginning of a chunk's text, white space collapsed; of several with one, the last chunk."""
    prefix = F.substring(T.collapse(F.col("text")), 1, chars)
    return chunks.select(prefix.alias("prefix"), "order", "chunk_id").where("prefix <> ''").groupBy("prefix").agg(F.max_by("chunk_id", "order").alias("chunk_id"))


def optional(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame | None:
    """A Parquet table; where there is none, an empty one of the schema, or None."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None if schema is None else spark.createDataFrame([], schema)


def column_of(rows: DataFrame, *candidates: str) -> str | None:
    """The first of the candidates that is a column."""
    return next((c for c in candidates if c in rows.columns), None)


def mapped_units(units: DataFrame, prefixes: DataFrame, known: DataFrame) -> DataFrame:
    """`units` (id, text, …) with chunk_id: by id in `known` (id, chunk_id), else by the beginning of the text."""
    found = units.withColumn("_prefix", F.substring(T.collapse(F.coalesce("text", F.lit(""))), 1, 80))
    found = found.join(known.select(F.col("id").cast("string").alias("_id"), F.col("chunk_id").alias("_by_id")), F.col("id").cast("string") == F.col("_id"), "left")
    found = found.join(prefixes.select(F.col("prefix").alias("_prefix"), F.col("chunk_id").alias("_by_text")), "_prefix", "left")
    return found.withColumn("chunk_id", F.coalesce("_by_id", "_by_text")).drop("_prefix", "_id", "_by_id", "_by_text")


def unit_ids(units: DataFrame) -> DataFrame:
    """(id, chunk_id) of text units: under their id and, where there is one, their readable id; the chunk is the first of
    document_ids, else document_id. Where both ids of different units agree, the greatest chunk id counts."""
    first = F.lit(None).cast("string")
    if "document_id" in units.columns:
        first = F.nullif(F.col("document_id").cast("string"), F.lit(""))
    if "document_ids" in units.columns:
        first = F.coalesce(F.get("document_ids", F.lit(0)).cast("string"), first)
    parts = [units.select(F.col(c).cast("string").alias("id"), first.alias("chunk_id")) for c in ("id", "human_readable_id") if c in units.columns]
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found.where("id is not null and chunk_id is not null").groupBy("id").agg(F.max("chunk_id").alias("chunk_id"))


class KnowledgeBase:
    """The tables of a knowledge base directory: entities and text units must be there, the others may."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.entities, self.text_units = (optional(spark, f"{path}/{t}.parquet") for t in ("entities", "text_units"))
        if self.entities is None or self.text_units is None:
            raise FileNotFoundError(f"{path} holds no knowledge base: entities or text_units are missing")
        self.communities, self.reports, self.relationships, self.claims = (optional(spark, f"{path}/{t}.parquet") for t in ("communities", "community_reports", "relationships", "covariates"))
        self.entity_units = optional(spark, f"{path}/entity_units.parquet")
        self.edges = optional(spark, f"{path}/cross_references.parquet", schemas.EDGE)
        self.aliases = optional(spark, f"{path}/entity_aliases.parquet", schemas.ALIAS)
        self.adjacency = open_adjacency(spark, f"{path}/adjacency") if optional(spark, f"{path}/adjacency/made") is not None else None
        self.chunks = manifest(spark, f"{path}/chunks_manifest.jsonl")

    def register(self, prefix: str = "kb_") -> None:
        """Temporary views of all tables that are there, for SQL."""
        for name in ("entities", "entity_units", "text_units", "communities", "reports", "relationships", "claims", "edges", "aliases", "chunks"):
            rows = getattr(self, name)
            if rows is not None:
                rows.createOrReplaceTempView(prefix + name)
