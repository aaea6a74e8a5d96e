"""Sinks: chunk files, the manifest, edges, aliases, and the portable directory."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from docloom import schemas
from docloom.operators.lineage import qualified

_NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


@contextmanager
def replacing(spark: SparkSession, path: str) -> Iterator[str]:
    """A folder beside `path` to write into. When all is written it takes the place of `path` by renaming; if anything fails it goes, and what an earlier
    run left stays whole. Where a file system renames piece by piece, as object stores do, so does this."""
    Path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    token = uuid.uuid4().hex
    target, fresh, old = (Path(f"{path.rstrip('/')}{end}") for end in ("", f".fresh-{token}", f".old-{token}"))
    system = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    try:
        yield fresh.toString()
        system.mkdirs(fresh)
        if system.exists(target) and not system.rename(target, old):
            raise OSError(f"{path} could not be set aside")
        if not system.rename(fresh, target):
            system.rename(old, target)
            raise OSError(f"{path} could not be replaced")
        system.delete(old, True)
    finally:
        system.delete(fresh, True)


@dataclass
class Written(WriterCommitMessage):
    files: int


class ChunkFileWriter(DataSourceArrowWriter):
    """Tasks write files into a folder of this job; the commit puts it in the place of the target, an abort removes it. (A task that
    is still writing when the job is aborted may leave files in that folder, never in the target.)"""

    def __init__(self, root: str):
        self.root, self.token = root.rstrip("/"), uuid.uuid4().hex

    def _place(self):
        from pyarrow import fs

        files, base = fs.FileSystem.from_uri(self.root)
        return files, base, f"{base}.fresh-{self.token}", f"{base}.old-{self.token}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        files, _, fresh, _ = self._place()
        n = 0
        for batch in iterator:
            for row in batch.to_pylist():
                doc, chunk = (_NO_VALUE if row[name] is None else quote(str(row[name]), safe="") for name in ("doc_id", "chunk_id"))
                folder = f"{fresh}/doc_id={doc}/chunk_id={chunk}"
                files.create_dir(folder, recursive=True)
                with files.open_output_stream(f"{folder}/part-0.md") as out:
                    out.write((row["text"] or "").encode())
                n += 1
        return Written(n)

    def commit(self, messages: list[Written | None]) -> None:
        from pyarrow import fs

        files, base, fresh, old = self._place()
        files.create_dir(fresh, recursive=True)
        there = files.get_file_info(base).type != fs.FileType.NotFound
        if there:
            files.move(base, old)
        files.move(fresh, base)
        if there:
            files.delete_dir(old)

    def abort(self, messages: list[Written | None]) -> None:
        from pyarrow import fs

        files, _, fresh, _ = self._place()
        if files.get_file_info(fresh).type != fs.FileType.NotFound:
            files.delete_dir(fresh)


class ChunkFiles(DataSource):
    """Sink of (doc_id, chunk_id, text): a folder for each chunk with exactly its text in one file. Option: root."""

    @classmethod
    def name(cls) -> str:
        return "docloom_chunk_files"

    def writer(self, schema, overwrite: bool) -> ChunkFileWriter:
        return ChunkFileWriter(self.options["root"])


def chunk_files(chunks: DataFrame, path: str) -> None:
    """A folder for each chunk with exactly its text in one file; what an earlier run left is replaced when all files are there, and stays whole if a
    task fails.

    Spark's text sink ends every row with a separator, so tasks write the files themselves, through a data source of ours. A task that is run again
    writes the same files. Folders are named like partitions; a null id is `__HIVE_DEFAULT_PARTITION__`, a null text an empty file.
    """
    spark = chunks.sparkSession
    spark.dataSource.register(ChunkFiles)
    chunks.select(*(F.col(c).cast("string").alias(c) for c in ("doc_id", "chunk_id", "text"))).write.format("docloom_chunk_files").option("root", qualified(spark, path)).mode("overwrite").save()


def manifest(chunks: DataFrame, path: str) -> None:
    """Chunk records as JSON lines, ordered within files, with nulls written out."""
    chunks.repartitionByRange("doc_id", "order").sortWithinPartitions("doc_id", "order").write.mode("overwrite").option("ignoreNullFields", False).json(path)


def table(rows: DataFrame, path: str, schema: str | None = None) -> None:
    """Parquet with a fixed schema, even if there are no rows."""
    if schema is not None:
        kinds = rows.sparkSession.createDataFrame([], schema).schema
        rows = rows.select(*(F.col(f.name).cast(f.dataType) for f in kinds))
    rows.write.mode("overwrite").parquet(path)


def bundle(spark: SparkSession, path: str, chunks: DataFrame, edges: DataFrame, tables: dict[str, DataFrame], facts: dict[str, str | int] | None = None) -> DataFrame:
    """Write all tables of a knowledge base into one directory, with a manifest of row counts; returns that manifest."""
    manifest(chunks, f"{path}/chunks_manifest.jsonl")
    table(edges, f"{path}/cross_references.parquet", schemas.EDGE)
    for name, rows in tables.items():
        table(rows, f"{path}/{name}.parquet", schemas.ALIAS if name == "entity_aliases" else None)
    files = sorted([*(f"{n}.parquet" for n in tables), "cross_references.parquet"])
    n_chunks, n_edges = (spark.read.schema(schemas.CHUNK).json(f"{path}/chunks_manifest.jsonl").count(), spark.read.parquet(f"{path}/cross_references.parquet").count())
    told = spark.range(1).select(
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ssXXX").alias("created_at"),
        F.lit(n_chunks).alias("n_chunks"),
        F.lit(n_edges).alias("xref_edges"),
        F.lit("entity_aliases" in tables).alias("entity_aliases"),
        F.lit("covariates" in tables).alias("extract_claims"),
        F.array(*(F.lit(f) for f in files)).alias("files"),
        *(F.lit(v).alias(k) for k, v in (facts or {}).items()),
    )
    told.coalesce(1).write.mode("overwrite").json(f"{path}/db_manifest.json")
    return told
