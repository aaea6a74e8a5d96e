"""Documents that change: a store of chunks and edges in which each version replaces what earlier ones hold of the same documents.

A version has its own folders of chunks and edges, and a row for each document it touches in a log that is written last. A version
without a log is not there yet; one that is made again replaces itself. What is current is, for each document, what its last version in the
log holds, or nothing if that one deletes it. References stay within a document, so a document's edges are made with its chunks.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from docloom import schemas
from docloom.operators import chunking, xref
from docloom.operators.lineage import written
from docloom.sources import readers, writers

LOG = "doc_id long, path string, modified long, deleted boolean"


@dataclass
class ChunkStore:
    spark: SparkSession
    path: str
    target_tokens: int = 1200
    max_tokens: int = 1800

    def _read(self, name: str, schema: str) -> DataFrame:
        found = readers.optional(self.spark, f"{self.path}/{name}")
        return found if found is not None else self.spark.createDataFrame([], f"{schema}, version long")

    def documents(self, before: int | None = None) -> DataFrame:
        """(doc_id, path, modified, deleted, version): the last row of each document in the log, deleted ones too; of versions below `before`, if given."""
        rows = self._read("log", LOG)
        rows = rows if before is None else rows.where(F.col("version") < before)
        return rows.groupBy("doc_id").agg(F.max(F.struct("version", "path", "modified", "deleted")).alias("last")).select("doc_id", "last.path", "last.modified", "last.deleted", F.col("last.version").cast("long").alias("version"))

    def _current(self, name: str, schema: str) -> DataFrame:
        alive = self.documents().where("not deleted").select("doc_id", "version")
        return self._read(name, schema).withColumn("version", F.col("version").cast("long")).join(alive, ["doc_id", "version"], "left_semi").drop("version")

    def chunks(self) -> DataFrame:
        return self._current("chunks", schemas.CHUNK)

    def edges(self) -> DataFrame:
        return self._current("edges", schemas.EDGE)

    def apply(self, changes: DataFrame, version: int) -> None:
        """One version from changes (path, md, modified, deleted). Of several changes of a path the last modified counts (a deletion after a text of the same time),
        and none that is older than what the store holds. Null paths are left out; a null text is an empty one, without chunks; a null time is 0."""
        rows = changes.where("path is not null").select(F.xxhash64("path").alias("doc_id"), "path", F.coalesce("md", F.lit("")).alias("md"), F.coalesce(F.col("modified").cast("long"), F.lit(0)).alias("modified"), F.coalesce("deleted", F.lit(False)).alias("deleted"))
        last = rows.groupBy("doc_id").agg(F.max(F.struct("modified", "deleted", "path", "md")).alias("last")).select("doc_id", "last.*")
        known = self.documents(version).select("doc_id", F.col("modified").alias("known"))
        fresh = written(last.join(known, "doc_id", "left").where(F.coalesce(F.col("modified") >= F.col("known"), F.lit(True))).drop("known"))
        name = F.regexp_replace(F.element_at(F.split("path", "/"), -1), r"(?<=.)\.[^.]*$", "")
        docs = fresh.where("not deleted").select("doc_id", F.replace(name, F.lit("_"), F.lit(" ")).alias("doc_title"), "md")
        done, edges = xref.process(written(chunking.chunk_documents(docs, self.target_tokens, self.max_tokens)))
        writers.table(done, f"{self.path}/chunks/version={version}", schemas.CHUNK)
        writers.table(edges, f"{self.path}/edges/version={version}", schemas.EDGE)
        writers.table(fresh, f"{self.path}/log/version={version}", LOG)

    def sync(self, source: str) -> int:
        """A version from what a folder of Markdown files holds now: files that are new or have another time than the log says are read, and
        those that are gone deleted. Returns the version; where nothing changed, the last one, and nothing is written."""
        there = self.spark.read.format("binaryFile").option("recursiveFileLookup", True).load(source)
        seen = there.select("path", F.unix_micros("modificationTime").alias("modified"))
        held = self.documents()
        last = held.agg(F.coalesce(F.max("version"), F.lit(-1)).alias("v")).first()["v"]
        alive = held.where("not deleted").select("path", F.col("modified").alias("known"))
        both = seen.join(alive, "path", "full").where("modified is null or known is null or modified <> known")
        changed = written(both.select("path", "modified", "known"))
        if changed.isEmpty():
            return last
        texts = there.join(changed.where("modified is not null").select("path"), "path", "left_semi").select("path", F.make_valid_utf8(F.col("content").cast("string")).alias("md"), F.unix_micros("modificationTime").alias("modified"), F.lit(False).alias("deleted"))
        gone = changed.where("modified is null").select("path", F.lit(None).cast("string").alias("md"), F.unix_micros(F.current_timestamp()).alias("modified"), F.lit(True).alias("deleted"))
        self.apply(texts.unionByName(gone), last + 1)
        return last + 1

    def follow(self, changes: DataFrame, checkpoint: str) -> StreamingQuery:
        """Applies a stream of changes (path, md, modified, deleted), each batch as the version of its number, until there are none left. A batch that
        runs again after a failure, or in a query started anew from the same checkpoint, replaces its own version."""
        return changes.writeStream.foreachBatch(self.apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
