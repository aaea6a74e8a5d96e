"""The reference graph written once for walks: bucketed by node, and split where a node has very many edges.

A hop joins its frontier with the edges of the frontier's nodes. With the edges in buckets by (node, part), only the frontier is
exchanged; the edges stay where they are. A node with more than `most` edges has several parts, which lie in different buckets, so that no
bucket grows with the degree of a node; the few nodes of that kind are a table of their own, and a frontier visits all their parts.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.operators.lineage import checkpoint_folder, cut, qualified

COLUMNS = ["node", "part", "neighbour", "dir", "edge_ord", "via", "edge_type", "weight"]
EDGES = "node string, part int, neighbour string, dir int, edge_ord bigint, via string, edge_type string, weight double"


def doubled(edges: DataFrame) -> DataFrame:
    """Every resolved edge with both ends, once in each direction: node, neighbour, dir (0 out, 1 in), edge_ord, via, edge_type, weight."""
    good = edges.where("resolved and coalesce(src_chunk_id, '') <> '' and coalesce(dst_chunk_id, '') <> ''")
    rest = [F.col("edge_ord").cast("long").alias("edge_ord"), F.col("ref_text").cast("string").alias("via"), F.col("edge_type").cast("string").alias("edge_type"), F.coalesce("weight", F.lit(1.0)).cast("double").alias("weight")]
    src, dst = F.col("src_chunk_id").cast("string"), F.col("dst_chunk_id").cast("string")
    out = good.select(src.alias("node"), dst.alias("neighbour"), F.lit(0).alias("dir"), *rest)
    return out.unionByName(good.select(dst.alias("node"), src.alias("neighbour"), F.lit(1).alias("dir"), *rest))


@dataclass
class Adjacency:
    """Edges in buckets by (node, part), and the nodes of several parts: (node, parts)."""

    edges: DataFrame
    hubs: DataFrame
    buckets: int
    name: str

    def step(self, frontier: DataFrame) -> DataFrame:
        """`frontier` (node, …) joined with the edges of its nodes. Only the frontier is exchanged."""
        parts = frontier.join(self.hubs, "node", "left").withColumn("part", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1))).drop("parts")
        return parts.repartition(self.buckets, "node", "part").join(self.edges, ["node", "part"]).drop("part")

    def forget(self) -> None:
        """Takes the table out of the session's catalogue; its files stay."""
        self.edges.sparkSession.sql(f"DROP TABLE IF EXISTS {self.name}")


def _registered(spark: SparkSession, folder: str, buckets: int) -> Adjacency:
    name = f"adjacency_{uuid.uuid4().hex}"
    folder = qualified(spark, folder)
    where = f"{folder}/edges".replace("'", "\\'")
    spark.sql(f"CREATE TABLE {name} ({EDGES}) USING parquet CLUSTERED BY (node, part) SORTED BY (node, part) INTO {buckets} BUCKETS LOCATION '{where}'")
    return Adjacency(spark.table(name), spark.read.schema("node string, parts int").parquet(f"{folder}/hubs"), buckets, name)


def write_adjacency(edges: DataFrame, folder: str | None = None, buckets: int | None = None, most: int = 100_000) -> Adjacency:
    """Writes edges (src_chunk_id, dst_chunk_id, edge_type, ref_text, resolved, weight, edge_ord) into a folder, by default a new one of the checkpoint
    folder. Unresolved edges, and those without both ends, are left out; no edges give an empty adjacency. `buckets` are by default as many as the
    session's shuffle partitions; a part holds about `most` edges of a node."""
    spark = edges.sparkSession
    folder = qualified(spark, folder or f"{checkpoint_folder(spark)}/adjacency-{uuid.uuid4().hex}")
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    both = cut(doubled(edges))
    hubs = both.groupBy("node").agg(F.count("*").alias("n")).where(F.col("n") > most).select("node", F.ceil(F.col("n") / most).cast("int").alias("parts"))
    hubs.write.mode("overwrite").parquet(f"{folder}/hubs")
    hubs = spark.read.schema("node string, parts int").parquet(f"{folder}/hubs")
    dealt = both.join(hubs, "node", "left").withColumn("part", F.pmod(F.xxhash64("neighbour", "edge_ord", "dir"), F.coalesce("parts", F.lit(1))).cast("int"))
    name = f"adjacency_{uuid.uuid4().hex}"
    dealt.select(*COLUMNS).repartition(buckets, "node", "part").write.format("parquet").bucketBy(buckets, "node", "part").sortBy("node", "part").option("path", f"{folder}/edges").mode("overwrite").saveAsTable(name)
    spark.createDataFrame([(buckets,)], "buckets int").coalesce(1).write.mode("overwrite").parquet(f"{folder}/made")
    return Adjacency(spark.table(name), hubs, buckets, name)


def open_adjacency(spark: SparkSession, folder: str) -> Adjacency:
    """An adjacency that was written into a folder, in this or another session."""
    return _registered(spark, folder, spark.read.parquet(f"{folder}/made").first()["buckets"])
