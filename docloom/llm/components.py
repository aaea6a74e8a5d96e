"""Connected components of an edge table by alternating large-star and small-star rounds, all as joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import cut


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
    return row[0], row[1]


def connected_components(edges: DataFrame, rounds: int = 40) -> DataFrame:
    """(node, component) for every node of the edges (a, b): the smallest node that it reaches.

    Nulls and loops are ignored; repeated and reversed edges count once. Each round ends in a checkpoint, so that a lost
    executor costs a round at most. Only a row count and a checksum of each round come to the driver. A node with very many
    neighbours is one row on the side of the minima, so that Spark can split the other side of that join.
    """
    now = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    mark = _mark(now)
    for _ in range(rounds):
        if not mark[0]:
            break
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(low.select("a", F.col("m").alias("b")))
        now = cut(small.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
        before, mark = mark, _mark(now)
        if mark == before:
            return now.groupBy("a").agg(F.min("b").alias("component")).withColumnRenamed("a", "node").unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
    if mark[0]:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return now.select(F.col("a").alias("node"), F.col("b").alias("component"))
