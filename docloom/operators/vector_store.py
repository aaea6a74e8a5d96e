"""A vector store on disk: coarse centroids, and the vectors of each as an inverted list, a partition of a Parquet table.

Centroids are trained on a sample of bounded size by spherical k-means in one task. Every vector goes to the list of its nearest
centroid; lists with more than `most` vectors have several parts. A search probes the lists of the centroids nearest to each query, so
that only these partitions are read, and each part of a list gives its best few to every query that probes it. How many lists have to
be probed depends on the data: `recall` measures it against all vectors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docloom.operators import vectors
from docloom.operators.lineage import written


def _unit(column: pd.Series) -> np.ndarray:
    x = np.array(column.tolist(), dtype=np.float64)
    norm = np.sqrt((x * x).sum(axis=1, keepdims=True))
    return x / np.where(norm > 0, norm, 1)


def _trained(lists: int, rounds: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        x = _unit(rows.sort_values("id")["vec"])
        rng = np.random.default_rng(3)
        chosen = [int(rng.integers(len(x)))]
        near = x @ x[chosen[0]]
        while len(chosen) < min(lists, len(x)):  # each new centroid far from those before it
            far = np.maximum(1 - near, 0)
            chosen.append(int(rng.choice(len(x), p=far / far.sum())) if far.sum() > 1e-12 else int(rng.integers(len(x))))
            near = np.maximum(near, x @ x[chosen[-1]])
        centre = x[chosen]
        for _ in range(rounds):
            owner = (x @ centre.T).argmax(axis=1)
            total = np.zeros_like(centre)
            np.add.at(total, owner, x)
            norm = np.sqrt((total * total).sum(axis=1, keepdims=True))
            centre = np.where(norm > 0, total / np.where(norm > 0, norm, 1), centre)
        return pd.DataFrame({"list": np.arange(len(centre)), "centre": list(centre)})

    return run


def _nearest(sent, probes: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names, centre = sent.value
        for batch in batches:
            if len(batch) and len(names):
                order = np.argsort(-(_unit(batch["vec"]) @ centre.T), axis=1, kind="stable")[:, :probes]
                yield batch.loc[batch.index.repeat(order.shape[1])].assign(list=names[order].ravel().astype(np.int32))

    return run


def _best(k: int):
    def run(held: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if held.empty or asked.empty:
            return pd.DataFrame({"query_id": pd.Series(dtype="int64"), "id": pd.Series(dtype="int64"), "score": pd.Series(dtype="float64")})
        ids, x = held["id"].to_numpy(dtype=np.int64), np.array(held["vec"].tolist(), dtype=np.float64)
        parts = []
        for start in range(0, len(asked), 256):
            some = asked.iloc[start : start + 256]
            score = np.array(some["vec"].tolist(), dtype=np.float64) @ x.T
            order = np.lexsort((np.broadcast_to(ids, score.shape), -score), axis=1)[:, :k]
            parts.append(pd.DataFrame({"query_id": np.repeat(some["query_id"].to_numpy(dtype=np.int64), order.shape[1]), "id": ids[order].ravel(), "score": np.take_along_axis(score, order, axis=1).ravel()}))
        return pd.concat(parts)

    return run


@dataclass
class VectorStore:
    spark: SparkSession
    path: str

    def _sent(self):
        rows = self.spark.read.parquet(f"{self.path}/centroids").orderBy("list").toPandas()  # `lists` rows, whatever the number of vectors
        centre = np.array(rows["centre"].tolist(), dtype=np.float64) if len(rows) else np.zeros((0, 0))
        return self.spark.sparkContext.broadcast((rows["list"].to_numpy(dtype=np.int64), centre))

    @classmethod
    def write(cls, base: DataFrame, path: str, lists: int = 64, sample: int = 20_000, rounds: int = 8, most: int = 50_000) -> VectorStore:
        """A store of base (id, vec); every row with an id and a vector is in it, vectors of zeros too. At most about `sample` rows, chosen by hash of their
        ids, are learned from. Vectors must have one length; an empty base gives an empty store."""
        spark = base.sparkSession
        rows = base.select(F.col("id").cast("long").alias("id"), F.col("vec").cast("array<double>").alias("vec")).where("id is not null and vec is not null")
        n = max(1, rows.count())
        step = 1_000_000
        some = rows.where(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(step)) < max(1, min(step, sample * step // n)))
        some = rows.limit(lists) if some.isEmpty() else some
        some.withColumn("all", F.lit(1)).groupBy("all").applyInPandas(_trained(lists, rounds), "list int, centre array<double>").write.mode("overwrite").parquet(f"{path}/centroids")
        store = cls(spark, path)
        placed = written(rows.mapInPandas(_nearest(store._sent(), 1), "id long, vec array<double>, list int"))
        crowded = placed.groupBy("list").agg(F.ceil(F.count("*") / most).cast("int").alias("parts"))  # `lists` rows
        dealt = placed.join(F.broadcast(crowded), "list").withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")).drop("parts")
        dealt.repartition("list", "part").write.mode("overwrite").partitionBy("list", "part").parquet(f"{path}/lists")
        return store

    def lists(self) -> DataFrame:
        return self.spark.read.schema("id long, vec array<double>, list int, part int").parquet(f"{self.path}/lists")

    def search(self, queries: DataFrame, k: int, probes: int = 8) -> DataFrame:
        """(query_id, rank, id, score): of the vectors in the `probes` lists nearest to each query (query_id, vec), the k with the greatest dot product, ties to
        the smaller id. Queries without a vector find nothing."""
        asked = queries.select(F.col("query_id").cast("long").alias("query_id"), F.col("vec").cast("array<double>").alias("vec")).where("query_id is not null and vec is not null")
        probed = written(asked.mapInPandas(_nearest(self._sent(), probes), "query_id long, vec array<double>, list int"))
        wanted = probed.select("list").distinct()
        held = self.lists().join(wanted, "list", "left_semi")
        sent = probed.join(self.lists().select("list", "part").distinct(), "list")
        found = held.groupBy("list", "part").cogroup(sent.groupBy("list", "part")).applyInPandas(_best(k), "query_id long, id long, score double")
        rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))
        return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "id", "score")

    def recall(self, queries: DataFrame, k: int, probes: int = 8) -> float:
        """The share of the true k nearest, by a search of all vectors, that a search finds."""
        queries = queries.where("query_id is not null and vec is not null")
        every = vectors.top_k(self.lists().select("id", "vec"), queries, k).select("query_id", "id")
        n = every.count()
        return every.join(self.search(queries, k, probes).select("query_id", "id"), ["query_id", "id"]).count() / n if n else 1.0
