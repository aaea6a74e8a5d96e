"""Embeddings and exact vector search."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docloom.functions import text as T


def hashed_vector(text: Column, dim: int = 64) -> Column:
    """A unit vector of hashed word counts: an offline stand-in for a learned embedding. Texts without words give zeros."""
    buckets = F.transform(F.filter(F.split(F.lower(T.collapse(text)), " "), lambda w: w != ""), lambda w: F.pmod(F.xxhash64(w), F.lit(dim)).cast("int"))
    counts = F.transform(F.sequence(F.lit(0), F.lit(dim - 1)), lambda i: F.size(F.filter(buckets, lambda b: b == i)).cast("double"))
    norm = F.sqrt(F.aggregate(counts, F.lit(0.0), lambda s, x: s + x * x))
    return F.transform(counts, lambda x: F.when(norm > 0, x / norm).otherwise(0.0).cast("float"))


def top_k(base: DataFrame, queries: DataFrame, k: int, most_queries: int = 4096) -> DataFrame:
    """(query_id, rank, id, score): the k rows of base (id, vec) with the greatest dot product with each query (query_id, vec), ties to the
    smaller id. Queries go to the tasks in blocks of about `most_queries`, dealt by hash, which bounds what is broadcast; each task keeps k rows a query."""
    spark = base.sparkSession
    blocks = -(-queries.count() // most_queries)
    parts = []
    for block in range(max(blocks, 1)):
        some = queries.where(F.pmod(F.xxhash64("query_id"), F.lit(max(blocks, 1))) == block).toPandas()
        if not len(some):
            continue
        ids = some["query_id"].to_numpy(dtype=np.int64)
        sent = spark.sparkContext.broadcast((ids, np.array(some["vec"].tolist(), dtype=np.float64).reshape(len(ids), -1)))
        parts.append(base.select("id", "vec").mapInPandas(_best(sent, k), "query_id long, id long, score double"))
    found = spark.createDataFrame([], "query_id long, id long, score double")
    for part in parts:
        found = found.unionByName(part)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "id", "score")


def _best(sent, k: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        queries, wanted = sent.value
        for batch in batches:
            if not len(batch) or not len(queries):
                continue
            ids = batch["id"].to_numpy(dtype=np.int64)
            score = wanted @ np.array(batch["vec"].tolist(), dtype=np.float64).T
            order = np.lexsort((np.broadcast_to(ids, score.shape), -score), axis=1)[:, :k]
            yield pd.DataFrame({"query_id": np.repeat(queries, order.shape[1]), "id": ids[order].ravel(), "score": np.take_along_axis(score, order, axis=1).ravel()})

    return run
