"""Approximate nearest neighbours by cosine: a robust-pruned directed graph in each shard, searched by beams.

Equal vectors are indexed once, with the smallest of their ids (one more than are asked for, so that a query can leave itself
out); the rest of such a group can never be among a query's nearest. Distinct vectors are dealt by hash into shards of about
`shard_size`. Each shard's graph begins at random; then, batch by batch, greedy beam searches propose neighbours for
each node, and relaxed pruning keeps, nearest first, those that no kept neighbour is closer to by the factor alpha; edges are
added both ways, and nodes with too many are pruned anew. Queries, in blocks of bounded size, meet every shard; each
shard gives its nearest few, scored in double precision on the original vectors.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docloom.llm.common import cut


def beam_search(x: np.ndarray, edges: np.ndarray, entries: np.ndarray, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """For each query, the `beam` nearest nodes that a best-first walk along the edges finds, nearest first (-1 beyond the last)."""
    b, width = len(queries), max(beam, len(entries))
    row = np.arange(b)[:, None]
    nodes = np.full((b, width), -1, dtype=np.int64)
    far = np.full((b, width), np.inf, dtype=np.float32)
    nodes[:, : len(entries)] = entries
    far[:, : len(entries)] = 1 - queries @ x[entries].T
    walked = nodes < 0
    seen = np.zeros((b, len(x) + 1), dtype=bool)  # the last column stands for edges that are not there
    seen[:, entries] = True
    while True:
        order = np.argsort(far, axis=1, kind="stable")[:, :beam] if far.shape[1] > beam else np.argsort(far, axis=1, kind="stable")
        nodes, far, walked = (np.take_along_axis(a, order, axis=1) for a in (nodes, far, walked))
        at = np.argmax(~walked, axis=1)
        busy = ~walked[np.arange(b), at]
        if not busy.any():
            return nodes, far
        walked[np.arange(b), at] = True
        near = np.where(busy[:, None], edges[np.where(busy, nodes[np.arange(b), at], 0)], -1)
        fresh = (near >= 0) & ~seen[row, near]
        seen[row, near] = True
        d = np.where(fresh, 1 - np.einsum("qrd,qd->qr", x[near], queries), np.inf).astype(np.float32)
        nodes = np.concatenate([nodes, np.where(fresh, near, -1)], axis=1)
        far = np.concatenate([far, d], axis=1)
        walked = np.concatenate([walked, ~fresh], axis=1)


def robust_prune(x: np.ndarray, own: np.ndarray, near: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """For each node of `own`, at most `degree` of its candidates (-1: none): going from the nearest, a kept one removes all that
    are closer to it than to the node, by the factor alpha."""
    order = np.sort(near, axis=1)
    near = np.where((order == own[:, None]) | np.concatenate([np.zeros((len(own), 1), dtype=bool), order[:, 1:] == order[:, :-1]], axis=1), -1, order)
    there = x[near]
    far = np.where(near >= 0, np.sqrt(np.maximum(2 - 2 * np.einsum("bmd,bd->bm", there, x[own]), 0)), np.inf)
    order = np.argsort(far, axis=1, kind="stable")
    near, far = np.take_along_axis(near, order, axis=1), np.take_along_axis(far, order, axis=1)
    there = x[near]
    between = np.sqrt(np.maximum(2 - 2 * np.matmul(there, there.transpose(0, 2, 1)), 0))
    alive, kept = near >= 0, np.zeros(near.shape, dtype=bool)
    for t in range(near.shape[1]):
        pick = alive[:, t] & (kept.sum(axis=1) < degree)
        kept[:, t] = pick
        alive &= ~(pick[:, None] & (alpha * between[:, t, :] <= far))
    out = np.full((len(own), degree), -1, dtype=np.int64)
    at = np.cumsum(kept, axis=1) - 1
    rows, columns = np.nonzero(kept)
    out[rows, at[rows, columns]] = near[rows, columns]
    return out


def build_graph(x: np.ndarray, degree: int, beam: int, alpha: float, batch: int = 256, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """The out-edges of each node (-1: none) and the entry nodes: the most central one and a few at random."""
    n, rng = len(x), np.random.default_rng(seed)
    entries = np.unique(np.concatenate([[int(np.argmax(x @ x.mean(axis=0)))], rng.integers(0, n, 7)]))
    if n <= degree + 1:
        return np.where(np.eye(n, dtype=bool), -1, np.arange(n)), entries
    edges = np.full((n, degree), -1, dtype=np.int64)
    edges[:, : degree // 2] = rng.integers(0, n, (n, degree // 2))
    edges[edges == np.arange(n)[:, None]] = -1
    for factor in (1.0, alpha):
        for own in np.array_split(rng.permutation(n), math.ceil(n / batch)):
            found, _ = beam_search(x, edges, entries, x[own], beam)
            edges[own] = robust_prune(x, own, np.concatenate([found, edges[own]], axis=1), degree, factor)
            source, target = np.repeat(own, degree), edges[own].ravel()
            source, target = source[target >= 0], target[target >= 0]
            order = np.argsort(target, kind="stable")
            source, target = source[order], target[order]
            back, first, count = np.unique(target, return_index=True, return_counts=True)
            place = np.arange(len(target)) - np.repeat(first, count)
            new = np.full((len(back), int(count.max())), -1, dtype=np.int64)
            new[np.repeat(np.arange(len(back)), count), place] = source
            for part in np.array_split(np.arange(len(back)), math.ceil(len(back) / batch)):
                edges[back[part]] = robust_prune(x, back[part], np.concatenate([edges[back[part]], new[part][:, : int(count[part].max())]], axis=1), degree, factor)
    return edges, entries


def scaled(x: np.ndarray) -> np.ndarray:
    """Each row by a power of two, so that its largest component lies between 1/2 and 1: squares of very small or large components
    neither vanish nor overflow, and cosines keep every bit."""
    most = np.abs(x).max(axis=1, initial=0.0)
    return np.ldexp(x, -np.frexp(most)[1][:, None])


def _built(degree: int, beam: int, alpha: float):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("hash", kind="stable").reset_index(drop=True)
        x = scaled(np.array(rows["vec"].tolist(), dtype=np.float64))
        x = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)
        edges, entries = build_graph(x, degree, beam, alpha)
        return pd.DataFrame({"dim": rows["dim"], "shard": rows["shard"], "pos": np.arange(len(x)), "ids": rows["ids"], "vec": rows["vec"], "edges": list(edges.astype(np.int32)), "entry": np.isin(np.arange(len(x)), entries)})

    return run


def _searched(k: int, beam: int, batch: int = 256):
    kinds = {"query_id": "int64", "vec_id": "int64", "score": "float64"}

    def run(nodes: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if nodes.empty or queries.empty:
            return pd.DataFrame({c: pd.Series(dtype=t) for c, t in kinds.items()})
        nodes = nodes.sort_values("pos")
        exact = scaled(np.array(nodes["vec"].tolist(), dtype=np.float64))
        norm = np.sqrt((exact * exact).sum(axis=1))
        x = (exact / norm[:, None]).astype(np.float32)
        edges, entries, ids = np.array(nodes["edges"].tolist(), dtype=np.int64), np.flatnonzero(nodes["entry"].to_numpy()), nodes["ids"].tolist()
        q = scaled(np.array(queries["vec"].tolist(), dtype=np.float64))
        length = np.sqrt((q * q).sum(axis=1))
        out: list[tuple] = []
        for part in np.array_split(np.arange(len(q)), math.ceil(len(q) / batch)):
            found, _ = beam_search(x, edges, entries, (q[part] / length[part, None]).astype(np.float32), beam)
            score = np.where(found >= 0, (exact[found] * q[part, None, :]).sum(axis=2) / (norm[found] * length[part, None]), -np.inf)
            best = np.argsort(-score, axis=1, kind="stable")
            for i, query in enumerate(queries["vec_id"].to_numpy()[part]):
                told: list[tuple] = []
                for j in best[i]:
                    if found[i, j] < 0 or (len(told) >= k and score[i, j] < told[k - 1][0]):
                        break
                    told += [(score[i, j], vec) for vec in ids[found[i, j]] if vec != query]
                    told.sort(key=lambda t: (-t[0], t[1]))
                out.extend((query, vec, s) for s, vec in told[:k])
        return pd.DataFrame(out, columns=list(kinds)).astype(kinds)

    return run


def _usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, vec): rows whose vectors have components, all of them finite, and not all zero."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vec"))
    finite = F.forall("vec", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    return rows.where(F.col("vec_id").isNotNull() & F.coalesce(finite & F.exists("vec", lambda v: v != 0), F.lit(False)))


def build_index(vectors: DataFrame, k: int = 5, shard_size: int = 4096, degree: int = 32, beam: int = 48, alpha: float = 1.2) -> DataFrame:
    """(dim, shard, pos, ids, vec, edges, entry): a node for each distinct usable vector, checkpointed."""
    rank = F.dense_rank().over(Window.partitionBy("vec").orderBy("vec_id"))
    distinct = _usable(vectors).withColumn("rank", rank).where(F.col("rank") <= k + 1).groupBy("vec").agg(F.sort_array(F.collect_set("vec_id")).alias("ids"))
    distinct = cut(distinct)
    shards = max(1, math.ceil(distinct.count() / shard_size))
    dealt = distinct.withColumns({"dim": F.size("vec"), "hash": F.xxhash64("vec")}).withColumn("shard", F.pmod("hash", F.lit(shards)).cast("int"))
    # by a stated number, as shards are few bytes but long work, and would else be put together in few tasks
    dealt = dealt.repartition(min(4 * shards, 20_000), "dim", "shard")
    return cut(dealt.groupBy("dim", "shard").applyInPandas(_built(degree, beam, alpha), "dim int, shard int, pos int, ids array<long>, vec array<double>, edges array<int>, entry boolean"))


def nearest(vectors: DataFrame, every: int = 50, k: int = 5, beam: int = 64, block: int = 16_384, **parameters) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest rows found for each row whose vec_id is divisible by `every`.

    Nearness is the cosine in double precision, largest first, ties to the smaller vec_id; all other rows are candidates. Rows with a
    null vec_id take no part, nor do vectors that are null, empty or zero, or hold null or non-finite components. Vectors are only
    compared with vectors of as many components. Rows that repeat a vec_id and vector count once; of a vec_id's different vectors, the least
(by component, then by number of components) asks, and all are candidates for others. Fewer than k rows are
    returned only where there are fewer candidates. An empty table gives an empty result.
    """
    index = build_index(vectors, k=k, **parameters)
    queries = _usable(vectors).where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("vec").alias("vec"))
    blocks = max(1, math.ceil(queries.count() / block))
    shards = index.select(F.col("dim").alias("of_dim"), F.col("shard").alias("of_shard")).distinct()
    asked = queries.select("vec_id", "vec", F.size("vec").alias("of_dim"), F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int").alias("of_block")).join(shards, "of_dim")
    offered = index.withColumn("block", F.explode(F.array(*(F.lit(b) for b in range(blocks))))) if blocks > 1 else index.withColumn("block", F.lit(0))
    found = offered.groupBy("dim", "shard", "block").cogroup(asked.groupBy("of_dim", "of_shard", "of_block")).applyInPandas(_searched(k, beam), "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
