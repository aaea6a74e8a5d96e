"""Retrieval over the reference graph: bounded expansion from seeds, for many queries in one job, and fusion of results.

Edges: doc_id is not needed here; src_chunk_id, dst_chunk_id, edge_type, ref_text, resolved, weight, edge_ord. Seeds: query_id,
node, pos (order), score.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docloom.operators.adjacency import Adjacency, write_adjacency
from docloom.operators.lineage import cut

HITS = ["query_id", "chunk_id", "hop", "direction", "via", "edge_type", "score", "found_pos"]


def _admitted(found: DataFrame, spent: DataFrame, budget: int) -> DataFrame:
    """Of each query's candidates in order, those that the budget admits: one that would exceed it is skipped, and later ones are
    still tried; the first hit of a query always enters. This is sequential by meaning, so it is a fold over a query's own frontier."""
    row = F.struct("found_pos", "chunk_id", "cost")
    listed = found.groupBy("query_id").agg(F.array_sort(F.collect_list(row)).alias("rows")).join(spent, "query_id", "left")

    def step(acc: Column, x: Column) -> Column:
        over = (acc["n"] > 0) & (acc["spent"] + x["cost"] > budget)
        return F.struct(
            F.when(over, acc["ids"]).otherwise(F.concat(acc["ids"], F.array(x["chunk_id"]))).alias("ids"),
            F.when(over, acc["spent"]).otherwise(acc["spent"] + x["cost"]).alias("spent"),
            F.when(over, acc["n"]).otherwise(acc["n"] + 1).alias("n"),
        )

    zero = F.struct(F.array().cast("array<string>").alias("ids"), F.coalesce("spent", F.lit(0).cast("long")).alias("spent"), F.coalesce("n", F.lit(0).cast("long")).alias("n"))
    folded = listed.select("query_id", F.explode(F.aggregate("rows", zero, step, lambda a: a["ids"])).alias("chunk_id"))
    return found.join(folded, ["query_id", "chunk_id"])


def expand(edges: DataFrame | Adjacency, seeds: DataFrame, costs: DataFrame | None = None, depth: int = 2, decay: float = 0.5, budget: int = 0) -> DataFrame:
    """Breadth-first hits of every query, HITS by column: each node at its first discovery (earlier parents first, outgoing before
    incoming edges, then edge order); the score is the parent's times decay**hop times the edge's weight. Seeds are never hits. With a
    budget above 0, hits are admitted while their costs (node, cost; unknown nodes cost 0) fit. Each hop is checkpointed, so that the plan
    of one does not hold those of all before it; an empty frontier ends the walk. Edges are written once in buckets by node, if they are
    not an adjacency already, so that a hop exchanges its frontier alone."""
    graph = edges if isinstance(edges, Adjacency) else write_adjacency(edges)
    frontier = seeds.select("query_id", F.col("node").alias("node"), F.col("pos").cast("long").alias("parent_pos"), F.col("score").cast("double").alias("score"))
    frontier = cut(frontier)
    visited = frontier.select("query_id", F.col("node").alias("chunk_id")).distinct()
    hits = None
    for hop in range(1, depth + 1):
        reached = graph.step(frontier).select("query_id", F.col("neighbour").alias("chunk_id"), "dir", "edge_ord", "via", "edge_type", "parent_pos", (F.col("score") * decay**hop * F.col("weight")).alias("score"))
        fresh = reached.join(visited, ["query_id", "chunk_id"], "left_anti")
        order = ["parent_pos", "dir", "edge_ord"]
        first = fresh.withColumn("n", F.row_number().over(Window.partitionBy("query_id", "chunk_id").orderBy(*order))).where("n = 1").drop("n")
        found = first.withColumn("found_pos", F.row_number().over(Window.partitionBy("query_id").orderBy(*order)).cast("long"))
        if budget:
            found = found.join(costs.select(F.col("node").alias("chunk_id"), F.col("cost").cast("long").alias("cost")), "chunk_id", "left").fillna({"cost": 0})
            before = frontier.select("query_id").distinct().withColumns({"spent": F.lit(0).cast("long"), "n": F.lit(0).cast("long")}) if hits is None else hits.groupBy("query_id").agg(F.sum("cost").alias("spent"), F.count("*").alias("n"))
            found = _admitted(found, before, budget)
        found = found.withColumns({"hop": F.lit(hop), "direction": F.when(F.col("dir") == 0, "xref_out").otherwise("xref_in")})
        found = cut(found.select(*HITS, *(["cost"] if budget else [])))  # read by the hits, the visited and the next frontier
        hits = found if hits is None else hits.unionByName(found)
        visited = visited.unionByName(found.select("query_id", "chunk_id"))
        frontier = found.select("query_id", F.col("chunk_id").alias("node"), F.col("found_pos").alias("parent_pos"), "score")
        if hop < depth and frontier.isEmpty():
            break
    if graph is not edges:
        graph.forget()  # all hits are checkpoints
    return hits.select(*HITS)


def seed_scores(ordered: DataFrame) -> DataFrame:
    """(query_id, node, pos, score) from (query_id, node, pos): distinct nodes in order of first place, scored from their number down to 1."""
    first = ordered.where("node is not null").groupBy("query_id", "node").agg(F.min("pos").alias("at"))
    pos = F.row_number().over(Window.partitionBy("query_id").orderBy("at", "node"))
    n = F.count("*").over(Window.partitionBy("query_id"))
    return first.select("query_id", "node", pos.alias("pos"), (n - pos + 1).cast("double").alias("score"))


def boosted(hits: DataFrame, mentions: DataFrame, seed_keys: DataFrame, boost: float = 0.25) -> DataFrame:
    """Hits whose chunk mentions (chunk_id, key) one of the query's seed entities (query_id, key) get their score times 1 + boost."""
    hit = mentions.join(seed_keys, "key").select("query_id", "chunk_id").distinct().withColumn("boost", F.lit(True))
    scored = hits.join(hit, ["query_id", "chunk_id"], "left")
    return scored.withColumn("score", F.when(F.col("boost"), F.col("score") * (1 + boost)).otherwise(F.col("score"))).drop("boost")


def claims_document(claims: DataFrame, most: int = 40) -> DataFrame:
    """(query_id, text, n_claims): the first `most` claims (query_id, pos, subject, statement) of a query as one text; blank ones, of those, left out."""
    ranked = claims.withColumn("n", F.row_number().over(Window.partitionBy("query_id").orderBy("pos"))).where(F.col("n") <= most)
    statement = F.trim(F.coalesce("statement", F.lit("")))
    line = F.concat(F.lit("- "), F.when(F.coalesce("subject", F.lit("")) != "", F.concat(F.lit("["), "subject", F.lit("] "))).otherwise(""), statement)
    listed = F.array_sort(F.collect_list(F.struct("n", line.alias("line"))))
    lines = F.array_join(F.transform(listed, lambda x: x["line"]), "\n")
    head = F.lit("Normative requirements / claims relevant to the query:\n")
    return ranked.where(statement != "").groupBy("query_id").agg(F.concat(head, lines).alias("text"), F.count("*").alias("n_claims"))


def fused(seeds: DataFrame, claims: DataFrame | None, hits: DataFrame, k: int = 12) -> DataFrame:
    """Ranked results of each query: its seeds, then its claims as one document, then its hits (nearest hop first, then score); the
    first k, or all with k = 0. Columns: query_id, rank, chunk_id, source, hop, score, via, edge_type, text, n_claims."""
    none = F.lit(None)
    rows = seeds.select("query_id", F.lit(0).alias("bucket"), F.col("pos").cast("double").alias("o1"), F.lit(0.0).alias("o2"), F.lit(0).cast("long").alias("o3"), F.col("node").alias("chunk_id"), F.lit("local_search").alias("source"), F.lit(0).alias("hop"), F.col("score").cast("double").alias("score"), none.cast("string").alias("via"), none.cast("string").alias("edge_type"), none.cast("string").alias("text"), none.cast("long").alias("n_claims"))
    if claims is not None:
        rows = rows.unionByName(claims.select("query_id", F.lit(1).alias("bucket"), F.lit(0.0).alias("o1"), F.lit(0.0).alias("o2"), F.lit(0).cast("long").alias("o3"), none.cast("string").alias("chunk_id"), F.lit("claims").alias("source"), F.lit(0).alias("hop"), F.lit(float("inf")).alias("score"), none.cast("string").alias("via"), none.cast("string").alias("edge_type"), "text", "n_claims"))
    new = hits.join(seeds.select("query_id", F.col("node").alias("chunk_id")).distinct(), ["query_id", "chunk_id"], "left_anti")
    blank = lambda c: F.nullif(F.col(c), F.lit(""))
    rows = rows.unionByName(new.select("query_id", F.lit(2).alias("bucket"), F.col("hop").cast("double").alias("o1"), (-F.col("score")).alias("o2"), F.col("found_pos").alias("o3"), "chunk_id", F.col("direction").alias("source"), "hop", "score", blank("via").alias("via"), blank("edge_type").alias("edge_type"), none.cast("string").alias("text"), none.cast("long").alias("n_claims")))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("bucket", "o1", "o2", "o3"))
    ranked = rows.withColumn("rank", rank)
    kept = ranked.where(F.col("rank") <= k) if k else ranked
    return kept.select("query_id", "rank", "chunk_id", "source", "hop", F.round("score", 4).alias("score"), "via", "edge_type", "text", "n_claims")


def label_propagation(edges: DataFrame, rounds: int = 5) -> DataFrame:
    """(node, community): the smallest node within `rounds` steps along undirected edges (a, b). A deterministic stand-in for clustering.
    Every round reads the labels twice, so each is checkpointed, else the plan would double; rounds end early when no label changes."""
    both = cut(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct())
    labels = both.select(F.col("a").alias("node"), F.col("a").alias("community")).distinct()
    for _ in range(rounds):
        seen = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("community").alias("near"))
        moved = cut(labels.join(seen, "node", "left").select("node", F.least("community", F.coalesce("near", "community")).alias("community"), (F.col("near") < F.col("community")).alias("changed")))
        labels = moved.drop("changed")
        if moved.where("changed").isEmpty():
            break
    return labels
