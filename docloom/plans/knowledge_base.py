"""Whole plans: documents to a knowledge base directory, and queries against it."""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from types import UnionType
from typing import get_args, get_origin, get_type_hints

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docloom.functions import text as T
from docloom.operators import clustering, entities, graph, vectors, xref
from docloom.operators.adjacency import write_adjacency
from docloom.operators.lineage import cut
from docloom.sources import readers, writers


@dataclass
class Settings:
    """What a build and its queries can be told; fixed values are the usual ones."""

    target_tokens: int = 1200
    max_tokens: int = 1800
    prepend_breadcrumb: bool = True
    named_references: list[str] = field(default_factory=list)
    inline_titles: bool = True
    mentions: bool = True
    xref: bool = True
    expand_depth: int = 2
    hop_decay: float = 0.5
    budget_share: float = 0.4
    context_window: int = 8000
    k: int = 12
    mention_boost: float = 0.25
    claims: bool = True
    vector_dim: int = 64
    merge_threshold: float | None = None
    chunk_files: bool = False
    max_cluster_size: int = 10
    descriptions: int = 5
    source: str | None = None
    target: str | None = None

    def checked(self) -> Settings:
        """Fails, naming the value, where one has another type than its own or makes no sense."""
        for name, kinds in get_type_hints(type(self)).items():
            value, allowed = getattr(self, name), {get_origin(k) or k for k in (get_args(kinds) if isinstance(kinds, UnionType) else [kinds])}
            if not (type(value) in allowed or (type(value) is int and float in allowed)):
                raise ValueError(f"{name} must be {' or '.join(sorted(k.__name__ for k in allowed))}, not {type(value).__name__}")
        for name in ("target_tokens", "max_tokens", "context_window", "vector_dim", "max_cluster_size", "descriptions"):
            if getattr(self, name) < 1:
                raise ValueError(f"{name} must be 1 or more")
        if self.max_tokens < self.target_tokens:
            raise ValueError("max_tokens must not be below target_tokens")
        if not 0 <= self.budget_share <= 1:
            raise ValueError("budget_share must lie between 0 and 1")
        return self


# Fixed text: the answer when nothing is found.
NOTHING_FOUND = "No relevant specification content found."


def entity_types(generic: list[str], domain: list[str]) -> list[str]:
    """Both lists, each type once, in order."""
    return list(dict.fromkeys([*generic, *domain]))


def node() -> Column:
    """The key of a chunk in the whole knowledge base: chunk ids alone are unique within their document only."""
    return F.concat_ws("/", F.col("doc_id").cast("string"), "chunk_id")


def build(spark: SparkSession, chunks: DataFrame, path: str, settings: Settings) -> DataFrame:
    """Write the knowledge base of chunk records (doc_id … original_name) into a directory; returns its manifest. No chunks: an error."""
    settings.checked()
    chunks = cut(chunks)
    if chunks.isEmpty():
        raise ValueError("no chunks were made from the input")
    done, edges = xref.process(chunks, settings.named_references, settings.inline_titles, settings.mentions, settings.xref)
    done, edges = cut(done), cut(edges)
    named = done.select("doc_id", "chunk_id", "breadcrumb", "order", F.posexplode("mentioned_entities").alias("pos", "m")).select("doc_id", "chunk_id", "breadcrumb", "order", "pos", F.col("m.name").alias("title"))
    found = cut(named.unionByName(done.select("doc_id", "chunk_id", "breadcrumb", "order", F.lit(-1).alias("pos"), "title")).select("*", node().alias("unit_id")))
    told = entities.described(found.select("title", F.struct("doc_id", "order", "pos").alias("ord"), F.col("breadcrumb").alias("description")).where("description <> ''"), settings.descriptions)
    listed = found.groupBy("title").agg(F.min(F.struct("doc_id", "order", "pos")).alias("at")).join(told, "title", "left")
    titles = cut(listed.select(F.sha1("title").alias("id"), "title", F.col("at.order").cast("long").alias("ord"), F.coalesce("description", F.lit("")).alias("description"), vectors.hashed_vector(F.col("title"), settings.vector_dim).alias("vector")))
    names = titles.select(F.col("title").alias("name"), "ord", "id")
    canonical = entities.canonical_names(names)
    if settings.merge_threshold is not None:
        keyed = canonical.select("name_key", F.xxhash64("name_key").alias("key_ord"), vectors.hashed_vector(F.col("canonical"), settings.vector_dim).alias("vec"))
        canonical = entities.merged_by_vectors(canonical, keyed, settings.merge_threshold)
    aliases = cut(entities.aliases(names, canonical))
    related = cut(entities.co_occurrence(found.select(F.col("unit_id").alias("group_id"), F.col("title").alias("item"))))
    communities = clustering.clusters(related, settings.max_cluster_size)
    units = done.select(node().alias("id"), node().alias("human_readable_id"), "text", node().alias("document_id"), F.array(node()).alias("document_ids"))
    tables = {
        "entities": titles,
        "entity_units": found.select(F.sha1("title").alias("entity_id"), "unit_id").distinct(),
        "text_units": units,
        "relationships": related.select(F.col("a").alias("source"), F.col("b").alias("target"), "weight"),
        "communities": communities,
        "community_reports": entities.community_reports(communities, related),
        "entity_aliases": aliases,
    }
    if settings.claims:
        tables["covariates"] = entities.claims(done)
    facts = {"n_folded_names": entities.n_folded(aliases)}
    with writers.replacing(spark, path) as fresh:
        if settings.chunk_files:
            writers.chunk_files(done, f"{fresh}/chunks")
        whole = [F.concat_ws("/", F.col("doc_id").cast("string"), c).alias(c) for c in ("src_chunk_id", "dst_chunk_id")]
        write_adjacency(edges.where("resolved").select(*whole, *(c for c in edges.columns if c not in ("doc_id", "src_chunk_id", "dst_chunk_id"))), f"{fresh}/adjacency").forget()
        return writers.bundle(spark, fresh, done, edges, tables, facts)


def entity_units(kb: readers.KnowledgeBase) -> DataFrame:
    """(entity_id, node): the chunks of each entity, from the table of links or, in knowledge bases made elsewhere, from the list of text
    units in the entity table. A unit is mapped to a chunk by its id, else by the beginning of its text; units without either drop out."""
    links = kb.entity_units
    if links is None:
        listed = readers.column_of(kb.entities, "text_unit_ids", "text_units")
        if listed is None:
            raise ValueError("the entity table has no list of text units, and there is no table of links")
        links = kb.entities.select(F.col("id").alias("entity_id"), F.explode(F.col(listed).cast("array<string>")).alias("unit_id"))
    chunks = kb.chunks.select(node().alias("chunk_id"), F.col("chunk_id").alias("bare"), "doc_id", "order", "text")
    units = kb.text_units.select(F.col("id").cast("string").alias("id"), "text")
    mapped = readers.mapped_units(units, readers.by_prefix(chunks), readers.unit_ids(kb.text_units)).select(F.col("id").alias("unit_id"), F.col("chunk_id").alias("to"))
    # a document id may be a chunk's key or, elsewhere, its bare id
    keys = chunks.select(F.col("chunk_id").alias("to"), F.col("chunk_id").alias("node")).unionByName(chunks.groupBy(F.col("bare").alias("to")).agg(F.min_by("chunk_id", F.struct("doc_id", "order")).alias("node")))
    return links.join(mapped, "unit_id").join(keys, "to").select("entity_id", "node").distinct()


def retrieve(kb: readers.KnowledgeBase, queries: DataFrame, settings: Settings, top_entities: int = 10) -> DataFrame:
    """Ranked results for every query (query_id long, text): chunks of the nearest entities, claims about them, and what their
    references lead to; with each chunk's doc_id, title, breadcrumb, section number and text."""
    wanted = queries.select("query_id", vectors.hashed_vector(F.col("text"), settings.vector_dim).alias("vec"))
    numbered = kb.entities.select(F.xxhash64("id").alias("id"), F.col("id").alias("entity_id"), "title", F.col(readers.column_of(kb.entities, "vector", "description_embedding", "embedding")).alias("vec"))
    near = cut(vectors.top_k(numbered, wanted, top_entities).join(numbered.select("id", "entity_id", "title"), "id"))
    unit = near.join(entity_units(kb), "entity_id").groupBy("query_id", "node").agg(F.count("*").alias("links"), F.min("rank").alias("best"))
    pos = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("links"), "best", "node"))
    seeds = cut(graph.seed_scores(unit.select("query_id", "node", pos.alias("pos"))))
    keys = entities.folded(near.select("query_id", "title"), "title", kb.aliases).select("query_id", "key").distinct()
    costs = kb.chunks.select(node().alias("node"), F.col("token_count").alias("cost"))
    edges = kb.adjacency
    if edges is None:  # a knowledge base made elsewhere
        whole = [F.concat_ws("/", F.col("doc_id").cast("string"), c).alias(c) for c in ("src_chunk_id", "dst_chunk_id")]
        edges = kb.edges.where("resolved").select(*whole, *(c for c in kb.edges.columns if c not in ("doc_id", "src_chunk_id", "dst_chunk_id")))
    hits = graph.expand(edges, seeds, costs, settings.expand_depth, settings.hop_decay, int(settings.budget_share * settings.context_window))
    mentioned = entities.folded(kb.chunks.select(node().alias("chunk_id"), F.explode("mentioned_entities.name").alias("name")), "name", kb.aliases).select("chunk_id", "key").distinct()
    hits = graph.boosted(hits, mentioned, keys, settings.mention_boost)
    told = None
    if settings.claims and kb.claims is not None:
        of = kb.claims.withColumn("node", node()).join(seeds.select("query_id", "node", F.col("pos").alias("seed_pos")), "node")
        place = F.row_number().over(Window.partitionBy("query_id").orderBy("seed_pos", "pos"))
        told = graph.claims_document(of.select("query_id", place.alias("pos"), "subject", "statement"))
    ranked = graph.fused(seeds, told, hits, settings.k).withColumnRenamed("chunk_id", "node")
    shown = kb.chunks.select(node().alias("node"), "doc_id", "chunk_id", "title", "breadcrumb", "section_no", "page_start", "page_end", F.col("text").alias("chunk_text"))
    return ranked.join(shown, "node", "left").withColumn("text", F.coalesce("text", "chunk_text")).drop("chunk_text", "node")


@dataclass
class Retriever:
    """A knowledge base with settings; each search may ask for other numbers of results, another boost, or no claims."""

    kb: readers.KnowledgeBase
    settings: Settings = field(default_factory=Settings)

    def search(self, queries: DataFrame, k: int | None = None, mention_boost: float | None = None, claims: bool | None = None) -> DataFrame:
        asked = {name: value for name, value in {"k": k, "mention_boost": mention_boost, "claims": claims}.items() if value is not None}
        return retrieve(self.kb, queries, replace(self.settings, **asked).checked())


def rendered(results: DataFrame) -> DataFrame:
    """(query_id, rank, line): how the command line shows a result."""
    via = F.when(F.col("via").isNotNull(), F.concat(F.lit(" via "), "via")).otherwise("")
    tag = F.concat(F.lit("["), "source", via, F.lit(" | hop "), F.col("hop").cast("string"), F.lit(" | "), F.col("score").cast("string"), F.lit("]"))
    head = F.coalesce(F.nullif("breadcrumb", F.lit("")), "title", "chunk_id", F.lit(""))
    return results.select("query_id", "rank", F.concat(tag, F.lit(" "), head, F.lit("\n    "), T.snippet(F.coalesce("text", F.lit("")))).alias("line"))


def tool_text(kb: readers.KnowledgeBase, question: str, settings: Settings) -> str:
    """The answer of a retrieval tool to one question, at most k excerpts, as text."""
    asked = kb.spark.createDataFrame([(0, question)], "query_id long, text string")
    rows = retrieve(kb, asked, settings).orderBy("rank").collect()
    blocks = [f"### {r['breadcrumb'] or r['title'] or r['chunk_id'] or ''}  [{r['source']}{' via ' + r['via'] if r['via'] else ''}]\n{r['text']}" for r in rows]
    return "\n\n".join(blocks) or NOTHING_FOUND
