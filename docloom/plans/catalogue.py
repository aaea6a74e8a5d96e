"""The query catalogue of the engine's own operators: what the driver runs, with its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docloom.functions import text as T
from docloom.operators import chunking, clustering, entities, graph, markdown, vectors, xref
from docloom.operators.ordering import numbered_within
from docloom.plans import oracles as S
from docloom.plans.spec_tables import alias_names, graph_edges, graph_seeds, spec_documents, table
from docloom.sources import readers

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
#: Sections of the catalogue's inputs stay whole below this many tokens, so that SQL can follow them; splitting has queries of its own.
WHOLE = 10**9


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def specs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spec_documents(table(spark, sf_dir, "documents"))


def chunks_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks are made again where a query reads them twice: that takes less time and room than to keep them."""
    return chunking.chunk_documents(specs(spark, sf_dir), WHOLE, WHOLE)


# scalar functions


@query(f"SELECT doc_id, {S.tokens('text')} AS token_count, CAST(len(regexp_extract_all(text, '\\S+')) AS INTEGER) AS words FROM documents")
def token_count_documents(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", T.token_count(F.col("text")).alias("token_count"), T.word_count(F.col("text")).alias("words"))


@query(f"SELECT p_partkey, {S.norm_title('p_name')} AS norm, {S.norm_title(chr(39) + 'The ' + chr(39) + ' || p_type')} AS norm_type FROM part")
def norm_title_parts(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", T.norm_title(F.col("p_name")).alias("norm"), T.norm_title(F.concat(F.lit("The "), "p_type")).alias("norm_type"))


@query(S.with_(S.NAMES, f"SELECT name, {S.canonical_key('name')} AS name_key FROM names"))
def canonical_key_part_names(spark, sf_dir):
    return alias_names(spark, sf_dir).select("name", T.canonical_key(F.col("name")).alias("name_key"))


@query(f"SELECT p_partkey, {S.slug('p_name')} AS slug, lpad(CAST(p_partkey AS VARCHAR), CAST(greatest(4, len(CAST(p_partkey AS VARCHAR))) AS INTEGER), '0') || '__' || {S.slug(chr(39) + '1.2-' + chr(39) + ' || p_name')} || '__' || substr(sha1(p_brand || ' > ' || p_name || '#p1'), 1, 6) AS chunk_id FROM part")
def slug_and_id(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", T.slug(F.col("p_name")).alias("slug"), T.chunk_id(F.col("p_partkey"), F.lit("1.2"), F.col("p_name"), F.concat_ws(" > ", "p_brand", "p_name"), F.lit(1)).alias("chunk_id"))


@query("SELECT doc_id, substr(trim(regexp_replace(text, '\\s+', ' ', 'g')), 1, 240) AS snippet FROM documents")
def snippet_projection(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", T.snippet(F.col("text")).alias("snippet"))


_LABEL = "CASE " + " ".join(f"WHEN contains(lower(t), '{n}') THEN '{v}'" for n, v in T.TASK_LABELS) + r" ELSE coalesce(nullif(substr(trim(regexp_replace(t, '\s+', ' ', 'g')), 1, 90), ''), 'llm-call') END"


@query(f"""WITH m AS (SELECT conv_id, coalesce(arg_min(text, turn) FILTER (role = 'system' AND text IS NOT NULL), arg_min(text, turn) FILTER (role = 'user' AND text IS NOT NULL), arg_min(text, turn) FILTER (text IS NOT NULL), '') AS t FROM conversations GROUP BY conv_id)
    SELECT conv_id, {_LABEL} AS label FROM m""")
def call_labels(spark, sf_dir):
    talks = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", F.col("text").alias("content")))).alias("messages"))
    return talks.select("conv_id", T.task_label(T.first_text(F.col("messages"))).alias("label"))


@query("SELECT event_type, count(*) AS started, count(*) FILTER (event_id % 3 <> 0) AS done, count(*) FILTER (event_id % 3 <> 0 AND value < 10) AS failed, greatest(0, count(*) - count(*) FILTER (event_id % 3 <> 0)) AS in_flight FROM events GROUP BY event_type")
def call_stats_by_type(spark, sf_dir):
    ended = F.col("event_id") % 3 != 0
    counted = table(spark, sf_dir, "events").groupBy("event_type").agg(F.count("*").alias("started"), F.count_if(ended).alias("done"), F.count_if(ended & (F.col("value") < 10)).alias("failed"))
    return counted.withColumn("in_flight", F.greatest(F.lit(0), F.col("started") - F.col("done")))


@query("""SELECT string_agg(type, ',' ORDER BY place) AS types FROM (SELECT type, min((side, pos)) AS place FROM (SELECT lang AS type, 0 AS side, doc_id AS pos FROM documents UNION ALL SELECT source, 1, doc_id FROM documents) WHERE type IS NOT NULL GROUP BY type)""")
def entity_types_distinct(spark, sf_dir):
    """Two lists of types, here the languages and the sources of documents, as one in which each stands once."""
    docs = table(spark, sf_dir, "documents")
    sides = [docs.select(F.lit(side).alias("side"), F.col("doc_id").alias("pos"), F.col(c).alias("type")) for side, c in enumerate(("lang", "source"))]
    return entities.ordered_types(sides[0].unionByName(sides[1]))


# Markdown


@query(f"SELECT doc_id, CAST(generate_subscripts(string_split(text, chr(10)), 1) - 1 AS INTEGER) AS pos, unnest(string_split(text, chr(10))) AS line FROM documents WHERE text IS NOT NULL")
def md_lines(spark, sf_dir):
    return markdown.lines(table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("md")))


@query(S.with_(S.spec() + S.LINES + S.HEADS, "SELECT doc_id, sec_pos, CAST(level AS INTEGER) AS level, raw_title, title, number FROM secs"))
def md_headings(spark, sf_dir):
    return markdown.sections(specs(spark, sf_dir)).where("level > 0").select("doc_id", "sec_pos", "level", "raw_title", "title", "number")


@query(S.with_(S.spec() + S.LINES + S.BLOCKS, "SELECT doc_id, pos, kind, text FROM blocks"))
def md_blocks(spark, sf_dir):
    return markdown.blocks(specs(spark, sf_dir))


@query(S.with_(S.spec() + S.LINES + S.BLOCKS, "SELECT doc_id, pos, CAST(len(string_split(text, chr(10))) AS INTEGER) AS n_rows FROM blocks WHERE kind = 'table'"))
def md_tables(spark, sf_dir):
    return markdown.blocks(specs(spark, sf_dir)).where("kind = 'table'").select("doc_id", "pos", F.size(F.split("text", "\n")).alias("n_rows"))


@query(S.with_(S.PARSED, "SELECT doc_id, sec_pos, level, title, number, coalesce(parent_pos, -2) AS parent_pos FROM tree"))
def section_tree(spark, sf_dir):
    return markdown.sections(specs(spark, sf_dir)).select("doc_id", "sec_pos", "level", "title", "number", F.coalesce("parent_pos", F.lit(-2)).alias("parent_pos"))


@query(S.with_(S.PARSED, "SELECT doc_id, sec_pos, crumbs AS breadcrumb FROM tree"))
def section_breadcrumbs(spark, sf_dir):
    return markdown.sections(specs(spark, sf_dir)).select("doc_id", "sec_pos", F.array_join("breadcrumb", " > ").alias("breadcrumb"))


@query(S.with_(S.CHUNKED, "SELECT doc_id, CAST(sec_pos AS INTEGER) AS sec_pos, count(*) AS n_blocks FROM owned WHERE kind <> 'heading' AND trim(text) <> '' GROUP BY doc_id, sec_pos"))
def sections_with_body(spark, sf_dir):
    return markdown.body_blocks(markdown.blocks(specs(spark, sf_dir))).groupBy("doc_id", "sec_pos").agg(F.count("*").alias("n_blocks"))


@query("""SELECT page_id, len(md) > 0 AS has_text, md FROM (SELECT page_id, trim(regexp_replace(regexp_replace(replace(replace(replace(replace(replace(replace(
    regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(h, '(?is)<b>(.*?)</b>', '**\\1**', 'g'), '(?is)<i>(.*?)</i>', '*\\1*', 'g'), '(?i)<br\\s*/?>', chr(10), 'g'), '(?is)<p[^>]*>(.*?)</p>', chr(10) || chr(10) || '\\1' || chr(10) || chr(10), 'g'), '(?is)<li[^>]*>(.*?)</li>', chr(10) || '- \\1', 'g'), '(?s)<[^>]+>', '', 'g'),
    '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&nbsp;', ' '), '&amp;', '&'), '[ \\t]+\\n', chr(10), 'g'), '\\n{3,}', chr(10) || chr(10), 'g'), ' ' || chr(10)) AS md
    FROM (SELECT page_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<nav[^>]*>.*?</nav>', '', 'g'), '(?is)<footer[^>]*>.*?</footer>', '', 'g'), '(?is)<(script[^>]*>.*?</script|head[^>]*>.*?</head|style[^>]*>.*?</style)>', '', 'g'),
    '(?is)<h1[^>]*>(.*?)</h1>', chr(10) || chr(10) || '# \\1' || chr(10) || chr(10), 'g'), '(?is)<h2[^>]*>(.*?)</h2>', chr(10) || chr(10) || '## \\1' || chr(10) || chr(10), 'g') AS h FROM pages))""")
def html_to_markdown(spark, sf_dir):
    pages = readers.pages(table(spark, sf_dir, "pages"))
    return pages.select(F.col("doc_id").alias("page_id"), (F.length("md") > 0).alias("has_text"), "md")


# chunks


@query(S.with_(S.CHUNKED, 'SELECT doc_id, ord AS "order", title, breadcrumb, section_no, level, token_count, text FROM chunks'))
def chunk_sections(spark, sf_dir):
    return chunks_of(spark, sf_dir).select("doc_id", "order", "title", "breadcrumb", "section_no", "level", "token_count", "text")


@query(S.with_(S.CHUNKED, "SELECT doc_id, chunk_id, 1 AS part, 1 AS n_parts FROM chunks"))
def chunk_ids(spark, sf_dir):
    return chunks_of(spark, sf_dir).select("doc_id", "chunk_id", "part", "n_parts")


@query(S.with_(S.CHUNKED, "SELECT doc_id, chunk_id AS id, breadcrumb AS title, text, '' AS creation_date, chunk_id AS raw_chunk_id, section_no AS raw_section_no FROM chunks"))
def documents_frame(spark, sf_dir):
    chunks = chunks_of(spark, sf_dir)
    return chunking.documents_frame(chunks).select(F.col("raw_data.doc_id").alias("doc_id"), "id", "title", "text", "creation_date", F.col("raw_data.chunk_id").alias("raw_chunk_id"), F.col("raw_data.section_no").alias("raw_section_no"))


@query()
def chunk_documents_split(spark, sf_dir):
    return chunking.chunk_documents(specs(spark, sf_dir), 120, 180).select("doc_id", "order", "chunk_id", "part", "n_parts", "token_count", "text")


@query()
def pack_blocks(spark, sf_dir):
    lines = table(spark, sf_dir, "documents").select("doc_id", F.transform(F.split("text", "\n", -1), lambda x: F.struct(F.lit("text").alias("kind"), x.alias("text"), T.token_count(x).alias("tok"))).alias("blocks"))
    return lines.select("doc_id", F.posexplode(chunking.pack_blocks(F.filter("blocks", lambda b: b["text"] != ""), F.lit(200), F.lit(300))).alias("part", "text"))


@query()
def split_text_lines(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.posexplode(chunking.split_lines(F.col("text"), F.lit(150))).alias("part", "text"))


@query()
def split_words(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.posexplode(chunking.split_words(F.col("text"), F.lit(150))).alias("part", "text"))


@query()
def split_table_rows(spark, sf_dir):
    rows = table(spark, sf_dir, "part").groupBy("p_brand").agg(F.array_join(F.array_sort(F.collect_list(F.concat(F.lit("| "), "p_name", F.lit(" | "), "p_type", F.lit(" |")))), "\n").alias("body"))
    whole = F.concat(F.lit("| name | type |\n| --- | --- |\n"), "body")
    return rows.select("p_brand", F.posexplode(chunking.split_table(whole, F.lit(200))).alias("part", "text"))


# cross-references


@query(S.with_(S.CHUNKED + S.INDEXES, "SELECT doc_id, number, dest AS target FROM sec_idx"))
def section_index(spark, sf_dir):
    return xref.section_index(chunks_of(spark, sf_dir))


@query(S.with_(S.CHUNKED + S.INDEXES, "SELECT doc_id, norm, dest AS target FROM title_idx"))
def title_index(spark, sf_dir):
    return xref.title_index(chunks_of(spark, sf_dir))


@query(S.with_(S.CHUNKED + S.INDEXES, "SELECT 'figure' AS kind, doc_id, number, dest AS target FROM figure_cap UNION ALL SELECT 'table', doc_id, number, dest FROM table_cap"))
def caption_index(spark, sf_dir):
    chunks = chunks_of(spark, sf_dir)
    figure, tables = (xref.caption_index(chunks, k).select(F.lit(k).alias("kind"), "doc_id", "number", "target") for k in ("figure", "table"))
    return figure.unionByName(tables)


def _refs(detector: int):
    def run(spark, sf_dir):
        return xref.numbered_refs(chunks_of(spark, sf_dir), detector).select("doc_id", "chunk_id", "raw", "number")

    run.__name__ = ("refs_section", "refs_figure", "refs_table")[detector]
    return query(S.with_(S.CHUNKED + S.INDEXES + S.REFS, f"SELECT doc_id, chunk_id, raw, number FROM r{detector}"))(run)


refs_section, refs_figure, refs_table = (_refs(i) for i in range(3))


@query(S.with_(S.CHUNKED + S.INDEXES + S.NAMED, "SELECT doc_id, chunk_id, raw, dest AS target FROM r3"))
def refs_named_config(spark, sf_dir):
    chunks = chunks_of(spark, sf_dir)
    return xref.phrase_refs(chunks, S.PHRASES).join(xref.title_index(chunks), ["doc_id", "norm"], "left").select("doc_id", "chunk_id", "raw", "target")


@query(S.with_(S.CHUNKED + S.INDEXES + S.CUES, "SELECT doc_id, chunk_id, raw, dest AS target FROM r4"))
def refs_cue_resolved(spark, sf_dir):
    chunks = chunks_of(spark, sf_dir)
    return xref.cue_refs(chunks, xref.title_index(chunks)).select("doc_id", "chunk_id", "raw", "target")


@query(S.with_(S.CHUNKED + S.INDEXES + S.REFS + S.edges("0"), "SELECT doc_id, src_chunk_id, dst_chunk_id, ref_text, resolved FROM edges"))
def xref_section_edges(spark, sf_dir):
    chunks = chunks_of(spark, sf_dir)
    return xref.edges(xref.references(chunks).where("edge_type = 'references_section'")).select("doc_id", "src_chunk_id", "dst_chunk_id", "ref_text", "resolved")


@query(S.with_(S.LINKED, "SELECT * FROM edges"))
def xref_edges_all(spark, sf_dir):
    return xref.edges(xref.references(chunks_of(spark, sf_dir), S.PHRASES))


@query(S.with_(S.LINKED, "SELECT doc_id, src_chunk_id, edge_type, ref_text FROM edges WHERE NOT resolved"))
def dangling_refs(spark, sf_dir):
    return xref.edges(xref.references(chunks_of(spark, sf_dir), S.PHRASES)).where("not resolved").select("doc_id", "src_chunk_id", "edge_type", "ref_text")


@query(S.with_(S.LINKED, "SELECT doc_id, dst_chunk_id AS chunk_id, string_agg(src_chunk_id || '/' || edge_type || '/' || ref_text, ';' ORDER BY edge_ord) AS refs_in FROM edges WHERE resolved GROUP BY doc_id, dst_chunk_id"))
def backlinks(spark, sf_dir):
    found = xref.backlinks(xref.references(chunks_of(spark, sf_dir), S.PHRASES))
    return found.select("doc_id", "chunk_id", F.array_join(F.transform("refs_in", lambda x: F.concat_ws("/", x["src_chunk_id"], x["ref_type"], x["raw_text"])), ";").alias("refs_in"))


@query(S.with_(S.LINKED + S.MENTIONED, "SELECT * FROM mentioned"))
def mentions(spark, sf_dir):
    chunks = chunks_of(spark, sf_dir)
    return xref.mentions(chunks, xref.references(chunks, S.PHRASES))


@query()
def inline_titles(spark, sf_dir):
    chunks = chunks_of(spark, sf_dir)
    return xref.inline_titles(chunks, xref.references(chunks, S.PHRASES)).select("doc_id", "chunk_id", "text")


@query(S.with_(S.LINKED, "SELECT edge_type, count(*) AS n_edges, count(*) FILTER (resolved) AS n_resolved FROM edges GROUP BY edge_type"))
def xref_stats(spark, sf_dir):
    return xref.stats(xref.edges(xref.references(chunks_of(spark, sf_dir), S.PHRASES)))


# graph and retrieval


def _hits(spark, sf_dir, **parameters):
    return graph.expand(graph_edges(spark, sf_dir), graph_seeds(spark, sf_dir), **parameters)


@query(S.with_(S.GRAPH, "SELECT query_id, chunk_id, direction FROM hits WHERE hop = 1"))
def reach_depth1(spark, sf_dir):
    return _hits(spark, sf_dir, depth=1).select("query_id", "chunk_id", "direction")


@query(S.with_(S.GRAPH, "SELECT query_id, chunk_id, CAST(hop AS INTEGER) AS hop FROM hits"))
def reach_depth2(spark, sf_dir):
    return _hits(spark, sf_dir, depth=2).select("query_id", "chunk_id", "hop")


@query(S.with_(S.GRAPH, "SELECT query_id, chunk_id, CAST(hop AS INTEGER) AS hop, direction, via, edge_type, round(score, 6) AS score, found_pos FROM hits"))
def expand_scored(spark, sf_dir):
    return _hits(spark, sf_dir, depth=2).withColumn("score", F.round("score", 6)).select(*graph.HITS)


@query()
def expand_budgeted(spark, sf_dir):
    edges = graph_edges(spark, sf_dir)
    costs = edges.select(F.explode(F.array("src_chunk_id", "dst_chunk_id")).alias("node")).distinct().withColumn("cost", F.length("node") + 10)
    return graph.expand(edges, graph_seeds(spark, sf_dir), costs, depth=2, budget=3200)


@query("SELECT c_nationkey AS query_id, 'C' || c_custkey AS node, CAST(row_number() OVER w AS INTEGER) AS pos, (count(*) OVER (PARTITION BY c_nationkey) - row_number() OVER w + 1)::DOUBLE AS score FROM customer WINDOW w AS (PARTITION BY c_nationkey ORDER BY c_custkey)")
def seed_scores(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("query_id"), F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("node"), F.col("c_custkey").alias("pos"))
    return graph.seed_scores(rows.unionByName(rows.withColumn("pos", F.col("pos") + 10**9)))


@query(S.with_(S.GRAPH, "SELECT query_id, chunk_id, round(CASE WHEN CAST(substr(chunk_id, 2) AS BIGINT) % 25 = query_id THEN score * 1.25 ELSE score END, 6) AS score FROM hits"))
def mention_boost(spark, sf_dir):
    hits = _hits(spark, sf_dir, depth=2)
    mentioned = hits.select("chunk_id", (F.substring("chunk_id", 2, 20).cast("long") % 25).alias("key")).distinct()
    keys = graph_seeds(spark, sf_dir).select("query_id", F.col("query_id").cast("long").alias("key")).distinct()
    return graph.boosted(hits, mentioned, keys).select("query_id", "chunk_id", F.round("score", 6).alias("score"))


@query(S.with_(S.GRAPH, """SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY bucket, o1, o2, o3) AS INTEGER) AS rank, chunk_id, source FROM (
    SELECT query_id, 0 AS bucket, pos AS o1, 0.0 AS o2, 0 AS o3, node AS chunk_id, 'local_search' AS source FROM seeds WHERE pos <= 5
    UNION ALL SELECT query_id, 2, hop, -round(score, 9), found_pos, chunk_id, direction FROM hits) QUALIFY rank <= 12"""))
def retrieve_topk(spark, sf_dir):
    seeds = graph_seeds(spark, sf_dir)
    hits = graph.expand(graph_edges(spark, sf_dir), seeds).withColumn("score", F.round("score", 9))
    return graph.fused(seeds.where("pos <= 5"), None, hits, 12).select("query_id", "rank", "chunk_id", "source")


@query(S.with_(S.CHUNKED, r"SELECT doc_id, chunk_id, trim(regexp_replace(s, '\s+', ' ', 'g')) AS statement FROM (SELECT doc_id, chunk_id, unnest(string_split(regexp_replace(text, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1))) AS s FROM chunks) WHERE regexp_matches(s, '\b(shall|should|may|must)\b')"))
def claims_normative(spark, sf_dir):
    return entities.claims(chunks_of(spark, sf_dir)).select("doc_id", "chunk_id", "statement")


@query("""SELECT conv_id AS query_id, 'Normative requirements / claims relevant to the query:' || chr(10) || string_agg('- [' || role || '] ' || trim(text), chr(10) ORDER BY turn) AS text, count(*) AS n_claims
    FROM (SELECT * FROM conversations QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn) <= 40) WHERE trim(text) <> '' GROUP BY conv_id""")
def claims_doc(spark, sf_dir):
    said = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("query_id"), F.col("turn").alias("pos"), F.col("role").alias("subject"), F.col("text").alias("statement"))
    return graph.claims_document(said)


# entities


_ALIASES = f"""{S.NAMES}
    keyed AS (SELECT *, {S.canonical_key('name')} AS name_key FROM names),
    best AS (SELECT name_key, arg_max(name, (len(name), name)) AS canonical FROM keyed GROUP BY name_key),"""


@query(S.with_(_ALIASES, f"SELECT name, k.name_key, canonical, {S.canonical_key('canonical')} AS canonical_key, id FROM keyed k JOIN best b ON k.name_key = b.name_key"))
def entity_aliases(spark, sf_dir):
    return entities.aliases(alias_names(spark, sf_dir))


_VECTORS = """
    ordered AS (SELECT name_key, canonical, row_number() OVER (ORDER BY name_key) AS key_ord FROM best),
    vecs AS (SELECT o.name_key, canonical, key_ord, e.embedding AS vec, list_filter(string_split(o.name_key, ' '), lambda w: w <> '') AS words FROM ordered o JOIN embeddings e ON e.vec_id = o.key_ord % 100),
    pairs AS (SELECT a.name_key, b.canonical AS merged, list_inner_product(a.vec::DOUBLE[], b.vec::DOUBLE[]) AS sim, b.key_ord FROM vecs a JOIN vecs b ON len(b.words) > len(a.words) AND list_has_all(b.words, a.words)),"""


@query(S.with_(_ALIASES + _VECTORS, "SELECT o.name_key, coalesce(m.merged, o.canonical) AS canonical FROM ordered o LEFT JOIN (SELECT name_key, arg_max(merged, (sim, key_ord)) AS merged FROM pairs WHERE sim >= 0.2 GROUP BY name_key) m ON o.name_key = m.name_key"))
def alias_tier3(spark, sf_dir):
    canonical = entities.canonical_names(alias_names(spark, sf_dir))
    key_ord = F.row_number().over(Window.orderBy("name_key"))  # a fixture: at most a few hundred names
    keyed = canonical.withColumn("key_ord", key_ord).withColumn("vec_id", F.col("key_ord") % 100)
    vecs = keyed.join(table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("vec")), "vec_id").select("name_key", "key_ord", "vec")
    return entities.merged_by_vectors(canonical, vecs, 0.2)


_NEAREST = """SELECT q.vec_id AS query_id, CAST(row_number() OVER (PARTITION BY q.vec_id ORDER BY list_inner_product(q.embedding::DOUBLE[], b.embedding::DOUBLE[]) DESC, b.vec_id) AS INTEGER) AS rank, b.vec_id AS id,
    round(list_inner_product(q.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) AS score FROM embeddings q, embeddings b WHERE q.vec_id % 20 = 0 QUALIFY rank <= 10"""


@query(_NEAREST)
def vector_topk(spark, sf_dir):
    """The ten nearest rows of every row whose id is divisible by 20."""
    base = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vec"))
    asked = base.where("id % 20 = 0").withColumnRenamed("id", "query_id")
    return vectors.top_k(base, asked, 10).withColumn("score", F.round("score", 6))


@query(_NEAREST)
def vector_topk_every20(spark, sf_dir):
    """The earlier name of the same search."""
    return vector_topk(spark, sf_dir)


@query("SELECT x.l_partkey AS a, y.l_partkey AS b, count(*) AS weight FROM (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem) x JOIN (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem) y ON x.l_orderkey = y.l_orderkey AND x.l_partkey < y.l_partkey GROUP BY 1, 2")
def cooccurrence_graph(spark, sf_dir):
    return entities.co_occurrence(table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("group_id"), F.col("l_partkey").alias("item")))


_COMMUNITIES = """
    e AS (SELECT DISTINCT l_partkey AS a, 1000000 + l_suppkey AS b FROM lineitem),
    u AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
    c0 AS (SELECT DISTINCT a AS node, a AS c FROM u),
    c1 AS (SELECT c0.node, least(c0.c, min(n.c)) AS c FROM c0 JOIN u ON u.a = c0.node JOIN c0 n ON n.node = u.b GROUP BY c0.node, c0.c),
    c2 AS (SELECT c1.node, least(c1.c, min(n.c)) AS c FROM c1 JOIN u ON u.a = c1.node JOIN c1 n ON n.node = u.b GROUP BY c1.node, c1.c),
    c3 AS (SELECT c2.node, least(c2.c, min(n.c)) AS c FROM c2 JOIN u ON u.a = c2.node JOIN c2 n ON n.node = u.b GROUP BY c2.node, c2.c),"""


def _part_suppliers(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("a"), (F.col("l_suppkey") + 1000000).alias("b")).distinct()


@query(S.with_(_COMMUNITIES, "SELECT node, c AS community FROM c3"))
def communities_min_label(spark, sf_dir):
    """Three rounds of label propagation over the edges of the whole table."""
    return graph.label_propagation(_part_suppliers(spark, sf_dir), rounds=3)


@query(S.with_(_COMMUNITIES, """SELECT s.community, s.size, coalesce(i.n, 0) AS n_edges, 'Community ' || s.community || ' has ' || s.size || ' members and ' || coalesce(i.n, 0) || ' relationships.' AS report
    FROM (SELECT c AS community, count(*) AS size FROM c3 GROUP BY c) s LEFT JOIN (SELECT x.c AS community, count(*) AS n FROM e JOIN c3 x ON x.node = e.a JOIN c3 y ON y.node = e.b AND x.c = y.c GROUP BY x.c) i ON s.community = i.community"""))
def community_reports(spark, sf_dir):
    edges = _part_suppliers(spark, sf_dir)
    return entities.community_reports(graph.label_propagation(edges, rounds=3), edges)


@query()
def community_levels(spark, sf_dir):
    """Parts and suppliers as communities by modularity, split until none has more than ten members."""
    edges = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("a"), (F.col("l_suppkey") + 1000000).alias("b"), F.lit(1.0).alias("weight"))
    return clustering.clusters(edges, most=10, rounds=4)


@query("SELECT l_returnflag, l_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_returnflag ORDER BY l_orderkey, l_linenumber) AS n FROM lineitem")
def running_numbers(spark, sf_dir):
    """The running order of the items of each return flag, of which there are few and large ones."""
    return numbered_within(table(spark, sf_dir, "lineitem").select("l_returnflag", "l_orderkey", "l_linenumber"), ["l_returnflag"], ["l_orderkey", "l_linenumber"], "n")


_WHOLE_COMMUNITIES = "e AS (SELECT DISTINCT l_partkey AS a, 1000000 + l_suppkey AS b FROM lineitem), u AS (SELECT a, b FROM e UNION SELECT b, a FROM e), c0 AS (SELECT DISTINCT a AS node, a AS c FROM u)," + "".join(
    f" c{i + 1} AS (SELECT l.node, least(l.c, min(n.c)) AS c FROM c{i} l JOIN u ON u.a = l.node JOIN c{i} n ON n.node = u.b GROUP BY l.node, l.c)," for i in range(5)
)


@query(S.with_(_WHOLE_COMMUNITIES, "SELECT node, c AS community FROM c5"))
def communities_whole(spark, sf_dir):
    """As communities_min_label, with the operator's own number of rounds."""
    return graph.label_propagation(_part_suppliers(spark, sf_dir))


@query(S.with_(_WHOLE_COMMUNITIES, """SELECT s.community, s.size, coalesce(i.n, 0) AS n_edges, 'Community ' || s.community || ' has ' || s.size || ' members and ' || coalesce(i.n, 0) || ' relationships.' AS report
    FROM (SELECT c AS community, count(*) AS size FROM c5 GROUP BY c) s LEFT JOIN (SELECT x.c AS community, count(*) AS n FROM e JOIN c5 x ON x.node = e.a JOIN c5 y ON y.node = e.b AND x.c = y.c GROUP BY x.c) i ON s.community = i.community"""))
def community_reports_whole(spark, sf_dir):
    """As community_reports, over the communities and edges of communities_whole."""
    edges = _part_suppliers(spark, sf_dir)
    return entities.community_reports(graph.label_propagation(edges), edges)


@query("""SELECT p_brand AS title, string_agg(description, ' ' ORDER BY ord) AS description FROM (SELECT p_brand, p_type AS description, min(p_partkey) AS ord FROM part GROUP BY p_brand, p_type) GROUP BY p_brand""")
def described_entities(spark, sf_dir):
    return entities.described(table(spark, sf_dir, "part").select(F.col("p_brand").alias("title"), F.col("p_partkey").alias("ord"), F.col("p_type").alias("description")))


@query("SELECT prefix, arg_max(doc_id, doc_id) AS chunk_id FROM (SELECT doc_id, substr(trim(regexp_replace(text, '\\s+', ' ', 'g')), 1, 80) AS prefix FROM documents) WHERE prefix <> '' GROUP BY prefix")
def prefix_index(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("text", F.col("doc_id").alias("order"), F.col("doc_id").alias("chunk_id"))
    return readers.by_prefix(rows)


@query()
def hashed_embeddings(spark, sf_dir):
    return table(spark, sf_dir, "benchmark").select("item_id", vectors.hashed_vector(F.col("text"), 32).alias("vec"))
