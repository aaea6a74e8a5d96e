"""The engine's own rules on small literal documents."""

import random
from collections import deque

import pytest
from pyspark.sql import functions as F

from docloom.functions import text as T
from docloom.operators import chunking, entities, graph, markdown, vectors, xref
from docloom.plans import catalogue
from docloom.plans import knowledge_base as plans
from docloom.sources import readers


def column(spark, f, *values):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.x for r in rows.select("i", f(F.col("v")).alias("x")).orderBy("i").collect()]


def test_scalars(spark):
    assert column(spark, T.token_count, "", " ", "one", "a b c d e f g h i j", None) == [0, 1, 2, 13, 0]
    assert column(spark, T.norm_title, "  The Status-Code  Table ", "An A") == ["status code table", "a"]
    assert column(spark, T.canonical_key, "the Identify commands", "namespaces", "namespace", "addresses", "Entries", "host's", "host’s id", None) == ["identify command", "namespac", "namespace", "addresse", "entry", "host", "host id", ""]
    assert column(spark, T.section_number, "5.21.1 Abort", "2024 Roadmap", "A.1 Foo", "5. X") == ["5.21.1", "2024", None, "5"]
    assert column(spark, T.section_title, "5.21.1 Abort", "A.1 Foo") == ["Abort", "A.1 Foo"]
    assert column(spark, T.slug, "Hello,  World!", "---", "x" * 60) == ["hello-world", "section", "x" * 48]
    assert column(spark, T.task_label, "List the claims and entities", "Entity list", "Say  hi", "") == ["extract_claims", "extract_graph", "Say hi", "llm-call"]


MIXED = ["# A", "#A", " # A", "####### x", "```", "~~~ py", "````", "| a | b |", "| --- | --- |", "---", "text", "", "  ", "a | b", "# h | i", "| - |", "-- | --"]


def by_hand(lines):
    """What blocks there are, by a reading with a cursor."""
    import re

    out, i = [], 0

    def table_at(j):
        s = lines[j].strip()
        return "|" in s and not s.startswith("#") and j + 1 < len(lines) and re.match(markdown.RULE, lines[j + 1])

    while i < len(lines):
        j = i + 1
        if f := re.match(markdown.FENCE, lines[i]):
            while j < len(lines) and not lines[j].strip().startswith(f[1]):
                j += 1
            j, kind = min(j + 1, len(lines)), "code"
        elif re.match(markdown.HEADING, lines[i]):
            kind = "heading"
        elif table_at(i):
            j, kind = i + 2, "table"
            while j < len(lines) and "|" in lines[j] and not lines[j].strip().startswith("#"):
                j += 1
        elif not lines[i].strip():
            i = j
            continue
        else:
            kind = "text"
            while j < len(lines) and lines[j].strip() and not re.match(markdown.HEADING, lines[j]) and not re.match(markdown.FENCE, lines[j]) and not table_at(j):
                j += 1
        out.append((i, kind, "\n".join(lines[i:j])))
        i = j
    return out


def test_blocks_like_a_reading_by_hand(spark):
    rng = random.Random(1)
    docs = [[rng.choice(MIXED if n % 2 else [m for m in MIXED if m[:1] not in "`~" and m != "---"]) for _ in range(rng.randint(1, 14))] for n in range(400)]
    for lines in docs:
        assert markdown.read_blocks(lines) == by_hand(lines)
    rows = spark.createDataFrame([(n, "\n".join(lines)) for n, lines in enumerate(docs)], "doc_id long, md string")
    got = {}
    for r in markdown.blocks(rows).orderBy("doc_id", "pos").collect():
        got.setdefault(r.doc_id, []).append((r.pos, r.kind, r.text))
    assert all(got.get(n, []) == by_hand(lines) for n, lines in enumerate(docs))


SPEC = """intro words

# 5 Commands

## 5.21 Admin Command

See Section 5.21.1 and Figure 12. Refer to Section 9.9.9.

| a | b |
| --- | --- |
| 1 | 2 |

### 5.21.1 Abort command

As defined in Admin Command Set, see Section 5.21.1. The host shall stop.

Table 45: Codes

Figure 12: Flow
"""


@pytest.fixture(scope="module")
def chunks(spark):
    return chunking.chunk_documents(spark.createDataFrame([(1, "Spec", SPEC)], "doc_id long, doc_title string, md string")).cache()


def test_chunks(chunks):
    got = chunks.orderBy("order").collect()
    assert [r.title for r in got] == ["Spec", "Admin Command", "Abort command"]
    assert got[2].breadcrumb == "Spec > Commands > Admin Command > Abort command" and got[2].section_no == "5.21.1" and got[2].level == 3
    assert got[1].text.startswith("> Context: Spec > Commands > Admin Command\n\n## 5.21 Admin Command\n\nSee Section")
    assert got[1].chunk_id.startswith("0002__5-21-admin-command__") and len({r.chunk_id for r in got}) == 3


def test_references(chunks):
    ids = {r.title: r.chunk_id for r in chunks.collect()}
    admin, abort = ids["Admin Command"], ids["Abort command"]
    refs = xref.references(chunks, ["abort command", "host shall"])
    got = {(r.chunk_id, r.raw): (r.target, r.resolved, r.weight) for r in refs.collect()}
    assert got[admin, "Section 5.21.1"] == (abort, True, 1.0) and got[admin, "Section 9.9.9"] == (None, False, 1.0)
    assert got[admin, "Figure 12"] == (abort, True, 0.9) and got[abort, "Figure 12"][1] is False and got[abort, "Table 45"][1] is False
    assert got[abort, "Section 5.21.1"] == (None, False, 1.0)
    assert got[abort, "Admin Command Set, see Section 5"][0] == admin and got[abort, "host shall"] == (None, False, 0.8)
    done, edges = xref.process(chunks, ["abort command"])
    rows = {r.chunk_id: r for r in done.collect()}
    assert "Section 5.21.1 (Abort command) and" in rows[admin].text
    assert [(b.src_chunk_id, b.ref_type) for b in rows[abort].refs_in][0] == (admin, "references_section")
    assert [m.name for m in rows[abort].mentioned_entities if m.source == "title_vocab"] == ["Admin Command"]
    assert edges.count() == sum(len(r.refs_out) for r in rows.values())
    assert xref.process(chunks, ["abort command"], enabled=False)[1].count() == 0


def test_splitting(spark):
    def cost(text):
        return 0 if not text else max(1, -(-len(text.split()) * 13 // 10))

    def greedy(items, budget, joiner, base=0):
        parts, held, used = [], [], base
        for item in items:
            if held and used + cost(item) + 1 > budget:
                parts, held, used = [*parts, joiner.join(held)], [], base
            held, used = [*held, item], used + cost(item) + 1
        return [*parts, joiner.join(held)] if held else parts

    rng = random.Random(2)
    texts = ["\n".join(" ".join("w" * rng.randint(1, 3) for _ in range(rng.choice([0, 1, 3, 40]))) for _ in range(rng.randint(1, 9))) for _ in range(60)]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", chunking.split_words(F.col("t"), F.lit(12)).alias("w"), chunking.split_lines(F.col("t"), F.lit(12)).alias("l"), chunking.split_table(F.col("t"), F.lit(30)).alias("b"))
    for r in rows.collect():
        text, want, run = texts[r.i], [], []
        assert r.w == greedy(text.split(" "), 12, " ")
        for line in text.split("\n"):
            if cost(line) + 1 > 12:
                want += [*greedy(run, 12, "\n"), *greedy(line.split(" "), 12, " ")]
                run = []
            else:
                run.append(line)
        assert r.l == [*want, *greedy(run, 12, "\n")]
        lines = text.split("\n")
        head = "\n".join(lines[:2])
        assert r.b == ([text] if len(lines) < 3 else [f"{head}\n{p}" for p in greedy(lines[2:], 30, "\n", cost(head + "\n"))])


def test_oversized_sections_split(spark):
    table = "| n | v |\n| --- | --- |\n" + "\n".join(f"| row{i} | value {i} |" for i in range(60))
    got = chunking.chunk_documents(spark.createDataFrame([(1, "D", f"# 1 Big\n\nfew words\n\n{table}")], "doc_id long, doc_title string, md string"), 60, 80).orderBy("order").collect()
    assert len(got) > 3 and [r.part for r in got] == list(range(1, len(got) + 1)) and {r.n_parts for r in got} == {len(got)}
    assert all("| n | v |\n| --- | --- |" in r.text for r in got[1:]) and all(f"part {r.part} of {r.n_parts}" in r.text for r in got[1:])
    assert sum(r.text.count("| row") for r in got) == 60


def walk(edges, seeds, costs, depth, decay, budget):
    """A queue over one query's graph."""
    visited, hits, spent, queue = set(seeds), {}, 0, deque((s, 0, float(v)) for s, v in seeds.items())
    while queue:
        node, hop, score = queue.popleft()
        if hop == depth:
            continue
        for incoming in (False, True):
            for src, dst, weight in edges:
                here, there = (dst, src) if incoming else (src, dst)
                if here != node or there in visited or (budget and hits and spent + costs.get(there, 0) > budget):
                    continue
                visited.add(there)
                spent += costs.get(there, 0)
                hits[there] = (hop + 1, round(score * decay ** (hop + 1) * weight, 9))
                queue.append((there, hop + 1, score * decay ** (hop + 1) * weight))
    return hits


@pytest.mark.parametrize("budget", [0, 1, 30, 80])
def test_expansion_like_a_queue(spark, budget):
    rng = random.Random(budget)
    nodes = [f"n{i}" for i in range(14)]
    edges = [(rng.choice(nodes), rng.choice(nodes), rng.choice([1.0, 0.9, 0.8])) for _ in range(30)]
    costs = {n: rng.randint(1, 25) for n in nodes[:12]}
    rows = spark.createDataFrame([(s, d, "t", "via", True, w, i) for i, (s, d, w) in enumerate(edges)] + [("n0", "n13", "t", "x", False, 1.0, 99)], "src_chunk_id string, dst_chunk_id string, edge_type string, ref_text string, resolved boolean, weight double, edge_ord long")
    asked = {q: {n: 5.0 - i for i, n in enumerate(rng.sample(nodes, rng.randint(1, 3)))} for q in range(12)}
    seeds = spark.createDataFrame([(q, n, i, s) for q, of in asked.items() for i, (n, s) in enumerate(of.items())], "query_id long, node string, pos int, score double")
    got = {}
    for r in graph.expand(rows, seeds, spark.createDataFrame(list(costs.items()), "node string, cost int"), 3, 0.5, budget).collect():
        got.setdefault(r.query_id, {})[r.chunk_id] = (r.hop, round(r.score, 9))
    assert all(got.get(q, {}) == walk(edges, of, costs, 3, 0.5, budget) for q, of in asked.items())


def test_fusion_order_and_cut(spark):
    seeds = spark.createDataFrame([(1, "a", 1, 2.0), (1, "b", 2, 1.0)], "query_id long, node string, pos int, score double")
    hits = spark.createDataFrame([(1, "c", 2, "xref_out", "v", "t", 9.0, 1), (1, "d", 1, "xref_in", "", "t", 0.00005, 2), (1, "a", 1, "xref_in", "", "t", 5.0, 3)], "query_id long, chunk_id string, hop int, direction string, via string, edge_type string, score double, found_pos long")
    claims = graph.claims_document(spark.createDataFrame([(1, i, "s" if i else None, f"c{i} " if i % 2 else " ") for i in range(50)], "query_id long, pos int, subject string, statement string"))
    got = graph.fused(seeds, claims, hits, 0).orderBy("rank").collect()
    assert [r.chunk_id for r in got] == ["a", "b", None, "d", "c"] and got[3].score == 0.0001 and got[3].via is None and got[2].n_claims == 20 and "- [s] c39" in got[2].text
    assert [r.chunk_id for r in graph.fused(seeds, claims, hits, 2).orderBy("rank").collect()] == ["a", "b"]


def test_aliases_and_vector_merge(spark):
    names = spark.createDataFrame([("Identify", 1, "x"), ("the Identify", 2, "y"), ("Identify Command", 3, "z"), ("identify commands", 4, "w"), ("Identify", 5, "v")], "name string, ord int, id string")
    got = {r.name: (r.canonical, r.id) for r in entities.aliases(names).collect()}
    assert got == {"Identify": ("the Identify", "x"), "the Identify": ("the Identify", "y"), "Identify Command": ("identify commands", "z"), "identify commands": ("identify commands", "w")}
    canonical = entities.canonical_names(names)
    vecs = spark.createDataFrame([("identify", 1, [1.0, 0.0]), ("identify command", 2, [0.95, 0.3122])], "name_key string, key_ord int, vec array<double>")
    assert {r.name_key: r.canonical for r in entities.merged_by_vectors(canonical, vecs).collect()} == {"identify": "identify commands", "identify command": "identify commands"}
    assert {r.name_key: r.canonical for r in entities.merged_by_vectors(canonical, vecs, 0.99).collect()}["identify"] == "the Identify"


def test_vectors(spark):
    base = spark.createDataFrame([(i, [float(i % 5), 1.0]) for i in range(40)], "id long, vec array<float>")
    asked = spark.createDataFrame([(q, [1.0, float(q)]) for q in range(5)], "query_id long, vec array<float>")
    got = vectors.top_k(base, asked, 3, most_queries=2)
    assert [(r.rank, r.id) for r in got.where("query_id = 3").orderBy("rank").collect()] == [(1, 4), (2, 9), (3, 14)] and got.count() == 15
    unit = spark.createDataFrame([("a b a",), ("",)], "t string").select(vectors.hashed_vector(F.col("t"), 8).alias("v")).collect()
    assert abs(sum(x * x for x in unit[0].v) - 1) < 1e-6 and sum(unit[1].v) == 0


def test_html(spark):
    html = "<html><head><title>t</title></head><body><nav>menu</nav><h2 class='x'>Head &amp; tail</h2><p>One <b>two</b></p><br/><ul><li>three</li></ul><footer>f</footer></body></html>"
    assert column(spark, markdown.html_to_markdown, html) == ["## Head & tail\n\nOne **two**\n\n- three"]


def test_build_and_retrieve(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "My_Spec.md").write_text(SPEC, encoding="utf-8")
    docs = readers.markdown_files(spark, str(tmp_path / "in"))
    assert docs.first().doc_title == "My Spec"
    settings = plans.Settings(named_references=["abort command"], merge_threshold=0.9)
    told = plans.build(spark, chunking.chunk_documents(docs), str(tmp_path / "kb"), settings).first()
    assert told.n_chunks == 3 and told.xref_edges > 3 and told.entity_aliases
    kb = readers.KnowledgeBase(spark, str(tmp_path / "kb"))
    kb.register()
    assert spark.sql("SELECT count(*) FROM kb_chunks").first()[0] == 3
    found = plans.retrieve(kb, spark.createDataFrame([(7, "Abort command"), (8, "admin command")], "query_id long, text string"), settings)
    got = found.orderBy("query_id", "rank").collect()
    assert {r.query_id for r in got} == {7, 8} and got[0].source == "local_search" and any(r.source == "claims" and "shall stop" in r.text for r in got)
    assert all(r.line.startswith("[") for r in plans.rendered(found).collect())
    assert "### " in plans.tool_text(kb, "Abort command", settings)
    with pytest.raises(FileNotFoundError):
        readers.KnowledgeBase(spark, str(tmp_path / "in"))
    with pytest.raises(ValueError):
        plans.build(spark, chunking.chunk_documents(docs).limit(0), str(tmp_path / "none"), settings)


def test_documents_whose_chunk_ids_agree(spark, tmp_path):
    """Two copies of one specification under other document ids: every chunk id occurs twice, and nothing crosses over."""
    docs = spark.createDataFrame([(1, "Spec", SPEC), (2, "Spec", SPEC.replace("The host shall stop.", "The host shall go."))], "doc_id long, doc_title string, md string")
    settings = plans.Settings(claims=True)
    told = plans.build(spark, chunking.chunk_documents(docs), str(tmp_path / "kb"), settings).first()
    kb = readers.KnowledgeBase(spark, str(tmp_path / "kb"))
    assert told.n_chunks == 6 and kb.chunks.select("chunk_id").distinct().count() == 3 and told.n_folded_names == 0
    got = plans.Retriever(kb, settings).search(spark.createDataFrame([(7, "Abort command")], "query_id long, text string"), k=0).collect()
    chunks = [(r.doc_id, r.chunk_id) for r in got if r.chunk_id]
    assert len(chunks) == len(set(chunks)) == 6 and all(r.text for r in got)
    assert all(("shall stop" in r.text) <= (r.doc_id == 1) for r in got if r.chunk_id)
    assert not any(r.source == "claims" for r in plans.Retriever(kb, settings).search(spark.createDataFrame([(7, "Abort command")], "query_id long, text string"), claims=False).collect())
    # a knowledge base made elsewhere: lists of unit ids, one of them known by the beginning of its text only
    units = {r.id: r.text for r in kb.text_units.collect()}
    kb.entity_units, kb.entities = None, kb.entities.withColumn("text_units", F.array(*(F.lit(u) for u in sorted(units)[:2])))
    kb.text_units = spark.createDataFrame([(u, None if i == 0 else u, t) for i, (u, t) in enumerate(sorted(units.items()))], "id string, document_id string, text string")
    found = {r.node for r in plans.entity_units(kb).collect()}
    assert sorted(units)[1] in found and len(found) == 2


def test_settings_and_index(spark, tmp_path):
    from docloom import cli

    for wrong in ('{"k": "five"}', '{"claims": 1}', '{"nothing": 1}', '{"max_tokens": 5}', '{"k": ${NOT_SET_ANYWHERE}}'):
        (tmp_path / "s.json").write_text(wrong)
        with pytest.raises(ValueError):
            cli.settings_from(str(tmp_path / "s.json"))
    (tmp_path / "s.json").write_text('{"hop_decay": 1, "named_references": ["a"], "merge_threshold": null}')
    assert cli.settings_from(str(tmp_path / "s.json")).named_references == ["a"]
    chunks = chunking.chunk_documents(spark.createDataFrame([(1, "Spec", SPEC)], "doc_id long, doc_title string, md string"))
    plans.build(spark, chunks, str(tmp_path / "a"), plans.Settings(chunk_files=True))
    assert sorted(p.read_text() for p in (tmp_path / "a" / "chunks").rglob("part-*")) == sorted(r.text for r in readers.manifest(spark, f"{tmp_path}/a/chunks_manifest.jsonl").collect())
    known = readers.manifest(spark, f"{tmp_path}/a/chunks_manifest.jsonl").drop("refs_out", "refs_in", "mentioned_entities")
    assert plans.build(spark, known, str(tmp_path / "b"), plans.Settings(inline_titles=False)).first().n_chunks == 3


def test_chunk_directory(spark, tmp_path):
    (tmp_path / "d" / "sub").mkdir(parents=True)
    for name, text in {"b_two.txt": "no heading here", "a.md": "# 3.1 First\n\nbody", "sub/c.TXT": "x", "blank.md": "  \n", "skip.pdf": "x", "plain": "words"}.items():
        (tmp_path / "d" / name).write_text(text, encoding="utf-8")
    got = chunking.chunk_files(readers.chunk_directory(spark, str(tmp_path / "d"))).orderBy("order").collect()
    assert [(r.original_name, r.title, r.section_no) for r in got] == [("a.md", "First", "3.1"), ("b_two.txt", "b two", None), ("plain", "plain", None), ("c.TXT", "c", None)]
    assert got[0].text.count("# 3.1 First") == 2 and [r.order for r in got] == [1, 2, 3, 4]
    with pytest.raises(NotADirectoryError):
        readers.chunk_directory(spark, str(tmp_path / "nowhere"))


def test_streaming_ingest(spark, tmp_path):
    from docloom.streaming.ingest import stream_chunks

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "one.md").write_text(SPEC, encoding="utf-8")
    args = [str(tmp_path / x) for x in ("in", "out", "state")]
    stream_chunks(spark, *args).awaitTermination(120)
    (tmp_path / "in" / "two.md").write_text(SPEC, encoding="utf-8")
    stream_chunks(spark, *args).awaitTermination(120)
    assert spark.read.parquet(args[1]).groupBy("doc_id").count().count() == 2


def test_communities_of_all_edges(spark):
    sf = "/root/testdata/sf0.001"
    edges = {(r.l_partkey, r.l_suppkey + 1000000) for r in spark.read.parquet(f"{sf}/lineitem.parquet").select("l_partkey", "l_suppkey").collect()}
    near = {}
    for a, b in edges:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    want = {}
    for node in near:
        reached = {node}
        for _ in range(5):
            reached |= {x for n in reached for x in near[n]}
        want[node] = min(reached)
    assert {r.node: r.community for r in catalogue.communities_whole(spark, sf).collect()} == want
    got = catalogue.community_reports_whole(spark, sf).collect()
    assert sum(r.size for r in got) == len(near) and sum(r.n_edges for r in got) == sum(want[a] == want[b] for a, b in edges)


def test_every_twentieth_row_is_asked(spark):
    sf = "/root/testdata/sf0.001"
    ids = {r.vec_id for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id").collect()}
    got = catalogue.vector_topk_every20(spark, sf).collect()
    assert {r.query_id for r in got} == {i for i in ids if i % 20 == 0} and all(sum(r.query_id == q for r in got) == 10 for q in (0, 20, 480))
