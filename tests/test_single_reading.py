"""Documents and chunks are read once, whatever is asked of them, and give what the plain plans give."""

import random
import re
import sys
import unicodedata

import pytest
from pyspark.sql import functions as F

from docloom.functions import text as T
from docloom.operators import chunking, entities, markdown, xref
from docloom.plans.spec_tables import spec_documents

LINES = ["# 1 One", "## 1.2. Two words", "###### deep", "#no", "# \xa0", "  # in", "#\ttab\r", "| a | b |", "| --- | :-: |", "|--|", "a | b", "text of some more words", "x" * 9, "", "  ", "\x1c", "\x85", "　 wide space", "- x", "```", "~~~", "one two three four five six seven"]


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def some_documents(spark):
    rng = random.Random(9)
    rows = [(n, rng.choice(["Doc", "A  title", None]), "\n".join(rng.choices(LINES if n % 3 else LINES[:-3], k=rng.randint(0, 40)))) for n in range(120)]
    return spark.createDataFrame([*rows, (120, "D", None), (121, "D", ""), (None, "D", "text")], "doc_id long, doc_title string, md string")


@pytest.mark.parametrize(("sizes", "context"), [((20, 30), True), ((140, 160), False)])
def test_chunks_equal_windows_over_lines_and_folds_of_columns(spark, sizes, context):
    docs = some_documents(spark)
    found = markdown.blocks(docs)
    bodies = markdown.body_blocks(found).groupBy("doc_id", "sec_pos").agg(F.array_sort(F.collect_list(F.struct("pos", "kind", "text"))).alias("blocks"))
    parts = chunking.section_parts(markdown.tree(found, docs.select("doc_id", "doc_title")).join(bodies, ["doc_id", "sec_pos"]), *sizes, context)
    want = chunking.numbered(parts.withColumns({"source_path": F.lit(None).cast("string"), "original_name": F.lit(None).cast("string")}), ["doc_id"], ["sec_pos", "part"])
    got = chunking.chunk_documents(docs, *sizes, context)
    assert got.dtypes == want.dtypes and got.count() > 200
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def test_no_line_is_exchanged(spark):
    told = plan(chunking.chunk_documents(some_documents(spark), 20, 30))
    assert told.count("MapInArrow") == 1 and not any(name in told for name in ("Window", "Join", "Aggregate", "Repartition"))


def test_rows_of_one_document_are_one_specification(spark):
    rows = spark.createDataFrame([(1, "b\nx9y 2 w-w v u"), (1, "a"), (2, None), (3, "")], "doc_id long, text string")
    got = {r.doc_id: r.md for r in spec_documents(rows, rich=False).collect()}
    assert got == {1: "# 1 Ta x\n\na See Section 1.\n\n# 1 Tb x\n\nb See Section 1.\n\n## 1.1 Txy ww v x\n\nx9y 2 w-w v u See Section 1.1.", 3: "# 1 T x\n\n See Section 1."}


def test_tokens_of_a_text_read_in_python(spark):
    texts = ["", " ", "a", "a\x1cb\x85c\xa0d", "a b c", "é　é é", "\x0b x \x0c"]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", T.token_count(F.col("t")).alias("n"), T.norm_title(F.col("t")).alias("norm")).collect()
    assert {r.i: (r.n, r.norm) for r in rows} == {i: (T.token_count_of(t), T.norm_title_of(t)) for i, t in enumerate(texts)}


def test_references_read_a_chunk_once_and_join_nothing(spark):
    chunks = chunking.chunk_documents(some_documents(spark))
    told = plan(xref.references(chunks, ["the unit", "view of"]))
    assert told.count("MapInArrow") == 1 and "Join" not in told and "InMemoryRelation" not in told


def test_phrases_are_found_without_the_normal_form_of_a_text(spark):
    rng = random.Random(3)
    bits = ["the", "The ", "a ", "an\t", "unit", " ", "\xa0", "\n", "values", "of", "View", "--", "x", "§", "é", "İ", "K", "the unit", "THE  UNIT.", "\x1c", "\x85"]
    phrases = ["the unit", "values of", "the", "The View of", "a", "VALUES-of", "unit", "an x", "é", "k"]
    texts = ["".join(rng.choices(bits, k=rng.randint(0, 7))) for _ in range(3000)]
    rows = spark.createDataFrame([(1, n, f"c{n}", t) for n, t in enumerate(texts)], "doc_id long, order int, chunk_id string, text string")
    normal = [(i, p, T.norm_title_of(p)) for i, p in enumerate(phrases)]
    normal = [(i, p, n) for i, p, n in normal if n and not any(m == n and j > i for j, _, m in normal)]
    got = sorted((r.order, r.occurrence, r.raw) for r in xref.phrase_refs(rows, phrases).collect())
    bodies = rows.select("order", T.norm_title(F.col("text")).alias("norm")).collect()
    assert got == sorted((r.order, i, p) for r in bodies for i, p, n in normal if n in r.norm)


def test_the_first_chunk_is_the_target_and_the_longest_title_counts(spark):
    rows = [
        (1, 1, "a", "The Abort command", "1", "Figure 3: flow\nSection 2, SECTION 2 and section 9. We see Status Code Definitions of it; refer to Status x"),
        (1, 2, "b", "Status Code", "2", "Figure 3: again. figure 3"),
        (1, 3, "c", "Status code", "2", "an abort command; see Abort command."),
        (2, 1, "d", "Status Code Definitions", None, "Section 1 and table 7"),
    ]
    chunks = spark.createDataFrame(rows, "doc_id long, order int, chunk_id string, title string, section_no string, text string")
    got = [(r.chunk_id, r.ref_pos, r.raw, r.target, r.weight) for r in xref.references(chunks, ["abort command"]).orderBy("doc_id", "order", "ref_pos").collect()]
    assert got == [
        ("a", 1, "Section 2", "b", 1.0), ("a", 2, "section 9", None, 1.0), ("a", 3, "Figure 3", None, 0.9), ("a", 4, "Status Code Definitions of it", "b", 0.8),
        ("b", 1, "Figure 3", "a", 0.9), ("c", 1, "abort command", "a", 0.8), ("d", 1, "Section 1", None, 1.0), ("d", 2, "table 7", None, 0.9),
    ]


def test_words_of_a_text_read_in_python():
    word = re.compile(r"\w")
    assert all(bool(word.match(c)) == (c == "_" or unicodedata.category(c)[0] in "LN") == xref._is_word(c) for c in map(chr, range(sys.maxunicode + 1)))


def test_only_runs_that_are_titles_leave_a_worker(spark):
    rows = [(1, 1, "a", "İstanbul Yolu", "ISTANBUL YOLU, i̇stanbul yolu"), (1, 2, "b", "ΟΔΟΣ ΜΕΓΑΣ", "οδος μεγας. Οδος μεγασ ΟΔΟΣ ΜΕΓΑΣ Other Title"), (2, 1, "c", "Other Title", "a other title _Other Title Other Titles"), (3, 1, "d", "Scope", "Other Title")]
    chunks = spark.createDataFrame(rows, "doc_id long, order int, chunk_id string, title string, text string")
    spans = xref.title_spans(chunks)
    assert "posexplode" not in plan(spans).lower() and plan(spans).count("MapInArrow") == 1
    assert [(r.chunk_id, r.at, r.name, r.own_title) for r in spans.orderBy("doc_id", "chunk_id", "at").collect()] == [("c", 2, "other title", "Other Title")]
    long = chunks.select("doc_id", "order", "chunk_id", F.concat("title", F.lit(" latina")).alias("title"), F.concat("text", F.lit(" ΟΔΟΣ ΜΕΓΑΣ LATINA İstanbul yolu Latina")).alias("text"))
    assert [(r.chunk_id, r.name) for r in xref.title_spans(long).where("doc_id = 1").orderBy("chunk_id", "at").collect()] == [("a", "ΟΔΟΣ ΜΕΓΑΣ LATINA"), ("a", "İstanbul yolu Latina"), ("b", "ΟΔΟΣ ΜΕΓΑΣ LATINA"), ("b", "İstanbul yolu Latina")]


def test_claims_are_collapsed_after_they_are_found(spark):
    rows = [(1, "a", "T", "It \xa0shall\n do.\x1cIt may! No. \t It\x85must  not? marshall"), (1, "b", "T", "nothing here"), (1, "c", "T", None)]
    found = entities.claims(spark.createDataFrame(rows, "doc_id long, chunk_id string, title string, text string"))
    assert [(r.chunk_id, r.pos, r.statement) for r in found.orderBy("pos").collect()] == [("a", 0, "It shall do. It may!"), ("a", 2, "It must not?")]
    assert plan(found).count("RLIKE") == 2
