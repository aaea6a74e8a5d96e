"""Sections into chunks of bounded size.

A section within the hard limit is one chunk. Only larger ones go through the folds that pack blocks and split blocks that are too
large: tables at rows (with their head repeated), text at lines, lines at spaces. Folds run over the ordered blocks of one section.
Whole documents are read in Python, each once from its first line to its last, so that no line is exchanged; columns have folds of their own.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from docloom.functions import text as T
from docloom.operators import markdown
from docloom.operators.ordering import numbered_within


#: Chunks leave a worker when their texts have this many characters.
PIECE = 2**21


def _let(value: Column, use) -> Column:
    """`use` of a value that is worked out once, however often it is named; keeps nested folds small."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _closed(acc: Column, joiner: str) -> Column:
    return F.when(F.size(acc["cur"]) > 0, F.concat(acc["parts"], F.array(F.array_join(acc["cur"], joiner)))).otherwise(acc["parts"])


def _state(parts: Column, cur: Column, tok: Column) -> Column:
    return F.struct(parts.alias("parts"), cur.alias("cur"), tok.cast("int").alias("tok"))


def _fold(items: Column, cost_of, budget: Column, joiner: str, base: Column | None = None, pieces_of=None, text_of=lambda item: item, limit: Column | None = None) -> Column:
    """Greedy parts of an array: a part is closed when the next item would exceed the budget; the first item of a part always
    enters. An item beyond `limit`, where `pieces_of` is given, closes the part and adds its own pieces."""
    empty = F.array().cast("array<string>")
    start = (F.lit(0) if base is None else base).cast("int")

    def step(acc: Column, item: Column) -> Column:
        def with_cost(cost: Column) -> Column:
            full = (F.size(acc["cur"]) > 0) & (acc["tok"] + cost > budget)
            return F.when(full, _state(_closed(acc, joiner), F.array(text_of(item)), start + cost)).otherwise(_state(acc["parts"], F.concat(acc["cur"], F.array(text_of(item))), acc["tok"] + cost))

        def with_limit(cost: Column) -> Column:
            return F.when(cost > limit, _state(F.concat(_closed(acc, joiner), pieces_of(item)), empty, F.lit(0))).otherwise(with_cost(cost))

        return _let(cost_of(item), with_cost if pieces_of is None else with_limit)

    return F.aggregate(items, _state(empty, empty, start), step, lambda acc: _closed(acc, joiner))


def _item_cost(item: Column) -> Column:
    return T.token_count(item) + 1


def split_words(line: Column, budget: Column) -> Column:
    return _fold(F.split(line, " ", -1), _item_cost, budget, " ")


def split_lines(text: Column, budget: Column) -> Column:
    """Parts of whole lines; a line beyond the budget stands alone, split at spaces."""
    return _fold(F.split(text, "\n", -1), _item_cost, budget, "\n", pieces_of=lambda line: split_words(line, budget), limit=budget)


def split_table(table: Column, budget: Column) -> Column:
    """Parts of whole rows, each below the table's first two lines; tables without rows stay whole."""

    def with_rows(rows: Column) -> Column:
        head = F.array_join(F.slice(rows, 1, 2), "\n")
        parts = _fold(F.slice(rows, F.lit(3), F.greatest(F.size(rows) - 2, F.lit(0))), _item_cost, budget, "\n", T.token_count(F.concat(head, F.lit("\n"))))
        return F.when(F.size(rows) < 3, F.array(F.array_join(rows, "\n"))).otherwise(F.transform(parts, lambda p: F.concat(head, F.lit("\n"), p)))

    return _let(F.split(table, "\n", -1), with_rows)


def pack_blocks(blocks: Column, soft: Column, hard: Column) -> Column:
    """Parts of an array of (kind, text, tok): blocks fill a part up to `soft`; one beyond `hard` is split and never shares a part."""

    def pieces(block: Column) -> Column:
        return F.when(block["kind"] == "table", split_table(block["text"], hard)).otherwise(split_lines(block["text"], hard))

    parts = _fold(blocks, lambda b: b["tok"], soft, "\n\n", pieces_of=pieces, text_of=lambda b: b["text"], limit=hard)
    return _let(parts, lambda p: F.when(F.size(p) > 0, p).otherwise(F.array(F.lit(""))))


def section_parts(found: DataFrame, target_tokens: int, max_tokens: int, prepend_breadcrumb: bool) -> DataFrame:
    """(…, part, n_parts, text) of sections (level, raw_title, breadcrumb array, blocks array of (pos, kind, text))."""
    context = F.when(F.size("breadcrumb") > 0, F.concat(F.lit("> Context: "), F.array_join("breadcrumb", " > "), F.lit("\n\n"))).otherwise("") if prepend_breadcrumb else F.lit("")
    heading = F.when(F.col("level") == 0, "").otherwise(F.concat(F.repeat(F.lit("#"), F.greatest(F.col("level"), F.lit(1))), F.lit(" "), F.col("raw_title"), F.lit("\n\n")))
    found = found.withColumns({"lead": F.concat(context, heading), "body": F.array_join(F.transform("blocks", lambda b: b["text"]), "\n\n")})
    found = found.withColumn("whole", T.strip(F.concat("lead", "body"))).withColumn("fits", T.token_count(F.col("whole")) <= max_tokens)
    overhead = T.token_count(F.col("lead")) + 8
    counted = F.transform("blocks", lambda b: F.struct(b["kind"].alias("kind"), b["text"].alias("text"), T.token_count(b["text"]).alias("tok")))
    packed = pack_blocks(counted, F.greatest(F.lit(target_tokens) - overhead, F.lit(128)), F.lit(max_tokens) - overhead)
    # the fold is a branch that rows within the limit never take, and the input is read once
    found = found.withColumn("packed", F.when(~F.col("fits"), packed))
    marked = F.transform(
        "packed",
        lambda p, i: T.strip(F.concat(F.col("lead"), F.when(i > 0, F.concat(F.lit("_(continued — part "), (i + 1).cast("string"), F.lit(" of "), F.size("packed").cast("string"), F.lit(")_\n\n"))).otherwise(""), p)),
    )
    every = found.withColumn("parts", F.coalesce(marked, F.array("whole"))).drop("packed").withColumn("n_parts", F.size("parts"))
    return every.select("*", F.posexplode("parts").alias("at", "text")).withColumn("part", F.col("at") + 1).drop("at", "parts", "whole", "body", "lead", "fits", "blocks")


def _greedy(items: list, cost_of: Callable, budget: int, joiner: str, base: int = 0, pieces_of: Callable | None = None, text_of: Callable = str, limit: int = 0) -> list[str]:
    """What `_fold` makes of a list."""
    parts, held, used = [], [], base
    for item in items:
        cost = cost_of(item)
        if pieces_of and cost > limit:
            if held:
                parts.append(joiner.join(held))
            parts += pieces_of(item)
            held, used = [], 0
        elif held and used + cost > budget:
            parts.append(joiner.join(held))
            held, used = [text_of(item)], base + cost
        else:
            held.append(text_of(item))
            used += cost
    return [*parts, joiner.join(held)] if held else parts


def _cost_of(item: str) -> int:
    return T.token_count_of(item) + 1


def _lines_of(text: str, budget: int) -> list[str]:
    return _greedy(text.split("\n"), _cost_of, budget, "\n", pieces_of=lambda line: _greedy(line.split(" "), _cost_of, budget, " "), limit=budget)


def _rows_of(table: str, budget: int) -> list[str]:
    rows = table.split("\n")
    if len(rows) < 3:
        return [table]
    head = "\n".join(rows[:2]) + "\n"
    return [head + part for part in _greedy(rows[2:], _cost_of, budget, "\n", T.token_count_of(head))]


def _trail(breadcrumb: list[str | None]) -> str:
    return " > ".join(t for t in breadcrumb if t is not None)


def section_texts(level: int, raw_title: str | None, breadcrumb: list[str | None], body: list[tuple[str, str]], target_tokens: int, max_tokens: int, prepend_breadcrumb: bool) -> list[tuple[str, int]]:
    """The texts of a section's parts and their tokens, as `section_parts` has them; a body is the (kind, text) of its blocks."""
    lead = f"> Context: {_trail(breadcrumb)}\n\n" if prepend_breadcrumb and breadcrumb else ""
    if level:
        lead += f"{'#' * level} {raw_title}\n\n"
    whole = (lead + "\n\n".join(text for _, text in body)).strip(T.SPACES)
    tokens = T.token_count_of(whole)
    if tokens <= max_tokens:
        return [(whole, tokens)]
    overhead = T.token_count_of(lead) + 8
    hard = max_tokens - overhead
    parts = _greedy(body, lambda b: T.token_count_of(b[1]), max(target_tokens - overhead, 128), "\n\n", pieces_of=lambda b: (_rows_of if b[0] == "table" else _lines_of)(b[1], hard), text_of=lambda b: b[1], limit=hard) or [""]
    texts = ((lead + (f"_(continued — part {i} of {len(parts)})_\n\n" if i > 1 else "") + part).strip(T.SPACES) for i, part in enumerate(parts, 1))
    return [(text, T.token_count_of(text)) for text in texts]


def chunk_documents(docs: DataFrame, target_tokens: int = 1200, max_tokens: int = 1800, prepend_breadcrumb: bool = True) -> DataFrame:
    """Chunks of documents (doc_id, doc_title, md), numbered within each document in reading order. Sections without a body make none."""

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, held = [], 0
            for doc, doc_title, md, from_left in zip(*(batch.column(c) for c in range(4))):
                doc, doc_title, order = doc.as_py(), doc_title.as_py(), 0
                for level, raw_title, title, number, breadcrumb, body in markdown.read_sections(md.as_py(), doc_title, from_left.as_py()):
                    texts = section_texts(level, raw_title, breadcrumb, body, target_tokens, max_tokens, prepend_breadcrumb)
                    trail = _trail(breadcrumb)
                    for part, (text, tokens) in enumerate(texts, 1):
                        order += 1
                        held += len(text)
                        rows.append((doc, order, T.chunk_id_of(order, number, title, trail, part), title, trail, number, level, part, len(texts), tokens, text))
                    if held > PIECE:
                        yield _batch(rows, fields)
                        rows, held = [], 0
            if rows:
                yield _batch(rows, fields)

    key = docs.schema["doc_id"].dataType
    told = f"doc_id {key.simpleString()}, order int, chunk_id string, title string, breadcrumb string, section_no string, level int, part int, n_parts int, token_count int, text string"
    fields = to_arrow_schema(_parse_datatype_string(told))
    md = F.coalesce("md", F.lit(""))
    read = docs.where("doc_id is not null").select("doc_id", "doc_title", md.alias("md"), markdown.needs_reading(md).alias("from_left"))
    none = {"page_start": "int", "page_end": "int", "source_path": "string", "original_name": "string"}
    return read.mapInArrow(chunks, told).select("*", *(F.lit(None).cast(kind).alias(c) for c, kind in none.items()))


def _batch(rows: list[tuple], fields: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(column, field.type) for column, field in zip(zip(*rows), fields)], schema=fields)


def numbered(parts: DataFrame, scope: list[str], order: list[str]) -> DataFrame:
    """Chunk records from parts, numbered from 1 within a scope that one task can hold."""
    return records(parts.withColumn("order", F.row_number().over(Window.partitionBy(*scope).orderBy(*order))))


def records(rows: DataFrame) -> DataFrame:
    """Chunk records from numbered parts."""
    trail = F.array_join("breadcrumb", " > ")
    return rows.select(
        "doc_id", "order", T.chunk_id(F.col("order"), F.col("number"), F.col("title"), trail, F.col("part")).alias("chunk_id"), "title", trail.alias("breadcrumb"), F.col("number").alias("section_no"), "level", "part", "n_parts",
        T.token_count(F.col("text")).alias("token_count"), "text", F.lit(None).cast("int").alias("page_start"), F.lit(None).cast("int").alias("page_end"), "source_path", "original_name",
    )


def chunk_files(files: DataFrame, target_tokens: int = 1200, max_tokens: int = 1800, prepend_breadcrumb: bool = True) -> DataFrame:
    """Chunks of ready-made chunk files (collection_id, path, content): one file is one section, named by its first heading or
    else its name; blank files make none. Files are numbered by path within their collection."""
    raw = files.withColumn("md", T.strip(F.col("content"))).where("md <> ''")
    name = F.element_at(F.split("path", "/"), -1)
    dotted = F.regexp_replace(name, r"(?<=.)\.[^.]*$", "")
    stem = F.trim(F.translate(dotted, "_-", "  "))
    first = F.regexp_extract("md", r"(?m)^(#{1,6})[ \t]+(.*\S)[ \t]*$", 2)
    raw = raw.withColumn("raw_head", F.coalesce(F.nullif(T.strip(first), F.lit("")), F.nullif(stem, F.lit("")), name)).withColumn("original_name", name)
    raw = raw.withColumns({"title": T.section_title(F.col("raw_head")), "number": T.section_number(F.col("raw_head")), "doc_id": F.xxhash64("path")})
    found = markdown.blocks(raw.select("doc_id", "md")).withColumn("kind", F.when(F.col("kind") == "heading", "text").otherwise(F.col("kind"))).where(T.strip(F.col("text")) != "")
    bodies = found.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("pos", "kind", "text"))).alias("blocks"))
    shown = F.concat(F.coalesce(F.concat("number", F.lit(" ")), F.lit("")), F.col("title"))
    sections = raw.select("collection_id", "doc_id", F.col("path").alias("source_path"), "original_name", F.lit(1).alias("level"), shown.alias("raw_title"), "title", "number", F.array("title").alias("breadcrumb")).join(bodies, "doc_id")
    parts = section_parts(sections, target_tokens, max_tokens, prepend_breadcrumb)
    # a collection may hold most of the files, so its running order is made over many partitions
    return records(numbered_within(parts.withColumn("doc_id", F.col("collection_id")), ["collection_id"], ["source_path", "part"], "order").withColumn("order", F.col("order").cast("int")))


def documents_frame(chunks: DataFrame) -> DataFrame:
    """The frame that an indexer reads: id, title, text, creation_date and the chunk's provenance; a row's key is raw_data.doc_id and id."""
    keys = ["doc_id", "chunk_id", "section_no", "breadcrumb", "level", "part", "n_parts", "page_start", "page_end"]
    title = F.coalesce(F.nullif("breadcrumb", F.lit("")), F.nullif("title", F.lit("")), F.col("chunk_id"))
    return chunks.select(F.col("chunk_id").alias("id"), title.alias("title"), "text", F.lit("").alias("creation_date"), F.struct(*keys).alias("raw_data"))
