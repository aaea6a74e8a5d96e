"""Markdown into blocks and sections, as windows over lines.

Lines are classified without state where that is exact: in documents without code fences, and without a table head above a rule
that has no bar. The few other documents need a left-to-right reading and go through a small per-document helper.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docloom.functions import text as T

# Fixed formats: headings, fences, table rules.
HEADING = r"^(#{1,6})\s+(.*\S)\s*$"
FENCE = r"^\s*(```|~~~)"
RULE = r"^\s*\|?\s*:?-{2,}:?\s*(\|\s*:?-{2,}:?\s*)*\|?\s*$"

BLOCK = "doc_id long, pos int, kind string, text string"


def lines(docs: DataFrame) -> DataFrame:
    """(doc_id, pos, line): every line of `md`, with carriage returns and empty lines."""
    return docs.select("doc_id", F.posexplode(F.split("md", "\n", -1)).alias("pos", "line"))


def is_row(line: Column) -> Column:
    return F.contains(line, F.lit("|")) & ~T.strip(line).startswith("#")


def needs_reading(md: Column) -> Column:
    """Whether a document has a fence, or a row of bars directly above a rule without bars."""
    bare = r"(?m)^[^\n]*\|[^\n]*\n[^\S\n]*:?-{2,}:?[^\S\n]*$"
    return md.rlike("(?m)" + FENCE) | md.rlike(bare)


def blocks(docs: DataFrame) -> DataFrame:
    """(doc_id, pos, kind, text) in reading order; kind is heading, text, table or code. Documents: (doc_id, md)."""
    docs = docs.select("doc_id", F.coalesce("md", F.lit("")).alias("md"))
    hard = needs_reading(F.col("md"))
    return _windowed(docs.where(~hard)).unionByName(docs.where(hard).mapInPandas(_read, BLOCK))


def _windowed(docs: DataFrame) -> DataFrame:
    by_doc = Window.partitionBy("doc_id").orderBy("pos")
    told = lines(docs).withColumns({"row": is_row(F.col("line")), "rule": F.col("line").rlike(RULE), "heading": F.col("line").rlike(HEADING), "blank": T.strip(F.col("line")) == ""})
    told = told.withColumn("run", F.sum((F.col("row") != F.coalesce(F.lag("row").over(by_doc), F.lit(False))).cast("int")).over(by_doc))
    head = F.when(F.col("row") & F.lead("row").over(by_doc) & F.lead("rule").over(by_doc), F.col("pos"))
    told = told.withColumn("head", head).withColumn("table_from", F.min("head").over(Window.partitionBy("doc_id", "run")))
    kind = F.when(F.col("heading"), "heading").when(F.col("row") & (F.col("pos") >= F.col("table_from")), "table").when(F.col("blank"), "blank").otherwise("text")
    told = told.withColumn("kind", kind)
    begins = (F.col("kind") == "heading") | ~F.col("kind").eqNullSafe(F.lag("kind").over(by_doc))
    told = told.withColumn("block", F.sum(begins.cast("int")).over(by_doc)).where("kind <> 'blank'")
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "line"))), lambda x: x["line"]), "\n")
    return told.groupBy("doc_id", "block").agg(F.min("pos").alias("pos"), F.first("kind").alias("kind"), body.alias("text")).select("doc_id", "pos", "kind", "text")


def _read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = [(doc, *block) for doc, md in zip(batch["doc_id"], batch["md"]) for block in read_blocks(md.split("\n"))]
        yield pd.DataFrame(rows, columns=["doc_id", "pos", "kind", "text"])


def read_blocks(source: list[str]) -> list[tuple[int, str, str]]:
    """(first line, kind, text) of each block, in one pass with one open block at most."""
    done: list[tuple[int, str, list[str]]] = []
    state, fence = "none", ""
    for i, line in enumerate(source):
        below = source[i + 1] if i + 1 < len(source) else None
        stripped = line.strip()
        bars = "|" in stripped and not stripped.startswith("#")
        opener = re.match(FENCE, line)
        if state == "code":
            done[-1][2].append(line)
            state = "none" if stripped.startswith(fence) else "code"
        elif state == "rule":  # the line below a table's head
            done[-1][2].append(line)
            state = "table"
        elif state == "table" and bars:
            done[-1][2].append(line)
        elif opener:
            done.append((i, "code", [line]))
            state, fence = "code", opener[1]
        elif re.match(HEADING, line):
            done.append((i, "heading", [line]))
            state = "none"
        elif bars and below is not None and re.match(RULE, below):
            done.append((i, "table", [line]))
            state = "rule"
        elif not stripped:
            state = "none"
        elif state == "text":
            done[-1][2].append(line)
        else:
            done.append((i, "text", [line]))
            state = "text"
    return [(i, kind, "\n".join(held)) for i, kind, held in done]


# The fixed formats as the JVM reads them, for lines that are read in Python: white space is ASCII, and a line may end in a carriage return.
_BLANK, _DOT, _END = r"[ \t\n\x0b\f\r]", r"[^\n\r\x85\u2028\u2029]", r"(?=(?:\r\n|[\n\r\x85\u2028\u2029])?\Z)"
_SOLID = "[^" + _BLANK[1:]
_HEADING = re.compile(rf"(#{{1,6}}){_BLANK}+({_DOT}*{_SOLID}){_BLANK}*{_END}")
_RULE = re.compile(rf"{_BLANK}*\|?{_BLANK}*:?-{{2,}}:?{_BLANK}*(\|{_BLANK}*:?-{{2,}}:?{_BLANK}*)*\|?{_BLANK}*{_END}")
_NUMBERED = re.compile(rf"{_BLANK}*([0-9]+(?:\.[0-9]+)*)\.?{_BLANK}+({_DOT}*{_SOLID}){_BLANK}*{_END}")


def read_plain_blocks(source: list[str]) -> list[tuple[int, str, str]]:
    """(first line, kind, text) of each block of a document that needs no reading from left to right: what `blocks` makes of it."""
    bars = ["|" in line and not line.strip(T.SPACES).startswith("#") for line in source]
    done: list[tuple[int, str, list[str]]] = []
    before, table_from, n = "blank", None, len(source)
    for i, line in enumerate(source):
        if bars[i]:
            if not i or not bars[i - 1]:  # a run of rows begins: its table begins at the first row above a rule
                table_from, j = None, i
                while j + 1 < n and bars[j + 1]:
                    if "--" in source[j + 1] and _RULE.match(source[j + 1]):
                        table_from = j
                        break
                    j += 1
            kind = "table" if table_from is not None and i >= table_from else "text"
        elif line[:1] == "#" and _HEADING.match(line):
            kind = "heading"
        else:
            kind = "text" if line.strip(T.SPACES) else "blank"
        if kind != "blank":
            if kind == before != "heading":
                done[-1][2].append(line)
            else:
                done.append((i, kind, [line]))
        before = kind
    return [(i, kind, "\n".join(held)) for i, kind, held in done]


def read_sections(md: str, doc_title: str | None, from_left: bool) -> Iterator[tuple[int, str | None, str | None, str | None, list[str | None], list[tuple[str, str]]]]:
    """(level, raw_title, title, number, breadcrumb, body) of the sections of a document that have a body, in reading order; a body is the
    (kind, text) of its blocks. As `tree` and `body_blocks` have them."""
    found = (read_blocks if from_left else read_plain_blocks)(md.split("\n"))
    section, above = (0, doc_title, doc_title, None, [doc_title], []), []
    for _, kind, text in found:
        if kind != "heading":
            if text.strip(T.SPACES):
                section[5].append((kind, text))
            continue
        if section[5]:
            yield section
        head = _HEADING.match(text)
        level, raw = (len(head[1]), head[2].strip(T.SPACES)) if head else (0, "")
        told = _NUMBERED.match(raw)
        title = (told[2].strip(T.SPACES) if told else "") or raw
        if level:
            while above and above[-1][0] >= level:
                above.pop()
        section = (level, raw, title, told[1] if told else None, [doc_title, *(t for _, t in above if level), title], [])
        if level:
            above.append((level, title))
    if section[5]:
        yield section


def sections(docs: DataFrame) -> DataFrame:
    """(doc_id, sec_pos, level, raw_title, title, number, parent_pos, breadcrumb array) for each heading, and for the document
    itself (sec_pos -1, level 0). Documents: (doc_id, doc_title, md). The parent is the nearest earlier heading of a smaller level."""
    return tree(blocks(docs), docs.select("doc_id", "doc_title"))


def tree(found: DataFrame, titles: DataFrame) -> DataFrame:
    before = Window.partitionBy("doc_id").orderBy("sec_pos").rowsBetween(Window.unboundedPreceding, -1)
    heads = found.where("kind = 'heading'").select("doc_id", F.col("pos").alias("sec_pos"), F.length(F.regexp_extract("text", HEADING, 1)).alias("level"), T.strip(F.regexp_extract("text", HEADING, 2)).alias("raw_title"))
    heads = heads.withColumns({"title": T.section_title(F.col("raw_title")), "number": T.section_number(F.col("raw_title"))})
    for m in range(1, 7):
        heads = heads.withColumn(f"at_{m}", F.last(F.when(F.col("level") == m, F.struct(F.col("sec_pos").alias("p"), F.col("title").alias("t"))), ignorenulls=True).over(before))
    steps, above = [], F.lit(-1)
    for m in range(1, 7):  # a heading at level m is an ancestor if no heading of a smaller level came after it
        at = F.col(f"at_{m}")
        steps.append(F.when((F.col("level") > m) & (at["p"] > above), at))
        above = F.greatest(above, F.coalesce(at["p"], F.lit(-1)))
    chain = F.filter(F.array(*steps), lambda x: x.isNotNull())
    heads = heads.join(titles, "doc_id").select(
        "doc_id", "sec_pos", "level", "raw_title", "title", "number",
        F.coalesce(F.get(chain, F.size(chain) - 1)["p"], F.lit(-1)).alias("parent_pos"),
        F.concat(F.array("doc_title"), F.transform(chain, lambda x: x["t"]), F.array("title")).alias("breadcrumb"),
    )
    none = F.lit(None)
    roots = titles.select("doc_id", F.lit(-1).alias("sec_pos"), F.lit(0).alias("level"), F.col("doc_title").alias("raw_title"), F.col("doc_title").alias("title"), none.cast("string").alias("number"), none.cast("int").alias("parent_pos"), F.array("doc_title").alias("breadcrumb"))
    return roots.unionByName(heads)


def body_blocks(found: DataFrame) -> DataFrame:
    """(doc_id, sec_pos, pos, kind, text) of blocks that are not headings or blank, with the section that owns each."""
    owner = F.last(F.when(F.col("kind") == "heading", F.col("pos")), ignorenulls=True).over(Window.partitionBy("doc_id").orderBy("pos"))
    return found.withColumn("sec_pos", F.coalesce(owner, F.lit(-1))).where((F.col("kind") != "heading") & (T.strip(F.col("text")) != "")).select("doc_id", "sec_pos", "pos", "kind", "text")


def html_to_markdown(html: Column) -> Column:
    """Headings, paragraphs, bold and line breaks of simple page markup; navigation and footers go, other tags are dropped."""
    out = F.regexp_replace(html, r"(?is)<(script|style|nav|footer|head)[^>]*>.*?</\1>", "")
    for level in range(1, 7):
        out = F.regexp_replace(out, f"(?is)<h{level}[^>]*>(.*?)</h{level}>", "\n\n" + "#" * level + " $1\n\n")
    out = F.regexp_replace(F.regexp_replace(out, r"(?is)<(b|strong)(?:\s[^>]*)?>(.*?)</\1>", "**$2**"), r"(?is)<(i|em)(?:\s[^>]*)?>(.*?)</\1>", "*$2*")
    out = F.regexp_replace(F.regexp_replace(out, r"(?i)<br\s*/?>", "\n"), r"(?is)<p[^>]*>(.*?)</p>", "\n\n$1\n\n")
    out = F.regexp_replace(F.regexp_replace(out, r"(?is)<li[^>]*>(.*?)</li>", "\n- $1"), r"(?s)<[^>]+>", "")
    for name, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
        out = F.replace(out, F.lit(name), F.lit(char))
    return T.strip(F.regexp_replace(F.regexp_replace(out, r"[ \t]+\n", "\n"), r"\n{3,}", "\n\n"))
