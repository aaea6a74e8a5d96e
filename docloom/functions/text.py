"""Column functions on titles, names, ids and texts, which stay in the JVM; those named `…_of` are the same for texts that are read in Python."""

from __future__ import annotations

import hashlib
import math
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Tokens per word; titles that are too common to be a vocabulary; what a prompt's text says about its task, in order.
TOKENS_PER_WORD = 1.3
STOP_TITLES = ["introduction", "overview", "scope", "general", "notes", "definitions", "description", "references", "requirements"]
TASK_LABELS = [
    ("claim", "extract_claims"),
    ("covariate", "extract_claims"),
    ("community report", "community_report"),
    ("summar", "summarize_descriptions"),
    ("report", "community_report"),
    ("entit", "extract_graph"),
    ("relationship", "extract_graph"),
]

#: White space as Python sees it; Java's \s alone misses the last ones.
SPACE = r"[\s\x1c-\x1f\x85\xa0]"
#: The same characters, for texts that are read in Python.
SPACES = " \t\n\x0b\f\r\x1c\x1d\x1e\x1f\x85\xa0"


def strip(text: Column) -> Column:
    return F.regexp_replace(text, f"^{SPACE}+|{SPACE}+$", "")


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"[^\s\x1c-\x1f\x85\xa0]+"))


def token_count(text: Column) -> Column:
    """An estimate from words: 0 for an empty or null text, else 1 at least."""
    return F.when(F.coalesce(text, F.lit("")) == "", 0).otherwise(F.greatest(F.lit(1), F.ceil(word_count(text) * F.lit(TOKENS_PER_WORD)).cast("int"))).cast("int")


#: White space of Python's own split that does not part words here.
_JOINING = re.compile("[\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")


def token_count_of(text: str) -> int:
    if not text:
        return 0
    words = len(text.split()) if text.isascii() or not _JOINING.search(text) else len(re.findall(f"[^{SPACES}]+", text))
    return max(1, math.ceil(words * TOKENS_PER_WORD))


def collapse(text: Column) -> Column:
    """Runs of white space become one space; none at the ends."""
    return strip(F.regexp_replace(text, f"{SPACE}+", " "))


def snippet(text: Column, chars: int = 240) -> Column:
    return F.substring(collapse(text), 1, chars)


def norm_title(text: Column) -> Column:
    """Lower case, no leading article, letters and digits only, single spaces."""
    bare = F.regexp_replace(F.lower(strip(text)), r"^(the|a|an)\s+", "")
    return F.trim(F.regexp_replace(bare, "[^a-z0-9]+", " "))


def norm_title_of(text: str) -> str:
    bare = re.sub("^(the|a|an)[ \t\n\x0b\f\r]+", "", text.strip(SPACES).lower())
    return re.sub("[^a-z0-9]+", " ", bare).strip(" ")


def singular(token: Column) -> Column:
    n = F.length(token)
    ies, es, s = token.endswith("ies") & (n > 3), token.endswith("es") & (n > 4) & ~token.endswith("ses") & ~token.endswith("zes"), token.endswith("s") & (n > 3) & ~token.endswith("ss")
    return F.when(ies, F.concat(F.substring(token, F.lit(1), n - 3), F.lit("y"))).when(es, F.substring(token, F.lit(1), n - 2)).when(s, F.substring(token, F.lit(1), n - 1)).otherwise(token)


def canonical_key(name: Column) -> Column:
    """The key under which variants of a name fold: no possessive, no leading article, no punctuation, singular words."""
    s = F.regexp_replace(F.lower(strip(F.coalesce(name, F.lit("")))), r"['’]s\b", "")
    s = F.trim(F.regexp_replace(F.regexp_replace(s, r"^(the|a|an)\s+", ""), "[^a-z0-9]+", " "))
    return F.array_join(F.transform(F.filter(F.split(s, " "), lambda t: t != ""), singular), " ")


def section_number(raw_title: Column) -> Column:
    return F.nullif(F.regexp_extract(raw_title, r"^\s*(\d+(?:\.\d+)*)\.?\s+(.*\S)\s*$", 1), F.lit(""))


def section_title(raw_title: Column) -> Column:
    """The title without its section number."""
    return F.coalesce(F.nullif(strip(F.regexp_extract(raw_title, r"^\s*(\d+(?:\.\d+)*)\.?\s+(.*\S)\s*$", 2)), F.lit("")), strip(raw_title))


def slug(text: Column, most: int = 48) -> Column:
    dashed = F.lower(F.regexp_replace(F.regexp_replace(text, "[^a-zA-Z0-9]+", "-"), "^-+|-+$", ""))
    return F.coalesce(F.nullif(F.substring(dashed, 1, most), F.lit("")), F.lit("section"))


def chunk_id(order: Column, number: Column, title: Column, breadcrumb: Column, part: Column) -> Column:
    """The order, a slug of number and title, and a digest of breadcrumb and part."""
    shown = F.lpad(order.cast("string"), F.greatest(F.lit(4), F.length(order.cast("string"))), F.lit("0"))
    digest = F.substring(F.sha1(F.concat(breadcrumb, F.lit("#p"), part.cast("string")).cast("binary")), 1, 6)
    return F.concat_ws("__", shown, slug(F.concat(F.coalesce(F.concat(F.nullif(number, F.lit("")), F.lit("-")), F.lit("")), title)), digest)


def chunk_id_of(order: int, number: str | None, title: str | None, breadcrumb: str, part: int) -> str:
    shown = "" if title is None else f"{number}-{title}" if number else title
    slugged = re.sub("[^a-zA-Z0-9]+", "-", shown).strip("-").lower()[:48] or "section"
    return f"{order:04}__{slugged}__{hashlib.sha1(f'{breadcrumb}#p{part}'.encode()).hexdigest()[:6]}"


def first_text(messages: Column) -> Column:
    """Of an ordered array of (role, content): the first system message, else the first user message, else the first with content."""

    def of(keep) -> Column:
        return F.get(F.filter(messages, keep), F.lit(0))["content"]

    return F.coalesce(of(lambda m: (m["role"] == "system") & m["content"].isNotNull()), of(lambda m: (m["role"] == "user") & m["content"].isNotNull()), of(lambda m: m["content"].isNotNull()), F.lit(""))


def task_label(text: Column, chars: int = 90) -> Column:
    """What kind of call a prompt is; else its beginning, else `llm-call`."""
    label = F.coalesce(F.nullif(F.substring(collapse(text), 1, chars), F.lit("")), F.lit("llm-call"))
    for needle, name in reversed(TASK_LABELS):
        label = F.when(F.contains(F.lower(text), F.lit(needle)), name).otherwise(label)
    return label


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, v: s + v)
