"""The corpus pipeline held against plain Python, stage by stage."""

import importlib
import random
import re
import zlib

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest

from docloom.llm import queries

random.seed(9)
WORDS = {lang: ["".join(random.choice(letters) for _ in range(random.randint(2, 8))) for _ in range(200)] for lang, letters in (("aa", "abcdefghi"), ("bb", "qrstuvwxyz"))}


def prose(lang, n):
    return " ".join(random.choice(WORDS[lang]) for _ in range(n))


def plain(rows):
    """doc_id -> text after the first four stages, and the rows that stay, in plain Python. Rows: (doc_id, text, lang)."""
    rows = [r for r in rows if r[1] is not None and re.search(r"[^\W\d_]", r[1])]
    rows = [r for r in rows if not re.search("[一-鿿]", r[1])]  # written in no language that a row teaches
    best = {}
    for r in rows:
        if r[1] not in best or r[0] > best[r[1]][0]:
            best[r[1]] = r
    rows = sorted(best.values())
    sets = []
    for _, text, _ in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
        sets.append({tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set())
    root = {i: i for i in range(len(rows))}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    rows = [r for i, r in enumerate(rows) if find(i) == i]
    seen = {}
    raws = [r[1].encode() for r in rows]
    for raw in raws:
        for i in range(len(raw) - 199):
            seen[raw[i : i + 200]] = seen.get(raw[i : i + 200], 0) + 1
    out = {}
    for (doc, _, _), raw in zip(rows, raws):
        gone = np.zeros(len(raw), dtype=bool)
        for i in range(len(raw) - 199):
            if seen[raw[i : i + 200]] > 1:
                gone[i : i + 200] = True
        out[doc] = bytes(b for b, g in zip(raw, gone) if not g).decode("utf-8", "ignore")
    return out


@pytest.fixture(scope="module")
def rows():
    passage = prose("aa", 60)
    near = prose("bb", 150).split()
    texts = [(prose(lang, random.randint(30, 200)), lang) for lang in ("aa", "bb") * 30]
    texts += [(f"{prose('aa', 40)} {passage} {prose('aa', 30)}", "aa") for _ in range(3)]
    texts += [(" ".join([*near[:i], "qq", *near[i + 1 :]]), "bb") for i in (10, 60, 140)]
    texts += [texts[0], texts[0], texts[3], (prose("aa", 6000), "aa"), (None, "aa"), ("", None), ("12 34 !?", "bb"), ("一二三四五六七八九十" * 8, None), (prose("aa", 50), None)]
    held = [(i, text, lang) for i, (text, lang) in enumerate(texts)]
    return [*held, held[5]]


def test_run_equals_plain_python(spark, rows, tmp_path):
    wide = [(*r, "s", 1, 2, "x", None) for r in rows]
    spark.createDataFrame(wide, "doc_id long, text string, lang string, source string, doc long, mark long, runs string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = plain(rows)
    assert {r.doc_id for r in got} == set(want)
    sequences = {}
    for doc, text in want.items():
        ids = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 2], dtype="<u4")
        at = 0
        for r in sorted((r for r in got if r.doc_id == doc), key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
            sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
        assert at == len(ids)
    for held in sequences.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 4096


def test_stages_keep_columns_and_take_empty_tables(spark, rows):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language ID", "exact dedup", "MinHash near-dedup", "suffix-array dedup", "packing"]
    schema = "doc_id long, text string, lang string, source string, n_chars long, gone long, kept boolean"
    docs = spark.createDataFrame([(*r, None, None, 1, True) for r in rows], schema)
    empty = spark.createDataFrame([], schema)
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        assert stage(spark, empty, "").count() == 0
        if k < 4:
            docs = stage(spark, docs, "")
            assert docs.columns == empty.columns and docs.count()


def test_every_operator_has_a_query():
    assert [int(n[2:].split("_")[0]) for n in queries.queries()] == list(range(1, 14))
    entry = importlib.import_module("__spark_entry__")
    assert "pipeline" in entry.queries() and set(queries.oracle_sql()) <= set(entry.oracle_sql())
