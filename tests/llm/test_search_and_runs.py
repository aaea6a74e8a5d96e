"""Ranked search, the pigeonhole join, periodic runs, and cases mended in other operators, each against brute force."""

import hashlib
import math
import random
import re

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from docloom.llm import ann, bpe, embedding_dedup, lexical, packing, runs, suffix_dedup

random.seed(11)
TERMS = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERMS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def ranked(docs, items, k):
    held = [(doc, terms(text)) for doc, text in docs]
    n_docs, n_terms = sum(bool(t) for _, t in held), sum(len(t) for _, t in held)
    asked = {}
    for item, text in items:
        asked.setdefault(item, set()).update(terms(text))
    df = {}
    for _, t in held:
        for x in set(t):
            df[x] = df.get(x, 0) + 1
    out = []
    for item, wanted in asked.items():
        scored = []
        for doc, t in held:
            m = 50 + (50 * len(t) * n_docs) // max(1, n_terms)
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[x] + 1))) * ((1000000000 * t.count(x)) // (1000 * t.count(x) + 20 * m)) for x in wanted if x in t)
            if score > 0:
                scored.append((-score, doc is None, doc or 0))
        out += [(item, i + 1, None if none else doc, -score) for i, (score, none, doc) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


@pytest.mark.parametrize("postings", [40, 100_000])
def test_ranked_search(spark, postings):
    words = ["Alpha", "beta", "gam_ma", "Straße", "delta9", "日本", "x", "of", "the"]
    docs = [(i, " ".join(random.choices(words, weights=[1, 1, 2, 1, 1, 1, 4, 20, 20], k=random.randint(0, 40)))) for i in range(300)]
    docs += [(300, None), (301, ""), (302, "!?"), (None, "alpha BETA"), (7, "alpha beta"), (7, "alpha beta"), (303, "the " * 5000 + "alpha")]
    items = [(1, "alpha beta, the"), (2, "ALPHA alpha x"), (2, "gam"), (3, None), (4, "nowhere"), (5, "of the x delta9 日本 Straße"), (None, "beta")]
    got = lexical.search(spark.createDataFrame([(*d, 1, "z") for d in docs], "doc_id long, text string, shard int, term string"), spark.createDataFrame(items, "item_id long, text string"), k=20, postings=postings)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=str) == ranked(docs, items, 20)


def test_ranked_search_of_nothing(spark):
    docs, items = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert lexical.search(docs, items).count() == 0
    assert lexical.search(items.withColumnRenamed("item_id", "doc_id"), items.limit(0)).count() == 0


def test_blocks_minimise_their_cost():
    rng = np.random.default_rng(2)
    values = rng.integers(1, 60, 90)
    first = np.array([0, 30, 31])

    def cost(part, ends, fixed):
        return sum((b - a) * int(part[a:b].max()) + fixed for a, b in zip([0, *ends[:-1]], ends))

    ends = lexical.block_ends(values, first, cost=2.0)
    for low, high in ((0, 30), (30, 31), (31, 90)):
        part, n = values[low:high], high - low
        fixed = 2.0 * (part.max() - part.mean()) + 1
        best = [0.0]
        for b in range(1, n + 1):
            best.append(min(best[a] + (b - a) * int(part[a:b].max()) + fixed for a in range(b)))
        mine = [int(e) - low for e in ends if low < e <= high]
        assert mine[-1] == n and abs(cost(part, mine, fixed) - best[n]) < 1e-6
    long = lexical.block_ends(np.arange(1000) % 7 + 1, np.array([0]))
    assert long[-1] == 1000 and np.diff(np.concatenate([[0], long])).max() <= lexical.SPAN


def test_search_skips_and_is_exact():
    rng = np.random.default_rng(4)
    lists = []
    for _ in range(6):
        docs = np.sort(rng.choice(5000, int(rng.integers(1, 3000)), replace=False)).astype(np.int32)
        parts = (rng.pareto(1.5, len(docs)) * 100 + 1).astype(np.int32)
        ends = lexical.block_ends(parts, np.array([0]))
        lists.append((docs, parts, ends, np.maximum.reduceat(parts, np.concatenate([[0], ends[:-1]])), int(rng.integers(1, 9))))
    score = np.zeros(5000, dtype=np.int64)
    for docs, parts, _, _, weight in lists:
        score[docs] += weight * parts
    want = np.lexsort((np.arange(5000), -score))[:50]
    docs, scores = lexical.best_of(lists, 5000, 50)
    assert docs.tolist() == want.tolist() and scores.tolist() == score[want].tolist()


def linked(rows, threshold):
    ok = [r for r in rows if r[0] is not None and r[2] is not None and r[1] and all(x is not None and math.isfinite(x) for x in r[1]) and any(r[1])]

    def cosine(a, b):
        a, b = (np.array(x, dtype=float) / np.abs(x).max() for x in (a, b))
        return a @ b / math.sqrt(a @ a) / math.sqrt(b @ b)

    n, near = {}, {r[0]: set() for r in rows}
    for i, r in enumerate(ok):
        for j, t in enumerate(ok):
            if i != j and r[2] == t[2] and len(r[1]) == len(t[1]) and cosine(r[1], t[1]) >= threshold:
                n[id(r)] = n.get(id(r), 0) + 1
                near[r[0]].add(t[0])
    component = {}
    for node in sorted(x for x in near if x is not None):
        walk = [node] if node not in component else []
        while walk:
            at = walk.pop()
            if at not in component:
                component[at] = node
                walk += near[at]
    return sorted(((r[0], n.get(id(r), 0), component.get(r[0]), r[0] is None or component[r[0]] == r[0]) for r in rows), key=str)


@pytest.mark.parametrize(("dim", "parameters"), [(20, {}), (20, {"tile": 8}), (5, {"threshold": 0.8, "width": 3, "tile": 16}), (1, {})])
def test_embedding_near_dedup(spark, dim, parameters):
    rng = np.random.default_rng(dim)
    rows = []
    for i in range(160):
        vec = np.array(rows[int(rng.integers(len(rows)))][1]) + rng.normal(size=dim) * rng.choice([0.01, 0.05, 0.1]) if i % 3 else rng.normal(size=dim)
        rows.append((i, [float(x) for x in vec / np.linalg.norm(vec)], int(rng.integers(3))))
    rows += [(1, rows[0][1], rows[0][2]), (500, rows[3][1], rows[3][2]), (501, rows[3][1], None), (None, rows[3][1], rows[3][2])]
    rows += [(510, None, 1), (511, [], 1), (512, [0.0] * dim, 1), (513, [float("nan")] * dim, 1), (514, [None] * dim, 1), (515, [1e-200] * dim, 2), (516, [1e200] * dim, 2), (517, [1.0] * (dim + 1), 2)]
    frame = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<double>, label int, cell long, n int")
    got = embedding_dedup.near_duplicates(frame, **parameters)
    assert sorted(map(tuple, got.collect()), key=str) == linked(rows, parameters.get("threshold", 0.93))
    assert embedding_dedup.near_duplicates(frame.limit(0)).count() == 0


def brute_runs(t, least):
    n, out = len(t), []
    for s in range(n):
        for p in range(1, (n - s) // 2 + 1):
            if s and t[s - 1] == t[s - 1 + p]:
                continue
            e = s
            while e + p < n and t[e] == t[e + p]:
                e += 1
            size = e - s + p
            if size >= max(least, 2 * p) and not any(all(t[k] == t[k + q] for k in range(s, s + size - q)) for q in range(1, p)):
                out.append((s, size, p))
    return sorted(out, key=lambda r: (r[0], r[2]))


def test_runs_of_random_and_periodic_words():
    for i in range(1500):
        t = [random.randrange(1 + i % 4) for _ in range(random.randint(0, 50))]
        if i % 3 == 0:
            t = t[:4] + t[4 : 4 + random.randint(1, 6)] * random.randint(2, 7) + t[10:16]
        for least in (1, 12):
            assert runs.runs_of(t, least) == brute_runs(t, least)
        words = np.array(t, dtype=np.int64)
        first, end = runs.repeated_stretches(np.zeros(len(t), dtype=np.int64), words, 6)
        assert sorted((a + s, n, p) for a, b in zip(first.tolist(), end.tolist()) for s, n, p in runs.runs_of(t[a:b])) == sorted(brute_runs(t, 12))


def test_no_place_is_compared_twice_at_a_distance():
    class Word:
        told = 0

        def __init__(self, x):
            self.x = x

        def __eq__(self, other):
            Word.told += 1
            return self.x == other.x

        def __lt__(self, other):
            Word.told += 1
            return self.x < other.x

    a, fibonacci = [0], [0, 1]
    while len(fibonacci) < 4000:
        a, fibonacci = fibonacci, fibonacci + a
    for t in ([0] * 4000, [0, 1] * 2000, fibonacci, [bin(i).count("1") % 2 for i in range(4096)], [random.randrange(50) for _ in range(400)] * 10):
        Word.told = 0
        runs.lyndon_array([Word(x) for x in t])
        assert Word.told < 12 * len(t)


def test_collapsed_texts(spark):
    texts = [None, "", " ", "one two", "ab " * 200, "\t".join("abc") + "\n", " ".join(f"w{i % 7}" for i in range(60)) + " end", " ".join(f"v{i}" for i in range(500)), "x " * 11, "x " * 12, "long " + "y z " * 30_000]
    texts += [" ".join(random.choices("ab", k=80)) for _ in range(30)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, "one two"), (None, "q " * 40)]
    frame = spark.createDataFrame([(*r, "x", 5) for r in rows], "doc_id long, text string, runs string, start long")
    got = runs.collapse_runs(frame).collect()
    assert len(got) == len(rows)
    held = {}
    for r in got:
        held.setdefault(r.doc_id, []).append(r)
    for doc, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        number = {}
        found = brute_runs([number.setdefault(w, len(number)) for w in words], 12) if len(words) < 1000 else [(1, 60_000, 2)]
        keep = [True] * len(words)
        for start, size, period in found:
            keep[start + period : start + size] = [False] * (size - period)
        for r in held[doc]:
            assert (r.n_words, [tuple(x) for x in r.runs], r.text) == (len(words), found, " ".join(w for w, k in zip(words, keep) if k))
    told = {r.doc_id: r for r in runs.digests(runs.collapse_runs(frame)).collect()}
    assert (told[0].n_runs, told[0].start, told[0].exponent_milli, told[0].runs_sha256) == (0, None, None, hashlib.sha256(b"").hexdigest())
    assert (told[4].start, told[4].length, told[4].period, told[4].exponent_milli, told[4].runs_sha256) == (0, 200, 1, 200_000, hashlib.sha256(b"0,200,1\n").hexdigest())
    assert runs.collapse_runs(frame.limit(0)).count() == 0


def test_runs_query_puts_periods_in(spark):
    import zlib

    rows = [(i, " ".join(f"w{j}" for j in range(random.choice([0, 1, 30, 90])))) for i in range(60)] + [(None, "a b c")]
    got = {r.doc_id: r.text for r in runs.repeated_tails(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    changed = 0
    for doc, text in rows:
        h = zlib.crc32(str(doc).encode()) if doc is not None else 1
        words, g = text.split(), h // 10
        if h % 10 == 0 and words:
            a = g % len(words)
            p = 1 + (len(words) - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
            changed += 1
        assert got[doc].split() == words
    assert changed


def test_very_long_words():
    codec = bpe.Codec(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=codec.ranks, special_tokens={})
    letters = "abcdefghijklmnopqrstuvwxyz"
    texts = ["a" * 20_001, "abc" * 5000, "".join(random.choices(letters, k=20_000)), "".join(random.choices("ab", k=9000)), "mississippi" * 900, "".join(random.choices("aé日本", k=5000)), "-" * 7001]
    for text in texts:
        assert codec.encode([text])[0] == np.array(plain.encode_ordinary(text), dtype="<u4").tobytes()


def test_words_of_many_letters_fit_in_memory():
    codec = bpe.Codec(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    coded = codec.encode(["a" * 1_500_000])[0]
    assert sum(len(codec.tokens[i]) for i in np.frombuffer(coded, dtype="<u4").tolist()) == 1_500_000


def test_known_chunks_are_not_split_again():
    codec = bpe.Codec(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=codec.ranks, special_tokens={})
    split, seen = codec.split, []
    codec.split = lambda text: seen.append(text) or split(text)
    texts = ["Some words, and (brackets).", "and Some (brackets)."]
    for text in texts:
        assert codec.encode([text])[0] == np.array(plain.encode_ordinary(text), dtype="<u4").tobytes()
    assert sorted(seen) == sorted(["Some", " words,", " and", " (brackets).", "and", " Some"])
    long = "x,1" * 50
    assert codec.encode([long, long]) == [np.array(plain.encode_ordinary(long), dtype="<u4").tobytes()] * 2 and long not in codec.words


def test_texts_are_kept_apart_whatever_is_held(monkeypatch):
    """Texts cut in chunks, texts cut into words and empty ones in turn; what is held and what one query decodes are much less than there is."""
    codec = bpe.Codec(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, most_held=5)
    monkeypatch.setattr(bpe, "MOST_IDS", 3)
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=codec.ranks, special_tokens={})
    white = [c for c in map(chr, range(0x110000)) if c.isspace()]
    texts = ["one two three", "", " lead", "trail ", "two  spaces", "x", "", "l'été 日本 x's", *[f"a{c} b{c}c {c}d {c}" for c in white], *[f"a{c}b c" for c in white], " ", ""]
    for _ in range(2):
        coded = codec.encode(texts)
        assert coded == [np.array(plain.encode_ordinary(t), dtype="<u4").tobytes() for t in texts]
        assert codec.decode(coded) == [t.encode() for t in texts]
    assert codec.decode([]) == [] and codec.encode([]) == []


def test_other_patterns():
    path, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), r"\p{L}+|\p{N}+|\s"
    codec = bpe.Codec(path, pattern)
    plain = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=codec.ranks, special_tokens={})
    text = "Some words, 12345 and more.  Two  spaces\tand (brackets)"
    assert codec.encode([text])[0] == np.array(plain.encode_ordinary(text), dtype="<u4").tobytes()


def test_packing_of_many_classes_in_a_session(spark):
    """The linear program of 250 classes, solved in a process that has forked a JVM."""
    assert spark.range(1).count() == 1
    rng = np.random.default_rng(1)
    sizes, capacity = np.arange(1, 251), 256
    demand = rng.integers(1, 200, len(sizes)).astype(float)
    patterns = packing.column_generation(demand, sizes, capacity)
    uses = sum(used for _, used in patterns)
    assert uses >= (demand * sizes).sum() / capacity - 1e-6
    used = packing.rounded(patterns, demand, sizes, capacity)
    assert (sum(times * pattern for pattern, times in used) == demand).all() and all(pattern @ sizes <= capacity for pattern, _ in used)
    matrix = rng.normal(size=(60, 60))
    assert np.abs(packing.inverted(matrix) @ matrix - np.eye(60)).max() < 1e-8


def test_neighbours_of_tiny_and_huge_vectors(spark):
    rows = [(0, [1e-200, 0.0]), (1, [1.0, 0.0]), (2, [1e200, 1e200]), (50, [2.0, 1.0]), (3, [0.0, 1e-310])]
    got = ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()

    def cosine(a, b):
        a, b = (np.array(x) / max(x) for x in (a, b))
        return a @ b / math.sqrt(a @ a) / math.sqrt(b @ b)

    told = {(r.query_id, r.vec_id): r.score for r in got}
    assert len(told) == 8
    for query, vec in rows:
        for other, there in rows:
            if query % 50 == 0 and other != query:
                assert abs(told[query, other] - cosine(vec, there)) < 1e-12


def test_without_repeats_takes_columns_of_any_name(spark):
    text = "".join(random.choices("abcdef ", k=250))
    rows = [(1, f"x{text}", 5), (2, f"y{text}", 6), (3, None, 7), (3, "short", 8)]
    docs = spark.createDataFrame([(*r, 1, 2, 3, "t", [1]) for r in rows], "doc_id long, text string, n_chars int, __docloom_doc long, __docloom_mark int, __docloom_runs long, rest string, runs array<int>")
    got = suffix_dedup.without_repeats(docs, length=200)
    assert got.schema.simpleString() == docs.schema.simpleString()
    assert sorted((r.doc_id, r.text or "", r.n_chars) for r in got.collect() if r.text is not None) == [(1, "x", 1), (2, "y", 1), (3, "short", 5)]
    assert suffix_dedup.without_repeats(docs.limit(0)).count() == 0
