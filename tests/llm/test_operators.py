"""Each operator against brute force, with nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import base64
import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from docloom.llm import ann, bpe, exact_dedup, language_id, minhash, packing, sharding, suffix_dedup, token_counts, url_filter

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, shard int, component_id long, kept boolean, digest string"
random.seed(5)
WORDS = ["".join(random.choice("abcdefghijklmnop") for _ in range(random.randint(2, 8))) for _ in range(300)]


def prose(n):
    return " ".join(random.choice(WORDS) for _ in range(n))


PASSAGE = prose(70)
NEAR = prose(120).split()
TEXTS = [
    "", " ", "a", "A b", "Straße ñandú été 日本語 🙂", "\n\n\t  x", None, None, prose(3000), "aaaa" * 150, "ab " * 200, *[prose(random.randint(1, 90)) for _ in range(40)],
    *[f"{prose(9)} {PASSAGE} {prose(12)}" for _ in range(4)], *["Copy of one text, many times over."] * 7,
    *[" ".join([*NEAR[:i], "changed", *NEAR[i + 1 :]]) for i in (5, 50, 90)], " ".join(NEAR).upper(),
]
ROWS = [(i, t, ("en", "de", None)[i % 3], f"s{i % 4}", None, 1, 2, True, "x") for i, t in enumerate(TEXTS)]
ROWS += [ROWS[12], ROWS[12], (None, "no id", "en", None, None, 1, 2, False, None), (None, None, None, None, None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_exact_dedup(docs, empty):
    got = exact_dedup.merge_runs(docs, runs=8, keep="largest").collect()
    groups = {}
    for doc, text, *_ in ROWS:
        groups.setdefault(text or "", []).append(doc)
    assert len(got) == len(ROWS)
    for r in got:
        ids = next(v for t, v in groups.items() if hashlib.sha256(t.encode()).hexdigest() == r.text_sha256 and r.doc_id in v)
        assert r.keep_id == max((i for i in ids if i is not None), default=None) and r.group_size == len(ids)
    assert sum(r.kept for r in got) == len(groups)
    assert exact_dedup.merge_runs(empty).count() == 0
    clashing = docs.withColumns({"stays": F.lit(1), "row": F.lit(2), "_kept_id": F.lit(3), "times": F.lit(4)})
    one = exact_dedup.keep_one(clashing, keep="largest")
    assert one.columns == clashing.columns and sorted(r.text or "" for r in one.collect()) == sorted(groups)
    assert {r.doc_id for r in one.collect()} == {max((i for i in ids if i is not None), default=None) for ids in groups.values()}
    assert exact_dedup.keep_one(empty).count() == 0


def test_digest_runs_merge_in_pairs(spark):
    """Each round halves the runs, keeps every digest once a run, and folds counts and extremes."""
    rows = spark.createDataFrame([(r, bytes([d // 3, d % 7, d]), 5, d, 10 * r + d, 1) for r in range(8) for d in range(20) if (r + d) % 3], "run int, digest binary, length int, check long, keep_id long, group_size long")
    want = {}
    for r in rows.collect():
        want.setdefault(r.check, []).append(r.keep_id)
    for k in range(3):
        rows = exact_dedup._round(rows, 1 << k, F.greatest)
        got = rows.collect()
        assert len({(r.run, r.check) for r in got}) == len(got) and {r.run for r in got} == set(range(0, 8, 2 << k))
    assert {r.check: (r.keep_id, r.group_size) for r in got} == {d: (max(ids), len(ids)) for d, ids in want.items()}


def sets_of(size):
    out = {}
    for doc, text, *_ in ROWS:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
        out[doc] = set(tuple(w[i : i + size]) for i in range(len(w) - size + 1)) if len(w) >= size else {tuple(w)} if w else set()
    return out


@pytest.mark.parametrize("size,percent", [(3, 85), (5, 80)])
def test_near_duplicates(docs, empty, size, percent):
    sets = sets_of(size)
    root = {i: i for i in sets if i is not None}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in root:
        for b in root:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]) and sets[b]:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    got = minhash.near_duplicates(docs, size=size, percent=percent).collect()
    assert len(got) == len(ROWS)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id, r.kept) == (len(sets[r.doc_id]), find(r.doc_id), find(r.doc_id) == r.doc_id)
    if size == 3:
        assert minhash.near_duplicates(empty).count() == 0


@pytest.mark.parametrize("crowded", [4, 10**6])
def test_crowded_buckets_lose_no_link(spark, crowded):
    rng = random.Random(3)
    base = [f"w{rng.randint(0, 10**6)}" for _ in range(100)]
    rows = []
    for i in range(90):
        words = list(base)
        for _ in range(rng.choice([0, 1, 2, 4, 6, 8])):
            words[rng.randrange(100)] = f"w{rng.randint(0, 300)}"
        rows.append((i * 7 % 90, " ".join(words)))
    sets = {i: set(zip(t.split(), t.split()[1:], t.split()[2:])) for i, t in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), size=3, percent=85, crowded=crowded)
    assert {r.doc_id: r.component_id for r in got.collect()} == {i: find(i) for i in sets}


def test_suffix_dedup(docs, empty):
    raw = [(doc, (text or "").encode()) for doc, text, *_ in ROWS]
    count = Counter(b[i : i + 200] for _, b in raw for i in range(len(b) - 199))
    want = Counter()
    for doc, b in raw:
        gone = bytearray(len(b))
        for i in range(len(b) - 199):
            if count[b[i : i + 200]] > 1:
                gone[i : i + 200] = b"\1" * 200
        kept = bytes(x for x, g in zip(b, gone) if not g)
        want[doc, len(b), sum(gone), sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1])), hashlib.sha256(kept).hexdigest()] += 1
    assert sum(w[2] for w in want) > 2000
    got = suffix_dedup.remove_repeats(docs)
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got.collect()) == want
    assert suffix_dedup.remove_repeats(empty).count() == 0
    left = suffix_dedup.without_repeats(docs)
    assert left.columns == docs.columns and left.count() == len(ROWS) and all(PASSAGE not in (r.text or "") for r in left.collect())


def test_no_frequent_trigger_is_dealt_whole(spark, monkeypatch):
    rng = random.Random(8)
    junk = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(n))
    footer, passage, tail = junk(190), junk(260), junk(12)
    texts = [junk(150) + footer + junk(150) for _ in range(40)] + [junk(99) + footer + tail + junk(9) for _ in range(9)] + [junk(50) + passage + junk(i) for i in range(20)] + [passage * 2] * 6
    count = Counter(t[i : i + 200] for t in texts for i in range(len(t) - 199))
    want = {}
    for doc, t in enumerate(texts):
        gone = bytearray(len(t))
        for i in range(len(t) - 199):
            if count[t[i : i + 200]] > 1:
                gone[i : i + 200] = b"\1" * 200
        want[doc] = hashlib.sha256(bytes(x for x, g in zip(t.encode(), gone) if not g)).hexdigest()
    real = suffix_dedup._repeats

    def watched(length):
        def run(batches):
            held = list(batches)
            most = Counter(k for b in held for k in b.column("key").to_pylist()).most_common(1)
            assert not most or most[0][1] <= 5, "a frequent key came to one task"
            yield from real(length)(iter(held))

        return run

    monkeypatch.setattr(suffix_dedup, "_repeats", watched)
    given = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    assert {r.doc_id: r.kept_sha256 for r in suffix_dedup.remove_repeats(given, frequent=5).collect()} == want


def test_bpe(docs, empty):
    import tiktoken

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    encode = tiktoken.Encoding("x", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    want = Counter((d, len(ids := encode(t or "")), hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()) for d, t, *_ in ROWS)
    got = bpe.round_trip(docs, path, public_tokenizers.PATTERN)
    assert Counter(map(tuple, got.collect())) == want
    assert bpe.round_trip(empty, path, public_tokenizers.PATTERN).count() == 0
    coded = bpe.encode_documents(docs, path, public_tokenizers.PATTERN)
    decoded = bpe.decode_documents(coded, path, public_tokenizers.PATTERN)
    assert Counter((r.doc_id, bytes(r.data)) for r in decoded.collect()) == Counter((d, (t or "").encode()) for d, t, *_ in ROWS)
    coder = bpe.codec(path, public_tokenizers.PATTERN)
    for odd in ["  a  b", "a b c", "x\x1cy \x1d z", "don't I'LL\n\n  new\t\tline \n", "é́ 🙂🙂", "z" * 700, "!?" * 99, " lead trail ", "e f g"]:
        assert np.frombuffer(coder.encode([odd])[0], dtype="<u4").tolist() == encode(odd) and coder.decode(coder.encode([odd])) == [odd.encode()]


def test_bpe_of_long_words(monkeypatch):
    import tiktoken

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    encode = tiktoken.Encoding("x", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    coder, rng = bpe.codec(path, public_tokenizers.PATTERN), random.Random(6)
    runs = ["".join(rng.choice(letters) for _ in range(n)) for letters, n in (("aab", 50_000), ("日本語中文", 50_000), ("abcdefghijklmnopqrstuvwxyz", 600))]
    for word in runs:
        assert np.frombuffer(coder.encode([word])[0], dtype="<u4").tolist() == encode(word) and coder.decode(coder.encode([word])) == [word.encode()]
    monkeypatch.setattr(bpe, "LONG", 70)  # contraction by whole ranks, on many words
    words = ["".join(rng.choice(letters) for _ in range(rng.randint(71, 300))) for letters in ("aab", "etaoinshr", "thehent", "éàaeiou", "abcdefghijklmnopqrstuvwxyz") for _ in range(25)]
    assert [np.frombuffer(c, dtype="<u4").tolist() for c in coder.encode(words)] == [encode(w) for w in words]


def test_token_counts(spark, docs, empty):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    counter = token_counts.Counter(path, public_tokenizers.PATTERN)
    rng = random.Random(1)
    bits = ["a", "b", " ", "  ", "\n", "'s", "'", "!", "1", "é", " the", " word", "S"]
    for _ in range(300):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(0, 30)))
        tree = token_counts.CountTree(text, counter)
        for _ in range(3):
            start, deleted, new = rng.randint(0, len(text) + 2), rng.randint(0, 4), "".join(rng.choice(bits) for _ in range(rng.randint(0, 3)))
            tree.edit(start, deleted, new)
            start = min(start, len(text))
            text = text[:start] + new + text[start + deleted :]
            leaves = [len(counter.encode(w)) for w in counter.pattern.findall(text)]
            assert tree.text == text and tree.leaves() == leaves and tree.total == sum(leaves)
            a = rng.randint(0, len(leaves))
            b = rng.randint(a, len(leaves))
            assert tree.between(a, b) == sum(leaves[a:b])
    long = token_counts.CountTree(TEXTS[8], counter)
    long.edit(5000, 3, "new")
    assert long.recounted < 8 < long.n_pretokens


def test_an_edit_touches_two_paths(monkeypatch):
    """Nodes made by an edit grow with the height of the tree, not with the text; heights stay balanced."""
    counter = token_counts.Counter(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    rng, made, real = random.Random(4), [0], token_counts._Node.__init__
    text = " ".join(rng.choice(WORDS) for _ in range(60_000))
    tree = token_counts.CountTree(text, counter)

    def heights(node):
        if node.first is not None:
            assert abs(node.first.height - node.second.height) <= 1
            heights(node.first)
            heights(node.second)

    def counted(self, *args, **kinds):
        made[0] += 1
        real(self, *args, **kinds)

    monkeypatch.setattr(token_counts._Node, "__init__", counted)
    for _ in range(60):
        start, deleted, new = rng.randint(0, len(text)), rng.randint(0, 40), prose(rng.randint(0, 3))
        made[0] = 0
        tree.edit(start, deleted, new)
        text = text[:start] + new + text[start + deleted :]
        assert made[0] < 12 * tree.root.height
    heights(tree.root)
    assert tree.leaves() == [len(counter.encode(w)) for w in counter.pattern.findall(text)]


def test_token_counts_of_edits(spark, docs, empty):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    counter = token_counts.Counter(path, public_tokenizers.PATTERN)
    edits = spark.createDataFrame([(8, 2, 0, 0, "Head "), (8, 1, 4, 10, None), (10, None, None, None, None), (None, 1, 0, 9, "x"), (999, 1, 0, 1, "y")], "doc_id long, edit_no long, start long, deleted long, inserted string")
    got = {r.doc_id: r for r in token_counts.count_edited(docs, edits, path, public_tokenizers.PATTERN).collect()}
    assert got[8].n_tokens_edited == len(counter.encode("Head " + TEXTS[8][:4] + TEXTS[8][14:])) and got[8].n_tokens == len(counter.encode(TEXTS[8]))
    assert got[10].n_tokens_edited == got[10].n_tokens == len(counter.encode(TEXTS[10])) and got[0].n_tokens == 0 and len(got) == len(TEXTS) + 1
    assert token_counts.count_edited(empty, edits, path, public_tokenizers.PATTERN).count() == 0
    own = {r.doc_id: r for r in token_counts.count_with_own_edits(docs, path, public_tokenizers.PATTERN).collect() if r.doc_id is not None}
    for doc in (8, 12, 0):
        text = f"s{doc % 4}\n" + (TEXTS[doc] or "")
        middle, head = len(TEXTS[doc]) // 2, len(f"s{doc % 4}") + 1
        text = text[: head + middle] + text[head + middle + 8 :]
        at = min(max(head + len(TEXTS[doc]) - 24, 0), len(text))
        text = text[:at] + f" {doc}" + text[at + 16 :]
        assert own[doc].n_tokens_edited == len(counter.encode(text)) and own[doc].n_tokens == len(counter.encode(TEXTS[doc]))


def test_url_filter(spark):
    urls = ["https://www.Example.org/es/a", "http://example.org/en/12", "http://a.org", "http://b.com/de/x?casino", "http://b.com/fr/casino-poker", "https://x.net/Casino/poker", "https://x.net/xxx/", "https://x.net/axxxb/", "no scheme poker casino", None, "", "http://u.net?feed=1&ref=2#://", "http://org/", "http://notexample.org:80/es/"]
    got = {r.page_id: r for r in url_filter.filter_urls(spark.createDataFrame([(i, u, "h", "p") for i, u in enumerate(urls)], "page_id long, url string, host string, path string")).collect()}
    assert [got[i].verdict for i in range(len(urls))] == ["block", "block", "allow", "block", "allow", "block", "block", "allow", "block", "allow", "allow", "allow", "allow", "allow"]
    assert [got[i].rule for i in range(5)] == ["example.org/es/", "example.org/en/1", None, "com/de/", "com/fr/"]
    assert (got[0].host, got[0].path) == ("www.example.org", "/es/a") and (got[8].host, got[8].path) == ("", "") and (got[11].host, got[11].path) == ("u.net", "") and got[13].rule is None
    assert url_filter.filter_urls(spark.createDataFrame([], "page_id long, url string")).count() == 0
    with pytest.raises(ValueError):
        url_filter.filter_urls(spark.createDataFrame([], "page_id long, url string"), soft=(("casino", 3),))


def test_url_vocabulary_decides_both_ways(spark):
    """Urls made of terms and plain words, between boundaries or not, against a plain count with regular expressions."""
    rng = random.Random(9)
    plain = ["news", "recipe", "page", "article", "2024", "sussex", "scrapbook", "betting2", "feed", "ref", "utm", "essex"]
    terms = [*url_filter.STRICT[:6], *list(url_filter.SOFT)[::3]]
    urls = ["https://site.net/" + "".join(rng.choice([w, w.upper()]) + rng.choice(["-", "/", ".", "_", "?q=", "%", "x", "é"]) for w in rng.choices(terms if rng.random() < 0.3 else plain + terms[6:9], k=rng.randint(1, 6))) for _ in range(600)]
    urls += ["https://site.net/" + "page/" * 40_000 + "casino-poker", urls[0], urls[0]]

    def judged(url):
        low = re.sub("[A-Z]", lambda m: m[0].lower(), url)
        here = lambda t: re.search(f"(?<![a-z0-9]){t}(?![a-z0-9])", low)
        strict, soft = [t for t in url_filter.STRICT if here(t)], [w for t, w in url_filter.SOFT.items() if here(t)]
        return ("block" if strict or sum(soft) >= 3 else "allow", len(strict), len(soft), sum(soft))

    got = {r.page_id: (r.verdict, r.strict_hits, r.soft_hits, r.soft_weight) for r in url_filter.filter_urls(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")).collect()}
    assert got == {i: judged(u) for i, u in enumerate(urls)}
    assert 100 < sum(v[0] == "block" for v in got.values()) < 500
    assert judged("https://e.net/article?utm_source=feed&ref=x")[0] == judged("https://e.net/essex/cheap-flights")[0] == "allow"


def test_sharding(docs, empty, spark):
    got = sharding.shard_documents(docs, shards=5).collect()
    counts = Counter(r.shard for r in got)
    assert len(got) == len(ROWS) and max(counts.values()) - min(counts.values()) <= 1 and set(counts) == set(range(5))
    assert all(sorted(r.slot for r in got if r.shard == s) == list(range(n)) for s, n in counts.items())
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == Counter((d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t, *_ in ROWS)
    place = sorted((r.shard, r.slot) for r in got if r.text_crc32 == zlib.crc32(b"Copy of one text, many times over."))
    order = sorted((r.shard, r.slot) for r in got)
    assert order.index(place[-1]) - order.index(place[0]) == 6  # equal texts lie side by side
    assert sharding.shard_documents(empty).count() == 0
    few = sharding.shard_documents(spark.createDataFrame(ROWS[:3], SCHEMA), shards=24).collect()
    assert len({r.shard for r in few}) == 3


def test_written_shards_prune(spark, docs, empty, tmp_path):
    import glob

    import pyarrow.parquet as pq

    rng = random.Random(3)
    rows = [(i, f"{i} " + "x" * int(10 ** rng.uniform(0, 4)), rng.choice("abcd"), f"site-{rng.randrange(40):02d}", None, 1, 2, True, "x") for i in range(2000)]
    made = spark.createDataFrame(rows, SCHEMA)
    sharding.write_shards(made, str(tmp_path / "s"), shards=16)
    made.repartition(16).write.parquet(str(tmp_path / "plain"))
    assert Counter(tuple(r) for r in spark.read.parquet(str(tmp_path / "s")).select(*made.columns).collect()) == Counter(rows)

    def read(folder, column, low, high):
        told = [pq.ParquetFile(f).metadata.row_group(0) for f in glob.glob(f"{tmp_path}/{folder}/**/*.parquet", recursive=True)]
        place = SCHEMA.replace(",", "").split()[::2].index(column)
        return sum(m.num_rows for m in told if m.column(place).statistics.min <= high and m.column(place).statistics.max >= low)

    for column, low, high in (("lang", "b", "b"), ("source", "site-07", "site-09")):
        assert read("s", column, low, high) < 0.7 * 2000 == 0.7 * read("plain", column, low, high)
    sharding.write_shards(docs, str(tmp_path / "edge"), shards=5)
    assert spark.read.parquet(str(tmp_path / "edge")).count() == len(ROWS)
    sharding.write_shards(empty, str(tmp_path / "none"), shards=5)
    with pytest.raises(ValueError):
        sharding.write_shards(docs.withColumn("hilbert_shard", F.lit(1)), str(tmp_path / "clash"))


def test_hilbert_curve():
    side = 8
    points = np.array([(a, b, c) for a in range(side) for b in range(side) for c in range(side)])
    index = sharding.hilbert_index(list(points.T), 3)
    assert sorted(index) == list(range(side**3))
    steps = np.abs(np.diff(points[np.argsort(index)], axis=0)).sum(axis=1)
    assert (steps == 1).all()


def test_packing(docs, empty):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    ids = {d: tokenizer.encode(t or "", add_special_tokens=False).ids + [2] for d, t, *_ in ROWS if d is not None}
    got = packing.pack(docs, path, length=256).collect()
    times = Counter(d for d, *_ in ROWS)
    by_doc, by_sequence = {}, {}
    for r in got:
        by_sequence.setdefault(r.sequence_id, []).append(r)
        if r.doc_id is not None:
            assert r.doc_tokens == len(ids[r.doc_id]) and r.ids_crc32 == zlib.crc32(np.array(ids[r.doc_id][r.start : r.start + r.length], dtype="<u4").tobytes())
            by_doc.setdefault(r.doc_id, []).append((r.start, r.length))
    for doc, held in by_doc.items():
        assert sum(n for _, n in held) == times[doc] * len(ids[doc])
    for held in by_sequence.values():
        at = 0
        for r in sorted(held, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 256
    total = sum(r.length for r in got)
    assert len(by_sequence) <= total / 256 * 1.1 + 1 and set(by_doc) == set(ids)
    assert packing.pack(empty, path).count() == 0
    odd = ["İ,", "Σας.", "a b", "x\x1cy", "é!", "<|endoftext|>", "it's.", "don'T,,", "1.5, 2²."]
    assert [np.frombuffer(x, dtype="<u4").tolist() for x in packing.token_ids(odd, path)] == [tokenizer.encode(t, add_special_tokens=False).ids for t in odd]


def test_other_tokenizers_are_not_put_together_from_words():
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    texts, tokenizer = ["Hello,  wide World!\n don't", "", "Straße 日本語 🙂"], Tokenizer.from_file(path)
    assert packing._by_words(public_tokenizers.path("word_bpe_49k.json")) and not packing._by_words(path)
    assert [np.frombuffer(x, dtype="<u4").tolist() for x in packing.WordIds(path).encode(texts)] == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_column_generation_meets_demand():
    rng = np.random.default_rng(0)
    for n in (1, 7, 400):
        histogram = {int(c): int(k) for c, k in zip(*np.unique(rng.integers(1, 65, n), return_counts=True))}
        places = packing.places_of(histogram, 64)
        for c, k in histogram.items():
            ranges = sorted((low, high) for of, low, high, *_ in places if of == c)
            assert ranges[0][0] == 0 and ranges[-1][1] == k and all(a[1] == b[0] for a, b in zip(ranges, ranges[1:]))
        used = Counter()
        for c, low, high, per, first in places:
            for r in range(low, high):
                used[first + (r - low) // per] += c
        assert max(used.values()) <= 64 and len(used) <= sum(c * k for c, k in histogram.items()) / 64 * 1.08 + 2
    assert packing.places_of({}, 64) == []


def test_language_id(spark, docs, empty):
    rng = random.Random(2)
    say = {"en": ["the", "and", "with", "house", "this"], "de": ["und", "der", "größe", "nicht", "haus"], "fr": ["être", "les", "avec", "maison", "où"]}
    rows = [(i, " ".join(rng.choice(say[lang]) for _ in range(rng.randint(3, 30))), lang, None) for i in range(300) for lang in [rng.choice(list(say))]]
    rows += [(1000, None, "en", None), (1001, "12 !?", "en", None), (1002, "", None, None), (1003, "the house and this", None, None), (None, "die größe und der", "de", None)]
    rows += [(1004, "これは学習していない言語の文章です", None, None), (1005, "the house and this " * 9000, None, None), rows[0], rows[0]]
    data = spark.createDataFrame(rows, "doc_id long, text string, lang string, lang_pred string")
    got = language_id.identify(data).collect()
    assert len(got) == len(rows)
    truth = {d: lang for d, _, lang, _ in rows}
    held = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id < 1000]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got if r.doc_id is not None)
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in held]) > 0.95 and all(0 <= r.score <= 1 for r in got)
    by = {r.doc_id: r for r in got}
    assert [by[i].lang_pred for i in (1000, 1001, 1002, 1003, None)] == ["und", "und", "und", "en", "de"] and by[1000].score == 0
    kept = language_id.keep_identified(data.withColumns({"lift": F.lit("x"), "score": F.lit(0)}))
    assert kept.columns == [*data.columns, "lift", "score"] and Counter(r.doc_id for r in kept.collect()) == Counter(r[0] for r in rows if r[0] not in (1000, 1001, 1002, 1004))
    assert by[1004].lift < 0 < by[1003].lift and by[1005].lang_pred == "en" and language_id.keep_identified(empty).count() == 0
    assert language_id.identify(empty).count() == 0
    assert {r.lang_pred for r in language_id.identify(data.withColumn("lang", data.lang_pred)).collect()} == {"und"}  # nothing to learn from


def test_language_posteriors_by_hand(spark):
    """Counts, smoothing, priors, posterior and lift of a small table, by loops over single characters."""
    import math

    bits, rows = 9, [(i, t, lang) for i, (t, lang) in enumerate([("Ab ba!", "x"), ("aé", "y"), ("bbb a", "x"), ("ça é", "y"), ("zz top", "x"), ("Éa 1b", "y"), ("ab", None), ("?", "x"), ("qq", None)])]

    def grams(text):
        c = [" ", *(ch if ch.isalpha() else " " for ch in text.lower()), " "]
        for i in range(1, len(c) - 1):
            if c[i].isalpha():
                pair = (ord(c[i - 1]) * 0x01000193 ^ ord(c[i]) * 0x85EBCA6B) % 2**32
                for value, salt in ((pair, 0x1B873593), ((pair * 0xC2B2AE35 ^ ord(c[i + 1]) * 0x27D4EB2F) % 2**32, 0xCC9E2D51)):
                    value = (value ^ value >> 15) * salt % 2**32
                    yield (value ^ value >> 13) >> 32 - bits

    learned = [(t, lang) for i, t, lang in rows if lang and zlib.crc32(str(i).encode()) % 5]
    count = {lang: Counter(g for t, of in learned if of == lang for g in grams(t)) for lang in "xy"}
    got = {r.doc_id: r for r in language_id.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string"), bits=bits).collect()}
    for i, text, _ in rows:
        log = {lang: sum(math.log((count[lang][g] + 0.5) / (count[lang].total() + 0.5 * 2**bits)) for g in grams(text)) for lang in "xy"}
        post = {lang: log[lang] + math.log(sum(of == lang for _, of in learned) / len(learned)) for lang in "xy"}
        best = max("xy", key=post.get)
        if list(grams(text)):
            assert got[i].lang_pred == best and abs(got[i].score - 1 / sum(math.exp(p - post[best]) for p in post.values())) < 1e-4
            assert abs(got[i].lift - (log[best] / len(list(grams(text))) + bits * math.log(2))) < 1e-4
    with pytest.raises(ValueError):
        language_id.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), most_languages=1)


def test_a_rare_language_is_learned(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice(["the", "and", "with"]) for _ in range(9)), "en") for i in range(3000)] + [(5000 + i, " ".join(rng.choice(["und", "nicht", "der"]) for _ in range(9)), "de") for i in range(12)]
    got = language_id.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string"), fit_rows=40).collect()
    assert all(r.lang_pred == ("de" if r.doc_id >= 5000 else "en") for r in got)


def test_nearest(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(12, 16))
    vectors = centres[rng.integers(0, 12, 1500)] + 0.4 * rng.normal(size=(1500, 16))
    vectors[600:900] = vectors[7]  # a group of copies
    rows = [(i, v.tolist(), 0) for i, v in enumerate(vectors)]
    rows += [rows[3], (2000, None, 0), (2050, [0.0] * 16, 0), (2100, [1.0, None] * 8, 0), (2150, [float("nan")] * 16, 0), (2200, [], 0), (None, [1.0] * 16, 0), (2250, [1.0, 2.0], 0)]
    got = ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>, shard int"), shard_size=400, degree=16, beam=48).collect()
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    found = total = 0
    for q in range(0, 1500, 50):
        score = unit @ unit[q]
        score[q] = -9
        mine = sorted((r.rank, r.vec_id, r.score) for r in got if r.query_id == q)
        assert [m[0] for m in mine] == [1, 2, 3, 4, 5]
        assert all(abs(s - score[v]) < 1e-9 for _, v, s in mine)
        assert [(-round(s, 12), v) for _, v, s in mine] == sorted((-round(s, 12), v) for _, v, s in mine)
        found += sum(1 for *_, s in mine if s >= np.sort(score)[-5] - 1e-9)
        total += 5
    assert found / total >= 0.95 and not any(r.query_id >= 1500 for r in got)
    assert [r.vec_id for r in sorted((r for r in got if r.query_id == 650), key=lambda r: r.rank)] == [7, 600, 601, 602, 603]
    assert ann.nearest(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
