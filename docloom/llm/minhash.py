"""Near-duplicate documents by circulant MinHash, bands, and an exact check of full shingle sets.

A document's set holds its distinct word shingles as 64-bit hashes. A first permutation scatters them over 32-bit positions; a
second one, shifted by k, gives coordinate k of the signature, so that two permutations make all coordinates. The
first is a bijection of the hash space, of whose values the upper 32 bits count; the second is one of these. Coordinates are folded into bands. The numbers of rows and bands follow from the threshold: a
pair just at it shares a band with a probability of at least 1 - `miss`.

Equal sets become one class at once. Within a band's bucket, pairs are not all emitted: first every member is checked against the
bucket's smallest member, its hub. While a bucket's members lie in several components, further hubs follow, `hub_rounds` in all: each is the
member nearest to the hubs before it, as in a group of variants of one text that is the one with the fewest changes, to
which most of the group links. Of the other pairs, only those are checked that (1) the links so far leave in different
components, (2) the triangle inequality of the Jaccard distance over their exact distances to the first hub allows, and (3) sizes
allow: those of the sets, or in buckets with more than `small` such members, of the sets without rare shingles (see
_crowded_pairs). What (1) to (3) leave out cannot change a component, so no link between components is lost.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import bytes_of, cut, id_and_text, mixed, pieces
from docloom.llm.components import connected_components

_LOWERED = np.arange(256, dtype=np.uint8)
_LOWERED[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BYTE = mixed(np.arange(256, dtype=np.uint64), 1)
_P = 0x9E3779B97F4A7C15
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of an odd number and of its inverse, modulo 2**64."""
    size = 1 << max(16, (n - 1).bit_length())
    if size not in _powers:
        out = []
        for base in (_P, pow(_P, -1, 2**64)):
            p = np.ones(1, dtype=np.uint64)
            while len(p) < size:
                p = np.concatenate([p, p * np.uint64(pow(base, len(p), 2**64))])
            out.append(p)
        _powers.clear()
        _powers[size] = tuple(out)
    return _powers[size]


def word_hashes(flat: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The 64-bit hash of each word of a batch of texts, and how many words each text has."""
    low = _LOWERED[flat]
    word = ~_SPACE[low]
    edge = np.zeros(len(flat) + 1, dtype=bool)
    edge[ends] = True  # a word never goes on into the next text
    start = np.flatnonzero(word & (edge[:-1] | np.concatenate([[True], ~word[:-1]])))
    stop = np.flatnonzero(word & (edge[1:] | np.concatenate([~word[1:], [True]]))) + 1
    up, down = powers(len(flat) + 1)
    total = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(_BYTE[low] * up[: len(flat)], dtype=np.uint64)])
    value = mixed((total[stop] - total[start]) * down[start], 2) + (stop - start).astype(np.uint64)
    return mixed(value, 3), np.diff(np.searchsorted(start, ends))


def shingle_sets(flat: np.ndarray, ends: np.ndarray, size: int) -> Iterator[np.ndarray]:
    """Each text's sorted distinct shingle hashes: runs of `size` words, or all words of a text that has fewer."""
    words, counts = word_hashes(flat, ends)
    folded = words
    for i in range(1, size):
        folded = mixed(folded[: len(words) - i], 4) ^ words[i:] if len(words) > i else folded[:0]
    first = 0
    for n in counts.tolist():
        if n >= size:
            yield np.unique(mixed(folded[first : first + n - size + 1], 5))
        elif n:
            value = words[first : first + 1]
            for i in range(1, n):
                value = mixed(value, 4) ^ words[first + i : first + i + 1]
            yield mixed(value, 100 + n)
        else:
            yield words[:0]
        first += n


def signature(shingles: np.ndarray, length: int) -> np.ndarray:
    """Coordinate k: the minimum over the set of the second permutation at the first one's position, shifted by k."""
    placed = (mixed(shingles, 6) >> np.uint64(32)).astype(np.uint32)
    shift = np.arange(length, dtype=np.uint32)[:, None]
    best = np.full(length, 2**32 - 1, dtype=np.uint32)
    for i in range(0, len(placed), 512):
        x = placed[None, i : i + 512] + shift
        x ^= x >> np.uint32(16)
        x *= np.uint32(0x7FEB352D)
        x ^= x >> np.uint32(15)
        x *= np.uint32(0x846CA68B)
        x ^= x >> np.uint32(16)
        np.minimum(best, x.min(axis=1), out=best)
    return best


def band_keys(signatures: np.ndarray, bands: int, rows: int) -> np.ndarray:
    part = signatures.reshape(len(signatures), bands, rows).astype(np.uint64)
    key = np.broadcast_to(mixed(np.arange(bands, dtype=np.uint64), 7), part.shape[:2])
    for i in range(rows):
        key = mixed(key ^ part[:, :, i], 8)
    return key.view(np.int64)


def bands_for(threshold: float, rows: int = 6, miss: float = 1e-6) -> int:
    return max(1, math.ceil(math.log(miss) / math.log(1 - threshold**rows)))


def _sketch(size: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in pieces(batches, "text", 1 << 20):
            counts, digests, signatures = [], [], []
            for shingles in shingle_sets(*bytes_of(batch.column("text")), size):
                counts.append(len(shingles))
                digests.append(xxhash.xxh3_128_digest(shingles.tobytes()) if len(shingles) else None)
                if len(shingles):
                    signatures.append(signature(shingles, bands * rows))
            keys = band_keys(np.array(signatures, dtype=np.uint32).reshape(-1, bands * rows), bands, rows)
            ends = np.concatenate([[0], np.cumsum([bands * (n > 0) for n in counts])]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(digests, pa.binary()), pa.ListArray.from_arrays(pa.array(ends), pa.array(keys.ravel(), pa.int64()))], ["doc_id", "n_shingles", "digest", "keys"])

    return run


def _sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", 1 << 20):
            sets = [s.tobytes() for s in shingle_sets(*bytes_of(batch.column("text")), size)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sets, pa.binary())], ["doc_id", "hashes"])

    return run


def _exploded(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", 1 << 20):
            sets = list(shingle_sets(*bytes_of(batch.column("text")), size))
            at = pa.array(np.repeat(np.arange(len(sets)), [len(s) for s in sets]))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(at), pa.array(np.concatenate(sets).view(np.int64))], ["doc_id", "hash"])

    return run


def _crowded_pairs(members: DataFrame, texts: DataFrame, size: int, percent: int, crowded: int, allowed: F.Column) -> DataFrame:
    """(a, b): the pairs of open buckets that can be linked.

    Shingles that at most `crowded` of these documents have are rare. Two documents share at most as many shingles as the one with
    fewer others has of those, and what they share of rare ones. So pairs that share no rare shingle are judged by their
    numbers of others alone, and those that do are found, with how many, by a join on rare shingles. A document whose
    others are less than `percent` of its set can be linked by rare shingles only, so it never meets its bucket.
    """
    nodes = members.groupBy("id", "part").agg(F.max("n").alias("n"))
    hashes = cut(texts.join(nodes.select(F.col("id").alias("doc_id")), "doc_id").mapInArrow(_exploded(size), "doc_id long, hash long").select(F.col("doc_id").alias("id"), "hash").distinct())
    rare = cut(hashes.join(hashes.groupBy("hash").agg(F.count("*").alias("times")).where(F.col("times") <= crowded), "hash"))
    nodes = cut(nodes.join(rare.groupBy("id").agg(F.count("*").alias("rare")), "id", "left").select("id", "n", "part", (F.col("n") - F.coalesce("rare", F.lit(0))).alias("others")))

    def enough(shared: F.Column) -> F.Column:
        return F.lit(100) * shared >= F.lit(percent) * (F.col("x.n") + F.col("y.n") - shared)

    others = F.least("x.others", "y.others")
    placed = members.drop("size").join(nodes.select("id", "others"), "id").where(F.lit(100) * F.col("others") >= F.lit(percent) * F.col("n"))
    split = placed.groupBy("key").agg(F.min("part").alias("low"), F.max("part").alias("high")).where("low < high").select("key")
    placed = cut(placed.join(split, "key"))
    by_others = placed.alias("x").join(placed.alias("y"), (F.col("x.key") == F.col("y.key")) & allowed & enough(others))
    found = by_others.select(F.col("x.id").alias("a"), F.col("y.id").alias("b"))
    twice = rare.where("times > 1").select("hash", "id").join(nodes.select("id", "part"), "id")
    sharing = twice.alias("x").join(twice.alias("y"), (F.col("x.hash") == F.col("y.hash")) & (F.col("x.part") < F.col("y.part"))).groupBy(F.col("x.id").alias("a"), F.col("y.id").alias("b")).agg(F.count("*").alias("shared"))
    by_rare = sharing.join(nodes.alias("x"), F.col("a") == F.col("x.id")).join(nodes.alias("y"), F.col("b") == F.col("y.id")).where(enough(F.col("shared") + others))
    return found.unionByName(by_rare.select("a", "b"))


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        told = []
        for left, right in zip(batch.column("hashes_a"), batch.column("hashes_b")):
            x, y = (np.frombuffer(v.as_buffer(), dtype=np.uint64) for v in (left, right))
            few, many = (x, y) if len(x) <= len(y) else (y, x)
            at = np.searchsorted(many, few)
            told.append((int(np.count_nonzero(many[np.minimum(at, len(many) - 1)] == few)), len(x), len(y)))
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), *(pa.array([t[i] for t in told], pa.int64()) for i in range(3))], ["a", "b", "shared", "n_a", "n_b"])


def _checked(pairs: DataFrame, texts: DataFrame, size: int) -> DataFrame:
    """(a, b, shared, n_a, n_b) for pairs (a, b) of doc_ids: how many shingles the full sets share and have. Only texts that occur in pairs are moved.

    The sets are written once before they are joined: both joins read them, and as nothing but a join follows their exchange, Spark can
    split the pairs of a hub that has very many.
    """
    wanted = pairs.select(F.col("a").alias("doc_id")).unionByName(pairs.select(F.col("b").alias("doc_id"))).distinct()
    sets = texts.join(wanted, "doc_id").mapInArrow(_sets(size), "doc_id long, hashes binary")
    one = cut(sets.groupBy("doc_id").agg(F.max(F.struct(F.length("hashes").alias("n"), "hashes")).alias("most")).select("doc_id", "most.hashes"))
    first = pairs.join(one.select(F.col("doc_id").alias("b"), F.col("hashes").alias("hashes_b")), "b")
    both = first.join(one.select(F.col("doc_id").alias("a"), F.col("hashes").alias("hashes_a")), "a")
    return both.select("a", "b", "hashes_a", "hashes_b").mapInArrow(_shared, "a long, b long, shared long, n_a long, n_b long")


def _open(placed: DataFrame, part: DataFrame) -> DataFrame:
    """The members (key, id, n, far, nearest) of buckets whose members lie in several components, with part and the bucket's size."""
    placed = placed.join(part.select(F.col("node").alias("id"), "component"), "id", "left").withColumn("part", F.coalesce("component", "id")).drop("component")
    open_keys = placed.groupBy("key").agg(F.min("part").alias("low"), F.max("part").alias("high"), F.count("*").alias("size")).where("low < high").select("key", "size")
    return cut(placed.join(open_keys, "key"))


def _joined(part: DataFrame, links: DataFrame) -> DataFrame:
    """The components (node, component) when links (a, b) are added."""
    links = cut(links.select("a", "b"))
    return part if links.isEmpty() else connected_components(part.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(links))


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80, rows: int = 6, miss: float = 1e-6, crowded: int = 64, small: int = 8, hub_rounds: int = 2) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept.

    Words are what `[^\\x20\\x09-\\x0D]+` matches after A-Z are lower-cased; the set holds the distinct shingles of `size` words,
    or all words as one shingle if there are fewer. Documents with 100 * shared >= percent * union are linked; component_id is
    the smallest doc_id reachable over links. Texts without words, and null texts, have an empty set and are linked with
    nothing. Rows with a null doc_id are linked with nothing either: null component_id, kept. Rows that repeat a doc_id form one
    node (whose links are those of its largest set, if their texts differ). kept is doc_id = component_id.
    """
    bands = bands_for(percent / 100, rows, miss)
    texts = id_and_text(docs)
    sketches = cut(texts.mapInArrow(_sketch(size, bands, rows), "doc_id long, n_shingles long, digest binary, keys array<long>"))
    classes = cut(sketches.where("n_shingles > 0 and doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("id"), F.first("n_shingles").alias("n"), F.first("keys").alias("keys")))

    entries = classes.select("id", "n", F.explode("keys").alias("key"))
    heads = entries.groupBy("key").agg(F.min("id").alias("hub"), F.count("*").alias("members")).where("members > 1").select("key", "hub")
    members = cut(entries.join(heads, "key").where("id <> hub").select("key", "id", "n", "hub"))
    jaccard = F.col("shared") / (F.col("n_a") + F.col("n_b") - F.col("shared"))
    linked = F.lit(100) * F.col("shared") >= F.lit(percent) * (F.col("n_a") + F.col("n_b") - F.col("shared"))
    spokes = cut(_checked(members.select(F.col("hub").alias("a"), F.col("id").alias("b")).distinct(), texts, size))
    part = connected_components(spokes.where(linked).select("a", "b"))

    # what the spokes leave open within a bucket
    far = spokes.select(F.col("a").alias("hub"), F.col("b").alias("id"), (1 - jaccard).alias("far"))
    still = _open(members.join(far, ["hub", "id"]).select("key", "id", "n", "far", F.col("far").alias("nearest")), part)
    ends = [F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")]
    for _ in range(hub_rounds - 1):
        heads = still.groupBy("key").agg(F.min(F.struct("nearest", "id", "part")).alias("hub")).select("key", F.col("hub.id").alias("a"), F.col("hub.part").alias("hub_part"))
        others = still.drop("size").join(heads, "key").withColumn("b", F.col("id")).where("a <> b")
        asked = cut(others.where("part <> hub_part").select(*ends).distinct())
        if asked.isEmpty():
            break
        told = cut(_checked(asked, texts, size))
        part = _joined(part, told.where(linked))
        now = others.withColumns({"a": F.least("a", "b"), "b": F.greatest("a", "b")}).join(told.select("a", "b", (1 - jaccard).alias("far_now")), ["a", "b"], "left")
        still = _open(now.select("key", "id", "n", "far", F.least("nearest", "far_now").alias("nearest")), part)

    reach = 1 - percent / 100 + 1e-9
    allowed = (F.col("x.part") < F.col("y.part")) & (F.abs(F.col("x.far") - F.col("y.far")) <= reach)
    sizes = F.lit(100) * F.least("x.n", "y.n") >= F.lit(percent) * F.greatest("x.n", "y.n")
    few, many = still.where(F.col("size") <= small), still.where(F.col("size") > small)
    rest = few.alias("x").join(few.alias("y"), (F.col("x.key") == F.col("y.key")) & allowed & sizes).select(F.col("x.id").alias("a"), F.col("y.id").alias("b"))
    if not many.isEmpty():
        rest = rest.unionByName(_crowded_pairs(many, texts, size, percent, crowded, allowed))
    rest = cut(rest.select(*ends).distinct())
    part = _joined(part, _checked(rest, texts, size).where(linked))

    named = classes.select("digest", "id").join(part.select(F.col("node").alias("id"), "component"), "id", "left").select("digest", F.coalesce("component", "id").alias("component"))
    return (
        sketches.select("doc_id", "n_shingles", "digest")
        .join(named, "digest", "left")
        .select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )


def keep_representatives(docs: DataFrame, **parameters) -> DataFrame:
    """The rows of `docs`, with all their columns whatever their names, but for those that a smaller doc_id of their component stands for.

    Rows with a null doc_id, a null text or a text without words stay. Rows that repeat a doc_id stay or go together. An empty
    table gives an empty result.
    """
    gone = near_duplicates(docs, **parameters).where("not kept").select("doc_id").distinct().alias("gone")
    return docs.alias("d").join(gone, F.col("d.doc_id").cast("long") == F.col("gone.doc_id"), "left_anti")
