"""Packing token sequences as a cutting-stock problem, solved by column generation.

Each task tokenises its documents once and cuts every document into full blocks of the sequence length and a remainder. The
histogram of piece lengths, in classes of `grain` tokens (a bounded table, whatever the corpus), goes to the driver. There a
linear program over packing patterns is solved by the simplex method; a knapsack dynamic program prices new patterns with the
dual values, until none improves the bound by more than `gap`. Patterns are used a whole number of times, and what rounding
leaves is packed best fit, as patterns that are used once. The pieces of each class are then ranked, as a Spark job, and
the piece of rank r takes the r-th place that the patterns have for its class, by a join with the (bounded) table of patterns.

Ranks do not need a task for a class: pieces are numbered within (class, salt), with as many salts as keep a salt's pieces near
`rows_a_salt`, and the salts of a class within a table of classes * salts rows. Pieces that fill a sequence are not ranked at all.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docloom.llm.common import cut, id_and_text, pieces

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
_held: dict[str, WordIds] = {}


# The rules of tokenizer files whose ids can be put together from words.
NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
SPLIT = {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True}


def _by_words(path: str) -> bool:
    """Whether the file has the rules that WordIds relies on."""
    with open(path, encoding="utf-8") as file:
        told = json.load(file)
    steps, model = (told.get("pre_tokenizer") or {}).get("pretokenizers", [{}, {}]), told["model"]
    return (
        told.get("normalizer") == NORMALIZER
        and len(steps) == 2
        and steps[0] == SPLIT
        and (steps[1].get("type"), steps[1].get("add_prefix_space"), steps[1].get("use_regex")) == ("ByteLevel", False, False)
        and (model.get("type"), model.get("end_of_word_suffix"), model.get("dropout"), told.get("truncation")) == ("BPE", "</w>", None, None)
    )


class WordIds:
    """The ids of words, worked out once in a Python worker; at most `most_held` words are kept. Texts of a tokenizer file with other
    rules than those below are encoded whole.

    The tokenizer drops white space and lets no token cross it, so the ids of a text are those of its chunks between ASCII
    spaces and line ends. A chunk of letters or digits and then stops, commas or exclamation marks has the ids of its two
    parts. Words of letters only are one pre-token each, whose last token is marked in the vocabulary; so many of them are
    encoded as one text and told apart by that mark. Texts of Latin-1 characters are lower-cased first, as the tokenizer would.
    """

    def __init__(self, path: str, most_held: int = 600_000):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.by_words = _by_words(path)
        words = self.tokenizer.get_vocab()
        self.last = np.zeros(max(words.values()) + 1, dtype=bool)
        self.last[[i for w, i in words.items() if w.endswith("</w>")]] = True
        self.words: dict[str, bytes] = {"": b""}
        self.most = most_held

    def _learn(self, words: set[str]) -> None:
        fresh = words.difference(self.words)
        if len(self.words) + len(fresh) > self.most:
            self.words = {"": b""}
            fresh = words.difference(self.words)
        plain = [w for w in fresh if w.isalpha() and w.lower().isalpha()]
        for i in range(0, len(plain), 10_000):
            part = plain[i : i + 10_000]
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, dtype="<u4")
            ends = (np.flatnonzero(self.last[ids]) + 1) * 4
            if len(ends) == len(part):
                raw = ids.tobytes()
                self.words.update(zip(part, (raw[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist()))))
        rest = [w for w in fresh if w not in self.words]
        for i in range(0, len(rest), 10_000):
            part = rest[i : i + 10_000]
            for word, got in zip(part, self.tokenizer.encode_batch_fast(part, add_special_tokens=False)):
                self.words[word] = np.array(got.ids, dtype="<u4").tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit integers."""
        if not self.by_words:
            return [np.array(got.ids, dtype="<u4").tobytes() for got in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        chunked = [_lowered(t).replace("\n", " ").replace("\r", " ").replace("\t", " ").split(" ") for t in texts]
        parts = {}
        for chunk in set().union(*chunked):
            word = chunk.rstrip(".,!")
            parts[chunk] = (word, chunk[len(word) :]) if word and len(word) < len(chunk) and (word[-1].lower().isalpha() or word[-1] in "0123456789") else (chunk, "")
        self._learn({w for pair in parts.values() for w in pair})
        held = self.words
        ids = {chunk: held[word] + held[rest] for chunk, (word, rest) in parts.items()}
        return [b"".join(map(ids.__getitem__, chunks)) for chunks in chunked]


def _lowered(text: str) -> str:
    if not text.isascii():
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return text
    return text.lower()


def token_ids(texts: list[str], path: str) -> list[bytes]:
    if path not in _held:
        _held.clear()
        _held[path] = WordIds(path)
    return _held[path].encode(texts)


def _cut_up(path: str, length: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = np.array([end_id], dtype="<u4").tobytes()
        for batch in pieces(batches, "text"):
            out: list[tuple] = []
            for doc, ids in zip(batch.column("doc_id").to_pylist(), token_ids(batch.column("text").to_pylist(), path)):
                ids += end
                n = len(ids) // 4
                out.extend((doc, s, min(length, n - s), zlib.crc32(ids[4 * s : 4 * (s + length)]), n) for s in range(0, n, length))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return run


def knapsack(prices: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """For each capacity up to `capacity`, the greatest value of items that fit in it (each any number of times), and the size of
    an item that reaches it (0: leave a unit empty), by dynamic programming."""
    price = np.full(capacity + 1, -np.inf)
    price[sizes] = prices
    value, taken = np.zeros(capacity + 1), np.zeros(capacity + 1, dtype=np.int64)
    for w in range(1, capacity + 1):
        gain = value[:w][::-1] + price[1 : w + 1]
        best = int(gain.argmax())
        value[w], taken[w] = (gain[best], best + 1) if gain[best] > value[w - 1] + 1e-12 else (value[w - 1], 0)
    return value, taken


def pattern_of(taken: np.ndarray, sizes: np.ndarray, w: int) -> np.ndarray:
    """How often each size occurs in the best filling of capacity w."""
    pattern = np.zeros(len(sizes), dtype=np.int64)
    while w > 0:
        if taken[w]:
            pattern[np.searchsorted(sizes, taken[w])] += 1
        w -= max(1, int(taken[w]))
    return pattern


def inverted(matrix: np.ndarray) -> np.ndarray:
    """The inverse of a regular matrix by Gauss-Jordan steps with row pivots, in plain array arithmetic: no call into threaded BLAS or
    LAPACK, whose threads may never come back in a process that has forked, such as a Spark driver's."""
    n = len(matrix)
    work = np.concatenate([matrix.astype(float), np.eye(n)], axis=1)
    for i in range(n):
        pivot = i + int(np.abs(work[i:, i]).argmax())
        work[[i, pivot]] = work[[pivot, i]]
        work[i] /= work[i, i]
        factor = work[:, i].copy()
        factor[i] = 0
        some = np.flatnonzero(factor)
        work[some] -= factor[some, None] * work[i]
    return work[:, n:]


def times(matrix: np.ndarray, vector: np.ndarray) -> np.ndarray:
    """matrix @ vector, without BLAS."""
    return (matrix * vector).sum(axis=1)


def column_generation(demand: np.ndarray, sizes: np.ndarray, capacity: int, gap: float = 2e-3, columns: int = 4) -> list[tuple[np.ndarray, float]]:
    """Patterns and how often each is used in the linear program: uses sum to the least, within `gap`, that meets the demand.

    Each pricing yields the best pattern, and the best ones around other items; those that still improve the bound when their turn
    comes enter the basis, `columns` at most, before prices are made anew.
    """
    m = len(sizes)
    basis = np.diag(capacity // sizes).astype(float)
    inverse = inverted(basis)
    uses, pivots = times(inverse, demand), 0
    while pivots < 40 * m + 40:
        prices = inverse.sum(axis=0)
        value, taken = knapsack(prices, sizes, capacity)
        if value[capacity] <= 1 + gap:
            break
        for i in np.argsort(-(prices + value[capacity - sizes]))[:columns].tolist():
            pattern = pattern_of(taken, sizes, int(capacity - sizes[i]))
            pattern[i] += 1
            if float((inverse.sum(axis=0) * pattern).sum()) <= 1 + gap:
                continue
            change = times(inverse, pattern)
            ratio = np.where(change > 1e-9, uses / np.where(change > 1e-9, change, 1), np.inf)
            out = int(ratio.argmin())
            basis[:, out] = pattern
            pivots += 1
            if pivots % 100 == 0:
                inverse = inverted(basis)
                uses = np.maximum(times(inverse, demand), 0)
            else:
                step = ratio[out]
                uses = np.maximum(uses - step * change, 0)
                uses[out] = step
                row = inverse[out] / change[out]
                inverse -= change[:, None] * row
                inverse[out] = row
    return [(np.rint(basis[:, i]).astype(np.int64), float(uses[i])) for i in range(m)]


def rounded(patterns: list[tuple[np.ndarray, float]], demand: np.ndarray, sizes: np.ndarray, capacity: int) -> list[tuple[np.ndarray, int]]:
    """Whole uses of patterns that meet the demand exactly: the program's, rounded down, and best fit for what that leaves."""
    left, out = demand.astype(np.int64).copy(), []
    for pattern, used in sorted(patterns, key=lambda p: -p[1]):
        some = pattern > 0
        times = min(int(used + 1e-6), int((left[some] // pattern[some]).min())) if some.any() else 0
        if times > 0:
            out.append((pattern, times))
            left -= times * pattern
    bins: list[list] = []
    for i in np.argsort(-sizes):
        for _ in range(int(left[i])):
            fits = [b for b in bins if b[0] >= sizes[i]]
            if not fits:
                bins.append([capacity, np.zeros(len(sizes), dtype=np.int64)])
                fits = bins[-1:]
            best = min(fits, key=lambda b: b[0])
            best[0] -= int(sizes[i])
            best[1][i] += 1
    return out + [(b[1], 1) for b in bins]


def pack(docs: DataFrame, tokenizer_path: str, length: int = 4096, end_id: int = 2, grain: int = 16, rows_a_salt: int = 200_000) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document's ids are those of its text (null: of the empty text) and `end_id`; so an empty text makes one piece of length 1. Each
    id lies in exactly one piece, and a piece is cut only at multiples of `length`. Sequences hold `length` ids at most; their
    pieces lie without gaps from offset 0; sequence_ids are unique, but not gapless. Which of several pieces of a class goes where follows a
    hash of doc_id, then doc_id and start; repeated rows are pieces of their own. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    cut_up = id_and_text(docs).mapInArrow(_cut_up(tokenizer_path, length, end_id), PIECES)
    # written once: the histogram, the ranks and the result must see the same rows, and tokenising costs most
    cut_up = cut(cut_up.withColumn("class", F.ceil(F.col("length") / grain).cast("int")))
    full = length // grain  # pieces of this class fill a sequence each, and need no rank
    histogram = {r["class"]: r["n"] for r in cut_up.groupBy("class").agg(F.count("*").alias("n")).collect()}
    places = places_of({c: n for c, n in histogram.items() if c < full}, full)
    sequences = 1 + max((sequence + (high - low - 1) // per for _, low, high, per, sequence in places), default=-1)
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    alone = cut_up.where(F.col("class") >= full).withColumns({"sequence_id": F.lit(sequences) + F.monotonically_increasing_id(), "offset": F.lit(0).cast("long")})

    salts = max(64, -(-max((n for c, n in histogram.items() if c < full), default=1) // rows_a_salt))
    rest = cut_up.where(F.col("class") < full).withColumn("salt", F.pmod(F.coalesce(F.xxhash64("doc_id", "start"), F.lit(0)), F.lit(salts)).cast("int"))
    counted = rest.groupBy("class", "salt").agg(F.count("*").alias("n"))
    firsts = counted.select("class", "salt", F.coalesce(F.sum("n").over(Window.partitionBy("class").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("first"))
    within = Window.partitionBy("class", "salt").orderBy("doc_id", "start")
    ranked = rest.withColumn("rank", F.row_number().over(within) - 1).join(firsts, ["class", "salt"]).withColumn("rank", F.col("rank") + F.col("first"))
    p = F.broadcast(spark.createDataFrame(places, "of int, low long, high long, per int, sequence long"))
    placed = ranked.join(p, (F.col("class") == F.col("of")) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high")))
    placed = placed.withColumn("sequence_id", F.expr("sequence + (rank - low) div per"))
    before = Window.partitionBy("sequence_id").orderBy(F.desc("length"), "class", "rank").rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)).cast("long"))
    return placed.select(*columns).unionByName(alone.select(*columns))


def places_of(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """(class, first rank, end of ranks, places in each sequence, first sequence) for every class of every pattern."""
    if not histogram:
        return []
    sizes = np.array(sorted(histogram), dtype=np.int64)
    demand = np.array([histogram[int(c)] for c in sizes], dtype=float)
    out, sequence, used = [], 0, np.zeros(len(sizes), dtype=np.int64)
    for pattern, times in rounded(column_generation(demand, sizes, capacity), demand, sizes, capacity):
        for i in np.flatnonzero(pattern):
            n = int(pattern[i]) * times
            out.append((int(sizes[i]), int(used[i]), int(used[i]) + n, int(pattern[i]), sequence))
            used[i] += n
        sequence += times
    return out
