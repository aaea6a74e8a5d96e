"""Byte-level BPE, encoded and decoded by DuckDB queries within Spark's partitions.

Texts are cut into words by the vocabulary's pattern. The distinct words that a Python worker has not met yet go, as rows of
(word and position, token), into a recursive query: each round joins neighbours with the merge table, takes for each word the
leftmost of its pairs of least rank, and contracts it; words without a pair leave the recursion. Words that are a token
themselves need no merging.

Very long words are cut into parts of STAGE bytes, which are encoded like words of their own. A sequence of tokens is the
encoding of its bytes if, and only if, the bytes of every two neighbours encode to these two: the first contraction ever to cross a
border between tokens would cross it in those two alone as well. So only the seams between parts are looked at. A wrong seam is
mended by encoding anew the few tokens around it, and one that stays wrong by a walk to the right, WALK bytes at a time, up to
the first seam that is right. No query holds more than a bounded part of a word.

Decoding is a join of (position, id) rows with the vocabulary and an ordered aggregation, so many ids at a time; documents are cut
from the bytes by the lengths of their tokens. Both tables have as many rows as the vocabulary makes, whatever the corpus.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from docloom.llm.common import id_and_text, pieces

#: Position bits of a key: any length of a text fits. Words of more than STAGE bytes are merged in stages of so many rounds; those of more
#: than LONG bytes in parts, which a walk of WALK bytes a step joins where their seams are wrong.
BITS, STAGE, LONG, WALK = 32, 64, 1024, 8192

#: Rows of state that a recursive query over long words may hold.
MOST_STATES = 4_000_000

#: Ids that one query decodes.
MOST_IDS = 500_000

#: What stands at the end of both recursive queries: each word's rows of its last round, in order.
LAST = f"""
SELECT s.k, s.tok, s.step
FROM state s JOIN (SELECT k >> {BITS} AS word, max(step) AS step FROM state GROUP BY 1) l ON s.k >> {BITS} = l.word AND s.step = l.step
ORDER BY s.k"""

MERGE = f"""
WITH RECURSIVE state(step, k, tok) AS (
  SELECT 0, k, tok FROM seed
  UNION ALL
  SELECT step + 1, k - (k > place)::INT, CASE WHEN k = place THEN merged ELSE tok END
  FROM (SELECT s.step, s.k, s.tok, (b.word << {BITS}) + (b.least & {(1 << BITS) - 1}) AS place, (b.least >> {BITS})::INT AS merged
        FROM state s JOIN (SELECT x.k >> {BITS} AS word, min((m.tok::BIGINT << {BITS}) + (x.k & {(1 << BITS) - 1})) AS least
                           FROM state x JOIN state y ON y.k = x.k + 1 JOIN merges m ON m.pair = (x.tok::BIGINT << 32) + y.tok
                           GROUP BY 1) b ON s.k >> {BITS} = b.word
        WHERE s.step < $steps)
  WHERE k <> place + 1
){LAST}"""

#: As MERGE, but a round contracts every pair of a word's least rank, from the left, each second one of pairs that overlap. This is what
#: one contraction after the other does, unless a new token forms a pair of a lesser rank with a neighbour (`risky` pairs are
#: those that rank below one of their halves): in a word where that would happen, the round contracts the leftmost pair only.
MERGE_RANKS = f"""
WITH RECURSIVE state(step, k, tok) AS (
  SELECT 0, k, tok FROM seed
  UNION ALL
  SELECT step + 1, k - coalesce(sum(taken::INT) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT, CASE WHEN taken THEN merged ELSE tok END
  FROM (SELECT *, coalesce(lag(taken) OVER w, false) AS gone
        FROM (SELECT step, k, c.tok, word, merged, can AND (nth = 1 OR NOT bool_or(l.pair IS NOT NULL OR r.pair IS NOT NULL) OVER (PARTITION BY word)) AS taken
              FROM (SELECT *, CASE WHEN lag(can, 2) OVER w THEN merged ELSE lag(tok) OVER w END AS before
                    FROM (SELECT *, hit AND row_number() OVER (PARTITION BY word, hit, k - nth ORDER BY k) % 2 = 1 AS can
                          FROM (SELECT *, row_number() OVER (PARTITION BY word, hit ORDER BY k) AS nth
                                FROM (SELECT *, min(merged) OVER (PARTITION BY word) AS least, coalesce(merged = min(merged) OVER (PARTITION BY word), false) AS hit
                                      FROM (SELECT p.*, m.tok AS merged
                                            FROM (SELECT *, k >> {BITS} AS word, lead(tok) OVER w AS after, lead(tok, 2) OVER w AS beyond FROM state WHERE step < $steps WINDOW w AS (PARTITION BY k >> {BITS} ORDER BY k)) p
                                            LEFT JOIN merges m ON m.pair = (p.tok::BIGINT << 32) + p.after))
                                WHERE least IS NOT NULL))
                    WINDOW w AS (PARTITION BY word ORDER BY k)) c
              LEFT JOIN risky l ON can AND l.pair = (before::BIGINT << 32) + merged AND l.tok < merged
              LEFT JOIN risky r ON can AND r.pair = (merged::BIGINT << 32) + beyond AND r.tok < merged)
        WINDOW w AS (PARTITION BY word ORDER BY k))
  WINDOW w AS (PARTITION BY word ORDER BY k)
  QUALIFY NOT gone
){LAST}"""

DECODE = "SELECT array_to_string(list(piece ORDER BY place), '') FROM coded JOIN vocabulary USING (id)"


class Codec:
    """A vocabulary's tables in a DuckDB database of this process, and the words and chunks encoded so far (`most_held` at most)."""

    def __init__(self, path: str, pattern: str, most_held: int = 1_000_000):
        import duckdb
        import regex

        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        pairs = [(left, right, rank) for token, rank in self.ranks.items() for i in range(1, len(token)) if (left := self.ranks.get(token[:i])) is not None and (right := self.ranks.get(token[i:])) is not None]
        # nothing is spilled: an empty folder name switches that off, as a worker has no folder of its own to write to
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "400MB", "preserve_insertion_order": "false", "temp_directory": ""})
        left, right, rank = (np.array(c, dtype=np.int64) for c in zip(*pairs)) if pairs else (np.zeros(0, dtype=np.int64),) * 3
        merges = pa.table({"pair": (left << 32) + right, "tok": rank.astype(np.int32)})
        self._table("merges", merges)
        self._table("risky", merges.filter(pa.array(rank < np.maximum(left, right))))
        # a token's bytes stand as characters of the same numbers, so that they aggregate as text
        self._table("vocabulary", pa.table({"id": pa.array(self.ranks.values(), pa.int32()), "piece": pa.array([t.decode("latin-1") for t in self.ranks], pa.string())}))
        self.byte = np.array([self.ranks[bytes([i])] for i in range(256)], dtype=np.int32)
        # by id; the last stands for ids outside the vocabulary, which no row of it joins
        self.sizes = np.zeros(max(self.ranks.values()) + 2, dtype=np.int64)
        self.sizes[list(self.ranks.values())] = [len(t) for t in self.ranks]
        self.split, self.match = regex.compile(pattern).findall, regex.compile(pattern).finditer
        self.words: dict[str, bytes] = {}
        self.seams: dict[tuple[int, int], bool] = {}
        self.tokens = {i: t for t, i in self.ranks.items()}
        self.most = most_held
        self.by_chunks = pattern == public_tokenizers.PATTERN

    def _table(self, name: str, rows: pa.Table) -> None:
        self.db.register("given", rows)
        self.db.execute(f"CREATE OR REPLACE TABLE {name} AS SELECT * FROM given")
        self.db.unregister("given")

    def _merged(self, words: list[bytes], query: str) -> dict[int, bytes]:
        lengths = np.array([len(w) for w in words], dtype=np.int64)
        tokens = self.byte[np.frombuffer(b"".join(words), dtype=np.uint8)]
        out: dict[int, bytes] = {}
        names = np.arange(len(words), dtype=np.int64)
        while len(names):
            steps = max(1, min(STAGE, MOST_STATES // len(tokens)))
            first = np.cumsum(lengths) - lengths
            k = (np.repeat(names, lengths) << BITS) + np.arange(len(tokens)) - np.repeat(first, lengths)
            self.db.register("seed", pa.table({"k": k, "tok": tokens}))
            got = self.db.execute(query, {"steps": steps}).fetchnumpy()
            self.db.unregister("seed")
            word, toks, more = got["k"] >> BITS, got["tok"].astype(np.int32), got["step"] >= steps
            first = np.flatnonzero(np.diff(word, prepend=-1))
            names, again, ends = word[first], more[first], np.append(first[1:], len(word))
            raw = toks.astype("<u4").tobytes()
            out.update((name, raw[4 * i : 4 * j]) for name, i, j in zip(names[~again].tolist(), first[~again].tolist(), ends[~again].tolist()))
            names, lengths, tokens = names[again], (ends - first)[again], toks[more]
        return out

    def _grouped(self, words: list[bytes], query: str = MERGE) -> list[bytes]:
        """The ids of words, in queries of about 400,000 bytes."""
        out, start = [], 0
        while start < len(words):
            size, stop = 0, start
            while stop < len(words) and (stop == start or size + len(words[stop]) <= 400_000):
                size += len(words[stop])
                stop += 1
            got = self._merged(words[start:stop], query)
            out.extend(got[i] for i in range(stop - start))
            start = stop
        return out

    def _right(self, left: list[int], right: list[int]) -> np.ndarray:
        """Which pairs of neighbours encode to themselves."""
        pairs = list(zip(left, right))
        fresh = list(dict.fromkeys(p for p in pairs if p not in self.seams))
        if len(self.seams) + len(fresh) > self.most:
            self.seams.clear()
            fresh = list(dict.fromkeys(pairs))
        token = self.tokens
        for pair, got in zip(fresh, self._grouped([token[a] + token[b] for a, b in fresh])):
            self.seams[pair] = got == np.array(pair, dtype="<u4").tobytes()
        return np.array([self.seams[p] for p in pairs], dtype=bool)

    def _bytes(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids.tolist()))

    def _long(self, word: bytes, around: int = 6) -> bytes:
        """The ids of a very long word, put together from parts."""
        parts = [np.frombuffer(p, dtype="<u4") for p in self._grouped([word[i : i + STAGE] for i in range(0, len(word), STAGE)])]
        wrong = np.flatnonzero(~self._right([int(p[-1]) for p in parts[:-1]], [int(p[0]) for p in parts[1:]]))
        # seams without a wrong seam beside them are mended at once, from a few tokens on either side
        alone = [int(i) for i in wrong if len(parts[i]) > 2 * around and len(parts[i + 1]) > 2 * around]
        mended = [np.frombuffer(m, dtype="<u4") for m in self._grouped([self._bytes(np.concatenate([parts[i][-around:], parts[i + 1][:around]])) for i in alone])]
        good = self._right([int(parts[i][-around - 1]) for i in alone] + [int(m[-1]) for m in mended], [int(m[0]) for m in mended] + [int(parts[i + 1][around]) for i in alone]).reshape(2, -1).all(axis=0)
        begin, end, between = [0] * len(parts), [len(p) for p in parts], {}
        for i, m, fine in zip(alone, mended, good.tolist()):
            if fine:
                end[i], begin[i + 1], between[i] = end[i] - around, around, m
        bad = set(wrong.tolist()).difference(between)
        done: list[np.ndarray] = []
        i = 0
        while i < len(parts):
            done.append(parts[i][begin[i] : end[i]])
            if i in between:
                done.append(between[i])
            elif i in bad:
                i = self._walk(done, parts, begin, end, between, i + 1)
                continue
            i += 1
        return np.concatenate(done).tobytes()

    def _walk(self, done: list[np.ndarray], parts: list[np.ndarray], begin: list[int], end: list[int], between: dict, i: int) -> int:
        """Encodes on from a wrong seam, before part i, until a seam between parts is right; `done` then ends there. Returns the next part."""
        while i < len(parts):
            stop, more = i, []
            size = 0
            while stop < len(parts) and (not more or size < WALK):
                more.append(parts[stop][begin[stop] : end[stop]])
                if stop in between:
                    more.append(between[stop])
                size += STAGE
                stop += 1
            ahead = np.concatenate(more)
            for back in (8, 64, 512, 4096, 1 << 62):
                before, held = [], 0
                while done and held < back:
                    before.insert(0, done.pop())
                    held += len(before[0])
                tail = np.concatenate(before) if before else ahead[:0]
                kept, again = (tail[:-back], tail[-back:]) if len(tail) > back else (tail[:0], tail)
                new = np.frombuffer(self._merged([self._bytes(np.concatenate([again, ahead]))], MERGE_RANKS)[0], dtype="<u4")
                if not len(kept) or self._right([int(kept[-1])], [int(new[0])])[0]:
                    done.extend(x for x in (kept, new) if len(x))
                    break
                done.append(tail)
            i = stop
            # behind a mended seam the next part begins in its middle, but its seam is judged all the same
            if i < len(parts) and self._right([int(done[-1][-1])], [int(parts[i][begin[i]])])[0]:
                break
        return i

    def _learn(self, words: set[str]) -> None:
        short, long, very_long = [], [], []
        for word in words:
            raw = word.encode()
            if raw in self.ranks:
                self.words[word] = self.ranks[raw].to_bytes(4, "little")
            else:
                (short if len(raw) <= STAGE else long if len(raw) <= LONG else very_long).append((word, raw))
        for group in (short, long):
            self.words.update(zip((word for word, _ in group), self._grouped([raw for _, raw in group])))
        for word, raw in very_long:
            self.words[word] = self._long(raw)

    def _held(self, chunks: list[str]) -> list[bytes]:
        """The ids of chunks. Those met before are not split again, save long ones of several words, which seldom come again and would fill the
        memory where texts have no spaces. What is held is thinned out to these chunks when it becomes too much."""
        fresh = {c: self.split(c) if self.by_chunks else [c] for c in set(chunks).difference(self.words)}
        unknown = set().union(*fresh.values()).difference(self.words)
        if len(self.words) + len(fresh) + len(unknown) > self.most:
            self.words = {c: self.words[c] for c in chunks if c in self.words}
            unknown = set().union(*fresh.values()).difference(self.words)
        self._learn(unknown)
        word = self.words.__getitem__
        joined = {c: b"".join(map(word, words)) for c, words in fresh.items() if words != [c]}
        self.words.update((c, ids) for c, ids in joined.items() if len(c) <= STAGE)
        return [joined[c] if c in joined else word(c) for c in chunks]

    def _chunks(self, texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Chunks, the number of each part's chunk, and how many parts each text has.

        A single space between two other characters that are not white space always starts a word of the public pattern, so texts
        without other runs of white space beside spaces are cut before spaces. Other texts, and all with another pattern, are cut into words.
        """
        whole = pc.match_substring_regex(texts, _BESIDE).to_numpy(zero_copy_only=False) if self.by_chunks else np.ones(len(texts), dtype=bool)
        cut = pc.split_pattern(texts.filter(pa.array(~whole)), " ")
        counts = np.zeros(len(texts), dtype=np.int64)
        counts[~whole] = pc.list_value_length(cut).to_numpy(zero_copy_only=False)
        parts = cut.flatten()
        head = np.zeros(len(parts), dtype=bool)
        head[np.cumsum(counts[~whole]) - counts[~whole]] = True
        later = parts.filter(pa.array(~head)).dictionary_encode()
        chunks = parts.filter(pa.array(head)).to_pylist()
        of_cut = np.zeros(len(parts), dtype=np.int64)
        of_cut[head] = np.arange(len(chunks))
        of_cut[~head] = later.indices.to_numpy(zero_copy_only=False) + len(chunks)
        chunks += [f" {c}" for c in later.dictionary.to_pylist()]
        words: dict[str, int] = {}
        found = [self.split(t) if self.by_chunks else [m.group() for m in self.match(t)] for t in texts.filter(pa.array(whole)).to_pylist()]
        of_whole = [words.setdefault(w, len(chunks) + len(words)) for f in found for w in f]
        counts[whole] = [len(f) for f in found]
        numbers, by_whole = np.zeros(counts.sum(), dtype=np.int64), np.repeat(whole, counts)
        numbers[~by_whole], numbers[by_whole] = of_cut, of_whole
        return chunks + list(words), numbers, counts

    def encode_column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and the n + 1 places between which each text's ids lie."""
        chunks, numbers, counts = self._chunks(texts)
        coded = self._held(chunks)
        lengths = np.fromiter(map(len, coded), dtype=np.int64, count=len(coded)) // 4
        starts, ids = np.cumsum(lengths) - lengths, np.frombuffer(b"".join(coded), dtype="<u4")
        taken = lengths[numbers]
        ends = np.concatenate([[0], np.cumsum(taken)])
        at = np.repeat(starts[numbers] - ends[:-1], taken) + np.arange(ends[-1])
        return ids[at], ends[np.concatenate([[0], np.cumsum(counts)])]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit integers."""
        ids, ends = self.encode_column(pa.array(texts, pa.string()))
        return _slices(ids.tobytes(), 4 * ends)

    def decode_column(self, ids: np.ndarray, ends: np.ndarray) -> list[bytes]:
        """The bytes of each text, whose ids lie between two neighbours of `ends`."""
        out = []
        for start in range(0, len(ids), MOST_IDS):
            some = ids[start : start + MOST_IDS].astype(np.int32)
            self.db.register("coded", pa.table({"place": np.arange(len(some), dtype=np.int32), "id": some}))
            out.append((self.db.execute(DECODE).fetchall()[0][0] or "").encode("latin-1"))
            self.db.unregister("coded")
        sizes = self.sizes[np.minimum(ids, len(self.sizes) - 1)]
        return _slices(b"".join(out), np.concatenate([[0], np.cumsum(sizes)])[ends])

    def decode(self, coded: list[bytes]) -> list[bytes]:
        """Each text's bytes from its ids."""
        return self.decode_column(np.frombuffer(b"".join(coded), dtype="<u4"), np.concatenate([[0], np.cumsum([len(c) // 4 for c in coded], dtype=np.int64)]))


def _slices(data: bytes, ends: np.ndarray) -> list[bytes]:
    cuts = ends.tolist()
    return [data[i:j] for i, j in zip(cuts, cuts[1:])]


#: White space in Python's sense, which holds that of the pattern, beside a space or a space at an end.
_WHITE = r"[\x09-\x0d\x1c-\x20\x{85}\p{Z}]"
_BESIDE = f"{_WHITE} | {_WHITE}|^ | $"
_open: dict[tuple, Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    """The codec of a vocabulary, opened once in a Python worker."""
    if (path, pattern) not in _open:
        _open.clear()
        _open[path, pattern] = Codec(path, pattern)
    return _open[path, pattern]


def encode_documents(docs: DataFrame, vocabulary_path: str, pattern: str) -> DataFrame:
    """(doc_id, ids as an array of int) of every whole text; null counts as empty, and an empty text has no ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(vocabulary_path, pattern)
        for batch in pieces(batches, "text"):
            ids, ends = coder.encode_column(batch.column("text"))
            ends, ids = ends.astype(np.int32), ids.astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.ListArray.from_arrays(pa.array(ends), pa.array(ids))], ["doc_id", "ids"])

    return id_and_text(docs).mapInArrow(run, "doc_id long, ids array<int>")


def decode_documents(coded: DataFrame, vocabulary_path: str, pattern: str) -> DataFrame:
    """(doc_id, data as binary) of every row of (doc_id, ids); null or empty ids give empty data."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(vocabulary_path, pattern)
        for batch in batches:
            data = coder.decode([np.array(ids or [], dtype="<u4").tobytes() for ids in batch.column("ids").to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(data, pa.binary())], ["doc_id", "data"])

    return coded.select("doc_id", "ids").mapInArrow(run, "doc_id long, data binary")


def round_trip(docs: DataFrame, vocabulary_path: str, pattern: str) -> DataFrame:
    """One row per input row: doc_id, n_tokens, ids_sha256, decoded_sha256.

    The ids are those of every whole text (null: of the empty text, which has none), without special tokens; ids_sha256 is of
    the ids as little-endian unsigned 32-bit integers, decoded_sha256 of the bytes that the ids decode to. Repeated rows give
    repeated results, an empty table an empty one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(vocabulary_path, pattern)
        for batch in pieces(batches, "text", 2 << 20):
            ids, ends = coder.encode_column(batch.column("text"))
            coded, decoded = _slices(ids.tobytes(), 4 * ends), coder.decode_column(ids, ends)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.diff(ends), pa.int64()), pa.array([hashlib.sha256(c).hexdigest() for c in coded]), pa.array([hashlib.sha256(d).hexdigest() for d in decoded])],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return id_and_text(docs).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
