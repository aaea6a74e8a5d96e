"""Token counts that follow edits: a segment tree over the pre-tokens of each document.

Leaves are segments of consecutive matches of the vocabulary's pattern, with their token counts; each node above is the sum of two
below, and heights of halves differ by one at most. An edit
replaces a stretch of characters. Matches that end at least one character before it cannot have seen it (the pattern looks one
character past a match at most), so they stand; from the first other match on, the text is matched anew until a match starts
where an old one did, behind the edit: from there on, both texts and so all matches agree. Only the matches between are
counted again: the tree is cut before and behind them and joined around their own small tree, which makes the sums along
two paths anew and leaves all other subtrees as they are. (The text itself is one string, and is copied.)
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import id_and_text, pieces


#: Pre-tokens of a leaf, at most.
SEGMENT = 64


class Counter:
    """Counts the tokens of single pre-tokens; keeps at most `most_held` of the counts in this process."""

    def __init__(self, path: str, pattern: str, most_held: int = 700_000):
        import regex
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.encode = tiktoken.Encoding("counter", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.pattern = regex.compile(pattern)
        self.held: dict[str, int] = {}
        self.most = most_held

    def __call__(self, words: list[str]) -> np.ndarray:
        fresh = set(words).difference(self.held)
        if len(self.held) + len(fresh) > self.most:
            self.held.clear()
            fresh = set(words)
        for word in fresh:
            self.held[word] = len(self.encode(word))
        return np.fromiter(map(self.held.__getitem__, words), dtype=np.int64, count=len(words))


class _Node:
    """A node over one or two halves: how many pre-tokens, characters and tokens lie below. A leaf holds the lengths and counts of
    a segment of consecutive pre-tokens."""

    __slots__ = ("count", "first", "height", "lengths", "second", "tokens")

    def __init__(self, first=None, second=None, lengths: np.ndarray | None = None, count: np.ndarray | None = None):
        self.first, self.second, self.lengths, self.count = first, second, lengths, count
        if first is None:
            self.height, self.tokens = 0, (len(lengths), int(lengths.sum()), int(count.sum()))
        else:
            self.height, self.tokens = 1 + max(first.height, second.height), tuple(map(sum, zip(first.tokens, second.tokens)))


def _joined(a: _Node | None, b: _Node | None) -> _Node | None:
    """One balanced tree (heights of halves differ by one at most) of two: only nodes along the lower tree's edge are made anew."""
    if a is None or b is None:
        return a or b
    if a.height > b.height + 1:
        inner = _joined(a.second, b)
        if inner.height > a.first.height + 1:  # one rotation, after one of the inner half if its own first half is the higher
            if inner.first.height > inner.second.height:
                inner = _Node(inner.first.first, _Node(inner.first.second, inner.second))
            return _Node(_Node(a.first, inner.first), inner.second)
        return _Node(a.first, inner)
    if b.height > a.height + 1:
        inner = _joined(a, b.first)
        if inner.height > b.second.height + 1:
            if inner.second.height > inner.first.height:
                inner = _Node(_Node(inner.first, inner.second.first), inner.second.second)
            return _Node(inner.first, _Node(inner.second, b.second))
        return _Node(inner, b.second)
    return _Node(a, b)


def _cut(node: _Node | None, place: int) -> tuple[_Node | None, _Node | None]:
    """The trees of the first `place` pre-tokens and of the rest."""
    if node is None or place <= 0:
        return None, node
    if place >= node.tokens[0]:
        return node, None
    if node.first is None:
        return _Node(lengths=node.lengths[:place], count=node.count[:place]), _Node(lengths=node.lengths[place:], count=node.count[place:])
    here = node.first.tokens[0]
    if place < here:
        low, high = _cut(node.first, place)
        return low, _joined(high, node.second)
    low, high = _cut(node.second, place - here)
    return _joined(node.first, low), high


def _grown(lengths: np.ndarray, counts: np.ndarray) -> _Node | None:
    """A tree of segments of SEGMENT pre-tokens at most."""
    row = [_Node(lengths=lengths[i : i + SEGMENT], count=counts[i : i + SEGMENT]) for i in range(0, len(lengths), SEGMENT)]
    while len(row) > 1:
        row = [_Node(*row[i : i + 2]) if i + 1 < len(row) else row[i] for i in range(0, len(row), 2)]
    return row[0] if row else None


def _segments(node: _Node | None) -> Iterator[_Node]:
    if node is not None:
        if node.first is None:
            yield node
        else:
            yield from _segments(node.first)
            yield from _segments(node.second)


class CountTree:
    """The pre-tokens of one text, with the sums of their token counts as a balanced segment tree."""

    def __init__(self, text: str, counter: Counter):
        self.text, self.counter, self.recounted = text, counter, 0
        words = counter.pattern.findall(text)
        self.root = _grown(_lengths(words), counter(words))

    @property
    def total(self) -> int:
        return self.root.tokens[2] if self.root else 0

    @property
    def n_pretokens(self) -> int:
        return self.root.tokens[0] if self.root else 0

    def leaves(self) -> list[int]:
        """The token counts of all pre-tokens, in order."""
        return [int(x) for node in _segments(self.root) for x in node.count]

    def between(self, first: int, last: int) -> int:
        """The tokens of pre-tokens first to last - 1, from the sums of whole subtrees."""
        return self._before(last) - self._before(first)

    def _before(self, place: int) -> int:
        node, total = self.root, 0
        while node is not None and place > 0:
            if place >= node.tokens[0]:
                return total + node.tokens[2]
            if node.first is None:
                return total + int(node.count[:place].sum())
            here = node.first.tokens
            node, place, total = (node.first, place, total) if place < here[0] else (node.second, place - here[0], total + here[2])
        return total

    def _at(self, character: int) -> tuple[int, int]:
        """The number of the pre-token that holds a character, and where it starts; behind the last one, for a place beyond the text."""
        node, place, start = self.root, 0, 0
        while node is not None:
            if character >= start + node.tokens[1]:
                return place + node.tokens[0], start + node.tokens[1]
            if node.first is None:
                ends = start + np.cumsum(node.lengths)
                i = int(np.searchsorted(ends, character, side="right"))
                return place + i, int(ends[i] - node.lengths[i])
            here = node.first.tokens
            node, place, start = (node.first, place, start) if character < start + here[1] else (node.second, place + here[0], start + here[1])
        return place, start

    def edit(self, start: int, deleted: int, inserted: str) -> None:
        """Replace `deleted` characters from `start` on by `inserted`; both are cut to the text's length."""
        start = min(max(start, 0), len(self.text))
        stop = min(start + max(deleted, 0), len(self.text))
        new = self.text[:start] + inserted + self.text[stop:]
        shift = len(new) - len(self.text)
        first, at = self._at(max(start - 2, 0))  # the first pre-token that ends at start - 1 or later
        last, words = self.n_pretokens, []
        while at < len(new):
            if at >= start + len(inserted) and at - shift >= stop:
                old, old_start = self._at(at - shift)
                if old_start == at - shift:
                    last = old
                    break
            word = self.counter.pattern.match(new, at).group()
            words.append(word)
            at += len(word)
        self.text = new
        self.recounted += len(words)
        head, rest = _cut(self.root, first)
        tail = _cut(rest, last - first)[1]
        self.root = _joined(_joined(head, _grown(_lengths(words), self.counter(words))), tail)


def _lengths(words: list[str]) -> np.ndarray:
    return np.fromiter(map(len, words), dtype=np.int64, count=len(words))


_open: dict[tuple, Counter] = {}


def _counter(path: str, pattern: str) -> Counter:
    if (path, pattern) not in _open:
        _open.clear()
        _open[path, pattern] = Counter(path, pattern)
    return _open[path, pattern]


def count_edited(docs: DataFrame, edits: DataFrame, vocabulary_path: str, pattern: str) -> DataFrame:
    """One row per input row: doc_id, n_tokens (as given), n_tokens_edited, n_pretokens, n_recounted.

    `edits` has (doc_id, edit_no, start, deleted, inserted): the edits of a document apply in the order of edit_no (then start),
    each to the text that the one before has left; positions are characters, and those beyond the text are cut to its
    length. Nulls in an edit count as 0 or as an empty string; edits of other or null doc_ids are ignored. Null text counts as
    empty. Documents without edits keep their count. Repeated rows of a document get the same edits each.
    """
    columns = ["edit_no", "start", "deleted", "inserted"]
    edit = F.struct(*(F.coalesce(F.col(c).cast(kind), F.lit(none)).alias(c) for c, kind, none in zip(columns, ("long", "long", "long", "string"), (0, 0, 0, ""))))
    listed = edits.select(F.col("doc_id").cast("long").alias("doc_id"), edit.alias("edit")).groupBy("doc_id").agg(F.sort_array(F.collect_list("edit")).alias("edits"))
    return _counted(id_and_text(docs).join(listed, "doc_id", "left"), vocabulary_path, pattern)


def _counted(rows: DataFrame, vocabulary_path: str, pattern: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(vocabulary_path, pattern)
        for batch in pieces(batches, "text"):
            out = []
            for doc, text, edits in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "edits"))):
                tree = CountTree(text, counter)
                before = tree.total
                for e in edits or []:
                    tree.edit(e["start"], e["deleted"], e["inserted"])
                out.append((doc, before, tree.total, tree.n_pretokens, tree.recounted))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], ["doc_id", "n_tokens", "n_tokens_edited", "n_pretokens", "n_recounted"])

    return rows.select("doc_id", "text", "edits").mapInArrow(run, "doc_id long, n_tokens long, n_tokens_edited long, n_pretokens long, n_recounted long")


def count_with_own_edits(docs: DataFrame, vocabulary_path: str, pattern: str) -> DataFrame:
    """`count_edited` with three edits made from each row itself, so that they need no join: its source (or "unknown") and a line end before the
    text, eight characters in the middle deleted, and the last sixteen replaced by its doc_id."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        (F.coalesce(F.col("source").cast("string"), F.lit("unknown")) if "source" in docs.columns else F.lit("unknown")).alias("source"),
    )
    size, head = F.length("text").cast("long"), F.length("source").cast("long") + 1

    def edit(no: int, start, deleted: int, inserted) -> F.Column:
        return F.struct(F.lit(no).cast("long").alias("edit_no"), start.cast("long").alias("start"), F.lit(deleted).cast("long").alias("deleted"), inserted.alias("inserted"))

    edits = F.array(
        edit(1, F.lit(0), 0, F.concat("source", F.lit("\n"))),
        edit(2, head + F.floor(size / 2), 8, F.lit("")),
        edit(3, F.greatest(head + size - 24, F.lit(0)), 16, F.concat(F.lit(" "), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))),
    )
    return _counted(rows.withColumn("edits", edits), vocabulary_path, pattern)
