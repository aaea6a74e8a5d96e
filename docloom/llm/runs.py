"""Periodic runs of words by Lyndon arrays over an ordered alphabet, after Ellert and Fischer.

A run's period is the length of a longest Lyndon word that begins somewhere in the run, for one of two orders of the words: that
by number, or its reverse. So for each of the two, one scan from right to left finds the next smaller suffix of every place.
Suffixes are compared word by word, and no comparison is made twice: along the chain of next smaller suffixes a match already
found for one of them bounds that of the next, and each distance keeps the stretch on which words that far apart were last found to
match, which later comparisons at this distance enter and leave at its end. The two ends of a candidate's match at its
distance, extended to the left in the same way, are the ends of the run. Neither suffix arrays or trees nor hashes of stretches
are built.

Words are numbered as they first occur, which is an order like any other. Before the scan, words that lie in no run go: in a
run of `least` words or more, and of two periods or more, every word lies in a string of `least` / 2 words (of one word at least) that
occurs again in the text. Strings are told apart by sorted numbers of pairs. What is left are stretches, each scanned alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import id_and_text, pieces


def lyndon_array(t: list[int]) -> tuple[list[int], list[int]]:
    """For each place i, where the next smaller suffix begins (len(t), if there is none), and how many words the two share."""
    n = len(t)
    following, shared = [n] * n, [0] * n
    low: dict[int, int] = {}  # distance -> beginning of the stretch that was last compared at this distance
    high: dict[int, int] = {}  # and its end, where words differ, or the text ends
    for i in range(n - 2, -1, -1):
        j, here = i + 1, t[i]
        while j < n and here < t[j]:
            j = following[j]
        m = 0
        while j < n:
            k, d = i + m, j - i
            if k + d < n and t[k] == t[k + d]:
                begin, end = low.get(d, n), high.get(d, 0)
                k += 1
                while k + d < n and t[k] == t[k + d]:
                    if begin <= k < end:
                        k = end
                        break
                    k += 1
                low[d], high[d] = i, k
                m = k - i
            if j + m == n or t[j + m] < t[i + m]:
                break
            held, j = shared[j], following[j]
            if held < m:
                m = held
                break
        following[i] = j
        shared[i] = m if j < n else 0
    return following, shared


def runs_of(t: list[int], least: int = 12) -> list[tuple[int, int, int]]:
    """All (start, length, period) of maximal runs: stretches of smallest period p and of 2 * p words or more, and `least` or more."""
    n, found = len(t), set()
    most = max(t, default=0)
    for word in (t, [most - x for x in t]):
        following, shared = lyndon_array(word)
        ended: dict[int, int] = {}  # distance -> the end of the last stretch of matches at it
        for i in range(n):
            j, r = following[i], shared[i]
            p = j - i
            done = ended.get(p, -1)
            if i + r <= done:  # the same stretch as before
                continue
            k = i
            while k - 1 > done and word[k - 1] == word[k - 1 + p]:
                k -= 1
            if i + r > k:
                ended[p] = i + r
            if i + r - k >= p and i + r - k + p >= least:
                found.add((k, i + r - k + p, p))
    return sorted(found, key=lambda run: (run[0], run[2]))


def repeated_stretches(owner: np.ndarray, words: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The maximal stretches (first, end) of places that lie in a string of `size` words which begins at least twice in the same
    text. Texts stand one after the other: `owner` numbers them, `words` the words, all below the number of places."""
    n = len(words)

    def numbered(a: np.ndarray, b: np.ndarray, places: np.ndarray) -> np.ndarray:
        """For each place a number of its pair (a, b) if it is one of `places` and its pair stands at another of them too, else -1."""
        out = np.full(n, -1, dtype=np.int64)
        if len(places):
            pair = a * np.int64(n + 1) + b
            order = np.argsort(pair, kind="stable")
            pair = pair[order]
            new = np.concatenate([[True], pair[1:] != pair[:-1]])
            again = ~(new & np.concatenate([new[1:], [True]]))
            out[places[order][again]] = (np.cumsum(new) - 1)[again]
        return out

    # a string occurs again only if its beginning and its end do; numbers tell texts apart from the first step on
    held, now = numbered(owner.astype(np.int64), words.astype(np.int64), np.arange(n)), 1
    while now < size:
        step = min(now, size - now)
        at = np.flatnonzero(held[: max(0, n - step)] >= 0)
        at = at[held[at + step] >= 0]
        held, now = numbered(held[at], held[at + step], at), now + step
    edge = np.zeros(n + size + 1, dtype=np.int64)
    begin = np.flatnonzero(held >= 0)
    edge[begin] += 1
    edge[begin + size] -= 1
    covered = np.cumsum(edge)[:n] > 0
    other = np.concatenate([[True], owner[1:] != owner[:-1], [True]])
    first = np.flatnonzero(covered & (other[:-1] | np.concatenate([[True], ~covered[:-1]])))
    end = np.flatnonzero(covered & (other[1:] | np.concatenate([~covered[1:], [True]]))) + 1
    return first, end


def _collapsed(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            texts = [text.split() for text in batch.column("text").cast(pa.binary()).to_pylist()]  # bytes are split at ASCII white space
            counts = np.array([len(words) for words in texts], dtype=np.int64)
            number: dict[bytes, int] = {}
            words = np.array([number.setdefault(w, len(number)) for text in texts for w in text], dtype=np.int64)
            begins = np.concatenate([[0], np.cumsum(counts)])
            owner = np.repeat(np.arange(len(texts)), counts)
            found: list[list[tuple]] = [[] for _ in texts]
            for first, end in zip(*(x.tolist() for x in repeated_stretches(owner, words, max(1, least // 2)))):
                if end - first >= least:
                    text = int(owner[first])
                    found[text].extend((first - int(begins[text]) + start, length, period) for start, length, period in runs_of(words[first:end].tolist(), least))
            kept = []
            for text, runs in zip(texts, found):
                if runs:
                    edge = np.zeros(len(text) + 1, dtype=np.int64)
                    for start, length, period in runs:
                        edge[start + period] += 1
                        edge[start + length] -= 1
                    text = [text[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()]
                kept.append(b" ".join(text))
            ends = np.concatenate([[0], np.cumsum([len(runs) for runs in found])]).astype(np.int32)
            every = np.array([x for runs in found for x in runs], dtype=np.int64).reshape(-1, 3)
            listed = pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays([pa.array(every[:, k]) for k in range(3)], ["start", "length", "period"]))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(counts), listed, pa.array(kept, pa.binary()).cast(pa.string())], ["doc_id", "n_words", "runs", "text"])

    return run


def collapse_runs(docs: DataFrame, least: int = 12) -> DataFrame:
    """One row per input row: doc_id, n_words, runs (start, length, period; by start, then period), text.

    Words are what `[^\\x20\\x09-\\x0D]+` matches. A run is a stretch of words with smallest period p, of max(`least`, 2 * p) words or more, that no
    neighbouring word extends. The text returned holds the words, joined by one space, that no run contains after its first p words. Null texts
    are empty, and have no runs; so have texts without words. Rows that repeat, or have no doc_id, are rows of their own; an empty table gives an
    empty result. A text is one task's, with some tens of bytes a word; texts of any length are read whole.
    """
    return id_and_text(docs).mapInArrow(_collapsed(least), "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, text string")


def repeated_tails(docs: DataFrame) -> DataFrame:
    """(doc_id, text): `docs` with periodic ends put into a tenth of them, by a rule on doc_id. Let h be the CRC-32 of doc_id in decimal, and g = h div 10.
    If h ends in 0, each of the n words from a = g % n on becomes that which stands (i - a) % p after a, p = 1 + (n - a) div (3 + g % 8)."""
    rows = id_and_text(docs).withColumn("h", F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(1)))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    g = F.expr("h div 10")

    def of(words: Column) -> Column:
        n = F.size(words).cast("long")
        a = F.when(n > 0, g % n)
        p = F.lit(1) + F.call_function("div", n - a, F.lit(3) + g % 8)
        at = F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.get(words, F.when(i < a, i).otherwise(a + (i - a) % p).cast("int")))
        return F.when(n > 0, F.array_join(at, " ")).otherwise("")

    return rows.select("doc_id", F.when(F.col("h") % 10 == 0, F.get(F.transform(F.array(words), of), F.lit(0))).otherwise(F.col("text")).alias("text"))


def digests(collapsed: DataFrame) -> DataFrame:
    """What `collapse_runs` found as numbers and digests: of the runs, the longest (ties: by start, then period) and, as exponent_milli, 1000 times
    its length by its period, rounded down; without a run, nulls."""
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", *(r[c].cast("string") for c in ("start", "length", "period")))), "\n")
    lines = F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise("")
    told = collapsed.withColumn("longest", longest)
    start, length, period = -F.col("longest.start"), F.col("longest.length"), -F.col("longest.period")
    return told.select("doc_id", F.size("runs").cast("long").alias("n_runs"), start.alias("start"), length.alias("length"), period.alias("period"), F.call_function("div", length * 1000, period).alias("exponent_milli"), F.sha2(lines, 256).alias("runs_sha256"), F.sha2("text", 256).alias("collapsed_sha256"))
