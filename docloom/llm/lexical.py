"""Ranked lexical search by variable-block-max WAND, over shards of documents.

Index: documents are dealt into shards of about `postings` postings each. A shard holds, for each term, a posting list: the
documents that have it, in ascending order of doc_id, with the part of the score that does not depend on the term's weight. Lists
are cut into blocks of varying length, each with its greatest value, so that the bounds err least: a dynamic program
over every span of SPAN postings finds the ends that minimise the sum of (greatest value - value) and a fixed cost for each block.

Search: for an item, the blocks of its terms' lists cut the shard's documents into intervals within which every list has one block at
most; the sum of these blocks' greatest values, times the terms' weights, bounds all scores in the interval. The pivots of WAND are
so found for all intervals at once. Intervals are entered from the greatest bound down, where the lists' postings are added up exactly;
once as many documents as asked for are held, every interval whose bound lies below the least score held is skipped. All arithmetic
is in 64-bit integers, and nothing that could reach the ranking is left out.

Terms are told apart by 64-bit hashes. Only postings of the items' terms are indexed: a bitmap of BITS bits over all items' terms,
whose size does not depend on how many there are, goes to the tasks that read documents, and what it lets through by chance meets no
item. Each item meets every shard, as every document is to be ranked for it; items go in blocks of bounded size.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docloom.llm.common import bytes_of, cut, id_and_text, mixed, pieces
from docloom.llm.minhash import powers

SPAN, BITS = 128, 1 << 23
NO_ID = 2**63 - 1  # stands for a null doc_id within a shard, so that such rows come last among equal scores
_LOWERED = np.arange(256, dtype=np.uint8)
_LOWERED[65:91] += 32
_TERM = np.zeros(256, dtype=bool)
_TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_BYTE = mixed(np.arange(256, dtype=np.uint64), 31)
_INDEX = "shard int, term long, docs array<int>, parts array<int>, ends array<int>, tops array<int>, ids array<long>"


def term_hashes(flat: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The 64-bit hash of each term of a batch of texts, and the number of the text that it stands in."""
    inside = _TERM[flat]
    edge = np.zeros(len(flat) + 1, dtype=bool)
    edge[ends] = True  # a term never goes on into the next text
    start = np.flatnonzero(inside & (edge[:-1] | np.concatenate([[True], ~inside[:-1]])))
    stop = np.flatnonzero(inside & (edge[1:] | np.concatenate([~inside[1:], [True]]))) + 1
    up, down = powers(len(flat) + 1)
    total = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(_BYTE[_LOWERED[flat]] * up[: len(flat)], dtype=np.uint64)])
    value = mixed((total[stop] - total[start]) * down[start], 32) + (stop - start).astype(np.uint64)
    return mixed(value, 33), np.searchsorted(ends, start, side="right") - 1


def _counted(key: str, bitmap: bytes | None):
    """Each text's number of terms, and its distinct terms (of those that the bitmap has) with their numbers of occurrences."""
    kind = pa.int64()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = None if bitmap is None else np.frombuffer(bitmap, dtype=np.uint8)
        for batch in pieces(batches, "text"):
            value, owner = term_hashes(*bytes_of(batch.column("text")))
            n = np.bincount(owner, minlength=batch.num_rows)
            if bits is not None:
                place = (value % np.uint64(BITS)).astype(np.int64)
                some = (bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1 > 0
                value, owner = value[some], owner[some]
            order = np.lexsort((value, owner))
            value, owner = value[order], owner[order]
            first = np.flatnonzero(np.concatenate([[True], (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])]) if len(value) else np.zeros(0, dtype=bool))
            times = np.diff(np.concatenate([first, [len(value)]]))
            ends = pa.array(np.concatenate([[0], np.cumsum(np.bincount(owner[first], minlength=batch.num_rows))]).astype(np.int32))
            lists = [pa.ListArray.from_arrays(ends, pa.array(x)) for x in (value[first].view(np.int64), times.astype(np.int32))]
            yield pa.RecordBatch.from_arrays([batch.column(key), pa.array(n, kind), *lists], [key, "n", "terms", "times"])

    return run


def count_terms(docs: DataFrame, bitmap: bytes | None = None) -> DataFrame:
    """(doc_id, n, terms, times): a row for each document, with its number of terms and its distinct terms' hashes (if a bitmap is given,
    of those that it has) and numbers of occurrences. Null texts have no terms."""
    return id_and_text(docs).mapInArrow(_counted("doc_id", bitmap), "doc_id long, n long, terms array<long>, times array<int>")


def bitmap_of(terms: DataFrame) -> bytes:
    """BITS bits, set for the hashes of (term), whatever their number: BITS / 8 bytes come to the driver."""
    rows = terms.select(F.pmod("term", F.lit(BITS)).alias("place")).groupBy(F.expr("place div 32768").alias("part")).agg(F.bitmap_construct_agg(F.col("place") % 32768).alias("bits")).collect()
    out = bytearray(BITS // 8)
    for row in rows:
        out[row["part"] * 4096 : row["part"] * 4096 + len(row["bits"])] = row["bits"]
    return bytes(out)


def block_ends(values: np.ndarray, first: np.ndarray, cost: float = 16.0) -> np.ndarray:
    """Where the blocks of posting lists end. Lists stand one after the other in `values` and begin at `first`. Within each span of SPAN postings
    of a list, a dynamic program over all ends, for all spans at once, minimises the sum over blocks of (greatest value - value) and a
    cost for each block: `cost` times what a posting of the list errs by if the list is one block."""
    n = len(values)
    size = np.diff(np.concatenate([first, [n]]))
    spans = -(-size // SPAN)
    owner = np.repeat(np.arange(len(first)), spans)
    begin = first[owner] + SPAN * (np.arange(len(owner)) - np.repeat(np.cumsum(spans) - spans, spans))
    length = np.minimum(SPAN, first[owner] + size[owner] - begin)
    fixed = (cost * (np.maximum.reduceat(values, first) - np.add.reduceat(values, first) / size) + 1)[owner]
    padded = np.concatenate([values, np.zeros(SPAN, dtype=values.dtype)]).astype(np.float64)
    best, since = [np.zeros(len(owner))], [np.zeros(len(owner), dtype=np.int16)]
    rows = [padded[begin + i] for i in range(SPAN)]
    for b in range(1, int(length.max(initial=0)) + 1):
        top, least, at = rows[b - 1], best[b - 1] + rows[b - 1], np.full(len(owner), b - 1, dtype=np.int16)
        for a in range(b - 2, -1, -1):
            top = np.maximum(top, rows[a])
            now = best[a] + (b - a) * top
            less = now < least
            least = np.where(less, now, least)
            at[less] = a
        best.append(least + fixed)
        since.append(at)
    found, since, here = [], np.array(since), length.copy()
    span = np.arange(len(owner))
    while len(span):
        found.append(begin[span] + here[span])
        here[span] = since[here[span], span]
        span = span[here[span] > 0]
    return np.sort(np.concatenate(found)) if found else np.zeros(0, dtype=np.int64)


def _indexed(documents: int, words: int):
    def run(rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        ids = rows.column("doc_id").to_numpy()
        by_id = np.argsort(ids, kind="stable")
        rank = np.empty(len(ids), dtype=np.int64)
        rank[by_id] = np.arange(len(ids))
        lists = rows.column("terms").chunk(0)
        size = np.diff(lists.offsets.to_numpy())
        term, times = lists.flatten().to_numpy(), rows.column("times").chunk(0).flatten().to_numpy().astype(np.int64)
        m = np.array([50 + 50 * int(n) * documents // words for n in rows.column("n").to_numpy()], dtype=np.int64)
        part = 1_000_000_000 * times // (1000 * times + 20 * np.repeat(m, size))
        doc = np.repeat(rank, size)
        order = np.lexsort((doc, term))
        term, doc, part = term[order], doc[order].astype(np.int32), part[order].astype(np.int32)
        first = np.flatnonzero(np.concatenate([[True], term[1:] != term[:-1]])) if len(term) else np.zeros(0, dtype=np.int64)
        shard = rows.column("shard")[0].as_py()
        if len(term):
            ends = block_ends(part, first)
            tops = np.maximum.reduceat(part, np.concatenate([[0], ends[:-1]]))
        else:
            ends, tops = first, part
        edges = np.concatenate([first, [len(term)]])
        blocks = np.searchsorted(ends, edges[1:], side="right")
        within = (ends - edges[np.searchsorted(edges, ends, side="left") - 1]).astype(np.int32)

        def listed(x: np.ndarray, at: np.ndarray) -> pa.Array:
            return pa.ListArray.from_arrays(pa.array(np.concatenate([at, at[-1:]]).astype(np.int32)), pa.array(x))  # and an empty one for the row of ids

        offsets = np.concatenate([[0], blocks])
        alone = pa.ListArray.from_arrays(pa.array(np.concatenate([np.zeros(len(first) + 1), [len(ids)]]).astype(np.int32)), pa.array(ids[by_id]))
        columns = [pa.array(np.full(len(first) + 1, shard, dtype=np.int32)), pa.array([*term[first].tolist(), None], pa.int64()), listed(doc, edges), listed(part, edges), listed(within, offsets), listed(tops, offsets), alone]
        return pa.Table.from_arrays(columns, ["shard", "term", "docs", "parts", "ends", "tops", "ids"])

    return run


def build_index(counted: DataFrame, postings: int = 1_500_000) -> tuple[DataFrame, int, int]:
    """From `count_terms`, checkpointed: the index (a row for each shard and term, and one with the shard's doc_ids), also checkpointed; the number
    of shards; and the number of documents with a term. Copies of a text are documents of their own, in whichever shards."""
    total = counted.agg(F.count_if(F.col("n") > 0).alias("documents"), F.coalesce(F.sum("n"), F.lit(0)).alias("words"), F.coalesce(F.sum(F.size("terms")), F.lit(0)).alias("postings")).first()
    shards = max(1, math.ceil(total["postings"] / postings))
    dealt = counted.where(F.size("terms") > 0).select(F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(shards)).cast("int").alias("shard"), F.coalesce("doc_id", F.lit(NO_ID)).alias("doc_id"), "n", "terms", "times")
    dealt = dealt.repartition(min(4 * shards, 20_000), "shard")  # few bytes but long work, which would else be put together in few tasks
    return cut(dealt.groupBy("shard").applyInArrow(_indexed(total["documents"], max(1, total["words"])), _INDEX)), shards, total["documents"]


def best_of(lists: list[tuple], documents: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k documents of the greatest scores above 0, ties to the smaller, and these scores, from lists (docs, parts, ends, tops, weight)."""
    at, step = [], []
    for docs, _, ends, tops, weight in lists:
        at += [docs[np.concatenate([[0], ends[:-1]])], docs[ends - 1] + 1]
        step += [weight * tops.astype(np.int64), -weight * tops.astype(np.int64)]
    cuts, place = np.unique(np.concatenate(at), return_inverse=True)
    bound = np.zeros(len(cuts), dtype=np.int64)
    np.add.at(bound, place, np.concatenate(step))
    bound = np.cumsum(bound)
    order = np.argsort(-bound, kind="stable")
    score = np.zeros(documents, dtype=np.int64)
    held, least = np.zeros(0, dtype=np.int64), 1
    start, size = 0, 2 * k
    while start < len(order):
        entered = order[start : start + size]
        entered = np.sort(entered[bound[entered] >= least])
        if not len(entered):
            break  # so are all that follow
        low, high = cuts[entered], cuts[entered + 1]
        met = [held]
        for docs, parts, _, _, weight in lists:
            begin = np.searchsorted(docs, low)
            count = np.searchsorted(docs, high) - begin
            within = np.repeat(begin - np.cumsum(count) + count, count) + np.arange(int(count.sum()))
            np.add.at(score, docs[within], weight * parts[within].astype(np.int64))
            met.append(docs[within])
        met = np.unique(np.concatenate(met))
        met = met[score[met] > 0]
        held = met[np.argsort(-score[met], kind="stable")[:k]]
        if len(held) == k:
            least = int(score[held[-1]])
        start, size = start + size, 2 * size
    return held, score[held]


def _searched(k: int):
    names = ["item_id", "doc_id", "score"]

    def run(index: pa.Table, items: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if index.num_rows and items.num_rows:
            index = index.combine_chunks()
            terms = index.column("term").to_pylist()
            held = {t: i for i, t in enumerate(terms)}
            ids = index.column("ids")[held[None]].values.to_numpy()
            offsets, flat = {}, {}
            for name in ("docs", "parts", "ends", "tops"):
                column = index.column(name).chunk(0)
                offsets[name], flat[name] = column.offsets.to_numpy() - column.offsets[0].as_py(), column.flatten().to_numpy()

            def piece(name: str, i: int) -> np.ndarray:
                return flat[name][offsets[name][i] : offsets[name][i + 1]]

            for item, asked in zip(items.column("item_id").to_pylist(), items.column("terms").to_pylist()):
                lists = [(*(piece(name, held[x["term"]]) for name in ("docs", "parts", "ends", "tops")), x["weight"]) for x in asked if x["term"] in held and x["weight"] > 0]
                if lists:
                    docs, scores = best_of(lists, len(ids), k)
                    out.extend(zip([item] * len(docs), ids[docs].tolist(), scores.tolist()))
        return pa.Table.from_arrays([pa.array([o[i] for o in out], pa.int64()) for i in range(3)], names)

    return run


def search(docs: DataFrame, items: DataFrame, k: int = 50, block: int = 4096, **parameters) -> DataFrame:
    """item_id, rank, doc_id, score: the k documents (doc_id, text) of the greatest scores above 0 for each item (item_id, text).

    Terms are the maximal matches of `[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+`, with A-Z lower-cased. With N documents that have a term, L terms in
    all of them, n in one, df documents that have the term, which occurs tf times in the document, the score is the sum over the item's
    distinct terms of w * ((1000000000 * tf) div (1000 * tf + 20 * m)), where w = floor(1000 * ln((2N + 2) / (2df + 1))) and m = 50 + (50 * n * N) div L.
    Equal scores go by ascending doc_id. Documents and items with a null or empty text, or without a term, rank nowhere. Rows that repeat a
    doc_id are documents of their own; those without one come last among equal scores, with a null doc_id. Items that repeat an item_id are one
    item with the terms of all. Empty tables give an empty result.
    """
    asked = items.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    asked = cut(asked.mapInArrow(_counted("item_id", None), "item_id long, n long, terms array<long>, times array<int>").select("item_id", F.explode("terms").alias("term")).distinct())
    wanted = asked.select("term").distinct()
    counted = cut(count_terms(docs, bitmap_of(wanted)))
    index, shards, documents = build_index(counted, **parameters)
    having = counted.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df")).join(wanted, "term", "left_semi")
    weight = F.floor(1000 * F.log((2.0 * documents + 2) / (2 * F.col("df") + 1))).cast("long")
    told = cut(asked.join(having.select("term", weight.alias("weight")), "term").groupBy("item_id").agg(F.collect_list(F.struct("term", "weight")).alias("terms")))
    blocks = max(1, math.ceil(told.count() / block))
    sent = told.select("item_id", "terms", F.pmod(F.xxhash64("item_id"), F.lit(blocks)).cast("int").alias("block"), F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"))
    offered = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    parts = min(4 * shards * blocks, 20_000)
    found = offered.repartition(parts, "shard", "block").groupBy("shard", "block").cogroup(sent.repartition(parts, "shard", "block").groupBy("shard", "block")).applyInArrow(_searched(k), "item_id long, doc_id long, score long")
    rank = F.row_number().over(Window.partitionBy("item_id").orderBy(F.desc("score"), "doc_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("item_id", F.col("rank").cast("int").alias("rank"), F.nullif("doc_id", F.lit(NO_ID)).alias("doc_id"), "score")
