"""Repeated byte strings by prefix-free parsing, dealt over Spark.

Parsing: a trigger is a place whose rolling hash of `GRAM` bytes is the least (leftmost, if several are) within some window of
`length` bytes. Every window so has exactly one trigger that owns it, and equal windows have it at the same place, whatever
surrounds them; with triggers by residue, as in the usual parsing, a window might hold none. The text between triggers makes
the phrases. Each trigger owns a run of consecutive windows.

Dictionary: the bytes at a trigger are its key. Only triggers whose key occurs at least twice in the corpus can own a
repeated window; they are found by sorting keys (30 bytes a trigger are moved, no text). A key that occurs twice in one batch of
texts is known to repeat: one of its triggers tells the other batches, the rest get a salt, so that a very frequent key
is never one task's.

Order: of those triggers, the surroundings that their windows reach are dealt by key. Sorted by what follows the
trigger, they stand in the order of suffixes of the parse; sorted by what precedes it, read backwards, in the order of the phrase
suffixes before it. Both orders, with the lengths that neighbours in them share, combine: windows that begin x bytes before
their trigger are equal if they lie in one interval of the second order that shares x bytes, and in one of the first that shares
length - x bytes. This is exact, needs no window to be hashed or moved on its own, and each order is made within groups of equal
triggers, cut off at the window's length, instead of over the whole corpus.

Surroundings that are equal in every byte are merged within a task before they are dealt, with a list of where they stand.

Keys of more than `frequent` triggers are not dealt whole, as their surroundings would all be one task's. Each of their windows is dealt
by its own 128-bit BLAKE2 digest instead. A window that occurs twice in one batch of texts is known to repeat, and only
tells the other batches so; of every digest, a batch sends one row at most.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docloom.llm.common import bytes_of, cut, mixed, pieces, shuffle_partitions
from docloom.llm.lexical import BITS, bitmap_of

GRAM = 64
_BYTE = mixed(np.arange(256, dtype=np.uint64), 11)
_PLACE = np.uint64((1 << 31) - 1)


def gram_hashes(flat: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the GRAM bytes from each place on, by doubling: that of 2n bytes from those of n bytes at two places."""
    h, n, factor = _BYTE[flat], 1, 0x9E3779B97F4A7C15
    while n < GRAM:
        h = h[:-n] * np.uint64(factor) + h[n:]
        n, factor = 2 * n, factor * factor % 2**64
    return mixed(h, 12)


def triggers(flat: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Runs of windows with one owner: text number, first window and trigger (places in `flat`), windows in the run, and the key."""
    none = (np.zeros(0, dtype=np.int64),) * 5
    if len(flat) < length:
        return none
    h = gram_hashes(flat)
    width = length - GRAM + 1
    least = (h & ~_PLACE) | np.arange(len(h), dtype=np.uint64)
    n = 1
    while 2 * n <= width:
        least, n = np.minimum(least[:-n], least[n:]), 2 * n
    if n < width:
        least = np.minimum(least[: len(least) - (width - n)], least[width - n :])
    inside = np.zeros(len(flat) + 1, dtype=np.int64)
    long = np.flatnonzero(np.diff(ends) >= length)
    if not len(long):
        return none
    np.add.at(inside, ends[long], 1)
    np.add.at(inside, ends[long + 1] - length + 1, -1)
    window = np.flatnonzero(np.cumsum(inside)[: len(least)] > 0)
    owner = (least[window] & _PLACE).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
    count = np.diff(np.concatenate([first, [len(owner)]]))
    text = np.searchsorted(ends, window[first], side="right") - 1
    return text, window[first], owner[first], count, h[owner[first]].view(np.int64)


def _parsed(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", 2 << 20):
            flat, ends = bytes_of(batch.column("text"))
            text, first, owner, count, key = triggers(flat, ends, length)
            at = pa.array(text)
            _, one, which, times = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
            salt = np.where(times[which] > 1, 1 + np.arange(len(key)) % 32_000, 0)
            salt[one[times > 1]] = -1
            yield pa.RecordBatch.from_arrays([batch.column("doc").take(at), batch.column("mark").take(at), pa.array(first - ends[text], pa.int32()), pa.array(owner - first, pa.int16()), pa.array(count, pa.int16()), pa.array(key), pa.array(salt, pa.int16())], ["doc", "mark", "first", "lead", "windows", "key", "salt"])

    return run


def _told(bits: bytes):
    """Whether a key's bit is set."""
    return lambda key: bits[key % BITS >> 3] >> (key & 7) & 1


def _surroundings(length: int, sent):
    """The surroundings of all triggers whose key is not frequent."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = _told(sent.value)
        for batch in pieces(batches, "text"):
            found: dict[tuple, list] = {}
            for doc, mark, text, runs in zip(batch.column("doc").to_pylist(), batch.column("mark").to_pylist(), batch.column("text"), batch.column("runs")):
                raw, values = text.as_buffer().to_pybytes(), runs.values
                for first, lead, windows, key in zip(*(values.field(i).to_pylist() for i in range(4))):
                    if frequent(key):
                        continue
                    found.setdefault((key, lead, windows, raw[first : first + windows - 1 + length]), []).append((doc, mark, first))
            places = [p for held in found.values() for p in held]
            ends = np.concatenate([[0], np.cumsum([len(held) for held in found.values()])]).astype(np.int32)
            at = pa.StructArray.from_arrays([pa.array([p[i] for p in places], t) for i, t in enumerate((pa.int64(), pa.int32(), pa.int32()))], ["doc", "mark", "first"])
            columns = [pa.array([k[i] for k in found], t) for i, t in enumerate((pa.int64(), pa.int16(), pa.int16(), pa.binary()))]
            yield pa.RecordBatch.from_arrays([*columns, pa.ListArray.from_arrays(pa.array(ends), at)], ["key", "lead", "windows", "around", "places"])

    return run


def _digests(length: int, sent):
    """The windows of triggers whose key is frequent: those that repeat within a batch as runs without a digest; the others one by one, by
    digest; and for each digest of the first kind a row without a place. The salt deals out rows without a digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = _told(sent.value)
        for batch in pieces(batches, "text", 1 << 20):
            found: dict[bytes, list] = {}
            for doc, mark, text, runs in zip(batch.column("doc").to_pylist(), batch.column("mark").to_pylist(), batch.column("text"), batch.column("runs")):
                raw, values = text.as_buffer().to_pybytes(), runs.values
                for first, windows, key in zip(*(values.field(i).to_pylist() for i in (0, 2, 3))):
                    if frequent(key):
                        found.setdefault(raw[first : first + windows - 1 + length], []).append((doc, mark, first))
            if not found:
                continue
            places = list(found.values())
            size = np.array([len(around) - length + 1 for around in found])
            sums = b"".join(hashlib.blake2b(around[i : i + length], digest_size=16).digest() for around in found for i in range(len(around) - length + 1))
            halves = np.frombuffer(sums, dtype="<u8").reshape(-1, 2)
            order = np.lexsort((halves[:, 1], halves[:, 0]))
            new = np.concatenate([[True], (halves[order][1:] != halves[order][:-1]).any(axis=1)])
            which = np.empty(len(order), dtype=np.int64)
            which[order] = np.cumsum(new) - 1
            owner = np.repeat(np.arange(len(places)), size)
            within = np.arange(len(owner)) - (np.cumsum(size) - size)[owner]
            times = np.bincount(which, np.array([len(p) for p in places])[owner])
            again = times[which] > 1
            rows = [(sums[16 * i : 16 * i + 16], 0, None, None, None, None) for i in order[new][times > 1].tolist()]
            for i in np.flatnonzero(~again).tolist():
                doc, mark, first = places[owner[i]][0]
                at = first + int(within[i])
                rows.append((sums[16 * i : 16 * i + 16], 0, doc, mark, at, at))
            low = np.flatnonzero(again & ((within == 0) | ~np.roll(again, 1)))
            high = np.flatnonzero(again & ((within == size[owner] - 1) | ~np.roll(again, -1)))
            for i, j in zip(low.tolist(), high.tolist()):
                for doc, mark, first in places[owner[i]]:
                    rows.append((None, 1 + len(rows) % 32_000, doc, mark, first + int(within[i]), first + int(within[j])))
            kinds = (pa.binary(), pa.int16(), pa.int64(), pa.int32(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], ["digest", "salt", "doc", "mark", "low", "high"])

    return run


def _padded(flat: np.ndarray, start: np.ndarray, size: np.ndarray, width: int, step: int) -> np.ndarray:
    """A row of `width` bytes for each stretch of `size` bytes from `start` on (forwards or backwards), filled up with zeros."""
    at = np.arange(width)
    inside = at < size[:, None]
    return np.where(inside, flat[np.where(inside, start[:, None] + step * at, 0)], 0).astype(np.uint8)


def _ordered(group: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of rows by (group, bytes), and how many bytes each shares with the one before it (-1 where a group begins)."""
    keyed = np.concatenate([group.astype(">u4")[:, None].view(np.uint8).reshape(len(group), 4), rows], axis=1)
    order = np.argsort(np.ascontiguousarray(keyed).view(f"S{keyed.shape[1]}").ravel(), kind="stable")
    keyed = keyed[order]
    differs = keyed[1:] != keyed[:-1]
    shared = np.where(differs.any(axis=1), differs.argmax(axis=1) - 4, rows.shape[1])
    return order, np.concatenate([[-1], np.where(shared < 0, -1, shared)])


def repeated_windows(group: np.ndarray, lead: np.ndarray, windows: np.ndarray, flat: np.ndarray, ends: np.ndarray, times: np.ndarray, length: int) -> np.ndarray:
    """For each row and each x, whether the window that begins x bytes before the trigger occurs at least twice."""
    n, reach = len(group), length - GRAM
    follow, follow_shares = _ordered(group, _padded(flat, ends[:-1] + lead, np.diff(ends) - lead, length, 1))
    precede, precede_shares = _ordered(group, _padded(flat, ends[:-1] + lead - 1, lead, reach, -1))
    out = np.zeros((n, reach + 1), dtype=bool)
    after, before = np.empty(n, dtype=np.int64), np.empty(n, dtype=np.int64)
    for x in range(reach + 1):
        rows = np.flatnonzero((x <= lead) & (x > lead - windows))
        if not len(rows):
            continue
        after[follow] = np.cumsum(follow_shares < length - x)
        before[precede] = np.cumsum(precede_shares < x)
        both = after[rows] * np.int64(n + 1) + before[rows]
        _, which, count = np.unique(both, return_inverse=True, return_counts=True)
        out[rows, x] = (count[which] > 1) | (times[rows] > 1)
    return out


def _repeats(length: int, most: int = 12 << 20):
    def told(rows: pa.Table) -> pa.RecordBatch:
        rows = rows.combine_chunks()
        column = {c: rows.column(c).chunk(0) if rows.num_rows else rows.column(c) for c in rows.column_names}
        flat, ends = bytes_of(column["around"])
        _, group = np.unique(column["key"].to_numpy(), return_inverse=True)
        lead, windows = (column[c].to_numpy().astype(np.int64) for c in ("lead", "windows"))
        places = column["places"]
        times = np.diff(places.offsets.to_numpy())
        is_repeated = repeated_windows(group, lead, windows, flat, ends, times, length)
        edge = np.diff(np.pad(is_repeated.astype(np.int8), ((0, 0), (1, 1))), axis=1)
        row, high = np.nonzero(edge == -1)  # runs of x, so of windows, from the last to the first
        low = np.nonzero(edge == 1)[1]
        # every place of a row gets each of its runs
        n = times[row]
        run = np.repeat(np.arange(len(row)), n)
        at = pa.array(np.repeat(places.offsets.to_numpy()[row], n) - places.offsets.to_numpy()[0] + np.arange(len(run)) - np.repeat(np.cumsum(n) - n, n))
        place = places.flatten().take(at)
        start = place.field(2).to_numpy().astype(np.int64) + lead[row[run]]
        return pa.RecordBatch.from_arrays([place.field(0), place.field(1), pa.array(start - high[run] + 1, pa.int64()), pa.array(start - low[run], pa.int64())], ["doc", "mark", "low", "high"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            for start in range(0, batch.num_rows, 4096):
                part = batch.slice(start, 4096)
                held.append(part)
                size += part.num_rows * (length + 64)
                if size < most:
                    continue
                rows = pa.Table.from_batches(held)
                key = rows.column("key").to_numpy()
                whole = int(np.searchsorted(key, key[-1]))  # the last key may go on
                if whole:
                    yield told(rows.slice(0, whole))
                    held = rows.slice(whole).to_batches()
                    size = (rows.num_rows - whole) * (length + 64)
        if held:
            yield told(pa.Table.from_batches(held))

    return run


def _kept_and_spans(text: bytes, low: list[int], high: list[int], length: int) -> tuple[bytes, int]:
    """What is left of a text without all windows that begin at low to high, and the number of maximal runs removed."""
    covered = np.zeros(len(text) + 1, dtype=np.int64)
    np.add.at(covered, np.array(low, dtype=np.int64), 1)
    np.add.at(covered, np.minimum(np.array(high, dtype=np.int64) + length, len(text)), -1)
    gone = np.cumsum(covered)[:-1] > 0
    spans = int(np.count_nonzero(gone & ~np.concatenate([[False], gone[:-1]])))
    return np.frombuffer(text, dtype=np.uint8)[~gone].tobytes(), spans


def _mark(text: F.Column) -> F.Column:
    return F.coalesce((F.crc32(text.cast("binary")) - 2**31).cast("int"), F.lit(0))


def _identified(docs: DataFrame) -> DataFrame:
    """Rows are told apart by doc_id and the text's CRC (a null doc_id: by the text's hash)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.xxhash64(text)).alias("doc"), _mark(text).alias("mark"), F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))


def repeated_runs(docs: DataFrame, length: int = 200, frequent: int = 2_000) -> DataFrame:
    """(doc, mark, runs): for each document with repeated strings, the inclusive runs (low, high) of places where one begins."""
    if length < GRAM:
        raise ValueError(f"repeated strings must have {GRAM} bytes at least")
    n = shuffle_partitions(docs.sparkSession)
    whole = _identified(docs)
    parsed = whole.select("doc", "mark", "text").mapInArrow(_parsed(length), "doc long, mark int, first int, lead short, windows short, key long, salt short")
    same = Window.partitionBy("key", F.greatest("salt", F.lit(0))).orderBy("doc", "first")
    again = parsed.withColumns({"_before": F.lag("key").over(same), "_after": F.lead("key").over(same)}).where("salt <> 0 or _before is not null or _after is not null")
    runs = cut(again.groupBy("doc", "mark").agg(F.collect_list(F.struct("first", "lead", "windows", "key")).alias("runs")))
    many = runs.select(F.explode("runs.key").alias("term")).groupBy("term").agg(F.count("*").alias("times")).where(F.col("times") > frequent)
    # a bitmap of fixed size, whatever the number of these keys; a key that shares a bit with one of them is judged by digests too, which is as right
    bits = bitmap_of(many)
    sent = docs.sparkSession.sparkContext.broadcast(bits)
    # all columns go on, so that this join and that of the result share one exchange of the texts
    joined = whole.join(runs, ["doc", "mark"]).select("doc", "mark", "doc_id", "text", "runs")
    around = joined.mapInArrow(_surroundings(length, sent), "key long, lead short, windows short, around binary, places array<struct<doc:long,mark:int,first:int>>")
    found = around.repartition(n, "key").sortWithinPartitions("key").mapInArrow(_repeats(length), "doc long, mark int, low long, high long")
    if any(bits):
        dealt = joined.mapInArrow(_digests(length, sent), "digest binary, salt short, doc long, mark int, low long, high long")
        same = Window.partitionBy("digest", "salt").orderBy("doc", "low")
        known = dealt.withColumns({"_before": F.lag("salt").over(same), "_after": F.lead("salt").over(same)})
        found = found.unionByName(known.where("doc is not null and (digest is null or _before is not null or _after is not null)").select("doc", "mark", "low", "high"))
    return found.groupBy("doc", "mark").agg(F.collect_list(F.struct("low", "high")).alias("runs"))


def remove_repeats(docs: DataFrame, length: int = 200, frequent: int = 2_000) -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (the remaining bytes).

    Removes every byte that lies in a string of `length` bytes that also begins elsewhere: in another row, or elsewhere in the
    same text, overlapping or not. Strings never cross rows, and are judged on the texts as given. Null texts are empty;
    texts shorter than `length` stay as they are. Repeated rows are other rows: their texts go if they are long enough.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            out = []
            for text, runs in zip(batch.column("text"), batch.column("runs")):
                raw = text.as_buffer().to_pybytes()
                kept, spans = _kept_and_spans(raw, runs.values.field(0).to_pylist(), runs.values.field(1).to_pylist(), length) if runs.is_valid else (raw, 0)
                out.append((len(raw), len(raw) - len(kept), spans, hashlib.sha256(kept).hexdigest(), kept))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array([o[i] for o in out], t) for i, t in enumerate(kinds))], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    joined = _identified(docs).join(repeated_runs(docs, length, frequent), ["doc", "mark"], "left")
    return joined.select("doc", "mark", "doc_id", "text", "runs").mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")


def without_repeats(docs: DataFrame, length: int = 200) -> DataFrame:
    """The rows of `docs`, with all their columns, whatever their names: text without its repeated strings (and without characters that a cut
    has halved), n_chars, where there is one, its new length. Null texts stay null. Repeated rows are other rows, so their texts go
    if they are long enough. An empty table gives an empty result."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.xxhash64(text)).alias("doc"), _mark(text).alias("mark"), F.col("text").cast("string").alias("text"), F.struct(*(docs[f"`{c}`"] for c in docs.columns if c != "text")).alias("rest"))
    joined = rows.join(repeated_runs(docs, length), ["doc", "mark"], "left").select("text", "runs", "rest")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for text, spans in zip(batch.column("text").to_pylist(), batch.column("runs")):
                if text is not None and spans.is_valid:
                    text = _kept_and_spans(text.encode(), spans.values.field(0).to_pylist(), spans.values.field(1).to_pylist(), length)[0].decode("utf-8", "ignore")
                texts.append(text)
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), batch.column("rest")], ["text", "rest"])

    rest = joined.schema["rest"].dataType.simpleString()
    done = joined.mapInArrow(run, f"text string, rest {rest}")
    new = {"text": F.col("text").cast(docs.schema["text"].dataType)}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.length("text").cast(docs.schema["n_chars"].dataType)
    return done.select(*(new.get(c, F.col("rest").getField(c)).alias(c) for c in docs.columns))
