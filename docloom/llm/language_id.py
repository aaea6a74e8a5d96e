"""Language identification: multinomial naive Bayes over hashed character bigrams and trigrams.

Counts of (language, bucket) are gathered as a Spark aggregation over the labelled rows that may be learned from. At most
`fit_rows` of them, in expectation, are used: an equal number for every language (all of its rows, if it has fewer), chosen by a hash of
doc_id, so that a rare language is learned as well from a large table as from a small one. The matrix of log probabilities has
languages * 2**bits entries; more than `most_languages` are an error, as labels are then no languages. That bounded matrix is
broadcast; every text is scored whole, in numpy, a batch at a time.

Besides the posterior of the best language, which says nothing on texts in a language that was never learned, a text has a lift: the
mean log probability of its n-grams in that language above that of buckets drawn evenly. Text of a learned language is far above 0,
text that no language explains is below.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import pieces

UNKNOWN = "und"
#: Bytes of text that are scored at a time; the arrays made of them are about 50 times as large.
PIECE = 1 << 20
_letters: list[np.ndarray] = []


def is_letter() -> np.ndarray:
    """For each code point, whether it is a letter (Unicode category L)."""
    if not _letters:
        _letters.append(np.fromiter(map(str.isalpha, map(chr, range(0x110000))), dtype=bool, count=0x110000))
    return _letters[0]


def features(texts: list[str], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of all n-grams of a batch, text after text, and how many each text has: two for each of its letters."""
    joined = "\n".join(["", *texts, ""]).lower() if len(texts) else ""
    lengths = np.fromiter((len(t.lower()) for t in texts), dtype=np.int64, count=len(texts))
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    letter = is_letter()[codes]
    codes = np.where(letter, codes, np.uint32(32))
    centre = np.flatnonzero(letter)
    pair = codes[centre - 1] * np.uint32(0x01000193) ^ codes[centre] * np.uint32(0x85EBCA6B)
    triple = pair * np.uint32(0xC2B2AE35) ^ codes[centre + 1] * np.uint32(0x27D4EB2F)
    buckets = np.empty(2 * len(centre), dtype=np.int32)
    for at, (value, salt) in enumerate(((pair, 0x1B873593), (triple, 0xCC9E2D51))):
        value = (value ^ (value >> np.uint32(15))) * np.uint32(salt)
        buckets[at::2] = (value ^ (value >> np.uint32(13))) >> np.uint32(32 - bits)
    starts = np.concatenate([[1], 1 + np.cumsum(lengths + 1)])
    return buckets, 2 * np.diff(np.searchsorted(centre, starts))


def _counted(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}
        for batch in pieces(batches, "text", PIECE):
            langs = batch.column("lang").to_pylist()
            buckets, counts = features(batch.column("text").to_pylist(), bits)
            ends = np.cumsum(counts)
            for lang, end, n in zip(langs, ends.tolist(), counts.tolist()):
                got = np.bincount(buckets[end - n : end], minlength=1 << bits)
                held[lang] = held[lang] + got if lang in held else got
        for lang, got in held.items():
            at = np.flatnonzero(got)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(got[at], pa.int64())], ["lang", "bucket", "n"])

    return run


def held_out() -> F.Column:
    """Rows that are never learned from: crc32 of the doc_id as text is divisible by 5 (or there is no doc_id)."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary")) % 5 == 0, F.lit(True))


def fit(docs: DataFrame, fit_rows: int = 20_000, bits: int = 16, most_languages: int = 256) -> tuple[list[str], np.ndarray]:
    """The languages, sorted, and the log probabilities: a row for each language, the last column its prior."""
    usable = docs.where(~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    seen = {r["lang"]: r["n"] for r in usable.groupBy("lang").agg(F.count("*").alias("n")).limit(most_languages + 1).collect()}
    if len(seen) > most_languages:
        raise ValueError(f"more than {most_languages} values of lang: they cannot all be languages")
    if not seen:
        return [], np.zeros((0, 1))
    langs, each = sorted(seen), fit_rows / len(seen)
    # a row is learned from if its hash, evenly spread over 64 bits, lies below its language's mark
    below = [(lang, min(2**63 - 1, int(-(2**63) + min(1.0, each / seen[lang]) * 2**64))) for lang in langs]
    marks = docs.sparkSession.createDataFrame(below, "lang string, below long")
    sample = usable.join(F.broadcast(marks), "lang").where(F.xxhash64("doc_id") <= F.col("below"))
    got = sample.select("lang", "text").mapInArrow(_counted(bits), "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros((len(langs), 1 << bits))
    place = {lang: i for i, lang in enumerate(langs)}
    counts[[place[x] for x in got["lang"]], got["bucket"].to_numpy(dtype=np.int64)] = got["n"].to_numpy(dtype=float)
    log = np.log((counts + 0.5) / (counts.sum(axis=1, keepdims=True) + 0.5 * (1 << bits)))
    prior = np.log([[seen[lang] / sum(seen.values())] for lang in langs])
    return langs, np.concatenate([log, prior], axis=1)


def _scored(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, matrix = model.value
        bits = (matrix.shape[1] - 1).bit_length() - 1
        log = matrix[:, :-1].astype(np.float32)
        for batch in pieces(batches, "text", PIECE):
            buckets, counts = features(batch.column("text").to_pylist(), bits)
            some = np.flatnonzero(counts)
            best, score, lift = np.full(len(counts), -1), np.zeros(len(counts)), np.zeros(len(counts))
            if len(some):
                starts = (np.cumsum(counts) - counts)[some]
                total = np.stack([np.add.reduceat(log[i][buckets], starts, dtype=np.float64) for i in range(len(langs))]) + matrix[:, -1:]
                best[some] = total.argmax(axis=0)
                score[some] = 1 / np.exp(total - total.max(axis=0)).sum(axis=0)
                lift[some] = (total.max(axis=0) - matrix[best[some], -1]) / counts[some] + bits * np.log(2)
            told = [pa.array([langs[i] if i >= 0 else UNKNOWN for i in best], pa.string()), pa.array(np.clip(score, 0, 1), pa.float64()), pa.array(lift, pa.float64())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), *told], ["doc_id", "held_out", "lang_pred", "score", "lift"])

    return run


def identify(docs: DataFrame, **parameters) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score (the posterior of the language, 0 to 1), lift (see above).

    `und` with score and lift 0 if the text is null or has no letter, or if nothing can be learned from. Languages at equal posteriors: the
    first in order. lang is used only of rows that are not held out, and never for a row's own prediction; a language that
    only rows without letters have is learned as a prior. Texts are read whole, however long. Repeated rows are judged alike. An
    empty table gives an empty result.
    """
    model = fit(docs, **parameters)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    if not model[0]:
        return rows.select("doc_id", "held_out", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(0.0).alias("lift"))
    return rows.mapInArrow(_scored(docs.sparkSession.sparkContext.broadcast(model)), "doc_id long, held_out boolean, lang_pred string, score double, lift double")


def keep_identified(docs: DataFrame, least_lift: float = 0.0, **parameters) -> DataFrame:
    """The rows of `docs`, with all their columns whatever their names, whose text has a language: a letter, and a lift above `least_lift`.

    Null and empty texts go. Repeated rows stay or go together. If nothing can be learned from, and for an empty table, nothing stays.
    """
    model = fit(docs, **parameters)
    if not model[0]:
        return docs.limit(0)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = _scored(sent)
        for batch in pieces(batches, "text", PIECE):
            text = pa.array([t or "" for t in batch.column("text").to_pylist()], pa.string())
            none = pa.nulls(batch.num_rows, pa.int64())
            told = list(judge(iter([pa.RecordBatch.from_arrays([none, pa.nulls(batch.num_rows, pa.bool_()), text], ["doc_id", "held_out", "text"])])))
            keep = [lang != UNKNOWN and lift > least_lift for part in told for lang, lift in zip(part.column("lang_pred").to_pylist(), part.column("lift").to_pylist())]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
