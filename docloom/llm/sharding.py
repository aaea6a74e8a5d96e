"""Shards as runs of a Hilbert curve over document metadata.

Three dimensions are quantised to at most 2**bits cells each, all of them intervals: the size of the text in bytes (by quantiles of the
rows), the language and the source (in the order of their names, by ranges of the distinct names). Rows are sorted by the index
of their cell on the Hilbert curve and cut into runs, so that a shard covers a compact box of sizes, languages and sources, and
readers that filter on any of them skip shards by the minima and maxima in Parquet files. Equal texts are given one cell, that of
their smallest language and source, and sort together by checksum: a group of them lies in one run, or in neighbouring runs if
it is larger than the rest of a shard.

Ranks are exact and are made without a single sorted task: a range partitioning sorts the keys, and each partition's rows
are numbered from the count of rows in the partitions before it (a table of one row a partition).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docloom.llm.common import cut, shuffle_partitions


#: Parts that a group of equal texts is dealt in while its cell is settled.
SALTS = 256


def hilbert_index(cells: list[np.ndarray], bits: int) -> np.ndarray:
    """The index along the Hilbert curve of points with coordinates below 2**bits: coordinates are turned into the transposed
    index by undoing excess reflections and exchanges from the high bit down, then Gray decoded and interleaved."""
    x = [c.astype(np.int64).copy() for c in cells]
    high = 1 << (bits - 1)
    q = high
    while q > 1:
        for i in range(len(x)):
            flip = (x[i] & q) != 0
            swap = np.where(flip, 0, (x[0] ^ x[i]) & (q - 1))
            x[0] = np.where(flip, x[0] ^ (q - 1), x[0] ^ swap)
            if i:
                x[i] = x[i] ^ swap
        q >>= 1
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    gray = np.zeros_like(x[0])
    q = high
    while q > 1:
        gray = np.where(x[-1] & q, gray ^ (q - 1), gray)
        q >>= 1
    index = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for c in x:
            index = index << 1 | ((c ^ gray) >> b & 1)
    return index


def _spread(column: str, tops: list, bits: int) -> F.Column:
    """The cell of a value: how many of the ascending `tops` of cells it exceeds, spread over all 2**bits cells."""
    if not tops:
        return F.lit(0)
    return (F.size(F.filter(F.array(*(F.lit(t) for t in tops)), lambda top: top < F.col(column))) * (((1 << bits) - 1) // len(tops))).cast("int")


def _size_cell(told: DataFrame, bits: int) -> F.Column:
    n = 1 << bits
    found = told.agg(F.percentile_approx("size", [i / n for i in range(1, n)], 10_000).alias("tops")).first()["tops"]
    return _spread("size", sorted(set(found or [])), bits)


def _name_cell(told: DataFrame, column: str, bits: int) -> F.Column:
    """Ranges of the distinct names, told apart by their first 256 characters; one name at most for each cell comes to the driver."""
    names = told.select(F.substring(column, 1, 256).alias("name")).distinct()
    ranges = names.repartitionByRange(1 << bits, "name").withColumn("part", F.spark_partition_id()).groupBy("part").agg(F.max("name").alias("top"))
    return _spread(column, sorted(r.top for r in ranges.collect())[:-1], bits)


def _ranked(docs: DataFrame, shards: int, bits: int, whole: bool) -> DataFrame:
    """doc_id, size, text_crc32, shard, rank, start (the rank at which the shard begins), and the whole row as a struct if asked for."""
    spark = docs.sparkSession
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    told = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("mark"),
        *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) if c in docs.columns else F.lit("").alias(c) for c in ("lang", "source")),
        *([F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")] if whole else []),
    )
    cells = [_size_cell(told, bits), *(_name_cell(told, c, bits) for c in ("lang", "source"))]
    group = ["text_crc32", "mark", "size"]
    # a group's cell is found and handed back by (group, salt), so that a group of very many copies is never one key
    told = told.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)))
    salted = told.groupBy(*group, "salt").agg(F.min("lang").alias("lang_1"), F.min("source").alias("source_1"), F.max("lang").alias("lang_2"), F.max("source").alias("source_2"))
    shared = salted.groupBy(*group).agg(*(f(c).alias(c) for c, f in (("lang_1", F.min), ("source_1", F.min), ("lang_2", F.max), ("source_2", F.max))))
    shared = shared.where("lang_1 <> lang_2 or source_1 <> source_2").select(*group, F.col("lang_1").alias("lang_0"), F.col("source_1").alias("source_0"))
    moved = salted.select(*group, "salt").join(shared, group)
    told = told.join(moved, [*group, "salt"], "left").withColumns({"lang": F.coalesce("lang_0", "lang"), "source": F.coalesce("source_0", "source")})

    @F.pandas_udf("long")
    def on_curve(size: pd.Series, lang: pd.Series, source: pd.Series) -> pd.Series:
        return pd.Series(hilbert_index([c.to_numpy() for c in (size, lang, source)], bits))

    row = ["row"] if whole else []
    keyed = told.select("doc_id", *group, *row, on_curve(*cells).alias("curve"))
    order = ["curve", "text_crc32", "mark", "doc_id"]
    ranged = keyed.repartitionByRange(max(1, shuffle_partitions(spark)), *order).sortWithinPartitions(*order)
    # cut() keeps these rows with their partition and place, so that every later use sees the same ones
    placed = cut(ranged.select("doc_id", "size", "text_crc32", *row, F.spark_partition_id().alias("part"), F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("place")))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = placed.groupBy("part").agg(F.count("*").alias("rows"))
    firsts = counts.select("part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("first"), F.sum("rows").over(Window.partitionBy()).alias("total"))
    ranked = placed.join(F.broadcast(firsts), "part").withColumn("rank", F.col("first") + F.col("place")).withColumn("shard", F.expr(f"(rank * {shards}L) div total").cast("int"))
    start = F.expr(f"(shard * total + {shards - 1}L) div {shards}L")
    return ranked.select("doc_id", "size", "text_crc32", *row, "shard", "rank", start.alias("start"))


def shard_documents(docs: DataFrame, shards: int = 24, bits: int = 6) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    The law is `rows`: shard counts differ by one at most, and slots are gapless from 0 within a shard. size is the UTF-8 length
    (null text: 0) plus 8; text_crc32 is of the text's UTF-8 bytes (null: of none). Null languages and sources are a value of
    their own. Ties on the curve are broken by checksum, then by hash of the text, then doc_id; rows alike in all of these may take each
    other's slots. grown_shard is null under this law. Empty tables give empty results.
    """
    told = _ranked(docs, shards, bits, whole=False)
    return told.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", (F.col("rank") - F.col("start")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def write_shards(docs: DataFrame, folder: str, shards: int = 24, bits: int = 6) -> None:
    """Write whole rows as Parquet, one folder `hilbert_shard=<number>` for each shard of shard_documents, in the order of the curve.

    All columns are kept; one that is itself named hilbert_shard is an error. An empty table writes no shard. A rerun after a failure
    replaces what the folder holds.
    """
    if "hilbert_shard" in docs.columns:
        raise ValueError("hilbert_shard is the name of the shard's folder")
    _ranked(docs, shards, bits, whole=True).select("row.*", F.col("shard").alias("hilbert_shard")).write.partitionBy("hilbert_shard").mode("overwrite").parquet(folder)
