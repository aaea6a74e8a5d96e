"""Exact dedup as a tree merge of sorted digest runs, in DataFrame operations only.

Documents are dealt into `runs` runs (a power of two) by a hash, so that copies of one text, however many, spread evenly over all
runs. A run lists each of its digests once, with the count and the extreme identifier of its rows. Runs then merge in
binomial rounds: in round k, run r meets run r xor 2**k, and of the two lists one is left, until one run holds every digest.
Every round exchanges lists by run and range of the digest (its first two bytes) and sorts them there, so that a task holds
sorted stretches of merged runs; entries of one digest are neighbours, two at most (one from each partner), and are folded into one.
So no round has a key that grows with a group of copies. An entry also carries the text's length in bytes and its
64-bit xxHash, and at every level only entries on which all three agree are merged.

The outcome goes down in two joins: to the entries of the first runs (at most `runs` rows a digest), then to the documents, by run
and digest; the copies of one text are so dealt over as many keys as there are runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docloom.llm.common import cut, id_and_text

KEY = ["digest", "length", "check"]


def _round(lists: DataFrame, bit: int, extreme) -> DataFrame:
    """The lists of runs that differ in `bit` only become one list, under the run without that bit."""
    met = lists.withColumn("run", F.col("run").bitwiseAND(F.lit(~bit))).withColumn("range", F.substring("digest", 1, 2))
    sorted_list = Window.partitionBy("run", "range").orderBy(*KEY)

    def has_same_key(neighbour) -> F.Column:
        return F.coalesce(neighbour(F.struct(*KEY)).over(sorted_list) == F.struct(*KEY), F.lit(False))

    paired = met.select(
        "run", *KEY, "keep_id", "group_size",
        has_same_key(F.lag).alias("is_second"), has_same_key(F.lead).alias("is_first"), F.lead("keep_id").over(sorted_list).alias("next_id"), F.lead("group_size").over(sorted_list).alias("next_size"),
    )
    folded = [F.when(F.col("is_first"), extreme("keep_id", "next_id")).otherwise(F.col("keep_id")).alias("keep_id"), F.when(F.col("is_first"), F.col("group_size") + F.col("next_size")).otherwise(F.col("group_size")).alias("group_size")]
    return paired.where("not is_second").select("run", *KEY, *folded)


def merge_runs(docs: DataFrame, runs: int = 256, keep: str = "largest") -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Null text counts as empty text. `keep` is "largest" or "smallest": which doc_id of a group stays. Null doc_ids never stay,
    unless a group has no other; then its keep_id is null. Where several rows carry the doc_id that stays (repeated rows),
    exactly one of them is kept. An empty table gives an empty result.
    """
    if runs < 1 or runs & (runs - 1):
        raise ValueError("runs must be a power of two")
    best, extreme = {"largest": (F.max, F.greatest), "smallest": (F.min, F.least)}[keep]
    named = id_and_text(docs).select(
        "doc_id",
        F.pmod(F.xxhash64("doc_id", "text"), F.lit(runs)).cast("int").alias("run"),
        F.unhex(F.sha2("text", 256)).alias("digest"),
        F.octet_length("text").alias("length"),
        F.xxhash64("text").alias("check"),
    )
    first = cut(named.groupBy("run", *KEY).agg(best("doc_id").alias("keep_id"), F.count("*").alias("group_size")))
    lists, bit = first, 1
    while bit < runs:
        lists, bit = _round(lists, bit, extreme), bit << 1
    outcome = first.select("run", *KEY).join(lists.select(*KEY, "keep_id", "group_size"), KEY)
    same = Window.partitionBy("run", *KEY, "doc_id").orderBy(F.lit(0))
    return (
        named.join(outcome, ["run", *KEY])
        .withColumn("copy", F.row_number().over(same))
        .select("doc_id", "keep_id", F.col("group_size").cast("long"), (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))
    )


def keep_one(docs: DataFrame, keep: str = "smallest", **parameters) -> DataFrame:
    """The rows of `docs` that stay, with all their columns whatever their names: one row of each text.

    Null texts count as empty ones, and all of these are one group. Rows without a doc_id stay only where their text has no other
    row, then once. Of rows that repeat the doc_id and text that stay, any one is kept. An empty table gives an empty result.
    """
    told = cut(merge_runs(docs, keep=keep, **parameters).groupBy("doc_id", F.unhex("text_sha256").alias("digest")).agg(F.max("kept").alias("stays"), F.count("*").alias("times")))
    rows, columns = docs.alias("d"), [F.col(f"d.`{c}`") for c in docs.columns]
    own = [F.col("d.doc_id").cast("long"), F.unhex(F.sha2(F.coalesce(F.col("d.text").cast("string"), F.lit("")), 256))]

    def matches(name: str) -> F.Column:
        return own[0].eqNullSafe(F.col(f"{name}.doc_id")) & (own[1] == F.col(f"{name}.digest"))

    once = rows.join(told.where("not stays or times > 1").alias("out"), matches("out"), "left_anti")
    again = told.where("stays and times > 1")
    if again.isEmpty():
        return once.select(*columns)
    held = rows.join(again.select("doc_id", "digest").alias("r"), matches("r"), "left_semi").select(F.struct(*columns).alias("row"), *(k.alias(n) for k, n in zip(own, ("doc_id", "digest"))))
    return once.select(*columns).unionByName(held.dropDuplicates(["doc_id", "digest"]).select("row.*"))
