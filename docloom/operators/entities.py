"""Entities: variants of a name folded to one, and deterministic stand-ins for extraction by a language model."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docloom.functions import text as T


def canonical_names(names: DataFrame) -> DataFrame:
    """(name_key, canonical): for each key the longest of its names, ties to the greatest string."""
    keyed = names.withColumn("name_key", T.canonical_key(F.col("name")))
    return keyed.groupBy("name_key").agg(F.max(F.struct(F.length("name").alias("n"), F.col("name").alias("canonical"))).alias("best")).select("name_key", F.col("best.canonical").alias("canonical"))


def merged_by_vectors(canonical: DataFrame, vectors: DataFrame, threshold: float = 0.92) -> DataFrame:
    """`canonical` (name_key, canonical) where the name of a key whose words are a strict part of another key's, and whose vector is
    near enough, is replaced by that key's name: of several, the nearest, ties to the later key (key_ord). A replacement is never
    followed further. Vectors: (name_key, key_ord, vec), of unit length. Candidates are found by a shared word, the shorter key's first."""
    known = canonical.join(vectors, "name_key").withColumn("words", F.array_distinct(F.filter(F.split("name_key", " "), lambda w: w != ""))).where(F.size("words") > 0)
    short = known.select(F.col("name_key").alias("key_a"), F.col("vec").alias("vec_a"), F.col("words").alias("words_a"), F.array_min("words").alias("word"))
    longer = known.select(F.col("name_key").alias("key_b"), F.col("key_ord").alias("ord_b"), F.col("vec").alias("vec_b"), F.col("words").alias("words_b"), F.col("canonical").alias("name_b"), F.explode("words").alias("word"))
    near = short.join(longer, "word").where((F.size("words_b") > F.size("words_a")) & (F.size(F.array_except("words_a", "words_b")) == 0)).withColumn("sim", T.dot(F.col("vec_a"), F.col("vec_b"))).where(F.col("sim") >= threshold)
    best = near.groupBy(F.col("key_a").alias("name_key")).agg(F.max_by("name_b", F.struct("sim", "ord_b")).alias("merged"))
    return canonical.join(best, "name_key", "left").select("name_key", F.coalesce("merged", "canonical").alias("canonical"))


def aliases(names: DataFrame, canonical: DataFrame | None = None) -> DataFrame:
    """The alias table of names (name, ord, id): name, name_key, canonical, canonical_key, id; the first row of each name."""
    canonical = canonical_names(names) if canonical is None else canonical
    first = names.withColumn("n", F.row_number().over(Window.partitionBy("name").orderBy("ord"))).where("n = 1").withColumn("name_key", T.canonical_key(F.col("name")))
    joined = first.join(canonical, "name_key", "left").withColumn("canonical", F.coalesce("canonical", "name"))
    return joined.select("name", "name_key", "canonical", T.canonical_key(F.col("canonical")).alias("canonical_key"), F.col("id").cast("string").alias("id"))


def n_folded(alias_table: DataFrame) -> int:
    """How many names were folded into another one."""
    return alias_table.where("name <> canonical").count()


def folded(rows: DataFrame, column: str, alias_table: DataFrame) -> DataFrame:
    """`rows` with `key`: the canonical key of the name that `column` folds to (itself, if unknown)."""
    known = alias_table.select("name_key", F.col("canonical_key").alias("_to")).dropDuplicates(["name_key"])
    return rows.withColumn("name_key", T.canonical_key(F.col(column))).join(known, "name_key", "left").withColumn("key", F.coalesce("_to", "name_key")).drop("name_key", "_to")


def co_occurrence(members: DataFrame) -> DataFrame:
    """(a, b, weight): how many groups (group_id, item) two items share, a < b. Groups are small by nature: what one chunk names."""
    distinct = members.select("group_id", "item").distinct()
    other = distinct.select("group_id", F.col("item").alias("b"))
    return distinct.withColumnRenamed("item", "a").join(other, "group_id").where("a < b").groupBy("a", "b").agg(F.count("*").alias("weight"))


def claims(chunks: DataFrame, mentions: DataFrame | None = None) -> DataFrame:
    """(doc_id, chunk_id, pos, subject, statement): sentences of a chunk's text that say shall, should, may or must; the subject is the
    first name that the chunk mentions, else its title."""
    # white space is no part of these words, so texts and sentences without them go before theirs is collapsed
    normative = r"(?=[sm])\b(?:shall|should|may|must)\b"
    sentences = chunks.where(F.col("text").rlike(normative)).select("doc_id", "chunk_id", "title", F.posexplode(F.split("text", r"(?<=[.!?])\s+")).alias("pos", "statement"))
    found = sentences.where(F.col("statement").rlike(normative)).withColumn("statement", T.collapse(F.col("statement")))
    if mentions is None:
        return found.select("doc_id", "chunk_id", "pos", F.col("title").alias("subject"), "statement")
    first = mentions.groupBy("doc_id", "chunk_id").agg(F.min_by("name", "mention_pos").alias("first"))
    return found.join(first, ["doc_id", "chunk_id"], "left").select("doc_id", "chunk_id", "pos", F.coalesce("first", "title").alias("subject"), "statement")


def described(extracted: DataFrame, most: int | None = None) -> DataFrame:
    """(title, description): the distinct descriptions of each entity (title, ord, description) in order, joined; the first `most` only, if that is given."""
    ranked = extracted.groupBy("title", "description").agg(F.min("ord").alias("ord")).withColumn("n", F.row_number().over(Window.partitionBy("title").orderBy("ord")))
    ranked = ranked if most is None else ranked.where(F.col("n") <= most)
    return ranked.groupBy("title").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", "description"))), lambda x: x["description"]), " ").alias("description"))


def community_reports(communities: DataFrame, edges: DataFrame) -> DataFrame:
    """(community, size, n_edges, report): a sentence on each community (node, community) and the edges (a, b) within it."""
    sizes = communities.groupBy("community").agg(F.count("*").alias("size"))
    inside = edges.join(communities.select(F.col("node").alias("a"), F.col("community").alias("ca")), "a").join(communities.select(F.col("node").alias("b"), F.col("community").alias("cb")), "b").where("ca = cb").groupBy(F.col("ca").alias("community")).agg(F.count("*").alias("n_edges"))
    done = sizes.join(inside, "community", "left").fillna({"n_edges": 0})
    return done.withColumn("report", F.concat(F.lit("Community "), F.col("community").cast("string"), F.lit(" has "), F.col("size").cast("string"), F.lit(" members and "), F.col("n_edges").cast("string"), F.lit(" relationships.")))


def ordered_types(rows: DataFrame) -> DataFrame:
    """(types,), one row: every type of rows (side, pos, type) once, joined by commas in the order of their first places, side before pos."""
    first = rows.where("type is not null").groupBy("type").agg(F.min(F.struct("side", "pos")).alias("place"))
    return first.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "type"))), lambda x: x["type"]), ",").alias("types"))
