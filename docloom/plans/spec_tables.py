"""Specification-like inputs projected from plain tables, so that every query has something to parse."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spec_documents(documents: DataFrame, rich: bool = True) -> DataFrame:
    """(doc_id, doc_title, md): each line of a document's text becomes a section that refers to another one. Rich documents also get
    captions and references to them, tables, cue phrases, normative sentences and sections without a body, by line number."""
    texts = documents.repartition("doc_id").groupBy("doc_id").agg(F.collect_list("text").alias("texts"))
    numbered = F.flatten(F.transform("texts", lambda t: F.transform(F.split(t, "\n", -1), lambda line, p: F.struct(p.alias("p"), line.alias("line")))))
    rows = texts.where("size(texts) > 0").select("doc_id", numbered.alias("lines"), F.size("texts").alias("of"))

    def once(value, use):
        """`use` of a value that is worked out once for each line."""
        return F.get(F.transform(F.array(value), use), F.lit(0))

    def number(p):
        return F.concat((F.floor(p / 3) + 1).cast("string"), F.element_at(F.array(F.lit(""), F.lit(".1"), F.lit(".1.1")), (p % 3 + 1).cast("int")))

    def section(x):
        begin = F.regexp_extract(x["line"], r"^(?:[^A-Za-z]*+[A-Za-z][^ ]*+){0,3}", 0)  # as far as the third word with a letter
        words = F.filter(F.split(F.regexp_replace(begin, "[^A-Za-z ]", ""), " "), lambda w: w != "")
        title = F.concat(F.lit("T"), F.array_join(F.slice(words, 1, 3), " "), F.lit(" x"))
        told = F.struct(x["p"].alias("p"), x["line"].alias("line"), number(x["p"]).alias("num"), title.alias("title"), number((x["p"] * 7 + 3) % F.size("lines")).alias("to"))
        return once(told, lambda r: F.struct(r["p"].alias("p"), told_of(r).alias("section")))

    def told_of(r):
        p, line, num, title, to = (r[c] for c in ("p", "line", "num", "title", "to"))
        body = F.concat(F.lit("\n\n"), line, F.lit(" See Section "), to, F.lit("."))
        if rich:
            body = F.concat(
                body,
                F.when(p % 5 == 0, F.concat(F.lit("\n\nTable "), p.cast("string"), F.lit(": values of "), title)).otherwise(""),
                F.when(p % 5 == 1, F.concat(F.lit("\n\nFigure "), p.cast("string"), F.lit(": view of "), title, F.lit("\n\nAs Table "), (p - 1).cast("string"), F.lit(" says."))).otherwise(""),
                F.when(p % 4 == 0, F.concat(F.lit("\n\n| name | value |\n| --- | --- |\n| "), num, F.lit(" | a |\n| b | "), to, F.lit(" |"))).otherwise(""),
                F.when(p % 6 == 0, F.concat(F.lit("\n\nIt is defined in "), title, F.lit("."))).otherwise(""),
                F.when(p % 7 == 0, F.lit("\n\nThe unit shall answer. It works.")).otherwise(""),
            )
            body = F.when(p % 9 == 8, F.lit("")).otherwise(body)
        return F.concat(F.repeat(F.lit("#"), (p % 3 + 1).cast("int")), F.lit(" "), num, F.lit(" "), title, body)

    # lines follow each other already, save where several rows share a doc_id
    sections = rows.select("doc_id", "of", F.transform("lines", section).alias("sections"))
    sections = sections.withColumn("sections", F.when(F.col("of") > 1, F.array_sort("sections")).otherwise(F.col("sections")))
    joined = F.array_join(F.transform("sections", lambda x: x["section"]), "\n\n")
    return sections.select("doc_id", F.concat(F.lit("Doc "), F.col("doc_id").cast("string")).alias("doc_title"), joined.alias("md"))


def graph_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An edge table over customers, parts and suppliers: who ordered what, and who supplied it."""
    orders, items = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    both = orders.join(items, F.col("o_orderkey") == F.col("l_orderkey"))
    ends = {c: F.concat(F.lit(k), F.col(col).cast("string")) for c, k, col in (("c", "C", "o_custkey"), ("p", "P", "l_partkey"), ("s", "S", "l_suppkey"))}
    one = both.select(ends["c"].alias("src_chunk_id"), ends["p"].alias("dst_chunk_id"), F.lit("references_section").alias("edge_type"), (F.col("l_returnflag") != "R").alias("resolved"), F.lit(1.0).alias("weight"))
    two = both.select(ends["p"].alias("src_chunk_id"), ends["s"].alias("dst_chunk_id"), F.lit("references_named").alias("edge_type"), (F.col("l_returnflag") != "R").alias("resolved"), F.lit(0.8).alias("weight"))
    edges = one.unionByName(two).groupBy("src_chunk_id", "dst_chunk_id", "edge_type", "weight").agg(F.max("resolved").alias("resolved"))
    return edges.withColumns({"ref_text": F.concat(F.lit("ref "), "dst_chunk_id"), "edge_ord": F.conv(F.substring(F.md5(F.concat_ws("/", "src_chunk_id", "dst_chunk_id")), 1, 12), 16, 10).cast("long")})


def graph_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A query for each nation: its customers with the smallest keys, at most 20 (that is what a seed list is)."""
    from pyspark.sql import Window

    ranked = table(spark, sf_dir, "customer").withColumn("pos", F.row_number().over(Window.partitionBy("c_nationkey").orderBy("c_custkey"))).where("pos <= 20")
    return ranked.select(F.col("c_nationkey").alias("query_id"), F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("node"), "pos", (21 - F.col("pos")).cast("double").alias("score"))


def alias_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(name, ord, id): variants of the parts' names."""
    base = table(spark, sf_dir, "part").select(F.col("p_name").alias("n")).distinct()
    forms = [F.col("n"), F.concat(F.lit("the "), "n"), F.initcap("n"), F.concat("n", F.lit("s")), F.concat("n", F.lit("'s")), F.replace("n", F.lit(" "), F.lit("-")), F.element_at(F.split("n", " "), -1)]
    rows = base.select(F.posexplode(F.array(*forms)).alias("v", "name"), "n").groupBy("name").agg(F.min(F.struct("n", "v")).alias("first"))
    return rows.select("name", F.concat(F.col("first.n"), F.lit("/"), F.col("first.v").cast("string")).alias("ord"), F.md5("name").alias("id"))
