"""Sinks that replace as a whole, and documents that are added, changed and deleted."""

import json
import os

import pytest
from pyspark.sql import functions as F

from docloom.sources import writers
from docloom.streaming.upserts import ChunkStore


def files_below(path):
    return {os.path.relpath(os.path.join(d, f), path): open(os.path.join(d, f)).read() for d, _, names in os.walk(path) for f in names if not f.endswith(".crc")}


def test_chunk_files_replace_as_a_whole(spark, tmp_path):
    target = str(tmp_path / "chunks")
    rows = [(1, "a/b c", "first\n"), (1, None, None), (2, "a", "second")]
    writers.chunk_files(spark.createDataFrame(rows, "doc_id long, chunk_id string, text string").repartition(3), target)
    before = files_below(target)
    assert before == {"doc_id=1/chunk_id=a%2Fb%20c/part-0.md": "first\n", "doc_id=1/chunk_id=__HIVE_DEFAULT_PARTITION__/part-0.md": "", "doc_id=2/chunk_id=a/part-0.md": "second"}
    # a task that fails after others have written leaves the earlier output whole; at most a task that outlives the abort leaves something beside it
    bad = spark.createDataFrame([(i, "x", "new") for i in range(8)], "doc_id long, chunk_id string, text string").repartition(4)
    failing = bad.withColumn("text", F.when(F.col("doc_id") == 5, F.raise_error(F.lit("no"))).otherwise(F.col("text")))
    with pytest.raises(Exception, match="no"):
        writers.chunk_files(failing, target)
    assert files_below(target) == before and all(f == "chunks" or f.startswith("chunks.fresh-") for f in os.listdir(tmp_path))
    writers.chunk_files(spark.createDataFrame([(3, "z", "third")], "doc_id long, chunk_id string, text string"), target)
    assert files_below(target) == {"doc_id=3/chunk_id=z/part-0.md": "third"}
    writers.chunk_files(spark.createDataFrame([], "doc_id long, chunk_id string, text string"), target)
    assert files_below(target) == {}


def test_a_folder_is_replaced_when_all_is_written(spark, tmp_path):
    target = str(tmp_path / "kb")
    with writers.replacing(spark, target) as fresh:
        spark.range(3).write.parquet(f"{fresh}/a")
    with pytest.raises(ZeroDivisionError), writers.replacing(spark, target) as fresh:
        spark.range(9).write.parquet(f"{fresh}/a")
        raise ZeroDivisionError
    assert spark.read.parquet(f"{target}/a").count() == 3
    with writers.replacing(spark, target) as fresh:
        spark.range(5).write.parquet(f"{fresh}/b")
    assert os.listdir(target) == ["b"] and [f for f in os.listdir(tmp_path) if not f.startswith(".")] == ["kb"]


def texts(store):
    return {(r.source, r.title): r.text.split("\n")[-1] for r in store.chunks().join(store.documents().select("doc_id", F.element_at(F.split("path", "/"), -1).alias("source")), "doc_id").collect()}


def test_a_stream_of_changes(spark, tmp_path):
    feed, n = tmp_path / "feed", iter(range(9))
    feed.mkdir()
    store = ChunkStore(spark, str(tmp_path / "store"))

    def send(*rows):
        at = feed / f"{next(n)}.json"
        at.with_suffix(".tmp").write_text("".join(json.dumps(dict(zip(("path", "md", "modified", "deleted"), r))) + "\n" for r in rows))
        at.with_suffix(".tmp").rename(at)

    def run():
        changes = spark.readStream.schema("path string, md string, modified long, deleted boolean").option("pathGlobFilter", "*.json").json(str(feed))
        store.follow(changes, str(tmp_path / "checkpoint")).awaitTermination()

    assert store.chunks().count() == 0 and store.edges().count() == 0
    send(("a.md", "# 1 One\n\nfirst. See Section 2.\n\n# 2 Two\n\nsecond", 1, None), ("b.md", "# 1 B\n\nbody", 1, False), (None, "x", 1, False), ("e.md", None, 1, False))
    run()
    assert texts(store) == {("a.md", "One"): "first. See Section 2 (Two).", ("a.md", "Two"): "second", ("b.md", "B"): "body"}
    assert [r.ref_text for r in store.edges().collect()] == ["Section 2"]
    # a change, a deletion, an older change that comes late, two changes of one document; the query is a new one from the same checkpoint
    send(("a.md", "# 1 One\n\nchanged", 5, False), ("b.md", None, 2, True), ("c.md", "# C\n\nold", 2, False), ("c.md", "# C\n\nnew", 3, False))
    run()
    send(("a.md", "# 1 One\n\nlate", 4, False))
    run()
    assert texts(store) == {("a.md", "One"): "changed", ("c.md", "C"): "new"} and store.edges().count() == 0
    held = store.chunks().count()
    store.apply(spark.createDataFrame([("c.md", "# C\n\nagain", 9, False)], "path string, md string, modified long, deleted boolean"), 7)
    store.apply(spark.createDataFrame([("c.md", "# C\n\nagain", 9, False)], "path string, md string, modified long, deleted boolean"), 7)
    assert store.chunks().count() == held and texts(store)["c.md", "C"] == "again"


def test_a_folder_that_changes(spark, tmp_path):
    source = tmp_path / "docs"
    source.mkdir()
    (source / "one.md").write_text("# One\n\nfirst")
    (source / "two.md").write_text("# Two\n\nsecond")
    store = ChunkStore(spark, str(tmp_path / "store"))
    assert store.sync(str(source)) == 0 and store.sync(str(source)) == 0
    (source / "one.md").write_text("# One\n\nother")
    os.utime(source / "one.md", (2_000_000_000, 2_000_000_000))
    (source / "two.md").unlink()
    (source / "three.md").write_text("# Three\n\nthird")
    assert store.sync(str(source)) == 1
    assert texts(store) == {("one.md", "One"): "other", ("three.md", "Three"): "third"}
    assert store._read("chunks", "").where("version = 1").count() == 2  # what has not changed is not read again
