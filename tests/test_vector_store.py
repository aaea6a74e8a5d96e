"""The vector store against a search of all vectors."""

import os

import numpy as np

from docloom.operators import vectors
from docloom.operators.vector_store import VectorStore


def test_probes_find_the_nearest(spark, tmp_path):
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(40, 24))
    x = centres[rng.integers(40, size=1500)] + 0.35 * rng.normal(size=(1500, 24))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(1500, [0.0] * 24), (1501, None), (None, [1.0] * 24), (1502, x[3].tolist())]
    base = spark.createDataFrame(rows, "id long, vec array<double>")
    store = VectorStore.write(base, str(tmp_path / "s"), lists=32, most=60)
    held = store.lists()
    assert held.count() == 1502 and held.groupBy("list", "part").count().where("count > 200").count() == 0
    queries = base.where("id % 20 = 0 or id = 1501").withColumnRenamed("id", "query_id")
    assert store.recall(queries, 10, probes=6) >= 0.9
    # with every list probed, the search is exact
    whole = VectorStore(spark, str(tmp_path / "s")).search(queries, 5, probes=32)
    exact = vectors.top_k(held.select("id", "vec"), queries.where("vec is not null"), 5)
    assert sorted((r.query_id, r.rank, r.id) for r in whole.collect()) == sorted((r.query_id, r.rank, r.id) for r in exact.collect())
    one = store.search(queries.where("query_id = 20"), 5, probes=2)
    assert 0 < one.count() <= 5 and len([d for d in os.listdir(tmp_path / "s/lists") if d.startswith("list=")]) > 2


def test_a_store_of_nothing(spark, tmp_path):
    empty = spark.createDataFrame([], "id long, vec array<double>")
    store = VectorStore.write(spark.createDataFrame([(1, [1.0, 0.0])], "id long, vec array<double>"), str(tmp_path / "one"))
    assert store.search(empty.withColumnRenamed("id", "query_id"), 3).count() == 0
    assert [r.id for r in store.search(spark.createDataFrame([(5, [0.5, 0.5])], "query_id long, vec array<double>"), 3).collect()] == [1]
    nothing = VectorStore.write(empty, str(tmp_path / "none"))
    assert nothing.search(spark.createDataFrame([(5, [0.5, 0.5])], "query_id long, vec array<double>"), 3).count() == 0 and nothing.lists().count() == 0
