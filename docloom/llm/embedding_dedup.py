"""Near-duplicate vectors by a subspace pigeonhole join.

Unit vectors of cosine c lie at a squared distance of 2 - 2c. All are rotated by one fixed random rotation, which spreads what they
differ by evenly, and split into blocks of `width` coordinates. A pair within the whole squared distance lies, in one block at
least, within that block's share of it, in proportion to its coordinates. So in each block vectors are range-joined under this
budget: a grid over the block's first coordinates, with cells as wide as the budget's distance, deals each vector to its own cell, and
as a visitor to those of the cells around that come before its own and that it reaches. Within a cell, distances in the block are worked out as products of
matrices; the union of what all blocks propose is checked by the exact cosine of the original vectors, each pair in the first
block that proposes it.

Equal vectors are one class before anything is dealt. Cells with more than `tile` vectors are cut into tiles, and each pair of tiles is a
task's, so that no group is held whole. The work on pairs within a cell is arithmetic; only links are emitted.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.ann import scaled
from docloom.llm.common import cut
from docloom.llm.components import connected_components

SLACK, SEED, GRID = 1e-9, 12, 2
KEYS = ["label", "dim", "block", "cell"]
_rotations: dict[int, np.ndarray] = {}


def rotation(dim: int) -> np.ndarray:
    """A fixed random orthogonal matrix."""
    if dim not in _rotations:
        _rotations.clear()
        _rotations[dim] = np.linalg.qr(np.random.default_rng(SEED).normal(size=(dim, dim)))[0]
    return _rotations[dim]


def blocks_of(dim: int, width: int) -> list[slice]:
    ends = np.linspace(0, dim, max(1, math.ceil(dim / width)) + 1).astype(int)
    return [slice(int(a), int(b)) for a, b in zip(ends[:-1], ends[1:])]


def unit(x: np.ndarray) -> np.ndarray:
    x = scaled(x.astype(np.float64))
    return x / np.sqrt((x * x).sum(axis=1))[:, None]


def matrix_of(column: pa.ListArray) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), -1)


def cells_of(points: np.ndarray, reach: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where points of a block go: (row, cell, whether it is the row's own cell). Cells are squares (or intervals) of side `reach` of the first
    coordinates; a point also goes to those around its own that have a smaller number and that it is within reach of."""
    some = points[:, :GRID]
    place = np.floor(some / reach).astype(np.int64)
    low = some - place * reach  # how far it is from the lower edge

    def number(p: np.ndarray) -> np.ndarray:
        return (p[:, 0] << 32) + (p[:, 1] if p.shape[1] > 1 else 0)

    rows, cells, home = [np.arange(len(points))], [number(place)], [np.ones(len(points), dtype=bool)]
    for step in np.ndindex(*(3,) * some.shape[1]):
        move = np.array(step) - 1
        if not move.any() or number(move[None])[0] > 0:
            continue
        gap = np.where(move == 0, 0, np.where(move < 0, low, reach - low))
        near = np.flatnonzero((gap * gap).sum(axis=1) <= reach * reach)
        rows.append(near)
        cells.append(number(place[near] + move))
        home.append(np.zeros(len(near), dtype=bool))
    return np.concatenate(rows), np.concatenate(cells), np.concatenate(home)


def _placed(far: float, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = np.diff(batch.column("vec").offsets.to_numpy())
            for dim in np.unique(dims).tolist():
                mine = batch.take(pa.array(np.flatnonzero(dims == dim)))
                for start in range(0, mine.num_rows, 1000):
                    part = mine.slice(start, 1000)
                    x = unit(matrix_of(part.column("vec"))) @ rotation(dim)
                    for block, where in enumerate(blocks_of(dim, width)):
                        reach = math.sqrt(far * (where.stop - where.start) / dim) * (1 + 1e-6) + 1e-6
                        rows, cells, home = cells_of(x[:, where], reach)
                        at, n = pa.array(rows), len(rows)
                        yield pa.RecordBatch.from_arrays(
                            [part.column("label").take(at), pa.array(np.full(n, dim, dtype=np.int32)), pa.array(np.full(n, block, dtype=np.int32)), pa.array(cells), pa.array(home), part.column("id").take(at), part.column("vec").take(at)],
                            [*KEYS, "home", "id", "vec"],
                        )

    return run


def _linked(threshold: float, far: float, width: int, rows: int = 512):
    def run(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        dim, block, first, second = (group.column(c)[0].as_py() for c in ("dim", "block", "first", "second"))
        home, tile, ids = (group.column(c).to_numpy() for c in ("home", "tile", "id"))
        x = scaled(matrix_of(group.column("vec").chunk(0)).astype(np.float64))
        norm = np.sqrt((x * x).sum(axis=1))
        turned = (x / norm[:, None]) @ rotation(dim)
        slices = blocks_of(dim, width)
        budget = np.array([far * (s.stop - s.start) / dim for s in slices]) + SLACK
        y = turned[:, slices[block]]
        size = (y * y).sum(axis=1)
        left = np.flatnonzero(home & (tile == first))
        right = np.flatnonzero(tile == second) if first != second else np.arange(len(ids))
        out = [np.zeros((0, 2), dtype=np.int64)]
        for start in range(0, len(left), rows):
            some = left[start : start + rows]
            apart = size[some, None] + size[None, right] - 2 * (y[some] @ y[right].T)
            near = apart <= budget[block] + SLACK
            if first == second:  # each pair of the tile once, and all visitors
                near &= (right[None, :] > some[:, None]) | ~home[None, right]
            i, j = np.nonzero(near)
            for k in range(0, len(i), 20_000):
                a, b = some[i[k : k + 20_000]], right[j[k : k + 20_000]]
                gap = (turned[a] - turned[b]) ** 2
                before = np.zeros(len(a), dtype=bool)
                for s, most in zip(slices[:block], budget):  # surely proposed by an earlier block
                    before |= gap[:, s].sum(axis=1) <= most
                a, b = a[~before], b[~before]
                good = (x[a] * x[b]).sum(axis=1) / (norm[a] * norm[b]) >= threshold
                out.append(np.stack([ids[a[good]], ids[b[good]]], axis=1))
        links = np.concatenate(out)
        return pa.Table.from_arrays([pa.array(links.min(axis=1)), pa.array(links.max(axis=1))], ["a", "b"])

    return run


def links_of(classes: DataFrame, threshold: float, width: int = 8, tile: int = 4096) -> DataFrame:
    """(a, b), a < b: the pairs of ids of distinct vectors (label, vec, id) of one label whose cosine is `threshold` or more."""
    far = max(0.0, 2 - 2 * threshold)
    kind = dict(classes.dtypes)["vec"]
    placed = classes.select("label", "vec", "id").mapInArrow(_placed(far, width), f"label string, dim int, block int, cell long, home boolean, id long, vec {kind}")
    crowded = placed.groupBy(*KEYS).agg(F.count_if("home").alias("homes"), F.count_if(~F.col("home")).alias("visitors")).where(F.col("homes") + F.col("visitors") > tile)
    # crowded cells: tiles of homes from 0, then tiles of visitors
    crowded = cut(crowded.select(*KEYS, F.ceil(F.col("homes") / tile).cast("int").alias("own"), F.ceil(F.col("visitors") / tile).cast("int").alias("other")))
    rows = placed.join(crowded, KEYS, "left").withColumns({"own": F.coalesce("own", F.lit(0)), "other": F.coalesce("other", F.lit(0))})
    spread = F.xxhash64("id")
    tiled = F.when(F.col("own") == 0, 0).when(F.col("home"), F.pmod(spread, F.col("own"))).otherwise(F.col("own") + F.pmod(spread, F.greatest("other", F.lit(1)))).cast("int")
    rows = rows.withColumn("tile", tiled)
    # a home's tile meets every tile of the cell, a visitor's every tile of homes
    met = F.when(F.col("own") == 0, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.when(F.col("home"), F.col("own") + F.col("other")).otherwise(F.col("own")) - 1))
    rows = rows.withColumn("with", F.explode(met)).withColumns({"first": F.least("tile", "with"), "second": F.greatest("tile", "with")})
    return rows.select(*KEYS, "first", "second", "home", "tile", "id", "vec").groupBy(*KEYS, "first", "second").applyInArrow(_linked(threshold, far, width), "a long, b long").where("a < b").distinct()


def near_duplicates(vectors: DataFrame, threshold: float = 0.93, **parameters) -> DataFrame:
    """One row per input row (vec_id, embedding, label): vec_id, n_links, component_id, kept.

    Rows with equal, non-null labels are linked if the cosine of their vectors, in double precision, is `threshold` or more (0 at least); n_links counts
    the other rows linked directly, and component_id is the smallest vec_id reachable. Vectors that are null, empty or zero, or hold null or
    non-finite components, link with nothing, nor do those of different lengths with each other, nor rows with a null vec_id, whose component_id is null and
    which are kept. Rows that repeat a vec_id are one node, and each counts the other rows that its own vector is linked to. An empty table gives an empty result.
    """
    if not 0 <= threshold <= 1:
        raise ValueError("threshold must lie between 0 and 1")
    given = F.col("embedding")
    vec = given if dict(vectors.dtypes)["embedding"] in ("array<float>", "array<double>") else given.cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), vec.alias("vec"))
    finite = F.forall("vec", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    usable = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(finite & F.exists("vec", lambda v: v != 0), F.lit(False))
    rows = rows.withColumn("usable", usable)
    classes = cut(rows.where("usable").groupBy("label", "vec").agg(F.min("vec_id").alias("id"), F.count("*").alias("n")).withColumn("key", F.xxhash64("label", "id", "vec")))
    # a class is named by a number of its own, as classes may share their smallest vec_id
    links = cut(links_of(classes.select("label", "vec", F.col("key").alias("id")), threshold, **parameters))
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    sizes = classes.select(F.col("key").alias("b"), F.col("n").alias("m"))
    met = both.join(sizes, "b").groupBy(F.col("a").alias("key")).agg(F.sum("m").alias("met"))
    names = classes.select("key", "id")
    named = links.join(names.select(F.col("key").alias("a"), F.col("id").alias("x")), "a").join(names.select(F.col("key").alias("b"), F.col("id").alias("y")), "b")
    part = connected_components(named.select(F.col("x").alias("a"), F.col("y").alias("b")).unionByName(_repeated(rows.where("usable"))))
    told = classes.join(met, "key", "left").join(part.select(F.col("node").alias("id"), "component"), "id", "left").select("label", "vec", (F.col("n") - 1 + F.coalesce("met", F.lit(0))).alias("n_links"), F.coalesce("component", "id").alias("component"))
    joined = rows.alias("r").join(told.alias("t"), F.col("usable") & (F.col("r.label") == F.col("t.label")) & (F.col("r.vec") == F.col("t.vec")), "left")
    found = joined.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "vec_id").alias("component_id"))
    return found.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def _repeated(held: DataFrame) -> DataFrame:
    """(a, b): the vec_ids that rows with different vectors share stand in several classes; each is tied to the smallest vec_id of every class it is in."""
    several = held.groupBy("vec_id").agg(F.count("*").alias("times")).where("times > 1").select("vec_id")
    first = held.groupBy("label", "vec").agg(F.min("vec_id").alias("first"))
    ties = held.join(several, "vec_id").alias("h").join(first.alias("f"), (F.col("h.label") == F.col("f.label")) & (F.col("h.vec") == F.col("f.vec")))
    return ties.select(F.col("vec_id").alias("a"), F.col("first").alias("b"))
