"""Walks over bucketed edges, clusters by modularity, and running numbers, against plain Python."""

import itertools
import random
from collections import Counter, defaultdict

import pytest

from docloom.operators import adjacency, chunking, clustering, graph
from docloom.operators.ordering import numbered_within

random.seed(31)
EDGE = "src_chunk_id string, dst_chunk_id string, edge_type string, ref_text string, resolved boolean, weight double, edge_ord long"


def some_edges(n=400, nodes=60):
    ends = [(f"n{random.randrange(nodes) if random.random() < 0.7 else 0}", f"n{random.randrange(nodes)}") for _ in range(n)]
    rows = [(a, b, "references_section", f"r{i}", random.random() < 0.8, random.choice([1.0, 0.8, None]), i) for i, (a, b) in enumerate(ends)]
    return [*rows, (None, "n1", "x", "r", True, 1.0, 9000), ("", "n1", "x", "r", True, 1.0, 9001), ("n1", None, "x", "r", True, 1.0, 9002)]


def walked(edges, seeds, depth, decay):
    out, into = defaultdict(list), defaultdict(list)
    for e in edges:
        if e[4] and e[0] and e[1]:
            out[e[0]].append(e)
            into[e[1]].append(e)
    hits, seen, queue = {}, {n for n, _ in seeds}, [(n, s, 0) for n, s in seeds]
    while queue:
        node, score, hop = queue.pop(0)
        if hop == depth:
            continue
        for where, listed, end in (("xref_out", out, 1), ("xref_in", into, 0)):
            for e in listed[node]:
                if e[end] not in seen:
                    seen.add(e[end])
                    hits[e[end]] = (hop + 1, where, e[3], score * decay ** (hop + 1) * (1.0 if e[5] is None else e[5]))
                    queue.append((e[end], hits[e[end]][3], hop + 1))
    return hits


@pytest.mark.parametrize("most", [100_000, 5])
def test_walk_over_an_adjacency(spark, tmp_path, most):
    edges = some_edges()
    rows = spark.createDataFrame(edges, EDGE)
    made = adjacency.write_adjacency(rows, str(tmp_path / "a"), buckets=3, most=most)
    assert (made.hubs.count() > 0) == (most == 5) and made.edges.count() == 2 * sum(bool(e[4] and e[0] and e[1]) for e in edges)
    seeds = {1: [("n3", 3.0), ("n5", 2.0)], 2: [("n0", 1.0)], 3: [("nowhere", 1.0)]}
    frame = spark.createDataFrame([(q, n, i + 1, s) for q, held in seeds.items() for i, (n, s) in enumerate(held)], "query_id int, node string, pos int, score double")
    for given in (made, adjacency.open_adjacency(spark, str(tmp_path / "a")), rows):
        got = defaultdict(dict)
        for r in graph.expand(given, frame, depth=2).collect():
            got[r.query_id][r.chunk_id] = (r.hop, r.direction, r.via, r.score)
        for q, held in seeds.items():
            want = walked(edges, held, 2, 0.5)
            assert got[q].keys() == want.keys()
            for node, (hop, where, via, score) in want.items():
                assert got[q][node][:3] == (hop, where, via) and abs(got[q][node][3] - score) < 1e-12
    assert graph.expand(rows.limit(0), frame, depth=2).count() == 0


def test_a_hop_exchanges_only_its_frontier(spark, tmp_path):
    made = adjacency.write_adjacency(spark.createDataFrame(some_edges(), EDGE), str(tmp_path / "b"), buckets=4)
    frontier = spark.createDataFrame([("n1", 1)], "node string, query_id int")
    kept = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        plan = made.step(frontier)._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    side = plan[plan.index(f"FileScan parquet spark_catalog.default.{made.name}") - 400 :]
    assert "Bucketed: true" in plan and "SelectedBucketsCount: 4 out of 4" in plan
    # exchanges: the frontier by node for its hubs, the hubs, and the frontier by node and part
    assert plan.count("Exchange") == 3 and "Exchange" not in side.split("FileScan")[0].rpartition("SortMergeJoin")[2].rpartition("+- Sort")[2]


def plain_louvain(edges):
    """Greedy modularity, one node after the other, with contraction."""
    weight = Counter()
    for a, b, w in edges:
        if a != b:
            weight[frozenset((a, b))] += w
    adj = defaultdict(Counter)
    for pair, w in weight.items():
        a, b = pair
        adj[a][b] += w
        adj[b][a] += w
    names = {n: n for n in adj}
    while True:
        k = {n: sum(adj[n].values()) for n in adj}
        total, com, sums = sum(k.values()), {n: n for n in adj}, dict(k)
        moved, any_moved = True, False
        while moved:
            moved = False
            for n in sorted(adj):
                links = Counter()
                for m, w in adj[n].items():
                    if m != n:
                        links[com[m]] += w
                sums[com[n]] -= k[n]
                best = max([*links, com[n]], key=lambda c: (links[c] - k[n] * sums[c] / total, c == com[n]))
                if best != com[n]:
                    com[n], moved, any_moved = best, True, True
                sums[com[n]] += k[n]
        names = {n: com[c] for n, c in names.items()}
        if not any_moved:
            return names
        new = defaultdict(Counter)
        for a in adj:
            for b, w in adj[a].items():
                new[com[a]][com[b]] += w
        adj = new


def test_planted_communities_and_levels(spark):
    groups, size = 6, 12
    edges = []
    for a, b in itertools.combinations(range(groups * size), 2):
        if random.random() < (0.6 if a // size == b // size else 0.02):
            edges.append((f"v{a:03}", f"v{b:03}", 1.0))
    edges += [("v000", "v000", 5.0), (None, "v001", 1.0), ("v001", "v002", 0.0)]
    frame = spark.createDataFrame(edges, "a string, b string, weight double")
    rows = clustering.clusters(frame, most=10).collect()
    nodes = {x for a, b, w in edges if a and w and a != b for x in (a, b)}
    top = defaultdict(set)
    for r in rows:
        if r.level == 0:
            top[r.community].add(r.node)
            assert r.parent is None
    planted = {frozenset(f"v{i:03}" for i in range(g * size, g * size + size)) for g in range(groups)}
    assert {frozenset(v) for v in top.values()} == planted
    held = {(r.community, r.node) for r in rows}
    size_of, deepest = Counter(r.community for r in rows), {}
    for r in sorted(rows, key=lambda r: r.level):
        deepest[r.node] = r.community
        assert r.parent is None or (r.parent, r.node) in held and size_of[r.parent] > 10
    assert deepest.keys() == nodes and max(size_of[c] for c in deepest.values()) <= 10
    told = clustering.modularity(frame, spark.createDataFrame([(n, c) for c, v in top.items() for n in v], "node string, community string"))
    plain = clustering.modularity(frame, spark.createDataFrame(list(plain_louvain([e for e in edges if e[0] and e[2]]).items()), "node string, community string"))
    assert told >= plain - 1e-9


def test_clusters_that_do_not_split_are_cut(spark):
    star = [(0, i, 1.0) for i in range(1, 35)] + [(100 + a, 100 + b, 1.0) for a, b in itertools.combinations(range(14), 2)]
    frame = spark.createDataFrame(star, "a long, b long, weight double")
    rows = clustering.clusters(frame, most=5).collect()
    deepest = {r.node: r.community for r in sorted(rows, key=lambda r: r.level)}
    assert len(deepest) == 49 and max(Counter(deepest.values()).values()) <= 5
    assert clustering.clusters(frame.limit(0)).count() == 0


def test_modularity_of_a_sparse_random_graph(spark):
    edges = [(random.randrange(80), random.randrange(80), random.choice([1.0, 2.0])) for _ in range(220)]
    frame = spark.createDataFrame(edges, "a long, b long, weight double")
    top = clustering.clusters(frame, most=1000)
    plain = spark.createDataFrame(list(plain_louvain(edges).items()), "node long, community long")
    assert clustering.modularity(frame, top.select("node", "community")) >= clustering.modularity(frame, plain) - 0.02


def test_running_numbers_of_skewed_groups(spark):
    rows = [(0 if i % 4 else i, i * 7919 % 5000, "x") for i in range(5000)] + [(None, 3, "y"), (None, 1, "z")]
    frame = spark.createDataFrame(rows, "scope long, place long, name string").repartition(5)
    got = numbered_within(frame, ["scope"], ["place"], "n", partitions=7)
    want = defaultdict(list)
    for scope, place, _ in rows:
        want[scope].append(place)
    for held in want.values():
        held.sort()
    told = got.collect()
    assert len(told) == len(rows) and all(want[r.scope][r.n - 1] == r.place for r in told)
    assert numbered_within(frame.limit(0), ["scope"], ["place"], "n").count() == 0
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window") == 1 and "_part" in plan.split("Window")[1].split("\n")[0]  # over counts, not rows


def test_chunk_files_number_a_large_collection(spark):
    files = spark.createDataFrame([(c, f"/d/{c}/{i:04}.md", f"# {i} Title {i}\n\nBody {i}." if i % 50 else " ") for c, n in ((1, 400), (2, 3)) for i in range(n)], "collection_id long, path string, content string")
    got = chunking.chunk_files(files).collect()
    for c, n in ((1, 400), (2, 3)):
        mine = sorted((r for r in got if r.doc_id == c), key=lambda r: r.order)
        assert [r.order for r in mine] == list(range(1, len(mine) + 1))
        assert [r.source_path for r in mine] == [f"/d/{c}/{i:04}.md" for i in range(n) if i % 50]
