"""Components, blocks and communities against plain Python on random graphs."""

import random
from collections import defaultdict

import pytest

from quarry.operators import ranks, structure


def neighbours(edges):
    out = defaultdict(set)
    for a, b in edges:
        if a != b and a is not None and b is not None:
            out[a].add(b)
            out[b].add(a)
    return out


def reach(near, start, without=(), cut=None):
    seen, todo = {start}, [start]
    while todo:
        v = todo.pop()
        for w in near[v]:
            if w not in seen and w not in without and {v, w} != cut:
                seen.add(w)
                todo.append(w)
    return seen


def by_hand(edges):
    near = neighbours(edges)
    comp = {v: min(reach(near, v)) for v in near}
    bridges = {(a, b) for a in near for b in near[a] if a < b and b not in reach(near, a, cut={a, b})}
    points = {v for v in near if any(w not in reach(near, min(near[v]), without={v}) for w in near[v])}
    return comp, bridges, points


GRAPHS = {
    "path": [("a", "b"), ("b", "c"), ("c", "d"), ("d", "e"), ("e", "f"), ("f", "g")],
    "two cycles in a point": [("a", "b"), ("b", "c"), ("c", "a"), ("c", "d"), ("d", "e"), ("e", "c"), ("x", "y")],
    "star": [("h", c) for c in "abcdefg"],
    "square with a diagonal and a tail": [("a", "b"), ("b", "c"), ("c", "d"), ("d", "a"), ("a", "c"), ("d", "t"), ("t", "u"), ("a", "a"), ("b", "a")],
    None: [("p", "q"), ("q", None)],
}
r = random.Random(1)
for k, (n, m) in enumerate([(12, 11), (15, 16), (20, 24), (25, 60), (30, 29)]):
    GRAPHS[f"random {k}"] = [(f"v{r.randrange(n):02}", f"v{r.randrange(n):02}") for _ in range(m)]


@pytest.fixture(scope="module")
def graphs(spark):
    rows = [(g, a, b) for g, edges in GRAPHS.items() for a, b in edges]
    return spark.createDataFrame(rows, "g string, src string, dst string").repartition(3)


def test_components_bridges_and_points(graphs):
    comp = defaultdict(dict)
    for x in structure.connected(structure.both_ways(graphs, ["g"]), ["g"]).collect():
        comp[x["g"]][x["node"]] = x["component"]
    found = structure.blocks(graphs, ["g"])
    bridges, points = defaultdict(set), defaultdict(set)
    for x in structure.bridges(graphs, ["g"], found).collect():
        bridges[x["g"]].add((x["src"], x["dst"]))
    for x in structure.articulation_points(graphs, ["g"], found).collect():
        points[x["g"]].add(x["node"])
    for g, edges in GRAPHS.items():
        assert (comp[g], bridges[g], points[g]) == by_hand(edges), g


def test_rounds_do_not_follow_the_diameter(spark, monkeypatch):
    """A path of 300 nodes in shuffled order of names."""
    names = list(range(300))
    random.Random(3).shuffle(names)
    edges = spark.createDataFrame([(names[i], names[i + 1]) for i in range(299)], "src long, dst long")
    sym = structure.both_ways(edges, [])
    writes = []
    write = structure.written
    monkeypatch.setattr(structure, "written", lambda df: writes.append(1) or write(df))
    assert {x["component"] for x in structure.connected(sym, []).collect()} == {0}
    assert len(writes) <= 1 + 2 * 12


def test_empty_graph(spark):
    none = spark.createDataFrame([], "src string, dst string")
    assert structure.blocks(none, []).collect() == []
    assert structure.bridges(none, []).collect() == [] and structure.articulation_points(none, []).collect() == []
    member, steps = structure.greedy_modularity(none, [])
    assert member.collect() == [] and steps.collect() == []


def merged_by_hand(edges):
    """Every pair tried in every round, modularity from its definition."""
    near = neighbours(edges)
    m = sum(map(len, near.values())) / 2
    groups = {v: {v} for v in near}

    def quality(parts):
        return sum(sum(w in p for v in p for w in near[v]) / (2 * m) - (sum(len(near[v]) for v in p) / (2 * m)) ** 2 for p in parts)
    gains = []
    while True:
        base, best = quality(groups.values()), None
        for a in sorted(groups):
            for b in sorted(groups):
                if a < b and any(w in groups[b] for v in groups[a] for w in near[v]):
                    gain = quality([p for k, p in groups.items() if k not in (a, b)] + [groups[a] | groups[b]]) - base
                    if best is None or gain > best[0] + 1e-12:
                        best = (gain, a, b)
        if best is None or best[0] < -1e-12:
            return {v: k for k, p in groups.items() for v in p}, gains, quality(groups.values())
        gain, a, b = best
        groups[a] |= groups.pop(b)
        gains.append(gain)


def test_greedy_modularity(spark):
    rows = {"barbell": [("a", "b"), ("b", "c"), ("a", "c"), ("c", "d"), ("d", "e"), ("e", "f"), ("d", "f")], "random": GRAPHS["random 2"], "two": [("a", "b"), ("c", "d")]}
    edges = spark.createDataFrame([(g, a, b) for g, e in rows.items() for a, b in e], "g string, src string, dst string")
    member, steps = structure.greedy_modularity(edges, ["g"])
    quality = {x["g"]: x["modularity"] for x in structure.modularity(edges, ["g"], member).collect()}
    got, gains = defaultdict(dict), defaultdict(list)
    for x in member.collect():
        got[x["g"]][x["node"]] = x["community"]
    for x in sorted(steps.collect(), key=lambda x: x["step"]):
        gains[x["g"]].append(x["gain"])
    for g, e in rows.items():
        want, by, q = merged_by_hand(e)
        assert got[g] == want, g
        assert gains[g] == pytest.approx(by) and quality[g] == pytest.approx(q)
        assert min(gains[g]) >= 0
    assert got["barbell"] == dict(a="a", b="a", c="a", d="d", e="d", f="d")


def test_sums_before_cross_partitions(spark):
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    rows = [("hot" if i % 3 else f"g{i % 30}", i, i % 5 + 1) for i in range(500)] + [(None, 1000, 7), (None, 1001, 2)]
    df = spark.createDataFrame(rows, "g string, id long, n long").repartition(6)
    spark.conf.set(key, "false")
    try:
        got = {x["id"]: x["before"] for x in ranks.with_sum_before(df, "n", ["g"], "id", name="before").collect()}
    finally:
        spark.conf.set(key, "true")
    want, so_far = {}, defaultdict(int)
    for g, i, n in sorted(rows, key=lambda x: x[1]):
        want[i] = so_far[g]
        so_far[g] += n
    assert got == want


def test_no_table_of_nodes_goes_through_the_driver(spark, monkeypatch):
    plans, real = [], structure.written
    monkeypatch.setattr(structure, "written", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or real(df))
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (3, 4), (4, 5)], "src long, dst long")
    assert [tuple(r) for r in structure.bridges(edges, []).orderBy("src").collect()] == [(3, 4), (4, 5)]
    assert plans and not [p for p in plans if "Broadcast" in p and "__part" not in p]  # sums before: a row for each partition
