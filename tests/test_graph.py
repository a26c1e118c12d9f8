"""Graph operators on a literal graph with known answers (two components,
bridges and articulation points)."""

import pytest
from pyspark.sql import functions as F

from quarry.operators import graph as G

# component 1: triangle a-b-c, bridge c-d, path d-e ; component 2: x-y
EDGES = [("a", "b"), ("b", "c"), ("a", "c"), ("c", "d"), ("d", "e"), ("x", "y")]


@pytest.fixture(scope="module")
def edges(spark):
    return spark.createDataFrame([("g", s, d) for s, d in EDGES], "g string, src string, dst string")


def test_distances(edges):
    ap = {(r.s, r.v): (r.d, r.sigma) for r in G.bfs_all_pairs(edges, ["g"]).collect()}
    assert ap[("a", "e")] == (3, 1)
    assert ap[("b", "d")] == (2, 1)
    assert ("a", "x") not in ap


def test_components_and_paths(edges):
    comp = {r.node: r.component for r in G.components(edges, ["g"]).collect()}
    assert comp["e"] == "a" and comp["y"] == "x"
    m = G.path_metrics(edges, ["g"]).first()
    assert m.n_components == 2 and not m.is_connected
    assert m.diameter == 3 and m.avg_shortest_path == float("inf")


def test_bridges_and_articulation(edges):
    br = {(r.src, r.dst) for r in G.bridges(edges, ["g"]).collect()}
    assert br == {("c", "d"), ("d", "e"), ("x", "y")}
    ap = {r.node for r in G.articulation_points(edges, ["g"]).collect()}
    assert ap == {"c", "d"}


def test_betweenness_and_clustering(edges):
    bc = {r.node: r.betweenness for r in G.betweenness(edges, ["g"]).collect()}
    # c lies on the shortest paths a-d, a-e, b-d, b-e (x2 ordered) ; n = 7
    assert bc["c"] == pytest.approx(8 / (6 * 5))
    assert bc["d"] == pytest.approx(6 / (6 * 5))
    assert bc["a"] == 0.0
    cl = {r.node: r.clustering for r in G.clustering(edges, ["g"]).collect()}
    assert cl["a"] == 1.0 and cl["c"] == pytest.approx(1 / 3) and cl["e"] == 0.0


def test_closeness(edges):
    ap = G.bfs_all_pairs(edges, ["g"])
    cc = {r.node: r.closeness for r in G.closeness(ap, ["g"]).collect()}
    # c reaches 4 others at distances 1,1,1,2 ; V = 7
    assert cc["c"] == pytest.approx((4 / 5) * (4 / 6))


def test_girvan_newman_first_split(spark):
    e = spark.createDataFrame([("g", a, b) for a, b in [("a", "b"), ("b", "c"), ("a", "c"), ("c", "d"),
                                                          ("d", "e"), ("e", "f"), ("d", "f")]],
                              "g string, src string, dst string")
    gn = G.girvan_newman_split(e, ["g"])
    comms = {}
    for r in gn.collect():
        comms.setdefault(r.community, set()).add(r.node)
    assert sorted(map(sorted, comms.values())) == [["a", "b", "c"], ["d", "e", "f"]]
