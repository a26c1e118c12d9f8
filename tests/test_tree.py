"""Categorical tree: null and odd branch values, pruning, prediction."""

from collections import Counter, defaultdict

import math

import pytest

from quarry.operators import cattree as CT
from quarry.plans import tree_queries

ATTRS = ["a", "b"]
ROWS = [(i, a, b, y) for i, (a, b, y) in enumerate(
    [("x/1", "p", 1)] * 12 + [("x/1", "q", 1)] * 2 + [(None, "p", 0)] * 10 + [(None, "q", 1)] * 6 + [("z=2", "p", 0)] * 9 + [("z=2", None, 1)] * 5)]


def frame(spark):
    return spark.createDataFrame(ROWS, "id int, a string, b string, y int")


def test_every_row_has_one_node_per_level(spark):
    nodes = CT.grow(frame(spark), ATTRS, "y").collect()
    by_parent = defaultdict(int)
    for r in nodes:
        by_parent[r["parent"]] += r["n"]
    split = {r["node"]: r["n"] for r in nodes if not r["is_leaf"]}
    assert by_parent.pop(None) == len(ROWS) and by_parent == split
    assert {r["branch_value"] for r in nodes if r["parent"] == "root"} == {"x/1", None, "z=2"}


def test_predictions_follow_the_branches(spark):
    df = frame(spark)
    pure = Counter((a, b) for _, a, b, _ in ROWS)
    tree = CT.grow(df, ATTRS, "y")
    got = {r["id"]: r["prediction"] for r in CT.predict(df, tree, "id").collect()}
    assert len(pure) == 6 and got == {i: y for i, _, _, y in ROWS}
    new = spark.createDataFrame([(100, "unseen", "p"), (101, None, "unseen")], "id int, a string, b string")
    root, null = ({r["node"]: r for r in tree.collect()}[k] for k in ("root", "root/0:1"))
    assert {r["id"]: r["prediction"] for r in CT.predict(new, tree, "id").collect()} == {100: root["majority"], 101: null["majority"]}


def test_pruning_cuts_what_chance_explains(spark):
    noise = [(i, "u" if i % 2 else "v", "w", int(i % 4 < 2)) for i in range(80)]
    tree = CT.grow(spark.createDataFrame(noise, "id int, a string, b string, y int"), ATTRS, "y")
    assert tree.count() > 1 and [r["node"] for r in CT.chi2_prune(tree).collect()] == ["root"]
    kept = CT.chi2_prune(CT.grow(frame(spark), ATTRS, "y"))
    assert kept.count() > 4 and not kept.filter("node = 'root'").first()["is_leaf"]
    lines = [r["line"] for r in CT.tree_text(kept).orderBy("node").collect()]
    assert lines[0] == "root [split a]" and "  a = (missing) [split b]" in lines


def test_critical_value():
    assert abs(CT.critical_value(1, 0.05) - 3.841458820694124) < 1e-9 and abs(CT.critical_value(5, 0.05) - 11.070497693516351) < 1e-8


@pytest.mark.parametrize("query", ["tree_lines", "tree_predictions", "tree_kfold"])
def test_queries_grow_the_full_tree(monkeypatch, spark, query):
    grow, open_nodes = CT.grow, []

    def watched(df, attrs, label, *args, **kwargs):
        tree = grow(df, attrs, label, *args, **kwargs)
        mixed = tree.filter("is_leaf AND n_pos > 0 AND n_pos < n")
        open_nodes.append(mixed.filter(f"depth < {len(attrs)}").count())
        return tree
    monkeypatch.setattr(CT, "grow", watched)
    assert getattr(tree_queries, query)(spark, "/root/testdata/sf0.001").count() > 0
    assert open_nodes and not any(open_nodes)  # only used-up attributes leave a mixed leaf


def plain_tree(rows, attrs, path="root", depth=0, value=None):
    """The tree of dict rows by recursion: [n, n_pos, split, children by value]."""
    def entropy(some):
        return -sum(k / len(some) * math.log2(k / len(some)) for k in Counter(r["label"] for r in some).values())
    pos = sum(r["label"] for r in rows)
    node = {"n": len(rows), "pos": pos, "depth": depth, "value": value, "path": path, "split": None, "kids": {}}
    if pos in (0, len(rows)) or not attrs:
        return node
    groups = {a: defaultdict(list) for a in attrs}
    for r in rows:
        for a in attrs:
            groups[a][r[a]].append(r)
    gain = {a: round(entropy(rows) - sum(len(g) / len(rows) * entropy(g) for g in groups[a].values()), 12) for a in attrs}
    node["split"] = best = max(attrs, key=lambda a: (gain[a], -attrs.index(a)))
    index = tree_queries.CAT_ATTRS.index(best)
    for k, v in enumerate(sorted(groups[best], key=lambda v: (v is not None, v)), 1):
        node["kids"][v] = plain_tree(groups[best][v], [a for a in attrs if a != best], f"{path}/{index}:{k}", depth + 1, v)
    return node


def plain_prune(node, mode):
    kids = list(node["kids"].values())
    if not kids:
        return node
    if mode == "reference":
        stat, dof = sum((k["n"] - node["n"] / 2) ** 2 / (node["n"] / 2) for k in kids[:2]), 1
        kept = len(kids) > 1 and stat >= CT.critical_value(1, 0.05)
    else:
        share, dof = node["pos"] / node["n"], max(len(kids) - 1, 1)
        stat = sum((k["pos"] - k["n"] * share) ** 2 / (k["n"] * share) + (k["n"] - k["pos"] - k["n"] * (1 - share)) ** 2 / (k["n"] * (1 - share)) for k in kids)
        kept = stat >= CT.critical_value(dof, 0.05)
    if not kept:
        return node | {"split": None, "kids": {}}
    return node | {"kids": {v: plain_prune(k, mode) for v, k in node["kids"].items()}}


def nodes_of(node):
    return [node] + [x for k in node["kids"].values() for x in nodes_of(k)]


def plain_predict(node, row):
    while node["split"] and row[node["split"]] in node["kids"]:
        node = node["kids"][row[node["split"]]]
    return int(node["pos"] > node["n"] - node["pos"])


SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def cat_rows(spark):
    from quarry.sources.cat import cat
    return [r.asDict() for r in cat(spark, SF).collect()]


def test_tree_queries_match_plain_recursion(spark, cat_rows):
    full = plain_tree(cat_rows, tree_queries.CAT_ATTRS)
    want = {(k["path"], k["value"], k["split"], k["n"], k["pos"]) for k in nodes_of(plain_prune(full, "contingency"))}
    got = tree_queries.decision_tree(spark, SF).select("node", "branch_value", "split_attr", "n", "n_pos").collect()
    assert len(got) == len(want) and {tuple(r) for r in got} == want

    def lines(node, head):
        yield node["path"], "  " * node["depth"] + head + (f" [split {node['split']}]" if node["split"] else f" -> {int(node['pos'] * 2 > node['n'])} (n={node['n']})")
        for v, k in node["kids"].items():
            yield from lines(k, f"{node['split']} = {'(missing)' if v is None else v}")
    want = set(lines(plain_prune(full, "reference"), "root"))
    assert {tuple(r) for r in tree_queries.tree_lines(spark, SF).select("node", "line").collect()} == want


def test_predictions_match_plain_recursion(spark, cat_rows):
    from quarry.operators.tabular import hash_split
    from quarry.sources.cat import cat
    c = cat(spark, SF).checkpoint()
    held = {r["row_id"] for r in hash_split(c, "row_id", 80)[1].select("row_id").collect()}
    tree = plain_prune(plain_tree([r for r in cat_rows if r["row_id"] not in held], tree_queries.CAT_ATTRS), "contingency")
    right = [plain_predict(tree, r) == r["label"] for r in cat_rows if r["row_id"] in held]
    n, accuracy = tree_queries.tree_predictions(spark, SF).first()
    assert n == len(right) > 100 and abs(accuracy - sum(right) / n) < 1e-12


def test_equal_rows_are_grown_and_predicted_as_one(monkeypatch, spark):
    gains, step, seen = CT.attribute_gains, CT._step, []
    monkeypatch.setattr(CT, "attribute_gains", lambda rows, *a, **k: (seen.append(rows.count()), gains(rows, *a, **k))[1])
    monkeypatch.setattr(CT, "_step", lambda rows, *a, **k: (seen.append(rows.count()), step(rows, *a, **k))[1])
    df = frame(spark)
    many = df.unionByName(df).unionByName(df)
    tree = CT.grow(many, ATTRS, "y")
    assert {r["node"]: (r["n"], r["n_pos"]) for r in tree.collect()} == {r["node"]: (3 * r["n"], 3 * r["n_pos"]) for r in CT.grow(df, ATTRS, "y").collect()}
    got = Counter((r["id"], r["y"], r["prediction"]) for r in CT.predict(many, tree, "id", "y").collect())
    assert got == {(i, y, y): 3 for i, _, _, y in ROWS}
    assert max(seen) == len({r[1:] for r in ROWS})
    leaf = CT.grow(many, ATTRS, "y", max_depth=0)
    assert CT.predict(many, leaf, "id").count() == 3 * len(ROWS)
