"""Structure of large undirected graphs.

Edge frames are ``(keys..., src, dst)`` and may hold many graphs side by side.
Every step works on rows in proportion to the edges: components in a number of
rounds that grows with the logarithm of the graph, blocks by one search forest,
and communities by contracting a table of pairs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.operators.ranks import with_sum_before
from quarry.session import written


def both_ways(edges: DataFrame, keys: list[str]) -> DataFrame:
    """Each undirected edge in both directions once, without loops and nulls; a written table."""
    e = edges.select(*keys, "src", "dst").where("src IS NOT NULL AND dst IS NOT NULL AND src <> dst")
    return written(e.unionByName(e.select(*keys, F.col("dst").alias("src"), F.col("src").alias("dst"))).distinct())


def _on(left: str, right: str, keys: list[str], a: str, b: str):
    return reduce(lambda x, y: x & y, [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys], F.col(f"{left}.{a}") == F.col(f"{right}.{b}"))


def _dealt(frame: DataFrame, name: str) -> DataFrame:
    """The right side of a join that grows with the nodes: both sides are dealt
    by the key, so none is sent through the driver, however small its file."""
    return frame.alias(name).hint("merge")


def connected(sym: DataFrame, keys: list[str]) -> DataFrame:
    """``(keys, node, component)``, the component named by its smallest
    node, for :func:`both_ways` edges. Hooking and shortcutting: in each round a
    node's parent becomes the least grandparent among its neighbours and its
    own, and so does the parent of its old parent; trees halve in height, so
    rounds grow with the logarithm of the nodes, not with the diameter."""
    cols = [F.col(f"n.{k}").alias(k) for k in keys]
    f = written(sym.select(*keys, F.col("src").alias("node")).distinct().withColumn("parent", F.col("node")))
    while True:
        up = (f.alias("n").join(_dealt(f, "p"), _on("n", "p", keys, "parent", "node"))
              .select(*cols, F.col("n.node").alias("node"), F.col("n.parent").alias("parent"), F.col("p.parent").alias("grand")))
        up = written(up)
        near = (sym.alias("n").join(_dealt(up, "p"), _on("n", "p", keys, "dst", "node"))
                .groupBy(*cols, F.col("n.src").alias("node")).agg(F.min("p.grand").alias("low")))
        hook = (up.alias("n").join(_dealt(near, "p"), _on("n", "p", keys, "node", "node"))
                .select(*cols, F.explode(F.array("n.node", "n.parent")).alias("node"), F.col("p.low").alias("low")))
        low = (hook.unionByName(up.select(*keys, "node", F.col("grand").alias("low"))).groupBy(*keys, "node").agg(F.min("low").alias("low")))
        new = written(f.alias("n").join(_dealt(low, "p"), _on("n", "p", keys, "node", "node"))
                      .select(*cols, F.col("n.node").alias("node"), F.least("n.parent", "p.low").alias("parent"), (F.col("p.low") < F.col("n.parent")).alias("moved")))
        f = new.drop("moved")
        if new.where("moved").isEmpty():
            return f.withColumnRenamed("parent", "component")


def search_forest(sym: DataFrame, keys: list[str]) -> list[DataFrame]:
    """One breadth-first tree per component, rooted at its smallest node, as
    written tables ``(keys, node, parent)``, one for each depth. A node's new
    neighbours are those outside its own level and the one before, so every
    edge is looked at twice in all."""
    comp = connected(sym, keys)
    levels = [written(comp.where("node = component").select(*keys, "node", F.lit(None).cast(comp.schema["node"].dataType).alias("parent")))]
    while True:
        found = (levels[-1].alias("n").join(_dealt(sym, "e"), _on("n", "e", keys, "node", "src"))
                 .groupBy(*[F.col(f"n.{k}").alias(k) for k in keys], F.col("e.dst").alias("node")).agg(F.min("e.src").alias("parent")))
        for seen in levels[-2:]:
            found = found.alias("n").join(_dealt(seen, "p"), _on("n", "p", keys, "node", "node"), "left_anti")
        found = written(found.select(*keys, "node", "parent"))
        if found.isEmpty():
            return levels
        levels.append(found)


def _children(level: DataFrame, keys: list[str], *aggs) -> DataFrame:
    return level.groupBy(*keys, F.col("parent").alias("node")).agg(*aggs)


def blocks(edges: DataFrame, keys: list[str]) -> DataFrame:
    """Biconnected components: ``(keys, node, parent, block)``, a row for each
    edge of a search forest, the block named by one of its nodes. Nodes get
    numbers in depth-first order with the sizes of their subtrees, then the
    least and greatest number that their subtree reaches by any edge but the
    one to the parent; tree edges belong together where an edge of the graph
    joins their subtrees, or a subtree reaches beyond that of its parent."""
    sym = both_ways(edges, keys)
    levels = search_forest(sym, keys)
    same = [F.col(f"n.{k}").alias(k) for k in keys]
    sized: list[DataFrame] = []
    for level in reversed(levels):
        below = [sized[-1]] if sized else []
        size = F.lit(1).cast("long")
        frame = level.alias("n")
        for deeper in below:
            frame = frame.join(_dealt(_children(deeper, keys, F.sum("size").alias("size")), "p"), _on("n", "p", keys, "node", "node"), "left")
            size = F.lit(1) + F.coalesce("p.size", F.lit(0))
        sized.append(written(frame.select(*same, "n.node", "n.parent", size.alias("size"))))
    sized.reverse()
    # depth-first numbers: the parent's, one, and the subtrees of the siblings before
    numbered = [written(sized[0].withColumn("number", F.lit(0).cast("long")))]
    for level in sized[1:]:
        placed = with_sum_before(level, "size", [*keys, "parent"], "node", name="before")
        numbered.append(written(placed.alias("n").join(_dealt(numbered[-1], "p"), _on("n", "p", keys, "parent", "node"))
                                .select(*same, "n.node", "n.parent", "n.size", (F.col("p.number") + 1 + F.col("n.before")).alias("number"))))
    every = written(reduce(DataFrame.unionByName, numbered))
    name = every.select(*keys, "node", "parent", "number")
    reach = (sym.alias("n").join(_dealt(name, "p"), _on("n", "p", keys, "src", "node")).select(*same, "n.src", "n.dst", "p.parent")
             .where("parent IS NULL OR dst <> parent").alias("n").join(_dealt(name, "p"), _on("n", "p", keys, "dst", "node"))
             .groupBy(*same, F.col("n.src").alias("node")).agg(F.min("p.number").alias("low"), F.max("p.number").alias("high")))
    own = written(every.alias("n").join(_dealt(reach, "p"), _on("n", "p", keys, "node", "node"), "left")
                  .select(*same, "n.node", F.least("n.number", "p.low").alias("low"), F.greatest("n.number", "p.high").alias("high")))
    reached: list[DataFrame] = []
    for level in reversed(levels):
        frame = level.alias("n").join(_dealt(own, "o"), _on("n", "o", keys, "node", "node"))
        low, high = F.col("o.low"), F.col("o.high")
        for deeper in reached[-1:]:
            more = _children(deeper, keys, F.min("low").alias("low"), F.max("high").alias("high"))
            frame = frame.join(_dealt(more, "p"), _on("n", "p", keys, "node", "node"), "left")
            low, high = F.least("o.low", "p.low"), F.greatest("o.high", "p.high")
        reached.append(written(frame.select(*same, "n.node", "n.parent", low.alias("low"), high.alias("high"))))
    # an edge of the graph outside the forest joins two subtrees, neither inside the other
    tree = every.where("parent IS NOT NULL").select(*keys, F.col("node").alias("a"), F.col("parent").alias("b"))
    tree = tree.unionByName(tree.select(*keys, F.col("b").alias("a"), F.col("a").alias("b")))
    across = (sym.where("src < dst").alias("n").join(_dealt(tree, "p"), _on("n", "p", keys, "src", "a") & (F.col("n.dst") == F.col("p.b")), "left_anti")
              .select(*same, "n.src", "n.dst"))
    beyond = (reduce(DataFrame.unionByName, reached).alias("n").join(_dealt(every.where("parent IS NOT NULL"), "p"), _on("n", "p", keys, "parent", "node"))
              .where((F.col("n.low") < F.col("p.number")) | (F.col("n.high") >= F.col("p.number") + F.col("p.size")))
              .select(*same, F.col("n.node").alias("src"), F.col("n.parent").alias("dst")))
    joined = connected(both_ways(across.unionByName(beyond), keys), keys)
    return written(every.where("parent IS NOT NULL").alias("n").join(_dealt(joined, "p"), _on("n", "p", keys, "node", "node"), "left")
                   .select(*same, "n.node", "n.parent", F.coalesce("p.component", "n.node").alias("block")))


def bridges(edges: DataFrame, keys: list[str], found: DataFrame | None = None) -> DataFrame:
    """Edges whose removal separates their ends: blocks of one edge."""
    found = blocks(edges, keys) if found is None else found
    single = found.groupBy(*keys, "block").agg(F.count(F.lit(1)).alias("n"), F.first("node").alias("a"), F.first("parent").alias("b")).where("n = 1")
    return single.select(*keys, F.least("a", "b").alias("src"), F.greatest("a", "b").alias("dst"))


def articulation_points(edges: DataFrame, keys: list[str], found: DataFrame | None = None) -> DataFrame:
    """Nodes whose removal separates others: members of several blocks."""
    found = blocks(edges, keys) if found is None else found
    members = found.select(*keys, "block", F.explode(F.array("node", "parent")).alias("node")).distinct()
    return members.groupBy(*keys, "node").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(*keys, "node")


def greedy_modularity(edges: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Communities by joining, again and again, the pair of communities
    whose union raises modularity most, until every union would lower it.
    Returns memberships ``(keys, node, community)``, communities named by their
    smallest node, and the steps ``(keys, step, src, dst, gain)``. Gains are
    kept as 2 m L - d1 d2 (m edges, L of them between the two, d the sums of
    degrees), a whole number in proportion to the gain, so equal gains are
    equal; of those the pair of smallest names goes first. A round makes one
    union in every graph; it reads the pairs that are left, never the edges."""
    sym = both_ways(edges, keys)
    m = sym.groupBy(*keys).agg((F.count(F.lit(1)) / 2).cast("long").alias("m"))
    same = [F.col(f"n.{k}").alias(k) for k in keys]
    each = lambda a, b: reduce(lambda x, y: x & y, [F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}")) for k in keys], F.lit(True))
    total = written(sym.groupBy(*keys, F.col("src").alias("node")).agg(F.count(F.lit(1)).alias("degree")))
    member = written(total.select(*keys, "node", F.col("node").alias("community")))
    pairs = written(sym.where("src < dst").withColumn("links", F.lit(1).cast("long")))
    steps, step = [], 0
    while True:
        gain = (pairs.alias("n").join(total.alias("a"), _on("n", "a", keys, "src", "node")).join(total.alias("b"), _on("n", "b", keys, "dst", "node"))
                .join(m.alias("m"), each("n", "m"))
                .select(*same, "n.src", "n.dst", "m.m", (2 * F.col("m.m") * F.col("n.links") - F.col("a.degree") * F.col("b.degree")).alias("gain")))
        # the greatest gain, then the smallest names
        top = gain.groupBy(*keys).agg(F.max("gain").alias("top")).where("top >= 0")
        best = (gain.alias("n").join(top.alias("t"), each("n", "t") & (F.col("n.gain") == F.col("t.top")))
                .groupBy(*same, "n.m").agg(F.min(F.struct("n.src", "n.dst")).alias("p"), F.first("t.top").alias("gain")))
        best = written(best.select(*keys, "p.src", "p.dst", (F.col("gain") / (2.0 * F.col("m") * F.col("m"))).alias("gain")))
        if best.isEmpty():
            break
        steps.append(best.select(*keys, F.lit(step).alias("step"), "src", "dst", "gain"))
        step += 1

        def renamed(frame: DataFrame, col: str) -> DataFrame:
            rest = [c for c in frame.columns if c not in (*keys, col)]
            return (frame.alias("n").join(best.alias("p"), _on("n", "p", keys, col, "dst"), "left")
                    .select(*same, F.coalesce("p.src", f"n.{col}").alias(col), *[f"n.{c}" for c in rest]))
        member = written(renamed(member, "community"))
        total = written(renamed(total, "node").groupBy(*keys, "node").agg(F.sum("degree").alias("degree")))
        pairs = renamed(renamed(pairs, "src"), "dst").where("src <> dst")
        pairs = written(pairs.groupBy(*keys, F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst")).agg(F.sum("links").alias("links")))
    if not steps:
        steps = [pairs.limit(0).select(*keys, F.lit(0).alias("step"), "src", "dst", F.lit(0.0).alias("gain"))]
    return member.select(*keys, "node", "community"), reduce(DataFrame.unionByName, steps)


def modularity(edges: DataFrame, keys: list[str], member: DataFrame) -> DataFrame:
    """``(keys, modularity)``: share of edges inside communities less what the degrees alone would give."""
    sym = both_ways(edges, keys)
    named = (sym.alias("n").join(member.alias("a"), _on("n", "a", keys, "src", "node")).join(member.alias("b"), _on("n", "b", keys, "dst", "node"))
             .select(*[F.col(f"n.{k}").alias(k) for k in keys], F.col("a.community").alias("community"), (F.col("a.community") == F.col("b.community")).alias("inside")))
    each = named.groupBy(*keys, "community").agg(F.count(F.lit(1)).alias("degree"), F.sum(F.col("inside").cast("long")).alias("inside"))
    return each.groupBy(*keys).agg((F.sum("inside") / F.sum("degree")
                                    - F.sum(F.col("degree") * F.col("degree")) / (F.sum("degree") * F.sum("degree"))).alias("modularity"))
