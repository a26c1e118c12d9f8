"""Graph analytics as iterative DataFrame jobs.

Graphs are edge DataFrames ``(keys..., src, dst)`` holding many small
graphs side by side (one per ``keys`` value, e.g. per period); every loop
runs all of them at once. Loops stop on an emptiness / no-change test and
cut lineage with a reliable ``checkpoint()`` into ``spark.checkpoint.dir``.

BFS from every source is O(V*E); for very large graphs pass ``sources`` to
restrict the start set (the co-mention graphs here are bounded by the entity
dictionary).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.operators import structure
from quarry.operators.structure import articulation_points, bridges  # noqa: F401 - G15, G16

CKPT_EVERY = 4


def _ckpt(df: DataFrame, i: int) -> DataFrame:
    return df.checkpoint(eager=True) if i % CKPT_EVERY == CKPT_EVERY - 1 else df


def symmetric(edges: DataFrame, keys: list[str]) -> DataFrame:
    """Both directions of each undirected edge, self loops removed;
    materialised once (reliable checkpoint) so loops do not re-run the
    upstream plan every iteration."""
    e = edges.select(*keys, "src", "dst").filter(F.col("src") != F.col("dst"))
    s = e.unionByName(e.select(*keys, F.col("dst").alias("src"), F.col("src").alias("dst"))).distinct()
    return s.checkpoint(eager=True)


def nodes(sym: DataFrame, keys: list[str]) -> DataFrame:
    return sym.select(*keys, F.col("src").alias("node")).distinct()


def bfs_all_pairs(edges: DataFrame, keys: list[str], sources: DataFrame | None = None) -> DataFrame:
    """Level-synchronous BFS from every source: ``(keys, s, v, d,
    sigma)`` with sigma the number of shortest paths. Visited pairs are
    removed with an anti-join each level."""
    sym = symmetric(edges, keys)
    start = sources if sources is not None else nodes(sym, keys)
    frontier = start.select(*keys, F.col("node").alias("s"), F.col("node").alias("v"),
                            F.lit(0).alias("d"), F.lit(1).cast("long").alias("sigma"))
    visited = frontier
    level = 0
    while True:
        level += 1
        nxt = (frontier.join(sym.withColumnRenamed("src", "v"), keys + ["v"])
               .groupBy(*keys, "s", F.col("dst").alias("v"))
               .agg(F.sum("sigma").alias("sigma"))
               .join(visited.select(*keys, "s", "v"), keys + ["s", "v"], "left_anti")
               .select(*keys, "s", "v", F.lit(level).alias("d"), "sigma"))
        nxt = nxt.checkpoint(eager=True)
        if nxt.isEmpty():
            break
        visited = _ckpt(visited.unionByName(nxt), level)
        frontier = nxt
    return visited


def components(edges: DataFrame, keys: list[str]) -> DataFrame:
    """``(keys, node, component)``, component = smallest node name; see
    :func:`quarry.operators.structure.connected`."""
    return structure.connected(structure.both_ways(edges, keys), keys)


def path_metrics(edges: DataFrame, keys: list[str], apsp: DataFrame | None = None) -> DataFrame:
    """Connectivity, component count, diameter (largest
    eccentricity inside components, Q8 fixed) and average shortest path
    length (infinity when disconnected)."""
    apsp = apsp if apsp is not None else bfs_all_pairs(edges, keys)
    n = apsp.groupBy(*keys).agg(F.countDistinct("s").alias("n_nodes"))
    reach = apsp.groupBy(*keys, "s").agg(F.count("*").alias("r"), F.min("v").alias("comp"))
    conn = reach.groupBy(*keys).agg(F.min("r").alias("min_r"), F.countDistinct("comp").alias("n_components"))
    pairs = apsp.filter(F.col("s") != F.col("v")).groupBy(*keys).agg(
        F.max("d").alias("diameter"), F.avg("d").alias("_avg"))
    g = n.join(conn, keys).join(pairs, keys, "left")
    connected = F.col("min_r") == F.col("n_nodes")
    return g.select(*keys, "n_nodes", connected.alias("is_connected"), "n_components",
                    F.coalesce("diameter", F.lit(0)).alias("diameter"),
                    F.when(connected, F.coalesce("_avg", F.lit(0.0))).otherwise(F.lit(float("inf")))
                    .alias("avg_shortest_path"))


def closeness(apsp: DataFrame, keys: list[str]) -> DataFrame:
    """((r-1)/sum d) * ((r-1)/(V-1)), r = reachable incl. self."""
    n = apsp.groupBy(*keys).agg(F.countDistinct("s").alias("V"))
    c = apsp.groupBy(*keys, F.col("v").alias("node")).agg(F.count("*").alias("r"), F.sum("d").alias("tot"))
    j = c.join(n, keys)
    val = F.when((F.col("tot") > 0) & (F.col("V") > 1),
                 ((F.col("r") - 1) / F.col("tot")) * ((F.col("r") - 1) / (F.col("V") - 1))).otherwise(F.lit(0.0))
    return j.select(*keys, "node", val.alias("closeness"))


def _dependencies(edges: DataFrame, keys: list[str], apsp: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Brandes backward accumulation, one level per step (deepest first).
    Returns (node dependencies (keys, s, v, delta), edge credits
    (keys, s, a, b, c))."""
    sym = symmetric(edges, keys)
    maxd = apsp.agg(F.max("d")).first()[0] or 0
    p = apsp.select(*keys, "s", "v", "d", "sigma")
    cur = p.filter(F.col("d") == maxd).select(*keys, "s", F.col("v").alias("w"), "sigma", F.lit(0.0).alias("delta"))
    deltas, credits = [cur.select(*keys, "s", F.col("w").alias("v"), "delta")], []
    for lvl in range(maxd - 1, -1, -1):
        prev = p.filter(F.col("d") == lvl).select(*keys, "s", "v", F.col("sigma").alias("sv"))
        link = (cur.join(sym.select(*keys, F.col("src").alias("w"), F.col("dst").alias("v")), keys + ["w"])
                .join(prev, keys + ["s", "v"])
                .select(*keys, "s", "v", "w", (F.col("sv") / F.col("sigma") * (1.0 + F.col("delta"))).alias("c")))
        link = link.checkpoint(eager=True)
        credits.append(link)
        acc = link.groupBy(*keys, "s", "v").agg(F.sum("c").alias("delta"))
        cur = (prev.join(acc, keys + ["s", "v"], "left")
               .select(*keys, "s", F.col("v").alias("w"), F.col("sv").alias("sigma"),
                       F.coalesce("delta", F.lit(0.0)).alias("delta")))
        deltas.append(cur.select(*keys, "s", F.col("w").alias("v"), "delta"))
    dep = deltas[0]
    for d in deltas[1:]:
        dep = dep.unionByName(d)
    cr = credits[0] if credits else None
    for c in credits[1:]:
        cr = cr.unionByName(c)
    return dep, cr


def betweenness(edges: DataFrame, keys: list[str], apsp: DataFrame | None = None) -> DataFrame:
    """Normalised betweenness, sum_s delta_s(v) / ((V-1)(V-2))."""
    apsp = apsp if apsp is not None else bfs_all_pairs(edges, keys)
    dep, _ = _dependencies(edges, keys, apsp)
    n = apsp.groupBy(*keys).agg(F.countDistinct("s").alias("V"))
    b = dep.filter(F.col("s") != F.col("v")).groupBy(*keys, F.col("v").alias("node")).agg(F.sum("delta").alias("raw"))
    allv = apsp.select(*keys, F.col("s").alias("node")).distinct()
    j = allv.join(b, keys + ["node"], "left").join(n, keys)
    scale = F.when(F.col("V") > 2, F.lit(1.0) / ((F.col("V") - 1) * (F.col("V") - 2))).otherwise(F.lit(0.0))
    return j.select(*keys, "node", (F.coalesce("raw", F.lit(0.0)) * scale).alias("betweenness"))


def edge_betweenness(edges: DataFrame, keys: list[str], apsp: DataFrame | None = None) -> DataFrame:
    """Edge credits summed over sources (both directions), for G17."""
    apsp = apsp if apsp is not None else bfs_all_pairs(edges, keys)
    _, cr = _dependencies(edges, keys, apsp)
    if cr is None:
        return edges.select(*keys, "src", "dst", F.lit(0.0).alias("eb"))
    a, b = F.least("v", "w"), F.greatest("v", "w")
    return cr.groupBy(*keys, a.alias("src"), b.alias("dst")).agg(F.sum("c").alias("eb"))


def clustering(edges: DataFrame, keys: list[str]) -> DataFrame:
    """Local clustering 2T/(d(d-1)) (0 for degree < 2) and its average.
    Triangles are listed on degree-ordered edges (each node only pairs its
    higher-ranked neighbours), so hubs do not emit all neighbour pairs."""
    sym = symmetric(edges, keys)
    deg = sym.groupBy(*keys, F.col("src").alias("node")).agg(F.count("*").alias("deg"))
    s = (sym.join(deg.withColumnRenamed("node", "src").withColumnRenamed("deg", "ds"), keys + ["src"])
         .join(deg.withColumnRenamed("node", "dst").withColumnRenamed("deg", "dd"), keys + ["dst"]))
    fwd = s.filter(F.struct("ds", "src") < F.struct("dd", "dst")).select(*keys, "src", "dst")
    w = (fwd.alias("x").join(fwd.alias("y"), [F.col(f"x.{k}") == F.col(f"y.{k}") for k in keys]
                             + [F.col("x.src") == F.col("y.src"), F.col("x.dst") < F.col("y.dst")])
         .select(*[F.col(f"x.{k}").alias(k) for k in keys], F.col("x.src").alias("a"),
                 F.col("x.dst").alias("b"), F.col("y.dst").alias("c")))
    tri = w.join(sym.select(*keys, F.col("src").alias("b"), F.col("dst").alias("c")), keys + ["b", "c"], "left_semi")
    per = (tri.select(*keys, F.explode(F.array("a", "b", "c")).alias("node"))
           .groupBy(*keys, "node").agg(F.count("*").alias("t")))
    j = deg.join(per, keys + ["node"], "left")
    cc = F.when(F.col("deg") >= 2, 2.0 * F.coalesce("t", F.lit(0)) / (F.col("deg") * (F.col("deg") - 1))).otherwise(F.lit(0.0))
    return j.select(*keys, "node", "deg", F.coalesce("t", F.lit(0)).alias("triangles"), cc.alias("clustering"))


def girvan_newman_split(edges: DataFrame, keys: list[str]) -> DataFrame:
    """G17 + G19: remove the highest edge-betweenness edge (ties: smallest
    (src, dst)) until the component count rises; returns memberships
    (keys, node, community). One BFS per round serves both the component
    count and the edge betweenness."""
    cur = edges.select(*keys, "src", "dst").checkpoint(eager=True)
    allnodes = nodes(symmetric(cur, keys), keys)

    def comps(ap):
        c = ap.groupBy(*keys, F.col("s").alias("node")).agg(F.min("v").alias("component"))
        return allnodes.join(c, keys + ["node"], "left").select(
            *keys, "node", F.coalesce("component", "node").alias("component"))

    ap = bfs_all_pairs(cur, keys)
    base = comps(ap).groupBy(*keys).agg(F.countDistinct("component").alias("c0")).checkpoint(eager=True)
    done = None
    while True:  # every round removes an edge, so it ends
        eb = edge_betweenness(cur, keys, ap)
        w = Window.partitionBy(*keys).orderBy(F.col("eb").desc(), "src", "dst")
        drop = eb.withColumn("r", F.row_number().over(w)).filter("r = 1").select(*keys, "src", "dst")
        a, b = F.least("src", "dst"), F.greatest("src", "dst")
        cur = (cur.withColumn("_a", a).withColumn("_b", b)
               .join(drop.select(*keys, F.col("src").alias("_a"), F.col("dst").alias("_b")), keys + ["_a", "_b"], "left_anti")
               .drop("_a", "_b")).checkpoint(eager=True)
        ap = bfs_all_pairs(cur, keys) if not cur.isEmpty() else None
        comp = comps(ap) if ap is not None else allnodes.withColumn("component", F.col("node"))
        cnt = comp.groupBy(*keys).agg(F.countDistinct("component").alias("c1")).join(base, keys)
        split = cnt.filter(F.col("c1") > F.col("c0")).select(*keys).checkpoint(eager=True)
        fin = comp.join(split, keys, "left_semi")
        done = fin if done is None else done.unionByName(fin)
        done = done.checkpoint(eager=True)
        base = base.join(split, keys, "left_anti").checkpoint(eager=True)
        cur = cur.join(split, keys, "left_anti").checkpoint(eager=True)
        if base.isEmpty() or cur.isEmpty():
            break
        ap = ap.join(split, keys, "left_anti")
    return done.withColumnRenamed("component", "community")
