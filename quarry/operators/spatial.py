"""Spatial paths and assignment costs (SP1-SP8, C1-C4, T22).

Path search is a frontier relaxation loop over DataFrames: every start runs
at once; each round joins the improved frontier with the edge list and keeps
the best (cost, hops, path) per (start, node) until nothing improves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.session import written

EARTH_KM = 6371.0088


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle distance (spherical stand-in for the ellipsoid)."""
    r = F.radians
    dlat, dlon = r(lat2) - r(lat1), r(lon2) - r(lon1)
    a = F.sin(dlat / 2) ** 2 + F.cos(r(lat1)) * F.cos(r(lat2)) * F.sin(dlon / 2) ** 2
    return F.lit(2 * EARTH_KM) * F.asin(F.sqrt(a))


def edge_costs(adj: DataFrame, places: DataFrame) -> DataFrame:
    """SP2: cost = distance between the two states' coordinates (0 within a
    state); coordinates joined from the place table."""
    pa = places.select(F.col("place"), F.col("state").alias("sa"), F.col("lat").alias("la"), F.col("lon").alias("oa"))
    pb = places.select(F.col("place").alias("neighbor"), F.col("state").alias("sb"), F.col("lat").alias("lb"),
                       F.col("lon").alias("ob"))
    j = adj.join(pa, "place").join(pb, "neighbor")
    cost = F.when(F.col("sa") == F.col("sb"), F.lit(0.0)).otherwise(haversine_km("la", "oa", "lb", "ob"))
    return j.select("place", "neighbor", cost.alias("cost"))


#: Goals in a cell of the finest grid, and the finest grid there is (2 ^ 20 cells along each axis).
GOALS_PER_CELL, DEEPEST = 16, 20


def _on_sphere(df: DataFrame) -> DataFrame:
    """Adds x, y, z: the point on the unit sphere."""
    lat, lon = F.radians("lat"), F.radians("lon")
    return df.withColumns({"x": F.cos(lat) * F.cos(lon), "y": F.cos(lat) * F.sin(lon), "z": F.sin(lat)})


def _cell(level: int, axis: str) -> Column:
    return F.least(F.floor((F.col(axis) + 1) / 2 * float(1 << level)), F.lit((1 << level) - 1)).cast("long")


def _key(shift: int) -> Column:
    """The cell that many levels above, as one number."""
    up = [F.shiftright(c, shift) for c in ("cx", "cy", "cz")]
    return F.shiftleft(up[0], 40).bitwiseOR(F.shiftleft(up[1], 20)).bitwiseOR(up[2])


def _square(*parts: Column) -> Column:
    return parts[0] * parts[0] + parts[1] * parts[1] + parts[2] * parts[2]


def nearest_goal(places: DataFrame, goals: DataFrame) -> DataFrame:
    """SP3: distance from every place to its nearest goal (ties: name); null
    where there is no goal or no coordinate.

    Goals lie in the cubes of a grid around the sphere. From the whole grid down,
    level by level, a place keeps the non-empty cubes that can hold its nearest
    goal: those that begin no further than one goal of some cube lies. At the
    finest level, where a cube has few goals, these are compared. All joins are
    on cubes; a place keeps a few of them whatever the number of goals."""
    g = goals.where("lat IS NOT NULL AND lon IS NOT NULL").groupBy("lat", "lon").agg(F.min("place").alias("goal"))
    g = written(_on_sphere(g))
    depth = 0
    while depth < DEEPEST:
        fullest = g.groupBy(*[_cell(depth, c).alias(f"c{c}") for c in "xyz"]).count().agg(F.max("count")).first()[0] or 0
        if fullest <= GOALS_PER_CELL:
            break
        depth += 1
    g = g.withColumns({f"c{c}": _cell(depth, c) for c in "xyz"})
    asked = places.select("place", "lat", "lon").distinct()
    near = _on_sphere(asked.where("lat IS NOT NULL AND lon IS NOT NULL")).withColumn("cell", F.lit(0).cast("long"))
    one = Window.partitionBy("place", "lat", "lon")
    for level in range(1, depth + 1):
        width, shift = 2.0 / (1 << level), depth - level
        cubes = g.groupBy(_key(shift + 1).alias("cell"), _key(shift).alias("inner"), *[F.shiftright(f"c{c}", shift).alias(f"i{c}") for c in "xyz"]).agg(
            F.min(F.struct("goal", F.col("x").alias("gx"), F.col("y").alias("gy"), F.col("z").alias("gz"))).alias("some"))
        both = near.join(cubes, "cell")
        low = {c: F.col(f"i{c}") * width - 1 for c in "xyz"}
        begins = _square(*[F.greatest(low[c] - F.col(c), F.col(c) - low[c] - width, F.lit(0.0)) for c in "xyz"])
        reaches = F.min(_square(*[F.col(c) - F.col(f"some.g{c}") for c in "xyz"])).over(one)
        both = both.withColumn("begins", begins).withColumn("reaches", reaches).where(F.col("begins") <= F.col("reaches") * (1 + 1e-9) + 1e-15)
        near = written(both.select("place", "lat", "lon", "x", "y", "z", F.col("inner").alias("cell")))
    ends = g.select(_key(0).alias("cell"), "goal", F.col("lat").alias("glat"), F.col("lon").alias("glon"))
    h = haversine_km(F.col("lat"), F.col("lon"), F.col("glat"), F.col("glon"))
    best = near.join(ends, "cell").groupBy("place", "lat", "lon").agg(F.min(F.struct(h.alias("h"), "goal")).alias("b"))
    return asked.join(best, ["place", "lat", "lon"], "left").select("place", F.col("b.h").alias("h"), F.col("b.goal").alias("nearest_goal"))


def shortest_paths(costs: DataFrame, starts: DataFrame,
                   beam: int | None = None, h: DataFrame | None = None) -> DataFrame:
    """SP4 kernel: least-cost paths from every start (independent sources,
    Q15 fixed) to every reachable node: (start, node, cost, hops, path).
    SP5: with ``beam`` = k and a heuristic ``h`` (place, h), a node only
    expands its k neighbours nearest a goal (ties: name)."""
    best = starts.select(F.col("place").alias("start"), F.col("place").alias("node"), F.lit(0.0).alias("cost"),
                         F.lit(0).alias("hops"), F.array(F.col("place")).alias("path"))
    frontier = best
    c2 = costs.select(F.col("place").alias("node"), "neighbor", F.col("cost").alias("cost_e"))
    if beam is not None:
        hh = h.select(F.col("place").alias("neighbor"), F.col("h").alias("hn"))
        wb = Window.partitionBy("node").orderBy("hn", "neighbor")
        c2 = c2.join(hh, "neighbor").withColumn("_r", F.row_number().over(wb)).filter(F.col("_r") <= beam) \
            .drop("_r", "hn")
    while True:
        cand = (frontier.join(c2, "node")
                .filter(~F.array_contains("path", F.col("neighbor")))
                .select("start", F.col("neighbor").alias("node"), (F.col("cost") + F.col("cost_e")).alias("cost"),
                        (F.col("hops") + 1).alias("hops"), F.array_append("path", F.col("neighbor")).alias("path")))
        key = F.struct("cost", "hops", F.array_join("path", "|"))
        cb = cand.groupBy("start", "node").agg(F.min_by(F.struct("cost", "hops", "path"), key).alias("b")) \
            .select("start", "node", "b.cost", "b.hops", "b.path")
        old = best.select("start", "node", F.struct("cost", "hops", F.array_join("path", "|")).alias("ok"))
        imp = (cb.join(old, ["start", "node"], "left")
               .filter(F.col("ok").isNull() | (F.struct("cost", "hops", F.array_join("path", "|")) < F.col("ok")))
               .drop("ok")).checkpoint(eager=True)
        if imp.isEmpty():
            break
        best = best.join(imp.select("start", "node"), ["start", "node"], "left_anti").unionByName(imp)
        best = best.checkpoint(eager=True)
        frontier = imp
    return best


def path_to_nearest_goal(paths: DataFrame, starts: DataFrame, goals: DataFrame) -> DataFrame:
    """SP4: per start, the cheapest path to a goal of the same colour, or
    'No path found.'"""
    g = goals.select(F.col("place").alias("node"), F.col("colour").alias("gc"))
    s = starts.select(F.col("place").alias("start"), F.col("colour").alias("sc"))
    j = paths.join(g, "node").join(s, "start").filter(F.col("gc") == F.col("sc"))
    key = F.struct("cost", "hops", F.array_join("path", "|"))
    b = j.groupBy("start").agg(F.min_by(F.struct("node", "cost", "hops", "path"), key).alias("b"))
    out = s.join(b, "start", "left")
    return out.select("start", F.col("b.node").alias("goal"), F.col("b.cost").alias("cost"), F.col("b.hops").alias("hops"),
                      F.coalesce(F.array_join("b.path", " -> "), F.lit("No path found.")).alias("route"))


def greedy_descent(costs: DataFrame, h: DataFrame, starts: DataFrame, goals: DataFrame) -> DataFrame:
    """SP6: from each start move to the unvisited neighbour nearest a goal
    (ties: name), until a goal or a dead end."""
    gs = goals.select(F.col("place").alias("node")).withColumn("is_goal", F.lit(True))
    cur = starts.select(F.col("place").alias("start"), F.col("place").alias("node"), F.array(F.col("place")).alias("path"))
    hh = h.select(F.col("place").alias("neighbor"), F.col("h").alias("hn"))
    while True:  # every step lengthens a path of distinct places, so it ends
        act = cur.join(gs, "node", "left").filter(F.col("is_goal").isNull()).drop("is_goal")
        step = (act.join(costs.select(F.col("place").alias("node"), "neighbor"), "node")
                .filter(~F.array_contains("path", F.col("neighbor"))).join(hh, "neighbor"))
        mv = step.groupBy("start").agg(F.min_by("neighbor", F.struct("hn", "neighbor")).alias("nxt")).checkpoint(eager=True)
        if mv.isEmpty():
            break
        cur = (cur.join(mv, "start", "left")
               .select("start", F.coalesce("nxt", "node").alias("node"),
                       F.when(F.col("nxt").isNotNull(), F.array_append("path", F.col("nxt"))).otherwise(F.col("path"))
                       .alias("path"))).checkpoint(eager=True)
    return cur.join(gs, "node", "left").select(
        "start", "node", F.coalesce("is_goal", F.lit(False)).alias("reached_goal"),
        F.array_join("path", " -> ").alias("route"))


def neighbour_weights(costs: DataFrame, h: DataFrame, goals: DataFrame, temperature: float = 100.0) -> DataFrame:
    """SP7: exp(-delta/T) weights of a node's neighbours (delta = neighbour's
    goal distance minus the node's), normalised per node; when a neighbour is
    a goal, it gets 1 and the others 0."""
    hn = h.select(F.col("place").alias("neighbor"), F.col("h").alias("hn"))
    hp = h.select("place", F.col("h").alias("hp"))
    g = goals.select(F.col("place").alias("neighbor")).withColumn("ng", F.lit(1))
    j = costs.select("place", "neighbor").join(hn, "neighbor").join(hp, "place").join(g, "neighbor", "left")
    w = Window.partitionBy("place")
    any_goal = F.max(F.coalesce("ng", F.lit(0))).over(w)
    raw = F.exp(-(F.col("hn") - F.col("hp")) / F.lit(temperature))
    prob = F.when(any_goal == 1, F.coalesce("ng", F.lit(0)).cast("double")).otherwise(raw / F.sum(raw).over(w))
    return j.select("place", "neighbor", prob.alias("probability"))


def align_paths(paths: DataFrame, id_col: str = "start", path_col: str = "path") -> DataFrame:
    """SP8: step-aligned paths; a shorter path repeats its last element."""
    mx = paths.agg(F.max(F.size(path_col))).first()[0] or 0
    steps = F.sequence(F.lit(1), F.lit(mx))
    return paths.select(id_col, F.explode(steps).alias("step"), path_col).select(
        id_col, "step", F.element_at(path_col, F.least(F.col("step"), F.size(path_col))).alias("place"))


# ---- assignment costs ------------------------------------------------------

def global_cost(costs: DataFrame, assign: DataFrame) -> DataFrame:
    """Total cost of an assignment, each unordered edge once."""
    a = assign.select(F.col("agent").alias("i"), F.col("value").alias("vi"))
    b = assign.select(F.col("agent").alias("j"), F.col("value").alias("vj"))
    return (costs.filter(F.col("i") < F.col("j")).join(a, ["i", "vi"]).join(b, ["j", "vj"])
            .agg(F.sum("cost").cast("long").alias("global_cost")))


def local_costs(costs: DataFrame, assign: DataFrame) -> DataFrame:
    """Cost of each candidate value of each agent given its neighbours'
    current values."""
    b = assign.select(F.col("agent").alias("j"), F.col("value").alias("vj"))
    return (costs.join(b, ["j", "vj"]).groupBy(F.col("i").alias("agent"), F.col("vi").alias("value"))
            .agg(F.sum("cost").cast("long").alias("cost")))


def best_response(costs: DataFrame, assign: DataFrame) -> DataFrame:
    """Best value per agent (current value wins ties, then smaller
    value) and the gain over the current value."""
    lc = local_costs(costs, assign).join(assign.withColumnRenamed("value", "cur"), "agent")
    best = lc.groupBy("agent", "cur").agg(
        F.min_by(F.struct("value", "cost"), F.struct("cost", (F.col("value") != F.col("cur")).cast("int"), "value")).alias("b"),
        F.max(F.when(F.col("value") == F.col("cur"), F.col("cost"))).alias("cur_cost"))
    return best.select("agent", F.col("cur").alias("current"), F.col("b.value").alias("best_value"),
                       F.col("cur_cost").alias("current_cost"), F.col("b.cost").alias("best_cost"),
                       (F.col("cur_cost") - F.col("b.cost")).alias("gain"))


def winners(costs: DataFrame, br: DataFrame) -> DataFrame:
    """C4: agents with gain > 0 that no neighbour beats (larger gain, or an
    equal gain and a lower id)."""
    edges = costs.select("i", "j").distinct()
    gi = br.select(F.col("agent").alias("i"), F.col("gain").alias("gi"))
    gj = br.select(F.col("agent").alias("j"), F.col("gain").alias("gj"))
    beaten = (edges.join(gi, "i").join(gj, "j")
              .filter((F.col("gj") > F.col("gi")) | ((F.col("gj") == F.col("gi")) & (F.col("j") < F.col("i"))))
              .select(F.col("i").alias("agent")).distinct())
    return br.filter(F.col("gain") > 0).join(beaten, "agent", "left_anti")

