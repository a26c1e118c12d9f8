"""Path (GEO) and assignment (ASSIGN) queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions.text import round_doubles
from quarry.operators import spatial as SP
from quarry.plans.catalog import register
from quarry.session import table
from quarry.sources import geo as GE

PLACES_SQL = """
places AS (SELECT n.n_nationkey AS key, n.n_name || ', ' || r.r_name AS place, r.r_name AS state,
                  -20.0::DOUBLE + n.n_regionkey * 10.0::DOUBLE AS lat, -80.0::DOUBLE + n.n_regionkey * 40.0::DOUBLE AS lon,
                  ['red', 'blue', 'green'][n.n_nationkey % 3 + 1] AS colour
           FROM nation n JOIN region r ON r.r_regionkey = n.n_regionkey),
adj AS (SELECT DISTINCT a.place, b.place AS neighbor FROM places a JOIN places b
        ON (a.state = b.state OR abs(a.key - b.key) = 1) WHERE a.place <> b.place)"""


def hav(l1, o1, l2, o2):
    return (f"2 * {SP.EARTH_KM}::DOUBLE * asin(sqrt(pow(sin((radians({l2}) - radians({l1})) / 2), 2) + "
            f"cos(radians({l1})) * cos(radians({l2})) * pow(sin((radians({o2}) - radians({o1})) / 2), 2)))")


COSTS_SQL = PLACES_SQL + f""",
costs AS (SELECT a.place, a.neighbor, CASE WHEN pa.state = pb.state THEN 0.0 ELSE {hav('pa.lat', 'pa.lon', 'pb.lat', 'pb.lon')} END AS cost
          FROM adj a JOIN places pa ON pa.place = a.place JOIN places pb ON pb.place = a.neighbor)"""

GOALS = ", ".join(str(k) for k in GE.GOAL_KEYS)
STARTS = ", ".join(str(k) for k in GE.START_KEYS)


def _geo(spark, sf):
    p = GE.places(spark, sf)
    return p, GE.adjacency(spark, sf)


@register("adjacency", f"WITH {PLACES_SQL} SELECT place, neighbor FROM adj")
def adjacency(spark, sf):
    """SP1 + S12 shape: adjacency without self loops."""
    return GE.adjacency(spark, sf)


@register("place_parts", f"""WITH {PLACES_SQL}
SELECT DISTINCT trim(split_part(place, ',', 1)) AS county, trim(split_part(place, ',', -1)) AS state,
       trim(regexp_replace(colour || ': ' || place, '^(red|blue|green)[: ]+', '')) AS plain FROM places""")
def place_parts(spark, sf):
    """T23 + L6: split place ids, strip colour prefixes, distinct values."""
    p = GE.places(spark, sf)
    county, state = GE.split_place("place")
    return p.select(county.alias("county"), state.alias("state"),
                    GE.strip_colour(F.concat_ws(": ", "colour", "place")).alias("plain")).distinct()


@register("edge_costs", f"WITH {COSTS_SQL} SELECT place, neighbor, round(cost, 6) AS cost FROM costs")
def edge_costs(spark, sf):
    """SP2 + T22: edge costs from state coordinates (0 within a state)."""
    p, a = _geo(spark, sf)
    return round_doubles(SP.edge_costs(a, p))


@register("nearest_goal", f"""WITH {PLACES_SQL},
g AS (SELECT place AS goal, lat AS gl, lon AS go FROM places WHERE key IN ({GOALS})),
d AS (SELECT p.place, g.goal, {hav('p.lat', 'p.lon', 'g.gl', 'g.go')} AS h FROM places p, g)
SELECT place, round(min(h), 6) AS h, arg_min(goal, (h, goal)) AS nearest_goal FROM d GROUP BY place""")
def nearest_goal(spark, sf):
    """SP3: distance to the nearest goal."""
    p = GE.places(spark, sf)
    return round_doubles(SP.nearest_goal(p, p.filter(F.col("key").isin(GE.GOAL_KEYS))))


def _point(k: str) -> tuple[str, str]:
    """Coordinates of a customer or supplier: a rule of its key."""
    return f"({k} * 37 % 1801) / 10.0 - 90", f"({k} * 101 % 3600) / 10.0 - 180"


@register("nearest_supplier", f"""WITH c AS (SELECT c_name AS place, {_point('c_custkey')[0]} AS lat, {_point('c_custkey')[1]} AS lon FROM customer),
s AS (SELECT s_name AS goal, {_point('s_suppkey')[0]} AS gl, {_point('s_suppkey')[1]} AS go FROM supplier),
d AS (SELECT place, goal, {hav('lat', 'lon', 'gl', 'go')} AS h FROM c, s)
SELECT place, round(min(h), 6) AS h, arg_min(goal, (h, goal)) AS nearest_goal FROM d GROUP BY place""")
def nearest_supplier(spark, sf):
    """SP3 where places and goals both grow: every customer's nearest supplier."""
    def points(name, key, label):
        lat, lon = _point(key)
        return table(spark, sf, name).select(F.col(label).alias("place"), F.expr(lat).cast("double").alias("lat"), F.expr(lon).cast("double").alias("lon"))
    return round_doubles(SP.nearest_goal(points("customer", "c_custkey", "c_name"), points("supplier", "s_suppkey", "s_name")))


@register("neighbour_weights", f"""WITH {COSTS_SQL},
g AS (SELECT place AS goal, lat AS gl, lon AS go FROM places WHERE key IN ({GOALS})),
hh AS (SELECT p.place, min({hav('p.lat', 'p.lon', 'g.gl', 'g.go')}) AS h FROM places p, g GROUP BY p.place),
j AS (SELECT c.place, c.neighbor, hn.h AS hn, hp.h AS hp, CASE WHEN c.neighbor IN (SELECT goal FROM g) THEN 1 ELSE 0 END AS ng
      FROM costs c JOIN hh hn ON hn.place = c.neighbor JOIN hh hp ON hp.place = c.place)
SELECT place, neighbor, round(CASE WHEN max(ng) OVER (PARTITION BY place) = 1 THEN CAST(ng AS DOUBLE)
       ELSE exp(-(hn - hp) / 100.0) / sum(exp(-(hn - hp) / 100.0)) OVER (PARTITION BY place) END, 6) AS probability FROM j""")
def neighbour_weights(spark, sf):
    """SP7: softmax-like neighbour weights at temperature 100."""
    p, a = _geo(spark, sf)
    c = SP.edge_costs(a, p)
    goals = p.filter(F.col("key").isin(GE.GOAL_KEYS))
    return round_doubles(SP.neighbour_weights(c, SP.nearest_goal(p, goals), goals, 100.0))


def _paths(spark, sf):
    p, a = _geo(spark, sf)
    c = SP.edge_costs(a, p)
    starts = p.filter(F.col("key").isin(GE.START_KEYS))
    goals = p.filter(F.col("key").isin(GE.GOAL_KEYS))
    return p, c, starts, goals


HEURISTIC_SQL = f"""
g AS (SELECT place AS goal, lat AS gl, lon AS go FROM places WHERE key IN ({GOALS})),
hh AS (SELECT p.place, min({hav('p.lat', 'p.lon', 'g.gl', 'g.go')}) AS h FROM places p, g GROUP BY p.place),
near AS (SELECT c.place, c.neighbor, c.cost, hh.h, row_number() OVER (PARTITION BY c.place ORDER BY hh.h, c.neighbor) AS r
         FROM costs c JOIN hh ON hh.place = c.neighbor)"""


def _paths_ctes(edges="costs"):
    """``sp``: least-cost paths over ``edges``; ``st``, ``gl``, ``best``: starts,
    goals and each start's best path to a goal of its colour."""
    return f"""sp AS (WITH RECURSIVE r(start, node, cost, hops, path) USING KEY (start, node) AS (
    SELECT place, place, 0.0::DOUBLE, 0, [place] FROM places WHERE key IN ({STARTS})
    UNION
    (SELECT start, node, b.cost, b.hops, b.path FROM (
        SELECT f.start, c.neighbor AS node,
               arg_min({{'cost': f.cost + c.cost, 'hops': f.hops + 1, 'path': list_append(f.path, c.neighbor)}},
                       (f.cost + c.cost, f.hops + 1, array_to_string(list_append(f.path, c.neighbor), '|'))) AS b
        FROM r f JOIN {edges} c ON c.place = f.node
        WHERE NOT list_contains(f.path, c.neighbor)
        GROUP BY f.start, c.neighbor) x
     WHERE NOT EXISTS (SELECT 1 FROM recurring.r q WHERE q.start = x.start AND q.node = x.node
                       AND (q.cost, q.hops, array_to_string(q.path, '|')) <= (x.b.cost, x.b.hops, array_to_string(x.b.path, '|')))))
  SELECT * FROM r),
st AS (SELECT place AS start, colour AS sc FROM places WHERE key IN ({STARTS})),
gl AS (SELECT place AS node, colour AS gc FROM places WHERE key IN ({GOALS})),
best AS (SELECT sp.start, arg_min({{'node': sp.node, 'cost': cost, 'hops': hops, 'path': path}}, (cost, hops, array_to_string(path, '|'))) AS b
         FROM sp JOIN gl ON gl.node = sp.node JOIN st ON st.start = sp.start WHERE gc = sc GROUP BY sp.start)"""


def _routes_sql(ctes):
    return f"""WITH {ctes}
SELECT st.start, b.node AS goal, round(b.cost, 6) AS cost, b.hops AS hops,
       coalesce(array_to_string(b.path, ' -> '), 'No path found.') AS route
FROM st LEFT JOIN best USING (start)"""


@register("nearest_goal_paths", lambda: _routes_sql(f"{COSTS_SQL}, {_paths_ctes()}"))
def nearest_goal_paths(spark, sf):
    """SP4: least-cost path from each start to the nearest same-colour goal."""
    p, c, starts, goals = _paths(spark, sf)
    paths = SP.shortest_paths(c, starts)
    return round_doubles(SP.path_to_nearest_goal(paths, starts, goals))


@register("beam_paths", lambda: _routes_sql(
    f"{COSTS_SQL}, {HEURISTIC_SQL}, three AS (SELECT place, neighbor, cost FROM near WHERE r <= 3), {_paths_ctes('three')}"))
def beam_paths(spark, sf):
    """SP5: beam search (k = 3 neighbours nearest a goal per expansion)."""
    p, c, starts, goals = _paths(spark, sf)
    paths = SP.shortest_paths(c, starts, beam=3, h=SP.nearest_goal(p, goals))
    return round_doubles(SP.path_to_nearest_goal(paths, starts, goals))


@register("greedy_paths", f"""WITH {COSTS_SQL}, {HEURISTIC_SQL},
walk AS (WITH RECURSIVE w(start, node, path) AS (
    SELECT place, place, [place] FROM places WHERE key IN ({STARTS})
    UNION ALL
    (SELECT w.start, arg_min(n.neighbor, (n.h, n.neighbor)), list_append(w.path, arg_min(n.neighbor, (n.h, n.neighbor)))
     FROM w JOIN near n ON n.place = w.node
     WHERE w.node NOT IN (SELECT goal FROM g) AND NOT list_contains(w.path, n.neighbor) GROUP BY w.start, w.path))
  SELECT * FROM w)
SELECT start, arg_max(node, len(path)) AS node, arg_max(node, len(path)) IN (SELECT goal FROM g) AS reached_goal,
       array_to_string(arg_max(path, len(path)), ' -> ') AS route FROM walk GROUP BY start""")
def greedy_paths(spark, sf):
    """SP6 (SP5 shares the kernel): greedy descent toward the nearest goal."""
    p, c, starts, goals = _paths(spark, sf)
    return SP.greedy_descent(c, SP.nearest_goal(p, goals), starts, goals)


@register("aligned_paths", lambda: f"""WITH {COSTS_SQL}, {_paths_ctes()},
longest AS (SELECT max(len(b.path)) AS n FROM best)
SELECT start, CAST(step AS INTEGER) AS step, b.path[least(step, len(b.path))] AS place
FROM (SELECT start, b, unnest(range(1, n + 1)) AS step FROM best, longest)""")
def aligned_paths(spark, sf):
    """SP8: step-aligned routes (last place repeated)."""
    p, c, starts, goals = _paths(spark, sf)
    paths = SP.shortest_paths(c, starts)
    best = SP.path_to_nearest_goal(paths, starts, goals).filter(F.col("goal").isNotNull())
    return SP.align_paths(best.select("start", F.split("route", " -> ").alias("path")))


ASSIGN_SQL = PLACES_SQL + """,
ed AS (SELECT pa.key AS i, pb.key AS j FROM adj a JOIN places pa ON pa.place = a.place JOIN places pb ON pb.place = a.neighbor),
dom(v) AS (VALUES (0), (1), (2)),
acost AS (SELECT i, j, a.v AS vi, b.v AS vj,
                 100 + (least(i, j) * 31 + greatest(i, j) * 17 + (CASE WHEN i < j THEN a.v ELSE b.v END) * 7
                        + (CASE WHEN i < j THEN b.v ELSE a.v END) * 3) % 100 AS cost
          FROM ed, dom a, dom b),
asg AS (SELECT key AS agent, key % 3 AS value FROM places),
lc AS (SELECT c.i AS agent, c.vi AS value, CAST(sum(c.cost) AS BIGINT) AS cost FROM acost c JOIN asg b ON b.agent = c.j AND b.value = c.vj GROUP BY ALL),
br AS (SELECT l.agent, a.value AS current, arg_min(l.value, (l.cost, CASE WHEN l.value <> a.value THEN 1 ELSE 0 END, l.value)) AS best_value,
              max(CASE WHEN l.value = a.value THEN l.cost END) AS current_cost, min(l.cost) AS best_cost
       FROM lc l JOIN asg a ON a.agent = l.agent GROUP BY l.agent, a.value)"""


def _assign(spark, sf):
    return GE.assignment_costs(spark, sf), GE.initial_values(spark, sf)


@register("assignment_cost", f"""WITH {ASSIGN_SQL}
SELECT CAST(sum(cost) AS BIGINT) AS global_cost FROM acost c JOIN asg a ON a.agent = c.i AND a.value = c.vi
JOIN asg b ON b.agent = c.j AND b.value = c.vj WHERE c.i < c.j""")
def assignment_cost(spark, sf):
    """C1 + J11: total assignment cost, each edge once."""
    c, a = _assign(spark, sf)
    return SP.global_cost(c, a)


@register("assignment_local_costs", f"WITH {ASSIGN_SQL} SELECT agent, value, cost FROM lc")
def assignment_local_costs(spark, sf):
    """Local cost per (agent, candidate value)."""
    c, a = _assign(spark, sf)
    return SP.local_costs(c, a)


@register("assignment_best_response", f"""WITH {ASSIGN_SQL}
SELECT agent, current, best_value, current_cost, best_cost, current_cost - best_cost AS gain FROM br""")
def assignment_best_response(spark, sf):
    """Best response and gain per agent."""
    c, a = _assign(spark, sf)
    return SP.best_response(c, a)


@register("assignment_winners", f"""WITH {ASSIGN_SQL},
g AS (SELECT agent, current_cost - best_cost AS gain, * EXCLUDE (agent) FROM br),
beaten AS (SELECT DISTINCT e.i AS agent FROM (SELECT DISTINCT i, j FROM acost) e JOIN g gi ON gi.agent = e.i JOIN g gj ON gj.agent = e.j
           WHERE gj.gain > gi.gain OR (gj.gain = gi.gain AND e.j < e.i))
SELECT agent, current, best_value, current_cost, best_cost, gain FROM g
WHERE gain > 0 AND agent NOT IN (SELECT agent FROM beaten)""")
def assignment_winners(spark, sf):
    """C4: neighbourhood winners."""
    c, a = _assign(spark, sf)
    return SP.winners(c, SP.best_response(c, a))

