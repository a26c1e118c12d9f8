"""Co-mention graph queries (UNITS binding) and graph analytics."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry import params
from quarry.operators import mentions as M
from quarry.plans import sql as Q
from quarry.plans.catalog import register
from quarry.sources import bindings as B


def _edges(spark, sf):
    return M.edges(B.units(spark, sf))


@register("mentions", lambda: f"""WITH {Q.mention_ctes()}
SELECT period, unit_id, entity, score, sentiment FROM mrows""")
def mentions(spark, sf):
    """(unit, entity) mentions by case-insensitive substring."""
    return M.mention_rows(B.units(spark, sf)).select("period", "unit_id", "entity", "score", "sentiment")


@register("edges", lambda: f"""WITH {Q.mention_ctes()}
SELECT period, src, dst, weight, num_mentions, average_sentiment FROM edges""")
def edges(spark, sf):
    """J3 + G1: weighted co-mention edges per period."""
    return _edges(spark, sf)


@register("edge_sentiment", lambda: f"""WITH {Q.mention_ctes()}
SELECT period, src AS node_1, dst AS node_2, round_even(average_sentiment, 3) AS average_sentiment,
       CASE WHEN average_sentiment < {params.EDGE_THRESHOLDS[0]} THEN 'Negative'
            WHEN average_sentiment > {params.EDGE_THRESHOLDS[1]} THEN 'Positive' ELSE 'Neutral' END AS relation_type,
       num_mentions, weight AS total_weight
FROM edges""")
def edge_sentiment(spark, sf):
    """G3 + L2 (flagship): edge sentiment table sorted by |mean| desc."""
    return M.edge_sentiment(_edges(spark, sf))


@register("edge_widths", lambda: f"""WITH {Q.mention_ctes()},
mm AS (SELECT period, min(weight) AS mn, max(weight) AS mx FROM edges GROUP BY period)
SELECT e.period, src, dst, weight, num_mentions, average_sentiment,
       CASE WHEN mx <> mn THEN 0.5 + (weight - mn) / (mx - mn) * 9.5 ELSE 5.25 END AS normalized_weight
FROM edges e JOIN mm USING (period)""")
def edge_widths(spark, sf):
    """Min-max normalised edge widths."""
    return M.edge_widths(_edges(spark, sf))


@register("node_sentiment", lambda: f"""WITH {Q.mention_ctes()}
SELECT period, entity, avg_sentiment, mentions FROM nsent""")
def node_sentiment(spark, sf):
    """Mean sentiment and mention count per entity."""
    return M.node_sentiment(B.units(spark, sf))


@register("company_mentions", lambda: f"""WITH {Q.units_ctes()},
cm AS (SELECT period, unnest({Q.mentions_list('text', [(c, [c.lower()]) for c in params.COMPANIES])}) AS entity FROM units)
SELECT period, entity, CAST(count(*) AS BIGINT) AS mentions FROM cm GROUP BY ALL""")
def company_mentions(spark, sf):
    """A10: comparison-company mention counter."""
    return M.company_mentions(B.units(spark, sf))


@register("neighbourhood", lambda: f"""WITH {Q.mention_ctes()}
SELECT node, neighbor, period, weight, average_sentiment FROM sym""")
def neighbourhood(spark, sf):
    """Symmetric neighbour listing."""
    return M.neighbourhood(_edges(spark, sf))


@register("graph_overview", lambda: f"""WITH {Q.mention_ctes()},
v AS (SELECT period, CAST(count(*) AS BIGINT) AS nodes FROM deg GROUP BY period),
m AS (SELECT period, CAST(count(*) AS BIGINT) AS edges FROM edges GROUP BY period)
SELECT period, nodes, edges,
       CASE WHEN nodes > 1 THEN 2.0::DOUBLE * edges / (nodes * (nodes - 1)) ELSE 0.0 END AS density,
       CASE WHEN nodes > 0 THEN 2.0::DOUBLE * edges / nodes ELSE 0.0 END AS average_degree
FROM v JOIN m USING (period)""")
def graph_overview(spark, sf):
    """node/edge counts, density, average degree."""
    return M.graph_overview(_edges(spark, sf))


@register("degree_centrality", lambda: f"""WITH {Q.mention_ctes()}
SELECT period, node, degree,
       CASE WHEN count(*) OVER (PARTITION BY period) > 1
            THEN degree / (count(*) OVER (PARTITION BY period) - 1) ELSE 0.0 END AS degree_centrality
FROM deg""")
def degree_centrality(spark, sf):
    """Degree centrality."""
    return M.degree_centrality(_edges(spark, sf))


@register("top_degree_nodes", lambda: f"""WITH {Q.mention_ctes()},
dc AS (SELECT period, node, CAST(degree AS DOUBLE) AS value FROM deg),
r AS (SELECT period, node, 'degree' AS metric, value,
             row_number() OVER (PARTITION BY period ORDER BY value DESC, node) AS rank FROM dc)
SELECT * FROM r WHERE rank <= 3""")
def top_degree_nodes(spark, sf):
    """Top-3 nodes per centrality metric (degree)."""
    return M.top_n_per_metric(M.degrees(_edges(spark, sf)), ["degree"], 3)


@register("average_node_sentiment", lambda: f"""WITH {Q.mention_ctes()}
SELECT period, round(coalesce(avg(avg_sentiment), 0.0), 9) AS avg_node_sentiment FROM nsent GROUP BY period""")
def average_node_sentiment(spark, sf):
    """Graph average node sentiment."""
    return M.average_node_sentiment(M.node_sentiment(B.units(spark, sf)))


_P1, _P2 = params.ENTITY_ALIASES[0][0], params.ENTITY_ALIASES[1][0]


def _co_sql():
    al = dict(params.ENTITY_ALIASES)
    conds = []
    for p in (_P1, _P2):
        toks = [p.lower()] + [a.lower() for a in al[p]]
        conds.append("(" + " OR ".join(f"contains(lower(text), {Q.S(t)})" for t in toks) + ")")
    return f"""WITH {Q.units_ctes()}
SELECT kind AS type, text, period, created_utc, score, author, unit_id FROM units WHERE {' AND '.join(conds)}"""


@register("co_mentions", _co_sql)
def co_mentions(spark, sf):
    """P20: texts naming two given entities (aliases with spaces kept)."""
    return M.co_mentions(B.units(spark, sf), _P1, _P2)


# ---- iterative graph analytics on the per-period co-mention graph --------

from quarry.functions.text import round_doubles  # noqa: E402
from quarry.operators import graph as G  # noqa: E402
from quarry.operators import structure as ST  # noqa: E402
from quarry.sources import graphs as GR  # noqa: E402

K = ["period"]


def _g_sql(body: str) -> str:
    return f"""WITH {Q.mention_ctes()}, {Q.bfs_ctes()} {body}"""


@register("graph_distances", lambda: _g_sql("SELECT g AS period, s, v, d, sigma FROM apsp"))
def graph_distances(spark, sf):
    """All-pairs hop distances and shortest-path counts (BFS loop)."""
    return G.bfs_all_pairs(_edges(spark, sf), K).select("period", "s", "v", "d", "sigma")


@register("graph_paths", lambda: _g_sql(""",
n AS (SELECT g, count(DISTINCT s) AS n_nodes FROM apsp GROUP BY g),
r AS (SELECT g, s, count(*) AS r, min(v) AS comp FROM apsp GROUP BY g, s),
c AS (SELECT g, min(r) AS min_r, count(DISTINCT comp) AS n_components FROM r GROUP BY g),
p AS (SELECT g, max(d) AS diameter, avg(d) AS a FROM apsp WHERE s <> v GROUP BY g)
SELECT n.g AS period, n.n_nodes, c.min_r = n.n_nodes AS is_connected, c.n_components,
       coalesce(p.diameter, 0) AS diameter,
       round(CASE WHEN c.min_r = n.n_nodes THEN coalesce(p.a, 0.0) ELSE 'inf'::DOUBLE END, 6) AS avg_shortest_path
FROM n JOIN c USING (g) LEFT JOIN p USING (g)"""))
def graph_paths(spark, sf):
    """Connectivity, components, diameter, mean path length."""
    return round_doubles(G.path_metrics(_edges(spark, sf), K))


@register("components", lambda: _g_sql("SELECT g AS period, s AS node, min(v) AS component FROM apsp GROUP BY g, s"))
def components_q(spark, sf):
    """Connected components by hooking and shortcutting."""
    return G.components(_edges(spark, sf), K)


@register("closeness", lambda: _g_sql(""",
n AS (SELECT g, count(DISTINCT s) AS nv FROM apsp GROUP BY g),
c AS (SELECT g, v, count(*) AS r, sum(d) AS tot FROM apsp GROUP BY g, v)
SELECT c.g AS period, v AS node, round(CASE WHEN tot > 0 AND nv > 1 THEN ((r - 1) / tot) * ((r - 1) / (nv - 1)) ELSE 0.0 END, 6) AS closeness
FROM c JOIN n USING (g)"""))
def closeness(spark, sf):
    """Closeness centrality (component-size corrected)."""
    e = _edges(spark, sf)
    return round_doubles(G.closeness(G.bfs_all_pairs(e, K), K))


@register("betweenness", lambda: _g_sql(""",
n AS (SELECT g, count(DISTINCT s) AS nv FROM apsp GROUP BY g),
t AS (SELECT a.g, a.v AS node, sum(CAST(a.sigma AS DOUBLE) * b.sigma / st.sigma) AS raw
      FROM apsp a JOIN apsp b ON a.g = b.g AND a.v = b.s
      JOIN apsp st ON st.g = a.g AND st.s = a.s AND st.v = b.v
      WHERE a.s <> a.v AND b.v <> b.s AND a.s <> b.v AND a.d + b.d = st.d GROUP BY a.g, a.v),
allv AS (SELECT DISTINCT g, s AS node FROM apsp)
SELECT allv.g AS period, allv.node, round(coalesce(raw, 0.0) * CASE WHEN nv > 2 THEN 1.0 / ((nv - 1) * (nv - 2)) ELSE 0.0 END, 6) AS betweenness
FROM allv JOIN n USING (g) LEFT JOIN t ON t.g = allv.g AND t.node = allv.node"""))
def betweenness(spark, sf):
    """Normalised betweenness (Brandes accumulation, level loop)."""
    return round_doubles(G.betweenness(_edges(spark, sf), K))


@register("clustering", lambda: f"""WITH {Q.mention_ctes()},
gs AS (SELECT DISTINCT period, src, dst FROM edges UNION SELECT DISTINCT period, dst, src FROM edges),
dg AS (SELECT period, src AS node, count(*) AS deg FROM gs GROUP BY ALL),
tr AS (SELECT a.period, a.src AS node, count(*) AS t2 FROM gs a JOIN gs b ON a.period = b.period AND a.src = b.src AND a.dst < b.dst
       JOIN gs c ON c.period = a.period AND c.src = a.dst AND c.dst = b.dst GROUP BY ALL)
SELECT dg.period, dg.node, CAST(deg AS BIGINT) AS deg, CAST(coalesce(t2, 0) AS BIGINT) AS triangles,
       round(CASE WHEN deg >= 2 THEN 2.0 * coalesce(t2, 0) / (deg * (deg - 1)) ELSE 0.0 END, 6) AS clustering
FROM dg LEFT JOIN tr USING (period, node)""")
def clustering(spark, sf):
    """Local clustering coefficients (degree-ordered triangle listing)."""
    return round_doubles(G.clustering(_edges(spark, sf), K))


@register("average_clustering", lambda: f"""WITH {Q.mention_ctes()},
gs AS (SELECT DISTINCT period, src, dst FROM edges UNION SELECT DISTINCT period, dst, src FROM edges),
dg AS (SELECT period, src AS node, count(*) AS deg FROM gs GROUP BY ALL),
tr AS (SELECT a.period, a.src AS node, count(*) AS t2 FROM gs a JOIN gs b ON a.period = b.period AND a.src = b.src AND a.dst < b.dst
       JOIN gs c ON c.period = a.period AND c.src = a.dst AND c.dst = b.dst GROUP BY ALL)
SELECT period, round(avg(CASE WHEN deg >= 2 THEN 2.0 * coalesce(t2, 0) / (deg * (deg - 1)) ELSE 0.0 END), 6) AS avg_clustering
FROM dg LEFT JOIN tr USING (period, node) GROUP BY period""")
def average_clustering(spark, sf):
    """Average clustering coefficient per graph."""
    c = G.clustering(_edges(spark, sf), K)
    return round_doubles(c.groupBy("period").agg(F.avg("clustering").alias("avg_clustering")))


@register("bridges", lambda: f"""WITH {Q.mention_ctes()},
gs AS (SELECT DISTINCT period AS g, src, dst FROM edges UNION SELECT DISTINCT period, dst, src FROM edges),
und AS (SELECT g, src AS ra, dst AS rb FROM gs WHERE src < dst),
reach AS (WITH RECURSIVE rr(g, ra, rb, node) USING KEY (g, ra, rb, node) AS (
    SELECT g, ra, rb, ra FROM und
    UNION
    (SELECT f.g, f.ra, f.rb, x.dst FROM rr f JOIN gs x ON x.g = f.g AND x.src = f.node
     WHERE NOT ((x.src = f.ra AND x.dst = f.rb) OR (x.src = f.rb AND x.dst = f.ra))
       AND NOT EXISTS (SELECT 1 FROM recurring.rr q WHERE q.g = f.g AND q.ra = f.ra AND q.rb = f.rb AND q.node = x.dst)))
  SELECT * FROM rr)
SELECT g AS period, ra AS src, rb AS dst FROM und
WHERE NOT EXISTS (SELECT 1 FROM reach r WHERE r.g = und.g AND r.ra = und.ra AND r.rb = und.rb AND r.node = und.rb)""")
def bridges(spark, sf):
    """Bridges, from the blocks of a search forest."""
    return ST.bridges(_edges(spark, sf), K)


@register("articulation_points", lambda: f"""WITH {Q.mention_ctes()},
gs AS (SELECT DISTINCT period AS g, src, dst FROM edges UNION SELECT DISTINCT period, dst, src FROM edges),
nb AS (SELECT g, src AS v, min(dst) AS first_nb, count(*) AS deg FROM gs GROUP BY g, src HAVING count(*) >= 2),
reach AS (WITH RECURSIVE rr(g, v, node) USING KEY (g, v, node) AS (
    SELECT g, v, first_nb FROM nb
    UNION
    (SELECT f.g, f.v, x.dst FROM rr f JOIN gs x ON x.g = f.g AND x.src = f.node
     WHERE x.dst <> f.v AND NOT EXISTS (SELECT 1 FROM recurring.rr q WHERE q.g = f.g AND q.v = f.v AND q.node = x.dst)))
  SELECT * FROM rr)
SELECT nb.g AS period, nb.v AS node FROM nb
WHERE EXISTS (SELECT 1 FROM gs x WHERE x.g = nb.g AND x.src = nb.v
              AND NOT EXISTS (SELECT 1 FROM reach r WHERE r.g = nb.g AND r.v = nb.v AND r.node = x.dst))""")
def articulation_points(spark, sf):
    """Articulation points, from the blocks of a search forest."""
    return ST.articulation_points(_edges(spark, sf), K)


@register("communities")
def communities(spark, sf):
    """G17 + G19: first Girvan-Newman split memberships and sizes."""
    gn = G.girvan_newman_split(_edges(spark, sf), K)
    size = gn.groupBy("period", "community").agg(F.count("*").alias("size"))
    return gn.join(size, ["period", "community"])


@register("top_centrality_nodes")
def top_centrality_nodes(spark, sf):
    """Top-3 nodes per centrality metric (degree, betweenness, closeness)."""
    e = _edges(spark, sf)
    ap = G.bfs_all_pairs(e, K)
    dc = M.degree_centrality(e).select("period", "node", "degree_centrality")
    m = (dc.join(G.betweenness(e, K, ap), ["period", "node"])
         .join(G.closeness(ap, K), ["period", "node"]))
    return M.top_n_per_metric(round_doubles(m), ["degree_centrality", "betweenness", "closeness"], 3)


@register("greedy_communities")
def greedy_communities(spark, sf):
    """G18 + G19: communities of greatest modularity per period, with their sizes."""
    member, _ = ST.greedy_modularity(_edges(spark, sf), K)
    size = member.groupBy("period", "community").agg(F.count("*").alias("size"))
    return member.join(size, ["period", "community"])


# ---- graphs whose rows grow with the data ---------------------------------

PARTS_SQL = """pairs AS (SELECT DISTINCT a.l_partkey AS src, b.l_partkey AS dst FROM lineitem a JOIN lineitem b
  ON a.l_orderkey = b.l_orderkey AND a.l_partkey < b.l_partkey AND CAST(a.l_quantity AS BIGINT) // 2 = CAST(b.l_quantity AS BIGINT) // 2),
gs AS (SELECT src, dst FROM pairs UNION ALL SELECT dst, src FROM pairs)"""

BRANDS_SQL = """lines AS (SELECT DISTINCT l_orderkey, p_brand FROM lineitem JOIN part ON p_partkey = l_partkey),
pairs AS (SELECT a.p_brand AS src, b.p_brand AS dst, count(*) AS weight FROM lines a JOIN lines b ON a.l_orderkey = b.l_orderkey AND a.p_brand < b.p_brand GROUP BY ALL),
backbone AS (SELECT src, dst, weight FROM pairs ORDER BY weight DESC, src, dst LIMIT 80)"""


@register("part_components", f"""WITH RECURSIVE {PARTS_SQL},
lab(node, c) USING KEY (node) AS (SELECT DISTINCT src, src FROM gs
  UNION (SELECT x.dst, min(f.c) FROM lab f JOIN gs x ON x.src = f.node JOIN recurring.lab r ON r.node = x.dst WHERE f.c < r.c GROUP BY x.dst))
SELECT node, c AS component FROM lab""")
def part_components(spark, sf):
    """Components of parts ordered together in about the same quantity."""
    return ST.connected(ST.both_ways(GR.part_pairs(spark, sf), []), [])


@register("part_clustering", f"""WITH {PARTS_SQL},
dg AS (SELECT src AS node, count(*) AS deg FROM gs GROUP BY src),
tr AS (SELECT a.src AS node, count(*) AS t FROM gs a JOIN gs b ON a.src = b.src AND a.dst < b.dst JOIN pairs c ON c.src = a.dst AND c.dst = b.dst GROUP BY a.src)
SELECT node, deg, coalesce(t, 0) AS triangles, round(CASE WHEN deg >= 2 THEN 2.0 * coalesce(t, 0) / (deg * (deg - 1)) ELSE 0.0 END, 6) AS clustering
FROM dg LEFT JOIN tr USING (node)""")
def part_clustering(spark, sf):
    """Clustering of the part graph."""
    return round_doubles(G.clustering(GR.part_pairs(spark, sf), []))


@register("part_bridges", f"""WITH {PARTS_SQL},
reach AS (WITH RECURSIVE rr(ra, rb, node) USING KEY (ra, rb, node) AS (
    SELECT src, dst, src FROM pairs
    UNION
    (SELECT f.ra, f.rb, x.dst FROM rr f JOIN gs x ON x.src = f.node
     WHERE NOT ((x.src = f.ra AND x.dst = f.rb) OR (x.src = f.rb AND x.dst = f.ra))
       AND NOT EXISTS (SELECT 1 FROM recurring.rr q WHERE q.ra = f.ra AND q.rb = f.rb AND q.node = x.dst)))
  SELECT * FROM rr)
SELECT src, dst FROM pairs WHERE NOT EXISTS (SELECT 1 FROM reach r WHERE r.ra = src AND r.rb = dst AND r.node = dst)""")
def part_bridges(spark, sf):
    """Bridges of the part graph."""
    return ST.bridges(GR.part_pairs(spark, sf), [])


@register("part_articulation_points", f"""WITH {PARTS_SQL},
nb AS (SELECT src AS v, min(dst) AS first_nb FROM gs GROUP BY src HAVING count(*) >= 2),
reach AS (WITH RECURSIVE rr(v, node) USING KEY (v, node) AS (
    SELECT v, first_nb FROM nb
    UNION
    (SELECT f.v, x.dst FROM rr f JOIN gs x ON x.src = f.node
     WHERE x.dst <> f.v AND NOT EXISTS (SELECT 1 FROM recurring.rr q WHERE q.v = f.v AND q.node = x.dst)))
  SELECT * FROM rr)
SELECT v AS node FROM nb WHERE EXISTS (SELECT 1 FROM gs x WHERE x.src = v AND NOT EXISTS (SELECT 1 FROM reach r WHERE r.v = nb.v AND r.node = x.dst))""")
def part_articulation_points(spark, sf):
    """Articulation points of the part graph."""
    return ST.articulation_points(GR.part_pairs(spark, sf), [])


@register("brand_backbone", f"WITH {BRANDS_SQL} SELECT * FROM backbone")
def brand_backbone(spark, sf):
    """The brand graph: the 80 pairs of brands that most orders hold together."""
    return GR.brand_backbone(spark, sf)


@register("brand_communities")
def brand_communities(spark, sf):
    """Communities of the brand graph and their modularity."""
    edges = GR.brand_backbone(spark, sf)
    member, _ = ST.greedy_modularity(edges, [])
    return round_doubles(member.crossJoin(F.broadcast(ST.modularity(edges, [], member))))  # one number beside 25 brands
