"""Entity mentions and the per-period co-mention graph (J1-J3, G1-G6, G12,
G20, A10, A32, P20).

Mention detection is a per-row expression over a small parameter table of
aliases (no join, no shuffle). Edges are the unordered entity pairs of one
text (bounded by the entity count), aggregated per (period, src, dst) with a
map-side partial aggregate; sentiment lists are never collected, only their
sum and count travel.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry import params
from quarry.functions.text import explode_nonempty, mean_e4


def alias_table(entities: list[tuple[str, list[str]]] | None = None,
                companies: list[str] | None = None) -> list[tuple[str, list[str]]]:
    ents = params.ENTITY_ALIASES if entities is None else entities
    comps = params.COMPANIES if companies is None else companies
    out = [(e, [e.lower()] + [a.lower() for a in al]) for e, al in ents]
    out += [(c, [c.lower()]) for c in comps]
    return out


def mentions_expr(text, table: list[tuple[str, list[str]]] | None = None,
                  match: str = "substring", lowered: bool = False) -> Column:
    """Sorted array of distinct entities named in ``text``.

    ``match='substring'`` reproduces case-insensitive substring hits (Q4);
    ``match='word'`` requires word boundaries."""
    table = alias_table() if table is None else table
    low = F.col(text) if isinstance(text, str) else text
    low = low if lowered else F.lower(low)
    hits = []
    for ent, aliases in sorted(table, key=lambda x: x[0]):
        if match == "word":
            import re
            conds = [low.rlike(r"\b" + re.escape(a) + r"\b") for a in aliases]
        else:
            conds = [low.contains(a) for a in aliases]
        cond = conds[0]
        for c in conds[1:]:
            cond = cond | c
        hits.append(F.when(cond, F.lit(ent)))
    return F.array_compact(F.array(*hits))


def with_mentions(units: DataFrame, **kw) -> DataFrame:
    """Adds ``mentions``; the text is lowered once, as a column of its own."""
    low = units.withColumn("__low", F.lower("text"))
    return low.withColumn("mentions", mentions_expr("__low", lowered=True, **kw)).drop("__low")


def mention_rows(units: DataFrame, **kw) -> DataFrame:
    """(period, unit_id, entity, score, sentiment) per mention."""
    m = with_mentions(units, **kw)
    return explode_nonempty(m, "mentions", "entity", "period", "unit_id", "kind", "score", "sentiment")


def pair_expr(arr: str) -> Column:
    """Unordered pairs (i < j) of a sorted array as structs (src, dst)."""
    a = F.col(arr)
    n = F.size(a)
    return F.when(n >= 2, F.flatten(F.transform(
        F.sequence(F.lit(1), n - 1),
        lambda i: F.transform(F.sequence(i + 1, n),
                              lambda j: F.struct(F.element_at(a, i).alias("src"),
                                                 F.element_at(a, j).alias("dst"))))))


def edges(units: DataFrame, **kw) -> DataFrame:
    """G1: (period, src, dst, weight = sum of text scores, num_mentions,
    average_sentiment), src < dst."""
    m = with_mentions(units, **kw).withColumn("pairs", pair_expr("mentions"))
    p = explode_nonempty(m, "pairs", "pair", "period", "score", "sentiment")
    return p.groupBy("period", F.col("pair.src").alias("src"), F.col("pair.dst").alias("dst")).agg(
        F.sum("score").cast("bigint").alias("weight"),
        F.count("*").cast("bigint").alias("num_mentions"),
        mean_e4("sentiment").alias("average_sentiment"))


def edge_widths(e: DataFrame, lo: float = 0.5, hi: float = 10.0) -> DataFrame:
    """Min-max edge width per period; (lo+hi)/2 when all weights equal."""
    ends = e.groupBy("period").agg(F.min("weight").alias("__mn"), F.max("weight").alias("__mx"))
    mn, mx = F.col("__mn"), F.col("__mx")
    width = F.when(mx != mn, F.lit(lo) + (F.col("weight") - mn) / (mx - mn) * F.lit(hi - lo)) \
        .otherwise(F.lit((hi + lo) / 2))
    return e.join(ends, "period").withColumn("normalized_weight", width).drop("__mn", "__mx")


def edge_sentiment(e: DataFrame, thresholds=params.EDGE_THRESHOLDS) -> DataFrame:
    """G3 + L2: relation label from the unrounded mean (strict thresholds), mean
    to 3 places (half to even), sorted by its absolute value descending."""
    lo, hi = thresholds
    rel = (F.when(F.col("average_sentiment") < lo, "Negative")
           .when(F.col("average_sentiment") > hi, "Positive").otherwise("Neutral"))
    return (e.select("period", F.col("src").alias("node_1"), F.col("dst").alias("node_2"),
                     F.bround("average_sentiment", 3).alias("average_sentiment"), rel.alias("relation_type"), "num_mentions",
                     F.col("weight").alias("total_weight"))
            .orderBy(F.col("period"), F.abs("average_sentiment").desc(), "node_1", "node_2"))


def node_sentiment(units: DataFrame, **kw) -> DataFrame:
    """Mean sentiment and mention count per (period, entity); includes
    entities without an edge."""
    return mention_rows(units, **kw).groupBy("period", "entity").agg(
        mean_e4("sentiment").alias("avg_sentiment"),
        F.count("*").cast("bigint").alias("mentions"))


def company_mentions(units: DataFrame, companies: list[str] | None = None) -> DataFrame:
    """A10: texts naming each comparison company, per period."""
    comps = params.COMPANIES if companies is None else companies
    tbl = [(c, [c.lower()]) for c in comps]
    r = mention_rows(units, table=tbl)
    return r.groupBy("period", "entity").agg(F.count("*").cast("bigint").alias("mentions"))


def neighbourhood(e: DataFrame) -> DataFrame:
    """Symmetric neighbour listing with weight and mean sentiment."""
    cols = ["period", "weight", "average_sentiment"]
    a = e.select(F.col("src").alias("node"), F.col("dst").alias("neighbor"), *cols)
    b = e.select(F.col("dst").alias("node"), F.col("src").alias("neighbor"), *cols)
    return a.unionByName(b)


def degrees(e: DataFrame) -> DataFrame:
    """(period, node, degree) from the symmetrised edge list."""
    n = neighbourhood(e)
    return n.groupBy("period", "node").agg(F.count("*").cast("bigint").alias("degree"))


def graph_overview(e: DataFrame) -> DataFrame:
    """Nodes, edges, density 2E/(V(V-1)), average degree 2E/V."""
    d = degrees(e).groupBy("period").agg(F.count("*").cast("bigint").alias("nodes"))
    c = e.groupBy("period").agg(F.count("*").cast("bigint").alias("edges"))
    g = d.join(c, "period")
    v, m = F.col("nodes"), F.col("edges")
    return g.select("period", "nodes", "edges",
                    F.when(v > 1, F.lit(2.0) * m / (v * (v - 1))).otherwise(F.lit(0.0)).alias("density"),
                    F.when(v > 0, F.lit(2.0) * m / v).otherwise(F.lit(0.0)).alias("average_degree"))


def degree_centrality(e: DataFrame) -> DataFrame:
    """Degree / (V - 1) per node."""
    d = degrees(e)
    v = F.col("__v")
    return d.join(d.groupBy("period").agg(F.count("*").alias("__v")), "period").select("period", "node", "degree",
                    F.when(v > 1, F.col("degree") / (v - 1)).otherwise(F.lit(0.0)).alias("degree_centrality"))


def top_n_per_metric(df: DataFrame, metric_cols: list[str], n: int = 3) -> DataFrame:
    """Top-n nodes per metric (ties: node ascending)."""
    long = df.select("period", "node", F.explode(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metric_cols])).alias("mv"))
    long = long.select("period", "node", "mv.metric", "mv.value")
    w = Window.partitionBy("period", "metric").orderBy(F.col("value").desc(), F.col("node"))
    return long.withColumn("rank", F.row_number().over(w).cast("bigint")).filter(F.col("rank") <= n)


def average_node_sentiment(ns: DataFrame) -> DataFrame:
    """Mean of per-node means (0 when none)."""
    return ns.groupBy("period").agg(F.round(F.coalesce(F.avg("avg_sentiment"), F.lit(0.0)), 9)
                                    .alias("avg_node_sentiment"))


def co_mentions(units: DataFrame, person1: str, person2: str, person3: str | None = None,
                period: str | None = None) -> DataFrame:
    """P20 (Q6 fixed): texts naming every given person by name or alias
    (spaces kept), within ``period`` when given, with the post timestamp."""
    al = dict(params.ENTITY_ALIASES)
    low = F.lower("text")
    cond = None
    for p in [x for x in (person1, person2, person3) if x]:
        toks = [p.lower()] + [a.lower() for a in al.get(p, [])]
        c = None
        for t in toks:
            c = low.contains(t) if c is None else (c | low.contains(t))
        cond = c if cond is None else (cond & c)
    out = units.filter(cond)
    if period:
        out = out.filter(F.col("period") == period)
    return out.select(F.col("kind").alias("type"), "text", "period", "created_utc", "score", "author", "unit_id")
