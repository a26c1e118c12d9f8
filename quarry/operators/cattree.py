"""Categorical multiway decision tree, grown level by level.

Equal rows are one row with a weight, so the input is read once however deep
the tree is. All open nodes of a level are expanded at once: one unpivot of the
attributes and a single ``groupBy(node, attribute, value, label)`` count
give every node's information gain; rows then move to their child through
a join with the split table. Pruning, prediction and printing are joins on
the node table as well; it is never collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions import distributions as D
from quarry.session import written


def _number(weight: str | None) -> F.Column:
    """How many rows there are, each counted ``weight`` times."""
    return F.count("*") if weight is None else F.sum(weight)


def _long(df: DataFrame, attrs: list[str], label: str, *keep: str) -> DataFrame:
    st = F.explode(F.array(*[F.struct(F.lit(i).alias("ai"), F.lit(a).alias("attr"), F.col(a).cast("string").alias("value"))
                             for i, a in enumerate(attrs)])).alias("kv")
    return df.select("node", F.col(label).alias("y"), *keep, st).select("node", "y", *keep, "kv.ai", "kv.attr", "kv.value")


def entropy_col(counts: str, total: str) -> F.Column:
    """D1 helper: -p log2 p for a count column over a total."""
    p = F.col(counts) / F.col(total)
    return -p * F.log2(p)


def node_entropy(df: DataFrame, keys: list[str], label: str, weight: str | None = None) -> DataFrame:
    """Base-2 entropy of ``label`` per group."""
    c = df.groupBy(*keys, label).agg(_number(weight).alias("n"))
    t = c.withColumn("tot", F.sum("n").over(Window.partitionBy(*keys)))
    return t.groupBy(*keys).agg(F.sum(entropy_col("n", "tot")).alias("entropy"), F.first("tot").alias("n"))


def attribute_gains(rows: DataFrame, attrs: list[str], label: str, mode: str = "standard", weight: str | None = None) -> DataFrame:
    """Information gain of each attribute at each node. ``standard`` =
    H(Y) - sum p_v H(Y|v); ``reference`` = m*H(Y) - 2*sum p_v H(Y|v) (Q9,
    m = number of values). A row counts ``weight`` times."""
    lg = _long(rows, attrs, label, *([weight] if weight else []))
    cv = lg.groupBy("node", "ai", "attr", "value", "y").agg(_number(weight).alias("n"))
    wv = Window.partitionBy("node", "ai", "value")
    cv = cv.withColumn("nv", F.sum("n").over(wv))  # two label counts per value
    hv = cv.groupBy("node", "ai", "attr", "value").agg(F.sum(entropy_col("n", "nv")).alias("hv"), F.first("nv").alias("nv"))
    base = node_entropy(rows, ["node"], label, weight).withColumnRenamed("n", "nn").withColumnRenamed("entropy", "h")
    j = hv.join(base, "node")
    agg = j.groupBy("node", "ai", "attr", "h", "nn").agg(
        F.sum(F.col("nv") / F.col("nn") * F.col("hv")).alias("cond"), F.count("*").alias("m"))
    gain = (F.col("h") - F.col("cond")) if mode == "standard" else (F.col("m") * F.col("h") - 2 * F.col("cond"))
    return agg.select("node", "ai", "attr", gain.alias("gain"), "h", "nn")


def _value_of(attrs: list[str], by: str) -> F.Column:
    """The row's value of the attribute that column ``by`` names."""
    out = F.lit(None).cast("string")
    for a in attrs:
        out = F.when(F.col(by) == a, F.col(a).cast("string")).otherwise(out)
    return out


def _children(rows: DataFrame, splits: DataFrame, attrs: list[str]) -> DataFrame:
    """One row per branch of each split: (parent, branch_value, node). The id is
    the parent's, the attribute's index and the value's ordinal, so any value,
    also null, names its own branch."""
    values = rows.join(splits, "node").select("node", "split_attr", _value_of(attrs, "split_attr").alias("branch_value")).distinct()
    index = F.coalesce(*[F.when(F.col("split_attr") == a, F.lit(i)) for i, a in enumerate(attrs)])
    ordinal = F.row_number().over(Window.partitionBy("node").orderBy(F.col("branch_value").asc_nulls_first()))
    return values.select(F.col("node").alias("parent"), "split_attr", "branch_value",
                         F.concat("node", F.lit("/"), index, F.lit(":"), ordinal).alias("node"))


def _step(rows: DataFrame, children: DataFrame, attrs: list[str], how: str = "inner") -> DataFrame:
    """Rows (column node) with ``child``: the branch they follow."""
    c = children.select(F.col("parent").alias("__p"), F.col("split_attr").alias("__a"), F.col("branch_value").alias("__b"), F.col("node").alias("child"))
    splits = c.select(F.col("__p").alias("node"), F.col("__a").alias("__s")).distinct()
    r = rows.join(splits, "node", "left").withColumn("__v", _value_of(attrs, "__s"))
    return r.join(c, (r["node"] == c["__p"]) & r["__v"].eqNullSafe(c["__b"]), how).drop("__p", "__a", "__b", "__s", "__v")


def grow(df: DataFrame, attrs: list[str], label: str, mode: str = "standard",
         max_depth: int | None = None) -> DataFrame:
    """D3: grow the tree; returns the node table (node, parent, branch_value,
    depth, split_attr, n, n_pos, majority, is_leaf, ordinal). A node id is its
    path of attribute indexes and value ordinals ("root/2:1/0:3"), which also
    says which attributes are used up. A null attribute value is a branch of
    its own; rows with a null label are left out. Rows that agree in all
    attributes and the label go the same way: they are counted first."""
    limit = len(attrs) if max_depth is None else min(max_depth, len(attrs))
    rows = df.filter(F.col(label).isNotNull()).groupBy(*attrs, label).agg(F.count("*").alias("__w"))
    rows = written(rows.withColumn("node", F.lit("root")))
    born = df.sparkSession.createDataFrame([("root", None, None)], "node string, parent string, branch_value string")
    out = None
    for depth in range(limit + 1):
        st = rows.groupBy("node").agg(F.sum("__w").alias("n"), F.sum(F.col(label) * F.col("__w")).cast("long").alias("n_pos"))
        st = st.withColumn("majority", F.when(F.col("n_pos") > F.col("n") - F.col("n_pos"), 1).otherwise(0))
        leaf = (F.col("n_pos") == 0) | (F.col("n_pos") == F.col("n")) | F.lit(depth >= limit)
        st = written(st.withColumn("is_leaf", leaf))
        open_nodes = st.filter(~F.col("is_leaf")).select("node")
        live = rows.join(open_nodes, "node", "left_semi")
        g = attribute_gains(live, attrs, label, mode, "__w")
        g = g.filter(~F.col("node").contains(F.concat(F.lit("/"), F.col("ai"), F.lit(":"))))
        w = Window.partitionBy("node").orderBy(F.round("gain", 12).desc(), F.col("ai"))
        best = g.withColumn("r", F.row_number().over(w)).filter("r = 1").select("node", F.col("attr").alias("split_attr"))
        level = written(st.join(born, "node").join(best, "node", "left")
                 .select("node", "parent", "branch_value", F.lit(depth).alias("depth"), "split_attr", "n", "n_pos", "majority", "is_leaf",
                         F.coalesce(F.regexp_extract("node", r":(\d+)$", 1).try_cast("int"), F.lit(0)).alias("ordinal")))
        out = level if out is None else out.unionByName(level)
        splits = level.filter(~F.col("is_leaf")).select("node", "split_attr")
        if splits.isEmpty():
            return out
        children = written(_children(live, splits, attrs))
        born = children.select("node", "parent", "branch_value")
        rows = written(_step(live, children, attrs).drop("node").withColumnRenamed("child", "node"))
    return out


def split_statistics(tree: DataFrame, mode: str = "contingency") -> DataFrame:
    """(node, stat, dof) of every split. ``contingency``: children x label
    counts against independence; ``reference``: the sizes of the first two
    branches against half of the node (Q10), none with fewer branches."""
    parents = tree.filter(~F.col("is_leaf")).select(F.col("node").alias("__n"), F.col("n").alias("pn"), F.col("n_pos").alias("pp"))
    j = tree.filter(F.col("parent").isNotNull()).join(parents, F.col("parent") == F.col("__n"))
    if mode == "reference":
        e = F.col("pn") / 2.0
        first = F.row_number().over(Window.partitionBy("parent").orderBy("ordinal"))
        j = j.withColumn("__r", first).filter("__r <= 2")
        return (j.groupBy(F.col("parent").alias("node")).agg(F.sum((F.col("n") - e) ** 2 / e).alias("stat"), F.count("*").alias("b"))
                .filter("b = 2").select("node", "stat", F.lit(1).alias("dof")))
    p = F.col("pp") / F.col("pn")
    cell = lambda seen, want: F.when(want > 0, (seen - want) ** 2 / want).otherwise(0.0)
    stat = cell(F.col("n_pos"), F.col("n") * p) + cell(F.col("n") - F.col("n_pos"), F.col("n") * (1 - p))
    return j.groupBy(F.col("parent").alias("node")).agg(
        F.sum(stat).alias("stat"), F.greatest(F.count("*") - 1, F.lit(1)).cast("int").alias("dof"))


def critical_value(dof: int, alpha: float) -> float:
    """Chi-square value that is exceeded with probability ``alpha``."""
    lo, hi = 0.0, 10.0 * dof + 100.0
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if D.chi2_sf(mid, dof) > alpha else (lo, mid)
    return (lo + hi) / 2


def chi2_prune(tree: DataFrame, alpha: float = 0.05, mode: str = "contingency") -> DataFrame:
    """Bottom-up chi-square pruning on the node table. A split is judged on
    its branches as grown (their counts do not change by pruning below them); a
    pruned node becomes a majority leaf. As pruning goes bottom-up but each
    split is judged alone, a kept split survives only under kept ancestors."""
    stats = split_statistics(tree, mode)
    dofs = [r[0] for r in stats.select("dof").distinct().collect()]  # branch counts that occur
    limit = F.lit(None).cast("double")
    for d in dofs:
        limit = F.when(F.col("dof") == d, F.lit(critical_value(d, alpha))).otherwise(limit)
    kept = stats.filter(F.col("stat") >= limit).select(F.col("node"), F.lit(True).alias("__kept"))
    judged = tree.join(kept, "node", "left")
    cut = judged.filter(~F.col("is_leaf") & F.col("__kept").isNull()).select(F.col("node").alias("__cut"))
    # proper ancestors of a node are the prefixes of its path
    steps = F.split("node", "/")
    above = F.transform(F.sequence(F.lit(1), F.size(steps) - 1), lambda i: F.array_join(F.slice(steps, 1, i), "/"))
    gone = (judged.filter(F.col("parent").isNotNull()).select("node", F.explode(above).alias("__up"))
            .join(cut, F.col("__up") == F.col("__cut")).select("node").distinct())
    leaf = F.col("is_leaf") | F.col("__kept").isNull()
    return (judged.join(gone, "node", "left_anti")
            .select("node", "parent", "branch_value", "depth", F.when(~leaf, F.col("split_attr")).alias("split_attr"),
                    "n", "n_pos", "majority", leaf.alias("is_leaf"), "ordinal"))


def predict(df: DataFrame, tree: DataFrame, id_col: str, *keep: str) -> DataFrame:
    """D5 (Q11 fixed): one row (id, the columns ``keep``, prediction) for each
    row, also of repeated ids. Distinct attribute values walk down the node table
    level by level with joins, and every row takes what its values got; an
    unseen branch value stops at the node and takes its majority."""
    t = written(tree)
    attrs = sorted(r[0] for r in t.select("split_attr").distinct().collect() if r[0])
    splits = t.select(F.col("node").alias("__n"), F.col("split_attr").alias("__s"))
    children = (t.filter(F.col("parent").isNotNull()).join(splits, F.col("parent") == F.col("__n"))
                .select("parent", F.col("__s").alias("split_attr"), "branch_value", "node"))
    rows = df.select(id_col, *keep, *attrs)
    cur = rows.select(*attrs, F.lit("root").alias("node")).distinct()
    names = [F.col(a).alias(f"__k{i}") for i, a in enumerate(attrs)]
    done = None
    while True:
        moved = written(_step(cur, children, attrs, "left"))
        stay = moved.filter(F.col("child").isNull()).join(t.select("node", "majority"), "node")
        stay = stay.select(*names, F.col("majority").alias("prediction"))
        done = stay if done is None else done.unionByName(stay)
        cur = moved.filter(F.col("child").isNotNull()).drop("node").withColumnRenamed("child", "node")
        if cur.isEmpty():
            same = [F.col(a).eqNullSafe(F.col(f"__k{i}")) for i, a in enumerate(attrs)]
            # a tree without a split has one prediction for all
            return (rows.join(done, same) if same else rows.crossJoin(F.broadcast(done))).select(id_col, *keep, "prediction")


def fold_of(df: DataFrame, label: str, id_col: str, k: int, seed: int = 42) -> DataFrame:
    """Adds ``fold``: the rank of the id hash within the label, modulo k, so
    the folds of a label differ by at most one row. Ranks are dealt per label
    and hash range: counts of the ranges before, plus the rank inside."""
    h = F.xxhash64(F.col(id_col), F.lit(seed))
    keyed = df.withColumn("__h", h).withColumn("__part", F.shiftright("__h", 56))
    sizes = keyed.groupBy(label, "__part").agg(F.count("*").alias("__size"))
    before = Window.partitionBy(label).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    first = sizes.select(F.col(label).alias("__l"), F.col("__part").alias("__q"), F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__first"))
    rank = F.row_number().over(Window.partitionBy(label, "__part").orderBy("__h", id_col))
    r = keyed.withColumn("__rank", rank)
    return (r.join(first, r[label].eqNullSafe(first["__l"]) & (r["__part"] == first["__q"]))
            .withColumn("fold", F.pmod(F.col("__first") + F.col("__rank") - 1, F.lit(k)).cast("int"))
            .drop("__h", "__part", "__rank", "__l", "__q", "__first"))


def kfold_error(df: DataFrame, attrs: list[str], label: str, id_col: str, k: int = 2, seed: int = 42,
                max_depth: int | None = None) -> DataFrame:
    """Stratified k-fold error; per fold the error of a pruned tree trained
    on the other folds."""
    f = fold_of(df, label, id_col, k, seed).checkpoint(eager=True)
    out = []
    for i in range(k):
        train, test = f.filter(F.col("fold") != i), f.filter(F.col("fold") == i)
        tree = chi2_prune(grow(train, attrs, label, max_depth=max_depth))
        pred = predict(test, tree, id_col, label)
        err = pred.agg(F.avg((F.col("prediction") != F.col(label)).cast("double"))).first()[0]
        out.append((i, None if err is None else float(err)))
    return df.sparkSession.createDataFrame(out, "fold int, error double")


def tree_text(tree: DataFrame) -> DataFrame:
    """One indented text line per node (node, line), in path order."""
    up = tree.select(F.col("node").alias("__p"), F.col("split_attr").alias("__a"))
    j = tree.join(up, F.col("parent") == F.col("__p"), "left")
    head = F.when(F.col("parent").isNull(), F.lit("root")).otherwise(
        F.concat("__a", F.lit(" = "), F.coalesce("branch_value", F.lit("(missing)"))))
    tail = F.when(F.col("is_leaf"), F.concat(F.lit(" -> "), "majority", F.lit(" (n="), "n", F.lit(")"))).otherwise(
        F.concat(F.lit(" [split "), "split_attr", F.lit("]")))
    return j.select("node", F.concat(F.repeat(F.lit("  "), F.col("depth")), head, tail).alias("line"))
