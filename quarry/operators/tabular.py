"""Tabular statistics, cleaning and discretisation (A15-A30, P6-P18,
F1-F9, F17, T24, J8, J12, L7, W7).

Column statistics are single global aggregates (partial per partition,
merged once); where a fitted parameter is needed downstream (bin edges,
min / max, moments) the few resulting numbers are applied back as literals,
so no unpartitioned window or join appears in the plan.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DoubleType, StructField, StructType

from quarry.operators.ranks import quantiles, with_rank
from quarry.session import written

# ---------------------------------------------------------------- statistics


def value_shares(df: DataFrame, col: str) -> DataFrame:
    """Normalised value counts."""
    c = df.groupBy(col).agg(F.count("*").alias("n"))
    tot = df.count()
    return c.select(col, "n", (F.col("n") / F.lit(float(tot))).alias("share"))


def histogram(df: DataFrame, col: str, bins: int = 20) -> DataFrame:
    """Equal-width histogram between min and max, nulls dropped, the
    last bin closed on the right."""
    m = df.agg(F.min(col).alias("mn"), F.max(col).alias("mx")).first()
    mn, mx = m["mn"], m["mx"]
    x = F.col(col).cast("double")
    if mn is None:
        return df.sparkSession.createDataFrame([], "bin int, lo double, hi double, n bigint")
    width = (float(mx) - float(mn)) / bins if mx != mn else 1.0
    b = F.least(F.floor((x - F.lit(float(mn))) / F.lit(width)), F.lit(bins - 1)).cast("int")
    h = df.filter(F.col(col).isNotNull()).groupBy(b.alias("bin")).agg(F.count("*").alias("n"))
    return h.select("bin", (F.lit(float(mn)) + F.col("bin") * F.lit(width)).alias("lo"),
                    (F.lit(float(mn)) + (F.col("bin") + 1) * F.lit(width)).alias("hi"), "n")


def unit_histogram(df: DataFrame, col: str) -> DataFrame:
    """Rows per whole number from the least to the greatest value, empty
    ones too; a value counts for the whole number below it, nulls for none."""
    found = df.where(F.col(col).isNotNull()).groupBy(F.floor(col).cast("long").alias("value")).agg(F.count("*").alias("n"))
    ends = found.agg(F.min("value").alias("a"), F.max("value").alias("b")).where("a IS NOT NULL")
    return ends.select(F.explode(F.sequence("a", "b")).alias("value")).join(found, "value", "left").select("value", F.coalesce("n", F.lit(0)).alias("n"))


def mean_std(df: DataFrame, cols: list[str]) -> DataFrame:
    """Mean and sample std per column (long format)."""
    rows = [F.struct(F.lit(c).alias("column"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"))
            for c in cols]
    return df.agg(F.array(*rows).alias("a")).select(F.inline("a"))


QUARTERS = [0.25, 0.5, 0.75]


def describe(df: DataFrame, cols: list[str]) -> DataFrame:
    """Count, mean, std, min, 25/50/75% (linear interpolation), max."""
    rows = [F.struct(F.lit(c).alias("column"), F.count(c).alias("count"), F.avg(c).alias("mean"),
                     F.stddev_samp(c).alias("std"), F.min(c).cast("double").alias("min"),
                     F.max(c).cast("double").alias("max")) for c in cols]
    out = df.agg(F.array(*rows).alias("a")).select(F.inline("a")).join(quantiles(df, cols, QUARTERS), "column", "left")
    return out.select("column", "count", "mean", "std", "min", F.col("q0").alias("p25"), F.col("q1").alias("p50"), F.col("q2").alias("p75"), "max")


def null_counts(df: DataFrame) -> DataFrame:
    """Nulls per column in one pass."""
    rows = [F.struct(F.lit(c).alias("column"), F.sum(F.col(c).isNull().cast("long")).alias("nulls"))
            for c in df.columns]
    return df.agg(F.array(*rows).alias("a")).select(F.inline("a"))


def corr_matrix(df: DataFrame, cols: list[str]) -> DataFrame:
    """Pearson correlation for every column pair, one aggregate."""
    rows = [F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"), F.corr(a, b).alias("corr"))
            for a in cols for b in cols]
    return df.agg(F.array(*rows).alias("a")).select(F.inline("a"))


def _fences(df: DataFrame, group: str, col: str) -> DataFrame:
    """Every non-null value with the quartiles and fences of its group."""
    q = quantiles(df, [col], QUARTERS, by=group).select(
        F.col(group).alias("__g"), F.col("q0").alias("q1"), F.col("q1").alias("median"), F.col("q2").alias("q3"))
    iqr = F.col("q3") - F.col("q1")
    return df.join(q, F.col(group).eqNullSafe(F.col("__g"))).drop("__g").select(
        "*", (F.col("q1") - 1.5 * iqr).alias("fence_low"), (F.col("q3") + 1.5 * iqr).alias("fence_high"))


def box_stats(df: DataFrame, group: str, col: str) -> DataFrame:
    """Per group quartiles, 1.5 IQR whiskers (extreme values inside the
    fences) and outlier count. Groups without a value have no row."""
    x = F.col(col)
    return _fences(df.select(group, col), group, col).groupBy(group, "q1", "median", "q3").agg(
        F.min(F.when(x >= F.col("fence_low"), x)).cast("double").alias("whisker_low"),
        F.max(F.when(x <= F.col("fence_high"), x)).cast("double").alias("whisker_high"),
        F.sum(((x < F.col("fence_low")) | (x > F.col("fence_high"))).cast("long")).alias("outliers"))


def box_outliers(df: DataFrame, group: str, col: str) -> DataFrame:
    """The rows outside the fences of their group."""
    x = F.col(col)
    return _fences(df, group, col).where((x < F.col("fence_low")) | (x > F.col("fence_high"))).select(*df.columns)


def group_quartiles(df: DataFrame, group: str, col: str) -> DataFrame:
    """The quartiles drawn inside each group's distribution."""
    return quantiles(df, [col], QUARTERS, by=group).select(
        group, F.col("q0").alias("q1"), F.col("q1").alias("median"), F.col("q2").alias("q3"))


def group_histogram(df: DataFrame, group: str, col: str, bins: int = 10) -> DataFrame:
    """Per-group distribution (equal-width bins over the global range)."""
    m = df.agg(F.min(col).alias("mn"), F.max(col).alias("mx")).first()
    mn, mx = float(m["mn"]), float(m["mx"])
    width = (mx - mn) / bins if mx != mn else 1.0
    b = F.least(F.floor((F.col(col) - F.lit(mn)) / F.lit(width)), F.lit(bins - 1)).cast("int")
    return df.filter(F.col(col).isNotNull()).groupBy(group, b.alias("bin")).agg(F.count("*").alias("n"))


def regression_line(df: DataFrame, y: str, x: str) -> DataFrame:
    """Slope, intercept and R^2 of y on x."""
    return df.agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"),
                  F.regr_r2(y, x).alias("r2"), F.regr_count(y, x).alias("n"))


def outcome_crosstab(df: DataFrame, col: str, label: str = "outcome") -> DataFrame:
    """Rows per value and percent of class 1."""
    return df.groupBy(col).agg(F.count("*").alias("n"),
                               (F.lit(100.0) * F.avg((F.col(label) == 1).cast("double"))).alias("pct_1"))


def majority_class(df: DataFrame, keys: list[str], label: str) -> DataFrame:
    """Mode of ``label`` per key, smallest label on ties."""
    c = df.groupBy(*keys, label).agg(F.count("*").alias("n"))
    if not keys:
        return c.orderBy(F.col("n").desc(), F.col(label)).limit(1)
    w = Window.partitionBy(*keys).orderBy(F.col("n").desc(), F.col(label))
    return c.withColumn("r", F.row_number().over(w)).filter("r = 1").drop("r")


def medians(df: DataFrame, cols: list[str]) -> DataFrame:
    """Exact medians (linear interpolation)."""
    q = quantiles(df, cols, [0.5])
    return q.agg(*[F.max(F.when(F.col("column") == c, F.col("q0"))).alias(c) for c in cols])


def pivot_mean(df: DataFrame, idx: str, col: str, val: str, values: list) -> DataFrame:
    """Two-way pivot of a mean; the value list is given."""
    return df.groupBy(idx).pivot(col, values).agg(F.avg(val))


def best_by(df: DataFrame, metric: str, keys: list[str] | None = None) -> DataFrame:
    """A29 / A30 / ML13: row with the maximum metric (per key)."""
    cols = [c for c in df.columns]
    agg = df.groupBy(*(keys or [])).agg(F.max_by(F.struct(*cols), F.col(metric)).alias("b"))
    return agg.select("b.*")


# ---------------------------------------------------------------- cleaning


def fix_driving_age(df: DataFrame, age="age", exp="driving_experience", min_age: int = 16) -> DataFrame:
    """If age - experience < 16 then experience = age - 16."""
    return df.withColumn(exp, F.when(F.col(age) - F.col(exp) < min_age, F.col(age) - min_age)
                         .otherwise(F.col(exp)))


def band(c, cuts: list[float], labels: list) -> Column:
    """Right-closed threshold banding: x <= cuts[0] -> labels[0], ..."""
    c = F.col(c) if isinstance(c, str) else c
    out = None
    for cut, lab in zip(cuts, labels):
        out = F.when(c <= cut, F.lit(lab)) if out is None else out.when(c <= cut, F.lit(lab))
    return out.otherwise(F.lit(labels[len(cuts)]))


# Band thresholds and labels of the insurance study.
AGE_TEXT = ([30, 60], ["young", "grown-up", "old"])
AGE_WEIGHT = ([24, 65], [3, 1, 2])
EXP_TEXT = ([2, 8], ["new", "regular", "senior"])
EXP_WEIGHT = ([2, 8], [3, 2, 1])
RISK_BAND = ([4, 6], [1, 2, 3])


def risk_index_v1(df: DataFrame) -> DataFrame:
    """0.4 violations + 0.4 accidents + 0.2 experience."""
    return df.withColumn("driver_risk_index", 0.4 * F.col("speeding_violations")
                         + 0.4 * F.col("past_accidents") + 0.2 * F.col("driving_experience"))


def ratios(df: DataFrame) -> DataFrame:
    """P10: mileage/(1+experience), experience/(1+accidents)."""
    return df.select("*", (F.col("annual_mileage") / (1 + F.col("driving_experience"))).alias("mileage_experience_ratio"),
                     (F.col("driving_experience") / (1 + F.col("past_accidents"))).alias("experience_quality"))


def category_key(*cols: str) -> Column:
    """Concatenated category key."""
    return F.concat_ws("_", *[F.col(c) for c in cols])


def columns_by_type(df: DataFrame, numeric: bool = True) -> list[str]:
    """Numeric or non-numeric column names from the schema."""
    num = {"integer", "long", "double", "float", "short", "byte", "decimal"}
    return [f.name for f in df.schema.fields if (f.dataType.typeName() in num) == numeric]


def first_appearance_codes(df: DataFrame, col: str, order: str) -> DataFrame:
    """Integer code per category by first appearance in ``order``."""
    first = df.groupBy(col).agg(F.min(order).alias("_first"))
    return with_rank(first, "_first", col, name="_code").select(col, F.col("_code").cast("int").alias(f"{col}_code"))


def encode_categories(df: DataFrame, cols: list[str], order: str) -> DataFrame:
    """F8: every column of ``cols`` as its code; a null category has one too."""
    for c in cols:
        codes = first_appearance_codes(df, c, order).withColumnRenamed(c, "_c")
        df = df.join(codes, F.col(c).eqNullSafe(F.col("_c")), "left").drop(c, "_c").withColumnRenamed(f"{c}_code", c)
    return df


def constant_to_zero(df: DataFrame, *cols: str) -> DataFrame:
    """A column with at most one distinct value (nulls aside) becomes 0."""
    ends = df.agg(*[F.min(c).alias(f"a{i}") for i, c in enumerate(cols)], *[F.max(c).alias(f"b{i}") for i, c in enumerate(cols)]).first()
    flat = {c for i, c in enumerate(cols) if ends[f"a{i}"] == ends[f"b{i}"]}
    return df.select(*[F.lit(0).cast(df.schema[c].dataType).alias(c) if c in flat else F.col(c) for c in df.columns])


# ---------------------------------------------------------------- binning


def quantile_fit(df: DataFrame, cols: list[str], n_bins: int = 3) -> dict[str, list[float] | None]:
    """Edges between the quantile bins of every column, all columns in one pass:
    equal-share quantiles, as many bins as distinct values at most, edges no
    further than 1e-8 from the one before dropped. None for a column of at most
    one distinct value. An edge is interpolated from its two neighbouring values
    in one fixed way, so that a value next to it falls on the same side whatever
    the partitioning."""
    distinct = df.agg(*[F.count_distinct(c).alias(f"d{i}") for i, c in enumerate(cols)]).first()
    bins = {c: min(n_bins, distinct[f"d{i}"]) for i, c in enumerate(cols)}
    out: dict[str, list[float] | None] = {c: None for c, n in bins.items() if n <= 1}
    for n in sorted({n for n in bins.values() if n > 1}):
        some = [c for c, m in bins.items() if m == n]
        found = quantiles(df, some, [float(q) / 100 for q in np.linspace(0, 100, n + 1)])
        for r in found.collect():  # a row a column
            edges = [r[f"q{i}"] for i in range(n + 1)]
            out[r["column"]] = [e for e, before in zip(edges[1:], edges) if e - before > 1e-8][:-1]
    return out


def quantile_apply(col: str, edges: list[float] | None, labels: list | None = None) -> Column:
    """Bin of the column's value, also of values that the fit has not seen: how
    many edges it reaches; null stays null. ``labels`` maps bin i to labels[i]."""
    b = sum(((F.col(col) >= F.lit(e)).cast("int") for e in edges or []), F.lit(0))
    if labels:
        b = F.element_at(F.array(*[F.lit(v) for v in labels]), b + 1)
    return F.when(F.col(col).isNotNull(), b)


def quantile_bin(df: DataFrame, col: str, out: str | None = None, n_bins: int = 3, labels: list | None = None) -> DataFrame:
    """Ordinal quantile bins (inner edges by linear interpolation,
    a value on an edge goes up, duplicate edges dropped, 0 for a constant
    column). ``labels`` maps bin i -> labels[i]."""
    return df.withColumn(out or col, quantile_apply(col, quantile_fit(df, [col], n_bins)[col], labels))


def categorize(df: DataFrame, keep: list[str], trend: str = "daily_trend") -> DataFrame:
    """every column but ``keep`` to quantile labels 1 / 2 / 3, and ``trend``
    to 1 above 1, else -1; nulls stay null."""
    cols = [c for c in df.columns if c not in keep and c != trend]
    fitted = quantile_fit(df, cols)
    up = F.when(F.col(trend).isNotNull(), F.when(F.col(trend) > 1, 1).otherwise(-1)) if trend in df.columns else None
    return df.select(*[quantile_apply(c, fitted[c], [1, 2, 3]).alias(c) if c in fitted else up.alias(c) if c == trend else F.col(c)
                       for c in df.columns])


def log_shift(df: DataFrame, col: str, out: str) -> DataFrame:
    """If min <= 0 add |min| + 1, then natural log."""
    mn = df.agg(F.min(col)).first()[0]
    x = F.col(col) + F.lit(abs(mn) + 1) if mn is not None and mn <= 0 else F.col(col)
    return df.withColumn(out, F.ln(x))


def quantile_bin_log(df: DataFrame, col: str, out: str | None = None, n_bins: int = 3) -> DataFrame:
    """quantile bins of the shifted log (constant -> 0)."""
    tmp = f"__log_{col}"
    d = log_shift(df, col, tmp)
    return d.withColumn(out or col, quantile_apply(tmp, quantile_fit(d, [tmp], n_bins)[tmp])).drop(tmp)


def uniform_bin(df: DataFrame, col: str, out: str | None = None, n_bins: int = 3,
                labels: list | None = None) -> DataFrame:
    """equal-width bins; a constant column becomes bin 0."""
    out = out or col
    m = df.agg(F.min(col).alias("mn"), F.max(col).alias("mx")).first()
    mn, mx = m["mn"], m["mx"]
    if mn is None or mn == mx:
        b = F.lit(0)
    else:
        edges = np.linspace(float(mn), float(mx), n_bins + 1)
        b = sum((F.when(F.col(col) >= F.lit(float(e)), 1).otherwise(0) for e in edges[1:-1]), F.lit(0))
    if labels:
        b = F.element_at(F.array(*[F.lit(x) for x in labels]), b + 1)
    return df.withColumn(out, F.when(F.col(col).isNotNull(), b))


def minmax_fit(train: DataFrame, cols: list[str]) -> dict:
    """fit min / max on the training rows only (Q13 fixed)."""
    r = train.agg(*[F.min(c).alias(f"mn_{c}") for c in cols], *[F.max(c).alias(f"mx_{c}") for c in cols]).first()
    return {c: (r[f"mn_{c}"], r[f"mx_{c}"]) for c in cols}


def minmax_apply(df: DataFrame, fitted: dict) -> DataFrame:
    cols = []
    for f in df.columns:
        if f in fitted:
            mn, mx = fitted[f]
            rng = (mx - mn) if mx != mn else 1.0
            cols.append(((F.col(f) - F.lit(float(mn))) / F.lit(float(rng))).alias(f))
        else:
            cols.append(F.col(f))
    return df.select(*cols)


def hash_split(df: DataFrame, key: str, train_pct: int = 80, seed: int = 42, percentile: Column | None = None):
    """Deterministic train/test split by a percentile (0..99) of the
    key, a hash by default; the test set is the complement, so no join runs. A
    null key is hashed like any other; a null percentile is test."""
    p = F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(100)) if percentile is None else percentile
    in_train = F.coalesce(p < train_pct, F.lit(False))
    return df.filter(in_train), df.filter(~in_train)


# ---------------------------------------------------------------- KNN impute


def knn_impute(df: DataFrame, id_col: str, cols: list[str] | None = None, k: int = 5) -> DataFrame:
    """KNN imputation with nan-Euclidean distance over the columns
    that have nulls (Q12 kept); mean of the k nearest donors that have the
    value (ties: smaller id). A donor is eligible if it shares a present
    coordinate; the squared distance is scaled by total / shared coordinates.
    Without an eligible donor the column mean is used."""
    if cols is None:
        nulls = null_counts(df.select(*[c for c in df.columns if c != id_col])).collect()
        cols = [r["column"] for r in nulls if r["nulls"] > 0]
        cols = [c for c in cols if c in columns_by_type(df)]
    out = df
    means = df.agg(*[F.avg(c).alias(c) for c in cols]).first() if cols else {}
    for target in cols:
        coords = [c for c in cols if c != target]
        fill = _knn_fill(df, id_col, target, coords, k, means[target])
        out = out.join(fill, id_col, "left").withColumn(
            target, F.coalesce(F.col(target), F.col("__fill"))).drop("__fill")
    return out


#: Most donors in a cell of the search, and the halvings of an axis after which a cell is not cut any more.
DONORS_PER_CELL, HALVINGS = 1000, 48


def _present(coords: list[str]) -> Column:
    return F.concat(*[F.col(c).isNotNull().cast("int").cast("string") for c in coords])


def _knn_fill(df, id_col, target, coords, k, mean_value):
    """Fill values per receiver id. Receivers with equal coordinates are one
    query; donors with equal coordinates are reduced to k. All pairs of
    present-column patterns (at most 4^coordinates, those that occur) are
    searched side by side over the coordinates that they share."""
    receivers = df.filter(F.col(target).isNull())
    if not coords:
        return receivers.select(id_col, F.lit(mean_value).alias("__fill"))
    xs = [F.col(c).cast("double").alias(f"__q{i}") for i, c in enumerate(coords)]
    queries = receivers.select(_present(coords).alias("__p"), *xs).distinct().checkpoint(eager=True)
    alike = Window.partitionBy(*coords).orderBy(id_col)
    donors = (df.filter(F.col(target).isNotNull()).withColumn("__r", F.row_number().over(alike)).filter(F.col("__r") <= k)
              .select(_present(coords).alias("__p"), F.col(id_col).alias("__id"), F.col(target).cast("double").alias("__v"),
                      *[F.col(c).cast("double").alias(f"__d{i}") for i, c in enumerate(coords)])).checkpoint(eager=True)
    asked, given = ([r[0] for r in x.select("__p").distinct().collect()] for x in (queries, donors))
    pairs = [(p, q, [a == b == "1" for a, b in zip(p, q)]) for p in asked for q in given]
    pairs = [(i, p, q, both, (len(coords) + 1) / sum(both)) for i, (p, q, both) in enumerate(pairs) if any(both)]
    if not pairs:
        return receivers.select(id_col, F.lit(mean_value).alias("__fill"))
    pairs = df.sparkSession.createDataFrame(pairs, "__pair int, __p string, __g string, __both array<boolean>, __scale double")
    found = _nearest(queries, donors, F.broadcast(pairs), len(coords), k)
    keys = [f"__q{i}" for i in range(len(coords))]
    best = Window.partitionBy(*keys).orderBy("__dist", "__id")
    fills = (found.withColumn("__r", F.row_number().over(best)).filter(F.col("__r") <= k)
             .groupBy(*keys).agg(F.avg("__v").alias("__fill")))
    rows = receivers.select(id_col, *xs).alias("r").join(
        fills.alias("f"), [F.col(f"r.{c}").eqNullSafe(F.col(f"f.{c}")) for c in keys], "left")
    return rows.select(id_col, F.coalesce("__fill", F.lit(mean_value)).alias("__fill"))


def _cells(points, donors, xs, k):
    """Cuts the space of every pair until no cell holds more than
    DONORS_PER_CELL donors, by halving all axes alike, so cells are small where
    donors are dense and an outlier widens its own cell only. Returns the cells
    with the box of their donors, the donors with their cell, and the points
    with ``__reach``, the squared distance to the far corner of the least box
    around them that holds k donors."""
    cs = [f"__c{i}" for i in range(len(xs))]
    lows = [F.min(x).alias(f"__o{i}") for i, x in enumerate(xs)]
    span = F.greatest(*[F.max(x) - F.min(x) for x in xs], F.lit(0.0))
    grid = F.broadcast(written(donors.groupBy("__pair").agg(*lows, F.when(span > 0, span).otherwise(1.0).alias("__span"))))
    left, ask = donors.join(grid, "__pair"), points.withColumn("__reach", F.lit(float("inf"))).join(grid, "__pair")
    cells, placed, reached, level = [], [], [], 0
    while True:
        steps = float(2 ** level)
        at = [F.floor(F.least(F.greatest((F.col(x) - F.col(f"__o{i}")) / F.col("__span") * steps, F.lit(0.0)), F.lit(steps - 1))).cast("long") for i, x in enumerate(xs)]
        left = left.withColumn("__level", F.lit(level)).withColumns(dict(zip(cs, at)))
        ask = ask.withColumns(dict(zip(cs, at)))
        counted = written(left.groupBy("__pair", "__level", *cs).agg(
            F.count(F.lit(1)).alias("__n"), *[f(x).alias(f"__{e}{i}") for i, x in enumerate(xs) for e, f in (("l", F.min), ("h", F.max))]))
        full = F.col("__n") > (DONORS_PER_CELL if level < HALVINGS else float("inf"))
        cells.append(counted.where(~full))
        placed.append(left.join(counted.where(~full), ["__pair", *cs], "left_semi"))
        corner = sum((F.greatest(F.abs(F.col(x) - F.col(f"__l{i}")), F.abs(F.col(f"__h{i}") - F.col(x))) ** 2 for i, x in enumerate(xs)), F.lit(0.0))
        reach = F.least("__reach", F.when(F.col("__n") >= k, corner))
        ask = written(ask.join(counted.drop("__level"), ["__pair", *cs], "left").withColumns({"__reach": reach, "__on": F.coalesce(full, F.lit(False))})
                      .select(*points.columns, "__span", *[f"__o{i}" for i in range(len(xs))], "__reach", "__on"))
        reached.append(ask.where("NOT __on").select(*points.columns, "__reach"))
        if counted.where(full).isEmpty():
            return tuple(reduce(DataFrame.unionByName, x) for x in (cells, placed, reached))
        left = written(left.join(counted.where(full), ["__pair", *cs], "left_semi").drop("__level", *cs))
        ask = ask.where("__on").drop("__on")
        level += max(1, 4 // len(xs))


def _nearest(queries, donors, pairs, n_coords, k):
    """The k nearest donors of every query for each of the ``pairs`` of
    patterns, exact: donors are put in cells of any bounded number, a query goes
    to the cells whose box is no farther than k donors surely are, and a task
    compares the queries and donors of a cell. A coordinate that a pair does not
    share is 0 on both sides."""
    xs, cs = [f"__x{i}" for i in range(n_coords)], [f"__c{i}" for i in range(n_coords)]
    shared = lambda name: [F.when(F.col("__both")[i], F.col(f"{name}{i}")).otherwise(0.0).alias(x) for i, x in enumerate(xs)]
    asked = written(queries.join(pairs, "__p").select("__pair", "__scale", *shared("__q"), *[f"__q{i}" for i in range(n_coords)]))
    alike = Window.partitionBy("__pair", *xs).orderBy("__id")
    given = donors.join(pairs, donors["__p"] == pairs["__g"]).select("__pair", "__id", "__v", *shared("__d"))
    given = written(given.withColumn("__r", F.row_number().over(alike)).where(F.col("__r") <= k).drop("__r"))
    cells, placed, points = _cells(asked.select("__pair", "__scale", *xs).distinct(), given, xs, k)
    box = sum((F.greatest(F.col(f"__l{i}") - F.col(x), F.col(x) - F.col(f"__h{i}"), F.lit(0.0)) ** 2 for i, x in enumerate(xs)), F.lit(0.0))
    near = points.join(F.broadcast(cells), "__pair").where(box <= F.col("__reach") * (1 + 1e-9)).select("__pair", "__level", *cs, "__scale", *xs)
    donor = placed.select("__pair", "__level", *cs, "__id", "__v", *xs)
    key = ["__pair", "__level", *cs]

    def best(points: pa.Table, donors: pa.Table) -> pa.Table:
        donors = donors.take(pc.sort_indices(donors, sort_keys=[("__id", "ascending")], null_placement="at_start"))
        out, many = [], min(k, donors.num_rows)
        for start in range(0, points.num_rows if many else 0, 1000):
            some = points.slice(start, 1000)
            square = np.zeros((some.num_rows, donors.num_rows))
            for x in xs:
                apart = some[x].to_numpy()[:, None] - donors[x].to_numpy()[None, :]
                square += apart * apart
            dist = np.sqrt(square * some["__scale"].to_numpy()[:, None])
            rows, at = np.nonzero(~(dist > np.partition(dist, many - 1, axis=1)[:, many - 1:many]))
            order = np.lexsort((at, dist[rows, at], rows))
            rows, at = rows[order], at[order]
            first = np.searchsorted(rows, rows)
            keep = np.arange(len(rows)) - first < k  # equal distances by id
            rows, at = rows[keep], at[keep]
            found = some.select(["__pair", *xs]).take(rows)
            found = found.append_column("__dist", pa.array(dist[rows, at]))
            out.append(found.append_column("__id", donors["__id"].take(at)).append_column("__v", donors["__v"].take(at)))
        return pa.concat_tables(out) if out else empty.empty_table()

    schema = StructType([*points.select("__pair", *xs).schema, StructField("__dist", DoubleType()), *donors.select("__id", "__v").schema])
    empty = to_arrow_schema(schema)
    found = near.groupBy(*key).cogroup(donor.groupBy(*key)).applyInArrow(best, schema)
    return asked.drop("__scale").join(found, ["__pair", *xs]).select(*[f"__q{i}" for i in range(n_coords)], "__dist", "__id", "__v")


def insurance_features(df: DataFrame, id_col: str = "id") -> DataFrame:
    """the full pre-processing chain in the reference order (Q14):
    KNN imputation -> licence-age repair -> category codes -> credit bins ->
    mileage/experience ratio (raw experience) log-bins -> mileage bins ->
    age weight band -> experience quality log-bins -> experience band ->
    risk index v2 band -> violation and accident log-bins."""
    x = knn_impute(df, id_col, ["credit_score", "annual_mileage"])
    x = fix_driving_age(x)
    x = encode_categories(x, ["vehicle_type", "married", "children"], id_col).checkpoint(eager=True)
    x = quantile_bin(x, "credit_score")
    x = x.withColumn("mileage_experience_ratio", F.col("annual_mileage") / (1 + F.col("driving_experience")))
    x = quantile_bin_log(x, "mileage_experience_ratio")
    x = quantile_bin(x, "annual_mileage")
    x = x.withColumn("age", band("age", *AGE_WEIGHT))
    x = x.withColumn("experience_quality", F.col("driving_experience") / (1 + F.col("past_accidents")))
    x = quantile_bin_log(x, "experience_quality")
    x = x.withColumn("driving_experience", band("driving_experience", *EXP_WEIGHT))
    ri = 0.4 * F.col("speeding_violations") + 0.4 * F.col("past_accidents") \
        + 0.2 * F.col("driving_experience") * F.col("age")
    x = x.withColumn("driver_risk_index", band(ri, *RISK_BAND))
    x = quantile_bin_log(x, "speeding_violations")
    x = quantile_bin_log(x, "past_accidents")
    return x
