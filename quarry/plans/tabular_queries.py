"""Tabular queries over the TAB binding."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions.text import round_doubles
from quarry.operators import tabular as TB
from quarry.plans.catalog import register
from quarry.plans.tab_sql import TAB_SQL
from quarry.sources.tabular import TAB_NUMERIC, tab

NUM = TAB_NUMERIC
R = lambda e, n="": f"round({e}, 6)" + (f" AS {n}" if n else "")


@register("tab", f"WITH {TAB_SQL} SELECT id, age, driving_experience, round(credit_score, 6) AS credit_score, "
                 "round(annual_mileage, 6) AS annual_mileage, speeding_violations, past_accidents, vehicle_type, "
                 "married, children, outcome FROM tab")
def tab_q(spark, sf):
    """TAB binding / S11 shape (ID kept as the row key)."""
    return round_doubles(tab(spark, sf))


@register("value_shares", f"""WITH {TAB_SQL}
SELECT vehicle_type, CAST(count(*) AS BIGINT) AS n, round(count(*) / (SELECT count(*) FROM tab)::DOUBLE, 6) AS share
FROM tab GROUP BY vehicle_type""")
def value_shares(spark, sf):
    """Normalised value counts."""
    return round_doubles(TB.value_shares(tab(spark, sf), "vehicle_type"))


@register("histogram", f"""WITH {TAB_SQL},
m AS (SELECT min(annual_mileage) AS mn, max(annual_mileage) AS mx FROM tab),
b AS (SELECT CAST(least(floor((annual_mileage - mn) / ((mx - mn) / 20)), 19) AS INTEGER) AS bin, mn, (mx - mn) / 20 AS w
      FROM tab, m WHERE annual_mileage IS NOT NULL)
SELECT bin, round(mn + bin * w, 6) AS lo, round(mn + (bin + 1) * w, 6) AS hi, CAST(count(*) AS BIGINT) AS n FROM b GROUP BY bin, mn, w""")
def histogram(spark, sf):
    """20-bin histogram, nulls dropped."""
    return round_doubles(TB.histogram(tab(spark, sf), "annual_mileage", 20))


def _mean_std_sql():
    parts = [f"SELECT '{c}' AS \"column\", {R(f'avg({c})', 'mean')}, {R(f'stddev_samp({c})', 'std')} FROM tab" for c in NUM]
    return f"WITH {TAB_SQL} " + " UNION ALL ".join(parts)


@register("mean_std", _mean_std_sql)
def mean_std(spark, sf):
    """Mean and sample standard deviation per column."""
    return round_doubles(TB.mean_std(tab(spark, sf), NUM))


def _describe_sql():
    parts = [f"""SELECT '{c}' AS "column", CAST(count({c}) AS BIGINT) AS count, {R(f'avg({c})', 'mean')},
    {R(f'stddev_samp({c})', 'std')}, {R(f'CAST(min({c}) AS DOUBLE)', 'min')},
    {R(f'quantile_cont({c}, 0.25)', 'p25')}, {R(f'quantile_cont({c}, 0.5)', 'p50')},
    {R(f'quantile_cont({c}, 0.75)', 'p75')}, {R(f'CAST(max({c}) AS DOUBLE)', 'max')} FROM tab""" for c in NUM]
    return f"WITH {TAB_SQL} " + " UNION ALL ".join(parts)


@register("describe_columns", _describe_sql)
def describe_columns(spark, sf):
    """Eight-number description per numeric column."""
    return round_doubles(TB.describe(tab(spark, sf), NUM))


ALLC = ["id", "age", "driving_experience", "credit_score", "annual_mileage", "speeding_violations",
        "past_accidents", "vehicle_type", "married", "children", "outcome"]


@register("null_counts", lambda: f"WITH {TAB_SQL} " + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST(sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS nulls FROM tab" for c in ALLC))
def null_counts(spark, sf):
    """Null count per column."""
    return TB.null_counts(tab(spark, sf))


CORR = ["age", "driving_experience", "credit_score", "annual_mileage", "outcome"]


@register("corr_matrix", lambda: f"WITH {TAB_SQL} " + " UNION ALL ".join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr({a}, {b}), 6) AS corr FROM tab" for a in CORR for b in CORR))
def corr_matrix(spark, sf):
    """Pearson correlation matrix."""
    return round_doubles(TB.corr_matrix(tab(spark, sf), CORR))


@register("box_stats", f"""WITH {TAB_SQL},
q AS (SELECT vehicle_type, quantile_cont(annual_mileage, 0.25) AS q1, quantile_cont(annual_mileage, 0.5) AS median,
             quantile_cont(annual_mileage, 0.75) AS q3 FROM tab GROUP BY vehicle_type),
j AS (SELECT t.vehicle_type, t.annual_mileage AS x, q1, median, q3, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi
      FROM tab t JOIN q USING (vehicle_type))
SELECT vehicle_type, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
       round(min(CASE WHEN x >= lo THEN x END), 6) AS whisker_low, round(max(CASE WHEN x <= hi THEN x END), 6) AS whisker_high,
       CAST(sum(CASE WHEN x < lo OR x > hi THEN 1 ELSE 0 END) AS BIGINT) AS outliers
FROM j GROUP BY vehicle_type, q1, median, q3""")
def box_stats(spark, sf):
    """Box-plot statistics by group."""
    return round_doubles(TB.box_stats(tab(spark, sf), "vehicle_type", "annual_mileage"))


_FENCES = """q AS (SELECT vehicle_type, quantile_cont(annual_mileage, 0.25) AS q1, quantile_cont(annual_mileage, 0.75) AS q3 FROM tab GROUP BY vehicle_type)"""


@register("box_outliers", f"""WITH {TAB_SQL}, {_FENCES}
SELECT id, vehicle_type, round(annual_mileage, 6) AS annual_mileage FROM tab JOIN q USING (vehicle_type)
WHERE annual_mileage < q1 - 1.5 * (q3 - q1) OR annual_mileage > q3 + 1.5 * (q3 - q1)""")
def box_outliers(spark, sf):
    """The rows that a box plot draws apart."""
    return round_doubles(TB.box_outliers(tab(spark, sf).select("id", "vehicle_type", "annual_mileage"), "vehicle_type", "annual_mileage"))


@register("group_quartiles", f"""WITH {TAB_SQL}
SELECT married, round(quantile_cont(age, 0.25), 6) AS q1, round(quantile_cont(age, 0.5), 6) AS median, round(quantile_cont(age, 0.75), 6) AS q3
FROM tab GROUP BY married""")
def group_quartiles(spark, sf):
    """Quartiles inside each group's distribution."""
    return round_doubles(TB.group_quartiles(tab(spark, sf), "married", "age"))


@register("unit_histogram", f"""WITH {TAB_SQL},
m AS (SELECT min(past_accidents) AS a, max(past_accidents) AS b FROM tab)
SELECT CAST(v AS BIGINT) AS value, CAST(count(past_accidents) AS BIGINT) AS n
FROM (SELECT unnest(range(a, b + 1)) AS v FROM m) LEFT JOIN tab ON past_accidents = v GROUP BY v""")
def unit_histogram(spark, sf):
    """Bins of width one from the least to the greatest value."""
    return TB.unit_histogram(tab(spark, sf), "past_accidents")


@register("constant_columns", f"""WITH {TAB_SQL}
SELECT id, CASE WHEN (SELECT count(DISTINCT age) FROM tab WHERE age = 40) <= 1 THEN 0 ELSE age END AS age, driving_experience FROM tab WHERE age = 40""")
def constant_columns(spark, sf):
    """A column that is constant among the chosen rows becomes 0."""
    return TB.constant_to_zero(tab(spark, sf).where("age = 40").select("id", "age", "driving_experience"), "age", "driving_experience")


@register("group_histogram", f"""WITH {TAB_SQL},
m AS (SELECT min(age) AS mn, max(age) AS mx FROM tab)
SELECT married, CAST(least(floor((age - mn) / ((mx - mn) / 10.0)), 9) AS INTEGER) AS bin, CAST(count(*) AS BIGINT) AS n
FROM tab, m WHERE age IS NOT NULL GROUP BY ALL""")
def group_histogram(spark, sf):
    """Per-group distribution (violin data)."""
    return TB.group_histogram(tab(spark, sf), "married", "age", 10)


@register("regression_line", f"""WITH {TAB_SQL}
SELECT round(regr_slope(annual_mileage, age), 6) AS slope, round(regr_intercept(annual_mileage, age), 6) AS intercept,
       round(regr_r2(annual_mileage, age), 6) AS r2, CAST(regr_count(annual_mileage, age) AS BIGINT) AS n FROM tab""")
def regression_line(spark, sf):
    """Simple regression line of a scatter."""
    return round_doubles(TB.regression_line(tab(spark, sf), "annual_mileage", "age"))


@register("outcome_crosstab", f"""WITH {TAB_SQL}
SELECT past_accidents, CAST(count(*) AS BIGINT) AS n, round(100.0 * avg(CASE WHEN outcome = 1 THEN 1.0 ELSE 0.0 END), 6) AS pct_1
FROM tab GROUP BY past_accidents""")
def outcome_crosstab(spark, sf):
    """Cross-tab counts and percent of class 1."""
    return round_doubles(TB.outcome_crosstab(tab(spark, sf), "past_accidents"))


@register("majority_class", f"""WITH {TAB_SQL},
c AS (SELECT vehicle_type, outcome, CAST(count(*) AS BIGINT) AS n FROM tab GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY vehicle_type ORDER BY n DESC, outcome) AS rk FROM c)
SELECT vehicle_type, outcome, n FROM r WHERE rk = 1""")
def majority_class(spark, sf):
    """Majority class per group (smallest label on ties)."""
    return TB.majority_class(tab(spark, sf), ["vehicle_type"], "outcome")


@register("medians", f"""WITH {TAB_SQL}
SELECT {", ".join(f"round(quantile_cont({c}, 0.5), 6) AS {c}" for c in NUM)} FROM tab""")
def medians(spark, sf):
    """Column medians with linear interpolation."""
    return round_doubles(TB.medians(tab(spark, sf), NUM))


SEGS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@register("pivot_mean", f"""WITH {TAB_SQL}
SELECT married, {", ".join(f"round(avg(CASE WHEN vehicle_type = '{s}' THEN credit_score END), 6) AS {s}" for s in SEGS)}
FROM tab GROUP BY married""")
def pivot_mean(spark, sf):
    """Two-way pivot of a mean."""
    return round_doubles(TB.pivot_mean(tab(spark, sf), "married", "vehicle_type", "credit_score", SEGS))


@register("best_group", f"""WITH {TAB_SQL},
g AS (SELECT vehicle_type, avg(credit_score) AS mean_score FROM tab GROUP BY vehicle_type)
SELECT vehicle_type, round(mean_score, 6) AS mean_score FROM g ORDER BY mean_score DESC LIMIT 1""")
def best_group(spark, sf):
    """Mean metric per parameter, then the best one."""
    g = tab(spark, sf).groupBy("vehicle_type").agg(F.avg("credit_score").alias("mean_score"))
    return round_doubles(TB.best_by(g, "mean_score"))


@register("driving_age_fix", f"""WITH {TAB_SQL}
SELECT id, age, CASE WHEN age - driving_experience < 16 THEN age - 16 ELSE driving_experience END AS driving_experience FROM tab""")
def driving_age_fix(spark, sf):
    """Repair implied licence age."""
    return TB.fix_driving_age(tab(spark, sf)).select("id", "age", "driving_experience")


@register("risk_bands", f"""WITH {TAB_SQL},
x AS (SELECT id, age, driving_experience, speeding_violations, past_accidents, annual_mileage, married, children,
             CASE WHEN age <= 30 THEN 'young' WHEN age <= 60 THEN 'grown-up' ELSE 'old' END AS age_text,
             CASE WHEN age <= 24 THEN 3 WHEN age <= 65 THEN 1 ELSE 2 END AS age_weight,
             CASE WHEN driving_experience <= 2 THEN 'new' WHEN driving_experience <= 8 THEN 'regular' ELSE 'senior' END AS exp_text,
             CASE WHEN driving_experience <= 2 THEN 3 WHEN driving_experience <= 8 THEN 2 ELSE 1 END AS exp_weight FROM tab)
SELECT id, age_text, age_weight, exp_text, exp_weight,
       round(0.4::DOUBLE * speeding_violations + 0.4::DOUBLE * past_accidents + 0.2::DOUBLE * driving_experience, 6) AS risk_v1,
       CASE WHEN 0.4::DOUBLE * speeding_violations + 0.4::DOUBLE * past_accidents + 0.2::DOUBLE * exp_weight * age_weight <= 4 THEN 1
            WHEN 0.4::DOUBLE * speeding_violations + 0.4::DOUBLE * past_accidents + 0.2::DOUBLE * exp_weight * age_weight <= 6 THEN 2 ELSE 3 END AS risk_v2_band,
       round(annual_mileage / (1 + driving_experience), 6) AS mileage_experience_ratio,
       round(driving_experience / (1 + past_accidents), 6) AS experience_quality,
       concat_ws('_', children, married) AS family_key
FROM x""")
def risk_bands(spark, sf):
    """Risk indices, threshold bands, ratios, category key."""
    t = tab(spark, sf)
    x = t.select("*", TB.band("age", *TB.AGE_TEXT).alias("age_text"), TB.band("age", *TB.AGE_WEIGHT).alias("age_weight"),
                 TB.band("driving_experience", *TB.EXP_TEXT).alias("exp_text"),
                 TB.band("driving_experience", *TB.EXP_WEIGHT).alias("exp_weight"))
    x = TB.ratios(TB.risk_index_v1(x))
    v2 = 0.4 * F.col("speeding_violations") + 0.4 * F.col("past_accidents") + 0.2 * F.col("exp_weight") * F.col("age_weight")
    x = x.select("id", "age_text", "age_weight", "exp_text", "exp_weight", F.col("driver_risk_index").alias("risk_v1"),
                 TB.band(v2, *TB.RISK_BAND).alias("risk_v2_band"), "mileage_experience_ratio", "experience_quality",
                 TB.category_key("children", "married").alias("family_key"))
    return round_doubles(x)


@register("category_codes", f"""WITH {TAB_SQL},
f AS (SELECT vehicle_type, min(id) AS first_id FROM tab GROUP BY vehicle_type)
SELECT vehicle_type, CAST(dense_rank() OVER (ORDER BY first_id) - 1 AS INTEGER) AS vehicle_type_code FROM f""")
def category_codes(spark, sf):
    """First-appearance integer codes."""
    return TB.first_appearance_codes(tab(spark, sf), "vehicle_type", "id")


def _qb_sql(col, out, n=3, log=False):
    x, pre = col, ""
    if log:
        pre = f", mn AS (SELECT min({col}) AS m FROM tab)"
        x = f"ln(CASE WHEN (SELECT m FROM mn) <= 0 THEN {col} + abs((SELECT m FROM mn)) + 1 ELSE {col} END)"
    return f"""WITH {TAB_SQL} {pre},
v AS (SELECT list(CAST(x AS DOUBLE) ORDER BY x) AS l, least({n}, count(DISTINCT x)) AS bins FROM (SELECT {x} AS x FROM tab WHERE {col} IS NOT NULL)),
k AS (SELECT k, l, pos, CAST(floor(pos) AS BIGINT) + 1 AS i, CAST(ceil(pos) AS BIGINT) + 1 AS j, pos - floor(pos) AS w
      FROM (SELECT l, k, (k * (100.0::DOUBLE / bins)) / 100 * (len(l) - 1) AS pos FROM (SELECT l, bins, unnest(range(bins + 1)) AS k FROM v WHERE bins > 1))),
ends AS (SELECT k, CASE WHEN w < 0.5 THEN l[i] + (l[j] - l[i]) * w ELSE l[j] - (l[j] - l[i]) * (1 - w) END AS high FROM k),
apart AS (SELECT k, high FROM (SELECT *, lag(high) OVER (ORDER BY k) AS before FROM ends) WHERE high - before > 1e-8),
inner_edges AS (SELECT coalesce(list(high), []) AS e FROM apart WHERE k < (SELECT max(k) FROM apart))
SELECT id, CASE WHEN x IS NOT NULL THEN CAST(len(list_filter(e, lambda h: x >= h)) AS INTEGER) END AS {out} FROM (SELECT id, {x} AS x FROM tab), inner_edges"""


@register("quantile_bins", lambda: _qb_sql("credit_score", "credit_bin"))
def quantile_bins(spark, sf):
    """Three quantile bins (value on an edge goes up)."""
    t = tab(spark, sf)
    return TB.quantile_bin(t, "credit_score", "credit_bin").select("id", "credit_bin")


@register("log_quantile_bins", lambda: _qb_sql("speeding_violations", "violation_bin", log=True))
def log_quantile_bins(spark, sf):
    """F2 + T24: quantile bins of the shifted log."""
    t = tab(spark, sf)
    return TB.quantile_bin_log(t, "speeding_violations", "violation_bin").select("id", "violation_bin")


@register("uniform_bins", f"""WITH {TAB_SQL},
m AS (SELECT min(age) AS mn, max(age) AS mx FROM tab)
SELECT id, ['Low', 'Medium', 'High'][1 + (CASE WHEN age >= mn + (mx - mn) / 3.0 THEN 1 ELSE 0 END)
       + (CASE WHEN age >= mn + 2 * (mx - mn) / 3.0 THEN 1 ELSE 0 END)] AS age_band FROM tab, m""")
def uniform_bins(spark, sf):
    """equal-width bins to Low / Medium / High."""
    return TB.uniform_bin(tab(spark, sf), "age", "age_band", 3, ["Low", "Medium", "High"]).select("id", "age_band")


@register("minmax_scaled", f"""WITH {TAB_SQL},
m AS (SELECT min(age) AS a0, max(age) AS a1, min(annual_mileage) AS m0, max(annual_mileage) AS m1 FROM tab)
SELECT id, round((age - a0) / (a1 - a0), 6) AS age, round((annual_mileage - m0) / (m1 - m0), 6) AS annual_mileage FROM tab, m""")
def minmax_scaled(spark, sf):
    """min-max scaling (fitted on the rows it is applied to here)."""
    t = tab(spark, sf).select("id", "age", "annual_mileage")
    return round_doubles(TB.minmax_apply(t, TB.minmax_fit(t, ["age", "annual_mileage"])))


def _knn_sql():
    def one(target, other):
        return f"""
r_{target} AS (SELECT id, {other} AS x FROM tab WHERE {target} IS NULL AND {other} IS NOT NULL),
d_{target} AS (SELECT id AS did, {target} AS v, {other} AS x FROM tab WHERE {target} IS NOT NULL AND {other} IS NOT NULL),
k_{target} AS (SELECT r.id, d.v, row_number() OVER (PARTITION BY r.id ORDER BY sqrt(2.0 * (r.x - d.x) * (r.x - d.x)), d.did) AS rk
               FROM r_{target} r, d_{target} d),
f_{target} AS (SELECT id, avg(v) AS fill FROM k_{target} WHERE rk <= 5 GROUP BY id)"""
    return f"""WITH {TAB_SQL}, {one('credit_score', 'annual_mileage')}, {one('annual_mileage', 'credit_score')},
mean AS (SELECT avg(credit_score) AS mc, avg(annual_mileage) AS mm FROM tab)
SELECT t.id, round(coalesce(t.credit_score, fc.fill, mean.mc), 6) AS credit_score,
       round(coalesce(t.annual_mileage, fm.fill, mean.mm), 6) AS annual_mileage
FROM tab t LEFT JOIN f_credit_score fc ON fc.id = t.id LEFT JOIN f_annual_mileage fm ON fm.id = t.id, mean"""


@register("knn_impute", _knn_sql)
def knn_impute(spark, sf):
    """Exact KNN imputation (5 donors, nan-Euclidean)."""
    t = tab(spark, sf)
    out = TB.knn_impute(t, "id", ["credit_score", "annual_mileage"])
    return round_doubles(out.select("id", "credit_score", "annual_mileage"))


THREE = {"credit_score": "credit_score", "annual_mileage": "annual_mileage", "driving_experience": "CASE WHEN id % 5 <> 0 THEN driving_experience END"}


def _knn3_sql():
    """All pairs, from the definition of the distance."""
    cols = list(THREE)
    ctes = [TAB_SQL, "t3 AS (SELECT id, " + ", ".join(f"CAST({e} AS DOUBLE) AS {c}" for c, e in THREE.items()) + " FROM tab)"]
    for t in cols:
        a, b = [c for c in cols if c != t]
        seen = {c: f"(r.{c} IS NOT NULL AND d.{c} IS NOT NULL)" for c in (a, b)}
        parts = " + ".join(f"CASE WHEN {seen[c]} THEN (r.{c} - d.{c}) * (r.{c} - d.{c}) ELSE 0 END" for c in (a, b))
        n = " + ".join(f"CAST({seen[c]} AS INTEGER)" for c in (a, b))
        ctes.append(f"""k_{t} AS (SELECT id, avg(v) AS fill FROM (
  SELECT r.id, d.{t} AS v, row_number() OVER (PARTITION BY r.id ORDER BY sqrt(({parts}) * 3.0 / ({n})), d.id) AS k
  FROM t3 r, t3 d WHERE r.{t} IS NULL AND d.{t} IS NOT NULL AND ({n}) > 0) WHERE k <= 5 GROUP BY id)""")
    out = ", ".join(f"round(coalesce(t3.{c}, (SELECT fill FROM k_{c} WHERE k_{c}.id = t3.id), (SELECT avg({c}) FROM t3)), 6) AS {c}" for c in cols)
    return f"WITH {', '.join(ctes)} SELECT t3.id, {out} FROM t3"


@register("knn_impute_three", _knn3_sql)
def knn_impute_three(spark, sf):
    """KNN imputation over three columns with mixed nulls, so donors
    and receivers share one or two coordinates."""
    t = tab(spark, sf).select("id", *[F.expr(e).cast("double").alias(c) for c, e in THREE.items()])
    return round_doubles(TB.knn_impute(t, "id", list(THREE)).select("id", *THREE))


@register("train_test_split", f"""WITH {TAB_SQL}
SELECT id, CASE WHEN id * 7 % 100 < 80 THEN 'train' ELSE 'test' END AS part FROM tab""")
def train_test_split(spark, sf):
    """Deterministic split by an arithmetic key; test is the complement."""
    train, test = TB.hash_split(tab(spark, sf), "id", percentile=F.pmod(F.col("id") * 7, F.lit(100)))
    return train.select("id", F.lit("train").alias("part")).unionByName(test.select("id", F.lit("test").alias("part")))


def _bins_ctes(name, source, col, n=3, log=False):
    """``qe_name``: the inner quantile edges (one list) of ``x``, the column of
    ``source`` or its shifted log; ``qx_name``: id and x;
    ``qb_name``: id and bin."""
    shift = f"(SELECT CASE WHEN min({col}) <= 0 THEN abs(min({col})) + 1 ELSE 0 END FROM {source})"
    return f"""
qx_{name} AS (SELECT id, CAST({f"ln({col} + {shift})" if log else col} AS DOUBLE) AS x FROM {source}),
qv_{name} AS (SELECT list(x ORDER BY x) AS l, least({n}, count(DISTINCT x)) AS bins FROM qx_{name} WHERE x IS NOT NULL),
qk_{name} AS (SELECT k, l, pos, CAST(floor(pos) AS BIGINT) + 1 AS i, CAST(ceil(pos) AS BIGINT) + 1 AS j, pos - floor(pos) AS w
      FROM (SELECT l, k, (k * (100.0::DOUBLE / bins)) / 100 * (len(l) - 1) AS pos FROM (SELECT l, bins, unnest(range(bins + 1)) AS k FROM qv_{name} WHERE bins > 1))),
qa_{name} AS (SELECT k, high FROM (SELECT *, lag(high) OVER (ORDER BY k) AS before FROM
      (SELECT k, CASE WHEN w < 0.5 THEN l[i] + (l[j] - l[i]) * w ELSE l[j] - (l[j] - l[i]) * (1 - w) END AS high FROM qk_{name})) WHERE high - before > 1e-8),
qe_{name} AS (SELECT coalesce(list(high), []) AS e FROM qa_{name} WHERE k < (SELECT max(k) FROM qa_{name})),
qb_{name} AS (SELECT id, CASE WHEN x IS NOT NULL THEN CAST(len(list_filter(e, lambda h: x >= h)) AS INTEGER) END AS bin FROM qx_{name}, qe_{name})"""


def _insurance_sql():
    """The chain step by step, each step over the table of the one before."""
    knn = _knn_sql()
    filled = knn.index("SELECT t.id, round(")
    codes = ["vehicle_type", "married", "children"]
    coded = ", ".join(f"c_{c} AS (SELECT {c}, CAST(dense_rank() OVER (ORDER BY min(id)) - 1 AS INTEGER) AS code FROM tab GROUP BY {c})" for c in codes)
    bins = [("credit_score", "credit_score", False), ("mileage_experience_ratio", "mileage_experience_ratio", True), ("annual_mileage", "annual_mileage", False),
            ("experience_quality", "experience_quality", True), ("speeding_violations", "speeding_violations", True), ("past_accidents", "past_accidents", True)]
    return f"""{knn[:filled].rstrip()},
filled AS (SELECT t.* EXCLUDE (credit_score, annual_mileage), coalesce(t.credit_score, fc.fill, mean.mc) AS credit_score,
                  coalesce(t.annual_mileage, fm.fill, mean.mm) AS annual_mileage
           FROM tab t LEFT JOIN f_credit_score fc ON fc.id = t.id LEFT JOIN f_annual_mileage fm ON fm.id = t.id, mean),
fixed AS (SELECT * REPLACE (CASE WHEN age - driving_experience < 16 THEN age - 16 ELSE driving_experience END AS driving_experience) FROM filled),
{coded},
ratios AS (SELECT *, annual_mileage / (1 + driving_experience) AS mileage_experience_ratio, driving_experience / (1 + past_accidents) AS experience_quality,
                  CASE WHEN age <= 24 THEN 3 WHEN age <= 65 THEN 1 ELSE 2 END AS aw, CASE WHEN driving_experience <= 2 THEN 3 WHEN driving_experience <= 8 THEN 2 ELSE 1 END AS ew FROM fixed),
{", ".join(_bins_ctes(n, "ratios", c, log=log).strip() for n, c, log in bins)}
SELECT r.id, aw AS age, ew AS driving_experience, {", ".join(f"qb_{n}.bin AS {n}" for n, _, _ in bins)}, {", ".join(f"c_{c}.code AS {c}" for c in codes)}, outcome,
       CASE WHEN risk <= 4 THEN 1 WHEN risk <= 6 THEN 2 ELSE 3 END AS driver_risk_index
FROM (SELECT *, 0.4::DOUBLE * speeding_violations + 0.4::DOUBLE * past_accidents + 0.2::DOUBLE * ew * aw AS risk FROM ratios) r
{" ".join(f"JOIN qb_{n} ON qb_{n}.id = r.id" for n, _, _ in bins)} {" ".join(f"JOIN c_{c} ON c_{c}.{c} IS NOT DISTINCT FROM r.{c}" for c in codes)}"""


@register("insurance_features", _insurance_sql)
def insurance_features(spark, sf):
    """full insurance pre-processing chain."""
    return TB.insurance_features(tab(spark, sf))
