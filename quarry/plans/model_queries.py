"""Regression (R1-R13) queries over the price feature frame, plus ML."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions.text import round_doubles
from quarry.operators import ols as O
from quarry.operators import series as X
from quarry.plans import series_queries as SQ
from quarry.plans.catalog import register
from quarry.sources import prices as P

WINDOW = ("1996-01-01", "2000-12-31")
BASE_X = (["rsi", "pe", "log_return", "volatility", "daily_trend", "quarter", "csad"]
          + [f"delta_volume_{i}_days_back" for i in range(1, 11)])
Y = "volume"


def regression_frame(spark, sf):
    """P3 window over the feature frame with merged deltas."""
    f = X.price_features(P.prices(spark, sf), P.eps(spark, sf), P.betas(spark))
    f = X.merged_deltas(f)
    lo, hi = WINDOW
    return f.filter(F.col("date").between(F.to_date(F.lit(lo)), F.to_date(F.lit(hi)))).checkpoint(eager=True)


def _fit(spark, sf, cov="HC3", cols=None):
    df = regression_frame(spark, sf)
    cols = cols or BASE_X
    g = O.gram(df, cols, Y)
    f = O.fit_from_gram(g, Y, cols)
    if cov == "HC3":
        f = O.hc3(df, f)
    return df, g, f


@register("regression_fit")
def regression_fit(spark, sf):
    """OLS with HC3 errors; coefficient table."""
    _, _, f = _fit(spark, sf)
    return spark.createDataFrame(O.coef_table(f), "term string, coef double, std_err double, z double, p_value double, "
                                                  "ci_low double, ci_high double")


@register("regression_equation", f"SELECT '{Y} = b0' || {' || '.join(repr(f' + b{i} * {x}') for i, x in enumerate(BASE_X, 1))} AS equation")
def regression_equation(spark, sf):
    """General equation text of the fitted model."""
    _, _, f = _fit(spark, sf, cov=None)
    terms = spark.createDataFrame([(i, r[0]) for i, r in enumerate(O.coef_table(f))], "position int, term string")
    return O.equation(terms, Y)


@register("regression_single", lambda: f"""WITH {SQ.feat_sql()},
f AS (SELECT * FROM feat WHERE {SQ._notnull_sql(SQ.FEATURE_COLS)} AND date BETWEEN DATE '{WINDOW[0]}' AND DATE '{WINDOW[1]}')
SELECT round(regr_intercept(volume, csad), 4) AS intercept, round(regr_slope(volume, csad), 4) AS slope,
       round(regr_r2(volume, csad), 6) AS r_squared, CAST(count(*) AS BIGINT) AS n FROM f""")
def regression_single(spark, sf):
    """R1 + R4 (one predictor): Gram-matrix OLS checked against regr_*."""
    df = regression_frame(spark, sf)
    g = O.gram(df, ["csad"], Y)
    f = O.fit_from_gram(g, Y, ["csad"])
    st = O.summary_stats(f)
    return spark.createDataFrame([(round(float(f.beta[0]), 4), round(float(f.beta[1]), 4),
                                   round(st["r_squared"], 6), int(f.n))],
                                 "intercept double, slope double, r_squared double, n bigint")


@register("residuals", lambda: f"""WITH {SQ.feat_sql()},
f AS (SELECT * FROM feat WHERE {SQ._notnull_sql(SQ.FEATURE_COLS)} AND date BETWEEN DATE '{WINDOW[0]}' AND DATE '{WINDOW[1]}'),
c AS (SELECT regr_intercept(volume, csad) AS b0, regr_slope(volume, csad) AS b1 FROM f)
SELECT date, round(b0 + b1 * csad, 3) AS fitted, round(volume - (b0 + b1 * csad), 3) AS resid FROM f, c""")
def residuals(spark, sf):
    """Fitted values and residuals per row (single predictor)."""
    df = regression_frame(spark, sf)
    f = O.fit_from_gram(O.gram(df, ["csad"], Y), Y, ["csad"])
    return df.select("date", F.round(O.fitted_expr(f), 3).alias("fitted"),
                     F.round(O._resid_expr(f), 3).alias("resid"))


def _single() -> str:
    return f"""{SQ.feat_sql()},
f AS (SELECT * FROM feat WHERE {SQ._notnull_sql(SQ.FEATURE_COLS)} AND date BETWEEN DATE '{WINDOW[0]}' AND DATE '{WINDOW[1]}'),
c AS (SELECT regr_intercept(volume, csad) AS b0, regr_slope(volume, csad) AS b1, avg(csad) AS mx, regr_sxx(volume, csad) AS sxx, count(*) AS n FROM f),
r AS (SELECT date, volume - (b0 + b1 * csad) AS e FROM f, c)"""


@register("regression_table_single", lambda: f"""WITH {_single()},
s AS (SELECT sum(e * e) / (max(n) - 2) AS s2 FROM r, c)
SELECT 'Intercept' AS term, round(b0, 4) AS coef, round(sqrt(s2 * (1.0 / n + mx * mx / sxx)), 4) AS std_err, round(b0 / sqrt(s2 * (1.0 / n + mx * mx / sxx)), 4) AS t FROM c, s
UNION ALL SELECT 'csad', round(b1, 4), round(sqrt(s2 / sxx), 4), round(b1 / sqrt(s2 / sxx), 4) FROM c, s""")
def regression_table_single(spark, sf):
    """R2: coefficients, standard errors and t of the non-robust fit (one predictor)."""
    df = regression_frame(spark, sf)
    f = O.fit_from_gram(O.gram(df, ["csad"], Y), Y, ["csad"])
    return spark.createDataFrame([(r[0], *(round(v, 4) for v in r[1:4])) for r in O.coef_table(f)], "term string, coef double, std_err double, t double")


@register("residual_diagnostics", lambda: f"""WITH {_single()},
d AS (SELECT e, e - lag(e) OVER (ORDER BY date) AS de FROM r),
m AS (SELECT count(*) AS n, sum(de * de) / sum(e * e) AS dw, avg(e) AS mu FROM d),
k AS (SELECT avg((e - mu) ** 2) AS m2, avg((e - mu) ** 3) AS m3, avg((e - mu) ** 4) AS m4 FROM d, m),
x AS (SELECT n, dw, m3 / m2 ** 1.5 AS skew, m4 / m2 ** 2 AS kurt FROM m, k)
SELECT round(dw, 6) AS durbin_watson, round(skew, 6) AS skew, round(kurt, 6) AS kurtosis, round(n / 6.0 * (skew ** 2 + (kurt - 3) ** 2 / 4), 4) AS jarque_bera FROM x""")
def residual_diagnostics(spark, sf):
    """R9 + W8: Durbin-Watson by the residual before, skewness, kurtosis, Jarque-Bera (one predictor)."""
    df = regression_frame(spark, sf)
    d = O.residual_diagnostics(df, O.fit_from_gram(O.gram(df, ["csad"], Y), Y, ["csad"]))
    return spark.createDataFrame([(*(round(d[c], 6) for c in ("durbin_watson", "skew", "kurtosis")), round(d["jarque_bera"], 4))],
                                 "durbin_watson double, skew double, kurtosis double, jarque_bera double")


@register("vif_pair", lambda: f"""WITH {_single()},
v AS (SELECT 1 / (1 - corr(csad, volatility) ** 2) AS vif FROM f)
SELECT unnest(['csad', 'volatility']) AS feature, round(vif, 6) AS vif FROM v""")
def vif_pair(spark, sf):
    """Variance inflation of two predictors."""
    df = regression_frame(spark, sf)
    rows = O.vif(O.gram(df, ["csad", "volatility"], Y), ["csad", "volatility"])
    return spark.createDataFrame([(n, round(v, 6)) for n, v in rows if n != "Intercept"], "feature string, vif double")


@register("regression_summary")
def regression_summary(spark, sf):
    """Fit statistics, residual diagnostics, Breusch-Pagan."""
    df, _, f = _fit(spark, sf)
    st = O.summary_stats(f)
    st.update(O.residual_diagnostics(df, f))
    st.update({f"bp_{k}": v for k, v in O.breusch_pagan(df, f).items()})
    rows = [(k, float(v)) for k, v in st.items()]
    return spark.createDataFrame(rows, "metric string, value double")


@register("anova")
def anova(spark, sf):
    """Type-II ANOVA with explained share, sorted."""
    _, _, f = _fit(spark, sf, cov="nonrobust")
    return spark.createDataFrame(O.anova_type2(f), "term string, sum_sq double, df double, F double, "
                                                   "p_value double, explained_pct double")


@register("backward_selection")
def backward_selection(spark, sf):
    """Backward elimination steps (HC3 p-values)."""
    df, g, _ = _fit(spark, sf, cov="nonrobust")
    _, steps = O.backward_selection(df, g, Y, BASE_X, "HC3")
    return spark.createDataFrame(steps, "step int, action string, variable string, p_value double, n_vars int")


@register("vif")
def vif(spark, sf):
    """Variance inflation factors incl. the intercept."""
    _, g, _ = _fit(spark, sf, cov="nonrobust")
    return spark.createDataFrame(O.vif(g, BASE_X), "feature string, vif double")


@register("qq_points")
def qq_points(spark, sf):
    """Normal Q-Q pairs of the residuals."""
    df, _, f = _fit(spark, sf, cov="nonrobust")
    return O.qq_points(df, f)


APPROACHES = {
    "individual_deltas": BASE_X,
    "sum_delta": [c for c in BASE_X if not c.startswith("delta_volume_")] + ["delta_volume_sum"],
    "weighted_delta": [c for c in BASE_X if not c.startswith("delta_volume_")] + ["delta_volume_weighted"],
    "avg_delta": [c for c in BASE_X if not c.startswith("delta_volume_")] + ["delta_volume_avg"],
    "short_long_delta": [c for c in BASE_X if not c.startswith("delta_volume_")]
    + ["delta_volume_short_term", "delta_volume_long_term"],
    "no_deltas": [c for c in BASE_X if not c.startswith("delta_volume_")],
    "sum_2_5_deltas": [c for c in BASE_X if c not in ("delta_volume_2_days_back", "delta_volume_5_days_back")]
    + ["delta_volume_sum_2_5"],
    "sum_9_10_deltas": [c for c in BASE_X if c not in ("delta_volume_9_days_back", "delta_volume_10_days_back")]
    + ["delta_volume_sum_9_10"],
    "sum_2_5_9_10_deltas": [c for c in BASE_X if c not in ("delta_volume_2_days_back", "delta_volume_5_days_back",
                                                          "delta_volume_9_days_back", "delta_volume_10_days_back")]
    + ["delta_volume_sum_2_5", "delta_volume_sum_9_10"],
}


@register("delta_comparison")
def delta_comparison(spark, sf):
    """Nine delta feature sets from one superset Gram pass (HC3 pass
    per set for the significance count)."""
    df = regression_frame(spark, sf)
    allc = sorted({c for v in APPROACHES.values() for c in v})
    g = O.gram(df, allc, Y)
    rows = []
    for name, cols in APPROACHES.items():
        f = O.hc3(df, O.fit_from_gram(g, Y, cols))
        st = O.summary_stats(f)
        sig = sum(1 for r in O.coef_table(f) if r[0] != "Intercept" and r[4] <= 0.05)
        rows.append((name, float(st["r_squared"]), float(st["adj_r_squared"]), float(st["aic"]),
                     float(st["bic"]), len(cols), int(sig)))
    return round_doubles(spark.createDataFrame(
        rows, "approach string, r_squared double, adj_r_squared double, aic double, bic double, "
              "num_features int, significant_vars int"))


# ---- machine learning on TAB / VEC ----------------------------------------

from quarry.operators import ml as ML  # noqa: E402
from quarry.operators import tabular as TB  # noqa: E402
from quarry.plans.tab_sql import TAB_SQL  # noqa: E402
from quarry.session import table  # noqa: E402
from quarry.sources.tabular import tab  # noqa: E402

RULE_PRED = "CASE WHEN past_accidents >= 3 THEN 1 ELSE 0 END"


def _rule_pred(spark, sf):
    """A transparent rule classifier (so metrics are SQL-checkable)."""
    t = tab(spark, sf)
    return t.select("id", F.col("outcome").alias("label"),
                    F.when(F.col("past_accidents") >= 3, 1).otherwise(0).alias("prediction"))


@register("prediction_accuracy", f"""WITH {TAB_SQL}
SELECT round(avg(CASE WHEN outcome = {RULE_PRED} THEN 1.0 ELSE 0.0 END), 6) AS accuracy,
       round(1 - avg(CASE WHEN outcome = {RULE_PRED} THEN 1.0 ELSE 0.0 END), 6) AS error_rate,
       CAST(count(*) AS BIGINT) AS n FROM tab""")
def prediction_accuracy(spark, sf):
    """ML15: accuracy / error rate of a prediction column."""
    return round_doubles(ML.accuracy(_rule_pred(spark, sf)))


@register("confusion_matrix", f"""WITH {TAB_SQL}
SELECT outcome AS label, CAST(sum(CASE WHEN {RULE_PRED} = 0 THEN 1 ELSE 0 END) AS BIGINT) AS "0",
       CAST(sum(CASE WHEN {RULE_PRED} = 1 THEN 1 ELSE 0 END) AS BIGINT) AS "1" FROM tab GROUP BY outcome""")
def confusion_matrix(spark, sf):
    """ML11: confusion matrix."""
    return ML.confusion(_rule_pred(spark, sf))


@register("classification_report", f"""WITH {TAB_SQL},
p AS (SELECT outcome AS y, {RULE_PRED} AS p FROM tab),
cl AS (SELECT DISTINCT y AS c FROM p UNION SELECT DISTINCT p FROM p),
r AS (SELECT c, (SELECT count(*) FROM p WHERE y = c AND p = c) AS tp, (SELECT count(*) FROM p WHERE y = c) AS support,
             (SELECT count(*) FROM p WHERE p = c) AS pred_n FROM cl),
r2 AS (SELECT CAST(c AS VARCHAR) AS class, CASE WHEN pred_n > 0 THEN tp / pred_n ELSE 0.0 END AS precision,
              CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS recall, CAST(support AS BIGINT) AS support FROM r),
r3 AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1 FROM r2)
SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall, support, round(f1, 6) AS f1 FROM r3
UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), CAST(sum(support) AS BIGINT), round(avg(f1), 6) FROM r3
UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6), round(sum(recall * support) / sum(support), 6),
       CAST(sum(support) AS BIGINT), round(sum(f1 * support) / sum(support), 6) FROM r3""")
def classification_report(spark, sf):
    """ML10 + ML12: per-class precision / recall / F1 and averages."""
    return round_doubles(ML.class_report(_rule_pred(spark, sf)))


def _ml_frame(spark, sf):
    t = TB.knn_impute(tab(spark, sf), "id", ["credit_score", "annual_mileage"])
    t = TB.encode_categories(t, ["vehicle_type", "married", "children"], "id")
    t = t.withColumn("label", F.col("outcome").cast("double")).drop("outcome")
    a, cols = ML.assemble(t, "label", exclude=["id"])
    return a.checkpoint(eager=True), cols


@register("tree_grid")
def tree_grid(spark, sf):
    """ML1 + ML3 + ML4 + ML13: tree sweep (splitter x depth x criterion), the
    best combination, and its feature importances from the greatest down."""
    a, cols = _ml_frame(spark, sf)
    train, test = TB.hash_split(a, "id", 80)
    rows, best = ML.tree_grid(train, "label", list(range(2, 11)), ["gini", "entropy"], ["best", "random"])
    imp = sorted(zip(cols, best.featureImportances.toArray().tolist()), key=lambda x: (-x[1], x[0]))
    top = max(rows, key=lambda r: r[3])
    out = [("grid", *r, None, None, r == top, None) for r in rows]
    out += [("importance", None, None, None, None, c, float(v), None, i) for i, (c, v) in enumerate(imp, 1)]
    return spark.createDataFrame(out, "kind string, splitter string, max_depth int, impurity string, accuracy double, "
                                      "feature string, importance double, best boolean, place int")


#: Splits that are fitted at a time, so that the tasks of one fill the gaps of another.
STUDY_JOBS = 6


@register("split_ratio_study")
def split_ratio_study(spark, sf):
    """ML2 + A29: mean accuracy per train ratio over repeated seeded splits."""
    from multiprocessing.pool import ThreadPool

    from pyspark import inheritable_thread_target
    from pyspark.ml.classification import DecisionTreeClassifier
    a, _ = _ml_frame(spark, sf)

    def one(case):
        ratio, rep = case
        tr, te = a.randomSplit([ratio, 1 - ratio], seed=rep)
        m = DecisionTreeClassifier(labelCol="label", maxDepth=5, seed=42).fit(tr)
        acc = ML.accuracy(m.transform(te)).first()["accuracy"]
        return round(ratio, 1), rep, float(acc)
    with ThreadPool(STUDY_JOBS) as jobs:
        rows = jobs.map(inheritable_thread_target(spark)(one), [(0.1 * i, rep) for i in range(1, 10) for rep in range(10)], chunksize=1)
    df = spark.createDataFrame(rows, "ratio double, repeat int, accuracy double")
    mean = df.groupBy("ratio").agg(F.avg("accuracy").alias("mean_accuracy"))
    top = TB.best_by(mean, "mean_accuracy").select(F.col("ratio").alias("best_ratio"))  # ML13: one row
    return mean.crossJoin(F.broadcast(top)).select("ratio", "mean_accuracy", (F.col("ratio") == F.col("best_ratio")).alias("best"))


HIDDEN = [[50, 50], [50, 50, 50], [100, 100], [100, 100, 100]]


@register("mlp_grid")
def mlp_grid(spark, sf):
    """ML5 + ML6 + F9: MLP grid (hidden layers x iterations) with 3-fold CV on
    min-max scaled features (scaler fitted on train only); the best model on the
    test rows."""
    a, cols = _ml_frame(spark, sf)
    train, test = TB.hash_split(a, "id", 80)
    sc = ML.scale_fit(train)
    rows, best = ML.mlp_grid(sc.transform(train), "label", len(cols), HIDDEN, [200, 400])
    acc = ML.accuracy(best.transform(sc.transform(test))).first()["accuracy"]
    rows.append(("best_on_test", 0, float(acc)))
    return spark.createDataFrame(rows, "layers string, max_iter int, accuracy double")


@register("mlp_target")
def mlp_target(spark, sf):
    """ML14: the column ``target`` that a trained network predicts for rows it
    has not seen; their outcome is never read."""
    a, cols = _ml_frame(spark, sf)
    train, test = TB.hash_split(a, "id", 80)
    sc = ML.scale_fit(train)
    return ML.predict_target(sc.transform(train), sc.transform(test.drop("label")), len(cols), HIDDEN[0], "label", "id")


@register("svm_grid")
def svm_grid(spark, sf):
    """ML9 + ML13: 5-fold F1 over kernel x C x gamma, and which row is best."""
    a, cols = _ml_frame(spark, sf)
    train, _ = TB.hash_split(a, "id", 80)
    sc = ML.scale_fit(train)
    rows = ML.svm_grid(sc.transform(train), "label", len(cols), ["linear", "rbf", "poly"], [0.1, 1.0, 10.0], [0.01, 0.1])
    top = max(rows, key=lambda r: r[3])
    return spark.createDataFrame([(*r, r == top) for r in rows], "kernel string, c double, gamma double, f1 double, best boolean")


def _vec(spark, sf):
    from pyspark.ml.functions import array_to_vector
    e = table(spark, sf, "embeddings")
    return e.select("vec_id", F.col("label"), array_to_vector(F.col("embedding").cast("array<double>")).alias("features"))


@register("kmeans_clusters")
def kmeans_clusters(spark, sf):
    """ML7 + ML8 + A25: KMeans(k=2) relabelled by majority class; cluster
    vs class distribution."""
    p = ML.kmeans_relabel(_vec(spark, sf), "label", 2, 42)
    return p.groupBy("prediction", "cluster_label", "label").agg(F.count("*").alias("n"))


@register("pca_projection")
def pca_projection(spark, sf):
    """F16: 2-component PCA of the embeddings with explained variance."""
    p, ev = ML.pca2(_vec(spark, sf))
    from pyspark.ml.functions import vector_to_array
    out = p.select("vec_id", vector_to_array("pca").alias("pc"))
    return out.select("vec_id", F.col("pc")[0].alias("pc1"), F.col("pc")[1].alias("pc2"),
                      F.lit(ev[0]).alias("explained_1"), F.lit(ev[1]).alias("explained_2"))
