"""Regression diagnostics (R2-R10, R12) and PCA against numpy, from their definitions."""

import math
from statistics import NormalDist

import numpy as np
import pytest

from quarry.operators import ml, ols

NAMES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(11)
    x = rng.normal(size=(150, 3))
    x[:, 2] = 0.8 * x[:, 0] + 0.3 * x[:, 2]
    y = 2 + 1.5 * x[:, 0] - 0.7 * x[:, 1] + rng.normal(size=150) * (0.5 + np.abs(x[:, 0]))
    return x, y


@pytest.fixture(scope="module")
def frame(spark, data):
    x, y = data
    return spark.createDataFrame([(i, *map(float, r), float(v)) for i, (r, v) in enumerate(zip(x, y))], "date int, a double, b double, c double, y double").repartition(4)


def design(x):
    return np.column_stack([np.ones(len(x)), x])


def solve(x, y):
    b = np.linalg.lstsq(x, y, rcond=None)[0]
    return b, y - x @ b


@pytest.fixture(scope="module")
def fit(frame):
    return ols.fit_from_gram(ols.gram(frame, NAMES, "y"), "y", NAMES)


def test_coefficients_and_errors(frame, data, fit):
    x, y = design(data[0]), data[1]
    b, e = solve(x, y)
    inv = np.linalg.inv(x.T @ x)
    plain = np.sqrt(np.diag(inv) * (e @ e) / (len(y) - 4))
    h = np.einsum("ij,jk,ik->i", x, inv, x)
    robust = np.sqrt(np.diag(inv @ (x.T * (e / (1 - h)) ** 2) @ x @ inv))
    for f, se in ((fit, plain), (ols.hc3(frame, fit), robust)):
        rows = ols.coef_table(f)
        assert [r[0] for r in rows] == ["Intercept", *NAMES]
        assert np.allclose([r[1] for r in rows], b) and np.allclose([r[2] for r in rows], se) and np.allclose([r[3] for r in rows], b / se)
    z = NormalDist()
    assert np.allclose([r[4] for r in ols.coef_table(ols.hc3(frame, fit))], [2 * z.cdf(-abs(t)) for t in b / robust], atol=1e-7)


def test_fit_statistics(data, fit):
    x, y = design(data[0]), data[1]
    _, e = solve(x, y)
    n, k, ssr, sst = len(y), 4, e @ e, ((y - y.mean()) ** 2).sum()
    s = ols.summary_stats(fit)
    llf = -n / 2 * (math.log(2 * math.pi * ssr / n) + 1)
    want = {"r_squared": 1 - ssr / sst, "adj_r_squared": 1 - ssr / (n - k) / (sst / (n - 1)), "f_statistic": ((sst - ssr) / 3) / (ssr / (n - k)),
            "log_likelihood": llf, "aic": 2 * k - 2 * llf, "bic": k * math.log(n) - 2 * llf, "n": n, "df_model": 3, "df_resid": n - k}
    assert {c: s[c] for c in want} == pytest.approx(want)


def test_anova_drops_one_term_at_a_time(data, fit):
    x, y = data
    full = (solve(design(x), y)[1] ** 2).sum()
    want = {c: (solve(design(np.delete(x, i, axis=1)), y)[1] ** 2).sum() - full for i, c in enumerate(NAMES)} | {"Residual": full}
    rows = ols.anova_type2(fit)
    assert {r[0]: r[1] for r in rows} == pytest.approx(want)
    assert {r[0]: r[3] for r in rows if r[0] != "Residual"} == pytest.approx({c: want[c] / (full / (len(y) - 4)) for c in NAMES})
    assert [r[5] for r in rows] == sorted((r[5] for r in rows), reverse=True) and sum(r[5] for r in rows) == pytest.approx(1)


def test_inflation(frame, data):
    x = data[0]
    got = dict(ols.vif(ols.gram(frame, NAMES, "y"), NAMES))
    for i, c in enumerate(NAMES):
        e = solve(design(np.delete(x, i, axis=1)), x[:, i])[1]
        assert got[c] == pytest.approx(((x[:, i] - x[:, i].mean()) ** 2).sum() / (e @ e))


def test_residual_diagnostics(frame, data, fit):
    e = solve(design(data[0]), data[1])[1]
    n, c = len(e), e - e.mean()
    skew, kurt = (c ** 3).mean() / (c ** 2).mean() ** 1.5, (c ** 4).mean() / (c ** 2).mean() ** 2
    got = ols.residual_diagnostics(frame, fit)
    want = {"durbin_watson": (np.diff(e) ** 2).sum() / (e @ e), "skew": skew, "kurtosis": kurt, "jarque_bera": n / 6 * (skew ** 2 + (kurt - 3) ** 2 / 4)}
    assert {k: got[k] for k in want} == pytest.approx(want)
    assert got["jb_pvalue"] == pytest.approx(math.exp(-want["jarque_bera"] / 2))


def test_breusch_pagan(frame, data, fit):
    x = design(data[0])
    e2 = solve(x, data[1])[1] ** 2
    r2 = 1 - (solve(x, e2)[1] ** 2).sum() / ((e2 - e2.mean()) ** 2).sum()
    got = ols.breusch_pagan(frame, fit)
    assert got["lm"] == pytest.approx(len(e2) * r2) and got["f_value"] == pytest.approx((r2 / 3) / ((1 - r2) / (len(e2) - 4)))
    assert got["heteroscedastic"] == (got["lm_pvalue"] < 0.05)


def test_backward_steps(frame, data):
    """Every step drops the term of the greatest p, recomputed on what is left."""
    x, y = data
    _, steps = ols.backward_selection(frame, ols.gram(frame, NAMES, "y"), "y", NAMES, "nonrobust")
    left = list(NAMES)
    for _, action, name, _, many in steps:
        xs = design(x[:, [NAMES.index(c) for c in left]])
        b, e = solve(xs, y)
        t = np.abs(b / np.sqrt(np.diag(np.linalg.inv(xs.T @ xs)) * (e @ e) / (len(y) - xs.shape[1])))[1:]
        if action == "remove":
            assert name == left[int(t.argmin())]
            left.remove(name)
        assert many == len(left)
    assert steps[-1][1] == "final" and set(left) >= {"a", "b"}


def test_qq_points(frame, data, fit):
    e = np.sort(solve(design(data[0]), data[1])[1])
    rows = sorted(ols.qq_points(frame, fit).collect(), key=lambda r: r["i"])
    assert [r["i"] for r in rows] == list(range(1, 151)) and np.allclose([r["resid"] for r in rows], e)
    n, z = 150, NormalDist()
    p = [1 - 0.5 ** (1 / n)] + [(i - 0.3175) / (n + 0.365) for i in range(2, n)] + [0.5 ** (1 / n)]
    assert np.allclose([r["theoretical"] for r in rows], [z.inv_cdf(v) for v in p])


def test_pca_equals_numpy(spark, data):
    from pyspark.ml.functions import array_to_vector, vector_to_array
    x = data[0]
    vec = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "id int, a array<double>").select("id", array_to_vector("a").alias("features"))
    out, explained = ml.pca2(vec, 2)
    _, s, vt = np.linalg.svd(x - x.mean(axis=0), full_matrices=False)
    assert np.allclose(explained, (s ** 2 / (s ** 2).sum())[:2])
    got = np.array([r[0] for r in out.orderBy("id").select(vector_to_array("pca")).collect()])
    assert np.allclose(np.abs(got), np.abs((x - x.mean(axis=0)) @ vt[:2].T))
