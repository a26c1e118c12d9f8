"""Ordinary least squares with diagnostics.

One pass computes the moments, a second the Gram matrix of the centred and
scaled design; only (p+1)^2 numbers reach the driver, where the p x p solve
runs. HC3 and Breusch-Pagan take one more pass each, with the fitted
coefficients applied as literals inside the aggregate expression. Re-fits
(backward steps, feature-set comparisons) reuse sub-blocks of one Gram
matrix instead of rescanning rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions import distributions as D
from quarry.operators.ranks import with_previous, with_rank


@dataclass
class Gram:
    names: list[str]          # design columns, "Intercept" first
    xtx: np.ndarray           # raw X'X (with intercept)
    xty: np.ndarray
    yty: float
    n: int
    ybar: float


@dataclass
class Fit:
    y: str
    names: list[str]
    beta: np.ndarray
    cov: np.ndarray
    cov_type: str
    n: int
    ssr: float
    sst: float
    xtx_inv: np.ndarray
    stats: dict = field(default_factory=dict)


def gram(df: DataFrame, x: list[str], y: str) -> Gram:
    """Two aggregate passes: moments, then the scaled Gram matrix; the raw
    Gram is reconstructed on the driver (better conditioned sums)."""
    cols = x + [y]
    m = df.agg(F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)],
               *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(cols)]).first()
    n = m["n"]
    mu = np.array([m[f"m{i}"] for i in range(len(cols))], dtype=float)
    sd = np.array([m[f"s{i}"] or 1.0 for i in range(len(cols))], dtype=float)
    sd[sd == 0] = 1.0
    z = [(F.col(c) - F.lit(float(mu[i]))) / F.lit(float(sd[i])) for i, c in enumerate(cols)]
    k = len(cols)
    prods = [(i, j) for i in range(k) for j in range(i, k)]
    g = df.agg(*[F.sum(z[i] * z[j]).alias(f"g{i}_{j}") for i, j in prods]).first()
    zz = np.zeros((k, k))
    for i, j in prods:
        zz[i, j] = zz[j, i] = g[f"g{i}_{j}"]
    # raw sums: sum x_i x_j = sd_i sd_j zz_ij + n mu_i mu_j (centred z sums to 0)
    raw = np.outer(sd, sd) * zz + n * np.outer(mu, mu)
    p = len(x)
    xtx = np.zeros((p + 1, p + 1))
    xtx[0, 0] = n
    xtx[0, 1:] = xtx[1:, 0] = n * mu[:p]
    xtx[1:, 1:] = raw[:p, :p]
    xty = np.concatenate([[n * mu[p]], raw[:p, p]])
    return Gram(["Intercept"] + x, xtx, xty, float(raw[p, p]), n, float(mu[p]))


def _sub(g: Gram, cols: list[str]) -> tuple[np.ndarray, np.ndarray, list[str]]:
    idx = [0] + [g.names.index(c) for c in cols]
    return g.xtx[np.ix_(idx, idx)], g.xty[idx], ["Intercept"] + cols


def fit_from_gram(g: Gram, y: str, cols: list[str]) -> Fit:
    xtx, xty, names = _sub(g, cols)
    inv = np.linalg.pinv(xtx)
    beta = inv @ xty
    ssr = float(g.yty - 2 * beta @ xty + beta @ xtx @ beta)
    ssr = max(ssr, 0.0)
    sst = float(g.yty - g.n * g.ybar ** 2)
    dfr = g.n - len(names)
    sigma2 = ssr / dfr if dfr > 0 else float("nan")
    return Fit(y, names, beta, sigma2 * inv, "nonrobust", g.n, ssr, sst, inv)


def _design(names: list[str]) -> list[Column]:
    return [F.lit(1.0) if nm == "Intercept" else F.col(nm).cast("double") for nm in names]


def _resid_expr(f: Fit) -> Column:
    xs = _design(f.names)
    return F.col(f.y) - _bsum([F.lit(float(b)) * c for b, c in zip(f.beta, xs)])


def fitted_expr(f: Fit) -> Column:
    """Fitted value as a column expression."""
    return F.col(f.y) - _resid_expr(f)


def _bsum(terms: list[Column]) -> Column:
    """Balanced sum (keeps expression trees shallow)."""
    while len(terms) > 1:
        terms = [terms[i] + terms[i + 1] if i + 1 < len(terms) else terms[i] for i in range(0, len(terms), 2)]
    return terms[0]


def hc3(df: DataFrame, f: Fit) -> Fit:
    """HC3 sandwich, (X'X)^-1 [sum x x' e^2/(1-h)^2] (X'X)^-1, h the
    leverage x' (X'X)^-1 x computed per row in staged projections."""
    xs = _design(f.names)
    k = len(xs)
    inv = f.xtx_inv
    d = df.select(*[c.alias(f"__x{i}") for i, c in enumerate(xs)], _resid_expr(f).alias("__e"))
    xc = [F.col(f"__x{i}") for i in range(k)]
    d = d.select("*", *[_bsum([F.lit(float(inv[i, j])) * xc[j] for j in range(k)]).alias(f"__q{i}")
                        for i in range(k)])
    h = _bsum([xc[i] * F.col(f"__q{i}") for i in range(k)])
    d = d.select(*xc, ((F.col("__e") ** 2) / ((F.lit(1.0) - h) ** 2)).alias("__w"))
    w = F.col("__w")
    prods = [(i, j) for i in range(k) for j in range(i, k)]
    r = d.agg(*[F.sum(xc[i] * xc[j] * w).alias(f"m{i}_{j}") for i, j in prods]).first()
    meat = np.zeros((k, k))
    for i, j in prods:
        meat[i, j] = meat[j, i] = r[f"m{i}_{j}"]
    return Fit(f.y, f.names, f.beta, inv @ meat @ inv, "HC3", f.n, f.ssr, f.sst, inv)


def summary_stats(f: Fit) -> dict:
    """R^2, adj. R^2, F, log-likelihood, AIC, BIC, n, df."""
    n, k = f.n, len(f.names)
    if n <= k:
        nan = float("nan")
        return {"r_squared": nan, "adj_r_squared": nan, "f_statistic": nan, "f_pvalue": nan,
                "log_likelihood": nan, "aic": nan, "bic": nan, "n": n, "df_model": k - 1, "df_resid": n - k}
    r2 = 1 - f.ssr / f.sst if f.sst > 0 else float("nan")
    adj = 1 - (1 - r2) * (n - 1) / (n - k) if n > k else float("nan")
    llf = -n / 2.0 * (math.log(2 * math.pi) + math.log(f.ssr / n) + 1) if f.ssr > 0 else float("inf")
    dfm, dfr = k - 1, n - k
    if f.cov_type == "nonrobust":
        fstat = (r2 / dfm) / ((1 - r2) / dfr) if dfm > 0 and dfr > 0 and r2 < 1 else float("nan")
    else:  # Wald test of all slopes with the robust covariance
        b, c = f.beta[1:], f.cov[1:, 1:]
        fstat = float(b @ np.linalg.pinv(c) @ b) / dfm if dfm > 0 else float("nan")
    return {"r_squared": r2, "adj_r_squared": adj, "f_statistic": fstat,
            "f_pvalue": D.f_sf(fstat, dfm, dfr) if not math.isnan(fstat) else float("nan"),
            "log_likelihood": llf, "aic": -2 * llf + 2 * k, "bic": -2 * llf + k * math.log(n),
            "n": n, "df_model": dfm, "df_resid": dfr}


def coef_table(f: Fit) -> list[tuple]:
    """Coefficient, std error, t (or z for HC3), p, 95% bounds."""
    se = np.sqrt(np.maximum(np.diag(f.cov), 0))
    dfr = f.n - len(f.names)
    rows = []
    for nm, b, s in zip(f.names, f.beta, se):
        t = b / s if s > 0 else float("nan")
        if f.cov_type == "nonrobust":
            p = D.t_sf2(t, dfr)
            q = _t_ppf975(dfr)
        else:
            p = D.norm_sf2(t)
            q = 1.959963984540054
        rows.append((nm, float(b), float(s), float(t), float(p), float(b - q * s), float(b + q * s)))
    return rows


def _t_ppf975(df: float) -> float:
    lo, hi = 0.0, 50.0
    for _ in range(200):
        mid = (lo + hi) / 2
        if D.t_sf2(mid, df) > 0.05:
            lo = mid
        else:
            hi = mid
    return (lo + hi) / 2


def equation(coefficients: DataFrame, y: str) -> DataFrame:
    """The general equation as one row, from the coefficient table (columns
    ``position`` and ``term``, the intercept first)."""
    part = F.transform(F.array_sort(F.collect_list(F.struct("position", "term"))),
                       lambda x: F.concat(F.lit("b"), x["position"], F.when(x["position"] > 0, F.concat(F.lit(" * "), x["term"])).otherwise("")))
    return coefficients.agg(F.concat_ws(" + ", part).alias("terms")).select(F.concat(F.lit(f"{y} = "), "terms").alias("equation"))


def anova_type2(f: Fit) -> list[tuple]:
    """Per-term sum of squares beta_i^2 / inv(X'X)_ii (1 df each; for a
    robust fit the Wald form with the robust variance times sigma^2), F, p,
    share of the total including the residual, sorted by share."""
    dfr = f.n - len(f.names)
    sigma2 = f.ssr / dfr if dfr > 0 else float("nan")
    rows = []
    for i, nm in enumerate(f.names):
        if nm == "Intercept":
            continue
        var = f.cov[i, i]
        fstat = f.beta[i] ** 2 / var if var > 0 else float("nan")
        rows.append((nm, fstat * sigma2, 1.0, fstat, D.f_sf(fstat, 1, dfr)))
    rows.append(("Residual", f.ssr, float(dfr), float("nan"), float("nan")))
    tot = sum(r[1] for r in rows) or float("nan")
    out = [(r[0], float(r[1]), float(r[2]), float(r[3]), float(r[4]), float(r[1] / tot)) for r in rows]
    return sorted(out, key=lambda r: -r[5])


def backward_selection(df: DataFrame, g: Gram, y: str, cols: list[str], cov_type: str = "HC3",
                       alpha: float = 0.05) -> tuple[list[str], list[tuple]]:
    """Drop the largest p-value until all <= alpha; the steps are
    returned. Nonrobust steps reuse the Gram matrix; HC3 adds one pass."""
    cur = list(cols)
    steps = []
    while cur:
        f = fit_from_gram(g, y, cur)
        if cov_type == "HC3":
            f = hc3(df, f)
        tab = [r for r in coef_table(f) if r[0] != "Intercept"]
        worst = max(tab, key=lambda r: (r[4], r[0]))
        if worst[4] <= alpha:
            steps.append((len(steps), "final", None, None, len(cur)))
            break
        cur.remove(worst[0])
        steps.append((len(steps), "remove", worst[0], float(worst[4]), len(cur)))
    return cur, steps


def vif(g: Gram, cols: list[str]) -> list[tuple]:
    """1/(1-R^2_i) regressing each design column (incl. the intercept)
    on the others, from Gram sub-blocks (uncentred R^2 for the intercept,
    whose regression has no constant)."""
    xtx, _, names = _sub(g, cols)
    out = []
    n = g.n
    for i, nm in enumerate(names):
        others = [j for j in range(len(names)) if j != i]
        a = xtx[np.ix_(others, others)]
        b = xtx[others, i]
        beta = np.linalg.pinv(a) @ b
        ssr = xtx[i, i] - 2 * beta @ b + beta @ a @ beta
        if i == 0:
            tss = xtx[i, i]
        else:
            tss = xtx[i, i] - xtx[0, i] ** 2 / n
        r2 = 1 - ssr / tss if tss > 0 else float("nan")
        out.append((nm, float(1.0 / (1.0 - r2)) if r2 < 1 else float("inf")))
    return out


def residual_diagnostics(df: DataFrame, f: Fit, order: str = "date") -> dict:
    """Durbin-Watson (residual of the row before by ``order``; a regression
    panel has one row per date), skew, kurtosis, Jarque-Bera, Omnibus, condition
    number."""
    e = _resid_expr(f)
    r = with_previous(df.select(e.alias("e"), F.col(order)), "e", order, name="before").withColumn("de", F.col("e") - F.col("before"))
    m = r.agg(F.sum(F.col("de") ** 2).alias("num"), F.sum(F.col("e") ** 2).alias("den"),
              F.skewness("e").alias("skew"), F.kurtosis("e").alias("kurt"), F.count("e").alias("n")).first()
    n = m["n"]
    if n < 8 or m["skew"] is None or not m["den"]:
        nan = float("nan")
        return {"durbin_watson": nan, "skew": nan, "kurtosis": nan, "jarque_bera": nan, "jb_pvalue": nan,
                "omnibus": nan, "omnibus_pvalue": nan, "cond_no": nan}
    s, k = m["skew"], m["kurt"] + 3.0
    jb = n / 6.0 * (s * s + (k - 3) ** 2 / 4.0)
    om = _omnibus(s, k, n)
    ev = np.linalg.eigvalsh(f.xtx_inv)
    cond = math.sqrt(ev.max() / ev.min()) if ev.min() > 0 else float("inf")
    return {"durbin_watson": m["num"] / m["den"], "skew": s, "kurtosis": k, "jarque_bera": jb,
            "jb_pvalue": math.exp(-jb / 2.0), "omnibus": om, "omnibus_pvalue": math.exp(-om / 2.0),
            "cond_no": cond}


def _omnibus(s: float, k: float, n: int) -> float:
    """D'Agostino-Pearson K^2 from the skewness and kurtosis z-scores."""
    y = s * math.sqrt((n + 1) * (n + 3) / (6.0 * (n - 2)))
    beta2 = 3.0 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2.0) * (n + 5) * (n + 7) * (n + 9))
    w2 = -1 + math.sqrt(2 * (beta2 - 1))
    delta = 1 / math.sqrt(0.5 * math.log(w2))
    alpha = math.sqrt(2.0 / (w2 - 1))
    y = y if y != 0 else 1.0
    zs = delta * math.log(y / alpha + math.sqrt((y / alpha) ** 2 + 1))
    e = 3.0 * (n - 1) / (n + 1)
    varb2 = 24.0 * n * (n - 2) * (n - 3) / ((n + 1.0) ** 2 * (n + 3) * (n + 5))
    x = (k - e) / math.sqrt(varb2)
    sqrtbeta1 = 6.0 * (n * n - 5 * n + 2) / ((n + 7.0) * (n + 9)) * math.sqrt(6.0 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3)))
    a = 6.0 + 8.0 / sqrtbeta1 * (2.0 / sqrtbeta1 + math.sqrt(1 + 4.0 / sqrtbeta1 ** 2))
    term1 = 1 - 2 / (9.0 * a)
    denom = 1 + x * math.sqrt(2 / (a - 4.0))
    term2 = math.copysign(((1 - 2.0 / a) / abs(denom)) ** (1 / 3.0), denom) if denom != 0 else float("nan")
    zk = (term1 - term2) / math.sqrt(2 / (9.0 * a))
    return zs * zs + zk * zk


def breusch_pagan(df: DataFrame, f: Fit) -> dict:
    """Auxiliary regression of e^2 on the same design; LM = n R^2."""
    cols = [c for c in f.names if c != "Intercept"]
    if f.n <= len(cols) + 1:
        nan = float("nan")
        return {"lm": nan, "lm_pvalue": nan, "f_value": nan, "f_pvalue": nan, "heteroscedastic": False}
    aux = df.select(*cols, (_resid_expr(f) ** 2).alias("__e2"))
    g = gram(aux, cols, "__e2")
    fa = fit_from_gram(g, "__e2", cols)
    r2 = 1 - fa.ssr / fa.sst
    k = len(cols)
    lm = f.n * r2
    fv = (r2 / k) / ((1 - r2) / (f.n - k - 1))
    return {"lm": lm, "lm_pvalue": D.chi2_sf(lm, k), "f_value": fv, "f_pvalue": D.f_sf(fv, k, f.n - k - 1),
            "heteroscedastic": D.chi2_sf(lm, k) < 0.05}


def qq_points(df: DataFrame, f: Fit) -> DataFrame:
    """Ordered residuals against normal order-statistic medians
    (Filliben positions), inverse normal by an Arrow-batched UDF."""
    from quarry.functions.udfs import inv_norm

    n = f.n
    r = with_rank(df.select(_resid_expr(f).alias("resid")), "resid")
    i = F.col("rank").cast("int") + 1
    pos = (F.when(i == 1, F.lit(1 - 0.5 ** (1.0 / n)))
           .when(i == n, F.lit(0.5 ** (1.0 / n)))
           .otherwise((i - 0.3175) / (n + 0.365)))
    return r.select("resid", i.alias("i"), pos.alias("p")).withColumn("theoretical", inv_norm("p"))
