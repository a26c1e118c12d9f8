"""Price / EPS time-series queries (PRICES and EPS bindings)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry import params
from quarry.functions.text import round_doubles
from quarry.operators import series as X
from quarry.plans.catalog import register
from quarry.sources import prices as P

S = params.sql_str
TGT = S(params.TARGET_SYMBOL)
PEERS = ", ".join(S(p) for p in params.PEER_SYMBOLS)
BETAS = ", ".join(f"({S(s)}, {b}::DOUBLE)" for s, b in params.BETAS)

BASE_SQL = f"""
so AS (SELECT c.c_mktsegment AS symbol, o.o_orderkey, o.o_orderdate,
              CAST(round(o.o_totalprice * 100) AS BIGINT) AS cents
       FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey),
prices AS (SELECT symbol, CAST(date_trunc('week', o_orderdate) AS DATE) AS date,
                  arg_min(cents, (o_orderdate, o_orderkey)) / 100.0::DOUBLE AS open,
                  CAST(sum(cents) AS DOUBLE) / count(*) / 100.0::DOUBLE AS close,
                  CAST(count(*) AS DOUBLE) AS volume
           FROM so GROUP BY ALL),
eps AS (SELECT symbol, CAST(date_trunc('quarter', o_orderdate) AS DATE) AS date,
               CAST(sum(cents) AS DOUBLE) / count(*) / 1000000.0::DOUBLE AS quarterly_eps
        FROM so GROUP BY ALL),
eps2 AS (SELECT *, CAST(date + INTERVAL 3 MONTH - INTERVAL 1 DAY + INTERVAL 40 DAY AS DATE) AS publish_date FROM eps),
ttm AS (SELECT symbol, publish_date,
               CASE WHEN count(quarterly_eps) OVER w = 4 THEN round_even(sum(quarterly_eps) OVER w, 2) END AS ttm_eps
        FROM eps2 WINDOW w AS (PARTITION BY symbol ORDER BY publish_date, date ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)),
betas(symbol, beta) AS (VALUES {BETAS})"""


def feat_sql(floor=params.FEATURE_DATE_FLOOR):
    dl = ", ".join(f"volume - lag(volume, {i}) OVER w AS delta_volume_{i}_days_back" for i in range(1, 11))
    return f"""{BASE_SQL},
base AS (SELECT * FROM prices WHERE date >= DATE '{floor}'),
x1 AS (SELECT b.*, t.ttm_eps FROM base b ASOF LEFT JOIN ttm t ON b.symbol = t.symbol AND b.date >= t.publish_date),
x2 AS (SELECT *, coalesce(close - lag(close) OVER w, 0.0) AS d, ln(close / lag(close) OVER w) AS log_return, {dl}
       FROM x1 WINDOW w AS (PARTITION BY symbol ORDER BY date)),
x3 AS (SELECT *, avg(CASE WHEN d > 0 THEN d ELSE 0.0 END) OVER f AS ag, avg(CASE WHEN d < 0 THEN -d ELSE 0.0 END) OVER f AS al,
              count(*) OVER f AS nf,
              CASE WHEN count(log_return) OVER v = 10 THEN stddev_samp(log_return) OVER v END AS volatility
       FROM x2 WINDOW f AS (PARTITION BY symbol ORDER BY date ROWS BETWEEN 13 PRECEDING AND CURRENT ROW),
                      v AS (PARTITION BY symbol ORDER BY date ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)),
x4 AS (SELECT x3.*, b.beta,
              CASE WHEN ttm_eps <> 0 THEN close / ttm_eps END AS pe,
              CASE WHEN nf >= 14 THEN (CASE WHEN al = 0 AND ag = 0 THEN 'NaN'::DOUBLE WHEN al = 0 THEN 100.0
                                             ELSE 100.0 - 100.0 / (1.0 + ag / al) END) END AS rsi,
              close / open AS daily_trend, CAST(isodow(date) - 1 AS INTEGER) AS weekday, CAST(quarter(date) AS DOUBLE) AS quarter
       FROM x3 LEFT JOIN betas b USING (symbol)),
rets AS (SELECT symbol, date, log_return FROM x4 WHERE log_return IS NOT NULL),
csad AS (SELECT t.date, avg(abs(t.log_return - p.log_return)) AS csad FROM rets t JOIN rets p ON t.date = p.date
         WHERE t.symbol = {TGT} AND p.symbol IN ({PEERS}) GROUP BY t.date HAVING count(DISTINCT p.symbol) = {len(params.PEER_SYMBOLS)}),
feat AS (SELECT x4.* EXCLUDE (d, ag, al, nf), csad.csad FROM x4 LEFT JOIN csad USING (date) WHERE symbol = {TGT})"""


FEATURE_COLS = (["symbol", "date", "open", "close", "volume", "ttm_eps", "pe", "rsi", "log_return", "volatility",
                 "beta", "daily_trend", "weekday", "quarter"]
                + [f"delta_volume_{i}_days_back" for i in range(1, 11)] + ["csad"])


def _notnull_sql(cols):
    conds = [f"{c} IS NOT NULL" for c in cols]
    conds += [f"NOT isnan({c})" for c in ("open", "close", "volume", "ttm_eps", "pe", "rsi", "log_return",
                                          "volatility", "beta", "daily_trend", "quarter", "csad")]
    return " AND ".join(conds)


def _rsel(cols, dbl):
    return ", ".join(f"round({c}, 6) AS {c}" if c in dbl else c for c in cols)


DBL = {"open", "close", "volume", "ttm_eps", "pe", "rsi", "log_return", "volatility", "beta", "daily_trend",
       "quarter", "csad"} | {f"delta_volume_{i}_days_back" for i in range(1, 11)}


def _features(spark, sf):
    return X.price_features(P.prices(spark, sf), P.eps(spark, sf), P.betas(spark))


@register("prices", f"WITH {BASE_SQL} SELECT symbol, date, round(open, 6) AS open, round(close, 6) AS close, volume FROM prices")
def prices(spark, sf):
    """PRICES binding (S9 shape): weekly segment open/close/volume."""
    return round_doubles(P.prices(spark, sf))


@register("eps", f"WITH {BASE_SQL} SELECT symbol, date, round(quarterly_eps, 6) AS quarterly_eps, publish_date FROM eps2")
def eps(spark, sf):
    """EPS binding (S8 shape)."""
    return round_doubles(P.eps(spark, sf))


def _categorize_sql() -> str:
    """Edges by linear interpolation from the nearer neighbour; a value on an
    edge goes up."""
    cols = ["open", "close"]
    edges = []
    for c in cols:
        for k, q in ((1, 100 / 3 / 100), (2, 200 / 3 / 100)):
            at = f"({q!r}::DOUBLE * (len({c}_all) - 1))"
            low, high, w = (f"{c}_all[CAST(floor({at}) AS BIGINT) + 1]", f"{c}_all[CAST(ceil({at}) AS BIGINT) + 1]", f"({at} - floor({at}))")
            edges.append(f"CASE WHEN {w} < 0.5 THEN {low} + ({high} - {low}) * {w} ELSE {high} - ({high} - {low}) * (1 - {w}) END AS {c}{k}")
    lists = ", ".join(f"list({c} ORDER BY {c}) AS {c}_all" for c in cols)
    bins = ", ".join(f"1 + CAST(p.{c} >= {c}1 AS INTEGER) + CAST(p.{c} >= {c}2 AS INTEGER) AS {c}" for c in cols)
    return f"""WITH {BASE_SQL}, l AS (SELECT {lists} FROM prices), e AS (SELECT {", ".join(edges)} FROM l)
SELECT symbol, date, {bins}, volume, CASE WHEN p.close / p.open > 1 THEN 1 ELSE -1 END AS daily_trend FROM prices p, e"""


@register("categorized_prices", _categorize_sql)
def categorized_prices(spark, sf):
    """price columns to quantile labels 1 / 2 / 3, the trend to 1 / -1."""
    from quarry.operators.tabular import categorize
    p = P.prices(spark, sf).withColumn("daily_trend", F.col("close") / F.col("open"))
    return categorize(p, ["symbol", "date", "volume"])


@register("price_window", f"""WITH {BASE_SQL}
SELECT symbol, date, round(close, 6) AS close FROM prices WHERE date BETWEEN DATE '1996-01-01' AND DATE '1996-06-30'""")
def price_window(spark, sf):
    """Inclusive date-window filter."""
    p = P.prices(spark, sf).filter(F.col("date").between(F.to_date(F.lit("1996-01-01")), F.to_date(F.lit("1996-06-30"))))
    return round_doubles(p.select("symbol", "date", "close"))


@register("rsi", f"""WITH {BASE_SQL},
x AS (SELECT *, coalesce(close - lag(close) OVER (PARTITION BY symbol ORDER BY date), 0.0) AS d FROM prices),
y AS (SELECT symbol, date, avg(CASE WHEN d > 0 THEN d ELSE 0.0 END) OVER f AS ag,
             avg(CASE WHEN d < 0 THEN -d ELSE 0.0 END) OVER f AS al, count(*) OVER f AS nf
      FROM x WINDOW f AS (PARTITION BY symbol ORDER BY date ROWS BETWEEN 13 PRECEDING AND CURRENT ROW))
SELECT symbol, date, round(CASE WHEN nf >= 14 THEN (CASE WHEN al = 0 AND ag = 0 THEN 'NaN'::DOUBLE WHEN al = 0 THEN 100.0
       ELSE 100.0 - 100.0 / (1.0 + ag / al) END) END, 6) AS rsi FROM y""")
def rsi(spark, sf):
    """14-period simple-mean RSI per symbol."""
    return round_doubles(P.prices(spark, sf).select("symbol", "date", X.rsi().alias("rsi")))


@register("returns_volatility", f"""WITH {BASE_SQL},
x AS (SELECT symbol, date, ln(close / lag(close) OVER (PARTITION BY symbol ORDER BY date)) AS log_return FROM prices)
SELECT symbol, date, round(log_return, 6) AS log_return,
       round(CASE WHEN count(log_return) OVER v = 10 THEN stddev_samp(log_return) OVER v END, 6) AS volatility
FROM x WINDOW v AS (PARTITION BY symbol ORDER BY date ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)""")
def returns_volatility(spark, sf):
    """W2 + W3: log return and 10-row rolling sample std."""
    x = P.prices(spark, sf).withColumn("log_return", X.log_return())
    return round_doubles(x.select("symbol", "date", "log_return", X.rolling_std("log_return", 10).alias("volatility")))


@register("rolling_mean", f"""WITH {BASE_SQL}
SELECT symbol, date, round(CASE WHEN count(close) OVER f >= 2 THEN avg(close) OVER f END, 6) AS close_ma4
FROM prices WINDOW f AS (PARTITION BY symbol ORDER BY date ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)""")
def rolling_mean(spark, sf):
    """Rolling mean with a minimum number of periods."""
    w = X._w()
    return round_doubles(P.prices(spark, sf).select("symbol", "date", X.rolling_mean("close", 4, 2, w).alias("close_ma4")))


@register("volume_deltas", f"""WITH {BASE_SQL}
SELECT symbol, date, volume, {", ".join(f"volume - lag(volume, {i}) OVER w AS delta_volume_{i}_days_back" for i in range(1, 11))}
FROM prices WINDOW w AS (PARTITION BY symbol ORDER BY date)""")
def volume_deltas(spark, sf):
    """Volume deltas vs 1..10 rows back."""
    return X.volume_deltas(P.prices(spark, sf).select("symbol", "date", "volume"))


@register("ttm_eps", f"""WITH {BASE_SQL}
SELECT b.symbol, b.date, round(b.close, 6) AS close, round(t.ttm_eps, 6) AS ttm_eps,
       round(CASE WHEN t.ttm_eps <> 0 THEN b.close / t.ttm_eps END, 6) AS pe
FROM prices b ASOF LEFT JOIN ttm t ON b.symbol = t.symbol AND b.date >= t.publish_date""")
def ttm_eps(spark, sf):
    """W6 + J4 + T19: as-of trailing-4-quarter EPS and the PE ratio."""
    p = P.prices(spark, sf).select("symbol", "date", "close")
    x = X.asof_ttm(p, X.trailing_eps(P.eps(spark, sf)))
    x = x.withColumn("pe", F.when(F.col("ttm_eps") != 0, F.col("close") / F.col("ttm_eps")))
    return round_doubles(x)


@register("market_returns", f"""WITH {BASE_SQL},
r AS (SELECT symbol, date, ln(close / lag(close) OVER (PARTITION BY symbol ORDER BY date)) AS log_return FROM prices),
p AS (SELECT date, {", ".join(f"max(CASE WHEN symbol = {S(s)} THEN log_return END) AS return_{s}" for s in params.PEER_SYMBOLS)}
      FROM r GROUP BY date)
SELECT date, {", ".join(f"round(return_{s}, 6) AS return_{s}" for s in params.PEER_SYMBOLS)} FROM p
WHERE {" AND ".join(f"return_{s} IS NOT NULL" for s in params.PEER_SYMBOLS)}""")
def market_returns(spark, sf):
    """F14 + J6: peer return panel aligned by date, complete rows."""
    return round_doubles(X.market_returns(P.prices(spark, sf), params.PEER_SYMBOLS))


@register("csad", f"""WITH {BASE_SQL},
r AS (SELECT symbol, date, ln(close / lag(close) OVER (PARTITION BY symbol ORDER BY date)) AS log_return FROM prices),
rets AS (SELECT * FROM r WHERE log_return IS NOT NULL)
SELECT t.date, round(avg(abs(t.log_return - p.log_return)), 6) AS csad FROM rets t JOIN rets p ON t.date = p.date
WHERE t.symbol = {TGT} AND p.symbol IN ({PEERS}) GROUP BY t.date HAVING count(DISTINCT p.symbol) = {len(params.PEER_SYMBOLS)}""")
def csad(spark, sf):
    """cross-sectional absolute deviation of the target vs peers."""
    r = P.prices(spark, sf).withColumn("log_return", X.log_return())
    return round_doubles(X.csad(r))


@register("price_features", lambda: f"""WITH {feat_sql()}
SELECT {_rsel(FEATURE_COLS, DBL)} FROM feat WHERE {_notnull_sql(FEATURE_COLS)}""")
def price_features(spark, sf):
    """F15 (+P4, P5, S10, J5, J7, T18, T20): full technical feature frame."""
    return round_doubles(_features(spark, sf).select(*FEATURE_COLS))


MERGED = ["delta_volume_sum", "delta_volume_weighted", "delta_volume_avg", "delta_volume_short_term",
          "delta_volume_long_term", "delta_volume_sum_2_5", "delta_volume_sum_9_10", "delta_volume_sum_2_5_9_10"]


def _merged_sql():
    d = lambda i: f"delta_volume_{i}_days_back"
    s = lambda ids: " + ".join(d(i) for i in ids)
    w = d(1) + " * 1.0 + " + " + ".join(f"{d(i)} * {1.0 / i!r}" for i in range(2, 11))
    return f"""WITH {feat_sql()},
f AS (SELECT * FROM feat WHERE {_notnull_sql(FEATURE_COLS)})
SELECT date, round({s(range(1, 11))}, 6) AS delta_volume_sum, round({w}, 6) AS delta_volume_weighted,
       round(({s(range(1, 11))}) / 10.0, 6) AS delta_volume_avg, round({s([1, 2, 3])}, 6) AS delta_volume_short_term,
       round({s(range(4, 11))}, 6) AS delta_volume_long_term, round({s([2, 5])}, 6) AS delta_volume_sum_2_5,
       round({s([9, 10])}, 6) AS delta_volume_sum_9_10, round({s([2, 5, 9, 10])}, 6) AS delta_volume_sum_2_5_9_10
FROM f"""


@register("merged_deltas", _merged_sql)
def merged_deltas(spark, sf):
    """merged volume-delta features."""
    return round_doubles(X.merged_deltas(_features(spark, sf)).select("date", *MERGED))


@register("calendar_trend", lambda: f"""WITH {feat_sql()},
f AS (SELECT * FROM feat WHERE {_notnull_sql(FEATURE_COLS)})
SELECT date, weekday, quarter, CASE WHEN daily_trend > 1 THEN 1 ELSE -1 END AS trend,
       ['Monday','Tuesday','Wednesday','Thursday','Friday','Saturday','Sunday'][weekday + 1] AS weekday_name,
       'Q' || CAST(CAST(quarter AS INTEGER) AS VARCHAR) AS quarter_name,
       CASE WHEN daily_trend > 1 THEN 'up' ELSE 'down' END AS trend_name
FROM f""")
def calendar_trend(spark, sf):
    """Calendar parts, trend flag and label dictionaries."""
    f = _features(spark, sf)
    wd = {i: n for i, n in enumerate(["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"])}
    return f.select("date", "weekday", "quarter", X.trend_flag("daily_trend").alias("trend"),
                    X.code_labels("weekday", wd).alias("weekday_name"),
                    X.code_labels(F.col("quarter").cast("int"), {1: "Q1", 2: "Q2", 3: "Q3", 4: "Q4"}).alias("quarter_name"),
                    X.code_labels(X.trend_flag("daily_trend"), {-1: "down", 1: "up"}).alias("trend_name"))


@register("interaction_feature", lambda: f"""WITH {feat_sql()},
f AS (SELECT * FROM feat WHERE {_notnull_sql(FEATURE_COLS)}),
m AS (SELECT avg(rsi) AS mr, stddev_samp(rsi) AS sr, avg(volatility) AS mv, stddev_samp(volatility) AS sv FROM f)
SELECT date, round(((rsi - mr) / sr) * ((volatility - mv) / sv), 6) AS rsi_volatility FROM f, m""")
def interaction_feature(spark, sf):
    """F10 + F11: product of z-scores of two features."""
    f = _features(spark, sf)
    return round_doubles(X.interaction(f, ["rsi", "volatility"]).select("date", "rsi_volatility"))
