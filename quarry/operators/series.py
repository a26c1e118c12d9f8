"""Technical time-series features.

All windows are partitioned by ``symbol`` and ordered by ``date`` (Q1/Q2:
explicit order, never file order); every lag of one symbol shares one sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry import params




def _w(part="symbol", order="date") -> Window:
    return Window.partitionBy(part).orderBy(order)


def rolling_mean(c, n: int, min_periods: int, w: Window) -> Column:
    """Mean over the last n rows, null unless >= min_periods values."""
    f = w.rowsBetween(-(n - 1), 0)
    c = F.col(c) if isinstance(c, str) else c
    return F.when(F.count(c).over(f) >= min_periods, F.avg(c).over(f))


def rsi(close: str = "close", period: int = params.RSI_PERIOD, w: Window | None = None) -> Column:
    """Simple-mean RSI; the first difference counts as 0 gain / 0 loss;
    avg_loss 0 -> 100, both 0 -> NaN."""
    w = w or _w()
    d = F.coalesce(F.col(close) - F.lag(close).over(w), F.lit(0.0))
    gain = F.when(d > 0, d).otherwise(F.lit(0.0))
    loss = F.when(d < 0, -d).otherwise(F.lit(0.0))
    f = w.rowsBetween(-(period - 1), 0)
    ag, al = F.avg(gain).over(f), F.avg(loss).over(f)
    full = F.count(F.lit(1)).over(f) >= period
    val = (F.when((al == 0) & (ag == 0), F.lit(float("nan")))
           .when(al == 0, F.lit(100.0))
           .otherwise(F.lit(100.0) - F.lit(100.0) / (F.lit(1.0) + ag / al)))
    return F.when(full, val)


def log_return(close: str = "close", w: Window | None = None) -> Column:
    """ln(close / previous close)."""
    w = w or _w()
    return F.ln(F.col(close) / F.lag(close).over(w))


def rolling_std(c: str, n: int, w: Window | None = None) -> Column:
    """Sample std over the last n rows, needing n non-null values."""
    w = (w or _w()).rowsBetween(-(n - 1), 0)
    return F.when(F.count(c).over(w) == n, F.stddev_samp(c).over(w))


def volume_deltas(df: DataFrame, n: int = params.N_VOLUME_LAGS, w: Window | None = None) -> DataFrame:
    """Volume minus volume i rows back, i = 1..n (one sort)."""
    w = w or _w()
    return df.select("*", *[(F.col("volume") - F.lag("volume", i).over(w)).alias(f"delta_volume_{i}_days_back")
                            for i in range(1, n + 1)])


def trailing_eps(eps: DataFrame, k: int = 4) -> DataFrame:
    """Sum of the last k EPS by publish date, rounded 2; null if < k."""
    w = Window.partitionBy("symbol").orderBy("publish_date", "date").rowsBetween(-(k - 1), 0)
    return eps.select("symbol", "publish_date",
                      F.when(F.count("quarterly_eps").over(w) == k,
                             F.bround(F.sum("quarterly_eps").over(w), 2)).alias("ttm_eps"))


def asof_ttm(prices: DataFrame, ttm: DataFrame) -> DataFrame:
    """As-of join: the trailing EPS sum of the latest publication on or
    before each price date. Union + last(ignorenulls) window per symbol."""
    a = prices.select("symbol", "date", F.lit(1).alias("_is_price"), F.lit(None).cast("double").alias("_ttm"))
    b = ttm.select("symbol", F.col("publish_date").alias("date"), F.lit(0).alias("_is_price"),
                   F.col("ttm_eps").alias("_ttm"))
    w = Window.partitionBy("symbol").orderBy("date", "_is_price").rowsBetween(Window.unboundedPreceding, 0)
    u = a.unionByName(b).withColumn("_last", F.last("_ttm", ignorenulls=True).over(w))
    got = u.filter(F.col("_is_price") == 1).select("symbol", "date", F.col("_last").alias("ttm_eps"))
    return prices.join(got, ["symbol", "date"], "left")


def csad(returns: DataFrame, target: str = params.TARGET_SYMBOL,
         peers: list[str] | None = None) -> DataFrame:
    """F13 + J6: per date, mean over peers of |r_target - r_peer|, only on
    dates where the target and every peer have a return."""
    peers = params.PEER_SYMBOLS if peers is None else peers
    r = returns.filter(F.col("log_return").isNotNull())
    t = r.filter(F.col("symbol") == target).select("date", F.col("log_return").alias("r0"))
    p = r.filter(F.col("symbol").isin(peers)).select("date", "symbol", "log_return")
    j = t.join(p, "date")
    return (j.groupBy("date")
            .agg(F.avg(F.abs(F.col("r0") - F.col("log_return"))).alias("csad"),
                 F.countDistinct("symbol").alias("_n"))
            .filter(F.col("_n") == len(peers)).drop("_n"))


def market_returns(prices: DataFrame, symbols: list[str]) -> DataFrame:
    """F14 + J6: date x symbol return panel, complete rows only. The pivot
    receives its value list."""
    r = prices.filter(F.col("symbol").isin(symbols)).withColumn("log_return", log_return())
    p = r.groupBy("date").pivot("symbol", symbols).agg(F.first("log_return"))
    p = p.select("date", *[F.col(s).alias(f"return_{s}") for s in symbols])
    return p.na.drop()


def price_features(prices: DataFrame, eps: DataFrame, beta_dim: DataFrame,
                   floor: str = params.FEATURE_DATE_FLOOR,
                   target: str = params.TARGET_SYMBOL, peers: list[str] | None = None) -> DataFrame:
    """the full feature frame for the target symbol (P4 floor first,
    then EPS/PE, RSI, return, volatility, beta, trend, calendar, deltas,
    CSAD, complete rows only)."""
    from quarry.sources.prices import with_beta
    peers = params.PEER_SYMBOLS if peers is None else peers
    base = prices.filter(F.col("date") >= F.to_date(F.lit(floor))).na.drop()
    w = _w()
    x = asof_ttm(base, trailing_eps(eps))
    x = x.withColumn("pe", F.when(F.col("ttm_eps") != 0, F.col("close") / F.col("ttm_eps")))
    x = x.withColumn("rsi", rsi(w=w)).withColumn("log_return", log_return(w=w))
    x = x.withColumn("volatility", rolling_std("log_return", params.VOL_WINDOW, w))
    x = with_beta(x, beta_dim)
    x = x.withColumn("daily_trend", F.col("close") / F.col("open"))
    x = x.withColumn("weekday", F.weekday("date")).withColumn("quarter", F.quarter("date").cast("double"))
    x = volume_deltas(x, w=w)
    c = csad(x.select("symbol", "date", "log_return"), target, peers)
    out = x.filter(F.col("symbol") == target).join(c, "date", "left")
    return out.na.drop()


def merged_deltas(df: DataFrame) -> DataFrame:
    """sum, 1/i-weighted sum, mean, short (1-3) / long (4-10) and the
    {2,5}, {9,10}, {2,5,9,10} subset sums of the volume deltas."""
    d = {i: F.col(f"delta_volume_{i}_days_back") for i in range(1, 11)}
    s = lambda ids: sum((d[i] for i in ids[1:]), d[ids[0]])
    return df.select("*",
                     s(list(range(1, 11))).alias("delta_volume_sum"),
                     sum((d[i] * (1.0 / i) for i in range(2, 11)), d[1] * 1.0).alias("delta_volume_weighted"),
                     (s(list(range(1, 11))) / 10.0).alias("delta_volume_avg"),
                     s([1, 2, 3]).alias("delta_volume_short_term"),
                     s(list(range(4, 11))).alias("delta_volume_long_term"),
                     s([2, 5]).alias("delta_volume_sum_2_5"),
                     s([9, 10]).alias("delta_volume_sum_9_10"),
                     s([2, 5, 9, 10]).alias("delta_volume_sum_2_5_9_10"))


def zscore_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    """(x - mean) / sample std. The moments are one global aggregate
    (two numbers per column) applied back as literals: no single-partition
    window, no join."""
    m = df.agg(*[F.avg(c).alias(f"m_{c}") for c in cols],
               *[F.stddev_samp(c).alias(f"s_{c}") for c in cols]).first()
    return df.select("*", *[((F.col(c) - F.lit(m[f"m_{c}"])) / F.lit(m[f"s_{c}"])).alias(f"z_{c}") for c in cols])


def interaction(df: DataFrame, features: list[str]) -> DataFrame:
    """product of z-scores, named by joining the feature names."""
    z = zscore_columns(df, features)
    prod = None
    for f in features:
        prod = F.col(f"z_{f}") if prod is None else prod * F.col(f"z_{f}")
    return z.withColumn("_".join(features), prod).drop(*[f"z_{f}" for f in features])


def trend_flag(c) -> Column:
    """1 if ratio > 1 else -1."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c > 1, 1).otherwise(-1)


def code_labels(c, mapping: dict) -> Column:
    """Code-to-label dictionary lookup."""
    m = F.create_map(*[x for k, v in mapping.items() for x in (F.lit(k), F.lit(v))])
    return F.try_element_at(m, F.col(c) if isinstance(c, str) else c)
