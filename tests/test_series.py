import math

import pytest
from pyspark.sql import functions as F

from quarry.operators import series as X


def _frame(spark, closes):
    return spark.createDataFrame([("S", i, float(c)) for i, c in enumerate(closes)], "symbol string, date int, close double")


def test_rsi_edge_cases(spark):
    up = _frame(spark, range(1, 21))                 # only gains -> 100
    flat = _frame(spark, [5.0] * 20)                 # no moves -> NaN
    r_up = [r.rsi for r in up.select("date", X.rsi().alias("rsi")).orderBy("date").collect()]
    r_flat = [r.rsi for r in flat.select("date", X.rsi().alias("rsi")).orderBy("date").collect()]
    assert r_up[:13] == [None] * 13 and r_up[13] == 100.0
    assert all(math.isnan(v) for v in r_flat[13:])


def test_rsi_matches_pandas_definition(spark):
    closes = [10, 11, 10.5, 12, 11, 11.5, 13, 12, 12.5, 14, 13, 13.5, 15, 14, 14.5, 16, 15]
    df = _frame(spark, closes)
    got = [r.rsi for r in df.select("date", X.rsi().alias("rsi")).orderBy("date").collect()]
    d = [0.0] + [closes[i] - closes[i - 1] for i in range(1, len(closes))]
    for i in range(13, len(closes)):
        win = d[i - 13:i + 1]
        g = sum(x for x in win if x > 0) / 14
        l_ = sum(-x for x in win if x < 0) / 14
        assert got[i] == pytest.approx(100 - 100 / (1 + g / l_))


def test_trailing_eps_needs_four_and_asof(spark):
    eps = spark.createDataFrame(
        [("S", q, 1.0 + q, q * 10) for q in range(6)], "symbol string, date int, quarterly_eps double, publish_date int")
    prices = spark.createDataFrame([("S", d) for d in (5, 25, 30, 45, 100)], "symbol string, date int")
    got = {r.date: r.ttm_eps for r in X.asof_ttm(prices, X.trailing_eps(eps)).collect()}
    # publications at 0,10,20,30,... ; the 4th (value 1+2+3+4=10) is published at 30
    assert got[5] is None and got[25] is None
    assert got[30] == 10.0 and got[45] == 14.0   # publication at 40: 2+3+4+5
    assert got[100] == pytest.approx(3 + 4 + 5 + 6)


def test_volume_deltas(spark):
    df = spark.createDataFrame([("S", i, float(v)) for i, v in enumerate([5, 7, 4, 9])], "symbol string, date int, volume double")
    r = X.volume_deltas(df, 2).orderBy("date").collect()
    assert [x.delta_volume_1_days_back for x in r] == [None, 2.0, -3.0, 5.0]
    assert [x.delta_volume_2_days_back for x in r] == [None, None, -1.0, 2.0]
