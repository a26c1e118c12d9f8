import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.operators import tabular as TB
from quarry.sources import files as FS
from quarry.sources.prices import parse_volume


def test_comment_literal_parser(spark):
    # literal samples: deleted author 'None', escaped quote, \xNN escape, newline escape
    s1 = "[{'author': 'None', 'body': \"There's no way\", 'score': 258}]"
    s2 = "[{'author': 'a', 'body': 'it\\'s \\xa0 ok\\n', 'score': -5}]"
    df = spark.createDataFrame([(s1,), (s2,)], "c string")
    got = df.select(FS.parse_comment_literal("c").alias("p")).collect()
    assert got[0].p[0].author == "None" and got[0].p[0].body == "There's no way" and got[0].p[0].score == 258
    assert got[1].p[0].body == "it's \xa0 ok\n" and got[1].p[0].score == -5


def test_vendor_volume_suffix(spark):
    df = spark.createDataFrame([("46.14M",), ("3.2K",), ("1.5B",), ("12",)], "v string")
    assert [r[0] for r in df.select(parse_volume("v")).collect()] == pytest.approx([46.14e6, 3.2e3, 1.5e9, 12.0])


def test_quantile_bins_match_numpy_rule(spark):
    vals = [1.0, 2.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0, 8.0, 9.0]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "id int, x double")
    got = [r.x for r in TB.quantile_bin(df, "x").orderBy("id").collect()]
    edges = np.percentile(vals, np.linspace(0, 100, 4))
    exp = list(np.searchsorted(edges[1:-1], vals, side="right"))
    assert got == exp


def test_constant_column_bins_to_zero(spark):
    df = spark.createDataFrame([(i, 5.0) for i in range(5)], "id int, x double")
    assert {r.x for r in TB.quantile_bin(df, "x").collect()} == {0}


def test_driving_age_repair(spark):
    df = spark.createDataFrame([(20, 10), (40, 5)], "age int, driving_experience int")
    got = [r.driving_experience for r in TB.fix_driving_age(df).collect()]
    assert got == [4, 5]


def test_knn_impute_brute_force(spark):
    rng = np.random.default_rng(0)
    n = 300
    a = rng.normal(size=n).round(3)
    b = rng.normal(size=n).round(3)
    a[::7] = np.nan
    b[::11] = np.nan
    rows = [(i, None if np.isnan(a[i]) else float(a[i]), None if np.isnan(b[i]) else float(b[i])) for i in range(n)]
    df = spark.createDataFrame(rows, "id int, a double, b double")
    got = {r.id: (r.a, r.b) for r in TB.knn_impute(df, "id", ["a", "b"]).collect()}
    for i in range(n):
        for t, o in ((0, 1), (1, 0)):
            col, other = (a, b) if t == 0 else (b, a)
            if not np.isnan(col[i]):
                continue
            if np.isnan(other[i]):
                exp = np.nanmean(col)
            else:
                don = [(abs(other[i] - other[j]), j) for j in range(n) if not np.isnan(col[j]) and not np.isnan(other[j])]
                don.sort()
                exp = np.mean([col[j] for _, j in don[:5]])
            assert got[i][t] == pytest.approx(exp)
