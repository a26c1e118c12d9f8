"""Distributed ranks, quantiles and previous values against sorting in Python."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.operators import ranks
from quarry.operators import tabular as TB


@pytest.fixture(scope="module")
def rows():
    r = random.Random(5)
    # a third of all rows share one value; nulls; a far outlier
    return [(i, r.choice("abc"), None if i % 7 == 0 else 3.0 if i % 3 == 0 else r.uniform(-5, 5), None if i % 11 == 0 else i // 2) for i in range(600)] + [(600, None, 1e12, 5)]


@pytest.fixture(scope="module")
def frame(spark, rows):
    return spark.createDataFrame(rows, "id long, g string, x double, y long").repartition(5)


def test_ranks_follow_the_order(frame, rows):
    got = sorted(((r["rank"], r["x"], r["id"]) for r in ranks.with_rank(frame, F.asc_nulls_first("x"), "id").collect()))
    assert [g[0] for g in got] == list(range(len(rows)))
    assert [(g[1], g[2]) for g in got] == [(x, i) for x, i in sorted(((r[2], r[0]) for r in rows), key=lambda t: (t[0] is not None, t[0] or 0, t[1]))]


def test_a_shared_value_is_dealt_to_several_tasks(spark):
    hot = spark.range(0, 20000).select("id", F.lit(1.0).alias("x"))
    key = "spark.sql.adaptive.coalescePartitions.enabled"  # else so few rows go to one task
    spark.conf.set(key, "false")
    try:
        out = ranks._dealt(hot, ["x"])
    finally:
        spark.conf.set(key, "true")
    sizes = [r["count"] for r in out.groupBy(F.shiftright("__at", ranks.PLACE_BITS).alias("p")).count().collect()]
    assert max(sizes) < 0.6 * sum(sizes)
    assert sorted(r["rank"] for r in ranks.with_rank(hot, "x").collect()) == list(range(20000))


def test_previous_value_crosses_partitions(frame, rows):
    got = {r["id"]: r["before"] for r in ranks.with_previous(frame, "x", "id", name="before").collect()}
    assert got == {r[0]: rows[k - 1][2] if k else None for k, r in enumerate(rows)}


def test_quantiles_equal_linear_interpolation(frame, rows):
    shares = [0.0, 0.25, 1 / 3, 0.5, 0.9, 1.0]
    got = {r["column"]: r for r in ranks.quantiles(frame, ["x", "y"], shares).collect()}
    for c, at in (("x", 2), ("y", 3)):
        values = np.array([r[at] for r in rows if r[at] is not None], float)
        for i, q in enumerate(shares):
            assert math.isclose(got[c][f"q{i}"], np.quantile(values, q), rel_tol=1e-12, abs_tol=1e-12)


def test_quantiles_by_group(frame, rows):
    got = {r["g"]: (r["q0"], r["q1"]) for r in ranks.quantiles(frame, ["x"], [0.25, 0.5], by="g").collect()}
    for g in ("a", "b", "c", None):
        values = [r[2] for r in rows if r[1] == g and r[2] is not None]
        assert np.allclose(got[g], np.quantile(values, [0.25, 0.5]), rtol=1e-12)


def test_empty_and_all_null(spark):
    none = spark.createDataFrame([(1, None)], "id long, x double")
    assert ranks.quantiles(none, ["x"], [0.5]).collect() == []
    assert ranks.with_rank(none.where("id > 5"), "id").collect() == []
    assert ranks.with_previous(none.where("id > 5"), "x", "id", name="b").collect() == []
    assert TB.medians(none, ["x"]).first()[0] is None
    assert TB.describe(none, ["x"]).first()["p50"] is None


def test_edges_are_those_of_numpy_to_the_last_bit(spark):
    """Values on and next to an edge, where (n - 1) / 3 is whole."""
    for x in ([0.1 * k for k in range(31)], [float(v * v) for v in range(100)], [1.0 / (k + 1) for k in range(64)]):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(x)], "id int, x double").repartition(3)
        want = np.percentile(x, np.linspace(0, 100, 4))[1:-1]
        assert TB.quantile_fit(df, ["x"])["x"] == want.tolist()
        got = {r["id"]: r["x"] for r in TB.quantile_bin(df, "x").collect()}
        assert [got[i] for i in range(len(x))] == np.searchsorted(want, x, side="right").tolist()


def test_edges_apply_to_unseen_values(spark):
    unseen = spark.createDataFrame([(-9.0,), (1.0,), (0.9999,), (99.0,), (None,)], "x double")
    assert [r[0] for r in unseen.select(TB.quantile_apply("x", [1.0, 2.0])).collect()] == [0, 1, 0, 2, None]


def test_few_distinct_values(spark):
    df = spark.createDataFrame([(i, float(i % 2), 7.0) for i in range(50)], "id int, two double, one double")
    fitted = TB.quantile_fit(df, ["two", "one"])
    assert fitted["one"] is None and fitted["two"] == [0.5]


def test_box_outliers_and_unit_bins(spark):
    df = spark.createDataFrame([("a", float(v)) for v in [1, 2, 3, 4, 5, 100]] + [("b", None)], "g string, x double")
    assert [r["x"] for r in TB.box_outliers(df, "g", "x").collect()] == [100.0]
    counts = {r["value"]: r["n"] for r in TB.unit_histogram(df.where("x < 9 or x is null").withColumn("x", F.col("x") * 2), "x").collect()}
    assert counts == {2: 1, 3: 0, 4: 1, 5: 0, 6: 1, 7: 0, 8: 1, 9: 0, 10: 1}
