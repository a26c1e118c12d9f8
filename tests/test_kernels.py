"""Kernel maps against the kernels, and what they are for."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from quarry.operators import kernels, ml


def frame(spark, x, y=None):
    rows = [(i, [float(v) for v in r], float(0 if y is None else y[i])) for i, r in enumerate(x)]
    return spark.createDataFrame(rows, "id int, a array<double>, label double").repartition(3).withColumn("scaled", array_to_vector("a")).drop("a")


def mapped(df):
    return np.array([r[0] for r in df.orderBy("id").select(vector_to_array("mapped")).collect()])


@pytest.mark.parametrize("gamma", [0.1, 0.7])
def test_polynomial_map_is_the_kernel(spark, gamma):
    x = np.random.default_rng(0).random((12, 4))
    z = mapped(kernels.polynomial_map(frame(spark, x), gamma, 4))
    assert np.allclose(z @ z.T, (gamma * x @ x.T) ** 3)


@pytest.mark.parametrize("gamma", [0.1, 1.0])
def test_fourier_map_is_near_the_kernel(spark, gamma):
    x = np.random.default_rng(1).random((30, 3))
    z = mapped(kernels.fourier_map(frame(spark, x), gamma, 3, dims=4096))
    want = np.exp(-gamma * ((x[:, None] - x[None]) ** 2).sum(axis=2))
    assert np.abs(z @ z.T - want).max() < 0.08


def test_rbf_wins_where_classes_are_rings(spark):
    rng = np.random.default_rng(2)
    angle, radius = rng.uniform(0, 2 * np.pi, 300), np.where(np.arange(300) % 2, 1.0, 0.35) + rng.normal(0, 0.05, 300)
    df = frame(spark, np.stack([radius * np.cos(angle), radius * np.sin(angle)], axis=1), np.arange(300) % 2)
    f1 = {(k, c, g): f for k, c, g, f in ml.svm_grid(df, "label", 2, ["linear", "rbf"], [1.0, 10.0], [2.0])}
    assert set(f1) == {(k, c, 2.0) for k in ("linear", "rbf") for c in (1.0, 10.0)}
    assert f1["rbf", 10.0, 2.0] > 0.95 > 0.8 > max(f1["linear", c, 2.0] for c in (1.0, 10.0))


def test_tree_grid_and_target(spark):
    rng = np.random.default_rng(3)
    x = rng.random((200, 3))
    y = (x[:, 0] > 0.5).astype(float)
    df = frame(spark, x, y).withColumn("features", F.col("scaled"))
    rows, best = ml.tree_grid(df, "label", [2, 3], ["gini", "entropy"], ["best", "random"])
    assert len(rows) == 8 and {r[0] for r in rows} == {"best", "random"}
    assert max(r[3] for r in rows if r[0] == "best") > 0.95 and best.featureImportances.toArray().argmax() == 0
    out = ml.predict_target(df.where("id < 150"), df.where("id >= 150").drop("label"), 3, [4], "label", "id", max_iter=100)
    assert out.columns == ["id", "target"]
    got = {r["id"]: r["target"] for r in out.collect()}
    assert set(got) == set(range(150, 200)) and np.mean([got[i] == y[i] for i in got]) > 0.8
