"""Feature maps under which a linear model learns with a kernel (ML9).

A map is a fixed function of a row's vector, so it is one Arrow-batched
projection; nothing is fitted and no pair of rows is compared."""

from itertools import combinations_with_replacement
from math import factorial

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _mapped(df: DataFrame, inp: str, out: str, fn) -> DataFrame:
    def run(xs: pd.Series) -> pd.Series:
        return pd.Series(list(fn(np.stack(xs.to_numpy()) if len(xs) else np.zeros((0, 1)))))
    return df.withColumn(out, array_to_vector(F.pandas_udf(run, "array<double>")(vector_to_array(inp))))


def plain(x: np.ndarray) -> np.ndarray:
    """The linear kernel: the features as they are."""
    return x


def fourier(gamma: float, size: int, dims: int = 128, seed: int = 42):
    """The map of ``fourier_map`` for rows of an array."""
    rng = np.random.default_rng(seed)
    w, b = rng.normal(0.0, np.sqrt(2 * gamma), (size, dims)), rng.uniform(0, 2 * np.pi, dims)
    return lambda x: np.sqrt(2.0 / dims) * np.cos(x @ w + b)


def polynomial(gamma: float, size: int, degree: int = 3):
    """The map of ``polynomial_map`` for rows of an array."""
    picks = list(combinations_with_replacement(range(size), degree))
    often = [factorial(degree) / np.prod([factorial(p.count(i)) for i in set(p)]) for p in picks]
    scale, at = np.sqrt(np.array(often)) * gamma ** (degree / 2), np.array(picks)
    return lambda x: np.prod(x[:, at], axis=2) * scale


def fourier_map(df: DataFrame, gamma: float, size: int, dims: int = 128, seed: int = 42, inp: str = "scaled", out: str = "mapped") -> DataFrame:
    """RBF kernel exp(-gamma |x - y|^2): the mean of cosines of random
    projections drawn from its spectrum; inner products of ``dims`` of them are
    within about 1 / sqrt(dims) of the kernel. ``size``: length of the input."""
    return _mapped(df, inp, out, fourier(gamma, size, dims, seed))


def polynomial_map(df: DataFrame, gamma: float, size: int, degree: int = 3, inp: str = "scaled", out: str = "mapped") -> DataFrame:
    """Polynomial kernel (gamma <x, y>)^degree, exactly: all monomials of that
    degree, each by the root of how often it occurs in the power."""
    return _mapped(df, inp, out, polynomial(gamma, size, degree))
