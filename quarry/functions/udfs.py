"""The few Arrow-batched pandas UDFs (no postponed annotations here: the
type hints must be real types for pandas_udf)."""

from statistics import NormalDist

import pandas as pd
from pyspark.sql import functions as F


def _inv_norm(p: pd.Series) -> pd.Series:
    nd = NormalDist()
    return p.map(nd.inv_cdf)


def inv_norm(col):
    """Inverse standard normal CDF (R12), vectorised per Arrow batch."""
    return F.pandas_udf(_inv_norm, "double")(col)
