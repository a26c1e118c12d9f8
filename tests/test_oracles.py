"""Every registered query against its DuckDB oracle on sf0.001."""

import math

import pytest

from quarry.plans import catalog

catalog.load_all()

SF = "/root/testdata/sf0.001"


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 5) + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "as_integer_ratio") and not isinstance(v, int):
        return round(float(v), 5)
    return v


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = catalog.QUERIES[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    sql = catalog.ORACLES.get(name)
    if sql is None:  # values are checked in the tests of the operator
        assert rows and len(set(df.columns)) == len(df.columns)
        return
    cur = duck.execute(sql)
    dcols = [d[0] for d in cur.description]
    c1, r1 = _canon(df.columns, rows)
    c2, r2 = _canon(dcols, cur.fetchall())
    assert c1 == c2
    assert len(r1) == len(r2)
    assert r1 == r2
