"""The SQL of the queries that have one, on the small table."""

import duckdb
import pytest

from quarry.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    want = con.execute(queries.ORACLES[name])
    columns = [d[0] for d in want.description]
    df = queries.QUERIES[name](spark, SF)
    assert sorted(columns) == sorted(df.columns)
    assert sorted(map(str, (tuple(r[c] for c in columns) for r in df.collect()))) == sorted(str(r) for r in want.fetchall())
