"""Run every registered query in Spark and its SQL oracle in DuckDB and
compare row count, column names and order-insensitive rounded values.

usage: python scripts/oracle_check.py [sf_dir] [name ...]
"""
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from quarry.plans import catalog  # noqa: E402
from quarry.session import TABLES, get_session  # noqa: E402


def norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 5) + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if hasattr(v, "as_integer_ratio") and not isinstance(v, int):
        return round(float(v), 5)
    return v


SPARK_FAM = {"int": "INT32", "bigint": "INT64", "smallint": "INT16", "tinyint": "INT8", "double": "FLOAT64",
             "float": "FLOAT32", "string": "STRING", "boolean": "BOOL", "date": "DATE",
             "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP"}
DUCK_FAM = {"INTEGER": "INT32", "BIGINT": "INT64", "SMALLINT": "INT16", "TINYINT": "INT8", "DOUBLE": "FLOAT64",
            "FLOAT": "FLOAT32", "VARCHAR": "STRING", "BOOLEAN": "BOOL", "DATE": "DATE", "TIMESTAMP": "TIMESTAMP",
            "HUGEINT": "INT128"}


def type_diffs(df, cur):
    st = {f.name: SPARK_FAM.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    dt = {d[0]: DUCK_FAM.get(str(d[1]), str(d[1])) for d in cur.description}
    return [(c, st[c], dt.get(c)) for c in st if dt.get(c) != st[c]]


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = sorted((tuple(norm(r[i]) for i in order) for r in rows), key=repr)
    return [cols[i] for i in order], out


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    catalog.load_all()
    spark = get_session("local[8]")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    ok = bad = 0
    for name, fn in catalog.QUERIES.items():
        if names and name not in names:
            continue
        t0 = time.time()
        try:
            df = fn(spark, sf)
            scols = df.columns
            srows = [tuple(r) for r in df.collect()]
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: spark error {str(e)[:400]}")
            bad += 1
            continue
        ts = time.time() - t0
        sql = catalog.ORACLES.get(name)
        if sql is None:
            print(f"ROWS {name}: {len(srows)} rows ({ts:.1f}s, no oracle)")
            continue
        try:
            cur = con.execute(sql)
            dcols = [d[0] for d in cur.description]
            drows = cur.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: duckdb error {str(e)[:400]}")
            bad += 1
            continue
        td = type_diffs(df, cur)
        if td:
            print(f"TYPE {name}: {td}")
        c1, r1 = canon(scols, srows)
        c2, r2 = canon(dcols, drows)
        if c1 != c2:
            print(f"FAIL {name}: columns {c1} vs {c2}")
            bad += 1
        elif r1 != r2:
            diff = [x for x in r1 if x not in set(r2)][:3]
            diff2 = [x for x in r2 if x not in set(r1)][:3]
            print(f"FAIL {name}: rows {len(r1)} vs {len(r2)}; spark-only {diff}; sql-only {diff2}")
            bad += 1
        else:
            print(f"OK   {name}: {len(r1)} rows ({ts:.1f}s)")
            ok += 1
    print(f"ok={ok} bad={bad}")


if __name__ == "__main__":
    main()
