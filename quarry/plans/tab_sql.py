"""SQL rendering of the TAB binding."""

TAB_SQL = """
ordagg AS (SELECT o_custkey AS c_custkey, sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS cents,
                  sum(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END) AS urgent,
                  sum(CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END) AS pending
           FROM orders GROUP BY o_custkey),
tab AS (SELECT c.c_custkey AS id, 16 + c.c_custkey % 70 AS age, c.c_custkey * 7 % 60 AS driving_experience,
               CASE WHEN c.c_custkey % 17 <> 0 THEN (c.c_acctbal + 1000) / 11000 END AS credit_score,
               CASE WHEN c.c_custkey % 19 <> 0 THEN CAST(o.cents AS DOUBLE) / 100000.0::DOUBLE END AS annual_mileage,
               CAST(coalesce(o.urgent, 0) AS BIGINT) AS speeding_violations,
               CAST(coalesce(o.pending, 0) AS BIGINT) AS past_accidents,
               c.c_mktsegment AS vehicle_type,
               CASE WHEN c.c_nationkey % 2 = 0 THEN 'yes' ELSE 'no' END AS married,
               CASE WHEN c.c_custkey % 3 = 0 THEN 'yes' ELSE 'no' END AS children,
               CAST(c.c_acctbal > 0 AS INTEGER) AS outcome
        FROM customer c LEFT JOIN ordagg o ON o.c_custkey = c.c_custkey)"""
