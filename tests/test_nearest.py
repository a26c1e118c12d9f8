"""Nearest goals and KNN cells against all pairs."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quarry.operators import ranks
from quarry.operators import spatial as SP
from quarry.operators import tabular as TB


def km(a, b):
    la, oa, lb, ob = map(math.radians, (*a, *b))
    return 2 * SP.EARTH_KM * math.asin(math.sqrt(math.sin((lb - la) / 2) ** 2 + math.cos(la) * math.cos(lb) * math.sin((ob - oa) / 2) ** 2))


@pytest.mark.parametrize("n_goals", [1, 3, 40, 900])
def test_nearest_goal_equals_all_pairs(spark, n_goals):
    r = random.Random(n_goals)
    goals = [(f"g{i:04}", r.uniform(-90, 90), r.uniform(-180, 180)) for i in range(n_goals)]
    # a third of all goals in one town, equal coordinates, poles, the date line
    goals += [(f"t{i:04}", 48 + r.gauss(0, 0.01), 11 + r.gauss(0, 0.01)) for i in range(n_goals // 2)] + [("z same", goals[0][1], goals[0][2]), ("null", None, 1.0)]
    places = [(f"p{i}", r.uniform(-90, 90), r.uniform(-180, 180)) for i in range(60)]
    places += [("north", 90.0, 0.0), ("south", -90.0, 50.0), ("east", 10.0, 180.0), ("west", 10.0, -180.0), ("town", 48.0, 11.0), ("none", None, None)]
    frame = lambda rows: spark.createDataFrame(rows, "place string, lat double, lon double").repartition(3)
    got = {x["place"]: (x["h"], x["nearest_goal"]) for x in SP.nearest_goal(frame(places), frame(goals)).collect()}
    assert len(got) == len(places) and got["none"] == (None, None)
    for name, lat, lon in places[:-1]:
        h, goal = min((km((lat, lon), g[1:]), g[0]) for g in goals if g[1] is not None)
        assert got[name][0] == pytest.approx(h, abs=1e-6)
        assert got[name][1] == goal or km((lat, lon), next(g[1:] for g in goals if g[0] == got[name][1])) == pytest.approx(h, abs=1e-9)


def test_no_goal(spark):
    p = spark.createDataFrame([("a", 1.0, 2.0)], "place string, lat double, lon double")
    assert [tuple(r) for r in SP.nearest_goal(p, p.where("lat > 5")).collect()] == [("a", None, None)]


def test_last_mark_crosses_partitions(spark):
    rows = [(i, i // 50 if i % 50 == 0 and i else None) for i in range(400)]
    got = {x["i"]: x["m"] for x in ranks.with_last(spark.createDataFrame(rows, "i long, c long").repartition(5), "c", "i", name="m").collect()}
    assert got == {i: i // 50 or None for i in range(400)}


def fill_by_hand(rows, k):
    """Column c of rows (id, a, b, c) from the k nearest by the shared ones of a and b."""
    mean = sum(r[3] for r in rows if r[3] is not None) / sum(r[3] is not None for r in rows)
    out = {}
    for i, a, b, c in rows:
        if c is None:
            near = []
            for j, x, y, v in rows:
                both = [(p - q) ** 2 for p, q in ((a, x), (b, y)) if p is not None and q is not None]
                if v is not None and both:
                    near.append((math.sqrt(sum(both) * 3 / len(both)), j, v))
            near.sort()
            out[i] = sum(n[2] for n in near[:k]) / len(near[:k]) if near else mean
    return out


def test_one_far_outlier_fills_no_cell(spark):
    r = random.Random(4)
    rows = [(i, r.choice([None, round(r.uniform(0, 1), 3), 0.5]), r.choice([None, r.uniform(0, 1)]), r.choice([None, r.uniform(5, 9)])) for i in range(400)]
    rows += [(400, 1e9, 0.3, 7.0), (401, -1e12, 0.2, None), (402, 1e9, None, None)]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double").repartition(4)
    got = {x["id"]: x["__fill"] for x in TB._knn_fill(df, "id", "c", ["a", "b"], 5, 0.0).collect()}
    want = fill_by_hand(rows, 5)
    assert got == {i: pytest.approx(v if any(rows[i][1:3]) or rows[i][1] == 0 or rows[i][2] is not None or rows[i][1] is not None else 0.0) for i, v in want.items()}


def test_cells_hold_equal_numbers_of_donors(spark):
    d = spark.range(1000).select(F.when(F.col("id") == 999, 1e12).when(F.col("id") % 3 == 0, 7.0).otherwise(F.col("id") / 10).alias("d"), "id")
    cells = ranks.with_rank(d, "d", "id", name="at").select(F.floor(F.col("at") / TB.DONORS_PER_CELL).alias("c"))
    assert max(Counter(x["c"] for x in cells.collect()).values()) == TB.DONORS_PER_CELL


def test_a_wide_second_coordinate_makes_few_pairs(spark, monkeypatch):
    """The first coordinate says little: donors compared with a query do not grow with the table."""
    monkeypatch.setattr(TB, "DONORS_PER_CELL", 20)
    r = random.Random(5)
    rows = [(i, r.uniform(0, 1), r.choice([None, round(r.uniform(0, 3000), 1)]), r.uniform(0, 9) if i % 4 else None) for i in range(1200)]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double").repartition(4)
    got = {x["id"]: x["__fill"] for x in TB._knn_fill(df, "id", "c", ["a", "b"], 5, 0.0).collect()}
    assert got == {i: pytest.approx(v) for i, v in fill_by_hand(rows, 5).items()}
    points = spark.createDataFrame([(0, x, y) for _, x, y, c in rows if c is None and y is not None], "__pair int, __x0 double, __x1 double")
    donors = spark.createDataFrame([(0, i, c, x, y) for i, x, y, c in rows if c is not None and y is not None], "__pair int, __id long, __v double, __x0 double, __x1 double")
    cells, placed, reached = TB._cells(points, donors, ["__x0", "__x1"], 5)
    assert placed.count() == donors.count() and reached.count() == points.count()
    assert cells.agg(F.max("__n")).first()[0] <= 20 and cells.agg(F.sum("__n")).first()[0] == donors.count()
    inside = ((F.col("__x0") >= F.col("__l0")) & (F.col("__x0") <= F.col("__h0")) & (F.col("__x1") >= F.col("__l1")) & (F.col("__x1") <= F.col("__h1")))
    assert reached.where("__reach > 300 * 300").isEmpty() and cells.join(donors, "__pair").where(inside).count() == donors.count()
