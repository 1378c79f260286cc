import math

import numpy as np
import pytest

from tablework.operators import profiles

SCHEMA = "id bigint, vec array<double>"


def brute(queries, rows, k):
    out = {}
    for q, v in queries:
        ranked = sorted((round(math.dist(v, w), 9), i) for i, w in rows if i != q)
        out |= {(q, rank): (i, d) for rank, (d, i) in enumerate(ranked[:k], 1)}
    return out


def got(df):
    rows = df.collect()
    found = {(r["query"], r["rank"]): (r.neighbour, r.distance) for r in rows}
    assert len(found) == len(rows)
    return found


@pytest.mark.parametrize("dim, k", [(1, 2), (2, 3), (4, 3)])
def test_equal_to_comparing_everything(spark, dim, k):
    draw = np.random.RandomState(dim)
    rows = [(i, [float(x) for x in np.round(v, 2)]) for i, v in enumerate(draw.rand(400, dim))]
    # a third of the rows are one vector, some rows lie far out
    rows = [(i, [0.5] * dim) if i % 3 == 0 else (i, v) for i, v in rows] + [(1000 + i, [50.0 * i] * dim) for i in range(1, 4)]
    queries = rows[:12] + rows[-2:] + [(5000, [0.1] * dim), (5001, [-400.0] * dim)]
    found = got(profiles.nearest_profiles(spark.createDataFrame(queries, SCHEMA), spark.createDataFrame(rows, SCHEMA), k))
    assert found == brute(queries, rows, k)


def test_few_pairs_are_compared(spark):
    draw = np.random.RandomState(1)
    rows = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(draw.rand(5000, 3))], SCHEMA)
    queries = rows.filter("id < 50")
    points = rows.selectExpr("vec", "array(id) as ids")
    radius = profiles._first_radius(points, queries, 3, 3, 5000)
    pairs = profiles.candidates(points, queries, radius, profiles.directions(3)).count()
    print("compared share", pairs / (50 * 5000))
    assert pairs < 0.05 * 50 * 5000


def test_rows_that_take_no_part_and_empty_sides(spark):
    rows = spark.createDataFrame(
        [(1, [0.0, 0.0]), (2, [0.0, 1.0]), (3, None), (4, [None, 1.0]), (5, [math.nan, 1.0]), (6, [math.inf, 0.0]), (None, [0.0, 0.0])], SCHEMA
    )
    assert got(profiles.nearest_profiles(rows, rows, 3)) == {(1, 1): (2, 1.0), (2, 1): (1, 1.0)}
    none = rows.filter("id > 100")
    assert got(profiles.nearest_profiles(none, rows, 3)) == got(profiles.nearest_profiles(rows, none, 3)) == {}
    with pytest.raises(ValueError, match="differ in length"):
        profiles.nearest_profiles(rows, spark.createDataFrame([(1, [1.0])], SCHEMA))
