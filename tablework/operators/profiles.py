"""Exact nearest neighbours by Euclidean distance, found through buckets of projections."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablework.plans import join_lookup, stage

_SAMPLE = 1000  # points, and as many queries, from which the first radius is taken on the driver
_DIGITS = 9  # distances are compared after rounding, as are similarities in ``knn``
_SLACK = 1e-8  # more than rounding and the noise of projections can move a distance


def directions(dim: int, count: int = 3, seed: int = 7) -> np.ndarray:
    """``count`` (at most ``dim``) orthogonal directions of length 1, one per row.

    A projection on such a direction never makes a distance longer, so rows within a
    radius of a query are within that radius of it on each projection.
    """
    square = np.linalg.qr(np.random.RandomState(seed).randn(dim, dim))[0]
    return square.T[: min(count, dim)]


def distance(a: str, b: str) -> Column:
    squares = F.zip_with(a, b, lambda x, y: (x - y) * (x - y))
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda total, x: total + x))


def _along(vec: str, way: np.ndarray) -> Column:
    return sum((F.col(vec)[i] * float(x) for i, x in enumerate(way)), F.lit(0.0))


def candidates(points: DataFrame, queries: DataFrame, radius: float, ways: np.ndarray) -> DataFrame:
    """``(query, asked, vec, ids)``: points in the buckets that a query's radius reaches.

    A bucket is ``radius`` wide on every projection, so a query asks for three or four a
    projection. The asking side is broadcast if it has few rows; then the points stay in place.
    """
    cells = [f"_c{i}" for i in range(len(ways))]
    placed = points.withColumns({c: F.floor(_along("vec", w) / radius) for c, w in zip(cells, ways)})
    asked = queries.select(F.col("id").alias("query"), F.col("vec").alias("asked"))
    for c, w in zip(cells, ways):
        low, high = (F.floor((_along("asked", w) + side * (radius + _SLACK)) / radius) for side in (-1, 1))
        asked = asked.withColumn(c, F.explode(F.sequence(low, high)))
    return join_lookup(placed, stage(asked, "asked"), cells).select("query", "asked", "vec", "ids")


def _complete(df: DataFrame) -> DataFrame:
    """``(id, vec)`` with finite numbers only, in double precision."""
    rows = df.select("id", F.col("vec").cast("array<double>").alias("vec")).filter("id IS NOT NULL AND vec IS NOT NULL")
    return rows.filter(~F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == math.inf)))


def _first_radius(points: DataFrame, queries: DataFrame, k: int, dim: int, n: int) -> float:
    """Half of the queries should find ``k`` neighbours: their distance in a sample, less what the sample left out."""
    some, asked = (
        np.array([r.vec for r in side.select("vec").orderBy(F.xxhash64("vec")).limit(_SAMPLE).collect()]) for side in (points, queries)
    )
    squares = (asked**2).sum(axis=1)[:, None] + (some**2).sum(axis=1)[None, :] - 2 * asked @ some.T
    apart = np.sort(np.sqrt(np.maximum(squares, 0)), axis=1)
    typical = float(np.median(apart[:, min(k, apart.shape[1] - 1)]))
    return max(typical * (len(some) / n) ** (1 / dim), 1e-6)


def nearest_profiles(queries: DataFrame, rows: DataFrame, k: int = 3, count: int = 3, seed: int = 7) -> DataFrame:
    """``(query, rank, neighbour, distance)``: the ``k`` rows nearest to each query, without the query itself.

    Both sides are ``(id, vec)``; ids do not repeat within a side. Ties go to the smaller id. Rows with a null id, a
    null vector, or a cell that is null or not finite take no part; vectors of different lengths are an error.

    Rows with equal vectors are one point, which keeps the ``k + 1`` smallest ids. All points within
    a radius of a query are met through buckets; a query is done when ``k`` lie
    within it, else the radius doubles, so the result is that of comparing everything. The first radius
    comes from a sample of distances and changes the work only.
    """
    queries, rows = stage(_complete(queries), "queries"), _complete(rows)
    order = Window.partitionBy("vec").orderBy("id")
    # the planner drops all but the first ids of a vector before the shuffle, too
    firsts = rows.withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= k + 1)
    points = stage(firsts.groupBy("vec").agg(F.sort_array(F.collect_list("id")).alias("ids")), "points")
    sides = points.select("vec").unionByName(queries.select("vec"))
    lengths = sides.agg(F.min(F.size("vec")).alias("low"), F.max(F.size("vec")).alias("high")).first()
    if lengths.low != lengths.high:
        raise ValueError("vectors differ in length")
    n, dim = points.count(), lengths.high or 0
    schema = "query bigint, rank int, neighbour bigint, distance double"
    if not n or not dim or queries.isEmpty():
        return rows.sparkSession.createDataFrame([], schema)
    ends = sides.agg(*[F.max(F.col("vec")[i]) - F.min(F.col("vec")[i]) for i in range(dim)]).first()
    widest = math.sqrt(sum(x * x for x in ends)) + 1e-6
    radius, ways, found = _first_radius(points, queries, k, dim, n), directions(dim, count, seed), []
    best = Window.partitionBy("query").orderBy("distance", "neighbour")
    while True:
        radius = min(radius, widest)
        near = candidates(points, queries, radius, ways).withColumn("distance", distance("asked", "vec")).filter(F.col("distance") <= radius)
        near = near.select("query", F.round("distance", _DIGITS).alias("distance"), F.explode("ids").alias("neighbour"))
        near = near.filter("neighbour <> query").withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
        near = stage(near.select("query", "rank", "neighbour", "distance"), "near")
        if radius >= widest:
            found.append(near)
            break
        done = near.filter((F.col("rank") == k) & (F.col("distance") <= radius - _SLACK)).select("query")
        found.append(near.join(done, "query"))
        queries = stage(queries.join(done, queries["id"] == done["query"], "left_anti"), "queries")
        if queries.isEmpty():
            break
        radius *= 2
    out = found[0]
    for part in found[1:]:
        out = out.unionByName(part)
    return out
