"""Approximate quantiles from sketches that are stored and merged."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Size of a sketch, and the error of a quantile's rank, as a share of the rows, that it is held to.
SIZE, RANK_ERROR = 400, 0.02


def quantile_sketches(df: DataFrame, keys: Sequence[str | Column], value: str, size: int = SIZE) -> DataFrame:
    """``keys`` and ``sketch``, a binary of bounded size (KLL) per group, to be written or merged.

    Nulls and NaN do not count; a group without other values has no row. Sketches are made per task
    and merged by the shuffle, so a group with very many rows is no burden.
    """
    number = F.col(value).cast("double")
    rows = df.select(*keys, number.alias("_value")).filter(F.col("_value").isNotNull() & ~F.isnan("_value"))
    names = [c for c in rows.columns if c != "_value"]
    return rows.groupBy(*names).agg(F.expr(f"kll_sketch_agg_double(_value, {size})").alias("sketch"))


def merge_sketches(sketches: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    """One sketch per group of ``keys`` from those of finer groups; the values are not read again."""
    rows = sketches.select(*keys, "sketch")
    return rows.groupBy(*[c for c in rows.columns if c != "sketch"]).agg(F.expr("kll_merge_agg_double(sketch)").alias("sketch"))


def sketch_quantiles(sketches: DataFrame, shares: Sequence[float]) -> DataFrame:
    """The other columns, ``n`` (values in the sketch), ``share`` and ``value``, a row per share."""
    keys = [c for c in sketches.columns if c != "sketch"]
    # the function takes constant shares only
    each = [F.struct(F.lit(float(x)).alias("share"), F.expr(f"kll_sketch_get_quantile_double(sketch, {float(x)!r}D)").alias("value")) for x in shares]
    n = F.expr("kll_sketch_get_n_double(sketch)").cast("long").alias("n")
    return sketches.select(*keys, n, F.explode(F.array(*each)).alias("q")).select(*keys, "n", "q.share", "q.value")
